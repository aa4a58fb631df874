"""Aggregations, window ranking, top-k and sampling.

Every fit statistic is computed by one distributed aggregation (partial, map-side);
its result has one value per fitted column -- a size fixed by the schema, as in any
Spark ML estimator -- and is applied back as literals inside one projection.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featureflow.functions.columns import key_hash32


def row_count(df: DataFrame, where: Column | None = None) -> DataFrame:
    """A0: rows, plain and under a predicate, as a one-row frame."""
    cols = [F.count(F.lit(1)).alias("n_rows")]
    if where is not None:
        cols.append(F.count_if(where).alias("n_matching"))
    return df.agg(*cols)


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """A1: frequency table, most frequent first (value as tie-break)."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), F.asc(col))


def column_modes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A2 fit: most frequent non-null value per column; ties -> the smallest value in the column's type.

    One row per column: its name, the value as text (``value``) and in its own type (field of ``typed``).
    Counts come from one ``explode`` of (column, value) pairs and one partial aggregation; the ranking
    then runs over distinct values only.
    """
    names = [f"v{i}" for i in range(len(cols))]
    fields = lambda at: [(F.col(c) if i == at else F.lit(None).cast(df.schema[c].dataType)).alias(n)
                         for i, (c, n) in enumerate(zip(cols, names, strict=True))]
    pairs = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"), *fields(i)) for i, c in enumerate(cols)])).alias("p"))
    counts = pairs.select("p.*").where(F.col("value").isNotNull()).groupBy("column", "value", *names).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("column").orderBy(F.desc("n"), *[F.asc(n) for n in names])
    return (counts.withColumn("_r", F.row_number().over(w)).where("_r = 1")
            .select("column", "value", "n", F.struct(*names).alias("typed")))


def fit_modes(df: DataFrame, cols: Sequence[str]) -> dict:
    """A2 fit: {column: mode in the column's type}. The result has one entry per column (size fixed by
    the schema, not the data), like any Spark ML estimator's fitted state."""
    got = {r["column"]: r["typed"][list(cols).index(r["column"])] for r in column_modes(df, cols).collect()}
    return {c: got.get(c) for c in cols}


def impute_mode(df: DataFrame, cols: Sequence[str], modes: dict | None = None) -> DataFrame:
    """A2 apply: fill nulls with the column mode, types kept; a literal projection."""
    modes = modes if modes is not None else fit_modes(df, cols)
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(modes[c]).cast(df.schema[c].dataType)) for c in cols})


def fit_means(df: DataFrame, cols: Sequence[str]) -> dict[str, float | None]:
    """A3 fit: {column: mean of the non-null values} from one partial aggregation."""
    row = df.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in cols]).first()
    return {c: row[c] for c in cols}


def impute_mean(df: DataFrame, cols: Sequence[str], means: dict | None = None) -> DataFrame:
    """A3 apply: nulls -> the fitted mean (fit on ``df`` unless ``means`` is given)."""
    means = means if means is not None else fit_means(df, cols)
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(means[c]).cast("double"))
                           for c in cols})


def fit_standardize(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """A4 fit: {column: (mean, population std)}; zero or undefined std -> 1."""
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"m_{c}"), F.stddev_pop(x).alias(f"s_{c}")]
    row = df.agg(*aggs).first()
    return {c: (row[f"m_{c}"], row[f"s_{c}"] if row[f"s_{c}"] not in (None, 0.0) else 1.0) for c in cols}


def fit_impute_standardize(df: DataFrame, cols: Sequence[str]) -> tuple[dict, dict]:
    """A3 + A4 fit in one pass: means of the non-null values, and the population std
    the columns have *after* mean imputation. Imputed rows sit on the mean, so that
    std is sqrt(n_nonnull / n_rows) times the std of the non-null values."""
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"m_{c}"), F.stddev_pop(x).alias(f"s_{c}"), F.count(x).alias(f"n_{c}")]
    row = df.agg(*aggs).first()
    means, scale = {}, {}
    for c in cols:
        mu, sd, n = row[f"m_{c}"], row[f"s_{c}"], row[f"n_{c}"]
        means[c] = mu
        sd_imp = sd * (n / row["_rows"]) ** 0.5 if sd is not None and row["_rows"] else None
        scale[c] = (mu, sd_imp if sd_imp not in (None, 0.0) else 1.0)
    return means, scale


def standardize(df: DataFrame, cols: Sequence[str], stats: dict | None = None) -> DataFrame:
    """A4 apply: (x - mean) / std with population std, as scikit-learn's scaler."""
    stats = stats if stats is not None else fit_standardize(df, cols)
    return df.withColumns({c: (F.col(c).cast("double") - F.lit(stats[c][0])) / F.lit(stats[c][1])
                           for c in cols})


def latest_per_key(df: DataFrame, keys: Sequence[str], order_desc: Sequence[str]) -> DataFrame:
    """Newest record per key via ``row_number`` (Spark plans a WindowGroupLimit)."""
    w = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order_desc])
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def recent_windows(df: DataFrame, n: int, window_col: str = "window_start",
                   tie_breakers: Sequence[str] = ()) -> DataFrame:
    """The ``n`` newest metric windows (TakeOrderedAndProject: top-k per task, then merge)."""
    return df.orderBy(F.desc(window_col), *[F.asc(c) for c in tie_breakers]).limit(n)


def best_run(runs: DataFrame, metric: str, status_col: str = "status", finished: str = "FINISHED",
             id_col: str = "run_id", higher_is_better: bool = True) -> DataFrame:
    """Best finished run by metric (ties -> smallest run id)."""
    order = F.desc(metric) if higher_is_better else F.asc(metric)
    return runs.where((F.col(status_col) == finished) & F.col(metric).isNotNull()) \
        .orderBy(order, F.asc(id_col)).limit(1)


def sample_n(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """Fixed-size deterministic sample: the ``n`` rows with the smallest md5(key:seed).

    Same rows at any partitioning; a top-k, not a full sort.
    """
    h = key_hash32(key, f"sample:{seed}")
    return df.withColumn("_h", h).orderBy("_h", key).limit(n).drop("_h")
