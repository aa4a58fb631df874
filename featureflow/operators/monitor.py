"""Time-window features, profiles, drift and metric-violation rules."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featureflow.functions.columns import round_metric
from featureflow.operators.clean import filter_metric_rows
from featureflow.operators.metrics import running_sums


def _flat_window(df: DataFrame, col: str = "window") -> DataFrame:
    return df.withColumns({"window_start": F.col(f"{col}.start"), "window_end": F.col(f"{col}.end")}).drop(col)


def window_features(df: DataFrame, keys: Sequence[str], ts: str, start: dt.datetime | None = None,
                    end: dt.datetime | None = None, length: str = "1 hour", slide: str | None = None,
                    aggs: Mapping[str, Column] | None = None) -> DataFrame:
    """A10: time-range filter, then sliding (``slide``) or tumbling windows per key.

    A row at time t belongs to every window [s, s + length) with s on the slide grid
    and s <= t < s + length (1 hour / 15 min -> 4 windows). The range filter is a
    plain predicate, so it reaches the Parquet scan.
    """
    c = F.col(ts)
    if start is not None:
        df = df.where(c >= F.lit(start).cast(df.schema[ts].dataType))
    if end is not None:
        df = df.where(c < F.lit(end).cast(df.schema[ts].dataType))
    w = F.window(c, length, slide) if slide else F.window(c, length)
    aggs = aggs or {"n_rows": F.count(F.lit(1))}
    out = df.groupBy(w.alias("window"), *keys).agg(*[v.alias(k) for k, v in aggs.items()])
    return _flat_window(out)


_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def interval_seconds(text: str) -> int:
    """'15 minutes' -> 900 (second / minute / hour / day / week units)."""
    n, unit = text.split()
    return int(n) * _UNIT_SECONDS[unit.lower().rstrip("s")]


def pane_window_features(df: DataFrame, keys: Sequence[str], ts: str, start: dt.datetime | None = None,
                         end: dt.datetime | None = None, length: str = "1 hour", slide: str = "15 minutes",
                         specs: Mapping[str, tuple[str, str | None]] | None = None) -> DataFrame:
    """A10 for decomposable aggregates, pre-aggregated per pane before the windows.

    ``specs``: name -> (``count`` | ``sum`` | ``avg`` | ``min`` | ``max``, column or None).
    Rows are first reduced to one row per (key, slide-sized pane) -- a partial
    aggregation, so a hot key is reduced map-side -- and only those pane rows are
    copied into the ``length / slide`` windows that contain them, then combined.
    Same windows and values as ``window_features`` with the matching aggregates,
    while the sliding expansion touches panes instead of raw rows.
    """
    length_s, slide_s = interval_seconds(length), interval_seconds(slide)
    if length_s % slide_s:
        raise ValueError("window length must be a multiple of the slide")
    n = length_s // slide_s
    specs = dict(specs or {"n_rows": ("count", None)})
    c = F.col(ts)
    if start is not None:
        df = df.where(c >= F.lit(start).cast(df.schema[ts].dataType))
    if end is not None:
        df = df.where(c < F.lit(end).cast(df.schema[ts].dataType))
    partial, combine = [], {}
    for name, (fn, col) in specs.items():
        x = F.col(col) if col else F.lit(1)
        if fn == "count":
            partial.append(F.count(x).alias(f"_c_{name}"))
            combine[name] = F.sum(f"_c_{name}")
        elif fn == "sum":
            partial.append(F.sum(x).alias(f"_s_{name}"))
            combine[name] = F.sum(f"_s_{name}")
        elif fn == "avg":
            partial += [F.sum(x).alias(f"_s_{name}"), F.count(x).alias(f"_c_{name}")]
            combine[name] = F.sum(f"_s_{name}") / F.sum(f"_c_{name}")
        elif fn in ("min", "max"):
            partial.append(getattr(F, fn)(x).alias(f"_m_{name}"))
            combine[name] = getattr(F, fn)(f"_m_{name}")
        else:
            raise ValueError(f"not decomposable: {fn}")
    panes = df.groupBy(*keys, F.window(c, slide).start.alias("_p")).agg(*partial)
    spread = panes.withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    spread = spread.withColumn("window_start", F.expr(f"timestampadd(SECOND, -_k * {slide_s}, _p)"))
    out = spread.groupBy(*keys, "window_start").agg(*[v.alias(k) for k, v in combine.items()])
    return out.withColumn("window_end", F.expr(f"timestampadd(SECOND, {length_s}, window_start)"))


def profile_metrics(df: DataFrame, ts: str, granularity: str, columns: Sequence[str],
                    model_col: str | None = None, slice_cols: Sequence[str] = (),
                    table_metrics: Mapping[str, Column] | None = None, log_type: str = "INPUT",
                    digits: int = 6, exact_distinct: bool = True,
                    quality: Mapping[str, tuple[str, str, str]] | None = None) -> DataFrame:
    """Per window x model x slice x column: count, nulls, mean, std, min, max, distinct.

    * one ``:table`` row per window x model x slice with the row count and the
      mean of each ``table_metrics`` per-row expression (e.g. a squared error) and each
      ``quality`` metric, name -> (``rmse`` | ``precision`` | ``recall`` | ``f1``, prediction,
      label); classes are 1 or not, and rows without label or prediction have no squared error;
    * ``model_id = '*'`` rows aggregate all models (grouping sets, one pass);
    * slices: ``slice_key`` null = whole data, else one row per slice value.
    Columns are unpivoted with one ``explode`` (numeric columns cast to double).
    ``exact_distinct=False`` swaps the exact distinct count (an extra aggregation
    level per grouping set) for HyperLogLog++ sketches merged map-side.
    Moments are rounded half-up to ``digits`` decimals (default 6); means are taken
    from the rounded sum, so they do not depend on the summation order.
    """
    table_metrics, quality = dict(table_metrics or {}), dict(quality or {})
    model = F.col(model_col).cast("string") if model_col else F.lit(None).cast("string")
    slices = [F.struct(F.lit(None).cast("string").alias("k"), F.lit(None).cast("string").alias("v"))] + [
        F.struct(F.lit(s).alias("k"), F.col(s).cast("string").alias("v")) for s in slice_cols]
    base = df.select(F.window(F.col(ts), granularity).alias("window"), model.alias("_model"),
                     F.explode(F.array(*slices)).alias("_s"),
                     *[F.col(c).cast("double").alias(f"_c_{c}") for c in columns],
                     *[v.alias(f"_tm_{k}") for k, v in table_metrics.items()],
                     *[v.alias(f"_q_{k}_{n}") for k, q in quality.items() for n, v in _quality_rows(*q).items()])
    base = base.select("window", "_model", F.col("_s.k").alias("slice_key"), F.col("_s.v").alias("slice_value"),
                       *[c for c in base.columns if c not in ("window", "_model", "_s")])
    keys = ["window", "slice_key", "slice_value"]

    # column rows: unpivot then aggregate
    cols_unp = base.select(*keys, "_model", F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"_c_{c}").alias("x")) for c in columns])).alias("_u"))
    cols_unp = cols_unp.select(*keys, "_model", "_u.column_name", "_u.x")
    col_aggs = [F.count(F.lit(1)).alias("count"), F.count_if(F.col("x").isNull()).alias("num_nulls"),
                _mean(F.col("x"), digits).alias("mean"),
                round_metric(F.stddev_samp("x"), digits).alias("stddev"),
                F.min("x").alias("min"), F.max("x").alias("max"),
                (F.count_distinct("x") if exact_distinct else F.approx_count_distinct("x")).alias("num_distinct")]
    per_col = _with_all_models(cols_unp, [*keys, "column_name"], col_aggs)
    # table rows: row count + per-row metric inputs averaged (e.g. squared error -> MSE)
    t_aggs = [F.count(F.lit(1)).alias("count")] + [_mean(F.col(f"_tm_{k}"), digits).alias(k)
                                                   for k in table_metrics]
    t_aggs += [_quality_agg(q[0], f"_q_{k}_", digits).alias(k) for k, q in quality.items()]
    per_table = _with_all_models(base, keys, t_aggs).withColumn("column_name", F.lit(":table"))
    out = per_col.unionByName(per_table, allowMissingColumns=True)
    out = _flat_window(out).withColumn("log_type", F.lit(log_type))
    return out


def _mean(x: Column, digits: int) -> Column:
    """Mean from the sum rounded to ``digits`` decimals: the sum of the same values
    gives the same rounded sum in any summation order, so the mean no longer
    depends on how partial aggregates were merged."""
    return round_metric(round_metric(F.sum(x), digits) / F.count(x), digits)


def _quality_rows(kind: str, pred: str, label: str) -> dict[str, Column]:
    """What one row adds to a quality metric."""
    if kind == "rmse":
        return {"se": (F.col(pred) - F.col(label)).cast("double") ** 2}
    if kind not in ("precision", "recall", "f1"):
        raise ValueError(f"unknown quality metric {kind}")
    said, real = (F.coalesce(F.col(c).cast("int") == 1, F.lit(False)) for c in (pred, label))
    return {"tp": said & real, "fp": said & ~real, "fn": ~said & real}


def _quality_agg(kind: str, prefix: str, digits: int) -> Column:
    if kind == "rmse":
        return round_metric(F.sqrt(_mean(F.col(prefix + "se"), digits)), digits)
    tp, fp, fn = (F.count_if(F.col(prefix + n)) for n in ("tp", "fp", "fn"))
    top = 2 * tp if kind == "f1" else tp
    under = {"precision": tp + fp, "recall": tp + fn, "f1": 2 * tp + fp + fn}[kind]
    return round_metric(F.when(under == 0, 0.0).otherwise(top / under), digits)


def _with_all_models(df: DataFrame, keys: Sequence[str], aggs: list[Column]) -> DataFrame:
    """Aggregate per model and over all models ('*') in one grouping-sets pass."""
    g = df.groupingSets([[*keys, "_model"], list(keys)], *keys, "_model").agg(
        *aggs, F.grouping("_model").alias("_all"))
    return g.withColumn("model_id", F.when(F.col("_all") == 1, F.lit("*")).otherwise(F.col("_model"))) \
        .drop("_model", "_all")


def drift_categorical(base: DataFrame, current: DataFrame, col: str, eps: float = 1e-4,
                      digits: int = 4) -> DataFrame:
    """PSI, Jensen-Shannon divergence (log base 2) and chi-square of one category column.

    Shares below ``eps`` are floored at ``eps`` for PSI (no infinite terms).
    """
    b = base.groupBy(F.col(col).cast("string").alias("v")).agg(F.count(F.lit(1)).alias("nb"))
    c = current.groupBy(F.col(col).cast("string").alias("v")).agg(F.count(F.lit(1)).alias("nc"))
    c = c.withColumnRenamed("v", "_v")  # a null category is a category and matches itself
    j = b.join(c, F.col("v").eqNullSafe(F.col("_v")), "full_outer").fillna(0, ["nb", "nc"])
    tot = j.agg(F.struct(F.sum("nb").alias("b"), F.sum("nc").alias("c"))).scalar()
    j = j.withColumns({"_tb": tot["b"], "_tc": tot["c"]})
    return j.groupBy().agg(F.lit(col).alias("column_name"), *_category_aggs(eps, digits))


def _category_aggs(eps: float, digits: int) -> list[Column]:
    """PSI, Jensen-Shannon and chi-square over rows of counts (nb, nc) and totals (_tb, _tc)."""
    pb = F.col("nb") / F.col("_tb")
    pc = F.col("nc") / F.col("_tc")
    pbe, pce = F.greatest(pb, F.lit(eps)), F.greatest(pc, F.lit(eps))
    m = (pb + pc) / 2
    kl = lambda p: F.when(p > 0, p * F.log2(p / m)).otherwise(0.0)
    expected = pb * F.col("_tc")
    chi = F.when(expected > 0, (F.col("nc") - expected) ** 2 / expected).otherwise(0.0)
    return [
        round_metric(F.sum((pce - pbe) * F.log(pce / pbe)), digits).alias("psi"),
        round_metric(F.sum(kl(pb) + kl(pc)) / 2, digits).alias("js_divergence"),
        round_metric(F.sum(chi), digits).alias("chi_square"),
    ]


def drift_ks(base: DataFrame, current: DataFrame, col: str, digits: int = 4) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov statistic max |F_base(x) - F_cur(x)|.

    Values are reduced to distinct (value, n_base, n_cur) first; the empirical CDFs
    come from the bucketed running sums (no single-task window).
    """
    u = (base.select(F.col(col).cast("double").alias("x"), F.lit(1).alias("ib"), F.lit(0).alias("ic"))
         .unionByName(current.select(F.col(col).cast("double").alias("x"), F.lit(0).alias("ib"), F.lit(1).alias("ic")))
         .where(F.col("x").isNotNull()))
    g = u.groupBy("x").agg(F.sum("ib").alias("nb"), F.sum("ic").alias("nc"))
    rs = running_sums(g, [], "x", ["nb", "nc"])
    tot = g.agg(F.struct(F.sum("nb").alias("b"), F.sum("nc").alias("c"))).scalar()
    j = rs.withColumns({"_tb": tot["b"], "_tc": tot["c"]})
    d = F.abs(F.col("cum_nb") / F.col("_tb") - F.col("cum_nc") / F.col("_tc"))
    return j.groupBy().agg(F.lit(col).alias("column_name"), round_metric(F.max(d), digits).alias("ks"))


def metric_violated(profile: DataFrame, metric: str, threshold: float, n_eval: int = 5,
                    n_violate: int = 2, window_col: str = "window_start", **row_filter) -> DataFrame:
    """M1: 1 iff at least ``n_violate`` of the newest ``n_eval`` windows exceed the
    threshold *and* the newest one does; else 0. A null metric is not a violation;
    no rows -> 0. Ties on the window are broken by model_id.

    One top-k (TakeOrderedAndProject) then one aggregate over at most ``n_eval`` rows.
    """
    recent = filter_metric_rows(profile, **row_filter).orderBy(F.desc(window_col), F.asc("model_id")).limit(n_eval)
    ranked = recent.withColumn("_rn", F.row_number().over(
        Window.partitionBy(F.lit(0)).orderBy(F.desc(window_col), F.asc("model_id"))))
    agg = ranked.groupBy().agg(
        F.count_if(F.col(metric) > F.lit(threshold)).alias("_nv"),
        F.max(F.when(F.col("_rn") == 1, F.col(metric) > F.lit(threshold))).alias("_newest"))
    res = F.when((F.col("_nv") >= n_violate) & F.coalesce(F.col("_newest"), F.lit(False)), 1).otherwise(0)
    return agg.select(res.alias("query_result"))


def violations_by(profile: DataFrame, group_cols: Sequence[str], metric: str, threshold: float,
                  n_eval: int = 5, n_violate: int = 2, window_col: str = "window_start",
                  filter_rows: bool = True, **row_filter) -> DataFrame:
    """M2: M1 per group (e.g. per model) in one pass.

    ``row_number`` per group with a ``<= n_eval`` filter is planned as a
    WindowGroupLimit: each task keeps only its top ``n_eval`` rows per group before
    the shuffle, so a hot group never ships all of its rows.
    """
    df = filter_metric_rows(profile, **row_filter) if filter_rows else profile
    w = Window.partitionBy(*group_cols).orderBy(F.desc(window_col))
    top = df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n_eval)
    agg = top.groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias("n_windows"),
        F.count_if(F.col(metric) > F.lit(threshold)).alias("n_violations"),
        F.max(F.when(F.col("_rn") == 1, F.col(metric) > F.lit(threshold))).alias("_newest"))
    res = F.when((F.col("n_violations") >= n_violate) & F.coalesce(F.col("_newest"), F.lit(False)), 1).otherwise(0)
    return agg.select(*group_cols, "n_windows", "n_violations", res.alias("violated"))


def _side_counts(base: DataFrame, current: DataFrame, cols: Sequence[str], kind: str) -> DataFrame:
    """(column_name, v, nb, nc): how often each value stands in each column on either side; a null
    is a value. Every side is scanned once for all columns."""
    def side(df, b, c):
        cells = F.explode(F.array(*[F.struct(F.lit(n).alias("column_name"), F.col(n).cast(kind).alias("v")) for n in cols]))
        return df.select(cells.alias("u")).select("u.*", F.lit(b).alias("ib"), F.lit(c).alias("ic"))
    u = side(base, 1, 0).unionByName(side(current, 0, 1))
    return u.groupBy("column_name", "v").agg(F.sum("ib").alias("nb"), F.sum("ic").alias("nc"))


def drift_metrics(base: DataFrame, current: DataFrame, cols: Sequence[str], digits: int = 4, eps: float = 1e-4) -> DataFrame:
    """A12 over several columns, long format (column_name, metric, value): text and
    boolean columns get PSI / Jensen-Shannon / chi-square, numeric columns KS. One pass a kind,
    however many columns; columns of two empty tables have no rows."""
    from pyspark.sql.types import NumericType
    numeric = [c for c in cols if isinstance(base.schema[c].dataType, NumericType)]
    other = [c for c in cols if c not in numeric]
    parts = []

    def with_totals(rows, counts):
        return rows.join(counts.groupBy("column_name").agg(F.sum("nb").alias("_tb"), F.sum("nc").alias("_tc")), "column_name")
    if other:
        g = _side_counts(base, current, other, "string")
        d = with_totals(g, g).groupBy("column_name").agg(*_category_aggs(eps, digits))
        parts.append(d.select("column_name", F.explode(F.array(*[
            F.struct(F.lit(m).alias("metric"), F.col(m).alias("value"))
            for m in ("psi", "js_divergence", "chi_square")])).alias("m")).select("column_name", "m.*"))
    if numeric:
        g = _side_counts(base, current, numeric, "double").where(F.col("v").isNotNull()).withColumnRenamed("v", "x")
        gap = F.abs(F.col("cum_nb") / F.col("_tb") - F.col("cum_nc") / F.col("_tc"))
        d = with_totals(running_sums(g, ["column_name"], "x", ["nb", "nc"]), g).groupBy("column_name").agg(F.max(gap).alias("ks"))
        parts.append(d.select("column_name", F.lit("ks").alias("metric"), round_metric(F.col("ks"), digits).alias("value")))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def write_profile(profile: DataFrame, path: str, mode: str = "append") -> None:
    """Store profile rows partitioned by window date, so monitors that read recent
    windows prune partitions at the scan instead of reading the whole history."""
    (profile.withColumn("window_date", F.to_date("window_start")).write.mode(mode)
     .partitionBy("window_date").parquet(path))


def read_profile(spark, path: str, since: dt.date | None = None) -> DataFrame:
    """Profile rows, optionally only windows on or after ``since`` (a partition filter)."""
    df = spark.read.parquet(path)
    if since is not None:
        df = df.where(F.col("window_date") >= F.lit(since))
    return df.drop("window_date")
