"""Preprocessing, training, search, scoring and importance on Spark ML.

Fitting statistics are distributed aggregations whose results are bounded by the
schema (levels of a categorical column, one mean per numeric column) -- the same
shape as Spark ML's own estimators; applying them is a literal projection. Training
and scoring run in the JVM (``model.transform``); nothing is collected to pandas.
"""

from __future__ import annotations

import hashlib
import json
import math
import re
import time
from collections import Counter
from collections.abc import Callable, Mapping, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from featureflow.functions.columns import key_hash32
from featureflow.operators import aggregate as AG
from featureflow.operators import metrics as MT
from featureflow.operators.lookup import FeatureFunction, FeatureLookup, create_training_set

# Model input columns by kind.
BOOL_FEATURES = ("gender", "phone_service", "dependents", "senior_citizen", "paperless_billing", "partner")
NUM_FEATURES = ("monthly_charges", "total_charges", "avg_price_increase", "tenure", "num_optional_services")
CAT_FEATURES = ("contract", "device_protection", "internet_service", "multiple_lines", "online_backup",
                "online_security", "payment_method", "streaming_movies", "streaming_tv", "tech_support")
MAX_LEVELS = 10_000  # a categorical column with more levels is not one-hot material


def to_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Numeric columns -> double directly; anything else through text, errors -> null."""
    return df.withColumns({c: F.col(c).cast("double") if isinstance(df.schema[c].dataType, NumericType)
                           else F.col(c).cast("string").try_cast("double") for c in cols})


def _level_name(col: str, level: str) -> str:
    return f"{col}_{re.sub(r'[^0-9A-Za-z]+', '_', str(level)).strip('_').lower() or 'blank'}"


def indicator_names(levels: Mapping[str, Sequence[str]]) -> dict[tuple[str, str], str]:
    """Column name of each (column, level). A name that two levels would share, or that is a
    column's unknown indicator, gets the start of the md5 of column and level as a suffix."""
    plain = {(c, v): _level_name(c, v) for c, lv in levels.items() for v in lv}
    uses = Counter([*plain.values(), *[f"{c}_unknown" for c in levels]])
    return {(c, v): n if uses[n] == 1 else f"{n}_{hashlib.md5(f'{c}:{v}'.encode()).hexdigest()[:8]}"
            for (c, v), n in plain.items()}


def fit_levels(df: DataFrame, cols: Sequence[str]) -> dict[str, list[str]]:
    """Sorted distinct non-null levels per column (one distributed distinct).

    Bounded by ``MAX_LEVELS`` per column: more raises instead of collecting.
    """
    if not cols:
        return {}
    pairs = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v"))
                                          for c in cols])).alias("p")).select("p.c", "p.v")
    lv = pairs.where(F.col("v").isNotNull()).distinct()
    big = lv.groupBy("c").count().where(F.col("count") > MAX_LEVELS).limit(1).collect()
    if big:
        raise ValueError(f"column {big[0]['c']} has more than {MAX_LEVELS} levels")
    out: dict[str, list[str]] = {c: [] for c in cols}
    for r in lv.collect():
        out[r["c"]].append(r["v"])
    return {c: sorted(v) for c, v in out.items()}


def one_hot(df: DataFrame, levels: Mapping[str, Sequence[str]], drop_first: Sequence[str] = (),
            unknown_indicator: Sequence[str] = (), keep_input: bool = False) -> DataFrame:
    """L1: indicator columns (double 0/1).

    * ``drop_first`` columns: the first (sorted) level is dropped; unknown -> all zeros;
    * ``unknown_indicator`` columns: every level plus ``<col>_unknown`` for values
      (and nulls) not seen at fit time.
    """
    new, names = {}, indicator_names(levels)
    for c, lv in levels.items():
        v = F.col(c).cast("string")
        use = list(lv[1:]) if c in drop_first else list(lv)
        for level in use:
            new[names[c, level]] = F.coalesce((v == F.lit(level)).cast("double"), F.lit(0.0))
        if c in unknown_indicator:
            seen = v.isin(*lv) if lv else F.lit(False)
            new[f"{c}_unknown"] = F.when(v.isNull() | ~seen, 1.0).otherwise(0.0)
    out = df.withColumns(new)
    return out if keep_input else out.drop(*levels.keys())


@dataclass
class Preprocessor:
    """L2 fitted state: levels, means and (mean, population std) per column."""
    bool_cols: list[str]
    num_cols: list[str]
    cat_cols: list[str]
    levels: dict[str, list[str]] = field(default_factory=dict)
    means: dict[str, float | None] = field(default_factory=dict)
    scale: dict[str, tuple[float, float]] = field(default_factory=dict)

    def transform(self, df: DataFrame) -> DataFrame:
        out = to_numeric(df, self.num_cols)
        out = AG.impute_mean(out, self.num_cols, self.means)
        out = AG.standardize(out, self.num_cols, self.scale)
        out = one_hot(out, self.levels, drop_first=self.bool_cols, unknown_indicator=self.cat_cols)
        return out

    def feature_columns(self) -> list[str]:
        cols, names = list(self.num_cols), indicator_names(self.levels)
        for c in self.bool_cols:
            cols += [names[c, lv] for lv in self.levels.get(c, [])[1:]]
        for c in self.cat_cols:
            cols += [names[c, lv] for lv in self.levels.get(c, [])] + [f"{c}_unknown"]
        return cols

    def save(self, spark: SparkSession, path: str) -> None:
        """Write the fitted state (one line of JSON) to a folder that any Spark file system can hold."""
        spark.createDataFrame([(json.dumps(asdict(self)),)], "state string").write.mode("overwrite").text(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Preprocessor:
        state = json.loads(spark.read.text(path).first()[0])
        state["scale"] = {c: tuple(v) for c, v in state["scale"].items()}
        return cls(**state)


def preprocess_fit(train: DataFrame, bool_cols: Sequence[str], num_cols: Sequence[str],
                   cat_cols: Sequence[str]) -> Preprocessor:
    """L2: fit on the training rows only: numeric coercion, mean imputation,
    population standardisation, drop-first / indicator one-hot."""
    means, scale = AG.fit_impute_standardize(to_numeric(train, num_cols), num_cols)  # one pass
    levels = fit_levels(train, [*bool_cols, *cat_cols])
    return Preprocessor(list(bool_cols), list(num_cols), list(cat_cols), levels, means, scale)


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="keep").transform(df)


def train_gbt(train: DataFrame, val: DataFrame | None, features: Sequence[str], label: str = "label",
              params: Mapping[str, object] | None = None, seed: int = 42) -> PipelineModel:
    """L3: boosted trees with early stopping on the validation rows (validationIndicatorCol)."""
    p = {"maxIter": 50, "maxDepth": 4, "stepSize": 0.1, "subsamplingRate": 1.0, "maxBins": 32}
    p.update(params or {})
    data = train.withColumn("_is_val", F.lit(False))
    if val is not None:
        data = data.unionByName(val.withColumn("_is_val", F.lit(True)))
    gbt = GBTClassifier(labelCol=label, featuresCol="features", seed=seed, validationTol=0.01, **p)
    if val is not None:
        gbt = gbt.setValidationIndicatorCol("_is_val")
    pipe = Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep"), gbt])
    return pipe.fit(data.withColumn(label, F.col(label).cast("double")))


def positive_probability(scored: DataFrame, out: str = "score") -> DataFrame:
    return scored.withColumn(out, vector_to_array(F.col("probability"))[1])


def family(name: str, label: str, seed: int = 42, **params):
    if name == "logistic_regression":
        return LogisticRegression(labelCol=label, featuresCol="features", **params)
    if name == "random_forest":
        return RandomForestClassifier(labelCol=label, featuresCol="features", seed=seed, **params)
    if name == "gbt":
        return GBTClassifier(labelCol=label, featuresCol="features", seed=seed, **params)
    raise ValueError(name)


class HashDraws:
    """Draws of one trial: the n-th is the first 32 bits of md5(trial:n:seed), over 2^32."""

    def __init__(self, trial: int, seed: int):
        self.trial, self.seed, self.n = trial, seed, 0

    def random(self) -> float:
        h = hashlib.md5(f"{self.trial}:{self.n}:{self.seed}".encode()).hexdigest()
        self.n += 1
        return int(h[:8], 16) / 2**32

    def uniform(self, lo: float, hi: float) -> float:
        return lo + (hi - lo) * self.random()

    def choice(self, values: Sequence):
        return values[int(self.random() * len(values))]


def sample_space(space: Mapping[str, tuple], rng) -> dict[str, object]:
    """One point of a search space: ("uniform", lo, hi), ("loguniform", lo, hi), ("quniform", lo, hi, q), ("choice", [...])."""
    out = {}
    for k, spec in space.items():
        kind = spec[0]
        if kind == "uniform":
            out[k] = rng.uniform(spec[1], spec[2])
        elif kind == "loguniform":
            out[k] = math.exp(rng.uniform(math.log(spec[1]), math.log(spec[2])))
        elif kind == "quniform":
            out[k] = int(round(rng.uniform(spec[1], spec[2]) / spec[3]) * spec[3])
        elif kind == "choice":
            out[k] = rng.choice(list(spec[1]))
        else:
            raise ValueError(kind)
    return out


def random_search(space: Mapping[str, tuple], n_trials: int, objective: Callable[[dict], float],
                  seed: int = 42, parallelism: int = 1) -> list[dict]:
    """L4: seeded random search minimising ``objective``; each trial is a set of Spark
    jobs. Points depend on (seed, trial, dimension) alone, the same at any parallelism;
    ``parallelism`` > 1 runs trials from driver threads so their jobs share the
    cluster, as Spark ML's tuning estimators do."""
    points = [sample_space(space, HashDraws(i, seed)) for i in range(n_trials)]
    if parallelism > 1:
        from concurrent.futures import ThreadPoolExecutor
        with ThreadPoolExecutor(max_workers=parallelism) as pool:
            losses = list(pool.map(objective, points))
    else:
        losses = [objective(p) for p in points]
    trials = [{"trial": i, "loss": float(loss), "params": p} for i, (p, loss) in enumerate(zip(points, losses))]
    return sorted(trials, key=lambda t: (t["loss"], t["trial"]))


def bake_off(train: DataFrame, val: DataFrame, features: Sequence[str], label: str = "label",
             families: Sequence[str] = ("logistic_regression", "random_forest", "gbt"),
             seed: int = 42, budget_seconds: float | None = None) -> list[dict]:
    """Several model families under one validation metric (binary F1 of class 1), each with its
    model and its counts of validation rows. No family is started once ``budget_seconds`` have passed
    (the first always is); those left out are not in the result."""
    tr = assemble(train, features).withColumn(label, F.col(label).cast("double"))
    va = assemble(val, features).withColumn(label, F.col(label).cast("double"))
    out, start = [], time.monotonic()
    for name in families:
        if out and budget_seconds is not None and time.monotonic() - start >= budget_seconds:
            break
        model = family(name, label, seed).fit(tr)
        m = MT.binary_metrics(model.transform(va), label, "prediction", 1.0).first()
        out.append({"family": name, "f1": float(m["f1"]), "accuracy": float(m["accuracy"]), "model": model,
                    "rows": m["tp"] + m["fp"] + m["fn"] + m["tn"], "positives": m["tp"] + m["fn"]})
    return out


@dataclass
class ScoringModel:
    """A fitted preprocessing and the pipeline trained on its output, stored and loaded as one folder."""
    prepare: Preprocessor
    pipeline: PipelineModel

    def transform(self, df: DataFrame) -> DataFrame:
        return self.pipeline.transform(self.prepare.transform(df))

    def save(self, spark: SparkSession, path: str) -> None:
        self.pipeline.write().overwrite().save(f"{path}/pipeline")
        self.prepare.save(spark, f"{path}/prepare")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> ScoringModel:
        return cls(Preprocessor.load(spark, f"{path}/prepare"), PipelineModel.load(f"{path}/pipeline"))


def score_batch(df: DataFrame, model: PipelineModel | ScoringModel, keep: Sequence[str] | None = None,
                lookups: Sequence[FeatureLookup] = (), functions: Sequence[FeatureFunction] = (),
                texts: tuple[str, str] | None = None) -> DataFrame:
    """Predict, keeping every input column as it was, or those in ``keep`` (JVM-side, no collect).

    With ``lookups`` and ``functions`` the input needs only keys and times: features are looked up as
    of each row's time and on-demand features added, as in the training set (J4). ``texts`` names the
    prediction of class 0 and 1 ("No", "Yes"); without it the prediction is 0 or 1.
    """
    cols = list(keep) if keep is not None else df.columns
    rows = create_training_set(df, lookups, functions) if lookups or functions else df
    scored = positive_probability(model.transform(rows.withColumn("_in", F.struct(*cols))))
    cls = F.col("prediction").cast("int")
    shown = cls if texts is None else F.when(cls == 1, F.lit(texts[1])).when(cls == 0, F.lit(texts[0]))
    return scored.select("_in.*", "score", shown.alias("prediction"))


def linear_margin(weights: Mapping[str, float], bias: float = 0.0) -> Column:
    """bias + sum of weight x column; nulls count as zero."""
    z = F.lit(bias)
    for c, w in weights.items():
        z = z + F.lit(w) * F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    return z


def score_linear(df: DataFrame, weights: Mapping[str, float], bias: float = 0.0, threshold: float = 0.5) -> DataFrame:
    """L6 with fixed weights: logistic score as a native expression (SQL-checkable)."""
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-linear_margin(weights, bias)))
    return df.withColumns({"score": p, "prediction": (p > threshold).cast("int")})


@dataclass
class LinearModel:
    """``score_linear`` with its weights, where a fitted model is expected; ``margin`` adds a column of that name."""
    weights: Mapping[str, float]
    bias: float = 0.0
    threshold: float = 0.5
    margin: bool = False

    def transform(self, df: DataFrame) -> DataFrame:
        scored = score_linear(df, self.weights, self.bias, self.threshold)
        return scored.withColumn("margin", linear_margin(self.weights, self.bias)) if self.margin else scored


BUCKET_ROWS = 100_000  # rows that are permuted among themselves, about


def permuted(df: DataFrame, col: str, key: str, seed: int = 42, n_buckets: int | None = None) -> DataFrame:
    """Copy of ``df`` whose ``col`` is shuffled between rows, without a global sort.

    Rows are spread over buckets by md5(key:seed); inside each bucket, rows are put
    in md5 order and each row takes ``col`` from its successor (the last takes it from
    the first): a cyclic shift, so every value is kept exactly once. The bucket count
    follows the row count (``BUCKET_ROWS`` a bucket), not the session's settings.
    """
    if n_buckets is None:
        n_buckets = max(1, df.count() // BUCKET_ROWS)
    h = key_hash32(key, f"perm:{seed}")
    d = df.withColumns({"_h": h, "_pb": h % n_buckets})
    w = Window.partitionBy("_pb").orderBy("_h", key)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    is_last = F.row_number().over(w) == F.count(F.lit(1)).over(whole)
    shifted = F.when(is_last, F.first(F.col(col)).over(whole)).otherwise(F.lead(F.col(col)).over(w))
    return d.withColumn(col, shifted).drop("_h", "_pb")


def permutation_importance(df: DataFrame, model: PipelineModel | ScoringModel | LinearModel, cols: Sequence[str],
                           key: str, label: str = "label", seed: int = 42) -> list[dict]:
    """Drop in accuracy / F1 after shuffling each column of any type (one scoring job per column)."""
    def score(frame):
        m = MT.binary_metrics(model.transform(frame), label, "prediction", 1.0).first()
        return float(m["accuracy"]), float(m["f1"]), m["tp"] + m["fp"] + m["fn"] + m["tn"]
    base_acc, base_f1, rows = score(df)
    out = []
    for c in cols:
        acc, f1, _ = score(permuted(df, c, key, seed, max(1, rows // BUCKET_ROWS)))
        out.append({"column": c, "accuracy_drop": base_acc - acc, "f1_drop": base_f1 - f1})
    return out
