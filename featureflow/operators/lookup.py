"""Joins and point-in-time lookups.

The as-of lookup is the one operator Spark lacks. It is written as a union of the
two sides plus a running ``last(..., ignorenulls)`` window -- one shuffle of the
rows, no theta join, label rows never multiply; several feature frames on the same
key share the pass. To keep a hot key (one entity with a third of all rows) from
landing in one task, rows are partitioned by (key, time bucket) and each bucket receives
the newest feature row of all earlier buckets, computed from a per-bucket pre-aggregate
whose size is bounded by the number of buckets, not by the number of rows. The plan is
the same at every size and planning runs no job.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

_RUNNING = (Window.unboundedPreceding, Window.currentRow)


def join_exact(labels: DataFrame, features: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on the full key; AQE picks broadcast or sort-merge at run time."""
    return labels.join(features, list(keys), how)


def attach_labels(scored: DataFrame, labels: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Predictions with late-arriving truth; unlabeled rows are kept."""
    return scored.join(labels, list(keys), "left")


_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}
DEFAULT_BUCKET = "30 days"


def _bucket(ts: Column, bucket: str) -> Column:
    """Number of the time bucket that holds ``ts``; null for a null time, so its row is kept."""
    n, unit = bucket.split()
    width = int(n) * _UNIT_SECONDS[unit.rstrip("s")] * 1_000_000
    us = F.unix_micros(ts.cast("timestamp"))
    return ((us - F.pmod(us, F.lit(width))) / F.lit(width)).cast("bigint")


@dataclass
class AsofSide:
    """One feature frame of a multi-lookup as-of pass."""
    features: DataFrame
    feature_ts: str
    feature_cols: Sequence[str] | None = None
    tie_breakers: Sequence[str] = ()
    max_age: str | None = None


def lookup_asof(labels: DataFrame, features: DataFrame, keys: Sequence[str], label_ts: str,
                feature_ts: str | None = None, feature_cols: Sequence[str] | None = None,
                tie_breakers: Sequence[str] = (), max_age: str | None = None,
                bucket: str | None = DEFAULT_BUCKET) -> DataFrame:
    """Each label row gets the newest feature row with feature_ts <= label_ts.

    * ``keys`` exist under the same names on both sides.
    * Ties on the feature time are broken by ``tie_breakers`` (largest wins).
    * No earlier feature -> null feature columns; label rows are never duplicated
      or dropped; a null label time or key gets null features.
    * ``max_age`` (an interval string such as ``'30 days'``): older matches -> nulls.
    * ``bucket``: time-bucket width that splits each key's rows over tasks ("30 days",
      "6 hours", ...); choose it so that the hottest key's densest bucket fits a task.
      ``None`` uses one window partition per key (fine when keys are not skewed).
      Every choice gives the same rows.
    """
    side = AsofSide(features, feature_ts or label_ts, feature_cols, tie_breakers, max_age)
    return lookup_asof_many(labels, [side], keys, label_ts, bucket)


def lookup_asof_many(labels: DataFrame, sides: Sequence[AsofSide], keys: Sequence[str], label_ts: str,
                     bucket: str | None = DEFAULT_BUCKET) -> DataFrame:
    """Several as-of lookups on the same key and label time in ONE pass: the label
    rows and every feature frame are unioned and shuffled once, and one window
    carries each frame's newest row forward (``last(_fv<i>, ignorenulls)``), so N
    lookups cost one shuffle of the labels instead of N. Semantics per side as in
    ``lookup_asof``."""
    keys = list(keys)
    label_cols = labels.columns
    taken = set(label_cols)
    lab = labels.select(*[F.col(k) for k in keys], F.col(label_ts).alias("_ts"),
                        F.lit(1).alias("_side"), F.struct(*label_cols).alias("_l"))
    feats, outs = [], []
    for i, sd in enumerate(sides):
        excluded = set(keys) | {sd.feature_ts}
        cols = list(sd.feature_cols) if sd.feature_cols is not None else [c for c in sd.features.columns
                                                                          if c not in excluded]
        clash = [c for c in cols if c in taken]
        if clash:
            raise ValueError(f"feature columns clash with label or earlier feature columns: {clash}")
        taken |= set(cols)
        fv = F.struct(F.col(sd.feature_ts).alias("fts"),
                      *[F.col(t).alias(f"_t{n}") for n, t in enumerate(sd.tie_breakers)],
                      F.struct(*cols).alias("f"))
        valid = F.col(sd.feature_ts).isNotNull()
        for k in keys:
            valid = valid & F.col(k).isNotNull()  # null keys never match, as in SQL
        feats.append(sd.features.where(valid).select(*[F.col(k) for k in keys], F.col(sd.feature_ts).alias("_ts"),
                                                     F.lit(0).alias("_side"), fv.alias(f"_fv{i}")))
        outs.append((i, cols, sd.max_age))
    fvs = [f"_fv{i}" for i, _, _ in outs]

    def union(frames):
        out = frames[0]
        for f in frames[1:]:
            out = out.unionByName(f, allowMissingColumns=True)
        return out

    if bucket is None:
        allr = union([lab, *feats])
        w = Window.partitionBy(*keys).orderBy("_ts", "_side", *fvs).rowsBetween(*_RUNNING)
    else:
        lab = lab.withColumn("_b", _bucket(F.col("_ts"), bucket))
        feats = [f.withColumn("_b", _bucket(F.col("_ts"), bucket)) for f in feats]
        # Phase A: newest feature row per (key, bucket) and side -- partial aggregation, bounded output.
        fbs = [f.groupBy(*keys, "_b").agg(F.max(v).alias(f"_last{v}")).withColumn("_k", F.lit(1))
               for f, v in zip(feats, fvs)]
        # Phase B: for each label bucket, newest feature row of all *earlier* buckets, per side.
        lb = lab.select(*keys, "_b").distinct().withColumn("_k", F.lit(0))
        wb = Window.partitionBy(*keys).orderBy("_b", "_k").rowsBetween(*_RUNNING)
        carry = (union([lb, *fbs])
                 .withColumns({v: F.last(f"_last{v}", ignorenulls=True).over(wb) for v in fvs})
                 .where(F.col("_k") == 0)
                 .select(*keys, "_b", *fvs, F.lit(-1).alias("_side")))
        # Phase C: exact as-of inside each (key, bucket), seeded by the carried rows.
        allr = union([lab, *feats, carry])
        w = Window.partitionBy(*keys, "_b").orderBy(
            F.when(F.col("_side") == -1, 0).otherwise(1), "_ts", "_side", *fvs).rowsBetween(*_RUNNING)
    res = allr.withColumns({f"_m{i}": F.last(v, ignorenulls=True).over(w) for (i, _, _), v in zip(outs, fvs)})
    res = res.where(F.col("_side") == 1)
    for i, _, max_age in outs:
        if max_age is not None:
            m = F.col(f"_m{i}")
            too_old = F.col("_ts") > m["fts"] + F.expr(f"INTERVAL {max_age}")
            res = res.withColumn(f"_m{i}", F.when(~too_old, m))
    return res.select(*[F.col(f"_l.{c}").alias(c) for c in label_cols],
                      *[F.col(f"_m{i}.f.{c}").alias(c) for i, cols, _ in outs for c in cols])


def latest_snapshot(df: DataFrame, keys: Sequence[str], ts: str, tie_breakers: Sequence[str] = ()) -> DataFrame:
    """Newest row per key (what an online store would serve).

    Ranked per key with ``row_number = 1``, which Spark turns into a group limit before
    the shuffle: a hot key is reduced to one row in every task first. Rows whose time is
    null come last; ties beyond ``tie_breakers`` go to the largest remaining columns.
    """
    keys = list(keys)
    others = [c for c in df.columns if c not in keys]
    rest = [c for c in others if c not in (ts, *tie_breakers) and not isinstance(df.schema[c].dataType, MapType)]
    order = [F.desc_nulls_last(c) for c in (ts, *tie_breakers, *rest)]
    ranked = df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where("_rn = 1").select(*keys, *others)


def lookup_latest(df: DataFrame, features: DataFrame, keys: Sequence[str], ts: str | None = None,
                  feature_cols: Sequence[str] | None = None, tie_breakers: Sequence[str] = ()) -> DataFrame:
    """Left equi lookup without time -- the newest feature row per key."""
    keys = list(keys)
    snap = latest_snapshot(features, keys, ts, tie_breakers) if ts else features
    cols = list(feature_cols) if feature_cols is not None else [c for c in snap.columns
                                                                if c not in keys and c != ts]
    return df.join(snap.select(*keys, *cols), keys, "left")


@dataclass
class FeatureLookup:
    """Which feature table to look up, on which key and time column (U4)."""
    table: DataFrame
    lookup_key: Sequence[str]
    timestamp_lookup_key: str | None = None
    feature_ts: str | None = None
    feature_names: Sequence[str] | None = None
    rename: Mapping[str, str] = field(default_factory=dict)
    tie_breakers: Sequence[str] = ()
    max_age: str | None = None


@dataclass
class FeatureFunction:
    """On-demand feature: a Column builder bound to input columns (U4)."""
    fn: Callable[..., Column]
    input_bindings: Mapping[str, str]
    output_name: str

    def column(self) -> Column:
        return self.fn(**{arg: F.col(col) for arg, col in self.input_bindings.items()})


_FEATURES: dict[str, FeatureFunction] = {}


def register_feature(name: str, fn: Callable[..., Column], inputs: Mapping[str, str],
                     output: str | None = None) -> FeatureFunction:
    """U4: name an on-demand feature (Column builder + input binding) for reuse in
    training sets and scoring."""
    f = FeatureFunction(fn, dict(inputs), output or name)
    _FEATURES[name] = f
    return f


def feature_function(name: str, **rebind: str) -> FeatureFunction:
    """A registered feature, optionally with inputs bound to other columns."""
    f = _FEATURES[name]
    return FeatureFunction(f.fn, {**f.input_bindings, **rebind}, f.output_name)


def create_training_set(labels: DataFrame, lookups: Sequence[FeatureLookup] = (),
                        functions: Sequence[FeatureFunction] = (), label: str | None = None,
                        exclude_columns: Sequence[str] = (), bucket: str | None = DEFAULT_BUCKET) -> DataFrame:
    """Labels + point-in-time features + on-demand features - excluded columns (lazy).

    Consecutive as-of lookups on the same key and label time share one pass
    (``lookup_asof_many``): one shuffle of the label rows for all of them.
    """
    df = labels
    pending: list[AsofSide] = []
    pending_on: tuple | None = None

    def flush(frame):
        if not pending:
            return frame
        keys, ts = pending_on
        out = lookup_asof_many(frame, list(pending), list(keys), ts, bucket)
        pending.clear()
        return out

    for lk in lookups:
        t = lk.table
        names = list(lk.feature_names) if lk.feature_names is not None else None
        if lk.rename:
            t = t.withColumnsRenamed(dict(lk.rename))
            if names is not None:
                names = [lk.rename.get(n, n) for n in names]
        if lk.timestamp_lookup_key is None:
            df = flush(df)
            df = lookup_latest(df, t, lk.lookup_key, lk.feature_ts, names, lk.tie_breakers)
            continue
        on = (tuple(lk.lookup_key), lk.timestamp_lookup_key)
        if pending and on != pending_on:
            df = flush(df)
        pending_on = on
        pending.append(AsofSide(t, lk.feature_ts or lk.timestamp_lookup_key, names, lk.tie_breakers, lk.max_age))
    df = flush(df)
    if functions:
        df = df.withColumns({f.output_name: f.column() for f in functions})
    drop = [c for c in exclude_columns if c != label]
    return df.drop(*drop)
