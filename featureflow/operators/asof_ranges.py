"""J2 / W2 without a bucket to choose: as-of lookup over range partitions with a two-level prefix scan.

Label and feature rows together are range-partitioned by (key, time), so a partition holds a fair share of all rows however
they are spread: a key with a third of the rows, all within an hour, takes a third of the partitions. Rows of one key and
time are told apart by a hash, so even those can part. Level one takes the newest feature row of each (key, partition), one
small row each; level two carries it into the key's later partitions. Inside a partition a running window then finds each
label's newest feature row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from featureflow.session import materialize

PARTS_PER_SHUFFLE_PARTITION = 2
_RUNNING = (Window.unboundedPreceding, Window.currentRow)


def ranged_rows(labels: DataFrame, features: DataFrame, keys: Sequence[str], label_ts: str, feature_ts: str, feature_cols: Sequence[str],
                tie_breakers: Sequence[str], parts: int) -> DataFrame:
    """Both sides as rows (k, t, side, salt, l, f, part): features before labels at equal times; part numbers the range."""
    key = F.struct(*[F.col(k) for k in keys]).alias("k")
    lab = labels.select(key, F.col(label_ts).alias("t"), F.lit(1).alias("side"), F.struct(*labels.columns).alias("l"))
    lab = lab.withColumn("salt", F.xxhash64("l"))
    valid = F.col(feature_ts).isNotNull()
    for k in keys:
        valid = valid & F.col(k).isNotNull()  # null keys never match, as in SQL
    found = F.struct(F.col(feature_ts).alias("t"), F.struct(*[F.col(x).alias(f"x{i}") for i, x in enumerate(tie_breakers)] or [F.lit(0).alias("x")]).alias("tie"),
                     F.struct(*feature_cols).alias("f"))
    fea = features.where(valid).select(key, F.col(feature_ts).alias("t"), F.lit(0).alias("side"), F.lit(0).cast("long").alias("salt"), found.alias("f"))
    rows = lab.unionByName(fea, allowMissingColumns=True).repartitionByRange(parts, "k", "t", "side", "salt")
    return materialize(rows.withColumn("part", F.spark_partition_id()))  # the numbers must not change when a task runs again


def lookup_asof_ranges(labels: DataFrame, features: DataFrame, keys: Sequence[str], label_ts: str, feature_ts: str | None = None,
                       feature_cols: Sequence[str] | None = None, tie_breakers: Sequence[str] = (), max_age: str | None = None,
                       parts: int | None = None) -> DataFrame:
    """The rows of ``lookup_asof``: each label with the newest feature row whose time isn't after its own.

    Nothing has to be known about the data. Ties on the feature time go to the largest ``tie_breakers``, then the largest
    row; labels without a match, a key or a time get null features and none is lost or doubled; features older than
    ``max_age`` count as null. ``parts``: ranges, by default two a shuffle partition. The ranged rows are checkpointed.
    """
    feature_ts = feature_ts or label_ts
    cols = list(feature_cols) if feature_cols is not None else [c for c in features.columns if c not in {*keys, feature_ts}]
    clash = [c for c in cols if c in labels.columns]
    if clash:
        raise ValueError(f"feature columns clash with label columns: {clash}")
    n = parts or PARTS_PER_SHUFFLE_PARTITION * int(labels.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = ranged_rows(labels, features, keys, label_ts, feature_ts, cols, tie_breakers, n)
    newest = rows.groupBy("k", "part").agg(F.max("f").alias("f"))  # one row a key and range that it is in
    before = Window.partitionBy("k").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = newest.withColumn("f", F.last("f", ignorenulls=True).over(before)).where(F.col("f").isNotNull())
    every = rows.unionByName(carried.withColumn("side", F.lit(-1)), allowMissingColumns=True)
    every = every.repartitionByRange(n, "part")  # a task is a range again; the window below needs no other exchange
    seeded = F.when(F.col("side") == -1, 0).otherwise(1)
    running = Window.partitionBy("part", "k").orderBy(seeded, "t", "side", "f").rowsBetween(*_RUNNING)
    res = every.withColumn("m", F.last("f", ignorenulls=True).over(running)).where("side = 1")
    m = F.when(F.col("t").isNotNull(), F.col("m"))
    if max_age is not None:
        m = F.when(~(F.col("t") > F.col("m")["t"] + F.expr(f"INTERVAL {max_age}")), m)
    res = res.withColumn("m", m)
    return res.select(*[F.col("l")[c].alias(c) for c in labels.columns], *[F.col("m")["f"][c].alias(c) for c in cols])
