"""As-of lookups over ranges against the bucketed form and its definition; the streaming form against the batch form."""
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from featureflow.operators import asof_ranges as AR
from featureflow.operators.lookup import lookup_asof
from featureflow.session import scratch_path
from featureflow.streaming import asof as SA
from featureflow.streaming import streams as ST

rng = random.Random(9)
T0 = dt.datetime(2024, 1, 1)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def data(spark, n, keys, seconds):
    at = lambda: None if rng.random() < .03 else T0 + dt.timedelta(seconds=rng.randrange(seconds))
    key = lambda: None if rng.random() < .03 else rng.choice(keys)
    labels = [(i, key(), at()) for i in range(n)]
    features = [(key(), at(), i, rng.random()) for i in range(n)]
    return (spark.createDataFrame(labels + labels[:3], "id bigint, k string, ts timestamp_ntz").withColumns({x: F.lit(x) for x in ("t", "side", "l", "f", "part", "m")}),
            spark.createDataFrame(features, "k string, fts timestamp_ntz, no bigint, v double"))


def test_ranges_equal_buckets(spark):
    for keys, seconds in ((["a", "b", "c"], 200), ([f"k{i}" for i in range(40)], 10**7)):
        labels, features = data(spark, 400, keys, seconds)
        for age in (None, "30 seconds"):
            want = lookup_asof(labels.drop("f"), features, ["k"], "ts", "fts", ["no", "v"], ["no"], age)
            got = AR.lookup_asof_ranges(labels, features, ["k"], "ts", "fts", ["no", "v"], ["no"], age, parts=7)
            assert rows(got.drop("f")) == rows(want)
    assert AR.lookup_asof_ranges(labels.limit(0), features, ["k"], "ts", "fts", ["v"]).count() == 0
    assert AR.lookup_asof_ranges(labels, features.limit(0), ["k"], "ts", "fts", ["v"]).where("v is not null").count() == 0


def test_hot_key_within_an_hour_is_spread(spark):
    n = 40_000
    hot = F.col("id") % 3 == 0
    at = F.lit(T0) + F.make_dt_interval(secs=F.when(hot, F.col("id") % 5).otherwise(F.col("id") % 3600))
    labels = spark.range(n).select("id", F.when(hot, 0).otherwise(F.col("id") % 500).alias("k"), at.cast("timestamp_ntz").alias("ts"))
    features = labels.select("k", F.col("ts").alias("fts"), F.col("id").alias("v")).where("v % 2 = 0")
    ranged = AR.ranged_rows(labels, features, ["k"], "ts", "fts", ["v"], ["v"], 16)
    sizes = sorted(r["count"] for r in ranged.where("side = 1").groupBy("part").count().collect())
    assert sum(sizes) == n and sizes[-1] <= 2 * sizes[len(sizes) // 2] + n // 16
    assert rows(AR.lookup_asof_ranges(labels, features, ["k"], "ts", "fts", ["v"], ["v"], parts=16)) == rows(
        lookup_asof(labels, features, ["k"], "ts", "fts", ["v"], ["v"], bucket=None))


def test_answers_and_expiry():
    f = [(10, [1], "a"), (20, [1], "b"), (20, [2], "c"), (40, [1], "d")]
    done, kept, wait = SA.answer(list(f), [(9, "x"), (20, "y"), (39, "z"), (50, "w")], 40, None)
    assert done == [("x", None), ("y", "c"), ("z", "c")] and kept == [f[2], f[3]] and wait == [(50, "w")]
    done, kept, _ = SA.answer(list(f), [(39, "z"), (35, "y")], 60, 15)
    assert done == [("z", None), ("y", "c")] and kept == []


def test_streams_in_any_order_within_the_delay(spark):
    """Six micro-batches with rows up to five minutes out of order, features after their labels, one feature far too late."""
    schema = "id bigint, k string, ts timestamp_ntz, side int, v double"
    every = [(i, rng.choice("abc"), T0 + dt.timedelta(seconds=20 * i), i % 2, float(i)) for i in range(600)]
    every += [(1000, None, T0, 1, 0.0), (1001, "a", T0, 1, 0.0)]
    arrival = sorted(every, key=lambda r: (r[2] - T0).total_seconds() + rng.uniform(0, 240))
    late = (2000, "a", T0 + dt.timedelta(seconds=5), 0, -1.0)
    src, out, ck = (scratch_path(spark, x) for x in ("s_src", "s_out", "s_ck"))
    size = -(-len(arrival) // 6)
    for i in range(6):
        part = arrival[i * size:(i + 1) * size] + ([late] if i == 5 else [])
        spark.createDataFrame(part, schema).coalesce(2).write.mode("append").parquet(src)
        stream = ST.read_stream(spark, src, spark.createDataFrame([], schema).schema, max_files=None)
        labels = stream.where("side = 1").select("id", "k", "ts")
        features = stream.where("side = 0").select("k", F.col("ts").alias("fts"), "v")
        ST.stream_score(SA.stream_asof(labels, features, ["k"], "ts", "fts", ["v"], "5 minutes"), lambda s: s, out, ck)
    df = spark.createDataFrame(every, schema)
    batch = lookup_asof(df.where("side = 1").select("id", "k", "ts"), df.where("side = 0").select("k", F.col("ts").alias("fts"), "v"), ["k"], "ts", "fts", ["v"])
    passed = max(r[2] for r in every) - dt.timedelta(minutes=5)
    want = batch.where((F.col("ts") < F.lit(passed).cast("timestamp_ntz")) | F.col("k").isNull())
    got = rows(spark.read.parquet(out))
    assert got == rows(want) and len(got) > 250


def test_stream_keys_share_state_by_groups(spark):
    """2,000 keys in two micro-batches: the rows of the batch form, from no more states than groups. Before, each key had one."""
    schema = "id bigint, k bigint, ts timestamp_ntz, side int, v double"
    every = [(i, i % 2000, T0 + dt.timedelta(seconds=i % 1999 + 6000 * (i // 4000)), i // 2000 % 2, float(i)) for i in range(8000)]
    df = spark.createDataFrame(every, schema)
    labels = lambda d: d.where("side = 1").select("id", "k", "ts")
    features = lambda d: d.where("side = 0").select("k", F.col("ts").alias("fts"), F.col("id").alias("no"), "v")
    last = F.lit(max(r[2] for r in every) - dt.timedelta(minutes=5)).cast("timestamp_ntz")
    for age, options in ((None, {}), (6000, {"groups": 1}), (3, {"groups": 7})):
        src, out, ck = (scratch_path(spark, x) for x in ("s_src", "s_out", "s_ck"))
        for part in (df.where("id < 4000"), df.where("id >= 4000")):
            part.coalesce(2).write.mode("append").parquet(src)
            stream = ST.read_stream(spark, src, df.schema, max_files=None)
            joined = SA.stream_asof(labels(stream), features(stream), ["k"], "ts", "fts", ["v"], "5 minutes", ["no"], age, **options)
            q = joined.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck).trigger(availableNow=True).start()
            q.awaitTermination()
            held = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
            assert held and max(held) <= options.get("groups", 1024)
        want = lookup_asof(labels(df), features(df), ["k"], "ts", "fts", ["v"], ["no"], age and f"{age} seconds").where(F.col("ts") < last)
        got = rows(spark.read.parquet(out))
        assert got == rows(want) and len(got) > 3000 and len({r[3] for r in got}) > 100


def test_stream_keeps_its_number_of_groups(spark):
    src, out, ck = (scratch_path(spark, x) for x in ("s_src", "s_out", "s_ck"))
    df = spark.createDataFrame([(i, "a", T0 + dt.timedelta(hours=i), i % 2, float(i)) for i in range(4)], "id bigint, k string, ts timestamp_ntz, side int, v double")

    def step(groups):
        df.write.mode("append").parquet(src)
        stream = ST.read_stream(spark, src, df.schema, max_files=None)
        labels, features = stream.where("side = 1").select("id", "k", "ts"), stream.where("side = 0").select("k", "ts", "v")
        ST.stream_score(SA.stream_asof(labels, features, ["k"], "ts", "ts", ["v"], "5 hours", groups=groups), lambda s: s, out, ck)
    step(1)
    with pytest.raises(Exception, match="begun with 1 groups"):
        step(2)
