"""Columns of many levels, tables by row count, cuts by bisection, one read of scored rows."""
import random

import pytest
from pyspark.sql import functions as F

from featureflow.operators import metrics as MT
from featureflow.operators import ml as ML
from featureflow.operators import wide_levels as WL
from featureflow.session import scratch_path
from featureflow.sources import tables as TB


def test_levels_beyond_the_collected_bound(spark):
    """More levels than ``fit_levels`` takes, a hot level, nulls: numbers are the places in the sorted distinct values."""
    n = ML.MAX_LEVELS + 500
    rows = spark.range(n * 2).select(F.when(F.col("id") < n, F.concat(F.lit("v"), F.col("id"))).when(F.col("id") % 2 == 0, F.lit("v7")).alias("c"),
                                     (F.col("id") % 3).cast("string").alias("d"))
    got = WL.fit_level_table(rows, ["c", "d"]).collect()
    assert [r.level for r in sorted((r for r in got if r.column_name == "c"), key=lambda r: r.idx)] == sorted(f"v{i}" for i in range(n))
    assert sorted(r.idx for r in got if r.column_name == "c") == list(range(n)) and {r.n_levels for r in got if r.column_name == "c"} == {n}
    assert {r.level: r.idx for r in got if r.column_name == "d"} == {"0": 0, "1": 1, "2": 2}


def test_sparse_vectors_equal_dense_indicators(spark):
    rng = random.Random(4)
    fit = spark.createDataFrame([(rng.choice(["a", "b", "c", None]), rng.randint(0, 3)) for _ in range(50)], "k string, n int")
    new = spark.createDataFrame([("a", 1), ("z", 2), (None, 9), ("c", None)], "k string, n int")
    table = WL.fit_level_table(fit, ["k", "n"])
    out = WL.one_hot_sparse(new, table, ["k", "n"]).collect()
    dense = ML.one_hot(new, ML.fit_levels(fit, ["k", "n"]), unknown_indicator=["k", "n"], keep_input=True).collect()
    want = {(r.k, r.n): ([r.k_a, r.k_b, r.k_c, r.k_unknown], [r.n_0, r.n_1, r.n_2, r.n_3, r.n_unknown]) for r in dense}
    assert len(out) == 4
    for r in out:
        assert (r.k_vec.toArray().tolist(), r.n_vec.toArray().tolist()) == want[r.k, r.n] and len(r.k_vec.indices) == 1
    with pytest.raises(ValueError):
        WL.level_indices(new.withColumn("k_idx", F.lit(1)), table, ["k"])


def test_empty_levels(spark):
    df = spark.createDataFrame([(None,)], "k string")
    table = WL.fit_level_table(df, ["k"])
    assert table.count() == 0 and WL.fit_level_table(df.limit(0), ["k"]).count() == 0
    assert [r.k_vec.toArray().tolist() for r in WL.one_hot_sparse(df, table, ["k"]).collect()] == [[1.0]]


def test_rows_by_count(spark):
    specs = {"kind": TB.Choice(("x", "y"), (3, 1)), "size": TB.Steps(0, 10, 1)}
    long = TB.generate_rows(spark, 300, specs).collect()
    assert len(long) == 300 and {r.kind for r in long} == {"x", "y"}
    parts = TB.generate_rows(spark, 100, specs).collect() + TB.generate_rows(spark, 200, specs, first=100).collect()
    assert sorted(long) == sorted(parts) and TB.generate_rows(spark, 0, specs).count() == 0
    with pytest.raises(ValueError):
        TB.generate_rows(spark, -1, specs)


def test_cuts_below_is_a_count(spark):
    for n in (1, 2, 3, 7, 8, 63, 100):
        cuts = sorted(random.Random(n).choice(range(20)) * 1.0 for _ in range(n))
        xs = [-1.0, 0.0, 3.0, 3.5, 19.0, 25.0, None, float("nan")]
        df = spark.createDataFrame([(cuts, x) for x in xs], "cuts array<double>, x double")
        got = [r.b for r in df.select(MT._cuts_below("cuts", n, F.col("x")).alias("b")).collect()]
        assert got == [0 if x is None else n if x != x else sum(c < x for c in cuts) for x in xs]


def test_split_metrics_read_their_rows_once(spark):
    rng = random.Random(8)
    rows = [(rng.choice(["train", "test", None]), rng.choice([0, 1, None]), rng.choice([0, 1]), rng.choice([None, rng.random()])) for _ in range(400)]
    path = scratch_path(spark, "scored-once")
    spark.createDataFrame(rows, "split string, label int, prediction int, score double").write.parquet(path)
    df = spark.read.parquet(path)
    out = MT.metrics_by_split(df)
    got = {r.split: r for r in out.collect()}
    plan = out._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final and final.count("FileScan parquet") == 1
    auc = {r.split: r.auc for r in MT.roc_auc(df, group_cols=["split"]).collect()}
    loss = {r.split: r.log_loss for r in MT.log_loss(df, group_cols=["split"]).collect()}
    assert {s: r.auc for s, r in got.items()} == auc and {s: r.log_loss for s, r in got.items()} == pytest.approx(loss)
    for s, r in got.items():
        assert r.tp == sum(x[0] == s and x[1] == 1 and x[2] == 1 for x in rows)
