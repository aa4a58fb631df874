import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from featureflow.operators import lookup as LK

D = dt.datetime


def brute_asof(labels, feats, max_age=None):
    out = []
    for (lid, k, t) in labels:
        cands = [f for f in feats if f[0] == k and f[1] <= t]
        best = max(cands, key=lambda f: (f[1], f[2])) if cands else None
        if best is not None and max_age is not None and t - best[1] > max_age:
            best = None
        out.append((lid, k, t, None if best is None else best[2], None if best is None else best[3]))
    return sorted(out, key=lambda r: r[0])


def run(spark, labels, feats, bucket, max_age=None):
    L = spark.createDataFrame(labels, "lid bigint, k bigint, ts timestamp_ntz")
    Fd = spark.createDataFrame(feats, "k bigint, fts timestamp_ntz, fid bigint, v double")
    res = LK.lookup_asof(L, Fd, ["k"], "ts", feature_ts="fts", tie_breakers=["fid"],
                         max_age=None if max_age is None else f"{max_age.days} days", bucket=bucket)
    return sorted([tuple(r) for r in res.select("lid", "k", "ts", "fid", "v").collect()], key=lambda r: r[0])


EDGE_LABELS = [(1, 1, D(2024, 1, 5)),   # two earlier features -> newest
               (2, 1, D(2024, 1, 3)),   # equal time -> included
               (3, 2, D(2024, 1, 5)),   # only a future feature -> null
               (4, 3, D(2024, 1, 5)),   # no feature at all
               (5, 1, D(2024, 1, 5)),   # duplicate label row -> kept
               (6, 1, D(2024, 3, 1))]   # far later, older than max_age
EDGE_FEATS = [(1, D(2024, 1, 1), 10, 1.0), (1, D(2024, 1, 3), 11, 2.0), (2, D(2024, 1, 9), 20, 3.0),
              (1, D(2024, 1, 3), 9, 9.0)]  # same time as fid 11: larger tie-breaker wins


@pytest.mark.parametrize("bucket", [None, "1 day", "7 days"])
def test_asof_edges(spark, bucket):
    got = run(spark, EDGE_LABELS, EDGE_FEATS, bucket)
    assert got == brute_asof(EDGE_LABELS, EDGE_FEATS)
    assert [r[3] for r in got] == [11, 11, None, None, 11, 11]


@pytest.mark.parametrize("bucket", [None, "1 day"])
def test_asof_max_age(spark, bucket):
    age = dt.timedelta(days=10)
    got = run(spark, EDGE_LABELS, EDGE_FEATS, bucket, age)
    assert got == brute_asof(EDGE_LABELS, EDGE_FEATS, age)
    assert got[5][3] is None


def test_asof_hot_key_random(spark):
    """One key holds most rows; bucketed and unbucketed plans equal brute force."""
    rng = random.Random(7)
    base = D(2024, 1, 1)
    labels, feats = [], []
    for i in range(600):
        k = 0 if rng.random() < 0.6 else rng.randint(1, 20)
        labels.append((i, k, base + dt.timedelta(minutes=rng.randint(0, 60 * 24 * 40))))
    for j in range(900):
        k = 0 if rng.random() < 0.6 else rng.randint(1, 20)
        feats.append((k, base + dt.timedelta(minutes=rng.randint(0, 60 * 24 * 40)), 1000 + j, float(j)))
    want = brute_asof(labels, feats)
    assert run(spark, labels, feats, "1 day") == want
    assert run(spark, labels, feats, None) == want


def test_asof_plan_has_no_theta_join(spark):
    L = spark.createDataFrame(EDGE_LABELS, "lid bigint, k bigint, ts timestamp_ntz")
    Fd = spark.createDataFrame(EDGE_FEATS, "k bigint, fts timestamp_ntz, fid bigint, v double")
    res = LK.lookup_asof(L, Fd, ["k"], "ts", feature_ts="fts")
    plan = res._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_training_set_composition(spark):
    from featureflow.functions.columns import price_increase
    labels = spark.createDataFrame([(1, D(2024, 1, 5), "Yes"), (2, D(2024, 1, 5), "No")],
                                   "customer_id bigint, ts timestamp_ntz, churn string")
    feats = spark.createDataFrame([(1, D(2024, 1, 1), 10.0, 2.0, 30.0), (2, D(2024, 1, 6), 5.0, 1.0, 5.0)],
                                  "customer_id bigint, fts timestamp_ntz, m double, t double, tot double")
    ts = LK.create_training_set(
        labels, [LK.FeatureLookup(feats, ["customer_id"], "ts", feature_ts="fts")],
        [LK.FeatureFunction(price_increase, {"monthly": "m", "tenure": "t", "total": "tot"}, "api")],
        label="churn", exclude_columns=["ts"])
    rows = {r.customer_id: r for r in ts.collect()}
    assert ts.columns == ["customer_id", "churn", "m", "t", "tot", "api"]
    assert rows[1].api == pytest.approx(-5.0) and rows[2].m is None and rows[2].api is None


def test_null_label_times_and_keys_are_kept(spark):
    base = D(2024, 1, 1)
    L = spark.createDataFrame([(0, 1, base), (1, 1, None), (2, None, base), (3, 2, base)], "lid bigint, k bigint, ts timestamp_ntz")
    Fd = spark.createDataFrame([(1, base - dt.timedelta(days=90), 7, 1.0), (1, None, 8, 2.0)], "k bigint, fts timestamp_ntz, fid bigint, v double")
    for bucket in (None, "1 day", "30 days"):
        got = LK.lookup_asof(L, Fd, ["k"], "ts", feature_ts="fts", bucket=bucket).orderBy("lid").collect()
        assert [(r.lid, r.fid) for r in got] == [(0, 7), (1, None), (2, None), (3, None)]


def test_planning_runs_no_job(spark):
    L = spark.createDataFrame([(0, 1, D(2024, 1, 1))], "lid bigint, k bigint, ts timestamp_ntz")
    Fd = spark.createDataFrame([(1, D(2023, 1, 1), 7, 1.0)], "k bigint, fts timestamp_ntz, fid bigint, v double")
    spark.sparkContext.setJobGroup("asof-plan", "")
    LK.lookup_asof(L, Fd, ["k"], "ts", feature_ts="fts")
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("asof-plan")
    spark.sparkContext.setJobGroup("", "")


def test_clustered_hot_key(spark):
    rng = random.Random(11)
    base = D(2024, 1, 1)
    labels = [(i, 0 if i % 3 else i, base + dt.timedelta(minutes=rng.randint(0, 60))) for i in range(300)]
    feats = [(0 if j % 3 else j, base + dt.timedelta(minutes=rng.randint(0, 60)), 5000 + j, float(j)) for j in range(400)]
    L = spark.createDataFrame(labels, "lid bigint, k bigint, ts timestamp_ntz")
    Fd = spark.createDataFrame(feats, "k bigint, fts timestamp_ntz, fid bigint, v double")
    for bucket in ("5 minutes", "30 days"):
        res = LK.lookup_asof(L, Fd, ["k"], "ts", feature_ts="fts", tie_breakers=["fid"], bucket=bucket)
        got = sorted([tuple(r) for r in res.select("lid", "k", "ts", "fid", "v").collect()], key=lambda r: r[0])
        assert got == brute_asof(labels, feats)


def test_register_feature(spark):
    from featureflow.functions.columns import price_increase
    LK.register_feature("avg_price_increase", price_increase,
                        {"monthly": "monthly_charges", "tenure": "tenure", "total": "total_charges"})
    f = LK.feature_function("avg_price_increase", tenure="t")
    df = spark.createDataFrame([(50.0, 2.0, 60.0)], "monthly_charges double, t double, total_charges double")
    assert df.select(f.column().alias("x")).first().x == pytest.approx(20.0)


def test_hot_key_plan_partitions_by_time_bucket(spark):
    L = spark.createDataFrame([(i, 0, D(2024, 1, 1) + dt.timedelta(hours=i)) for i in range(200)],
                              "lid bigint, k bigint, ts timestamp_ntz")
    Fd = spark.createDataFrame([(0, D(2024, 1, 1) + dt.timedelta(hours=j, minutes=30), j, 1.0) for j in range(200)],
                               "k bigint, fts timestamp_ntz, fid bigint, v double")
    hot = LK.lookup_asof(L, Fd, ["k"], "ts", feature_ts="fts")
    cold = LK.lookup_asof(L, Fd, ["k"], "ts", feature_ts="fts", bucket=None)
    hot_plan = hot._jdf.queryExecution().executedPlan().toString()
    cold_plan = cold._jdf.queryExecution().executedPlan().toString()
    assert "_b#" in hot_plan and "_b#" not in cold_plan
    assert sorted(tuple(r) for r in hot.collect()) == sorted(tuple(r) for r in cold.collect())


@pytest.mark.parametrize("bucket", [None, "1 day"])
def test_multi_lookup_one_pass_equals_sequential(spark, bucket):
    rng = random.Random(21)
    base = D(2024, 1, 1)
    labels = [(i, rng.randint(0, 5), base + dt.timedelta(hours=rng.randint(0, 24 * 10))) for i in range(150)]
    f1 = [(rng.randint(0, 5), base + dt.timedelta(hours=rng.randint(0, 24 * 10)), j, float(j)) for j in range(120)]
    f2 = [(rng.randint(0, 5), base + dt.timedelta(hours=rng.randint(0, 24 * 10)), 900 + j) for j in range(80)]
    L = spark.createDataFrame(labels, "lid bigint, k bigint, ts timestamp_ntz")
    F1 = spark.createDataFrame(f1, "k bigint, t1 timestamp_ntz, fid bigint, v double")
    F2 = spark.createDataFrame(f2, "k bigint, t2 timestamp_ntz, gid bigint")
    one = LK.lookup_asof_many(L, [LK.AsofSide(F1, "t1", tie_breakers=["fid"]),
                                  LK.AsofSide(F2, "t2", tie_breakers=["gid"], max_age="2 days")],
                              ["k"], "ts", bucket=bucket)
    seq = LK.lookup_asof(LK.lookup_asof(L, F1, ["k"], "ts", "t1", tie_breakers=["fid"], bucket=bucket),
                         F2, ["k"], "ts", "t2", tie_breakers=["gid"], max_age="2 days", bucket=bucket)
    assert one.columns == seq.columns == ["lid", "k", "ts", "fid", "v", "gid"]
    assert sorted(tuple(r) for r in one.collect()) == sorted(tuple(r) for r in seq.collect())
    final = one._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("Window [") == (1 if bucket is None else 2)  # one pass for both lookups
