import random

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator

from featureflow.operators import metrics as MT


def test_binary_metrics_edges(spark):
    none_pred = spark.createDataFrame([(1, 0), (0, 0)], "label int, prediction int")
    r = MT.binary_metrics(none_pred).first()
    assert (r.precision, r.recall, r.f1, r.accuracy) == (0.0, 0.0, 0.0, 0.5)
    none_pos = spark.createDataFrame([(0, 1), (0, 0)], "label int, prediction int")
    r = MT.binary_metrics(none_pos).first()
    assert (r.recall, r.f1) == (0.0, 0.0)
    null_pred = spark.createDataFrame([(1, None), (1, 1)], "label int, prediction int")
    r = MT.binary_metrics(null_pred).first()
    assert (r.tp, r.fn) == (1, 1)


def test_weighted_f1_matches_spark_evaluator(spark):
    rows = [(1.0, 1.0), (1.0, 0.0), (0.0, 0.0), (0.0, 1.0), (1.0, 1.0)]
    df = spark.createDataFrame(rows, "label double, prediction double")
    ours = MT.weighted_f1(df, digits=None).first().weighted_f1
    theirs = MulticlassClassificationEvaluator(metricName="f1").evaluate(df)
    assert ours == pytest.approx(theirs)
    assert MT.binary_metrics(df, positive=1.0, digits=None).first().f1 == pytest.approx(2 / 3)


def test_auc_and_curves_against_brute_force(spark):
    rng = random.Random(3)
    rows = [(round(rng.random(), 2), 1 if rng.random() < 0.4 else 0) for _ in range(300)]
    df = spark.createDataFrame(rows, "score double, label int")
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert MT.roc_auc(df, digits=None).first().auc == pytest.approx(want)
    roc = {r.threshold: (r.tpr, r.fpr) for r in MT.roc_curve(df).collect()}
    for t in list(roc)[:20]:
        assert roc[t][0] == pytest.approx(sum(p >= t for p in pos) / len(pos))
        assert roc[t][1] == pytest.approx(sum(n >= t for n in neg) / len(neg))
    # grouped form equals per-group brute force
    g = spark.createDataFrame([(s, y, i % 2) for i, (s, y) in enumerate(rows)], "score double, label int, g int")
    for r in MT.roc_auc(g, group_cols=["g"], digits=None).collect():
        sub = [(s, y) for i, (s, y) in enumerate(rows) if i % 2 == r.g]
        p_ = [s for s, y in sub if y == 1]
        n_ = [s for s, y in sub if y == 0]
        w = sum((a > b) + 0.5 * (a == b) for a in p_ for b in n_) / (len(p_) * len(n_))
        assert r.auc == pytest.approx(w)


def test_ks_brute_force(spark):
    from featureflow.operators.monitor import drift_ks
    rng = random.Random(5)
    a = [round(rng.gauss(0, 1), 1) for _ in range(200)]
    b = [round(rng.gauss(0.3, 1), 1) for _ in range(150)]
    A = spark.createDataFrame([(x,) for x in a], "x double")
    B = spark.createDataFrame([(x,) for x in b], "x double")
    xs = sorted(set(a + b))
    want = max(abs(sum(v <= x for v in a) / len(a) - sum(v <= x for v in b) / len(b)) for x in xs)
    assert drift_ks(A, B, "x", digits=10).first().ks == pytest.approx(want, abs=1e-9)


def test_drift_metrics_long_format(spark):
    from featureflow.operators.monitor import drift_metrics
    a = spark.createDataFrame([("x", 1.0), ("y", 2.0), ("x", 3.0)], "c string, v double")
    b = spark.createDataFrame([("y", 1.5), ("y", 2.5)], "c string, v double")
    got = {(r.column_name, r.metric) for r in drift_metrics(a, b, ["c", "v"]).collect()}
    assert got == {("c", "psi"), ("c", "js_divergence"), ("c", "chi_square"), ("v", "ks")}
    assert MT.auc is MT.roc_auc


def test_binned_roc_points(spark):
    rng = random.Random(9)
    rows = [(rng.random(), 1 if rng.random() < 0.5 else 0) for _ in range(500)]
    df = spark.createDataFrame(rows, "score double, label int")
    pts = MT.roc_curve(df, bins=10).collect()
    assert len(pts) <= 11
    pos = [s for s, y in rows if y == 1]
    for r in pts:
        assert r.tpr == pytest.approx(sum(int(s * 10) / 10 >= r.threshold for s in pos) / len(pos))


def test_random_search_same_points_at_any_parallelism():
    from featureflow.operators.ml import random_search
    space = {"a": ("uniform", 0, 1), "b": ("quniform", 1, 9, 1), "c": ("loguniform", 0.01, 1.0), "d": ("choice", [3, 4])}
    obj = lambda p: (p["a"] - 0.3) ** 2 + p["b"] * 0.01
    one, four = random_search(space, 6, obj, 42, 1), random_search(space, 6, obj, 42, 4)
    assert one == four and one[0]["loss"] <= one[-1]["loss"]


def test_metrics_by_split_equals_separate_metrics(spark):
    rng = random.Random(17)
    rows = [(rng.choice(["train", "test"]), round(rng.random(), 3), rng.choice([0, 1, None]), rng.choice([0, 1]))
            for _ in range(400)]
    df = spark.createDataFrame(rows, "split string, score double, label int, prediction int")
    got = {r.split: r for r in MT.metrics_by_split(df).collect()}
    for s in ("train", "test"):
        sub = df.where(df.split == s)
        b = MT.binary_metrics(sub).first()
        assert (got[s].tp, got[s].fp, got[s].fn, got[s].tn, got[s].f1) == (b.tp, b.fp, b.fn, b.tn, b.f1)
        assert got[s].weighted_f1 == MT.weighted_f1(sub).first().weighted_f1
        assert got[s].log_loss == pytest.approx(MT.log_loss(sub).first().log_loss, abs=1e-4)
        assert got[s].auc == MT.roc_auc(sub).first().auc


def test_curves_do_not_depend_on_shuffle_partitions(spark):
    df = spark.range(300).selectExpr("cast(id * 37 % 211 as double) / 211 as score", "cast(id % 3 = 0 as int) as label")
    few = sorted(tuple(r) for r in MT.roc_curve(df).collect())
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "100")
    try:
        assert sorted(tuple(r) for r in MT.roc_curve(df).collect()) == few
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
