"""Indicator names, stored models, scoring from ids and times, permutations."""
import datetime as dt

from pyspark.sql import functions as F

from featureflow.operators import lookup as LK
from featureflow.operators import ml as ML
from featureflow.session import scratch_path

T0 = dt.datetime(2024, 1, 1)


def test_levels_with_like_names_keep_their_own_columns(spark):
    df = spark.createDataFrame([("A-B",), ("A B",), ("unknown",), (None,)], "c string")
    pre = ML.preprocess_fit(df, [], [], ["c"])
    out = pre.transform(df)
    names = pre.feature_columns()
    assert len(set(names)) == 4 and set(names) == set(out.columns)
    assert all(sum(r) == 1.0 for r in out.collect())


def test_scoring_from_ids_with_a_stored_model(spark):
    feats = spark.createDataFrame([(i, T0, float(i), "x" if i % 2 else "y") for i in range(40)], "id int, ts timestamp_ntz, a double, kind string")
    ids = spark.createDataFrame([(i, T0 + dt.timedelta(days=1)) for i in range(40)], "id int, ts timestamp_ntz")
    lookups = [LK.FeatureLookup(feats, ["id"], "ts")]
    data = LK.create_training_set(ids, lookups).withColumn("label", (F.col("a") >= 20).cast("double"))
    pre = ML.preprocess_fit(data, [], ["a"], ["kind"])
    model = ML.train_gbt(pre.transform(data), None, pre.feature_columns(), params={"maxIter": 2, "maxDepth": 2})
    path = scratch_path(spark, "scoring-model")
    ML.ScoringModel(pre, model).save(spark, path)
    loaded = ML.ScoringModel.load(spark, path)
    assert loaded.prepare == pre
    got = ML.score_batch(ids, loaded, lookups=lookups, texts=("No", "Yes"))
    assert got.columns == ["id", "ts", "score", "prediction"]
    assert {r.id: r.prediction for r in got.collect()} == {i: "Yes" if i >= 20 else "No" for i in range(40)}


def test_permutation_keeps_values_at_any_session_setting(spark):
    df = spark.createDataFrame([(i, f"v{i}") for i in range(50)], "id int, v string")
    first = {r.id: r.v for r in ML.permuted(df, "v", "id").collect()}
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        again = {r.id: r.v for r in ML.permuted(df, "v", "id").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
    assert first == again and sorted(first.values()) == sorted(f"v{i}" for i in range(50))
    assert all(v != f"v{i}" for i, v in first.items())


def test_bake_off_stops_at_its_budget(spark):
    df = spark.createDataFrame([(float(i), float(i >= 10)) for i in range(20)], "a double, label double")
    one = ML.bake_off(df, df, ["a"], budget_seconds=0.0)
    assert [r["family"] for r in one] == ["logistic_regression"] and one[0]["rows"] == 20 and one[0]["positives"] == 10
