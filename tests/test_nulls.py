"""Nulls, ties, large values and interrupted writes in the operators that aggregate or store."""
import datetime as dt
import math
import tempfile

import pytest
from pyspark.sql import functions as F

from featureflow.functions import columns as C
from featureflow.operators import aggregate as AG, clean as CL, feature_table as FT, metrics as MT, monitor as MO, promote as PR


def test_round_metric_keeps_large_values_and_nan(spark):
    df = spark.createDataFrame([(1e13,), (2e15,), (float("nan"),), (1.23456,), (None,), (float("inf"),)], "x double")
    got = [r.y for r in df.select(C.round_metric("x", 6).alias("y")).collect()]
    assert got[:2] == [1e13, 2e15] and math.isnan(got[2]) and got[3] == 1.23456 and got[4] is None and math.isinf(got[5])


def test_parse_number_white_space_and_suffix(spark):
    df = spark.createDataFrame([("\t",), (" \n",), ("1.5d",), (" 2.5 ",), ("-1e3",), ("x",), (None,)], "s string")
    got = df.select(C.parse_number_expr("s").alias("n"), C.parse_rejected("s").alias("r")).collect()
    assert [r.n for r in got] == [0.0, 0.0, None, 2.5, -1000.0, None, None]
    assert [r.r for r in got] == [False, False, True, False, False, True, False]


def test_modes_keep_their_type(spark):
    df = spark.createDataFrame([(9, "b"), (9, "a"), (10, "b"), (10, None), (None, "a")], "n int, s string")
    assert AG.fit_modes(df, ["n", "s"]) == {"n": 9, "s": "a"}
    out = AG.impute_mode(df, ["n", "s"])
    assert dict(out.dtypes) == {"n": "int", "s": "string"} and out.where("n is null or s is null").count() == 0


@pytest.mark.parametrize("name, out", [("CustomerID", "customer_i_d"), ("StreamingTV", "streaming_t_v"), ("Total Charges", "total__charges"),
                                       ("paperless-billing", "paperless_billing"), ("Rate (USD)", "rate__u_s_d"), ("a__b", "a_b"), ("", "")])
def test_snake_name(name, out):
    assert CL.snake_name(name) == out


def test_null_group_keeps_its_metrics(spark):
    rows = [(None, 0.9, 1, 1), (None, 0.2, 0, 0), ("a", 0.8, 1, 1), ("a", 0.3, 0, 0), ("a", None, 1, 1)]
    df = spark.createDataFrame(rows, "split string, score double, label int, prediction int")
    got = {r.split: r for r in MT.metrics_by_split(df).collect()}
    assert got[None].auc == 1.0 and got[None].weighted_f1 == 1.0 and got["a"].auc == 1.0
    assert got["a"].log_loss == pytest.approx(-(math.log(0.8) + math.log(0.7)) / 2, abs=1e-4)


def test_null_category_matches_itself(spark):
    df = spark.createDataFrame([("x",), (None,), (None,), ("y",)], "c string")
    r = MO.drift_categorical(df, df, "c").first()
    assert (r.psi, r.js_divergence, r.chi_square) == (0.0, 0.0, 0.0)


def test_merge_gives_one_row_per_key(spark):
    t = spark.createDataFrame([(1, 1, "old"), (None, 1, "n")], "k int, at int, v string")
    u = spark.createDataFrame([(1, 2, "new"), (1, 3, "newest"), (None, 2, "nn"), (2, 1, "b")], "k int, at int, v string")
    once = FT.merge_features(t, u, ["k"], "at")
    twice = FT.merge_features(once, u, ["k"], "at")
    want = {(1, 3, "newest"), (None, 2, "nn"), (2, 1, "b")}
    assert set(map(tuple, once.collect())) == want == set(map(tuple, twice.collect())) and twice.count() == 3
    late = spark.createDataFrame([(1, 0, "late")], "k int, at int, v string")
    assert {tuple(r) for r in FT.merge_features(twice, late, ["k"], "at").collect()} == want


def test_rows_without_meta_are_refused(spark):
    path = tempfile.mkdtemp(prefix="ff-meta-") + "/t"
    rows = spark.range(100).withColumnRenamed("id", "k").withColumn("v", F.lit(1))
    rows.withColumn("_bucket", F.lit(0)).write.partitionBy("_bucket").parquet(path)
    with pytest.raises(ValueError):
        FT.upsert_table(spark, rows.limit(3), ["k"], path)
    assert spark.read.parquet(path).count() == 100


def test_model_without_validation_is_an_error(spark):
    info = spark.createDataFrame([("a", 1, 0.5, dt.datetime(2024, 1, 1)), ("a", 2, 0.6, dt.datetime(2024, 1, 1))],
                                 "model_name string, model_version bigint, f1_score double, validation_timestamp timestamp_ntz")
    al = spark.createDataFrame([("a", 1, 2), ("b", 1, 2)], "model_name string, champion_version bigint, challenger_version bigint")
    with pytest.raises(ValueError):
        PR.choose_champion(info, al)
    assert {r.model_name for r in PR.choose_champion(info, al, strict=False).collect()} == {"a"}


def test_register_after_promotion(spark):
    al = spark.createDataFrame([("m", 1, "prior_champion"), ("m", 3, "champion"), ("m", 4, "challenger")], "model_name string, model_version bigint, alias string")
    new = spark.createDataFrame([("m", 5), ("n", 1)], "model_name string, model_version bigint")
    got = {(r.model_name, r.model_version): r.alias for r in PR.register_version(al, new).collect()}
    assert got == {("m", 1): "prior_champion", ("m", 3): "champion", ("m", 4): None, ("m", 5): "challenger", ("n", 1): "champion"}
