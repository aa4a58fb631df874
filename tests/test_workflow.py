"""Integration: feature job -> training job -> validation -> promotion -> monitoring, as in the
README workflow, on the smallest driver tables."""
import datetime as dt

from pyspark.sql import functions as F

from featureflow.functions.columns import price_increase
from featureflow.functions.sql import register_sql_functions
from featureflow.operators import clean as CL
from featureflow.operators import feature_table as FT
from featureflow.operators import lookup as LK
from featureflow.operators import ml as ML
from featureflow.operators import monitor as MO
from featureflow.operators import promote as PR
from featureflow.plans import fixtures as FX
from featureflow.session import scratch_path
from featureflow.sources import tables as TB


def test_end_to_end(spark):
    t = TB.Tables(spark, "/root/testdata/sf0.001")
    cut_off, now = dt.datetime(2001, 1, 1), dt.datetime(2024, 1, 1)
    raw = FX.subscribers(t).drop("transaction_ts")
    feats = CL.stamp(CL.prepare_customers(raw), transaction_ts=F.lit(cut_off).cast("timestamp_ntz"))
    labels = CL.assign_split(feats.select("customer_id", "transaction_ts", "churn"), "customer_id")
    TB.write_table(labels, "wf_churn_labels", location=scratch_path(spark, "labels"))
    ftp = scratch_path(spark, "features")
    FT.upsert_table(spark, feats.drop("churn"), ["customer_id", "transaction_ts"], ftp)
    assert FT.check_constraints(spark.table("wf_churn_labels"), ["customer_id", "transaction_ts"]).count() == 0
    register_sql_functions(spark)

    ts = LK.create_training_set(
        spark.table("wf_churn_labels"),
        [LK.FeatureLookup(FT.feature_table(spark, ftp), ["customer_id"], "transaction_ts")],
        [LK.FeatureFunction(price_increase, {"monthly": "monthly_charges", "tenure": "tenure",
                                             "total": "total_charges"}, "avg_price_increase")],
        label="churn").withColumn("label", (F.col("churn") == "Yes").cast("double"))
    assert ts.count() == labels.count()
    pre = ML.preprocess_fit(CL.split_of(ts, "train"), ["senior_citizen"], ML.NUM_FEATURES,
                            ["contract", "online_security"])
    x = pre.transform(ts)
    model = ML.train_gbt(CL.split_of(x, "train"), CL.split_of(x, "validate"), pre.feature_columns(),
                         params={"maxIter": 5})
    scored = ML.score_batch(x, model)
    assert scored.count() == labels.count() and {"score", "prediction"} <= set(scored.columns)

    mi = scratch_path(spark, "model_info")
    TB.append_table(PR.validation_record(scored, "churn", 1, "champion", "gbt", now), path=mi)
    TB.append_table(PR.validation_record(scored, "churn", 2, "challenger", "gbt", now), path=mi)
    aliases = spark.createDataFrame([("churn", 1, 2)], "model_name string, champion_version bigint, "
                                                        "challenger_version bigint")
    decision = PR.choose_champion(spark.read.parquet(mi), aliases)
    got = {r.model_version: r.new_alias for r in decision.collect()}
    assert got == {1: "champion", 2: "challenger"}  # equal scores: the incumbent stays

    log = scored.withColumns({"inference_timestamp": F.lit(now).cast("timestamp_ntz"), "model_version": F.lit(2)})
    profile = MO.profile_metrics(log, "inference_timestamp", "1 day", ["score"], model_col="model_version",
                                 table_metrics={"error": (F.col("score") - F.col("label")) ** 2})
    assert MO.metric_violated(profile, "error", 0.0, n_eval=5, n_violate=1).first().query_result == 1
    assert MO.metric_violated(profile, "error", 1.0, n_eval=5, n_violate=1).first().query_result == 0
