"""Registered queries: one per operator of the survey inventory, each over the
driver tables (or views Spark derives from them), each with its SQL oracle where
SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featureflow.functions import columns as C
from featureflow.operators import lookup as LK
from featureflow.plans import fixtures as FX
from featureflow.plans import sqlbits as S
from featureflow.plans.registry import query
from featureflow.session import configure
from featureflow.sources.tables import Tables


def _t(spark: SparkSession, d: str) -> Tables:
    configure(spark)
    return Tables(spark, d)


r4 = C.round_metric

# ---------------------------------------------------------------------------------------
# Flagship: raw table -> clean -> labels + split -> point-in-time training set -> summary
# ---------------------------------------------------------------------------------------


def training_set(t: Tables, bucket: str | None = LK.DEFAULT_BUCKET) -> DataFrame:
    labels, features = FX.churn_tables(t)
    return LK.create_training_set(
        labels,
        lookups=[
            LK.FeatureLookup(features, ["customer_id"], "transaction_ts"),
            LK.FeatureLookup(FX.monthly_features(t), ["customer_id"], "transaction_ts", feature_ts="feature_ts",
                             feature_names=["cum_orders", "cum_spend"]),
        ],
        functions=[LK.FeatureFunction(C.price_increase,
                                      {"monthly": "monthly_charges", "tenure": "tenure", "total": "total_charges"},
                                      "avg_price_increase")],
        label="churn",
        bucket=bucket,
    )


def training_summary_df(t: Tables) -> DataFrame:
    ts = training_set(t)
    return ts.groupBy("split", "churn").agg(
        F.count("*").alias("n"),
        r4(F.avg("num_optional_services")).alias("avg_services"),
        r4(F.avg("avg_price_increase")).alias("avg_price_increase"),
        r4(F.avg("tenure")).alias("avg_tenure"),
        r4(F.avg("cum_spend")).alias("avg_cum_spend"),
        F.count("cum_orders").alias("n_with_history"),
    )


@query("training_summary", S.with_(S.SUBSCRIBERS, S.CHURN_FEATURES, S.CHURN_LABELS, S.MONTHLY) + f"""
, ts AS (
  SELECT l.split, l.churn, f.num_optional_services, f.tenure, m.cum_spend, m.cum_orders,
         {S.price_increase('f.monthly_charges', 'f.tenure', 'f.total_charges')} AS avg_price_increase
  FROM churn_labels l
  ASOF LEFT JOIN churn_features f ON l.customer_id = f.customer_id AND l.transaction_ts >= f.transaction_ts
  ASOF LEFT JOIN monthly_features m ON l.customer_id = m.customer_id AND l.transaction_ts >= m.feature_ts)
SELECT split, churn, count(*) AS n,
       {S.r4('avg(num_optional_services)')} AS avg_services,
       {S.r4('avg(avg_price_increase)')} AS avg_price_increase,
       {S.r4('avg(tenure)')} AS avg_tenure,
       {S.r4('avg(cum_spend)')} AS avg_cum_spend,
       count(cum_orders) AS n_with_history
FROM ts GROUP BY split, churn""")
def q_training_summary(spark, d):
    return training_summary_df(_t(spark, d))
