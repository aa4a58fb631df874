"""Business-shaped views derived from the driver tables (survey §2.12).

Every view is a lazy DataFrame over the parquet scans, so its work grows with the
tables. The same definitions are written independently in SQL in ``sqlbits.py``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from featureflow.operators.clean import SERVICE_COLUMNS, assign_split, prepare_customers
from featureflow.sources.tables import Tables

# Fixed values of the fixture design (our choice, see survey §2.12).
CUTOFF = dt.datetime(2001, 1, 1)
SERVICE_PART_TYPES = ("STANDARD", "PROMO", "SMALL", "LARGE", "ECONOMY", "MEDIUM")
SERVICE_QTY_THRESHOLD = 150.0


def _cutoff():
    return F.lit(CUTOFF).cast("timestamp_ntz")


def subscribers(t: Tables) -> DataFrame:
    """One raw row per customer at the cut-off, shaped like the churn bronze table.

    Orders are aggregated per customer before anything touches lineitem, and
    line quantities are aggregated per customer with one conditional sum per
    part type (no pivot, no fan-out).
    """
    pre = F.col("o_orderdate") < _cutoff()
    o = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    oagg = o.groupBy("o_custkey").agg(
        F.count(F.when(pre, 1)).cast("double").alias("tenure"),
        F.max(F.when(pre, F.col("o_totalprice"))).alias("monthly_charges"),
        F.sum(F.when(pre, F.col("o_totalprice"))).alias("_total"),
        F.count(F.when(~pre, 1)).alias("_later"),
    )
    lines = (t.lineitem.select("l_orderkey", "l_partkey", "l_quantity")
             .join(o.where(pre).select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey")
             .join(t.part.select(F.col("p_partkey").alias("l_partkey"), "p_type"), "l_partkey"))
    lagg = lines.groupBy("o_custkey").agg(*[
        F.sum(F.when(F.col("p_type") == F.lit(pt), F.col("l_quantity"))).alias(svc)
        for pt, svc in zip(SERVICE_PART_TYPES, SERVICE_COLUMNS)])
    c = t.customer.select("c_custkey", "c_nationkey", "c_mktsegment")
    df = (c.join(oagg, c.c_custkey == oagg.o_custkey, "left").drop("o_custkey")
          .join(lagg, c.c_custkey == lagg.o_custkey, "left"))
    flags = [F.when(F.col(s) > SERVICE_QTY_THRESHOLD, F.lit("Yes"))
             .when(F.col(s).isNotNull(), F.lit("No")).alias(s) for s in SERVICE_COLUMNS]
    return df.select(
        F.col("c_custkey").alias("customer_id"),
        _cutoff().alias("transaction_ts"),
        (F.col("c_nationkey") % 3).cast("bigint").alias("senior_citizen"),
        "tenure",
        "monthly_charges",
        F.when(F.col("_total").isNull(), F.lit(" "))
         .otherwise(F.col("_total").cast("decimal(18,2)").cast("string")).alias("total_charges"),
        *flags,
        F.col("c_mktsegment").alias("contract"),
        F.when(F.coalesce(F.col("_later"), F.lit(0)) > 0, F.lit("No")).otherwise(F.lit("Yes")).alias("churn"),
    )


def churn_features(t: Tables) -> DataFrame:
    """Cleaned feature table (no label column); key (customer_id, transaction_ts)."""
    return prepare_customers(subscribers(t)).drop("churn")


def churn_labels(t: Tables) -> DataFrame:
    """Label table: (customer_id, transaction_ts, churn, split)."""
    return assign_split(subscribers(t).select("customer_id", "transaction_ts", "churn"), "customer_id")


def churn_tables(t: Tables) -> tuple[DataFrame, DataFrame]:
    """(labels, features) as the feature job hands them to training: the raw table is
    computed once and written under the shared folder (a reliable checkpoint), and
    both tables are projections of it -- as separate written tables would be."""
    from featureflow.session import materialize
    sub = materialize(subscribers(t))
    labels = assign_split(sub.select("customer_id", "transaction_ts", "churn"), "customer_id")
    return labels, prepare_customers(sub).drop("churn")


def monthly_features(t: Tables) -> DataFrame:
    """Per (customer, month) running order totals; ``feature_ts`` = end of month.

    The time column is the moment the month's totals are known, so an as-of
    lookup at the cut-off never sees orders placed after it.
    """
    month = F.trunc(F.col("o_orderdate").cast("date"), "month")
    per = (t.orders.groupBy(F.col("o_custkey").alias("customer_id"), month.alias("_m"))
           .agg(F.count("*").alias("n_orders"), F.sum("o_totalprice").alias("spend")))
    w = Window.partitionBy("customer_id").orderBy("_m").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return per.select(
        "customer_id",
        F.add_months(F.col("_m"), 1).cast("timestamp_ntz").alias("feature_ts"),
        F.sum("n_orders").over(w).alias("cum_orders"),
        F.sum("spend").over(w).alias("cum_spend"),
    )


def pit_labels(t: Tables) -> DataFrame:
    """Purchases are the label events of the as-of fixture."""
    return t.events.where(F.col("event_type") == "purchase").select(
        "event_id", "user_id", "ts", F.col("value").alias("amount"))


def pit_features(t: Tables) -> DataFrame:
    """Views are the feature events of the as-of fixture."""
    return t.events.where(F.col("event_type") == "view").select(
        "user_id", F.col("ts").alias("view_ts"), F.col("event_id").alias("view_event_id"),
        F.col("value").alias("view_value"))


def predictions(t: Tables) -> DataFrame:
    """Scored documents with truth: score from length, truth = quality label."""
    d = t.documents.select("doc_id", "n_chars")
    lab = t.labels.select("doc_id", "quality")
    df = d.join(lab, "doc_id")
    score = F.least(F.col("n_chars").cast("double") / F.lit(5000.0), F.lit(1.0))
    out = df.select("doc_id", score.alias("score"),
                    F.when(score > 0.5, 1).otherwise(0).alias("prediction"),
                    F.col("quality").alias("label"))
    return assign_split(out, "doc_id")


def model_info(t: Tables) -> DataFrame:
    """Validation log: one row per (model, version) validation run."""
    return t.events.select(
        F.col("event_type").alias("model_name"),
        (F.col("user_id") % 5).alias("model_version"),
        (F.col("value") / F.lit(500.0)).alias("f1_score"),
        F.col("ts").alias("validation_timestamp"),
        F.col("event_id"),
    )


def bronze_json(t: Tables) -> DataFrame:
    return t.events.select("event_id", "ts", "props")
