"""Registered queries for sources/sinks (S) and cleaning/scalar operators (B, P1)."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from featureflow.functions import columns as C
from featureflow.operators import clean as CL
from featureflow.operators import feature_table as FT
from featureflow.operators import monitor as MO
from featureflow.plans import fixtures as FX
from featureflow.plans import sqlbits as S
from featureflow.plans.queries import _t
from featureflow.plans.registry import query
from featureflow.session import scratch_path
from featureflow.sources import tables as TB

W = S.with_
SUB = (S.SUBSCRIBERS,)

# ------------------------------------------------------------------ B: cleaning / scalar


@query("normalized_columns", """
SELECT c_custkey AS customer_id, c_name AS name, c_acctbal AS account_balance,
       c_mktsegment AS market_segment, c_nationkey AS nation_key FROM customer""")
def q_normalized_columns(spark, d):
    t = _t(spark, d)
    raw = t.customer.select(F.col("c_custkey").alias("CustomerID"), F.col("c_name").alias("Name"),
                            F.col("c_acctbal").alias("AccountBalance"),
                            F.col("c_mktsegment").alias("MarketSegment"), F.col("c_nationkey").alias("NationKey"))
    return CL.normalize_columns(raw)


@query("num_optional_services", W(*SUB) + """
SELECT customer_id, CAST(""" + " + ".join(f"(CASE WHEN {s} = 'Yes' THEN 1 ELSE 0 END)" for s in S.SERVICES)
       + """ AS BIGINT) AS num_optional_services FROM subscribers""")
def q_num_optional_services(spark, d):
    return CL.count_flags(FX.subscribers(_t(spark, d))).select("customer_id", "num_optional_services")


@query("recode_values", W(*SUB) + """
SELECT customer_id, CASE CAST(senior_citizen AS VARCHAR) WHEN '1' THEN 'Yes' WHEN '0' THEN 'No' END AS senior_citizen
FROM subscribers""")
def q_recode_values(spark, d):
    return CL.recode(FX.subscribers(_t(spark, d)), "senior_citizen").select("customer_id", "senior_citizen")


@query("parse_number", W(*SUB) + """
, txt AS (SELECT customer_id, CASE WHEN customer_id % 50 = 0 THEN 'n/a' ELSE total_charges END AS x FROM subscribers)
SELECT customer_id,
       CASE WHEN trim(x) = '' THEN 0.0 ELSE TRY_CAST(x AS DOUBLE) END AS total_charges,
       (x IS NOT NULL AND trim(x) <> '' AND TRY_CAST(x AS DOUBLE) IS NULL) AS rejected
FROM txt""")
def q_parse_number(spark, d):
    s = FX.subscribers(_t(spark, d))
    s = s.withColumn("total_charges", F.when(F.col("customer_id") % 50 == 0, F.lit("n/a"))
                     .otherwise(F.col("total_charges")))
    return CL.parse_number(s, "total_charges", reject_col="rejected").select("customer_id", "total_charges", "rejected")


@query("coerce_numeric", """
SELECT o_orderkey, TRY_CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS priority_num,
       TRY_CAST(o_orderpriority AS DOUBLE) AS priority_raw FROM orders""")
def q_coerce_numeric(spark, d):
    o = _t(spark, d).orders.select("o_orderkey", F.substring("o_orderpriority", 1, 1).alias("priority_num"),
                                   F.col("o_orderpriority").alias("priority_raw"))
    return CL.coerce_numeric(o, ["priority_num", "priority_raw"])


@query("fill_missing", W(*SUB) + """
SELECT customer_id, coalesce(tenure, 0.0) AS tenure, coalesce(monthly_charges, 0.0) AS monthly_charges
FROM subscribers""")
def q_fill_missing(spark, d):
    s = FX.subscribers(_t(spark, d)).select("customer_id", "tenure", "monthly_charges")
    return CL.fill_missing(s, {"tenure": 0.0, "monthly_charges": 0.0})


STAMP_TS = dt.datetime(2024, 6, 1, 7, 0, 0)


@query("stamp_metadata", W(S.PREDICTIONS) + """
SELECT doc_id, prediction, 'doc_quality' AS model_name, CAST(3 AS INTEGER) AS model_version,
       'champion' AS model_alias, TIMESTAMP '2024-06-01 07:00:00' AS inference_timestamp
FROM predictions""")
def q_stamp_metadata(spark, d):
    p = FX.predictions(_t(spark, d)).select("doc_id", "prediction")
    return CL.stamp(p, model_name="doc_quality", model_version=3, model_alias="champion",
                    inference_timestamp=F.lit(STAMP_TS).cast("timestamp_ntz"))


@query("avg_price_increase", W(*SUB, S.CHURN_FEATURES) + f"""
SELECT customer_id, {S.price_increase('monthly_charges', 'tenure', 'total_charges')} AS avg_price_increase
FROM churn_features""")
def q_avg_price_increase(spark, d):
    return CL.add_price_increase(FX.churn_features(_t(spark, d))).select("customer_id", "avg_price_increase")


MODEL_COLS = ["customer_id", "tenure", "monthly_charges", "total_charges", "num_optional_services", "contract",
              "gender"]


@query("select_supported", W(*SUB, S.CHURN_FEATURES) + """
SELECT customer_id, tenure, monthly_charges, total_charges, num_optional_services, contract FROM churn_features""")
def q_select_supported(spark, d):
    return CL.select_supported(FX.churn_features(_t(spark, d)), MODEL_COLS)


@query("drop_rename", W(*SUB, S.CHURN_LABELS) + """
SELECT customer_id, churn AS label, split FROM churn_labels""")
def q_drop_rename(spark, d):
    lab = CL.drop_columns(FX.churn_labels(_t(spark, d)), ["transaction_ts"])
    return CL.rename_columns(lab, {"churn": "label"})


@query("assign_split", W(*SUB, S.CHURN_LABELS) + "SELECT customer_id, split FROM churn_labels")
def q_assign_split(spark, d):
    return FX.churn_labels(_t(spark, d)).select("customer_id", "split")


@query("split_counts", W(*SUB, S.CHURN_LABELS) + """
SELECT split, count(*) AS n, count(CASE WHEN churn = 'Yes' THEN 1 END) AS n_churned
FROM churn_labels GROUP BY split""")
def q_split_counts(spark, d):
    lab = FX.churn_labels(_t(spark, d))
    parts = [CL.split_of(lab, name).groupBy("split").agg(F.count(F.lit(1)).alias("n"),
                                                          F.count_if(F.col("churn") == "Yes").alias("n_churned"))
             for name, _ in CL.SPLIT_RATIOS]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("ceil_timestamp", """
SELECT event_id,
       make_timestamp(((epoch_us(ts) + 899999999) // 900000000) * 900000000) AS ceil_15,
       make_timestamp(((epoch_us(ts) + 1799999999) // 1800000000) * 1800000000) AS ceil_30,
       CAST(((epoch_us(ts) + 899999999) // 900000000) * 900 AS BIGINT) AS ceil_15_unix
FROM events""")
def q_ceil_timestamp(spark, d):
    e = _t(spark, d).events
    return e.select("event_id", C.ceil_timestamp("ts", 15).cast("timestamp_ntz").alias("ceil_15"),
                    C.ceil_timestamp("ts", 30).cast("timestamp_ntz").alias("ceil_30"),
                    C.ceil_unix_seconds("ts", 15).alias("ceil_15_unix"))


@query("decode_label", W(*SUB, S.CHURN_LABELS) + """
SELECT customer_id, CAST(CASE WHEN churn = 'Yes' THEN 1.0 ELSE 0.0 END AS DOUBLE) AS label FROM churn_labels""")
def q_decode_label(spark, d):
    return FX.churn_labels(_t(spark, d)).select("customer_id", C.decode_label("churn").alias("label"))


@query("narrow_floats", W(*SUB, S.CHURN_FEATURES) + """
SELECT customer_id, CAST(tenure AS FLOAT) AS tenure, CAST(monthly_charges AS FLOAT) AS monthly_charges,
       CAST(total_charges AS FLOAT) AS total_charges FROM churn_features""")
def q_narrow_floats(spark, d):
    f = FX.churn_features(_t(spark, d)).select("customer_id", "tenure", "monthly_charges", "total_charges")
    return CL.narrow_floats(f)


@query("round_metric", W(S.MODEL_INFO) + f"""
SELECT event_id, {S.r4('f1_score')} AS f1_rounded FROM model_info""")
def q_round_metric(spark, d):
    return FX.model_info(_t(spark, d)).select("event_id", C.round_metric("f1_score", 4).alias("f1_rounded"))


@query("to_time", """
SELECT event_id, make_timestamp(CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) * 1000000) AS from_epoch,
       date_trunc('second', ts) AS from_text FROM events""")
def q_to_time(spark, d):
    e = _t(spark, d).events
    secs = F.unix_seconds(F.col("ts").cast("timestamp"))
    txt = F.date_format(F.col("ts"), "yyyy-MM-dd HH:mm:ss")
    return e.select("event_id", C.to_time(secs).alias("from_epoch"),
                    C.to_time(txt, "yyyy-MM-dd HH:mm:ss").alias("from_text"))


def profile(t):
    """Profile table over events: 1-day windows, model = event type, value column."""
    return MO.profile_metrics(t.events, "ts", "1 day", ["value"], model_col="event_type",
                              table_metrics={"avg_value": F.col("value")})


@query("metric_row_filter", W(S.PROFILE_TABLE_ROWS) + f"""
SELECT window_start, window_end, model_id, count, {S.r6('avg_value')} AS avg_value FROM profile_rows""")
def q_metric_row_filter(spark, d):
    p = CL.filter_metric_rows(profile(_t(spark, d)))
    return p.select("window_start", "window_end", "model_id", "count", "avg_value")


# ------------------------------------------------------------------ S: sources / sinks


@query("scan_parquet", """
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1998-01-01 00:00:00' AND l_returnflag = 'R'""")
def q_scan_parquet(spark, d):
    li = TB.read_path(spark, "parquet", f"{d}/lineitem.parquet")
    return li.where((F.col("l_shipdate") >= F.lit(dt.datetime(1998, 1, 1)).cast("timestamp_ntz"))
                    & (F.col("l_returnflag") == "R")) \
        .select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")


@query("csv_roundtrip", """
SELECT c_custkey AS customer_id, c_name AS name, c_acctbal AS account_balance, c_mktsegment AS market_segment
FROM customer""")
def q_csv_roundtrip(spark, d):
    t = _t(spark, d)
    path = scratch_path(spark, "bronze_csv")
    t.customer.select(F.col("c_custkey").alias("CustomerID"), F.col("c_name").alias("Name"),
                      F.col("c_acctbal").alias("AccountBalance"), F.col("c_mktsegment").alias("MarketSegment")) \
        .write.option("header", "true").csv(path)
    df = TB.ingest_csv(spark, path)
    return df.select(F.col("customer_id").cast("bigint"), F.col("name").cast("string"),
                     F.col("account_balance").cast("double"), F.col("market_segment").cast("string"))


@query("overwrite_roundtrip", """
SELECT c_custkey, c_acctbal, c_mktsegment, c_acctbal > 0 AS positive FROM customer""")
def q_overwrite_roundtrip(spark, d):
    t = _t(spark, d)
    name = f"ff_overwrite_{uuid.uuid4().hex[:10]}"
    loc = scratch_path(spark, name)
    TB.write_table(t.customer, name, location=loc)
    TB.write_table(t.customer.select("c_custkey", "c_acctbal", "c_mktsegment",
                                     (F.col("c_acctbal") > 0).alias("positive")), name, location=loc)
    return TB.read_table(spark, name)


@query("append_log", """
SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders""")
def q_append_log(spark, d):
    t = _t(spark, d)
    path = scratch_path(spark, "append_log")
    o = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    cut = F.lit(dt.datetime(1998, 1, 1)).cast("timestamp_ntz")
    TB.append_table(o.where(F.col("o_orderdate") < cut), path=path)
    TB.append_table(o.where(F.col("o_orderdate") >= cut), path=path)
    return spark.read.parquet(path)


@query("feature_table_empty", W(*SUB, S.CHURN_FEATURES) + "SELECT * FROM churn_features WHERE false")
def q_feature_table_empty(spark, d):
    t = _t(spark, d)
    schema = FX.churn_features(t).schema
    spec = FT.FeatureTableSpec("churn_features", ("customer_id", "transaction_ts"), "transaction_ts")
    return FT.create_feature_table(spark, spec, schema, scratch_path(spark, "feature_table"))


UPSERT_T1 = dt.datetime(1999, 1, 1)


def _snap(o, lo, hi, extra=False):
    c = o.where((F.col("o_orderdate") >= F.lit(lo).cast("timestamp_ntz"))
                & (F.col("o_orderdate") < F.lit(hi).cast("timestamp_ntz")))
    aggs = [F.count(F.lit(1)).alias("n_orders"), F.sum("o_totalprice").alias("spend")]
    if extra:
        aggs.append(F.max("o_totalprice").alias("max_price"))
    return c.groupBy(F.col("o_custkey").alias("customer_id")).agg(*aggs)


_SNAP_SQL = """
tgt AS (SELECT o_custkey AS customer_id, count(*) AS n_orders, sum(o_totalprice) AS spend FROM orders
        WHERE o_orderdate < TIMESTAMP '1999-01-01 00:00:00' GROUP BY 1),
upd AS (SELECT o_custkey AS customer_id, count(*) AS n_orders, sum(o_totalprice) AS spend,
               max(o_totalprice) AS max_price FROM orders
        WHERE o_orderdate >= TIMESTAMP '1999-01-01 00:00:00' AND o_orderdate < TIMESTAMP '2001-01-01 00:00:00'
        GROUP BY 1)"""


@query("feature_upsert", W(_SNAP_SQL) + f"""
SELECT coalesce(u.customer_id, t.customer_id) AS customer_id,
       CASE WHEN u.customer_id IS NOT NULL THEN u.n_orders ELSE t.n_orders END AS n_orders,
       {S.r4('CASE WHEN u.customer_id IS NOT NULL THEN u.spend ELSE t.spend END')} AS spend,
       u.max_price
FROM tgt t FULL OUTER JOIN upd u ON t.customer_id = u.customer_id""")
def q_feature_upsert(spark, d):
    o = _t(spark, d).orders
    target = _snap(o, dt.datetime(1900, 1, 1), UPSERT_T1)
    updates = _snap(o, UPSERT_T1, FX.CUTOFF, extra=True)
    once = FT.merge_features(target, updates, ["customer_id"])
    return once.withColumn("spend", C.round_metric("spend"))


@query("constraint_check", """
SELECT 'primary_key' AS "constraint", 'o_custkey,o_orderdate' AS "column",
       CAST(o_custkey AS VARCHAR) || '|' || CAST(o_orderdate AS VARCHAR) AS key, count(*) AS n
FROM orders GROUP BY o_custkey, o_orderdate HAVING count(*) > 1
UNION ALL
SELECT 'not_null', c, NULL, n FROM (
  SELECT 'o_custkey' AS c, count(*) FILTER (WHERE o_custkey IS NULL) AS n FROM orders
  UNION ALL SELECT 'o_orderdate', count(*) FILTER (WHERE o_orderdate IS NULL) FROM orders
  UNION ALL SELECT 'o_orderpriority', count(*) FILTER (WHERE o_orderpriority IS NULL) FROM orders) x
WHERE n > 0""")
def q_constraint_check(spark, d):
    return FT.check_constraints(_t(spark, d).orders, ["o_custkey", "o_orderdate"], ["o_orderpriority"])


@query("latest_snapshot", """
SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders) WHERE rn = 1""")
def q_latest_snapshot(spark, d):
    return FT.latest_snapshot(_t(spark, d).orders, ["o_custkey"], "o_orderdate", ["o_orderkey"])


_ACTIVE_SQL = """SELECT o_custkey AS customer_id, count(*) AS n_orders, max(o_totalprice) AS max_price FROM orders
        WHERE o_orderdate < TIMESTAMP '{hi}' GROUP BY 1 HAVING max(o_orderdate) >= TIMESTAMP '{lo}'"""


@query("table_changes", f"""
WITH old AS ({_ACTIVE_SQL.format(hi='1999-01-01 00:00:00', lo='1998-01-01 00:00:00')}),
new AS ({_ACTIVE_SQL.format(hi='2001-01-01 00:00:00', lo='2000-01-01 00:00:00')})
SELECT coalesce(n.customer_id, o.customer_id) AS customer_id,
       CASE WHEN o.customer_id IS NULL THEN 'insert' WHEN n.customer_id IS NULL THEN 'delete' ELSE 'update' END
         AS change_type,
       CASE WHEN n.customer_id IS NULL THEN o.n_orders ELSE n.n_orders END AS n_orders,
       CASE WHEN n.customer_id IS NULL THEN o.max_price ELSE n.max_price END AS max_price
FROM old o FULL OUTER JOIN new n ON o.customer_id = n.customer_id
WHERE o.customer_id IS NULL OR n.customer_id IS NULL
   OR o.n_orders IS DISTINCT FROM n.n_orders OR o.max_price IS DISTINCT FROM n.max_price""")
def q_table_changes(spark, d):
    """Change feed between two versions of an online table of *active* customers
    (at least one order in the year before the version date): customers who stop
    ordering are deleted, new ones inserted, the others updated when stats change."""
    o = _t(spark, d).orders

    def active_snapshot(hi):
        lo = hi.replace(year=hi.year - 1)
        c = o.where(F.col("o_orderdate") < F.lit(hi).cast("timestamp_ntz"))
        g = c.groupBy(F.col("o_custkey").alias("customer_id")).agg(
            F.count(F.lit(1)).alias("n_orders"), F.max("o_totalprice").alias("max_price"),
            F.max("o_orderdate").alias("_last"))
        return g.where(F.col("_last") >= F.lit(lo).cast("timestamp_ntz")).drop("_last")
    return FT.table_changes(active_snapshot(UPSERT_T1), active_snapshot(FX.CUTOFF), ["customer_id"])


# The synthetic inference columns (values, weights, ranges).
SYNTH_SPECS = {
    "internet_service": TB.Choice(("Fiber optic", "DSL", "No"), (0.5, 0.3, 0.2)),
    "contract": TB.Choice(("Month-to-month", "One year", "Two year"), (0.5, 0.25, 0.25)),
    "payment_method": TB.Choice(("Credit card (automatic)", "Mailed check", "Bank transfer (automatic)",
                                 "Electronic check"), (0.2, 0.2, 0.2, 0.4)),
    "tenure": TB.Steps(0.0, 72.0, 1.0),
    "monthly_charges": TB.Steps(18.0, 118.0, 0.5),
    "total_charges": TB.Steps(0.0, 8684.0, 20.0),
    "customer_code": TB.Template("dddd-AAAA"),
    "transaction_ts": TB.TimeSteps(dt.datetime(2024, 5, 1), dt.datetime(2024, 5, 30), 3600),
}


def _synth_sql() -> str:
    cols = []
    for name, spec in SYNTH_SPECS.items():
        salt = f"{name}:42"
        if isinstance(spec, TB.Choice):
            cols.append(f"{S.choice_sql('c_custkey', salt, spec.values, spec.weights)} AS {name}")
        elif isinstance(spec, TB.Steps):
            cols.append(f"{S.steps_sql('c_custkey', salt, spec.lo, spec.hi, spec.step)} AS {name}")
        elif isinstance(spec, TB.Template):
            cols.append(f"{S.template_sql('c_custkey', salt, spec.pattern)} AS {name}")
        else:
            b = int(spec.begin.replace(tzinfo=dt.timezone.utc).timestamp())
            e = int(spec.end.replace(tzinfo=dt.timezone.utc).timestamp())
            cols.append(f"{S.time_steps_sql('c_custkey', salt, b, e, spec.step_seconds)} AS {name}")
    return "SELECT c_custkey, " + ", ".join(cols) + " FROM customer"


@query("synthetic_rows", _synth_sql())
def q_synthetic_rows(spark, d):
    return TB.generate_table(_t(spark, d).customer, "c_custkey", SYNTH_SPECS, seed=42)


@query("unpack_json_props", """
SELECT event_id, ts, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""")
def q_unpack_json_props(spark, d):
    return TB.unpack_payload(FX.bronze_json(_t(spark, d)), "props", "k INT")
