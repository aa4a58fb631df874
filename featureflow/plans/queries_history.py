"""Registered queries for versioned tables (S8, S10, S11), row explanations (L7), as-of lookups over ranges
and on streams (X3)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from featureflow.functions import columns as C
from featureflow.operators import asof_ranges as AR
from featureflow.operators import clean as CL
from featureflow.operators import drift_windows as DW
from featureflow.operators import explain as EX
from featureflow.operators import ml as ML
from featureflow.operators import rollup as RU
from featureflow.operators import versioned as VT
from featureflow.plans import fixtures as FX
from featureflow.plans import queries_clean as QC
from featureflow.plans import sqlbits as S
from featureflow.plans.queries import _t
from featureflow.plans.queries_ml import LINEAR_B, LINEAR_W, _labeled
from featureflow.plans.registry import ORACLES, query
from featureflow.session import materialize, scratch_path
from featureflow.streaming import asof as SA
from featureflow.streaming import streams as ST

W = S.with_
r4 = C.round_metric


@query("feature_upsert_versions", ORACLES["feature_upsert"])
def q_feature_upsert_versions(spark, d):
    """The upsert of ``feature_upsert`` on a stored table, as two commits; the second one adds a column."""
    o = _t(spark, d).orders
    first = QC._snap(o, dt.datetime(1900, 1, 1), QC.UPSERT_T1)
    table = VT.VersionedTable.create(spark, scratch_path(spark, "versions"), first.schema, ["customer_id"], n_buckets=8)
    table.merge(first)
    table.merge(QC._snap(o, QC.UPSERT_T1, FX.CUTOFF, extra=True))
    return table.read().withColumn("spend", r4("spend"))


def _active(o, hi):
    """Customers with an order in the year before ``hi``."""
    c = o.where(F.col("o_orderdate") < F.lit(hi).cast("timestamp_ntz"))
    g = c.groupBy(F.col("o_custkey").alias("customer_id")).agg(
        F.count(F.lit(1)).alias("n_orders"), F.max("o_totalprice").alias("max_price"), F.max("o_orderdate").alias("last"))
    return g.where(F.col("last") >= F.lit(hi.replace(year=hi.year - 1)).cast("timestamp_ntz")).drop("last")


@query("table_changes_log", ORACLES["table_changes"])
def q_table_changes_log(spark, d):
    """The feed of ``table_changes`` between two stored versions, with a commit in between that changes nothing for good."""
    o = _t(spark, d).orders
    old, new = _active(o, QC.UPSERT_T1), _active(o, FX.CUTOFF)
    table = VT.VersionedTable.create(spark, scratch_path(spark, "versions"), old.schema, ["customer_id"], n_buckets=8)
    a = table.merge(old)
    table.merge(new)
    gone = table.read().select("customer_id").join(new.select("customer_id"), "customer_id", "left_anti")
    return table.changes(a, table.merge(deletes=gone))


@query("snapshot_refresh", """
SELECT o_custkey, o_orderkey, o_totalprice, o_orderdate FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders WHERE o_orderkey % 7 <> 0) WHERE rn = 1""")
def q_snapshot_refresh(spark, d):
    """Each customer's newest order, kept up over three feeds: early orders, later ones, then late rows and deletions."""
    o = _t(spark, d).orders.select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    late = F.coalesce(F.col("o_orderkey") % 5 == 0, F.lit(False))
    early = F.coalesce(F.col("o_orderdate") < F.lit(dt.datetime(1997, 1, 1)).cast("timestamp_ntz"), F.lit(True))
    orders = VT.VersionedTable.create(spark, scratch_path(spark, "versions"), o.schema, ["o_custkey", "o_orderkey"], 8, bucket_by=["o_custkey"])
    newest = VT.VersionedTable.create(spark, scratch_path(spark, "versions"), o.schema, ["o_custkey"], 8)
    gone = o.where(F.col("o_orderkey") % 7 == 0).select("o_custkey", "o_orderkey")
    for updates, deletes in ((o.where(early & ~late), None), (o.where(~early & ~late), None), (o.where(late & (F.col("o_orderkey") % 7 != 0)), gone)):
        before = orders.at().version
        VT.refresh_snapshot(orders, newest, before, orders.merge(updates, deletes), "o_orderdate", ["o_orderkey"])
    return newest.read()


def _explained_sql() -> str:
    cols = list(LINEAR_W)
    x = {c: f"coalesce(CAST({c} AS DOUBLE), 0)" for c in cols}
    means = ", ".join(f"avg({x[c]}) AS m_{c}" for c in cols)
    margin = " + ".join([f"{LINEAR_B}", *[f"{w} * {x[c]}" for c, w in LINEAR_W.items()]])
    base = " + ".join([f"{LINEAR_B}", *[f"{w} * m_{c}" for c, w in LINEAR_W.items()]])
    rows = " UNION ALL ".join(f"SELECT customer_id, '{c}' AS \"column\", {w} * ({x[c]} - m_{c}) AS value, {margin} AS output, {base} AS base FROM v, m"
                              for c, w in LINEAR_W.items())
    return W(S.SUBSCRIBERS, S.CHURN_FEATURES, S.CHURN_LABELS) + f"""
, j AS (SELECT l.customer_id, l.split, {", ".join(f"f.{c}" for c in cols)} FROM churn_labels l JOIN churn_features f ON l.customer_id = f.customer_id),
v AS (SELECT * FROM j WHERE split = 'validate'),
m AS (SELECT {means} FROM (SELECT * FROM j WHERE split = 'train' ORDER BY {S.hash32('customer_id', 'background:42')}, customer_id LIMIT 32))
SELECT customer_id, "column", {S.r4('value')} AS value, {S.r4('output')} AS output, {S.r4('base')} AS base FROM ({rows})"""


@query("row_explanations", _explained_sql())
def q_row_explanations(spark, d):
    """What each column adds to a row's margin, for a model of fixed weights: weight x (value - mean of the background)."""
    data = materialize(_labeled(_t(spark, d)).select("customer_id", "split", *LINEAR_W))
    model = ML.LinearModel(LINEAR_W, LINEAR_B, margin=True)
    background = EX.background_rows(CL.split_of(data, "train"), list(LINEAR_W), "customer_id")
    out = EX.shapley_values(CL.split_of(data, "validate").drop("split"), model, list(LINEAR_W), "customer_id", background, "margin")
    return out.select("customer_id", "column", *[r4(c).alias(c) for c in ("value", "output", "base")])


@query("pit_lookup_hot", """
WITH r AS (SELECT o_orderkey, CASE WHEN o_custkey % 3 = 0 THEN 0 ELSE o_custkey END AS k, o_totalprice,
                  CASE WHEN o_custkey % 3 = 0 THEN TIMESTAMP '2000-01-01 00:00:00' + to_seconds(o_orderkey % 3600) ELSE o_orderdate END AS ts FROM orders),
f AS (SELECT k, ts, max(o_orderkey) AS feature_order, arg_max(o_totalprice, o_orderkey) AS price FROM r WHERE o_orderkey % 2 = 0 GROUP BY ALL),
l AS (SELECT o_orderkey, k, ts FROM r WHERE o_orderkey % 2 = 1)
SELECT l.o_orderkey, l.k, l.ts, f.feature_order, f.price FROM l ASOF LEFT JOIN f ON l.k = f.k AND l.ts >= f.ts""")
def q_pit_lookup_hot(spark, d):
    """As-of lookup where one key has a third of all rows, all of them within an hour."""
    o = _t(spark, d).orders
    hot = F.col("o_custkey") % 3 == 0
    at = (F.lit(dt.datetime(2000, 1, 1)) + F.make_dt_interval(secs=F.col("o_orderkey") % 3600)).cast("timestamp_ntz")
    r = o.select("o_orderkey", F.when(hot, 0).otherwise(F.col("o_custkey")).cast("long").alias("k"), "o_totalprice",
                 F.when(hot, at).otherwise(F.col("o_orderdate").cast("timestamp_ntz")).alias("ts"))
    features = r.where("o_orderkey % 2 = 0").select("k", "ts", F.col("o_orderkey").alias("feature_order"), F.col("o_totalprice").alias("price"))
    return AR.lookup_asof_ranges(r.where("o_orderkey % 2 = 1").select("o_orderkey", "k", "ts"), features, ["k"], "ts", tie_breakers=["feature_order"])


ASOF_GROUP_ROWS = 10_000  # rows of a group of users over all steps: so many more groups as there are more rows


@query("stream_score_asof", f"""
WITH l AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'),
f AS (SELECT user_id, ts, arg_max(value, event_id) AS value FROM events WHERE event_type = 'click' GROUP BY ALL),
j AS (SELECT l.*, f.value FROM l ASOF LEFT JOIN f ON l.user_id = f.user_id AND l.ts >= f.ts),
w AS (SELECT (epoch_ms(max(ts)) - 3600000) * 1000 AS us FROM events WHERE event_type IN ('purchase', 'click'))
SELECT event_id, user_id, ts, value, {S.r4('1.0 / (1.0 + exp(-(-1.0 + 0.02 * coalesce(value, 0))))')} AS score
FROM j, w WHERE epoch_us(ts) < w.us""")
def q_stream_score_asof(spark, d):
    """Purchases scored on a stream with the value of the user's last click, landed and processed in six steps."""
    events = _t(spark, d).events.select("event_id", "ts", "user_id", "event_type", "value").where("event_type IN ('purchase', 'click')")
    src, out, ck = (scratch_path(spark, n) for n in ("events_asof", "stream_asof", "ck_asof"))
    first, last, n = events.agg(F.min("ts"), F.max("ts"), F.count(F.lit(1))).first()
    if first is None:
        return spark.createDataFrame([], "event_id bigint, user_id bigint, ts timestamp_ntz, value double, score double")
    model = ML.LinearModel({"value": 0.02}, -1.0)
    steps, groups = 6, max(64, n // ASOF_GROUP_ROWS)
    cuts = [first + (last - first) * i / steps for i in range(steps)] + [last + dt.timedelta(microseconds=1)]
    for a, b in zip(cuts, cuts[1:], strict=False):
        bound = lambda x: F.lit(x).cast("timestamp_ntz")
        events.where((F.col("ts") >= bound(a)) & (F.col("ts") < bound(b))).write.mode("append").parquet(src)
        stream = ST.read_stream(spark, src, events.schema, max_files=None)
        clicks = stream.where("event_type = 'click'").select("user_id", "ts", F.col("event_id").alias("click_id"), "value")
        bought = stream.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
        joined = SA.stream_asof(bought, clicks, ["user_id"], "ts", "ts", ["value"], "1 hour", ["click_id"], groups=groups)
        ST.stream_score(joined, lambda s: model.transform(s).select("event_id", "user_id", "ts", "value", r4("score").alias("score")), out, ck)
    return spark.read.parquet(out)


@query("profile_rollup", f"""
WITH b AS (SELECT date_trunc('day', ts) AS w, event_type, CAST(value AS DOUBLE) AS value, CAST(user_id AS DOUBLE) AS user_id FROM events),
u AS (SELECT w, event_type, 'value' AS column_name, value AS x FROM b UNION ALL SELECT w, event_type, 'user_id', user_id FROM b),
p AS (SELECT w, event_type, column_name, count(*) AS count, count(*) - count(x) AS num_nulls, {S.r6(S.r6('sum(x)') + ' / count(x)')} AS mean,
             {S.r6('stddev_samp(x)')} AS stddev, min(x) AS min, max(x) AS max
      FROM u GROUP BY GROUPING SETS ((w, event_type, column_name), (w, column_name)))
SELECT w AS window_start, coalesce(event_type, '*') AS event_type, column_name, count, num_nulls, mean, stddev, min, max, true AS sketches_fit FROM p""")
def q_profile_rollup(spark, d):
    """Days, by type and of all types, from stored states of hours. ``sketches_fit``: the distinct count is within 10 % of
    the exact one (six standard errors) and the median's rank within 5 % of a half."""
    events = _t(spark, d).events
    path = scratch_path(spark, "profile_states")
    RU.profile_states(events, "ts", "1 hour", ["value", "user_id"], ["event_type"]).write.parquet(path)
    states = spark.read.parquet(path)
    days = RU.roll_up(states, "1 day", ["event_type"])
    every = days.unionByName(RU.roll_up(states, "1 day").withColumn("event_type", F.lit("*")))
    p = RU.profile_of(every, {"median": 0.5})
    day = F.date_trunc("day", "ts").cast("timestamp_ntz").alias("window_start")
    x = F.explode(F.create_map(F.lit("value"), F.col("value").cast("double"), F.lit("user_id"), F.col("user_id").cast("double"))).alias("column_name", "x")
    rows = events.select(day, F.explode(F.array("event_type", F.lit("*"))).alias("event_type"), "value", "user_id").select("window_start", "event_type", x)
    rows = rows.join(p.select("window_start", "event_type", "column_name", "median"), ["window_start", "event_type", "column_name"])
    exact = rows.groupBy("window_start", "event_type", "column_name").agg(
        F.count_distinct("x").alias("d"), F.avg((F.col("x") < F.col("median")).cast("int")).alias("under"), F.avg((F.col("x") <= F.col("median")).cast("int")).alias("upto"))
    fit = (F.abs(F.col("num_distinct_approx") - F.col("d")) <= 0.1 * F.col("d") + 1) & (F.col("under") <= 0.55) & (F.col("upto") >= 0.45)
    return p.join(exact, ["window_start", "event_type", "column_name"]).select(
        "window_start", "event_type", "column_name", "count", "num_nulls", "mean", "stddev", "min", "max", fit.alias("sketches_fit"))


_DRIFT_ROWS = """
e AS (SELECT date_trunc('day', ts) AS w, CASE WHEN day(ts) = 10 AND event_type = 'signup' THEN 'brand new' WHEN day(ts) = 20 AND event_type = 'error' THEN NULL
             ELSE event_type END AS c FROM events WHERE day(ts) <> 15),
h AS (SELECT w, c, count(*) AS n FROM e GROUP BY ALL)"""


def _drift_sql(kind: str, refs: str) -> str:
    """``refs``: a table (w, c, m) of each window's reference."""
    return f"""
SELECT w AS window_start, '{kind}' AS drift_type, any_value(total) AS count, {S.r6('sum(abs(p - q)) / 2')} AS tv_distance,
       {S.r6('greatest(sum((CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2)) ELSE 0 END) / 2), 0)')} AS js_divergence,
       {S.r6('sum((greatest(p, 1e-4) - greatest(q, 1e-4)) * ln(greatest(p, 1e-4) / greatest(q, 1e-4)))')} AS psi,
       count(*) FILTER (WHERE q = 0) AS new_categories, count(*) FILTER (WHERE p = 0) AS gone_categories
FROM (SELECT coalesce(a.w, r.w) AS w, t.total, coalesce(a.n, 0) / t.total AS p, coalesce(r.m, 0) / rt.total AS q
      FROM h a FULL JOIN ({refs}) r ON a.w = r.w AND a.c IS NOT DISTINCT FROM r.c
      JOIN t ON t.w = coalesce(a.w, r.w) JOIN (SELECT w, sum(m) AS total FROM ({refs}) GROUP BY w) rt ON rt.w = coalesce(a.w, r.w)) GROUP BY w"""


@query("drift_over_windows", f"""
WITH {_DRIFT_ROWS},
t AS (SELECT w, sum(n)::BIGINT AS total FROM h GROUP BY w),
pv AS (SELECT w, lag(w) OVER (ORDER BY w) AS prev FROM t),
days AS (SELECT unnest(generate_series((SELECT min(w) FROM t), (SELECT max(w) FROM t), INTERVAL 1 DAY)) AS w),
m AS ({_drift_sql('consecutive', 'SELECT pv.w, x.c, x.n AS m FROM pv JOIN h x ON x.w = pv.prev')}
UNION ALL {_drift_sql('baseline', "SELECT t.w, x.c, x.m FROM t, (SELECT c, sum(n) AS m FROM h WHERE w < TIMESTAMP '2024-01-08 00:00:00' GROUP BY c) x")})
SELECT days.w AS window_start, k.drift_type, coalesce(t.total, 0) AS count, tv_distance, js_divergence, psi, new_categories, gone_categories
FROM days CROSS JOIN (SELECT unnest(['consecutive', 'baseline']) AS drift_type) k
LEFT JOIN t ON t.w = days.w LEFT JOIN m ON m.window_start = days.w AND m.drift_type = k.drift_type""")
def q_drift_over_windows(spark, d):
    """Daily drift of the event type, with a day of a new category, one of null categories and one without rows."""
    e, day = _t(spark, d).events, F.dayofmonth("ts")
    kind = F.when((day == 10) & (F.col("event_type") == "signup"), "brand new").when((day == 20) & (F.col("event_type") == "error"), F.lit(None)).otherwise(F.col("event_type"))
    path = scratch_path(spark, "window_histogram")
    DW.window_histogram(e.where(day != 15), "ts", "1 day", kind).write.parquet(path)
    hist = spark.read.parquet(path)
    baseline = hist.where(F.col("window_start") < F.lit(dt.datetime(2024, 1, 8)).cast("timestamp_ntz")).select("category", "n")
    return DW.drift_over_windows(hist, "1 day", baseline)
