"""Registered queries for joins (J), aggregations and metrics (A, W, T), monitoring
and promotion decisions (M)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from featureflow.functions import columns as C
from featureflow.operators import aggregate as AG
from featureflow.operators import lookup as LK
from featureflow.operators import metrics as MT
from featureflow.operators import monitor as MO
from featureflow.operators import promote as PR
from featureflow.operators.clean import filter_metric_rows
from featureflow.plans import fixtures as FX
from featureflow.plans import sqlbits as S
from featureflow.plans.queries import _t, training_set
from featureflow.plans.queries_clean import profile
from featureflow.plans.registry import query

W = S.with_
r4 = C.round_metric

# ------------------------------------------------------------------ J: joins and lookups


@query("join_exact", W(S.SUBSCRIBERS, S.CHURN_FEATURES, S.CHURN_LABELS) + """
SELECT l.customer_id, l.churn, l.split, f.tenure, f.num_optional_services
FROM churn_labels l JOIN churn_features f
  ON l.customer_id = f.customer_id AND l.transaction_ts = f.transaction_ts""")
def q_join_exact(spark, d):
    t = _t(spark, d)
    j = LK.join_exact(FX.churn_labels(t), FX.churn_features(t), ["customer_id", "transaction_ts"])
    return j.select("customer_id", "churn", "split", "tenure", "num_optional_services")


def _pit(t, **kw):
    feats = FX.pit_features(t)
    return LK.lookup_asof(FX.pit_labels(t), feats, ["user_id"], "ts", feature_ts="view_ts",
                          tie_breakers=["view_event_id"], **kw)


@query("pit_lookup", W(S.PIT) + """
SELECT l.event_id, l.user_id, l.ts, l.amount, f.view_event_id, f.view_value
FROM pit_labels l ASOF LEFT JOIN pit_features f ON l.user_id = f.user_id AND l.ts >= f.view_ts""")
def q_pit_lookup(spark, d):
    return _pit(_t(spark, d))


@query("pit_lookup_max_age", W(S.PIT) + """
SELECT l.event_id, l.user_id, l.ts, l.amount,
       CASE WHEN l.ts - f.view_ts > INTERVAL 2 DAY THEN NULL ELSE f.view_event_id END AS view_event_id,
       CASE WHEN l.ts - f.view_ts > INTERVAL 2 DAY THEN NULL ELSE f.view_value END AS view_value
FROM pit_labels l ASOF LEFT JOIN pit_features f ON l.user_id = f.user_id AND l.ts >= f.view_ts""")
def q_pit_lookup_max_age(spark, d):
    return _pit(_t(spark, d), max_age="2 days")


@query("lookup_latest", W(S.PIT) + """
, lv AS (SELECT user_id, view_event_id, view_value FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY view_ts DESC, view_event_id DESC) AS rn
    FROM pit_features) WHERE rn = 1)
SELECT l.event_id, l.user_id, l.amount, lv.view_event_id, lv.view_value
FROM pit_labels l LEFT JOIN lv ON l.user_id = lv.user_id""")
def q_lookup_latest(spark, d):
    t = _t(spark, d)
    lab = FX.pit_labels(t).select("event_id", "user_id", "amount")
    return LK.lookup_latest(lab, FX.pit_features(t), ["user_id"], "view_ts", ["view_event_id", "view_value"],
                            ["view_event_id"])


@query("training_set", W(S.SUBSCRIBERS, S.CHURN_FEATURES, S.CHURN_LABELS, S.MONTHLY) + f"""
SELECT l.customer_id, l.transaction_ts, l.churn, l.split, f.senior_citizen, f.tenure, f.monthly_charges,
       f.total_charges, {", ".join("f." + s for s in S.SERVICES)}, f.contract, f.num_optional_services,
       m.cum_orders, {S.r4('m.cum_spend')} AS cum_spend,
       {S.price_increase('f.monthly_charges', 'f.tenure', 'f.total_charges')} AS avg_price_increase
FROM churn_labels l
ASOF LEFT JOIN churn_features f ON l.customer_id = f.customer_id AND l.transaction_ts >= f.transaction_ts
ASOF LEFT JOIN monthly_features m ON l.customer_id = m.customer_id AND l.transaction_ts >= m.feature_ts""")
def q_training_set(spark, d):
    return training_set(_t(spark, d)).withColumn("cum_spend", r4("cum_spend"))


@query("attach_labels", """
SELECT d.doc_id, least(CAST(d.n_chars AS DOUBLE) / 5000.0, 1.0) AS score, l.quality
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def q_attach_labels(spark, d):
    t = _t(spark, d)
    scored = t.documents.select("doc_id", F.least(F.col("n_chars").cast("double") / 5000.0, F.lit(1.0)).alias("score"))
    return LK.attach_labels(scored, t.labels.select("doc_id", "quality"), ["doc_id"])


# ------------------------------------------------------------------ A / W / T


@query("row_count", """
SELECT count(*) AS n_rows, count(*) FILTER (WHERE l_returnflag = 'R') AS n_matching FROM lineitem""")
def q_row_count(spark, d):
    return AG.row_count(_t(spark, d).lineitem, F.col("l_returnflag") == "R")


@query("value_counts", "SELECT o_orderpriority, count(*) AS count FROM orders GROUP BY 1")
def q_value_counts(spark, d):
    return AG.value_counts(_t(spark, d).orders, "o_orderpriority")


_MODE_SQL = " UNION ALL ".join(
    f"SELECT '{s}' AS c, {s} AS v, count(*) AS n FROM subscribers WHERE {s} IS NOT NULL GROUP BY {s}"
    for s in S.SERVICES)


@query("impute_mode", W(S.SUBSCRIBERS) + f"""
, cnt AS ({_MODE_SQL}),
modes AS (SELECT c, v FROM (SELECT *, row_number() OVER (PARTITION BY c ORDER BY n DESC, v) AS rn FROM cnt)
          WHERE rn = 1)
SELECT customer_id, {", ".join(f"coalesce({s}, (SELECT v FROM modes WHERE c = '{s}')) AS {s}" for s in S.SERVICES)}
FROM subscribers""")
def q_impute_mode(spark, d):
    s = FX.subscribers(_t(spark, d)).select("customer_id", *S.SERVICES)
    return AG.impute_mode(s, S.SERVICES)


@query("impute_mean", W(S.SUBSCRIBERS) + f"""
SELECT customer_id, {S.r4('coalesce(tenure, avg(tenure) OVER ())')} AS tenure,
       {S.r4('coalesce(monthly_charges, avg(monthly_charges) OVER ())')} AS monthly_charges FROM subscribers""")
def q_impute_mean(spark, d):
    s = FX.subscribers(_t(spark, d)).select("customer_id", "tenure", "monthly_charges")
    out = AG.impute_mean(s, ["tenure", "monthly_charges"])
    return out.withColumns({c: r4(c) for c in ["tenure", "monthly_charges"]})


_STD_COLS = ["tenure", "monthly_charges", "total_charges"]


@query("standardize", W(S.SUBSCRIBERS, S.CHURN_FEATURES) + "SELECT customer_id, " + ", ".join(
    S.r4(f"({c} - avg({c}) OVER ()) / coalesce(nullif(stddev_pop({c}) OVER (), 0), 1)") + f" AS {c}"
    for c in _STD_COLS) + " FROM churn_features")
def q_standardize(spark, d):
    f = FX.churn_features(_t(spark, d)).select("customer_id", *_STD_COLS)
    return AG.standardize(f, _STD_COLS).withColumns({c: r4(c) for c in _STD_COLS})


@query("confusion_matrix", W(S.PREDICTIONS) + "SELECT label, prediction, count(*) AS n FROM predictions GROUP BY 1, 2")
def q_confusion_matrix(spark, d):
    return MT.confusion_matrix(FX.predictions(_t(spark, d)))


def _rates_sql(src: str, group: str = "") -> str:
    g = f"{group}, " if group else ""
    gb = f"GROUP BY {group}" if group else ""
    return f"""
SELECT {g}tp, fp, fn, tn,
  {S.r4('CASE WHEN tp + fp + fn + tn = 0 THEN 0 ELSE (tp + tn) / (tp + fp + fn + tn) END')} AS accuracy,
  {S.r4('CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END')} AS precision,
  {S.r4('CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END')} AS recall,
  {S.r4('CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END')} AS f1
FROM (SELECT {g}count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp,
             count(*) FILTER (WHERE label IS DISTINCT FROM 1 AND prediction = 1) AS fp,
             count(*) FILTER (WHERE label = 1 AND prediction IS DISTINCT FROM 1) AS fn,
             count(*) FILTER (WHERE label IS DISTINCT FROM 1 AND prediction IS DISTINCT FROM 1) AS tn
      FROM {src} {gb})"""


@query("binary_metrics", W(S.PREDICTIONS) + _rates_sql("predictions"))
def q_binary_metrics(spark, d):
    return MT.binary_metrics(FX.predictions(_t(spark, d)))


def _wf1_sql(group: str = "") -> str:
    g = f"{group}, " if group else ""
    return f"""
cm AS (SELECT {g}label, prediction, count(*) AS n FROM predictions WHERE label IS NOT NULL GROUP BY ALL),
sup AS (SELECT {g}label AS cls, sum(n) AS support, sum(CASE WHEN label = prediction THEN n ELSE 0 END) AS tp
        FROM cm GROUP BY ALL),
prd AS (SELECT {g}prediction AS cls, sum(n) AS predicted FROM cm GROUP BY ALL),
wf AS (SELECT {g.replace(group, 's.' + group) if group else ''}
         {S.r4('sum(CASE WHEN s.support + coalesce(p.predicted, 0) = 0 THEN 0 ELSE 2.0 * s.tp / (s.support + coalesce(p.predicted, 0)) END * s.support) / sum(s.support)')} AS weighted_f1
       FROM sup s LEFT JOIN prd p ON s.cls = p.cls {('AND s.' + group + ' = p.' + group) if group else ''}
       {('GROUP BY s.' + group) if group else ''})"""


@query("weighted_f1", W(S.PREDICTIONS, _wf1_sql()) + "SELECT weighted_f1 FROM wf")
def q_weighted_f1(spark, d):
    return MT.weighted_f1(FX.predictions(_t(spark, d)))


def _auc_sql(group: str = "") -> str:
    g = f"{group}, " if group else ""
    part = f"PARTITION BY {group}" if group else ""
    return f"""
sc AS (SELECT {g}score, count(*) FILTER (WHERE label = 1) AS pos,
              count(*) FILTER (WHERE label IS DISTINCT FROM 1) AS neg
       FROM predictions WHERE score IS NOT NULL GROUP BY ALL),
sc2 AS (SELECT *, coalesce(sum(neg) OVER ({part} ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
               AS below FROM sc),
auc AS (SELECT {g}{S.r4('CASE WHEN sum(pos) * sum(neg) = 0 THEN 0 ELSE sum(pos * (below + 0.5 * neg)) / (sum(pos) * sum(neg)) END')}
               AS auc FROM sc2 {('GROUP BY ' + group) if group else ''})"""


@query("roc_auc", W(S.PREDICTIONS, _auc_sql()) + "SELECT auc FROM auc")
def q_roc_auc(spark, d):
    return MT.roc_auc(FX.predictions(_t(spark, d)))


_CURVE_SQL = """
sc AS (SELECT score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label IS DISTINCT FROM 1) AS neg
       FROM predictions WHERE score IS NOT NULL GROUP BY score),
cu AS (SELECT score, sum(pos) OVER (ORDER BY score DESC) AS cp, sum(neg) OVER (ORDER BY score DESC) AS cn,
              sum(pos) OVER () AS P, sum(neg) OVER () AS N FROM sc)"""


@query("roc_points", W(S.PREDICTIONS, _CURVE_SQL) + f"""
SELECT score AS threshold, {S.r4('CASE WHEN P = 0 THEN 0 ELSE cp / P END')} AS tpr,
       {S.r4('CASE WHEN N = 0 THEN 0 ELSE cn / N END')} AS fpr FROM cu""")
def q_roc_points(spark, d):
    c = MT.roc_curve(FX.predictions(_t(spark, d)))
    return c.withColumns({"tpr": r4("tpr"), "fpr": r4("fpr")})


@query("pr_points", W(S.PREDICTIONS, _CURVE_SQL) + f"""
SELECT score AS threshold, {S.r4('CASE WHEN cp + cn = 0 THEN 0 ELSE cp / (cp + cn) END')} AS precision,
       {S.r4('CASE WHEN P = 0 THEN 0 ELSE cp / P END')} AS recall FROM cu""")
def q_pr_points(spark, d):
    c = MT.pr_curve(FX.predictions(_t(spark, d)))
    return c.withColumns({"precision": r4("precision"), "recall": r4("recall")})


_LOGLOSS = S.r4("-avg(CASE WHEN label = 1 THEN ln(least(greatest(score, 1e-15), 1 - 1e-15)) "
                "ELSE ln(1 - least(greatest(score, 1e-15), 1 - 1e-15)) END)")


@query("metrics_by_split", W(S.PREDICTIONS, _wf1_sql("split"), _auc_sql("split")) + f"""
, r AS ({_rates_sql('predictions', 'split')}),
ll AS (SELECT split, {_LOGLOSS} AS log_loss FROM predictions GROUP BY split)
SELECT r.*, wf.weighted_f1, ll.log_loss, auc.auc
FROM r LEFT JOIN wf ON r.split = wf.split LEFT JOIN ll ON r.split = ll.split LEFT JOIN auc ON r.split = auc.split""")
def q_metrics_by_split(spark, d):
    return MT.metrics_by_split(FX.predictions(_t(spark, d)))


WIN_LO, WIN_HI = dt.datetime(2024, 1, 3), dt.datetime(2024, 1, 10)


@query("sliding_features", f"""
WITH e AS (SELECT user_id, ts, value FROM events
           WHERE ts >= TIMESTAMP '2024-01-03 00:00:00' AND ts < TIMESTAMP '2024-01-10 00:00:00'),
x AS (SELECT user_id, value, time_bucket(INTERVAL 15 MINUTE, ts) - k * INTERVAL 15 MINUTE AS window_start
      FROM e, (SELECT unnest(range(4)) AS k))
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, user_id, count(*) AS n_rows,
       {S.r4('avg(value)')} AS avg_value
FROM x GROUP BY window_start, user_id""")
def q_sliding_features(spark, d):
    e = _t(spark, d).events
    out = MO.pane_window_features(e, ["user_id"], "ts", WIN_LO, WIN_HI, "1 hour", "15 minutes",
                                  {"n_rows": ("count", None), "avg_value": ("avg", "value")})
    return out.withColumn("avg_value", r4("avg_value"))


@query("tumbling_features", f"""
SELECT date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end, user_id,
       count(*) AS n_rows, {S.r4('sum(value)')} AS sum_value
FROM events WHERE ts >= TIMESTAMP '2024-01-03 00:00:00' AND ts < TIMESTAMP '2024-01-10 00:00:00'
GROUP BY 1, 2, user_id""")
def q_tumbling_features(spark, d):
    e = _t(spark, d).events
    return MO.window_features(e, ["user_id"], "ts", WIN_LO, WIN_HI, "1 day", None,
                              {"n_rows": F.count(F.lit(1)), "sum_value": r4(F.sum("value"))})


@query("profile_metrics", f"""
WITH b AS (SELECT date_trunc('day', ts) AS w, event_type, value FROM events),
cols AS (
  SELECT w, CASE WHEN grouping(event_type) = 1 THEN '*' ELSE event_type END AS model_id, 'value' AS column_name,
         count(*) AS count, count(*) FILTER (WHERE value IS NULL) AS num_nulls,
         {S.r6(S.r6('sum(value)') + ' / count(value)')} AS mean, {S.r6('stddev_samp(value)')} AS stddev, min(value) AS min, max(value) AS max,
         count(DISTINCT value) AS num_distinct, CAST(NULL AS DOUBLE) AS avg_value
  FROM b GROUP BY GROUPING SETS ((w, event_type), (w))),
tab AS (
  SELECT w, CASE WHEN grouping(event_type) = 1 THEN '*' ELSE event_type END AS model_id, ':table' AS column_name,
         count(*) AS count, CAST(NULL AS BIGINT) AS num_nulls, CAST(NULL AS DOUBLE) AS mean,
         CAST(NULL AS DOUBLE) AS stddev, CAST(NULL AS DOUBLE) AS min, CAST(NULL AS DOUBLE) AS max,
         CAST(NULL AS BIGINT) AS num_distinct, {S.r6(S.r6('sum(value)') + ' / count(value)')} AS avg_value
  FROM b GROUP BY GROUPING SETS ((w, event_type), (w)))
SELECT w AS window_start, w + INTERVAL 1 DAY AS window_end, CAST(NULL AS VARCHAR) AS slice_key,
       CAST(NULL AS VARCHAR) AS slice_value, column_name, count, num_nulls, mean, stddev, min, max, num_distinct,
       model_id, avg_value, 'INPUT' AS log_type
FROM (SELECT * FROM cols UNION ALL SELECT * FROM tab)""")
def q_profile_metrics(spark, d):
    return profile(_t(spark, d))


DRIFT_CUT = dt.datetime(2024, 1, 15)


def _halves(t):
    e = t.events
    cut = F.lit(DRIFT_CUT).cast("timestamp_ntz")
    return e.where(F.col("ts") < cut), e.where(F.col("ts") >= cut)


@query("drift_psi", f"""
WITH b AS (SELECT event_type AS v, count(*) AS nb FROM events WHERE ts < TIMESTAMP '2024-01-15 00:00:00' GROUP BY 1),
c AS (SELECT event_type AS v, count(*) AS nc FROM events WHERE ts >= TIMESTAMP '2024-01-15 00:00:00' GROUP BY 1),
j AS (SELECT coalesce(b.nb, 0) AS nb, coalesce(c.nc, 0) AS nc FROM b FULL OUTER JOIN c ON b.v IS NOT DISTINCT FROM c.v),
p AS (SELECT nb, nc, CAST(nb AS DOUBLE) / sum(nb) OVER () AS pb, CAST(nc AS DOUBLE) / sum(nc) OVER () AS pc,
             sum(nc) OVER () AS tot_c FROM j)
SELECT 'event_type' AS column_name,
  {S.r4('sum((greatest(pc, 1e-4) - greatest(pb, 1e-4)) * ln(greatest(pc, 1e-4) / greatest(pb, 1e-4)))')} AS psi,
  {S.r4('sum(CASE WHEN pb > 0 THEN pb * log2(pb / ((pb + pc) / 2)) ELSE 0 END + CASE WHEN pc > 0 THEN pc * log2(pc / ((pb + pc) / 2)) ELSE 0 END) / 2')} AS js_divergence,
  {S.r4('sum(CASE WHEN pb * tot_c > 0 THEN power(nc - pb * tot_c, 2) / (pb * tot_c) ELSE 0 END)')} AS chi_square
FROM p""")
def q_drift_psi(spark, d):
    b, c = _halves(_t(spark, d))
    return MO.drift_categorical(b, c, "event_type")


@query("drift_ks", f"""
WITH u AS (SELECT value AS x, CASE WHEN ts < TIMESTAMP '2024-01-15 00:00:00' THEN 1 ELSE 0 END AS ib,
                  CASE WHEN ts < TIMESTAMP '2024-01-15 00:00:00' THEN 0 ELSE 1 END AS ic
           FROM events WHERE value IS NOT NULL),
g AS (SELECT x, sum(ib) AS nb, sum(ic) AS nc FROM u GROUP BY x),
c AS (SELECT sum(nb) OVER (ORDER BY x) AS cb, sum(nc) OVER (ORDER BY x) AS cc,
             sum(nb) OVER () AS tot_b, sum(nc) OVER () AS tot_c FROM g)
SELECT 'value' AS column_name, {S.r4('max(abs(cb / tot_b - cc / tot_c))')} AS ks FROM c""")
def q_drift_ks(spark, d):
    b, c = _halves(_t(spark, d))
    return MO.drift_ks(b, c, "value")


def _drift_sql() -> str:
    cut = "TIMESTAMP '2024-01-15 00:00:00'"
    shares = f"""
g_{{0}} AS (SELECT {{1}} AS v, count(*) FILTER (WHERE ts < {cut}) AS nb, count(*) FILTER (WHERE ts >= {cut}) AS nc FROM d GROUP BY 1),
p_{{0}} AS (SELECT nb, nc, nb / sum(nb) OVER () AS pb, nc / sum(nc) OVER () AS pc, sum(nc) OVER () AS tot_c FROM g_{{0}}),
m_{{0}} AS (SELECT
  {S.r4('sum((greatest(pc, 1e-4) - greatest(pb, 1e-4)) * ln(greatest(pc, 1e-4) / greatest(pb, 1e-4)))')} AS psi,
  {S.r4('sum(CASE WHEN pb > 0 THEN pb * log2(pb / ((pb + pc) / 2)) ELSE 0 END + CASE WHEN pc > 0 THEN pc * log2(pc / ((pb + pc) / 2)) ELSE 0 END) / 2')} AS js_divergence,
  {S.r4('sum(CASE WHEN pb * tot_c > 0 THEN power(nc - pb * tot_c, 2) / (pb * tot_c) ELSE 0 END)')} AS chi_square FROM p_{{0}})"""
    ks = f"""
k_{{0}} AS (SELECT {{1}} AS x, count(*) FILTER (WHERE ts < {cut}) AS nb, count(*) FILTER (WHERE ts >= {cut}) AS nc FROM d WHERE {{1}} IS NOT NULL GROUP BY 1),
c_{{0}} AS (SELECT sum(nb) OVER (ORDER BY x) AS cb, sum(nc) OVER (ORDER BY x) AS cc, sum(nb) OVER () AS tb, sum(nc) OVER () AS tc FROM k_{{0}}),
s_{{0}} AS (SELECT {S.r4('max(abs(cb / tb - cc / tc))')} AS ks FROM c_{{0}})"""
    parts = [shares.format(c, c) for c in ("event_type", "tier")] + [ks.format(c, c) for c in ("value", "user_id")]
    rows = [f"SELECT '{c}' AS column_name, '{m}' AS metric, {m} AS value FROM m_{c}"
            for c in ("event_type", "tier") for m in ("psi", "js_divergence", "chi_square")]
    rows += [f"SELECT '{c}', 'ks', ks FROM s_{c}" for c in ("value", "user_id")]
    d = "WITH d AS (SELECT ts, event_type, CASE WHEN user_id % 3 > 0 THEN 't' || (user_id % 3) END AS tier, value, user_id FROM events)"
    return d + "," + ",".join(parts) + " " + " UNION ALL ".join(rows)


@query("drift_metrics", _drift_sql())
def q_drift_metrics(spark, d):
    """Two category columns (one with nulls) and two numeric ones at once."""
    def tiered(e):
        third = F.col("user_id") % 3
        return e.withColumn("tier", F.when(third > 0, F.concat(F.lit("t"), third.cast("string"))))
    b, c = _halves(_t(spark, d))
    return MO.drift_metrics(tiered(b), tiered(c), ["event_type", "tier", "value", "user_id"])


@query("profile_quality", f"""
WITH b AS (SELECT date_trunc('day', ts) AS w, CAST(user_id % 3 AS VARCHAR) AS model, event_type, power(value - user_id % 50, 2) AS se,
                  coalesce(event_type = 'purchase', false) AS y, coalesce(value > 25, false) AS p FROM events),
s AS (SELECT *, CAST(NULL AS VARCHAR) AS slice_key, CAST(NULL AS VARCHAR) AS slice_value FROM b
      UNION ALL SELECT *, 'event_type', event_type FROM b),
g AS (SELECT w, CASE WHEN grouping(model) = 1 THEN '*' ELSE model END AS model_id, slice_key, slice_value, count(*) AS count,
             {S.r6('sum(se)')} AS se, count(se) AS n_se, count(*) FILTER (WHERE p AND y) AS tp,
             count(*) FILTER (WHERE p AND NOT y) AS fp, count(*) FILTER (WHERE y AND NOT p) AS fn
      FROM s GROUP BY GROUPING SETS ((w, slice_key, slice_value, model), (w, slice_key, slice_value)))
SELECT w AS window_start, model_id, slice_key, slice_value, count,
       {S.r6('sqrt(' + S.r6('se / n_se') + ')')} AS root_mean_squared_error,
       {S.r6('CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END')} AS precision,
       {S.r6('CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END')} AS recall,
       {S.r6('CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END')} AS f1
FROM g""")
def q_profile_quality(spark, d):
    """Model quality a day, model and slice: the table rows of a sliced profile."""
    e = _t(spark, d).events
    scored = e.select("ts", "event_type", "value", (F.col("user_id") % 3).alias("model"), (F.col("user_id") % 50).alias("expected"),
                      (F.col("event_type") == "purchase").alias("bought"), (F.col("value") > 25).alias("predicted"))
    quality = {"root_mean_squared_error": ("rmse", "expected", "value")}
    quality |= {k: (k, "predicted", "bought") for k in ("precision", "recall", "f1")}
    p = MO.profile_metrics(scored, "ts", "1 day", ["value"], "model", ["event_type"], quality=quality)
    return p.where(F.col("column_name") == ":table").select("window_start", "model_id", "slice_key", "slice_value", "count", *quality)


@query("latest_per_key", W(S.MODEL_INFO) + """
SELECT model_name, model_version, f1_score, validation_timestamp, event_id FROM (
  SELECT *, row_number() OVER (PARTITION BY model_name, model_version ORDER BY validation_timestamp DESC) AS rn
  FROM model_info) WHERE rn = 1""")
def q_latest_per_key(spark, d):
    return AG.latest_per_key(FX.model_info(_t(spark, d)), ["model_name", "model_version"], ["validation_timestamp"])


@query("recent_windows", W(S.PROFILE_TABLE_ROWS) + f"""
SELECT window_start, model_id, {S.r6('avg_value')} AS avg_value FROM profile_rows
ORDER BY window_start DESC, model_id LIMIT 5""")
def q_recent_windows(spark, d):
    p = filter_metric_rows(profile(_t(spark, d)))
    return AG.recent_windows(p, 5, "window_start", ["model_id"]).select("window_start", "model_id", "avg_value")


def _runs(t):
    e = t.events
    return e.select(F.col("event_id").alias("run_id"),
                    F.when(F.col("event_type") == "error", "FAILED").otherwise("FINISHED").alias("status"),
                    F.col("value").alias("val_f1"))


@query("best_run", """
SELECT event_id AS run_id, 'FINISHED' AS status, value AS val_f1 FROM events
WHERE event_type <> 'error' AND value IS NOT NULL ORDER BY value DESC, event_id LIMIT 1""")
def q_best_run(spark, d):
    return AG.best_run(_runs(_t(spark, d)), "val_f1")


@query("sample_n", f"""
SELECT c_custkey, c_name FROM customer ORDER BY {S.hash32('c_custkey', 'sample:42')}, c_custkey LIMIT 100""")
def q_sample_n(spark, d):
    return AG.sample_n(_t(spark, d).customer.select("c_custkey", "c_name"), 100, "c_custkey", 42)


# ------------------------------------------------------------------ M: monitoring / promotion

THRESHOLD = 25.0


@query("metric_violation", W(S.PROFILE_TABLE_ROWS) + f"""
, recent AS (SELECT window_start, model_id, {S.r6('avg_value')} AS m FROM profile_rows
             ORDER BY window_start DESC, model_id LIMIT 5)
SELECT CASE WHEN (SELECT count(*) FROM recent WHERE m > {THRESHOLD}) >= 2
             AND (SELECT m FROM recent ORDER BY window_start DESC, model_id LIMIT 1) > {THRESHOLD}
            THEN 1 ELSE 0 END AS query_result""")
def q_metric_violation(spark, d):
    return MO.metric_violated(profile(_t(spark, d)), "avg_value", THRESHOLD, 5, 2)


@query("metric_violation_by_model", W(S.PROFILE_TABLE_ROWS) + f"""
, r AS (SELECT model_id, {S.r6('avg_value')} AS m,
               row_number() OVER (PARTITION BY model_id ORDER BY window_start DESC) AS rn FROM profile_rows)
SELECT model_id, count(*) AS n_windows, count(*) FILTER (WHERE m > {THRESHOLD}) AS n_violations,
       CASE WHEN count(*) FILTER (WHERE m > {THRESHOLD}) >= 2
             AND coalesce(max(CASE WHEN rn = 1 THEN m > {THRESHOLD} END), false) THEN 1 ELSE 0 END AS violated
FROM r WHERE rn <= 5 GROUP BY model_id""")
def q_metric_violation_by_model(spark, d):
    return MO.violations_by(profile(_t(spark, d)), ["model_id"], "avg_value", THRESHOLD, 5, 2)


def _aliases(t):
    return FX.model_info(t).select("model_name").distinct().select(
        "model_name", F.lit(0).cast("bigint").alias("champion_version"),
        F.lit(1).cast("bigint").alias("challenger_version"))


_CHAMP_SQL = W(S.MODEL_INFO) + """
, cand AS (SELECT m.*, CASE WHEN model_version = 0 THEN 'champion' ELSE 'challenger' END AS previous_alias
           FROM model_info m WHERE model_version IN (0, 1)),
latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY model_name, model_version
                                                      ORDER BY validation_timestamp DESC) AS rn FROM cand)
           WHERE rn = 1),
dec AS (SELECT model_name, model_version, f1_score, previous_alias,
               CASE WHEN row_number() OVER (PARTITION BY model_name ORDER BY f1_score DESC,
                                             CASE WHEN previous_alias = 'champion' THEN 0 ELSE 1 END) = 1
                    THEN 'champion' ELSE 'challenger' END AS new_alias
        FROM latest)"""


@query("choose_champion", _CHAMP_SQL + """
SELECT *, previous_alias <> new_alias AS changed FROM dec""")
def q_choose_champion(spark, d):
    t = _t(spark, d)
    return PR.choose_champion(FX.model_info(t), _aliases(t))


DECISION_AT = dt.datetime(2024, 2, 1, 7, 0, 0)


@query("alias_history", _CHAMP_SQL + """
, chg AS (SELECT model_name, max(CASE WHEN previous_alias <> new_alias THEN 1 ELSE 0 END) AS c FROM dec GROUP BY 1),
d AS (SELECT dec.*, chg.c FROM dec JOIN chg USING (model_name))
SELECT model_name, model_version, 'alias' AS kind, new_alias AS name, CAST(NULL AS VARCHAR) AS value FROM d
UNION ALL SELECT model_name, model_version, 'alias', 'prior_champion', NULL FROM d
  WHERE c = 1 AND previous_alias = 'champion'
UNION ALL SELECT model_name, model_version, 'tag', 'status', 'demoted_to_prior_champion' FROM d
  WHERE c = 1 AND previous_alias = 'champion'
UNION ALL SELECT model_name, model_version, 'tag', 'demoted_on', '2024-02-01 07:00:00' FROM d
  WHERE c = 1 AND previous_alias = 'champion'
UNION ALL SELECT model_name, model_version, 'tag', 'status', 'promoted_to_champion' FROM d
  WHERE c = 1 AND new_alias = 'champion'
UNION ALL SELECT model_name, model_version, 'tag', 'promoted_on', '2024-02-01 07:00:00' FROM d
  WHERE c = 1 AND new_alias = 'champion'""")
def q_alias_history(spark, d):
    t = _t(spark, d)
    return PR.apply_aliases(PR.choose_champion(FX.model_info(t), _aliases(t)), DECISION_AT)


@query("register_version", W(S.MODEL_INFO) + """
, v AS (SELECT DISTINCT model_name, model_version FROM model_info),
r AS (SELECT *, row_number() OVER (PARTITION BY model_name ORDER BY model_version) AS f,
             row_number() OVER (PARTITION BY model_name ORDER BY model_version DESC) AS l FROM v)
SELECT model_name, model_version,
       CASE WHEN f = 1 THEN 'champion' WHEN l = 1 THEN 'challenger' END AS alias,
       CASE WHEN f = 1 THEN 'true' ELSE 'false' END AS first_version
FROM r""")
def q_register_version(spark, d):
    v = FX.model_info(_t(spark, d)).select("model_name", "model_version").distinct()
    r = PR.initial_aliases(v)
    return r.select("model_name", "model_version", "alias", F.col("tags")["first_version"].alias("first_version"))


VALIDATED_AT = dt.datetime(2024, 3, 1, 7, 0, 0)


@query("validation_row", W(S.PREDICTIONS) + f"""
, c AS (SELECT count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp,
               count(*) FILTER (WHERE label IS DISTINCT FROM 1 AND prediction = 1) AS fp,
               count(*) FILTER (WHERE label = 1 AND prediction IS DISTINCT FROM 1) AS fn
        FROM predictions WHERE split = 'test')
SELECT 'doc_quality' AS model_name, CAST(2 AS BIGINT) AS model_version,
       {S.r4('CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END')} AS f1_score,
       'binary_f1' AS metric, 'challenger' AS model_alias, 'length_rule' AS modeling_method,
       TIMESTAMP '2024-03-01 07:00:00' AS validation_timestamp FROM c""")
def q_validation_row(spark, d):
    return PR.validation_record(FX.predictions(_t(spark, d)), "doc_quality", 2, "challenger", "length_rule",
                                VALIDATED_AT)


@query("deploy_version", W(S.MODEL_INFO) + """
, v AS (SELECT DISTINCT model_name, model_version FROM model_info),
r AS (SELECT *, row_number() OVER (PARTITION BY model_name ORDER BY model_version) AS f,
             row_number() OVER (PARTITION BY model_name ORDER BY model_version DESC) AS l FROM v),
reg AS (SELECT model_name, model_version,
               CASE WHEN f = 1 THEN 'champion' WHEN l = 1 THEN 'challenger' END AS alias FROM r),
dep AS (SELECT model_name, model_version AS d FROM reg WHERE alias = 'challenger' AND model_name <> 'error')
SELECT reg.model_name, reg.model_version,
       CASE WHEN dep.d IS NOT NULL AND reg.model_version = dep.d THEN 'champion'
            WHEN dep.d IS NOT NULL AND reg.alias = 'champion' THEN NULL
            ELSE reg.alias END AS alias
FROM reg LEFT JOIN dep ON reg.model_name = dep.model_name""")
def q_deploy_version(spark, d):
    """Register every version, then deploy each model's challenger (models other than
    'error'): it becomes champion, the old champion loses its alias."""
    v = FX.model_info(_t(spark, d)).select("model_name", "model_version").distinct()
    reg = PR.initial_aliases(v).select("model_name", "model_version", "alias")
    chosen = reg.where((F.col("alias") == PR.CHALLENGER) & (F.col("model_name") != "error"))
    return PR.deploy_version(reg, chosen.select("model_name", "model_version"))
