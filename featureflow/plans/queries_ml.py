"""Registered queries for ML on DataFrames (L), UDF/SQL-function surface (U) and
Structured Streaming (X)."""

from __future__ import annotations


from pyspark.sql import functions as F

from featureflow.functions import columns as C
from featureflow.functions.sql import register_sql_functions
from featureflow.functions.udfs import ceil_udf, flags_udf
from featureflow.operators import clean as CL
from featureflow.operators import lookup as LK
from featureflow.operators import ml as ML
from featureflow.plans import fixtures as FX
from featureflow.plans import sqlbits as S
from featureflow.plans.queries import _t, training_set
from featureflow.plans.registry import query
from featureflow.session import materialize, scratch_path
from featureflow.streaming import streams as ST

W = S.with_
r4 = C.round_metric

# Model inputs available on the training set (bool / numeric / categorical).
BOOL = ["senior_citizen"]
NUM = ["tenure", "monthly_charges", "total_charges", "num_optional_services", "avg_price_increase"]
CAT = ["contract", "online_security"]
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def _labeled(t):
    ts = training_set(t)
    return ts.withColumn("label", C.decode_label("churn"))


def _model_input(t):
    """Training set with label, preprocessed with statistics fitted on the train split,
    materialised once: every fit / search / scoring job below reads it."""
    data = materialize(_labeled(t).select("customer_id", "split", "label", *BOOL, *NUM, *CAT))
    pre = ML.preprocess_fit(CL.split_of(data, "train"), BOOL, NUM, CAT)
    return materialize(pre.transform(data)), pre.feature_columns()


@query("one_hot", W(S.SUBSCRIBERS, S.CHURN_FEATURES) + "SELECT customer_id, "
       + "CAST(senior_citizen = 'Yes' AND senior_citizen IS NOT NULL AS DOUBLE) AS senior_citizen_yes, "
       + ", ".join(f"CAST(coalesce(contract = '{s}', false) AS DOUBLE) AS contract_{s.lower()}" for s in SEGMENTS)
       + ", CAST(contract IS NULL OR contract NOT IN (" + ", ".join(f"'{s}'" for s in SEGMENTS)
       + ") AS DOUBLE) AS contract_unknown, "
       + "CAST(coalesce(online_security = 'No', false) AS DOUBLE) AS online_security_no, "
       + "CAST(coalesce(online_security = 'Yes', false) AS DOUBLE) AS online_security_yes, "
       + "CAST(online_security IS NULL OR online_security NOT IN ('No', 'Yes') AS DOUBLE) "
       + "AS online_security_unknown FROM churn_features")
def q_one_hot(spark, d):
    f = FX.churn_features(_t(spark, d)).select("customer_id", *BOOL, *CAT)
    levels = ML.fit_levels(f, [*BOOL, *CAT])
    return ML.one_hot(f, levels, drop_first=BOOL, unknown_indicator=CAT)


def _std_sql(c: str) -> str:
    x = f"coalesce({c}, (SELECT avg({c}) FROM tr))"
    return S.r4(f"({x} - (SELECT avg(coalesce({c}, (SELECT avg({c}) FROM tr))) FROM tr)) / "
                f"(SELECT coalesce(nullif(stddev_pop(coalesce({c}, (SELECT avg({c}) FROM tr))), 0), 1) FROM tr)")


@query("preprocess", W(S.SUBSCRIBERS, S.CHURN_FEATURES, S.CHURN_LABELS) + f"""
, base AS (SELECT l.customer_id, l.split, f.tenure, f.monthly_charges, f.total_charges, f.num_optional_services,
                  {S.price_increase('f.monthly_charges', 'f.tenure', 'f.total_charges')} AS avg_price_increase
           FROM churn_labels l JOIN churn_features f ON l.customer_id = f.customer_id),
tr AS (SELECT * FROM base WHERE split = 'train')
SELECT customer_id, {", ".join(_std_sql(c) + " AS " + c for c in NUM)} FROM base""")
def q_preprocess(spark, d):
    t = _t(spark, d)
    base = _labeled(t).select("customer_id", "split", *NUM)
    pre = ML.preprocess_fit(CL.split_of(base, "train"), [], NUM, [])
    out = pre.transform(base).select("customer_id", *NUM)
    return out.withColumns({c: r4(c) for c in NUM})


def _fit_gbt(t, params=None):
    x, feats = _model_input(t)
    model = ML.train_gbt(CL.split_of(x, "train"), CL.split_of(x, "validate"), feats, "label",
                         params or {"maxIter": 20, "maxDepth": 3})
    return model, x, feats


@query("gbt_scores", W(S.SUBSCRIBERS, S.CHURN_LABELS) + """
SELECT customer_id, CAST(churn = 'Yes' AS DOUBLE) AS label, true AS score_in_range, true AS follows_score
FROM churn_labels WHERE split = 'test'""")
def q_gbt_scores(spark, d):
    """Every test row with its label, and whether score and prediction are what they must be."""
    model, x, _ = _fit_gbt(_t(spark, d))
    s = ML.score_batch(CL.split_of(x, "test"), model, ["customer_id", "label"])
    return s.select("customer_id", "label", F.col("score").between(0.0, 1.0).alias("score_in_range"),
                    ((F.col("score") > 0.5) == (F.col("prediction") == 1)).alias("follows_score"))


@query("search_trials", f"""
SELECT CAST(trial AS INTEGER) AS trial, true AS loss_in_range,
       CAST(round(2 + 3 * ({S.hash32('trial', '0:42')} / 4294967296.0)) AS INTEGER) AS max_depth,
       {S.r4(f"exp(ln(0.05) + (ln(0.3) - ln(0.05)) * ({S.hash32('trial', '1:42')} / 4294967296.0))")} AS step_size
FROM range(2) r(trial)""")
def q_search_trials(spark, d):
    x, feats = _model_input(_t(spark, d))
    tr, va = CL.split_of(x, "train"), CL.split_of(x, "validate")

    def objective(params):
        model = ML.train_gbt(tr, va, feats, "label", {"maxIter": 10, **params})  # stops early on the validation rows
        m = ML.MT.binary_metrics(model.transform(va), "label", "prediction", 1.0).first()
        return -float(m["f1"])

    space = {"maxDepth": ("quniform", 2, 5, 1), "stepSize": ("loguniform", 0.05, 0.3)}
    trials = ML.random_search(space, 2, objective, seed=42)
    rows = [(tr_["trial"], tr_["loss"], int(tr_["params"]["maxDepth"]), float(tr_["params"]["stepSize"]))
            for tr_ in trials]
    out = spark.createDataFrame(rows, "trial int, loss double, max_depth int, step_size double")
    return out.select("trial", F.col("loss").between(-1.0, 0.0).alias("loss_in_range"), "max_depth",
                      r4("step_size").alias("step_size"))


@query("bake_off", W(S.SUBSCRIBERS, S.CHURN_LABELS) + """
SELECT family, count(*) AS n_rows, count(*) FILTER (WHERE churn = 'Yes') AS n_positive, true AS f1_in_range
FROM churn_labels, (VALUES ('logistic_regression'), ('random_forest'), ('gbt')) f(family)
WHERE split = 'validate' GROUP BY family""")
def q_bake_off(spark, d):
    x, feats = _model_input(_t(spark, d))
    res = ML.bake_off(CL.split_of(x, "train"), CL.split_of(x, "validate"), feats, "label")
    return spark.createDataFrame([(r["family"], r["rows"], r["positives"], 0.0 <= r["f1"] <= 1.0) for r in res],
                                 "family string, n_rows bigint, n_positive bigint, f1_in_range boolean")


PLANTED_SERVICES = 3  # the planted label: this many optional services or more


@query("score_batch", W(S.SUBSCRIBERS, S.CHURN_FEATURES, S.CHURN_LABELS) + f"""
SELECT l.customer_id, l.split, CASE WHEN f.num_optional_services >= {PLANTED_SERVICES} THEN 'Yes' ELSE 'No' END AS prediction,
       true AS score_in_range
FROM churn_labels l JOIN churn_features f ON l.customer_id = f.customer_id""")
def q_score_batch(spark, d):
    """Boosted trees learn a planted rule; the model is stored, loaded and given ids and times alone: it looks
    up its features, so every prediction must equal the rule."""
    labels, features = FX.churn_tables(_t(spark, d))
    ids = labels.drop("churn")
    lookups = [LK.FeatureLookup(features, ["customer_id"], "transaction_ts")]
    functions = [LK.FeatureFunction(C.price_increase, {"monthly": "monthly_charges", "tenure": "tenure",
                                                       "total": "total_charges"}, "avg_price_increase")]
    known = LK.create_training_set(ids, lookups, functions)
    data = materialize(known.withColumn("label", (F.col("num_optional_services") >= PLANTED_SERVICES).cast("double")))
    pre = ML.preprocess_fit(CL.split_of(data, "train"), BOOL, NUM, CAT)
    x = materialize(pre.transform(data))
    model = ML.train_gbt(CL.split_of(x, "train"), CL.split_of(x, "validate"), pre.feature_columns(), "label",
                         {"maxIter": 5, "maxDepth": 2})
    path = scratch_path(spark, "scoring_model")
    ML.ScoringModel(pre, model).save(spark, path)
    s = ML.score_batch(ids, ML.ScoringModel.load(spark, path), ["customer_id", "split"], lookups, functions, ("No", "Yes"))
    return s.select("customer_id", "split", "prediction", F.col("score").between(0.0, 1.0).alias("score_in_range"))


# Fixed weights of the linear scoring check (our choice).
LINEAR_W = {"tenure": -0.05, "num_optional_services": -0.2, "monthly_charges": 0.00001}
LINEAR_B = 0.5


@query("score_linear", W(S.SUBSCRIBERS, S.CHURN_FEATURES) + f"""
, z AS (SELECT customer_id, {LINEAR_B} + {LINEAR_W['tenure']} * coalesce(tenure, 0)
          + {LINEAR_W['num_optional_services']} * coalesce(CAST(num_optional_services AS DOUBLE), 0)
          + {LINEAR_W['monthly_charges']} * coalesce(monthly_charges, 0) AS z FROM churn_features)
SELECT customer_id, {S.r4('1.0 / (1.0 + exp(-z))')} AS score,
       CAST(1.0 / (1.0 + exp(-z)) > 0.5 AS INTEGER) AS prediction FROM z""")
def q_score_linear(spark, d):
    f = FX.churn_features(_t(spark, d)).select("customer_id", *LINEAR_W.keys())
    s = ML.score_linear(f, LINEAR_W, LINEAR_B)
    return s.select("customer_id", r4("score").alias("score"), "prediction")


def _importance_sql() -> str:
    """Rows of the validate split with every column's cyclic shift, scored once as they are and once a column."""
    cols = [*LINEAR_W, "contract"]
    moved = ", ".join(f"coalesce(lead({c}) OVER o, first({c}) OVER o) AS p_{c}" for c in cols)

    def cells(name, swap):
        z = " + ".join([f"{LINEAR_B}", *[f"{w} * {'p_' if c == swap else ''}{c}" for c, w in LINEAR_W.items()]])
        return (f"SELECT '{name}' AS variant, count(*) FILTER (WHERE y AND p) AS tp, count(*) FILTER (WHERE NOT y AND p) AS fp, "
                f"count(*) FILTER (WHERE y AND NOT p) AS fn, count(*) AS n FROM (SELECT y, {z} > 0 AS p FROM s)")
    union = " UNION ALL ".join([cells("", None), *[cells(c, c) for c in cols]])
    return W(S.SUBSCRIBERS, S.CHURN_FEATURES, S.CHURN_LABELS) + f"""
, v AS (SELECT l.customer_id, l.churn = 'Yes' AS y, {", ".join(f"CAST(f.{c} AS DOUBLE) AS {c}" for c in LINEAR_W)}, f.contract,
               {S.hash32('l.customer_id', 'perm:42')} AS h
        FROM churn_labels l JOIN churn_features f ON l.customer_id = f.customer_id WHERE l.split = 'validate'),
b AS (SELECT *, h % (SELECT greatest(1, count(*) // 100000) FROM v) AS bucket FROM v),
s AS (SELECT *, {moved} FROM b WINDOW o AS (PARTITION BY bucket ORDER BY h, customer_id)),
k AS ({union}),
m AS (SELECT variant, {S.r4('(n - fp - fn) / n')} AS acc, {S.r4('coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0)')} AS f1 FROM k)
SELECT m.variant AS "column", {S.r4('a.acc - m.acc')} AS accuracy_drop, {S.r4('a.f1 - m.f1')} AS f1_drop
FROM m, m a WHERE a.variant = '' AND m.variant <> ''"""


@query("permutation_importance", _importance_sql())
def q_permutation_importance(spark, d):
    """Importance of each column for a model of fixed weights (``contract`` has none, so no drop)."""
    data = materialize(CL.split_of(_labeled(_t(spark, d)), "validate").select("customer_id", "label", "contract", *LINEAR_W))
    res = ML.permutation_importance(data, ML.LinearModel(LINEAR_W, LINEAR_B), [*LINEAR_W, "contract"], "customer_id", "label")
    out = spark.createDataFrame([(r["column"], r["accuracy_drop"], r["f1_drop"]) for r in res],
                                "column string, accuracy_drop double, f1_drop double")
    return out.select("column", r4("accuracy_drop").alias("accuracy_drop"), r4("f1_drop").alias("f1_drop"))


# ------------------------------------------------------------------ U: UDF / SQL functions


@query("ceil_udf_vs_native", """
SELECT event_id, CAST(((epoch_us(ts) + 899999999) // 900000000) * 900 AS BIGINT) AS native,
       CAST(((epoch_us(ts) + 899999999) // 900000000) * 900 AS BIGINT) AS via_udf FROM events""")
def q_ceil_udf_vs_native(spark, d):
    """The row-at-a-time twin of the native expression."""
    return _t(spark, d).events.select("event_id", C.ceil_unix_seconds("ts", 15).alias("native"), ceil_udf("ts", F.lit(15)).alias("via_udf"))


@query("udf_vs_native", W(S.SUBSCRIBERS) + """
SELECT customer_id, CAST(n AS BIGINT) AS native, CAST(n AS DOUBLE) AS via_udf, true AS same FROM (
  SELECT customer_id, """ + " + ".join(f"(CASE WHEN {s} = 'Yes' THEN 1 ELSE 0 END)" for s in S.SERVICES)
       + " AS n FROM subscribers)")
def q_udf_vs_native(spark, d):
    s = FX.subscribers(_t(spark, d))
    out = s.select("customer_id", C.flag_count(CL.SERVICE_COLUMNS).alias("native"),
                   flags_udf(*CL.SERVICE_COLUMNS).alias("via_udf"))
    return out.withColumn("same", F.col("native").cast("double") == F.col("via_udf"))


@query("sql_function", W(S.SUBSCRIBERS, S.CHURN_FEATURES) + f"""
SELECT customer_id, {S.price_increase('monthly_charges', 'tenure', 'total_charges')} AS avg_price_increase
FROM churn_features""")
def q_sql_function(spark, d):
    register_sql_functions(spark)
    view = f"churn_features_{id(spark) % 100000}"
    FX.churn_features(_t(spark, d)).createOrReplaceTempView(view)
    return spark.sql(f"SELECT customer_id, avg_price_increase(monthly_charges, tenure, total_charges) "
                     f"AS avg_price_increase FROM {view}")


# ------------------------------------------------------------------ X: streaming


def _stage_by_year(spark, orders, path):
    """Lands orders in a folder a year (0: orders without a date), in one write and as many files as Spark makes; returns
    the years in order."""
    year = F.coalesce(F.year("o_orderdate"), F.lit(0))
    orders.withColumn("yr", year).write.partitionBy("yr").parquet(path)
    return [r.yr for r in spark.read.parquet(path).select("yr").distinct().orderBy("yr").collect()]  # a row a year


@query("stream_upsert", """
WITH y AS (SELECT o_custkey, coalesce(year(o_orderdate), 0) AS yr, o_orderdate, o_totalprice FROM orders),
last AS (SELECT o_custkey, max(yr) AS yr FROM y GROUP BY 1)
SELECT y.o_custkey AS customer_id, count(*) AS n_orders, max(o_totalprice) AS max_price,
       max(o_orderdate) AS last_order
FROM y JOIN last ON y.o_custkey = last.o_custkey AND y.yr = last.yr GROUP BY 1""")
def q_stream_upsert(spark, d):
    t = _t(spark, d)
    src_dir, table, ck = (scratch_path(spark, n) for n in ("orders_landing", "stream_table", "ck_upsert"))
    o = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    years = _stage_by_year(spark, o, src_dir)

    def per_batch(b):
        return b.groupBy(F.col("o_custkey").alias("customer_id")).agg(
            F.count(F.lit(1)).alias("n_orders"), F.max("o_totalprice").alias("max_price"),
            F.max("o_orderdate").alias("last_order"))
    for y in years:  # one available-now run a landed year, all its files in one batch
        ST.stream_features(ST.read_stream(spark, f"{src_dir}/yr={y}", o.schema, max_files=None), per_batch, ["customer_id"], table, f"{ck}/{y}")
    return ST.latest_table(spark, table)


@query("stream_windows", f"""
WITH e AS (SELECT * FROM events),
w AS (SELECT date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end,
             event_type, count(*) AS n, {S.r4('sum(value)')} AS total FROM e GROUP BY 1, 2, 3)
SELECT * FROM w WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""")
def q_stream_windows(spark, d):
    t = _t(spark, d)
    src_dir, out, ck = (scratch_path(spark, n) for n in ("events_landing", "stream_windows", "ck_windows"))
    t.events.write.parquet(src_dir)
    src = ST.read_stream(spark, src_dir, t.events.schema, max_files=None)
    ST.stream_window_features(src, ["event_type"], "ts", "1 day", None, "1 hour",
                              {"n": F.count(F.lit(1)), "total": r4(F.sum("value"))}, out, ck)
    return spark.read.parquet(out)


DOC_W = {"n_chars": 0.001}


@query("stream_score", f"""
SELECT d.doc_id, {S.r4('1.0 / (1.0 + exp(-(-2.0 + 0.001 * coalesce(CAST(d.n_chars AS DOUBLE), 0))))')} AS score,
       CAST(1.0 / (1.0 + exp(-(-2.0 + 0.001 * coalesce(CAST(d.n_chars AS DOUBLE), 0)))) > 0.5 AS INTEGER)
         AS prediction,
       l.quality
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def q_stream_score(spark, d):
    """Stream of documents scored with fixed weights; late-arriving truth comes from a
    static table through a stream-static left join (J5 on a stream)."""
    t = _t(spark, d)
    src_dir, out, ck = (scratch_path(spark, n) for n in ("docs_landing", "stream_score", "ck_score"))
    docs = t.documents.select("doc_id", "n_chars")
    docs.write.parquet(src_dir)
    src = ST.read_stream(spark, src_dir, docs.schema, max_files=None)
    truth = t.labels.select("doc_id", "quality")

    def score(s):
        scored = ML.score_linear(s, DOC_W, -2.0).select("doc_id", r4("score").alias("score"), "prediction")
        return scored.join(truth, "doc_id", "left")
    ST.stream_score(src, score, out, ck)
    return spark.read.parquet(out)


@query("stream_profile", f"""
WITH b AS (SELECT date_trunc('day', ts) AS w, event_type, value FROM events),
p AS (
  SELECT w, CASE WHEN grouping(event_type) = 1 THEN '*' ELSE event_type END AS model_id, 'value' AS column_name,
         count(*) AS count, count(*) FILTER (WHERE value IS NULL) AS num_nulls,
         {S.r6(S.r6('sum(value)') + ' / count(value)')} AS mean, {S.r6('stddev_samp(value)')} AS stddev,
         min(value) AS min, max(value) AS max
  FROM b GROUP BY GROUPING SETS ((w, event_type), (w))
  UNION ALL
  SELECT w, CASE WHEN grouping(event_type) = 1 THEN '*' ELSE event_type END, ':table', count(*),
         NULL, NULL, NULL, NULL, NULL
  FROM b GROUP BY GROUPING SETS ((w, event_type), (w)))
SELECT w AS window_start, w + INTERVAL 1 DAY AS window_end, model_id, column_name, count, num_nulls,
       mean, stddev, min, max
FROM p WHERE w + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""")
def q_stream_profile(spark, d):
    t = _t(spark, d)
    src_dir, out, ck = (scratch_path(spark, n) for n in ("events_landing_p", "stream_profile", "ck_profile"))
    t.events.write.parquet(src_dir)
    src = ST.read_stream(spark, src_dir, t.events.schema, max_files=None)
    ST.stream_profile(src, "ts", "1 day", ["value"], "event_type", "1 hour", out, ck)
    return spark.read.parquet(out)
