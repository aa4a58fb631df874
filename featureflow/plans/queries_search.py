"""Registered queries for namespaces (S6), payloads of unknown shape (S13) and the adaptive search (L4)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from featureflow.functions import columns as C
from featureflow.operators import tune as TU
from featureflow.plans import sqlbits as S
from featureflow.plans.queries import _t
from featureflow.plans.queries_ml import _model_input
from featureflow.plans.registry import query
from featureflow.session import scratch_path
from featureflow.sources import tables as TB
from featureflow.sources import variant as VA

r4 = C.round_metric


@query("namespaces", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def q_namespaces(spark, d):
    """A table written into a namespace that is created twice, read back by its full name."""
    space = f"ff_space_{uuid.uuid4().hex[:10]}"
    for _ in range(2):
        TB.ensure_schema(spark, space, use=False)
    TB.write_table(_t(spark, d).nation, f"{space}.nation", location=scratch_path(spark, "namespace"))
    return TB.read_table(spark, f"{space}.nation")


@query("unpack_variant", """
SELECT event_id, CASE WHEN event_id % 10 NOT IN (0, 1, 2) THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k,
       CASE WHEN event_id % 10 = 3 THEN event_type END AS note,
       CASE WHEN event_id % 10 = 4 THEN CAST(user_id AS VARCHAR) WHEN event_id % 10 = 5 THEN '"' || event_type || '"' END AS mixed,
       CASE event_id % 10 WHEN 0 THEN 'not json' WHEN 1 THEN 'not an object' END AS reason
FROM events""")
def q_unpack_variant(spark, d):
    """Every event's payload, with fields added, missing (2), of mixed types, cut off (0) and no object at all (1)."""
    e = _t(spark, d).events
    body = F.expr("substring(props, 1, length(props) - 1)")
    kind = F.col("event_id") % 10
    text = (F.when(kind == 0, body).when(kind == 1, F.concat(F.lit("["), "props", F.lit("]"))).when(kind == 2, F.lit("{}"))
            .when(kind == 3, F.concat(body, F.lit(', "note": "'), "event_type", F.lit('"}')))
            .when(kind == 4, F.concat(body, F.lit(', "mixed": '), F.col("user_id").cast("string"), F.lit("}")))
            .when(kind == 5, F.concat(body, F.lit(', "mixed": "'), "event_type", F.lit('"}'))).otherwise(F.col("props")))
    good, bad = VA.unpack_variant(e.select("event_id", text.alias("request")), "request")
    good = good.select("event_id", F.col("k").cast("long").alias("k"), "note", F.to_json("mixed").alias("mixed"))
    return good.unionByName(bad.select("event_id", "reason"), allowMissingColumns=True)


SPACE = {**TU.GBT_SPACE, "maxIter": ("quniform", 3, 6, 1), "maxDepth": ("quniform", 2, 3, 1)}


def _inside(spec, value) -> bool:
    return value in spec[1] if spec[0] == "choice" else spec[1] <= value <= spec[2]


@query("search_adaptive", S.with_(S.SUBSCRIBERS, S.CHURN_LABELS) + f"""
SELECT CAST(trial AS INTEGER) AS trial, trial >= 2 AS adaptive, split, count(*) AS n_rows,
       count(*) FILTER (WHERE churn = 'Yes') AS n_positive, true AS in_space, true AS in_range, true AS best_is_least,
       true AS best_model_kept,
       CASE WHEN trial < 2 THEN {S.r4(f"exp(ln(0.02) + (ln(0.5) - ln(0.02)) * ({S.hash32('trial', '2:42')} / 4294967296.0))")} END AS step_size
FROM churn_labels, range(4) r(trial) GROUP BY trial, split""")
def q_search_adaptive(spark, d):
    """Two seeded and two proposed trials of boosted trees, with the counts of every split and what must hold: points
    inside the space, metrics in range, the best loss the least, and its model the one that is returned."""
    x, feats = _model_input(_t(spark, d))
    found = TU.search_gbt(x, feats, SPACE, 4, start=2)
    kept = TU.split_metrics(found.model, x) == found.best.metrics
    least = found.best.loss == min(t.loss for t in found.trials)
    rows = [(t.trial, t.adaptive, s, m["rows"], m["positives"], all(_inside(SPACE[k], v) for k, v in t.params.items()),
             all(0.0 <= m[k] <= 1.0 for k in ("accuracy", "precision", "recall", "f1")), least, kept,
             None if t.adaptive else float(t.params["stepSize"])) for t in found.trials for s, m in t.metrics.items()]
    out = spark.createDataFrame(rows, "trial int, adaptive boolean, split string, n_rows bigint, n_positive bigint, in_space boolean, "
                                "in_range boolean, best_is_least boolean, best_model_kept boolean, step_size double")
    return out.withColumn("step_size", r4("step_size"))
