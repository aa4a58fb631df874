"""Registered queries: streams whose rows arrive over several micro-batches and partly late, and columns of many levels."""

from __future__ import annotations

from pyspark.sql import functions as F

from featureflow.functions.columns import round_metric as r4
from featureflow.operators import wide_levels as WL
from featureflow.plans import sqlbits as S
from featureflow.plans.queries import _t
from featureflow.plans.registry import query
from featureflow.session import scratch_path
from featureflow.streaming import streams as ST

ARRIVALS = 5
# Rows of the first fifth of the time span whose event_id ends in 7 arrive with the last fifth: the watermark has passed their windows.
ARRIVED_SQL = f"""
span AS (SELECT epoch_us(min(ts)) AS lo, greatest(epoch_us(max(ts)) - epoch_us(min(ts)), 1) AS len FROM events),
arrived AS (SELECT e.* FROM events e, span WHERE NOT (({ARRIVALS} * (epoch_us(ts) - lo)) // len = 0 AND event_id % 10 = 7))"""


def _arrivals(spark, events, run):
    """Lands events arrival by arrival in one folder and calls ``run(source)`` after each: the stream goes on where its
    checkpoint ends, so each arrival is a micro-batch of its own with any number of files."""
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    span = events.agg(F.min(us).alias("lo"), F.max(us).alias("hi")).first()
    landing, src = scratch_path(spark, "arrivals"), scratch_path(spark, "arrived")
    if span["lo"] is not None:
        fifth = F.least(F.lit(ARRIVALS - 1), F.floor(F.try_divide(F.lit(ARRIVALS) * (us - span["lo"]), F.lit(max(span["hi"] - span["lo"], 1)))))
        late = (fifth == 0) & (F.col("event_id") % 10 == 7)
        events.where("ts is not null").withColumn("arrival", F.when(late, ARRIVALS - 1).otherwise(fifth).cast("int")) \
            .write.partitionBy("arrival").parquet(landing)
        for i in sorted(r.arrival for r in spark.read.parquet(landing).select("arrival").distinct().collect()):  # five at most
            spark.read.schema(events.schema).parquet(f"{landing}/arrival={i}").write.mode("append").parquet(src)
            run(ST.read_stream(spark, src, events.schema, max_files=None))


@query("stream_windows_late", f"""
WITH {ARRIVED_SQL},
w AS (SELECT date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end,
             event_type, count(*) AS n, {S.r4('sum(value)')} AS total FROM arrived GROUP BY 1, 2, 3)
SELECT * FROM w WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""")
def q_stream_windows_late(spark, d):
    """X2 over five micro-batches: windows close batch by batch, rows that come after theirs closed are dropped."""
    t = _t(spark, d)
    out, ck = scratch_path(spark, "late_windows"), scratch_path(spark, "ck_late_windows")
    aggs = {"n": F.count(F.lit(1)), "total": r4(F.sum("value"))}
    _arrivals(spark, t.events, lambda src: ST.stream_window_features(src, ["event_type"], "ts", "1 day", None, "1 hour", aggs, out, ck))
    return spark.read.parquet(out)


@query("stream_profile_late", f"""
WITH {ARRIVED_SQL},
b AS (SELECT date_trunc('day', ts) AS w, event_type, value FROM arrived),
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
def q_stream_profile_late(spark, d):
    """X4 over five micro-batches, with the same late rows."""
    t = _t(spark, d)
    out, ck = scratch_path(spark, "late_profile"), scratch_path(spark, "ck_late_profile")
    _arrivals(spark, t.events, lambda src: ST.stream_profile(src, "ts", "1 day", ["value"], "event_type", "1 hour", out, ck))
    return spark.read.parquet(out)


@query("one_hot_wide", """
WITH fit AS (SELECT CAST(o_custkey AS VARCHAR) AS c, o_orderpriority AS p FROM orders WHERE o_orderdate < TIMESTAMP '1997-01-01'),
c AS (SELECT c, row_number() OVER (ORDER BY c) - 1 AS i FROM (SELECT DISTINCT c FROM fit WHERE c IS NOT NULL)),
p AS (SELECT p, row_number() OVER (ORDER BY p) - 1 AS i FROM (SELECT DISTINCT p FROM fit WHERE p IS NOT NULL))
SELECT o_orderkey, CAST(coalesce(c.i, (SELECT count(*) FROM c)) AS DOUBLE) AS o_custkey_idx,
       CAST(coalesce(p.i, (SELECT count(*) FROM p)) AS DOUBLE) AS o_orderpriority_idx
FROM orders o LEFT JOIN c ON CAST(o.o_custkey AS VARCHAR) = c.c LEFT JOIN p ON o.o_orderpriority = p.p""")
def q_one_hot_wide(spark, d):
    """L1 on a key column: level numbers fitted on earlier orders; later customers are unknown."""
    o = _t(spark, d).orders.select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate")
    cols = ["o_custkey", "o_orderpriority"]
    table = WL.fit_level_table(o.where(F.col("o_orderdate") < F.lit("1997-01-01").cast("timestamp_ntz")), cols)
    return WL.level_indices(o, table, cols).select("o_orderkey", *[f"{c}_idx" for c in cols])
