"""Structured Streaming forms of the feature, window, scoring and profile plans.

Each runs as ``readStream -> native transformations -> writeStream`` with a
checkpoint under the shared folder; ``trigger(availableNow=True)`` processes what
is there and stops, so the same code serves scheduled incremental jobs.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, TimestampNTZType

from featureflow.functions.columns import round_metric
from featureflow.operators.feature_table import feature_table, upsert_table


def read_stream(spark: SparkSession, path: str, schema: StructType, max_files: int | None = 1) -> DataFrame:
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", str(max_files))
    return r.parquet(path)


def stream_features(src: DataFrame, transform: Callable[[DataFrame], DataFrame], keys: Sequence[str],
                    table_path: str, checkpoint: str, order_col: str | None = None, n_buckets: int | None = None) -> None:
    """Feature upsert on a stream: every micro-batch is transformed, de-duplicated
    per key (newest ``order_col`` wins) and upserted into the stored table.

    ``foreachBatch`` is at-least-once; the upsert is idempotent and rewrites only the
    key-hash partitions the batch touches (``upsert_table``), so a replayed batch
    leaves the table unchanged and a small batch does not rewrite a large table.
    """
    spark = src.sparkSession

    def upsert(batch: DataFrame, batch_id: int) -> None:
        upd = transform(batch)
        if order_col is not None:
            from featureflow.operators.lookup import latest_snapshot
            upd = latest_snapshot(upd, keys, order_col)
        upsert_table(spark, upd, keys, table_path, n_buckets, order_col)

    (src.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())


def latest_table(spark: SparkSession, table_path: str) -> DataFrame:
    return feature_table(spark, table_path)


def _event_time(src: DataFrame, ts: str):
    """Watermarks need TIMESTAMP; zone-less event times are cast (session zone = UTC)
    and window bounds cast back, so output types equal the batch plans'."""
    if isinstance(src.schema[ts].dataType, TimestampNTZType):
        return src.withColumn(ts, F.col(ts).cast("timestamp")), lambda c: c.cast("timestamp_ntz")
    return src, lambda c: c


def stream_window_features(src: DataFrame, keys: Sequence[str], ts: str, length: str, slide: str | None,
                           delay: str, aggs: Mapping[str, Column], out_path: str, checkpoint: str) -> None:
    """Windowed features with a watermark; append mode emits each window once,
    after the watermark passes its end. Late rows beyond ``delay`` are dropped."""
    src, back = _event_time(src, ts)
    w = F.window(F.col(ts), length, slide) if slide else F.window(F.col(ts), length)
    agg = (src.withWatermark(ts, delay).groupBy(w.alias("window"), *keys)
           .agg(*[v.alias(k) for k, v in aggs.items()])
           .select(back(F.col("window.start")).alias("window_start"), back(F.col("window.end")).alias("window_end"),
                   *keys, *aggs.keys()))
    (agg.writeStream.outputMode("append").format("parquet").option("path", out_path)
     .option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination())


def stream_score(src: DataFrame, score: Callable[[DataFrame], DataFrame], out_path: str, checkpoint: str) -> None:
    """Stateless scoring of a stream (model transform / static-side lookups)."""
    (score(src).writeStream.outputMode("append").format("parquet").option("path", out_path)
     .option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination())


def stream_profile(src: DataFrame, ts: str, granularity: str, columns: Sequence[str], model_col: str,
                   delay: str, out_path: str, checkpoint: str, digits: int = 6,
                   approx_distinct: bool = False) -> None:
    """Profile metrics per closed window on a stream (append mode + watermark).

    The batch form's grouping sets and exact distinct counts are not available to a
    streaming aggregation, so the '*' (all models) rows come from exploding each row
    into (its model, '*') and the ':table' row from one extra unpivot entry: still a
    single stateful aggregation, emitted once per window after the watermark passes.
    ``approx_distinct`` adds ``num_distinct_approx`` (HyperLogLog++ state per window).
    """
    src, back = _event_time(src, ts)
    models = F.explode(F.array(F.col(model_col).cast("string"), F.lit("*")))
    entries = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("x")) for c in columns]
    entries.append(F.struct(F.lit(":table").alias("column_name"), F.lit(None).cast("double").alias("x")))
    unp = (src.withWatermark(ts, delay)
           .select(ts, models.alias("model_id"), F.explode(F.array(*entries)).alias("u"))
           .select(ts, "model_id", "u.column_name", "u.x"))
    agg = unp.groupBy(F.window(F.col(ts), granularity).alias("window"), "model_id", "column_name").agg(
        F.count(F.lit(1)).alias("count"), F.count_if(F.col("x").isNull()).alias("_nulls"),
        F.sum("x").alias("_sum"), F.count("x").alias("_n"), F.stddev_samp("x").alias("_sd"),
        F.min("x").alias("min"), F.max("x").alias("max"),
        *([F.approx_count_distinct("x").alias("num_distinct_approx")] if approx_distinct else []))
    out = agg.select(back(F.col("window.start")).alias("window_start"),
                     back(F.col("window.end")).alias("window_end"), "model_id", "column_name", "count",
                     F.when(F.col("column_name") != ":table", F.col("_nulls")).alias("num_nulls"),
                     round_metric(round_metric(F.col("_sum"), digits) / F.col("_n"), digits).alias("mean"),
                     round_metric(F.col("_sd"), digits).alias("stddev"), "min", "max",
                     *(["num_distinct_approx"] if approx_distinct else []))
    (out.writeStream.outputMode("append").format("parquet").option("path", out_path)
     .option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination())
