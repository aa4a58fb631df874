"""Session helpers: one place for the settings every plan in this library relies on.

The library never depends on a machine-local folder when it runs on a cluster: any
intermediate table it writes goes below the shared folder named by
``spark.checkpoint.dir``. Only a local session (a test, a laptop) without that setting
gets a private folder; elsewhere it is an error.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the plans assume. Time zone: driver Parquet timestamps are zone-less
# (TIMESTAMP_NTZ); pinning UTC keeps every NTZ <-> TIMESTAMP cast exact.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "featureflow",
                  extra: dict | None = None) -> SparkSession:
    """Session for tests, benches and notebooks; clusters pass their own master."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("FEATUREFLOW_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in {**SESSION_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the plans rely on to an existing session."""
    for k, v in SESSION_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder for lineage cuts and intermediate tables.

    Read from the session (``spark.checkpoint.dir`` or the context's checkpoint
    dir); only if neither is set, a local session gets a private one, others an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):  # executors would not see a folder of the driver
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="featureflow-ckpt-")
        spark.sparkContext.setCheckpointDir(d)
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder (never reused, never cleared)."""
    return f"{shared_dir(spark)}/featureflow/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df):
    """Cut the lineage of a frame that several jobs will read (ML fits, searches):
    a reliable checkpoint under the shared folder -- survives executor loss, unlike
    a local checkpoint, and is never written to a machine-local temp folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def size_for_input(spark: SparkSession, input_bytes: int, target_partition_bytes: int = 256 << 20,
                   max_partitions: int = 500_000) -> int:
    """Size shuffles for the data a job reads: the initial shuffle partition count is
    input / target (AQE then coalesces small ones toward the advisory size and splits
    skewed ones), and scans split files at the same target. 100 TB at 256 MiB gives
    ~400k partitions -- each fits an executor's memory and spills gracefully.
    Returns the partition count it set."""
    n = max(8, min(max_partitions, -(-int(input_bytes) // int(target_partition_bytes))))
    for k, v in {"spark.sql.shuffle.partitions": n,
                 "spark.sql.adaptive.coalescePartitions.initialPartitionNum": n,
                 "spark.sql.adaptive.advisoryPartitionSizeInBytes": target_partition_bytes,
                 "spark.sql.files.maxPartitionBytes": target_partition_bytes}.items():
        spark.conf.set(k, str(v))
    return n
