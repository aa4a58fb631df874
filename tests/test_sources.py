import os

from featureflow.session import scratch_path
from featureflow.sources import tables as TB


def test_ensure_schema_and_csv_ingest_if_absent(spark):
    TB.ensure_schema(spark, "ff_test_ns")
    assert spark.catalog.currentDatabase() == "ff_test_ns"
    path = scratch_path(spark, "csv")
    spark.createDataFrame([(1, "a")], "CustomerID int, PaymentMethod string").write.option("header", "true").csv(path)
    loc = scratch_path(spark, "bronze")
    df = TB.ingest_csv(spark, path, "bronze_t", location=loc)
    assert df.columns == ["customer_id", "payment_method"] and df.count() == 1
    # second call: the table exists, nothing is rewritten
    spark.createDataFrame([(2, "b")], "CustomerID int, PaymentMethod string").write.mode("append") \
        .option("header", "true").csv(path)
    assert TB.ingest_csv(spark, path, "bronze_t").count() == 1
    spark.catalog.setCurrentDatabase("default")


def test_unpack_payload(spark):
    df = spark.createDataFrame([(1, '{"k": 3, "s": "x"}'), (2, None)], "id int, p string")
    out = TB.unpack_payload(df, "p", "k INT, s STRING").collect()
    assert [(r.id, r.k, r.s) for r in out] == [(1, 3, "x"), (2, None, None)]


def test_generate_table_is_partitioning_independent(spark):
    ids = spark.range(500).withColumnRenamed("id", "k")
    specs = {"c": TB.Choice(("a", "b"), (0.8, 0.2)), "x": TB.Steps(0.0, 10.0, 0.5)}
    a = sorted(tuple(r) for r in TB.generate_table(ids, "k", specs).collect())
    b = sorted(tuple(r) for r in TB.generate_table(ids.repartition(5), "k", specs).collect())
    assert a == b
    share = sum(1 for r in a if r[1] == "a") / len(a)
    assert 0.7 < share < 0.9 and all(0.0 <= r[2] <= 10.0 for r in a)


def test_scratch_under_checkpoint_dir(spark):
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    p = scratch_path(spark, "x")
    assert p.startswith(d.rstrip("/")) and not os.path.exists(p.replace("file:", ""))


def test_size_for_input(spark):
    from featureflow.session import size_for_input
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert size_for_input(spark, 100 * 2**40) == 409_600           # 100 TB at 256 MiB
        assert size_for_input(spark, 100 * 2**40, 1 << 30) == 102_400   # 1 GiB partitions
        assert size_for_input(spark, 10 << 20) == 8
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", old)
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
