"""Payloads of unknown shape, namespaces' query, orders without a date on a stream."""
from pyspark.sql import functions as F

from featureflow.plans import queries_ml as QM
from featureflow.session import scratch_path
from featureflow.sources import variant as VA

ROWS = [(1, '{"a":1,"b":"x","A":2}'), (2, '{"a":2.5,"m":1}'), (3, '{"m":"s","n":null,"o":{"z":1},"l":[1],"it\'s":3,"d.o t":true}'),
        (4, '{"a":'), (5, "[1]"), (6, None), (7, '{"a":1,"a":2}'), (8, "null"), (9, ""), (10, "{}"), (None, '{"a":7}')]


def test_every_row_is_accepted_or_kept_aside(spark):
    df = spark.createDataFrame(ROWS, "id int, props string")
    good, bad = VA.unpack_variant(df, "props")
    assert {r.id: r.reason for r in bad.collect()} == {4: VA.BROKEN, 5: VA.NO_OBJECT, 7: VA.BROKEN, 8: VA.NO_OBJECT, 9: VA.BROKEN}
    assert bad.columns == ["id", "props", "reason"]
    kinds = dict(good.dtypes)
    assert kinds["b"] == "string" and kinds["d.o t"] == "boolean" and kinds["it's"] == "bigint"
    assert [kinds[n] for n in ("l", "m", "n", "o", "payload")] == ["variant"] * 5
    assert kinds["A"] == "bigint" and kinds["_a"].startswith("decimal")
    got = {r.id: r for r in good.select("id", F.col("_a").cast("double").alias("a"), F.to_json("m").alias("m"), "`d.o t`").collect()}
    assert set(got) == {1, 2, 3, 6, 10, None}
    assert (got[1].a, got[2].a, got[None].a, got[6].a, got[10].a) == (1.0, 2.5, 7.0, None, None)
    assert (got[2].m, got[3].m, got[3]["d.o t"]) == ("1", '"s"', True)


def test_clashing_names_empty_tables_and_few_columns(spark):
    df = spark.createDataFrame(ROWS, "id int, props string").withColumn("payload", F.lit(1)).withColumn("reason", F.lit("r")).withColumn("b", F.lit(0))
    good, bad = VA.unpack_variant(df, "props")
    assert {"payload", "_payload", "b", "_b", "reason"} <= set(good.columns) and {"reason", "_reason"} <= set(bad.columns)
    assert good.where("b <> 0 OR payload <> 1 OR reason <> 'r'").count() == 0
    none, rejected = VA.unpack_variant(df.limit(0), "props")
    assert none.count() == 0 == rejected.count()
    few, _ = VA.unpack_variant(spark.createDataFrame(ROWS, "id int, props string"), "props", max_columns=1)
    assert few.columns == ["id", "props", "payload", "a"]  # the rest stays in the payload
    assert few.where(F.expr("variant_get(payload, '$.b', 'string') = 'x'")).count() == 1


def test_fields_of_an_earlier_load(spark):
    first = spark.createDataFrame([(1, '{"k":1}')], "id int, props string")
    later = spark.createDataFrame([(2, '{"k":"many","z":1}')], "id int, props string")
    fields = VA.find_fields(VA.parse_variant(first, "props"))
    assert fields == [VA.Field("k", "BIGINT", 1)]
    good, _ = VA.unpack_variant(later, "props", fields=fields)
    assert good.select("id", "k").collect()[0].asDict() == {"id": 2, "k": None} and good.columns == ["id", "props", "payload", "k"]


def test_orders_without_a_date_are_landed(spark):
    o = spark.createDataFrame([(1, "1996-05-01"), (2, None), (3, "1998-01-01"), (4, None)], "k int, d string")
    path = scratch_path(spark, "years")
    years = QM._stage_by_year(spark, o.select("k", F.col("d").cast("timestamp_ntz").alias("o_orderdate")).repartition(3), path)
    assert years == [0, 1996, 1998]
    assert sorted(r.k for r in spark.read.parquet(f"{path}/yr=0").collect()) == [2, 4]
