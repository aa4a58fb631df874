import pytest
from pyspark.sql import functions as F

from featureflow.operators import feature_table as FT
from featureflow.session import scratch_path


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_merge_upsert_and_idempotence(spark):
    t = spark.createDataFrame([(1, 10.0, "a"), (2, 20.0, "b")], "k bigint, x double, s string")
    u = spark.createDataFrame([(2, 21.0, 7), (3, 30.0, 8)], "k bigint, x double, extra int")
    once = FT.merge_features(t, u, ["k"])
    assert once.columns == ["k", "x", "s", "extra"]
    assert _rows(once) == [(1, 10.0, "a", None), (2, 21.0, "b", 7), (3, 30.0, None, 8)]
    assert _rows(FT.merge_features(once, u, ["k"])) == _rows(once)


def test_check_constraints(spark):
    df = spark.createDataFrame([(1, "x"), (1, "y"), (2, None), (None, "z")], "k bigint, v string")
    got = {(r.constraint, r.column, r.key, r.n) for r in FT.check_constraints(df, ["k"], ["v"]).collect()}
    assert got == {("primary_key", "k", "1", 2), ("not_null", "k", None, 1), ("not_null", "v", None, 1)}


def test_table_changes(spark):
    old = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, None)], "k bigint, v double")
    new = spark.createDataFrame([(1, 1.0), (2, 2.5), (3, None), (4, 4.0)], "k bigint, v double")
    old2 = old.union(spark.createDataFrame([(5, 5.0)], "k bigint, v double"))
    got = _rows(FT.table_changes(old2, new, ["k"]))
    assert got == [(2, "update", 2.5), (4, "insert", 4.0), (5, "delete", 5.0)]


def test_latest_snapshot(spark):
    df = spark.createDataFrame([(1, 1, 5.0), (1, 3, 6.0), (1, 3, 7.0), (2, 2, 1.0)], "k bigint, t int, v double")
    got = _rows(FT.latest_snapshot(df, ["k"], "t", ["v"]))
    assert got == [(1, 3, 7.0), (2, 2, 1.0)]


def test_upsert_table_rewrites_only_touched_buckets(spark):
    import glob
    import os

    from featureflow.session import scratch_path
    path = scratch_path(spark, "ft")
    base = spark.createDataFrame([(k, float(k), "a") for k in range(200)], "k bigint, x double, s string")
    FT.upsert_table(spark, base, ["k"], path, n_buckets=16)
    before = {f: os.path.getmtime(f) for f in glob.glob(path.replace("file:", "") + "/_bucket=*/*.parquet")}
    upd = spark.createDataFrame([(3, 30.0, 1), (500, 5.0, 2)], "k bigint, x double, extra int")
    FT.upsert_table(spark, upd, ["k"], path, n_buckets=16)
    FT.upsert_table(spark, upd, ["k"], path, n_buckets=16)  # replay: unchanged
    got = {r.k: (r.x, r.s, r.extra) for r in FT.feature_table(spark, path).collect()}
    assert len(got) == 201 and got[3] == (30.0, "a", 1) and got[500] == (5.0, None, 2) and got[7] == (7.0, "a", None)
    after = {f: os.path.getmtime(f) for f in glob.glob(path.replace("file:", "") + "/_bucket=*/*.parquet")}

    def by_bucket(files):
        out = {}
        for f, m in files.items():
            out.setdefault(os.path.basename(os.path.dirname(f)), set()).add((f, m))
        return out
    b0, b1 = by_bucket(before), by_bucket(after)
    changed = [b for b in set(b0) | set(b1) if b0.get(b) != b1.get(b)]
    assert 1 <= len(changed) <= 2  # only the buckets of keys 3 and 500 were replaced


def test_feature_table_spec_as_properties(spark):
    from featureflow.session import scratch_path
    schema = "customer_id bigint, transaction_ts timestamp_ntz, tenure double"
    st = spark.createDataFrame([], schema).schema
    spec = FT.FeatureTableSpec("ff_spec_test", ("customer_id", "transaction_ts"), "transaction_ts", "churn features")
    df = FT.create_feature_table(spark, spec, st, scratch_path(spark, "spec"), register=True)
    assert df.count() == 0 and df.columns == ["customer_id", "transaction_ts", "tenure"]
    got = FT.feature_table_spec(spark, "ff_spec_test")
    assert got.primary_keys == spec.primary_keys and got.timeseries_column == "transaction_ts"


def test_bucket_count_is_fixed_per_table(spark):
    import pytest

    from featureflow.session import scratch_path
    path = scratch_path(spark, "ftb")
    df = spark.createDataFrame([(1, 1.0)], "k bigint, x double")
    FT.upsert_table(spark, df, ["k"], path, n_buckets=4)
    assert FT.table_buckets(spark, path) == (4, True)
    FT.upsert_table(spark, df, ["k"], path)  # the stored count is reused
    with pytest.raises(ValueError):
        FT.upsert_table(spark, df, ["k"], path, n_buckets=8)
    assert FT.feature_table(spark, path).count() == 1


def test_created_table_takes_upserts_with_its_own_keys(spark):
    schema = spark.createDataFrame([], "k int, t int, v string").schema
    path = scratch_path(spark, "created")
    FT.create_feature_table(spark, FT.FeatureTableSpec("x", ("k", "t")), schema, path, n_buckets=3)
    up = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (None, 1, "c")], schema)
    FT.upsert_table(spark, up, None, path)
    FT.upsert_table(spark, up.where("t = 2").withColumn("v", F.lit("z")), ["t", "k"], path)
    got = {tuple(r) for r in FT.feature_table(spark, path).select("k", "t", "v").collect()}
    assert got == {(1, 1, "a"), (1, 2, "z"), (None, 1, "c")}
    with pytest.raises(ValueError):
        FT.upsert_table(spark, up, ["k"], path)
    with pytest.raises(ValueError):  # rows are never replaced by an empty table
        FT.create_feature_table(spark, FT.FeatureTableSpec("x", ("k", "t")), schema, path)
    with pytest.raises(ValueError):
        FT.upsert_table(spark, up, None, scratch_path(spark, "nothing"))


def test_changes_with_null_keys_and_a_new_column(spark):
    old = spark.createDataFrame([(1, "a"), (None, "b"), (3, "c")], "k int, v string")
    new = spark.createDataFrame([(1, "a", None), (None, "b", 5), (4, "d", 6)], "k int, v string, w int")
    got = {(r.k, r.change_type, r.v, r.w) for r in FT.table_changes(old, new, ["k"]).collect()}
    assert got == {(None, "update", "b", 5), (3, "delete", "c", None), (4, "insert", "d", 6)}
