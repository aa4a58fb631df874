"""Versioned tables: what readers see during and after a commit, what a change feed reads, snapshots from feeds."""
import random

import pytest
from pyspark.sql import functions as F

from featureflow.operators import versioned as VT
from featureflow.operators.feature_table import merge_features, table_changes
from featureflow.operators.lookup import latest_snapshot
from featureflow.session import scratch_path

rng = random.Random(3)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_readers_see_one_version_and_a_killed_commit_leaves_nothing(spark, monkeypatch):
    base = spark.createDataFrame([(k, float(k), "a") for k in range(100)] + [(None, 1.0, "n")], "k bigint, x double, s string")
    t = VT.VersionedTable.create(spark, scratch_path(spark, "vt"), base.schema, ["k"], n_buckets=8)
    assert t.read().count() == 0 and t.versions() == [0]
    assert t.merge(base) == 1 and rows(t.read()) == rows(base)
    upd = spark.createDataFrame([(3, 30.0, 1), (500, 5.0, 2), (None, 2.0, 3), (3, 29.0, 9)], "k bigint, x double, extra int")
    reader = t.read()  # opened before the next commits
    seen_by_reader = []
    monkeypatch.setattr(t, "_commit", lambda *a: seen_by_reader.append(rows(VT.VersionedTable(spark, t.path).read())) or (_ for _ in ()).throw(KeyboardInterrupt))
    with pytest.raises(KeyboardInterrupt):  # all rows are written, the switch is not
        t.merge(upd)
    monkeypatch.undo()
    assert seen_by_reader == [rows(base)] and rows(t.read()) == rows(base) and t.versions() == [0, 1]
    assert t.merge(upd) == 2
    want = merge_features(base, upd, ["k"])
    assert t.read().columns == ["k", "x", "s", "extra"] and rows(t.read()) == rows(want)
    assert rows(reader) == rows(base) == rows(t.read(1))
    assert t.merge(upd) == 3 and rows(t.read()) == rows(want)  # replay
    assert t.merge(upd.limit(0)) == 3


def test_second_writer_fails_without_a_trace(spark):
    base = spark.createDataFrame([(1, 1.0)], "k bigint, x double")
    t = VT.VersionedTable.create(spark, scratch_path(spark, "vt"), base.schema, ["k"], n_buckets=2)
    a, old = t.at(), t.at().id
    t.merge(base)
    with pytest.raises(VT.CommitConflict):
        t._commit(VT.Version(1, "9" * 8 + "-late", a.keys, a.bucket_by, a.n_buckets, a.schema, {}), old)
    assert t.versions() == [0, 1] and rows(t.read()) == [(1, 1.0)]
    with pytest.raises(ValueError):
        VT.VersionedTable.create(spark, t.path, base.schema, ["k"])
    with pytest.raises(LookupError):
        t.read(7)


def test_changes_read_only_buckets_written_in_between(spark):
    base = spark.createDataFrame([(k, float(k)) for k in range(400)], "k bigint, x double")
    t = VT.VersionedTable.create(spark, scratch_path(spark, "vt"), base.schema, ["k"], n_buckets=32)
    t.merge(base)
    before = t.read()
    t.merge(spark.createDataFrame([(5, 5.5), (1000, 1.0)], base.schema))
    t.merge(deletes=spark.createDataFrame([(9,)], "k bigint"))
    assert rows(t.changes(1, 3)) == rows(table_changes(before, t.read(), ["k"])) == [(1000, "insert", 1.0), (5, "update", 5.5), (9, "delete", 9.0)]
    files = t.changes(1, 3).inputFiles()
    assert len(t.changed_buckets(1, 3)) <= 3 and {f.split("_bucket=")[1].split("/")[0] for f in files} == {str(b) for b in t.changed_buckets(1, 3)}
    assert t.changes(2, 2).count() == 0


def test_last_row_of_a_bucket_deleted(spark):
    base = spark.createDataFrame([(1, 1.0), (2, 2.0)], "k bigint, x double")
    t = VT.VersionedTable.create(spark, scratch_path(spark, "vt"), base.schema, ["k"], n_buckets=64)
    t.merge(base)
    t.merge(deletes=base.select("k"))
    assert t.read().count() == 0 and rows(t.changes(1, 2)) == [(1, "delete", 1.0), (2, "delete", 2.0)]


def test_snapshot_follows_the_feeds(spark):
    schema = "c bigint, t bigint, v double"
    events = spark.createDataFrame([(rng.randrange(30), rng.randrange(1000), rng.random()) for _ in range(300)], schema).dropDuplicates(["c", "t"])
    t = VT.VersionedTable.create(spark, scratch_path(spark, "vt"), events.schema, ["c", "t"], 16, bucket_by=["c"])
    s = VT.VersionedTable.create(spark, scratch_path(spark, "vt"), events.schema, ["c"], 16)
    for step in range(4):
        old = t.at().version
        late = spark.createDataFrame([(rng.randrange(35), rng.randrange(1000), 0.5) for _ in range(5)] + [(None, step, 1.0)], schema)
        newest = latest_snapshot(t.read(), ["c"], "t").where(F.col("c") % 5 == step)
        t.merge(events if step == 0 else late, deletes=newest.select("c", "t"))
        VT.refresh_snapshot(t, s, old, t.at().version, "t")
        assert rows(s.read()) == rows(latest_snapshot(t.read(), ["c"], "t").select(*s.read().columns))
    with pytest.raises(ValueError):
        VT.refresh_snapshot(s, VT.VersionedTable.create(spark, scratch_path(spark, "vt"), events.schema, ["t"]), 0, 1, "t")
