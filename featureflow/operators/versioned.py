"""Versioned feature tables: atomic upserts (S8), a stored change log (S11), incremental snapshots.

Rows are dealt to a fixed number of buckets by a hash of ``bucket_by`` (the keys, or a part of them). A commit writes the
buckets that it touches to a folder of its own, ``data/commit=<id>/_bucket=<n>``, and then appends one manifest row that
names the folder of every bucket. That append is a single file, so it is the switch: before it readers see the old table,
after it the new one, and a job that dies in between leaves a folder that nothing names. Old folders stay, so a version
that a reader has opened stays readable, and the changes between two versions need only the buckets whose folder differs.

Each manifest row names the commit it follows. Of two rows that follow the same commit the one with the smaller id
counts; the other writer finds that out after its append and fails without a trace in the table.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from featureflow.operators.feature_table import _read_if_there, key_bucket, merge_features, one_per_key, table_changes
from featureflow.operators.lookup import latest_snapshot
from featureflow.session import materialize

BUCKET = "_bucket"
MANIFEST = "version bigint, id string, follows string, keys array<string>, bucket_by array<string>, n_buckets int, columns string, folders map<int,string>"


class CommitConflict(RuntimeError):
    """Another writer committed first; nothing of this commit is visible."""


@dataclass(frozen=True)
class Version:
    """One manifest row: which commit holds each bucket's rows."""
    version: int
    id: str
    keys: tuple[str, ...]
    bucket_by: tuple[str, ...]
    n_buckets: int
    schema: StructType
    folders: dict[int, str]


class VersionedTable:
    """The table at ``path``. Its keys and bucket count are set by ``create`` and never change."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    @classmethod
    def create(cls, spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], n_buckets: int = 64,
               bucket_by: Sequence[str] | None = None) -> VersionedTable:
        """An empty table (version 0). Choose ``n_buckets`` so that a bucket is a fair unit to rewrite: thousands for a
        table of terabytes. ``bucket_by``: the part of the keys that decides the bucket."""
        t, by = cls(spark, path), tuple(bucket_by or keys)
        missing = [k for k in keys if k not in schema.fieldNames()] + [k for k in by if k not in keys]
        if missing:
            raise ValueError(f"no such column or key: {missing}")
        if t._chain():
            raise ValueError(f"{path} holds a table")
        t._commit(Version(0, "", tuple(keys), by, n_buckets, schema, {}), "")
        return t

    def _chain(self) -> list[tuple[int, str]]:
        """(version, commit id) of the valid commits, oldest first. A row a commit: small beside the table."""
        rows = _read_if_there(self.spark, f"{self.path}/manifest")
        after: dict[str, tuple[str, int]] = {}
        for r in rows.select("version", "id", "follows").collect() if rows is not None else ():
            after[r.follows] = min(after.get(r.follows, (r.id, r.version)), (r.id, r.version))
        chain, at = [], ""
        while at in after:
            at, version = after[at]
            chain.append((version, at))
        return chain

    def versions(self) -> list[int]:
        return [v for v, _ in self._chain()]

    def at(self, version: int | None = None) -> Version:
        """The manifest of a version, the newest by default."""
        chain = dict(self._chain())
        if not chain or version is not None and version not in chain:
            raise LookupError(f"no version {version} at {self.path}" if chain else f"no table at {self.path}")
        commit = chain[max(chain) if version is None else version]
        r = self.spark.read.parquet(f"{self.path}/manifest").where(F.col("id") == commit).first()
        return Version(r.version, r.id, tuple(r["keys"]), tuple(r.bucket_by), r.n_buckets, StructType.fromJson(json.loads(r.columns)), dict(r.folders or {}))

    def read(self, version: int | Version | None = None, buckets: Sequence[int] | None = None) -> DataFrame:
        """The rows of a version (only some buckets): one scan over the folders it names."""
        v = version if isinstance(version, Version) else self.at(version)
        paths = [f"{self.path}/data/commit={folder}/{BUCKET}={b}" for b, folder in sorted(v.folders.items()) if buckets is None or b in set(buckets)]
        if not paths:
            return self.spark.createDataFrame([], v.schema)
        files = StructType([*v.schema.fields, StructField(BUCKET, IntegerType())])
        return self.spark.read.schema(files).option("basePath", f"{self.path}/data").parquet(*paths).select(*[F.col(f"`{n}`") for n in v.schema.names])

    def merge(self, updates: DataFrame | None = None, deletes: DataFrame | None = None, order_col: str | None = None) -> int:
        """One commit: rows whose keys are in ``deletes`` go, then ``updates`` are merged (``merge_features``: one row a key,
        null keys match, new columns are added, with ``order_col`` newer stored rows stay). Returns the new version; without
        updates and deletes nothing is committed. Updates are computed once; the merged buckets are written once."""
        old = self.at()
        keys, by = list(old.keys), list(old.bucket_by)
        parts = {}
        if updates is not None:
            parts["updates"] = materialize(one_per_key(updates, keys, order_col).withColumn(BUCKET, key_bucket(by, old.n_buckets)))
        if deletes is not None:
            parts["deletes"] = materialize(deletes.select(*keys).distinct().withColumn(BUCKET, key_bucket(by, old.n_buckets)))
        touched = sorted({r[0] for p in parts.values() for r in p.select(BUCKET).distinct().collect()})  # n_buckets numbers at most
        if not touched:
            return old.version
        rows = self.read(old, touched).withColumn(BUCKET, key_bucket(by, old.n_buckets))
        if deletes is not None:
            gone = parts["deletes"].drop(BUCKET).withColumnsRenamed({k: f"_gone_{k}" for k in keys})
            same = F.lit(True)
            for k in keys:
                same = same & F.col(k).eqNullSafe(F.col(f"_gone_{k}"))
            rows = rows.join(gone, same, "left_anti")
        if updates is not None:
            rows = merge_features(rows, parts["updates"], [*keys, BUCKET], order_col, unique=True)
        commit = f"{old.version + 1:08d}-{uuid.uuid4().hex[:12]}"
        columns = [n for n in rows.columns if n != BUCKET]
        columns = [*old.schema.names, *[n for n in columns if n not in old.schema.names]]
        rows = rows.select(*columns, BUCKET)
        folder = f"{self.path}/data/commit={commit}"
        rows.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(folder)
        schema = StructType([*old.schema.fields, *[rows.schema[n] for n in columns if n not in old.schema.names]])
        filled = touched  # upserts alone leave no bucket empty
        if deletes is not None:
            written = self.spark.read.schema(StructType([*schema.fields, StructField(BUCKET, IntegerType())])).parquet(folder)
            filled = [r[0] for r in written.select(BUCKET).distinct().collect()]
        folders = {b: f for b, f in old.folders.items() if b not in touched} | {b: commit for b in filled}
        self._commit(Version(old.version + 1, commit, old.keys, old.bucket_by, old.n_buckets, schema, folders), old.id)
        return old.version + 1

    def _commit(self, v: Version, follows: str) -> None:
        """Append the manifest row, in one file, and make sure that it counts."""
        commit = v.id or f"{v.version:08d}-{uuid.uuid4().hex[:12]}"
        row = (v.version, commit, follows, list(v.keys), list(v.bucket_by), v.n_buckets, v.schema.json(), v.folders)
        self.spark.createDataFrame([row], MANIFEST).coalesce(1).write.mode("append").parquet(f"{self.path}/manifest")
        if commit not in [i for _, i in self._chain()]:
            raise CommitConflict(f"version {v.version} of {self.path} was committed by another writer")

    def changed_buckets(self, old: int, new: int) -> list[int]:
        a, b = self.at(old).folders, self.at(new).folders
        return sorted(n for n in a.keys() | b.keys() if a.get(n) != b.get(n))

    def changes(self, old: int, new: int) -> DataFrame:
        """Change feed between two versions (insert, update, delete a key), from the buckets written in between alone."""
        buckets = self.changed_buckets(old, new)
        return table_changes(self.read(old, buckets), self.read(new, buckets), self.at(new).keys)


def refresh_snapshot(source: VersionedTable, snapshot: VersionedTable, old: int, new: int, ts: str, tie_breakers: Sequence[str] = ()) -> int:
    """S10 kept up to date: bring ``snapshot`` (one row an entity, the newest) from version ``old`` of ``source`` to ``new``.

    Only entities in the change feed are looked at: their rows come from the buckets written in between, so ``source`` must
    be bucketed by the snapshot's keys. Late rows, corrections and deletions of the newest row are covered, as an entity's
    newest row is taken anew from all its rows; entities without rows leave the snapshot. Returns the snapshot's version.
    """
    entity = list(snapshot.at().keys)
    if list(source.at(new).bucket_by) != entity:
        raise ValueError(f"the source must be bucketed by {entity}")
    touched = materialize(source.changes(old, new).select(*entity).distinct())
    rows = source.read(new, source.changed_buckets(old, new))
    same = F.lit(True)
    for k in entity:
        same = same & F.col(k).eqNullSafe(F.col(f"_t_{k}"))
    rows = rows.join(touched.withColumnsRenamed({k: f"_t_{k}" for k in entity}), same, "left_semi")
    return snapshot.merge(latest_snapshot(rows, entity, ts, tie_breakers), deletes=touched)
