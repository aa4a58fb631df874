"""Keyed, time-stamped feature tables (S7-S11): spec, create, upsert, checks, snapshots,
change feed. Parquet has no MERGE, so an upsert is an explicit plan: a full outer join
on the key, stored by replacing only the hash-bucket partitions it touches."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from featureflow.operators.lookup import latest_snapshot  # noqa: F401  (re-export)


@dataclass(frozen=True)
class FeatureTableSpec:
    name: str
    primary_keys: tuple[str, ...]
    timeseries_column: str | None = None
    description: str = ""


def create_feature_table(spark: SparkSession, spec: FeatureTableSpec, schema: StructType, path: str,
                         register: bool = False, n_buckets: int | None = None) -> DataFrame:
    """An empty table with the given schema; key and time column are checked.

    The spec's keys and the bucket count go to ``<path>/_meta``, where ``upsert_table`` finds
    them. A path that holds rows is refused.
    ``register=True`` also creates the catalog table ``spec.name`` over ``path`` and
    keeps the spec as table properties (``feature_table_spec`` reads it back).
    """
    for k in (*spec.primary_keys, *([spec.timeseries_column] if spec.timeseries_column else [])):
        if k not in schema.fieldNames():
            raise ValueError(f"{k} is not a column of the schema")
    stored = read_feature_table(spark, path)
    if stored is not None and not stored.isEmpty():
        raise ValueError(f"{path} holds rows")
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)
    _write_meta(spark, path, n_buckets or DEFAULT_BUCKETS, spec.primary_keys)
    if register:
        props = {"featureflow.primary_keys": ",".join(spec.primary_keys),
                 "featureflow.timeseries_column": spec.timeseries_column or "",
                 "featureflow.description": spec.description.replace("'", "")}
        prop_sql = ", ".join(f"'{k}' = '{v}'" for k, v in props.items())
        spark.sql(f"CREATE TABLE IF NOT EXISTS {spec.name} USING parquet LOCATION '{path}' TBLPROPERTIES ({prop_sql})")
        return spark.table(spec.name)
    return spark.read.schema(schema).parquet(path)


def feature_table_spec(spark: SparkSession, name: str) -> FeatureTableSpec:
    """The spec kept as table properties by ``create_feature_table(register=True)``."""
    props = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    keys = tuple(k for k in props.get("featureflow.primary_keys", "").split(",") if k)
    return FeatureTableSpec(name, keys, props.get("featureflow.timeseries_column") or None,
                            props.get("featureflow.description", ""))


def one_per_key(updates: DataFrame, keys: Sequence[str], order_col: str | None = None) -> DataFrame:
    """One row a key: the newest by ``order_col``, of equals (or without it) the largest row. Ranked with
    ``row_number = 1``: a hot key is cut to one row in every task before the shuffle."""
    rest = [c for c in updates.columns if c not in keys]
    if not rest:
        return updates.distinct()
    first = [order_col] if order_col in rest else []
    order = [F.desc_nulls_last(c) for c in first + [c for c in rest if c not in first]]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    name = "_rank"
    while name in updates.columns:
        name = "_" + name
    return updates.withColumn(name, rank).where(F.col(name) == 1).select(*updates.columns)


def merge_features(target: DataFrame, updates: DataFrame, keys: Sequence[str], order_col: str | None = None, unique: bool = False) -> DataFrame:
    """Upsert ``updates`` into ``target`` on ``keys``.

    * matched key: columns present in ``updates`` take the update's value (also a
      null), columns only in ``target`` keep the target's value;
    * new key: inserted, columns it lacks are null (schema evolution);
    * unmatched target rows are kept.
    One full outer join: each side is shuffled once on the key. Idempotent:
    merging the same updates twice gives the same table. Updates are reduced to one row
    a key first and null keys match each other, so a key never gets a second row. With
    ``order_col`` a stored row that is newer than its update stays. ``unique``: the updates have one row a key already.
    """
    keys = list(keys)
    updates = updates if unique else one_per_key(updates, keys, order_col)
    t_cols = [c for c in target.columns if c not in keys]
    u_cols = [c for c in updates.columns if c not in keys]
    t = target.select(*keys, F.struct(*t_cols).alias("_t"), F.lit(True).alias("_tp"))
    u = updates.select(*keys, F.struct(*u_cols).alias("_u"), F.lit(True).alias("_up"))
    u = u.withColumnsRenamed({k: f"_u_{k}" for k in keys})
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_u_{k}"))
    j = t.join(u, on, "full_outer")
    has_u = F.col("_up").isNotNull()
    if order_col and order_col in t_cols and order_col in u_cols:
        has_u = has_u & ~F.coalesce(F.col(f"_t.{order_col}") > F.col(f"_u.{order_col}"), F.lit(False))
    out = []
    for c in t_cols + [c for c in u_cols if c not in t_cols]:
        if c in u_cols and c in t_cols:
            out.append(F.when(has_u, F.col(f"_u.{c}")).otherwise(F.col(f"_t.{c}")).alias(c))
        elif c in u_cols:
            out.append(F.when(has_u, F.col(f"_u.{c}")).alias(c))
        else:
            out.append(F.col(f"_t.{c}").alias(c))
    key = [F.when(F.col("_tp").isNotNull(), F.col(k)).otherwise(F.col(f"_u_{k}")).alias(k) for k in keys]
    return j.select(*key, *out)


def check_constraints(df: DataFrame, primary_keys: Sequence[str], not_null: Sequence[str] = ()) -> DataFrame:
    """Violations as rows (constraint, column, key, n).

    primary_key: one row per duplicated key (key rendered as text, '|'-joined);
    not_null: one row per column that holds nulls (key column null counts too).
    Both parts are plain aggregations (partial, map-side), no collect.
    """
    keys = list(primary_keys)
    key_txt = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("<null>")) for k in keys])
    dup = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
           .select(F.lit("primary_key").alias("constraint"), F.lit(",".join(keys)).alias("column"),
                   key_txt.alias("key"), F.col("n")))
    nn_cols = list(dict.fromkeys([*keys, *not_null]))
    nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in nn_cols])
    stacked = nulls.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("n")) for c in nn_cols])).alias("s"))
    nn = stacked.where(F.col("s.n") > 0).select(
        F.lit("not_null").alias("constraint"), F.col("s.column").alias("column"),
        F.lit(None).cast("string").alias("key"), F.col("s.n").alias("n"))
    return dup.unionByName(nn)


def table_changes(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Change feed between two versions: insert / update / delete per key.

    Null-safe comparison (``<=>``) of every non-key column; unchanged keys are
    omitted; null keys match each other; a column that ``old`` lacks counts as null there.
    One full outer join on the key.
    """
    keys = list(keys)
    cols = [c for c in new.columns if c not in keys]

    def had(c):
        return F.col(c) if c in old.columns else F.lit(None).cast(new.schema[c].dataType).alias(c)
    o = old.select(*keys, F.struct(*[had(c) for c in cols]).alias("_o"))
    n = new.select(*[F.col(k).alias(f"_n_{k}") for k in keys], F.struct(*cols).alias("_n"))
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_n_{k}"))
    j = o.join(n, on, "full_outer")
    same = F.lit(True)
    for c in cols:
        same = same & F.col(f"_o.{c}").eqNullSafe(F.col(f"_n.{c}"))
    kind = (F.when(F.col("_o").isNull(), F.lit("insert"))
            .when(F.col("_n").isNull(), F.lit("delete"))
            .when(~same, F.lit("update")))
    j = j.withColumn("change_type", kind).where(F.col("change_type").isNotNull())
    side = F.when(F.col("change_type") == "delete", F.col("_o")).otherwise(F.col("_n"))
    key = [F.when(F.col("_n").isNull(), F.col(k)).otherwise(F.col(f"_n_{k}")).alias(k) for k in keys]
    return j.select(*key, "change_type", *[side[c].alias(c) for c in cols])


# ----------------------------------------------------------------------------------
# Stored feature table: Parquet partitioned by a hash bucket of the key. An upsert
# reads only the buckets its updates touch (partition pruning), merges them, cuts the
# lineage with a reliable checkpoint and replaces just those partitions (dynamic
# partition overwrite), so its cost follows the update, not the table.
# ----------------------------------------------------------------------------------

BUCKET_COL = "_bucket"


def key_bucket(keys: Sequence[str], n_buckets: int):
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(n_buckets)).cast("int")


def read_feature_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The stored table (schema merged across buckets), or None if it does not exist."""
    return _read_if_there(spark, path)


def _read_if_there(spark: SparkSession, path: str) -> DataFrame | None:
    """None only where nothing is stored; every other failure is raised."""
    from pyspark.errors import AnalysisException
    try:
        return spark.read.option("mergeSchema", "true").parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


DEFAULT_BUCKETS = 16


def table_buckets(spark: SparkSession, path: str, requested: int | None = None) -> tuple[int, bool]:
    """The bucket count of the stored table (kept in ``<path>/_meta``, which Parquet
    readers skip), or the requested / default count for a new table. A table's
    count never changes: keys would land in different buckets."""
    meta = _read_if_there(spark, f"{path}/_meta")
    row = meta.first() if meta is not None else None
    if row is None:
        if read_feature_table(spark, path) is not None:
            raise ValueError(f"{path} holds rows but no _meta: its bucket count and keys are unknown")
        return (requested or DEFAULT_BUCKETS), False
    if requested is not None and requested != row["n_buckets"]:
        raise ValueError(f"table at {path} has {row['n_buckets']} buckets, not {requested}")
    return row["n_buckets"], True


def _write_meta(spark: SparkSession, path: str, n_buckets: int, keys: Sequence[str]) -> None:
    spark.createDataFrame([(n_buckets, ",".join(keys))], "n_buckets int, keys string") \
        .write.mode("overwrite").parquet(f"{path}/_meta")


def table_keys(spark: SparkSession, path: str) -> list[str] | None:
    """The keys of the stored table, or None if nothing is stored."""
    meta = _read_if_there(spark, f"{path}/_meta")
    row = meta.first() if meta is not None else None
    return row["keys"].split(",") if row is not None else None


def upsert_table(spark: SparkSession, updates: DataFrame, keys: Sequence[str] | None, path: str,
                 n_buckets: int | None = None, order_col: str | None = None) -> None:
    """S8 on a stored table: merge ``updates`` into the table at ``path``.

    ``_meta`` is written before the first rows, so a job that stops in between leaves an
    empty table, and rows without ``_meta`` are refused: an upsert never takes a stored
    table for a new one. ``order_col``: newer stored rows win over older updates.
    Idempotent (re-running the same updates leaves the table unchanged), so it is
    safe under at-least-once delivery. ``keys`` None: those the table was created with; other
    keys than those are refused. ``n_buckets`` is fixed when the table is
    created (default 16; size it so a bucket is a comfortable rewrite unit, e.g.
    thousands for a multi-terabyte table) and read back afterwards. The set of
    touched buckets is at most ``n_buckets`` values.
    """
    from featureflow.session import materialize
    n_buckets, known = table_buckets(spark, path, n_buckets)
    stored_keys = table_keys(spark, path)
    if keys is None and stored_keys is None:
        raise ValueError(f"nothing is stored at {path}: name the keys")
    keys = list(keys) if keys is not None else stored_keys
    if stored_keys is not None and sorted(keys) != sorted(stored_keys):
        raise ValueError(f"table at {path} has the keys {stored_keys}, not {keys}")
    keys = stored_keys or keys  # in the stored order, which the bucket depends on
    if not known:
        _write_meta(spark, path, n_buckets, keys)
    upd = one_per_key(updates, keys, order_col).withColumn(BUCKET_COL, key_bucket(keys, n_buckets))
    current = read_feature_table(spark, path) if known else None
    if current is None:
        merged = upd
    else:
        if BUCKET_COL not in current.columns:  # created, no rows yet
            current = current.withColumn(BUCKET_COL, key_bucket(keys, n_buckets))
        touched = [r[0] for r in upd.select(BUCKET_COL).distinct().collect()]
        if not touched:
            return
        cur = current.where(F.col(BUCKET_COL).isin(touched))
        merged = merge_features(cur, upd, [*keys, BUCKET_COL], order_col, unique=True)
    # the partitions being replaced are also being read: materialise first
    merged = materialize(merged)
    (merged.hint("rebalance", BUCKET_COL).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(BUCKET_COL).parquet(path))


def feature_table(spark: SparkSession, path: str) -> DataFrame:
    df = read_feature_table(spark, path)
    if df is None:
        raise FileNotFoundError(path)
    return df.drop(BUCKET_COL)
