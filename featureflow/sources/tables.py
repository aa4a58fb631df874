"""Scans, sinks and table-level sources."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

TABLE_NAMES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


class Tables:
    """Lazy access to the parquet tables of one data directory.

    ``tables.orders`` is a plain ``spark.read.parquet`` DataFrame, so projections
    and filters applied later reach the scan (``PushedFilters`` / ``ReadSchema``).
    """

    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in TABLE_NAMES:
            raise AttributeError(name)
        path = f"{self.base}/{name}.parquet"
        df = read_path(self.spark, "parquet", path)
        self.__dict__[name] = df  # one file listing / footer read per table and plan
        return df

    def register(self, names: Sequence[str] = TABLE_NAMES) -> None:
        """Expose the tables as temporary views for ``spark.sql``."""
        for n in names:
            getattr(self, n).createOrReplaceTempView(n)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Catalog table scan."""
    return spark.table(name)


def read_path(spark: SparkSession, fmt: str, path: str, schema: StructType | None = None,
              **options: str) -> DataFrame:
    """Path-addressed scan of any built-in format."""
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def ingest_csv(spark: SparkSession, path: str, table: str | None = None, schema: StructType | None = None,
               if_absent: bool = True, normalize: bool = True, location: str | None = None) -> DataFrame:
    """S3: CSV with a header row -> bronze table, written only if it is absent.

    Pass ``schema`` in production (schema inference reads the data twice).
    ``table`` is a catalog name; ``location`` (optional) an external path for it.
    """
    from featureflow.operators.clean import normalize_columns

    if table is not None and if_absent and spark.catalog.tableExists(table):
        return spark.table(table)
    reader = spark.read.option("header", "true")
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", "true")
    df = reader.csv(path)
    if normalize:
        df = normalize_columns(df)
    if table is None:
        return df
    write_table(df, table, location=location)
    return spark.table(table)


def write_table(df: DataFrame, name: str, mode: str = "overwrite", overwrite_schema: bool = True,
                location: str | None = None, partition_by: Sequence[str] = (), fmt: str = "parquet") -> None:
    """Replace a table (data and schema) or write any mode to a catalog name."""
    w = df.write.mode(mode).format(fmt)
    if overwrite_schema and mode == "overwrite":
        w = w.option("overwriteSchema", "true")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if location is not None:
        w = w.option("path", location)
    w.saveAsTable(name)


def write_path(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = (),
               fmt: str = "parquet") -> None:
    """Path-addressed sink (the counterpart of S2)."""
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def append_table(df: DataFrame, name: str | None = None, path: str | None = None, fmt: str = "parquet") -> None:
    """Append log rows to a catalog table or a path."""
    if name is not None:
        df.write.mode("append").format(fmt).saveAsTable(name)
    elif path is not None:
        df.write.mode("append").format(fmt).save(path)
    else:
        raise ValueError("append_table needs a table name or a path")


def log_row(spark: SparkSession, values: Mapping[str, object], schema: StructType) -> DataFrame:
    """A one-row DataFrame built from driver values (e.g. one validation result)."""
    return spark.createDataFrame([tuple(values.get(f.name) for f in schema.fields)], schema)


def ensure_schema(spark: SparkSession, name: str, use: bool = True) -> None:
    """Create the namespace if absent and make it current."""
    if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*){0,2}", name):
        raise ValueError(f"bad schema name {name!r}")
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}")
    if use:
        spark.sql(f"USE {name}")  # with its catalog, where one is named


def unpack_payload(df: DataFrame, col: str, schema: StructType | str, prefix: str = "",
                   keep: bool = False) -> DataFrame:
    """JSON request/response payload -> typed columns (``from_json`` + expand)."""
    parsed = F.from_json(F.col(col), schema)
    tmp = f"__{col}_parsed"
    out = df.withColumn(tmp, parsed)
    fields = out.schema[tmp].dataType.fieldNames()
    out = out.select(*[c for c in df.columns if keep or c != col],
                     *[F.col(f"{tmp}.{f}").alias(f"{prefix}{f}") for f in fields])
    return out


# --------------------------------------------------------------------------------------
# Deterministic synthetic rows. Every column is a function of (row key, column
# name, seed) through md5, so the result is identical at any partitioning and can be
# recomputed by any SQL engine that has md5.
# --------------------------------------------------------------------------------------

@dataclass(frozen=True)
class Choice:
    values: tuple
    weights: tuple | None = None


@dataclass(frozen=True)
class Steps:
    lo: float
    hi: float
    step: float
    dtype: str = "double"


@dataclass(frozen=True)
class Template:
    """Text from a pattern: 'd' -> a digit, 'A' -> an upper-case letter, else kept."""
    pattern: str


@dataclass(frozen=True)
class TimeSteps:
    """Timestamps begin, begin + step, ... up to end (inclusive), as TIMESTAMP_NTZ."""
    begin: "dt.datetime"
    end: "dt.datetime"
    step_seconds: int


LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _template_col(key: Column, salt: str, spec: Template) -> Column:
    parts = []
    for i, ch in enumerate(spec.pattern):
        if ch not in "dA":
            parts.append(F.lit(ch))
            continue
        h = F.md5(F.concat(key.cast("string"), F.lit(f":{salt}:{i // 16}")))
        byte = F.conv(F.substring(h, 2 * (i % 16) + 1, 2), 16, 10).cast("int")
        parts.append((byte % 10).cast("string") if ch == "d" else F.substring(F.lit(LETTERS), byte % 26 + 1, 1))
    return F.concat(*parts)


def _time_col(h: Column, spec: TimeSteps) -> Column:
    b = int(spec.begin.replace(tzinfo=dt.timezone.utc).timestamp())
    e = int(spec.end.replace(tzinfo=dt.timezone.utc).timestamp())
    n = (e - b) // spec.step_seconds + 1
    return F.timestamp_seconds(F.lit(b) + (h % n) * F.lit(spec.step_seconds)).cast("timestamp_ntz")


def unit_hash(key: Column, salt: str) -> Column:
    """Integer in [0, 2^32) from md5(key ':' salt): first 8 hex digits."""
    h = F.md5(F.concat(key.cast("string"), F.lit(":" + salt)))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint")


def _choice_col(h: Column, spec: Choice) -> Column:
    weights = spec.weights or tuple(1.0 for _ in spec.values)
    total = float(sum(weights))
    expr = None
    acc = 0.0
    for v, w in zip(spec.values[:-1], weights[:-1]):
        acc += w
        bound = int(acc / total * 2**32)
        expr = F.when(h < bound, F.lit(v)) if expr is None else expr.when(h < bound, F.lit(v))
    last = F.lit(spec.values[-1])
    return last if expr is None else expr.otherwise(last)


def _steps_col(h: Column, spec: Steps) -> Column:
    n = int(round((spec.hi - spec.lo) / spec.step)) + 1
    return (F.lit(spec.lo) + (h % n) * F.lit(spec.step)).cast(spec.dtype)


def generate_rows(spark: SparkSession, rows: int, specs: Mapping[str, Choice | Steps | Template | TimeSteps], key: str = "id",
                  seed: int = 42, first: int = 0) -> DataFrame:
    """S12 by a row count: ``rows`` keys from ``first`` on, dealt over the cluster by ``spark.range``. A row depends on its key
    and the seed alone, so a longer table begins with the shorter one and parts can be made apart."""
    if rows < 0:
        raise ValueError("rows must not be negative")
    return generate_table(spark.range(first, first + rows).withColumnRenamed("id", key), key, specs, seed)


def generate_table(ids: DataFrame, key: str, specs: Mapping[str, Choice | Steps | Template | TimeSteps],
                   seed: int = 42) -> DataFrame:
    """Add synthetic columns to a keyed frame (weighted choices, stepped ranges,
    text templates, stepped timestamps).

    The row count is the caller's frame, so the work scales with the data it is
    derived from; no driver-side data is created.
    """
    cols = []
    for name, spec in specs.items():
        salt = f"{name}:{seed}"
        h = unit_hash(F.col(key), salt)
        if isinstance(spec, Choice):
            c = _choice_col(h, spec)
        elif isinstance(spec, Steps):
            c = _steps_col(h, spec)
        elif isinstance(spec, Template):
            c = _template_col(F.col(key), salt, spec)
        elif isinstance(spec, TimeSteps):
            c = _time_col(h, spec)
        else:
            raise TypeError(spec)
        cols.append(c.alias(name))
    return ids.select(F.col(key), *cols)
