"""Helpers shared by the corpus operators."""

from __future__ import annotations

import base64
import json

import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from featureflow.session import scratch_path

# Word definition that all contracts share: runs of anything but space and U+0009..U+000D.
SPACES = " \t\n\x0b\f\r"
WORD_GAP = r"[\x20\x09-\x0D]+"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def c(name: str) -> Column:
    """A column by its exact name (dots and spaces included)."""
    return F.col("`" + name.replace("`", "``") + "`")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like ``names`` that no column of ``df`` has (Spark compares them without case)."""
    taken, out = {x.lower() for x in df.columns}, []
    for n in names:
        while n.lower() in taken:
            n = "_" + n
        taken.add(n.lower())
        out.append(n)
    return out


def text_of(col: Column) -> Column:
    """Null text reads as empty text."""
    return F.coalesce(col.cast("string"), F.lit(""))


def words(text: Column) -> Column:
    """Words of a text as an array; empty for null and blank texts."""
    core = F.btrim(text_of(text), F.lit(SPACES))
    return F.when(core == "", F.array().cast("array<string>")).otherwise(F.split(core, WORD_GAP))


def n_words(text: Column) -> Column:
    """Number of words (long)."""
    core = F.btrim(text_of(text), F.lit(SPACES))
    return F.when(core == "", F.lit(0)).otherwise(F.size(F.split(core, WORD_GAP))).cast("long")


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z, every other character as it is."""
    return F.translate(text, UPPER, UPPER.lower())


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once below the shared folder (spark.checkpoint.dir) and read it back: cuts
    lineage, survives lost executors and is compressed."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


BUCKET = 8  # keys in a bucket of a literal map, about


class LiteralMap:
    """A hash map as literal arrays of buckets, one of keys and one of values, that lambdas can read. Spark's own
    map lookup compares key by key; here only a bucket's few keys are compared. ``table`` is one literal; bind it
    once with ``let`` and pass the bound variable to ``get``."""

    def __init__(self, items: dict, value_type: str, key_type: str = "string"):
        self.n = 1 << max(0, (len(items) // BUCKET).bit_length())
        keys, values = [[] for _ in range(self.n)], [[] for _ in range(self.n)]
        for k, v in items.items():
            raw = k if isinstance(k, bytes) else k.encode()
            b = xxhash.xxh64_intdigest(raw, 42) % self.n  # what pmod(xxhash64(key), n) gives: n is a power of two
            keys[b].append(base64.b64encode(k).decode() if isinstance(k, bytes) else k)
            values[b].append(v)
        text = json.dumps({"k": keys, "v": values})
        self.table = F.from_json(F.lit(text), f"k array<array<{key_type}>>, v array<array<{value_type}>>")

    def get(self, table: Column, key: Column) -> Column:
        """The value of a key, null if there is none. ``key`` is read twice: a plain variable."""
        b = F.pmod(F.xxhash64(key), F.lit(self.n)).cast("int")
        return F.get(F.get(table["v"], b), F.array_position(F.get(table["k"], b), key).cast("int") - 1)


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
