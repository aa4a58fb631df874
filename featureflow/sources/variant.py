"""JSON payloads of unknown shape (S13): parsed once into a VARIANT column, columns found by an aggregate over the data,
rows that don't parse kept aside."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_COLUMNS = 1000  # fields that become columns, the most frequent first; all others stay readable in the VARIANT column
BROKEN, NO_OBJECT = "not json", "not an object"


@dataclass(frozen=True)
class Field:
    """A top-level key, the type that holds all its values (VARIANT if no simple one does) and the rows that have it."""
    name: str
    type: str
    rows: int


def _free(df: DataFrame, name: str) -> str:
    taken = {x.lower() for x in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def _col(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def parse_variant(df: DataFrame, col: str, out: str = "payload", reason: str = "reason") -> DataFrame:
    """Adds ``out`` (VARIANT, null unless the text is one JSON object) and ``reason`` (null for accepted rows and for null
    texts, else why the row is rejected). Text with a repeated key is not JSON here."""
    for name in (out, reason):
        if _free(df, name) != name:
            raise ValueError(f"column {name} exists")
    tmp = _free(df, "parsed_")
    d = df.withColumn(tmp, F.try_parse_json(_col(col)))
    is_object = F.schema_of_variant(_col(tmp)).startswith("OBJECT")
    why = F.when(_col(col).isNull(), F.lit(None).cast("string")).when(_col(tmp).isNull(), BROKEN).when(~is_object, NO_OBJECT)
    return d.withColumn(reason, why).withColumn(out, F.when(_col(reason).isNull(), _col(tmp))).drop(tmp)


def payload_fields(df: DataFrame, payload: str = "payload") -> DataFrame:
    """(name, type, rows) of every top-level key: the keys are exploded and their types merged by Spark. JSON null
    agrees with every type; a key that is never anything else has type VOID."""
    pairs = df.select(_col(payload).alias("v")).where("v IS NOT NULL").lateralJoin(
        df.sparkSession.tvf.variant_explode(F.col("v").outer())).select("key", "value")
    return pairs.groupBy(F.col("key").alias("name")).agg(F.schema_of_variant_agg("value").alias("type"), F.count(F.lit(1)).alias("rows"))


def find_fields(df: DataFrame, payload: str = "payload", max_columns: int = MAX_COLUMNS) -> list[Field]:
    """The ``max_columns`` most frequent fields, ties by name, in order of name."""
    top = payload_fields(df, payload).orderBy(F.desc("rows"), "name").limit(max_columns).collect()
    return sorted((Field(r.name, r.type, r.rows) for r in top), key=lambda f: f.name)


def _value(payload: str, f: Field) -> Column | None:
    quote = "'" if "'" not in f.name else '"' if '"' not in f.name else None
    if quote is None:  # no path can name it: it stays in the payload
        return None
    nested = f.type.startswith(("OBJECT", "ARRAY")) or f.type in ("VARIANT", "VOID")
    return F.try_variant_get(_col(payload), f"$[{quote}{f.name}{quote}]", "variant" if nested else f.type)


def expand_fields(df: DataFrame, fields: list[Field], payload: str = "payload", prefix: str = "") -> DataFrame:
    """A column a field: simple types as such, nested and mixed ones as VARIANT. Names that differ from another column's
    by case alone, or not at all, get underscores in front. Rows without the field have null."""
    out = df
    for f in fields:
        value = _value(payload, f)
        if value is not None:
            out = out.withColumn(_free(out, prefix + f.name), value)
    return out


def unpack_variant(df: DataFrame, col: str, prefix: str = "", fields: list[Field] | None = None,
                   max_columns: int = MAX_COLUMNS, keep_payload: bool = True) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected): the accepted rows with a column for each field of the data (or of ``fields``, e.g. those of an
    earlier load) and, if wanted, the VARIANT column; the rejected rows as they came, with their reason. Every input row is
    in exactly one of the two; null texts are accepted with all fields null."""
    payload, reason = _free(df, "payload"), _free(df, "reason")
    parsed = parse_variant(df, col, payload, reason)
    good = parsed.where(_col(reason).isNull()).drop(reason)
    bad = parsed.where(_col(reason).isNotNull()).drop(payload)
    out = expand_fields(good, find_fields(good, payload, max_columns) if fields is None else fields, payload, prefix)
    return (out if keep_payload else out.drop(payload)), bad
