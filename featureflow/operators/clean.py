"""DataFrame-level cleaning and projection operators."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, NumericType

from featureflow.functions import columns as C

# The six optional-service columns and the flag value counted over them.
SERVICE_COLUMNS = ("online_security", "online_backup", "device_protection", "tech_support",
                   "streaming_tv", "streaming_movies")
FLAG_VALUE = "Yes"
# Senior-citizen recode (other values -> null).
SENIOR_MAP = {"1": "Yes", "0": "No"}
# Default train / validate / test ratios and seed.
SPLIT_RATIOS = (("train", 0.7), ("validate", 0.2), ("test", 0.1))
SPLIT_SEED = 42


def snake_name(name: str) -> str:
    """Words of a column name joined by underscores: a capital inside the name and a space or
    hyphen each start a word, parentheses go, a run of underscores is one. A space before a
    capital therefore gives two underscores ("Total Charges" -> total__charges)."""
    out = []
    for before, ch in zip(" " + name, name):
        if ch in " -" or ch == "_" and before != "_":
            out.append("_")
        elif ch not in "()_":
            inner = out and before != "_" and "A" <= ch <= "Z"
            out.append("_" + ch.lower() if inner else ch.lower())
    return "".join(out)


# Explicit renames applied after the snake_case rule.
DEFAULT_RENAMES = {"streaming_t_v": "streaming_tv", "customer_i_d": "customer_id"}


def normalize_columns(df: DataFrame, renames: Mapping[str, str] | None = None) -> DataFrame:
    """B1: rename every column to snake_case, then apply explicit renames (metadata only)."""
    ren = DEFAULT_RENAMES if renames is None else renames
    names = [snake_name(c) for c in df.columns]
    names = [ren.get(n, n) for n in names]
    return df.toDF(*names)


def count_flags(df: DataFrame, cols: Sequence[str] = SERVICE_COLUMNS, value: str = FLAG_VALUE,
                out: str = "num_optional_services") -> DataFrame:
    """B2: number of ``cols`` equal to ``value`` (null -> not counted), bigint."""
    return df.withColumn(out, C.flag_count(cols, value))


def recode(df: DataFrame, col: str, mapping: Mapping[str, str] = SENIOR_MAP, out: str | None = None) -> DataFrame:
    """Value map, unmapped -> null."""
    return df.withColumn(out or col, C.recode_expr(col, mapping))


def parse_number(df: DataFrame, col: str, blank: float = 0.0, out: str | None = None,
                 reject_col: str | None = None) -> DataFrame:
    """Blank-safe text -> double; optionally flag rejected (unparsable) text."""
    if reject_col:
        df = df.withColumn(reject_col, C.parse_rejected(col))
    return df.withColumn(out or col, C.parse_number_expr(col, blank))


def coerce_numeric(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Cast to double, errors -> null (numeric columns are cast directly)."""
    return df.withColumns({c: F.col(c).cast("double") if isinstance(df.schema[c].dataType, NumericType)
                           else C.coerce_numeric_expr(c) for c in cols})


def fill_missing(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Per-column null default."""
    return df.fillna(dict(defaults))


def stamp(df: DataFrame, **constants) -> DataFrame:
    """Literal metadata columns (feature time, model name/version/alias, scoring time)."""
    return df.withColumns({k: (v if isinstance(v, Column) else F.lit(v)) for k, v in constants.items()})


def add_price_increase(df: DataFrame, monthly: str = "monthly_charges", tenure: str = "tenure",
                       total: str = "total_charges", out: str = "avg_price_increase") -> DataFrame:
    """B8 as a DataFrame step."""
    return df.withColumn(out, C.price_increase(monthly, tenure, total))


def select_supported(df: DataFrame, cols: Sequence[str], strict: bool = False) -> DataFrame:
    """Keep the model's columns in the model's order; extras are dropped."""
    missing = [c for c in cols if c not in df.columns]
    if missing and strict:
        raise ValueError(f"missing model columns: {missing}")
    return df.select(*[c for c in cols if c in df.columns])


def drop_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Projection by exclusion."""
    return df.drop(*cols)


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename."""
    return df.withColumnsRenamed(dict(mapping))


def split_thresholds(ratios=SPLIT_RATIOS) -> list[tuple[str, int]]:
    """Cumulative integer thresholds on the 32-bit hash for each split name."""
    total = float(sum(r for _, r in ratios))
    out, acc = [], 0.0
    for name, r in ratios:
        acc += r
        out.append((name, min(int(acc / total * 2**32), 2**32)))
    return out


def split_expr(key, ratios=SPLIT_RATIOS, seed: int = SPLIT_SEED) -> Column:
    h = C.key_hash32(key, str(seed))
    th = split_thresholds(ratios)
    expr = None
    for name, bound in th[:-1]:
        expr = F.when(h < bound, F.lit(name)) if expr is None else expr.when(h < bound, F.lit(name))
    return expr.otherwise(F.lit(th[-1][0])) if expr is not None else F.lit(th[-1][0])


def assign_split(df: DataFrame, key: str, ratios=SPLIT_RATIOS, seed: int = SPLIT_SEED,
                 out: str = "split") -> DataFrame:
    """train/validate/test from md5(key ':' seed) -- identical at any partitioning."""
    return df.withColumn(out, split_expr(key, ratios, seed))


def split_of(df: DataFrame, name: str, col: str = "split") -> DataFrame:
    """Rows of one split."""
    return df.where(F.col(col) == F.lit(name))


def narrow_floats(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """Double -> float for model input."""
    targets = set(cols) if cols is not None else {f.name for f in df.schema.fields
                                                  if isinstance(f.dataType, DoubleType)}
    return df.select(*[F.col(c).cast(FloatType()).alias(c) if c in targets else F.col(c) for c in df.columns])


def filter_metric_rows(df: DataFrame, column_name: str = ":table", slice_key: str | None = None,
                       exclude_model: str = "*", log_type: str = "INPUT") -> DataFrame:
    """The profile rows a monitor looks at (whole table, no slice, per model, one log type).

    ``model_id != '*'`` also drops null ids, as SQL's three-valued logic does.
    """
    cond = (F.col("column_name") == F.lit(column_name)) & (F.col("model_id") != F.lit(exclude_model)) \
        & (F.col("log_type") == F.lit(log_type))
    cond = cond & (F.col("slice_key").isNull() if slice_key is None else F.col("slice_key") == F.lit(slice_key))
    return df.where(cond)


def prepare_customers(df: DataFrame, reject_col: str | None = None) -> DataFrame:
    """The customer table's cleaning as one projection: senior_citizen recoded, total_charges read as a
    number (blank: 0), missing amounts 0, optional services counted. ``reject_col`` names a flag for
    total_charges text that is neither blank nor a number, so such rows can be counted."""
    out = {"senior_citizen": C.recode_expr("senior_citizen", SENIOR_MAP),
           "total_charges": F.coalesce(C.parse_number_expr("total_charges"), F.lit(0.0)),
           "num_optional_services": C.flag_count(SERVICE_COLUMNS, FLAG_VALUE)}
    for c in ("tenure", "monthly_charges"):
        if c in df.columns:
            out[c] = F.coalesce(F.col(c), F.lit(0.0).cast(df.schema[c].dataType))
    if reject_col:
        out[reject_col] = C.parse_rejected("total_charges")
    return df.withColumns(out)
