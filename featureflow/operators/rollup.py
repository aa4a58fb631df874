"""A11 from stored states: profiles that roll up from hours to days, and from slices to all, without the rows.

A state is one row a window, slice and column: counts, the sum, the centred second moment, the extremes, a HyperLogLog
sketch for distinct values and a KLL sketch for quantiles. States of disjoint rows merge into the state of their union:
exactly but for the sketches, whose errors stay those of one sketch. Rows are read once, aggregated as they are (no copy a
column); only the aggregates are turned into rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featureflow.functions.columns import round_metric

HLL_LOG = 12  # of the sketch's registers: 1.6 % standard error
KLL_K = 200   # of the quantile sketch: 1.33 % rank error
STATE = ("n", "nulls", "total", "m2", "low", "high", "distinct", "quantiles")


def profile_states(df: DataFrame, ts: str, granularity: str, columns: Sequence[str], slices: Sequence[str] = ()) -> DataFrame:
    """Rows (window_start, *slices, column_name, n, nulls, total, m2, low, high, distinct, quantiles).

    Columns are profiled as doubles. Rows without a time are left out; null slice values are a slice; a window without rows
    has no state; an empty table has none at all.
    """
    taken = {"window_start", "column_name", "states", *STATE} & set(slices)
    if taken:
        raise ValueError(f"slices need other names: {sorted(taken)}")

    def state(name):
        x = F.col(f"`{name}`").cast("double")
        return F.struct(F.lit(name).alias("column_name"), F.count(x).alias("n"), F.count_if(x.isNull()).alias("nulls"), F.sum(x).alias("total"),
                        (F.var_pop(x) * F.count(x)).alias("m2"), F.min(x).alias("low"), F.max(x).alias("high"),
                        F.hll_sketch_agg(x.cast("string"), F.lit(HLL_LOG)).alias("distinct"), F.kll_sketch_agg_double(x, F.lit(KLL_K)).alias("quantiles"))
    at = F.window(F.col(ts).cast("timestamp"), granularity)["start"].cast("timestamp_ntz").alias("window_start")
    base = df.where(F.col(ts).isNotNull()).select(at, *slices, *[c for c in columns if c not in slices])
    wide = base.groupBy("window_start", *slices).agg(F.array(*[state(c) for c in columns]).alias("states"))
    return wide.select("window_start", *slices, F.inline("states"))


def roll_up(states: DataFrame, granularity: str, slices: Sequence[str] = ()) -> DataFrame:
    """States of coarser windows (a multiple of the stored ones) and fewer slices. The moments are centred on the merged
    mean, which a first aggregation finds, so that large means lose no digits."""
    at = F.window(F.col("window_start").cast("timestamp"), granularity)["start"].cast("timestamp_ntz")
    keys = ["window_start", *slices, "column_name"]
    s = states.withColumn("window_start", at).select(*keys, *STATE)
    means = s.groupBy(*keys).agg((F.sum("total") / F.sum("n")).alias("mean")).withColumnsRenamed({k: f"_m_{k}" for k in keys})
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_m_{k}"))
    s = s.join(means, same)
    shift = F.col("total") / F.col("n") - F.col("mean")
    return s.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.sum("nulls").alias("nulls"), F.sum("total").alias("total"),
        F.sum(F.col("m2") + F.col("n") * shift * shift).alias("m2"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.hll_union_agg("distinct").alias("distinct"), F.kll_merge_agg_double("quantiles").alias("quantiles"))


def profile_of(states: DataFrame, quantiles: Mapping[str, float] | None = None, digits: int = 6) -> DataFrame:
    """Metrics of states: count, num_nulls, mean, stddev (of a sample), min, max, num_distinct_approx and named quantiles."""
    keys = [c for c in states.columns if c not in STATE]
    some = lambda x: F.when(F.col("n") > 0, x)
    asked = [some(F.kll_sketch_get_quantile_double("quantiles", F.lit(float(q)))).alias(name) for name, q in (quantiles or {}).items()]
    return states.select(*keys, (F.col("n") + F.col("nulls")).alias("count"), F.col("nulls").alias("num_nulls"),
                         round_metric(round_metric(F.col("total"), digits) / F.when(F.col("n") > 0, F.col("n")), digits).alias("mean"),
                         F.when(F.col("n") > 1, round_metric(F.sqrt(F.col("m2") / (F.col("n") - 1)), digits)).alias("stddev"),
                         F.col("low").alias("min"), F.col("high").alias("max"), F.hll_sketch_estimate("distinct").alias("num_distinct_approx"), *asked)
