"""A12 over time: a stored histogram a window, compared with the last window that had rows and with a baseline.

The histogram is the only pass over the rows: one row a window and category, which later comparisons read instead of the
rows. A window meets its reference on the category, and the categories that it lacks enter through the reference's totals,
so no pair of windows and no missing category is ever spelled out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featureflow.functions.columns import round_metric

FLOOR = 1e-4  # share that stands for none in the stability index


def window_histogram(df: DataFrame, ts: str, granularity: str, category: Column) -> DataFrame:
    """Rows (window_start, category, n). Null categories count as one; rows without a time are left out."""
    at = F.window(F.col(ts).cast("timestamp"), granularity)["start"].cast("timestamp_ntz").alias("window_start")
    return df.where(F.col(ts).isNotNull()).select(at, category.cast("string").alias("category")).groupBy("window_start", "category").agg(F.count(F.lit(1)).alias("n"))


def _psi(p: Column, q: Column) -> Column:
    p, q = F.greatest(p, F.lit(FLOOR)), F.greatest(q, F.lit(FLOOR))
    return (p - q) * F.log(p / q)


def _js(p: Column, q: Column) -> Column:
    """Both sides' part of the Jensen-Shannon divergence (natural logarithm)."""
    half = lambda a, m: F.when(a > 0, a * F.log(a / m)).otherwise(0.0)
    return (half(p, (p + q) / 2) + half(q, (p + q) / 2)) / 2


def _against(windows: DataFrame, hist: DataFrame, ref: DataFrame, kind: str, digits: int) -> DataFrame:
    """``windows``: (window_start, total, ref_id); ``ref``: (ref_id, category, m)."""
    totals = ref.groupBy("ref_id").agg(F.sum("m").alias("ref_total"))
    q = F.col("m") / F.col("ref_total")
    shares = ref.join(totals, "ref_id").withColumn("q", q)
    absent = shares.groupBy("ref_id").agg(F.sum(_psi(F.lit(0.0), F.col("q"))).alias("psi_absent"), F.sum(_js(F.lit(0.0), F.col("q"))).alias("js_absent"),
                                          F.count(F.lit(1)).alias("ref_categories"))
    mine = hist.join(windows.where("ref_id is not null"), "window_start").withColumn("p", F.col("n") / F.col("total"))
    r = shares.select(F.col("ref_id").alias("r_id"), F.col("category").alias("r_category"), "q")
    j = mine.join(r, (F.col("ref_id") == F.col("r_id")) & F.col("category").eqNullSafe(F.col("r_category")), "left")
    known, qq = F.col("q").isNotNull(), F.coalesce("q", F.lit(0.0))
    zero = F.lit(0.0)
    g = j.groupBy("window_start", "ref_id").agg(
        F.sum(F.abs(F.col("p") - qq)).alias("l1"), F.sum(qq).alias("seen"), F.sum(_psi(F.col("p"), qq)).alias("psi"), F.sum(_js(F.col("p"), qq)).alias("js"),
        F.sum(F.when(known, _psi(zero, qq)).otherwise(0.0)).alias("psi_seen"), F.sum(F.when(known, _js(zero, qq)).otherwise(0.0)).alias("js_seen"),
        F.count_if(~known).alias("new_categories"), F.count_if(known).alias("shared"))
    g = g.join(absent, "ref_id")
    out = windows.join(g.drop("ref_id"), "window_start", "left")
    js = F.col("js") + F.col("js_absent") - F.col("js_seen")
    return out.select("window_start", F.lit(kind).alias("drift_type"), F.col("total").alias("count"),
                      round_metric((F.col("l1") + 1 - F.col("seen")) / 2, digits).alias("tv_distance"),
                      round_metric(F.when(js > 0, js).when(js.isNotNull(), 0.0), digits).alias("js_divergence"),
                      round_metric(F.col("psi") + F.col("psi_absent") - F.col("psi_seen"), digits).alias("psi"),
                      "new_categories", (F.col("ref_categories") - F.col("shared")).alias("gone_categories"))


def drift_over_windows(hist: DataFrame, granularity: str, baseline: DataFrame | None = None, digits: int = 6) -> DataFrame:
    """Rows (window_start, drift_type, count, tv_distance, js_divergence, psi, new_categories, gone_categories): each window
    against the last earlier one that has rows (``consecutive``) and against ``baseline`` (category, n), if one is given.

    Every window from the first to the last has its rows; those without rows, and the first one's ``consecutive`` row, have
    null distances. An empty histogram gives an empty result, an empty baseline null distances.
    """
    totals = hist.groupBy("window_start").agg(F.sum("n").alias("total"))
    span = totals.agg(F.min("window_start").alias("a"), F.max("window_start").alias("b")).where("a is not null")
    every = span.select(F.explode(F.expr(f"sequence(a, b, INTERVAL {granularity})")).alias("window_start"))
    windows = every.join(totals, "window_start", "left").fillna(0, ["total"])
    order = Window.orderBy("window_start").rowsBetween(Window.unboundedPreceding, -1)  # a row a window, not a row of data
    prev = F.last(F.when(F.col("total") > 0, F.col("window_start")), ignorenulls=True).over(order)
    chained = windows.withColumn("prev", prev).withColumn("ref_id", F.when(F.col("total") > 0, F.col("prev")))
    out = _against(chained.select("window_start", "total", "ref_id"), hist, hist.select(F.col("window_start").alias("ref_id"), "category", F.col("n").alias("m")),
                   "consecutive", digits)
    if baseline is not None:
        one = windows.withColumn("ref_id", F.when(F.col("total") > 0, 1))
        ref = baseline.groupBy("category").agg(F.sum("n").alias("m")).withColumn("ref_id", F.lit(1))
        out = out.unionByName(_against(one, hist, ref, "baseline", digits))
    return out
