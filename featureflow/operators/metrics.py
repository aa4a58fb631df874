"""Classification metrics and curves (A5-A9, W3), all as distributed aggregations.

Curves and AUC need running sums in score order. A plain window without a partition
key would pull every row into one task, so running sums are computed in two levels:
rows are first reduced to one row per distinct score (partial aggregation), scores
are cut into buckets at approximate quantiles, bucket totals give each bucket its offset (a table
bounded by the bucket count), and the running sum inside each (group, bucket) adds
that offset. No step holds a whole group in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featureflow.functions.columns import round_metric

N_BUCKETS = 1024


def _safe_div(a: Column, b: Column) -> Column:
    """a / b with 0 when b == 0 (scikit-learn's zero_division=0); ANSI-safe."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def confusion_matrix(df: DataFrame, label: str = "label", pred: str = "prediction",
                     group_cols: Sequence[str] = ()) -> DataFrame:
    """A5: counts per (label, prediction)."""
    return df.groupBy(*group_cols, label, pred).agg(F.count(F.lit(1)).alias("n"))


def binary_counts(df: DataFrame, label: str, pred: str, positive=1, group_cols: Sequence[str] = ()) -> DataFrame:
    y = F.coalesce(F.col(label) == F.lit(positive), F.lit(False))
    p = F.coalesce(F.col(pred) == F.lit(positive), F.lit(False))
    return df.groupBy(*group_cols).agg(
        F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"), F.count_if(~y & ~p).alias("tn"))


def _with_rates(c: DataFrame, digits: int | None = 4) -> DataFrame:
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    prec = _safe_div(tp, tp + fp)
    rec = _safe_div(tp, tp + fn)
    f1 = _safe_div(2 * tp, 2 * tp + fp + fn)
    acc = _safe_div(tp + tn, tp + fp + fn + tn)
    rnd = (lambda x: round_metric(x, digits)) if digits is not None else (lambda x: x)
    return c.withColumns({"accuracy": rnd(acc), "precision": rnd(prec), "recall": rnd(rec), "f1": rnd(f1)})


def binary_metrics(df: DataFrame, label: str = "label", pred: str = "prediction", positive=1,
                   group_cols: Sequence[str] = (), digits: int | None = 4) -> DataFrame:
    """tp/fp/fn/tn, accuracy, precision, recall, F1 for one positive class.

    A null prediction or label counts as "not positive".
    """
    return _with_rates(binary_counts(df, label, pred, positive, group_cols), digits)


def weighted_f1(df: DataFrame, label: str = "label", pred: str = "prediction",
                group_cols: Sequence[str] = (), digits: int | None = 4, count_col: str | None = None) -> DataFrame:
    """Class-frequency-weighted F1 (the multiclass evaluator's "f1").

    Computed from the confusion table (classes^2 rows per group), never from rows;
    ``count_col``: ``df`` already is such a table with counts in that column.
    """
    g = list(group_cols)
    if count_col is None:
        cm = confusion_matrix(df.where(F.col(label).isNotNull()), label, pred, g)
    else:
        cm = df.groupBy(*g, label, pred).agg(F.sum(count_col).alias("n"))
    per_true = cm.groupBy(*g, F.col(label).alias("cls")).agg(
        F.sum("n").alias("support"), F.sum(F.when(F.col(label) == F.col(pred), F.col("n")).otherwise(0)).alias("tp"))
    per_pred = cm.groupBy(*g, F.col(pred).alias("cls")).agg(F.sum("n").alias("predicted"))
    per = join_null_safe(per_true, per_pred, [*g, "cls"], "left")
    f1 = _safe_div(2 * F.col("tp"), F.col("support") + F.coalesce(F.col("predicted"), F.lit(0)))
    out = per.groupBy(*g).agg(F.try_divide(F.sum(f1 * F.col("support")), F.sum("support")).alias("weighted_f1"))
    if digits is not None:
        out = out.withColumn("weighted_f1", round_metric("weighted_f1", digits))
    return out


def score_counts(df: DataFrame, score: str, label: str, positive=1, group_cols: Sequence[str] = (),
                 bins: int | None = None) -> DataFrame:
    """Rows reduced to (group, score, pos, neg): the input of every curve.

    ``bins``: round scores down to a grid of ``1 / bins`` first, so a curve over a
    huge scored table has at most ``bins + 1`` points per group (exact when None).
    """
    y = F.coalesce(F.col(label) == F.lit(positive), F.lit(False))
    s = F.col(score).cast("double")
    if bins is not None:
        s = F.floor(s * F.lit(bins)) / F.lit(float(bins))
    return (df.where(F.col(score).isNotNull())
            .groupBy(*group_cols, s.alias("score"))
            .agg(F.count_if(y).alias("pos"), F.count_if(~y).alias("neg")))


def join_null_safe(left: DataFrame, right: DataFrame, cols: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal names where null equals null; the columns of ``left`` and the others of ``right``."""
    r = right.withColumnsRenamed({c: f"_r_{c}" for c in cols})
    on = F.lit(True)
    for c in cols:
        on = on & F.col(c).eqNullSafe(F.col(f"_r_{c}"))
    return left.join(r, on, how).drop(*[f"_r_{c}" for c in cols])


def _attach_totals(df: DataFrame, g: DataFrame, gc: list[str], aggs: dict[str, Column]) -> DataFrame:
    """Per-group totals next to each row: a join with one row per group when grouped
    (null groups match; Spark broadcasts small sides), scalar subqueries when not."""
    if gc:
        tot = g.groupBy(*gc).agg(*[v.alias(k) for k, v in aggs.items()])
        return join_null_safe(df, tot, gc)
    one = g.agg(F.struct(*[v.alias(k) for k, v in aggs.items()])).scalar()  # one subquery for all totals
    return df.withColumns({k: one[k] for k in aggs})


QUANTILE_BUCKETS, MOST_BUCKETS = 64, 1024  # per group: as many as shuffle partitions, within these bounds


def _cuts_below(cuts: str, n: int, x: Column) -> Column:
    """How many of a row's ``n`` sorted cuts lie below x: a bisection, log2(n) comparisons a row."""
    halves = F.array(*[F.lit(1 << i) for i in reversed(range(n.bit_length()))])
    return F.aggregate(halves, F.lit(0), lambda at, by: F.when(F.get(F.col(cuts), at + by - 1) < x, at + by).otherwise(at))


def running_sums(g: DataFrame, group_cols: Sequence[str], order_col: str, value_cols: Sequence[str],
                 descending: bool = False, inclusive: bool = True, n_buckets: int | None = None,
                 buckets: str = "quantile") -> DataFrame:
    """Per-group running sums of ``value_cols`` in ``order_col`` order, without ever
    placing a whole group in one task (two-level: bucket offsets + in-bucket sums).

    Adds ``cum_<v>`` columns (inclusive of the current row unless ``inclusive=False``).
    ``order_col`` values must be distinct within a group (reduce first). The offset
    window runs over bucket totals only (at most ``n_buckets`` rows per group).

    ``buckets="quantile"`` (default) cuts at approximate quantiles of the distinct
    values, so every bucket holds about the same number of rows however the values
    are distributed; ``"width"`` cuts the value range into equal widths. Any
    monotone cut gives the same sums; the choice only balances the tasks. Without ``n_buckets``
    a group is cut into as many as the session has shuffle partitions (64 to 1,024).
    """
    gc = list(group_cols)
    x = F.col(order_col).cast("double")
    if buckets == "quantile":
        n = n_buckets or max(QUANTILE_BUCKETS, min(MOST_BUCKETS, int(g.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
        probs = [i / n for i in range(1, n)]
        seen = F.when(F.col(value_cols[0]).isNotNull(), x)  # reads what the sums read, so that both share one exchange
        gb = _attach_totals(g, g, gc, {"_cuts": F.percentile_approx(seen, probs, 10 * n)})
        b = _cuts_below("_cuts", n - 1, x)  # monotone in x
        gb = gb.withColumn("_b", (F.lit(n - 1) - b if descending else b).cast("int")).drop("_cuts")
    else:
        n = n_buckets or N_BUCKETS
        gb = _attach_totals(g, g, gc, {"_lo": F.min(x), "_hi": F.max(x)})
        width = (F.col("_hi") - F.col("_lo")) / F.lit(float(n))
        b = F.when(width > 0, F.least(F.floor((x - F.col("_lo")) / width), F.lit(n - 1))).otherwise(0)
        if descending:
            b = F.lit(n - 1) - b
        gb = gb.withColumn("_b", b.cast("int")).drop("_lo", "_hi")
    tot = gb.groupBy(*gc, "_b").agg(*[F.sum(v).alias(f"_t_{v}") for v in value_cols])
    wo = Window.partitionBy(*gc).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    off = tot.select(*gc, "_b", *[F.coalesce(F.sum(f"_t_{v}").over(wo), F.lit(0)).alias(f"_o_{v}")
                                  for v in value_cols])
    o = F.desc(order_col) if descending else F.asc(order_col)
    end = Window.currentRow if inclusive else -1
    wi = Window.partitionBy(*gc, "_b").orderBy(o).rowsBetween(Window.unboundedPreceding, end)
    j = join_null_safe(gb, off, [*gc, "_b"])
    return j.select(*g.columns, *[(F.coalesce(F.sum(v).over(wi), F.lit(0)) + F.col(f"_o_{v}")).alias(f"cum_{v}")
                                  for v in value_cols])


def roc_curve(df: DataFrame, score: str = "score", label: str = "label", positive=1,
              group_cols: Sequence[str] = (), bins: int | None = None) -> DataFrame:
    """One point per distinct score threshold t (predict positive if score >= t);
    ``bins`` caps the points per group (see ``score_counts``)."""
    gc = list(group_cols)
    g = score_counts(df, score, label, positive, gc, bins)
    rs = running_sums(g, gc, "score", ["pos", "neg"], descending=True)
    j = _attach_totals(rs, g, gc, {"_P": F.sum("pos"), "_N": F.sum("neg")})
    return j.select(*gc, F.col("score").alias("threshold"),
                    _safe_div(F.col("cum_pos"), F.col("_P")).alias("tpr"),
                    _safe_div(F.col("cum_neg"), F.col("_N")).alias("fpr"))


def pr_curve(df: DataFrame, score: str = "score", label: str = "label", positive=1,
             group_cols: Sequence[str] = (), bins: int | None = None) -> DataFrame:
    """Precision / recall per distinct score threshold (``bins``: see ``score_counts``)."""
    gc = list(group_cols)
    g = score_counts(df, score, label, positive, gc, bins)
    rs = running_sums(g, gc, "score", ["pos", "neg"], descending=True)
    j = _attach_totals(rs, g, gc, {"_P": F.sum("pos")})
    return j.select(*gc, F.col("score").alias("threshold"),
                    _safe_div(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg")).alias("precision"),
                    _safe_div(F.col("cum_pos"), F.col("_P")).alias("recall"))


def roc_auc(df: DataFrame, score: str = "score", label: str = "label", positive=1,
            group_cols: Sequence[str] = (), digits: int | None = 4) -> DataFrame:
    """Area under the ROC curve = P(score+ > score-) + 0.5 P(tie) (rank-sum form)."""
    return _auc(score_counts(df, score, label, positive, group_cols), list(group_cols), digits)


def _auc(g: DataFrame, gc: list[str], digits: int | None) -> DataFrame:
    rs = running_sums(g, gc, "score", ["neg"], descending=False, inclusive=False)
    part = rs.groupBy(*gc).agg(
        F.sum(F.col("pos") * (F.col("cum_neg") + F.lit(0.5) * F.col("neg"))).alias("_u"),
        F.sum("pos").alias("_P"), F.sum("neg").alias("_N"))
    auc = _safe_div(F.col("_u"), F.col("_P") * F.col("_N"))
    return part.select(*gc, (round_metric(auc, digits) if digits is not None else auc).alias("auc"))


def _clamped(score: str, eps: float) -> Column:
    """Scores inside [eps, 1 - eps]; a null score stays null and takes no part."""
    s = F.col(score).cast("double")
    return F.when(s.isNotNull(), F.least(F.greatest(s, F.lit(eps)), F.lit(1.0 - eps)))


def log_loss(df: DataFrame, score: str = "score", label: str = "label", positive=1,
             group_cols: Sequence[str] = (), eps: float = 1e-15, digits: int | None = 4) -> DataFrame:
    p = _clamped(score, eps)
    y = F.coalesce(F.col(label) == F.lit(positive), F.lit(False))
    ll = -F.avg(F.when(y, F.log(p)).otherwise(F.log(F.lit(1.0) - p)))
    return df.groupBy(*group_cols).agg((round_metric(ll, digits) if digits is not None else ll).alias("log_loss"))


def metrics_by_split(df: DataFrame, split: str = "split", score: str = "score", label: str = "label",
                     pred: str = "prediction", positive=1, digits: int = 4, eps: float = 1e-15) -> DataFrame:
    """Per split: counts, accuracy/precision/recall/F1, weighted F1, log-loss, AUC.

    The rows are read and shuffled once, to counts per (split, score, label, prediction); count-based metrics, log-loss
    and AUC all start from those, over a shared exchange. A null split is a split of its own; null scores take no part
    in log-loss and AUC.
    """
    g = [split]
    base = df.groupBy(F.col(split), F.col(score).cast("double").alias("_score"), F.col(label), F.col(pred)).agg(F.count(F.lit(1)).alias("_c"))
    p = _clamped("_score", eps)
    y = F.coalesce(F.col(label) == F.lit(positive), F.lit(False))
    term = -F.when(y, F.log(p)).otherwise(F.log(F.lit(1.0) - p)) * F.col("_c")
    known = F.when(F.col("_score").isNotNull(), F.col("_c")).otherwise(0)  # no filter: it would part the two plans below the exchange
    cells = base.groupBy(*g, label, pred).agg(F.sum("_c").alias("_n"), F.sum(term).alias("_ll"), F.sum(known).alias("_nll"))
    per_score = base.groupBy(*g, F.col("_score").alias("score")).agg(
        F.sum(F.when(y, known).otherwise(0)).alias("pos"), F.sum(F.when(y, 0).otherwise(known)).alias("neg"))
    yy = F.coalesce(F.col(label) == F.lit(positive), F.lit(False))
    pp = F.coalesce(F.col(pred) == F.lit(positive), F.lit(False))
    counts = cells.groupBy(*g).agg(
        F.sum(F.when(yy & pp, F.col("_n")).otherwise(0)).alias("tp"),
        F.sum(F.when(~yy & pp, F.col("_n")).otherwise(0)).alias("fp"),
        F.sum(F.when(yy & ~pp, F.col("_n")).otherwise(0)).alias("fn"),
        F.sum(F.when(~yy & ~pp, F.col("_n")).otherwise(0)).alias("tn"),
        F.try_divide(F.sum("_ll"), F.sum("_nll")).alias("_log_loss"))
    out = _with_rates(counts, digits).withColumn("log_loss", round_metric("_log_loss", digits)).drop("_log_loss")
    labelled = F.when(F.col(label).isNotNull(), F.col("_n")).otherwise(0)  # no filter here either
    wf = weighted_f1(cells.select(*g, label, pred, labelled.alias("_n")), label, pred, g, digits, count_col="_n")
    out = join_null_safe(out, wf, g, "left")
    out = join_null_safe(out, _auc(per_score, g, digits), g, "left")
    return out


auc = roc_auc  # survey name
