"""Row explanations by sampled Shapley values.

A column's value for a row is its mean effect on the model's output when it joins the columns already taken from the row,
the others being taken from a background row. Along one path (an order of the columns and a background row) the effects
telescope from the background row's output to the row's, so the values of a row always add up to its output less the mean
output over the paths' background rows, for any model.

Every path step is a row with some columns replaced: the rows are exploded by a literal table of (path, step) of bounded
size, scored by the model like any other rows, and each score is added to the column that was replaced last and taken from
the one replaced next: one aggregation by row and column, no window, nothing collected.
"""

from __future__ import annotations

import random
from collections.abc import Sequence
from itertools import permutations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featureflow.functions.columns import key_hash32

BACKGROUND_ROWS = 32  # rows of the background table, at most: the first by a hash of their key
STEP = "_shap_step"


def background_rows(df: DataFrame, cols: Sequence[str], key: str, seed: int = 42, rows: int = BACKGROUND_ROWS) -> list[dict]:
    """The background table: ``rows`` rows of ``df``, the first by md5(key:seed). Bounded by its parameter."""
    h = key_hash32(key, f"background:{seed}")
    return [r.asDict() for r in df.orderBy(h, key).select(*cols).limit(rows).collect()]


def paths_for(cols: Sequence[str], background: int, per_row: int, seed: int = 42) -> list[tuple[tuple[str, ...], int]]:
    """(column order, background row) pairs: ``per_row`` orders for each background row, each followed by its reverse (the
    pair cancels much of the order's effect). All orders, if there are no more than that."""
    every = None
    if len(cols) <= 6:
        every = list(permutations(cols))
    if every is not None and len(every) <= per_row:
        return [(o, z) for z in range(background) for o in every]
    rng, out = random.Random(seed), []
    for z in range(background):
        for i in range(per_row):
            if i % 2:
                out.append((tuple(reversed(out[-1][0])), z))
            else:
                out.append((tuple(rng.sample(list(cols), len(cols))), z))
    return out


def shapley_values(df: DataFrame, model, cols: Sequence[str], key: str, background: Sequence[dict], output: str = "score",
                   per_row: int = 2, seed: int = 42) -> DataFrame:
    """Rows (key, column, value, output, base): what each of ``cols`` adds to the row's ``output`` (a column that
    ``model.transform`` gives), which is the row's own output, and base, the mean output of the background paths.

    The values of a row add up to output - base. Columns may be of any type and hold nulls. Rows with a repeated or null
    key are explained together (the mean of their values); an empty table gives an empty result, an empty background an error. Work: rows x paths x (columns + 1) scorings, linear in the rows.
    """
    if not background:
        raise ValueError("the background has no rows")
    paths = paths_for(cols, len(background), per_row, seed)
    steps = []
    for order, z in paths:
        for k in range(len(order) + 1):  # the first k columns of the order come from the row
            steps.append((z, [c in order[:k] for c in cols], order[k - 1] if k else None, order[k] if k < len(order) else None))
    step = F.array(*[F.struct(F.lit(z).alias("z"), F.array(*map(F.lit, own)).alias("own"), F.lit(add).cast("string").alias("add"),
                              F.lit(take).cast("string").alias("take")) for z, own, add, take in steps])
    base = {c: F.array(*[F.lit(r[c]).cast(df.schema[c].dataType) for r in background]) for c in cols}
    s = F.col(STEP)
    mixed = df.select(*df.columns, F.explode(step).alias(STEP))
    mixed = mixed.withColumns({c: F.when(F.get(s["own"], F.lit(i)), F.col(c)).otherwise(F.get(base[c], s["z"])) for i, c in enumerate(cols)})
    out = model.transform(mixed).select(F.col(key).alias("key"), s["add"].alias("add"), s["take"].alias("take"), F.col(output).cast("double").alias("y"))
    y, n = F.col("y"), len(paths)
    # column "": the ends of a path, told apart by their side
    effect = F.array(F.struct(F.coalesce("add", F.lit("")).alias("column"), F.lit(1).alias("side"), y.alias("v")),
                     F.struct(F.coalesce("take", F.lit("")).alias("column"), F.lit(-1).alias("side"), (-y).alias("v")))
    effects = out.select("key", F.explode(effect).alias("e")).select("key", "e.column", "e.side", "e.v")
    first, last = (F.col("column") == "") & (F.col("side") == 1), (F.col("column") == "") & (F.col("side") == -1)
    per_column = effects.groupBy("key", "column").agg(
        F.sum("v").alias("v"), F.sum(F.when(first, F.col("v"))).alias("base"), F.sum(F.when(last, -F.col("v"))).alias("whole"),
        F.sum(F.when(F.col("side") == 1, 1)).alias("times"))
    ends = per_column.where(F.col("column") == "").select(F.col("key").alias("k"), (F.col("whole") / F.col("times")).alias("output"),
                                                           (F.col("base") / F.col("times")).alias("base"), (F.col("times") / n).alias("copies"))
    values = per_column.where(F.col("column") != "").join(ends, F.col("key").eqNullSafe(F.col("k")))
    return values.select(F.col("key").alias(key), "column", (F.col("v") / (F.col("copies") * n)).alias("value"), "output", ends["base"])
