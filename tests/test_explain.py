"""Shapley values against the definition (all orders, all background rows) and on awkward tables."""
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from featureflow.operators import explain as EX
from featureflow.operators import ml as ML

COLS = ["a", "b", "c"]


class Model:
    """Not additive: products, a text, a null."""

    def transform(self, df):
        return df.withColumn("score", F.coalesce("a", F.lit(0.0)) * F.coalesce("b", F.lit(2.0)) + F.when(F.col("c") == "x", F.col("b") + 1).otherwise(0.5))


def score(a, b, c):
    return (a if a is not None else 0.0) * (b if b is not None else 2.0) + ((b + 1) if c == "x" else 0.5)


def exact(row, background):
    out = dict.fromkeys(COLS, 0.0)
    paths = [(o, z) for o in permutations(COLS) for z in background]
    for order, z in paths:
        now = dict(z)
        for c in order:
            before = score(**now)
            now[c] = row[c]
            out[c] += (score(**now) - before) / len(paths)
    return out


def test_all_orders_give_the_exact_values(spark):
    rows = [(1, 2.0, 3.0, "x"), (2, None, 1.0, "y"), (3, 4.0, 5.0, None)]
    df = spark.createDataFrame(rows, "id bigint, a double, b double, c string")
    background = [{"a": 1.0, "b": 0.5, "c": "x"}, {"a": None, "b": 2.0, "c": None}]
    got = EX.shapley_values(df, Model(), COLS, "id", background, per_row=6).collect()
    assert len(got) == 9
    for r in got:
        row = dict(zip(["id", *COLS], next(x for x in rows if x[0] == r.id), strict=True))
        want = exact(row, background)
        assert r.value == pytest.approx(want[r.column]) and r.output == pytest.approx(score(*[row[c] for c in COLS]))
        assert r.base == pytest.approx(sum(score(**z) for z in background) / 2)


def test_sampled_values_add_up(spark):
    cols = [f"x{i}" for i in range(8)]
    df = spark.range(20).select("id", *[((F.col("id") * (i + 3)) % 7).cast("double").alias(c) for i, c in enumerate(cols)])

    class Product:
        def transform(self, d):
            return d.withColumn("score", F.col("x0") * F.col("x1") + F.col("x2") * F.col("x3") * F.col("x4") - F.greatest("x5", "x6", "x7"))
    background = EX.background_rows(df, cols, "id", rows=5)
    assert len(background) == 5 and background == EX.background_rows(df.repartition(3), cols, "id", rows=5)
    got = EX.shapley_values(df, Product(), cols, "id", background, per_row=4)
    sums = got.groupBy("id").agg(F.sum("value").alias("v"), F.first("output").alias("o"), F.first("base").alias("b")).collect()
    assert len(sums) == 20 and all(r.v == pytest.approx(r.o - r.b) for r in sums)
    assert EX.shapley_values(df.limit(0), Product(), cols, "id", background).count() == 0
    with pytest.raises(ValueError):
        EX.shapley_values(df, Product(), cols, "id", [])


def test_linear_model_and_repeated_keys(spark):
    df = spark.createDataFrame([(1, 1.0, 10.0), (1, 3.0, 30.0), (None, 5.0, None)], "id bigint, p double, q double")
    got = EX.shapley_values(df, ML.LinearModel({"p": 2.0, "q": -1.0}, 0.5, margin=True), ["p", "q"], "id", [{"p": 1.0, "q": 4.0}], "margin").collect()
    assert sorted((repr(r.id), r.column, round(r.value, 9)) for r in got) == [("1", "p", 2.0), ("1", "q", -16.0), ("None", "p", 8.0), ("None", "q", 4.0)]
