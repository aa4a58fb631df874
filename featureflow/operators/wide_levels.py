"""L1 for columns of any number of levels: the levels stay a table, rows find theirs by a join, vectors are sparse."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from featureflow.session import materialize


def fit_level_table(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column_name, level, idx, n_levels): the distinct non-null values of each column as text, numbered from 0 in their order.

    Levels are range-partitioned by (column, level); a level's number is its place in its range plus the column's levels in
    earlier ranges (one row a column and range), so no task and no driver holds all levels of a column. An empty table, or a
    column of nulls, gives no rows.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("level")) for c in cols]))
    lv = df.select(pairs.alias("p")).select("p.*").where(F.col("level").isNotNull()).distinct()
    lv = materialize(lv.repartitionByRange("column_name", "level").withColumn("part", F.spark_partition_id()))  # numbers must not change
    w = Window.partitionBy("column_name")
    ahead = w.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    per = lv.groupBy("column_name", "part").agg(F.count(F.lit(1)).alias("n"))
    per = per.select("column_name", "part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before"), F.sum("n").over(w).alias("n_levels"))
    place = F.row_number().over(Window.partitionBy("column_name", "part").orderBy("level"))
    numbered = lv.withColumn("place", place).join(per, ["column_name", "part"])
    return materialize(numbered.select("column_name", "level", (F.col("before") + F.col("place") - 1).alias("idx"), "n_levels"))


def level_indices(df: DataFrame, table: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Adds ``<col>_idx`` (double): the level's number; nulls and values unseen at fit time have the number of levels.

    A left join a column: Spark broadcasts a small level table and splits hot levels of a large one. The column carries the
    number of its slots as ML metadata."""
    sizes = {r.column_name: r.n for r in table.groupBy("column_name").agg(F.max("n_levels").alias("n")).collect()}  # a row a column
    out = df
    for c in cols:
        if f"{c}_idx" in df.columns:
            raise ValueError(f"column {c}_idx exists")
        n = sizes.get(c, 0)
        side = table.where(F.col("column_name") == c).select(F.col("level").alias(f"{c}__level"), F.col("idx").alias(f"{c}__idx"))
        out = out.join(side, F.col(c).cast("string") == F.col(f"{c}__level"), "left").drop(f"{c}__level")
        idx = F.coalesce(F.col(f"{c}__idx").cast("double"), F.lit(float(n)))
        out = out.withColumn(f"{c}_idx", idx).drop(f"{c}__idx")
        out = out.withMetadata(f"{c}_idx", {"ml_attr": {"name": f"{c}_idx", "type": "nominal", "num_vals": n + 1}})
    return out


def one_hot_sparse(df: DataFrame, table: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Adds ``<col>_idx`` and ``<col>_vec``, a sparse vector with a slot for each level and a last one for unknown values."""
    out = level_indices(df, table, cols)
    coder = OneHotEncoder(inputCols=[f"{c}_idx" for c in cols], outputCols=[f"{c}_vec" for c in cols], dropLast=False)
    return coder.fit(out).transform(out)  # sizes come from the metadata: no pass over the rows
