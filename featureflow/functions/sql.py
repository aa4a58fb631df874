"""SQL-registered feature functions (U3): bodies are SQL expressions, so Catalyst
inlines them -- no Python worker, unlike a ``LANGUAGE PYTHON`` function."""

from __future__ import annotations

from pyspark.sql import SparkSession

PRICE_INCREASE_SQL = """
CREATE OR REPLACE TEMPORARY FUNCTION avg_price_increase(
    monthly_charges_in DOUBLE, tenure_in DOUBLE, total_charges_in DOUBLE)
RETURNS FLOAT
COMMENT 'last monthly charge minus mean charge; 0 when tenure <= 0'
RETURN CAST(CASE WHEN tenure_in > 0 THEN monthly_charges_in - total_charges_in / tenure_in
                 WHEN tenure_in IS NOT NULL THEN 0.0 END AS FLOAT)
"""

FLAG_COUNT_SQL = """
CREATE OR REPLACE TEMPORARY FUNCTION is_yes(v STRING)
RETURNS BIGINT
RETURN CAST(coalesce(v = 'Yes', false) AS BIGINT)
"""


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Register the on-demand feature functions for ``spark.sql`` users."""
    for stmt in (PRICE_INCREASE_SQL, FLAG_COUNT_SQL):
        spark.sql(stmt)
    return ["avg_price_increase", "is_yes"]
