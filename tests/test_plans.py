"""Plan properties the operators promise: pushdown and pruning reach the scan, no
Python evaluation on native paths, no theta or cartesian joins."""
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_pushdown_and_pruning(spark):
    df = E.queries()["scan_parquet"](spark, SF)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_shipdate), IsNotNull(l_returnflag), GreaterThanOrEqual(l_shipdate" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double,l_extendedprice:double" in text
    scan = [line for line in text.split("\n") if "FileScan parquet" in line][0]
    assert "l_tax" not in scan and "l_discount" not in scan and "l_partkey" not in scan


B_OPS = ["normalized_columns", "num_optional_services", "recode_values", "parse_number", "coerce_numeric",
         "fill_missing", "stamp_metadata", "avg_price_increase", "select_supported", "drop_rename", "assign_split",
         "split_counts", "ceil_timestamp", "decode_label", "narrow_floats", "round_metric", "to_time"]
J_OPS = ["join_exact", "pit_lookup", "pit_lookup_max_age", "lookup_latest", "training_set", "attach_labels"]
OTHER = ["metrics_by_split", "roc_points", "profile_metrics", "drift_ks", "drift_psi", "feature_upsert",
         "table_changes", "impute_mode", "standardize", "metric_violation_by_model", "choose_champion"]


@pytest.mark.parametrize("name", B_OPS + J_OPS + OTHER)
def test_native_plans(spark, name):
    text = _plan(E.queries()[name](spark, SF))
    assert "EvalPython" not in text, name
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_udf_twin_is_the_only_python(spark):
    text = _plan(E.queries()["udf_vs_native"](spark, SF))
    assert "ArrowEvalPython" in text
