import datetime as dt

import pytest
from pyspark.sql import functions as F

from featureflow.operators import monitor as MO
from featureflow.operators import promote as PR

D = dt.datetime
SCHEMA = "window_start timestamp_ntz, column_name string, slice_key string, model_id string, log_type string, m double"


def prof(spark, metrics, model="m1"):
    rows = [(D(2024, 1, i + 1), ":table", None, model, "INPUT", None if v is None else float(v))
            for i, v in enumerate(metrics)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("metrics, want", [
    ([200, 200, 200, 200, 50], 0),     # newest not violating
    ([50, 50, 50, 50, 200], 0),        # newest violating but too few
    ([200, 200, None], 0),             # null newest -> not a violation
    ([200, 200], 1),                   # fewer windows than n_eval are still judged
    ([], 0),                           # empty
    ([10, 10, 10, 200, 200], 1),
])
def test_metric_violated(spark, metrics, want):
    df = prof(spark, metrics) if metrics else spark.createDataFrame([], SCHEMA)
    assert MO.metric_violated(df, "m", 100.0, 5, 2).first().query_result == want


def test_metric_violated_filters_rows(spark):
    rows = [(D(2024, 1, 1), ":table", None, "m1", "INPUT", 200.0), (D(2024, 1, 2), ":table", None, "m1", "INPUT", 200.0),
            (D(2024, 1, 3), ":table", None, "*", "INPUT", 1.0), (D(2024, 1, 3), "x", None, "m1", "INPUT", 1.0),
            (D(2024, 1, 3), ":table", "s", "m1", "INPUT", 1.0), (D(2024, 1, 3), ":table", None, None, "INPUT", 1.0)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert MO.metric_violated(df, "m", 100.0, 5, 2).first().query_result == 1


def test_two_models_in_one_window_tie_break(spark):
    rows = [(D(2024, 1, 2), ":table", None, "a", "INPUT", 50.0), (D(2024, 1, 2), ":table", None, "b", "INPUT", 200.0),
            (D(2024, 1, 1), ":table", None, "a", "INPUT", 200.0)]
    df = spark.createDataFrame(rows, SCHEMA)
    # newest = (2024-01-02, model 'a') = 50 -> not violated
    assert MO.metric_violated(df, "m", 100.0, 5, 2).first().query_result == 0
    by = {r.model_id: r.violated for r in MO.violations_by(df, ["model_id"], "m", 100.0, 5, 1).collect()}
    assert by == {"a": 0, "b": 1}


def test_sliding_window_one_trip(spark):
    df = spark.createDataFrame([(D(2022, 1, 12), 94400, 2.0)], "ts timestamp_ntz, zip bigint, d double")
    out = MO.window_features(df, ["zip"], "ts", D(2022, 1, 1), D(2022, 1, 15), "1 hour", "15 minutes")
    assert out.count() == 4
    out2 = MO.window_features(df, ["zip"], "ts", D(2022, 1, 1), D(2022, 1, 15), "1 day")
    assert out2.count() == 1
    out3 = MO.window_features(df, ["zip"], "ts", D(2022, 1, 1), D(2022, 1, 12), "1 day")
    assert out3.count() == 0  # range end is exclusive


def _info(spark, rows):
    return spark.createDataFrame(rows, "model_name string, model_version bigint, f1_score double, "
                                       "validation_timestamp timestamp_ntz")


def _aliases(spark):
    return spark.createDataFrame([("m", 1, 2)], "model_name string, champion_version bigint, challenger_version bigint")


def test_champion_tie_keeps_incumbent(spark):
    info = _info(spark, [("m", 1, 0.8, D(2024, 1, 1)), ("m", 2, 0.8, D(2024, 1, 1))])
    got = {r.model_version: r.new_alias for r in PR.choose_champion(info, _aliases(spark)).collect()}
    assert got == {1: "champion", 2: "challenger"}


def test_challenger_better_and_revalidated(spark):
    info = _info(spark, [("m", 1, 0.8, D(2024, 1, 1)), ("m", 2, 0.7, D(2024, 1, 1)), ("m", 2, 0.9, D(2024, 1, 2))])
    dec = PR.choose_champion(info, _aliases(spark))
    got = {r.model_version: r.new_alias for r in dec.collect()}
    assert got == {1: "challenger", 2: "champion"}
    hist = {(r.model_version, r.kind, r.name, r.value) for r in PR.apply_aliases(dec, D(2024, 2, 1)).collect()}
    assert (1, "alias", "prior_champion", None) in hist
    assert (2, "tag", "status", "promoted_to_champion") in hist
    assert (1, "tag", "demoted_on", "2024-02-01 00:00:00") in hist


def test_champion_needs_two_rows(spark):
    info = _info(spark, [("m", 1, 0.8, D(2024, 1, 1))])
    with pytest.raises(ValueError):
        PR.choose_champion(info, _aliases(spark))


def test_profile_grouping_sets(spark):
    rows = [(D(2024, 1, 1, 1), "a", 1.0), (D(2024, 1, 1, 2), "a", None), (D(2024, 1, 1, 3), "b", 3.0)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, model string, x double")
    p = MO.profile_metrics(df, "ts", "1 day", ["x"], "model", table_metrics={"avg_x": F.col("x")})
    got = {(r.model_id, r.column_name): (r["count"], r.num_nulls, r.mean) for r in p.collect()}
    assert got[("*", "x")] == (3, 1, 2.0)
    assert got[("a", "x")] == (2, 1, 1.0)
    assert got[("*", ":table")][0] == 3


def test_validation_record(spark):
    rows = [(1, 1, "test"), (1, 0, "test"), (0, 0, "test"), (1, 1, "train"), (0, 1, "train")]
    df = spark.createDataFrame(rows, "label int, prediction int, split string")
    r = PR.validation_record(df, "m", 3, "challenger", "gbt", D(2024, 1, 1)).first()
    assert (r.model_version, r.f1_score, r.metric) == (3, round(2 / 3, 4), "binary_f1")
    r_all = PR.validation_record(df, "m", 3, "challenger", "gbt", D(2024, 1, 1), splits=None).first()
    assert r_all.f1_score == round(4 / 6, 4)
    w = PR.validation_record(df, "m", 3, "challenger", "gbt", D(2024, 1, 1), metric="weighted_f1").first()
    assert w.metric == "weighted_f1" and 0 < w.f1_score <= 1


def test_deploy_version(spark):
    aliases = spark.createDataFrame([("m", 1, "champion"), ("m", 2, None), ("m", 3, "challenger"), ("n", 1, "champion")],
                                    "model_name string, model_version bigint, alias string")
    dep = spark.createDataFrame([("m", 3)], "model_name string, model_version bigint")
    got = {(r.model_name, r.model_version): r.alias for r in PR.deploy_version(aliases, dep).collect()}
    assert got == {("m", 1): None, ("m", 2): None, ("m", 3): "champion", ("n", 1): "champion"}


def test_profile_slices(spark):
    rows = [(D(2024, 1, 1, 1), "a", "x", 1.0), (D(2024, 1, 1, 2), "a", "y", 3.0)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, model string, lang string, v double")
    p = MO.profile_metrics(df, "ts", "1 day", ["v"], "model", slice_cols=["lang"])
    got = {(r.model_id, r.slice_key, r.slice_value, r.column_name): r["count"] for r in p.collect()}
    assert got[("a", None, None, "v")] == 2 and got[("a", "lang", "x", "v")] == 1 and got[("*", "lang", "y", ":table")] == 1


def test_profile_storage_prunes_partitions(spark):
    from featureflow.session import scratch_path
    rows = [(D(2024, 1, d, 1), "a", float(d)) for d in range(1, 11)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, model string, x double")
    p = MO.profile_metrics(df, "ts", "1 day", ["x"], "model", table_metrics={"m": F.col("x")})
    path = scratch_path(spark, "profile")
    MO.write_profile(p, path)
    recent = MO.read_profile(spark, path, since=dt.date(2024, 1, 8))
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(window_date" in plan
    assert MO.metric_violated(recent, "m", 8.5, 5, 2).first().query_result == 1  # windows 9 and 10 exceed


def test_pane_windows_equal_sliding_windows(spark):
    import random
    rng = random.Random(4)
    rows = [(rng.randint(0, 3), D(2024, 1, 1) + dt.timedelta(minutes=rng.randint(0, 600)), rng.random())
            for _ in range(300)] + [(9, D(2022, 1, 12), 2.0)]
    df = spark.createDataFrame(rows, "k bigint, ts timestamp_ntz, v double")
    specs = {"n": ("count", None), "s": ("sum", "v"), "a": ("avg", "v"), "lo": ("min", "v"), "hi": ("max", "v")}
    panes = MO.pane_window_features(df, ["k"], "ts", length="1 hour", slide="15 minutes", specs=specs)
    plain = MO.window_features(df, ["k"], "ts", length="1 hour", slide="15 minutes",
                               aggs={"n": F.count(F.lit(1)), "s": F.sum("v"), "a": F.avg("v"),
                                     "lo": F.min("v"), "hi": F.max("v")})
    cols = ["k", "window_start", "window_end", "n", "s", "a", "lo", "hi"]

    def rows_of(frame):
        return sorted((r.k, r.window_start, r.window_end, r.n, round(r.s, 9), round(r.a, 9), r.lo, r.hi)
                      for r in frame.select(*cols).collect())
    assert rows_of(panes) == rows_of(plain)
    assert panes.where("k = 9").count() == 4  # one trip -> four 1-hour windows on a 15-minute slide


def test_interval_seconds():
    assert MO.interval_seconds("15 minutes") == 900 and MO.interval_seconds("1 hour") == 3600
    assert MO.interval_seconds("2 days") == 172800 and MO.interval_seconds("30 seconds") == 30
    with pytest.raises(KeyError):
        MO.interval_seconds("1 month")


def test_quality_metrics_of_a_profile(spark):
    rows = [(D(2024, 1, 1), "a", 3.0, 1.0, 1, 1), (D(2024, 1, 1), "a", 1.0, 1.0, 1, 0), (D(2024, 1, 1), "b", None, 1.0, None, 1)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, m string, guess double, truth double, p int, y int")
    q = {"rmse": ("rmse", "guess", "truth"), "pr": ("precision", "p", "y"), "re": ("recall", "p", "y"), "f1": ("f1", "p", "y")}
    got = {r.model_id: (r.rmse, r.pr, r.re, r.f1) for r in
           MO.profile_metrics(df, "ts", "1 day", ["guess"], "m", quality=q).where("column_name = ':table'").collect()}
    assert got == {"a": (1.414214, 0.5, 1.0, 0.666667), "b": (None, 0.0, 0.0, 0.0), "*": (1.414214, 0.5, 0.5, 0.5)}
    with pytest.raises(ValueError):
        MO.profile_metrics(df, "ts", "1 day", ["guess"], "m", quality={"x": ("auc", "p", "y")})


def test_drift_of_several_columns_equals_one_by_one(spark):
    a = spark.createDataFrame([("x", None, 1.0, 5), ("y", "u", 2.0, 6), (None, None, None, 7)], "c string, d string, v double, n int")
    b = spark.createDataFrame([("x", "w", 1.5, 5), ("z", None, 9.0, None), (None, "u", 2.0, 5)], "c string, d string, v double, n int")
    got = {(r.column_name, r.metric): r.value for r in MO.drift_metrics(a, b, ["c", "v", "d", "n"]).collect()}
    want = {}
    for c in ("c", "d"):
        r = MO.drift_categorical(a, b, c).first()
        want |= {(c, m): r[m] for m in ("psi", "js_divergence", "chi_square")}
    want |= {(c, "ks"): MO.drift_ks(a, b, c).first().ks for c in ("v", "n")}
    assert got == want


def test_alias_rows_read_the_decision_once(spark, capsys):
    rows = [("m", 1, 0.5, "champion", "challenger", True), ("m", 2, 0.6, "challenger", "champion", True)]
    d = spark.createDataFrame(rows, "model_name string, model_version int, f1_score double, previous_alias string, new_alias string, changed boolean")
    out = PR.apply_aliases(d, D(2024, 1, 1))
    assert out.count() == 7
    out.explain()
    assert capsys.readouterr().out.count("Scan ExistingRDD") == 1
