"""Adaptive search on planted objectives; the trial table; split metrics."""
import math

from featureflow.operators import ml as ML
from featureflow.operators import tune as TU

SPACE = {"a": ("uniform", -3.0, 3.0), "b": ("loguniform", 1e-4, 1.0), "c": ("quniform", 2, 40, 2), "d": ("choice", ["x", "y", "z"])}


def planted(p):
    loss = (p["a"] - 1.1) ** 2 + (math.log10(p["b"]) + 2.5) ** 2 + ((p["c"] - 30) / 20) ** 2 + (p["d"] != "y")
    return loss, {}, None


def test_beats_random_points_at_equal_trials():
    wins = 0
    for seed in range(15):
        found = TU.adaptive_search(SPACE, 60, planted, seed)
        plain = ML.random_search(SPACE, 60, lambda p: planted(p)[0], seed)
        assert [t.params for t in found.trials[:TU.START]] == [t["params"] for t in sorted(plain, key=lambda t: t["trial"])[:TU.START]]
        wins += found.best.loss < plain[0]["loss"]
    assert wins >= 12


def test_points_stay_inside_and_repeat():
    one, two = (TU.adaptive_search(SPACE, 30, planted, 3) for _ in range(2))
    assert [t.params for t in one.trials] == [t.params for t in two.trials]
    for t in one.trials:
        assert -3 <= t.params["a"] <= 3 and 1e-4 * 0.999 <= t.params["b"] <= 1.001
        assert t.params["c"] in range(2, 41, 2) and t.params["d"] in ("x", "y", "z")


def test_losses_without_value_ties_and_no_trials():
    found = TU.adaptive_search(SPACE, 14, lambda p: (math.nan, {}, p), 1)
    assert found.best.trial == 0 and found.model == found.best.params and all(t.loss == math.inf for t in found.trials)
    assert TU.adaptive_search(SPACE, 14, lambda p: (1.0, {}, None), 1).best.trial == 0
    assert TU.adaptive_search(SPACE, 0, planted).best is None
    assert all(t.params["e"] == 5 for t in TU.adaptive_search({"e": ("quniform", 5, 5, 1)}, 12, lambda p: (0.0, {}, None)).trials)


def test_densities_are_normalised():
    for seen in ([], [0.2], [0.0, 0.0, 1.0], [0.1, 0.11, 0.9]):
        p = TU.Parzen(seen)
        area = sum(math.exp(p.log_density((i + 0.5) / 2000)) for i in range(2000)) / 2000
        assert abs(area - 1) < 1e-2


def test_trial_table_and_split_metrics(spark):
    rows = [(float(i), float(i >= 20), ("train", "validate", "test")[i % 3]) for i in range(60)]
    df = spark.createDataFrame(rows, "x double, label double, split string")
    found = TU.search_gbt(df, ["x"], {"maxIter": ("quniform", 1, 2, 1), "maxDepth": ("quniform", 1, 2, 1)}, 3, start=1)
    got = found.table(spark).collect()
    assert {(r.trial, r.split, r.metric) for r in got} == {(t, s, m) for t in range(3) for s in ("train", "validate", "test")
                                                           for m in ("rows", "positives", "accuracy", "precision", "recall", "f1")}
    assert all(r.adaptive == (r.trial > 0) and r.best == (r.trial == found.best.trial) for r in got)
    assert found.best.loss == -found.best.metrics["validate"]["f1"] and TU.split_metrics(found.model, df) == found.best.metrics
