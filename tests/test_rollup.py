"""Merged profile states against direct aggregates; drift over windows against its definition."""
import datetime as dt
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from featureflow.operators import drift_windows as DW
from featureflow.operators import rollup as RU

rng = random.Random(6)
T0 = dt.datetime(2024, 3, 1)


def test_states_merge_to_the_direct_profile(spark):
    rows = [(T0 + dt.timedelta(minutes=rng.randrange(60 * 48)), rng.choice(["a", "b", None]), None if rng.random() < .1 else 1e9 + rng.gauss(0, 1))
            for _ in range(4000)] + [(None, "a", 1.0), (T0, "only nulls", None)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, s string, x double").repartition(6)
    states = RU.profile_states(df, "ts", "1 hour", ["x"], ["s"])
    for slices in (["s"], []):
        got = RU.profile_of(RU.roll_up(states, "1 day", slices), {"median": 0.5, "low10": 0.1})
        direct = RU.profile_of(RU.profile_states(df, "ts", "1 day", ["x"], slices), {"median": 0.5})
        key = lambda r: (r.window_start, r.s if slices else "")
        want = {key(r): r for r in direct.collect()}
        for r in got.collect():
            w = want.pop(key(r))
            assert (r["count"], r.num_nulls, r["min"], r["max"]) == (w["count"], w.num_nulls, w["min"], w["max"])
            assert (r.mean is None) == (w.mean is None) and (r.mean is None or r.mean == pytest.approx(w.mean, rel=1e-14)) and (r.stddev is None or r.stddev == pytest.approx(w.stddev, rel=1e-6))
            values = sorted(x for t, s, x in rows if t is not None and x is not None and t.date() == r.window_start.date() and (not slices or s == r.s))
            if values:
                assert abs(r.num_distinct_approx - len(set(values))) <= 0.1 * len(values) + 1
                assert abs(sum(x <= r.median for x in values) / len(values) - 0.5) < 0.05
                assert abs(sum(x <= r.low10 for x in values) / len(values) - 0.1) < 0.05
            else:
                assert r.median is None and r.mean is None
        assert not want
    assert RU.profile_states(df.limit(0), "ts", "1 hour", ["x"]).count() == 0


def metrics(cur, ref):
    n, m = sum(cur.values()), sum(ref.values())
    pairs = [(cur.get(c, 0) / n, ref.get(c, 0) / m) for c in cur.keys() | ref.keys()]
    half = lambda a, b: a * math.log(2 * a / (a + b)) / 2 if a else 0.0
    floor = lambda a: max(a, DW.FLOOR)
    return (sum(abs(p - q) for p, q in pairs) / 2, sum(half(p, q) + half(q, p) for p, q in pairs),
            sum((floor(p) - floor(q)) * math.log(floor(p) / floor(q)) for p, q in pairs), sum(q == 0 for _, q in pairs), sum(p == 0 for p, _ in pairs))


def test_drift_over_windows(spark):
    rows = [(T0 + dt.timedelta(hours=h), rng.choice("abcdef"[: 2 + h // 12] if h < 40 else "xyz")) for h in range(100) for _ in range(3) if not 48 <= h < 72]
    rows += [(T0, None)] * 4 + [(None, "a")]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, c string")
    hist = DW.window_histogram(df, "ts", "1 day", F.col("c"))
    base = {"a": 5, "b": 2, None: 1, "zz": 3}
    got = {(r.window_start, r.drift_type): r for r in DW.drift_over_windows(hist, "1 day", spark.createDataFrame(list(base.items()), "category string, n long")).collect()}
    assert len(got) == 10  # five days, of which the third is empty
    prev = None
    for day in range(5):
        at = T0 + dt.timedelta(days=day)
        cur = Counter(c for t, c in rows if t is not None and t.date() == at.date())
        for kind, ref in (("consecutive", prev), ("baseline", base)):
            r = got[at, kind]
            assert r["count"] == sum(cur.values())
            values = (r.tv_distance, r.js_divergence, r.psi, r.new_categories, r.gone_categories)
            assert values == (pytest.approx(metrics(cur, ref), abs=1e-5) if cur and ref else (None,) * 5)
        prev = cur or prev
    assert DW.drift_over_windows(hist.limit(0), "1 day").count() == 0
