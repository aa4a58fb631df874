"""Properties from the test strategy: as-of never uses a future row and keeps the label
count; metric_violated is monotone in the threshold; binary metrics equal confusion
matrix algebra; streamed windows equal batch windows on closed windows."""
import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from featureflow.operators import lookup as LK
from featureflow.operators import metrics as MT
from featureflow.operators import monitor as MO

D = dt.datetime(2024, 1, 1)
rows_st = st.lists(st.tuples(st.integers(0, 3), st.integers(0, 500)), min_size=0, max_size=25)


@settings(max_examples=8, deadline=None)
@given(labels=rows_st, feats=rows_st)
def test_asof_properties(spark, labels, feats):
    L = spark.createDataFrame([(i, k, D + dt.timedelta(hours=h)) for i, (k, h) in enumerate(labels)],
                              "lid bigint, k bigint, ts timestamp_ntz")
    Fd = spark.createDataFrame([(k, D + dt.timedelta(hours=h), j) for j, (k, h) in enumerate(feats)],
                               "k bigint, fts timestamp_ntz, fid bigint")
    feat_ts = {j: D + dt.timedelta(hours=h) for j, (_, h) in enumerate(feats)}
    for bucket in (None, "2 days"):
        out = LK.lookup_asof(L, Fd, ["k"], "ts", feature_ts="fts", tie_breakers=["fid"], bucket=bucket).collect()
        assert sorted(r.lid for r in out) == list(range(len(labels)))      # no row lost or duplicated
        for r in out:
            if r.fid is not None:
                assert feat_ts[r.fid] <= r.ts and feats[r.fid][0] == r.k      # never a future row
            else:
                assert not any(k == r.k and D + dt.timedelta(hours=h) <= r.ts for k, h in feats)


@settings(max_examples=6, deadline=None)
@given(values=st.lists(st.one_of(st.none(), st.floats(0, 200)), min_size=0, max_size=8),
       t1=st.floats(0, 200), t2=st.floats(0, 200))
def test_violation_monotone_in_threshold(spark, values, t1, t2):
    lo, hi = min(t1, t2), max(t1, t2)
    rows = [(D + dt.timedelta(days=i), ":table", None, "m", "INPUT", v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "window_start timestamp_ntz, column_name string, slice_key string, "
                                     "model_id string, log_type string, m double")
    a = MO.metric_violated(df, "m", lo, 5, 2).first().query_result
    b = MO.metric_violated(df, "m", hi, 5, 2).first().query_result
    assert a >= b   # raising the threshold never creates a violation


@settings(max_examples=6, deadline=None)
@given(pairs=st.lists(st.tuples(st.integers(0, 1), st.one_of(st.none(), st.integers(0, 1))), min_size=1, max_size=30))
def test_binary_metrics_equal_confusion_algebra(spark, pairs):
    df = spark.createDataFrame(pairs, "label int, prediction int")
    cm = {(r.label, r.prediction): r.n for r in MT.confusion_matrix(df).collect()}
    tp = cm.get((1, 1), 0)
    fp = cm.get((0, 1), 0)
    fn = cm.get((1, 0), 0) + cm.get((1, None), 0)
    tn = cm.get((0, 0), 0) + cm.get((0, None), 0)
    m = MT.binary_metrics(df, digits=None).first()
    assert (m.tp, m.fp, m.fn, m.tn) == (tp, fp, fn, tn)
    assert abs(m.f1 - (2 * tp / (2 * tp + fp + fn) if 2 * tp + fp + fn else 0.0)) < 1e-12


def test_stream_windows_equal_batch(spark):
    from featureflow.session import scratch_path
    from featureflow.streaming import streams as ST
    rows = [(i, D + dt.timedelta(hours=3 * i), "a" if i % 2 else "b", float(i)) for i in range(60)]
    df = spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, kind string, value double")
    src_dir, out, ck = (scratch_path(spark, n) for n in ("src", "out", "ck"))
    for day in range(0, 8, 2):  # four files in time order
        lo, hi = D + dt.timedelta(days=day), D + dt.timedelta(days=day + 2)
        df.where((F.col("ts") >= F.lit(lo)) & (F.col("ts") < F.lit(hi))).coalesce(1) \
            .write.mode("append").parquet(src_dir)
    src = ST.read_stream(spark, src_dir, df.schema, max_files=1)
    aggs = {"n": F.count(F.lit(1)), "total": F.sum("value")}
    ST.stream_window_features(src, ["kind"], "ts", "1 day", None, "1 hour", aggs, out, ck)
    streamed = {tuple(r) for r in spark.read.parquet(out).select("window_start", "kind", "n", "total").collect()}
    batch = MO.window_features(df, ["kind"], "ts", length="1 day", aggs=aggs)
    closed = batch.where(F.col("window_end") <= F.lit(max(r[1] for r in rows) - dt.timedelta(hours=1)))
    want = {tuple(r) for r in closed.select("window_start", "kind", "n", "total").collect()}
    assert streamed == want  # four micro-batches, rows in time order: every closed window, exactly once


def test_stream_profile_approx_distinct(spark):
    from featureflow.session import scratch_path
    from featureflow.streaming import streams as ST
    rows = [(D + dt.timedelta(hours=i), "m" if i % 2 else "n", float(i % 7)) for i in range(96)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, model string, v double")
    src_dir, out, ck = (scratch_path(spark, n) for n in ("psrc", "pout", "pck"))
    df.coalesce(1).write.parquet(src_dir)
    ST.stream_profile(ST.read_stream(spark, src_dir, df.schema, max_files=None), "ts", "1 day", ["v"], "model",
                      "1 hour", out, ck, approx_distinct=True)
    got = {(r.window_start, r.model_id, r.column_name): r for r in spark.read.parquet(out).collect()}
    day0 = got[(D, "*", "v")]
    assert day0["count"] == 24 and day0.num_distinct_approx == 7 and day0.num_nulls == 0
