"""Point-in-time lookups between two streams, for scoring with a model on the way.

Held per key: the feature rows that a label may still need, and the labels that wait. A label is answered when the
watermark has passed its time: then every feature row that is at most ``delay`` late has come, whichever stream was ahead.
Feature rows older than the newest one behind the watermark are dropped, and all of them once they are older than
``max_age``, so what is held of a key is bounded by what arrives within the delay. Keys share state by groups of their
hash: a call of the Python function costs milliseconds, so it must not come once a key and micro-batch.
"""

from __future__ import annotations

import json
import pickle
from bisect import bisect_right
from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

# JSON formats that keep microseconds.
JSON = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def _micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def answer(features: list[tuple[int, list, str]], labels: list[tuple[int, str]], watermark: int, max_age: int | None):
    """((label, feature or None) of labels before the watermark, features still needed, labels that wait). Times in
    microseconds; features are (time, tie breakers, row)."""
    features.sort()
    times = [t for t, _, _ in features]
    done, wait = [], []
    for t, row in labels:
        if t >= watermark:
            wait.append((t, row))
            continue
        i = bisect_right(times, t) - 1
        fits = i >= 0 and (max_age is None or t - times[i] <= max_age)
        done.append((row, features[i][2] if fits else None))
    first = max(0, bisect_right(times, watermark - 1) - 1)  # the newest feature behind the watermark and all later ones
    kept = features[first:]
    if max_age is not None:
        kept = [x for x in kept if x[0] >= watermark - max_age]
    return done, kept, wait


def stream_asof(labels: DataFrame, features: DataFrame, keys: Sequence[str], label_ts: str, feature_ts: str, feature_cols: Sequence[str],
                delay: str, tie_breakers: Sequence[str] = (), max_age_seconds: float | None = None, groups: int = 1024) -> DataFrame:
    """The label stream with the newest feature row of its key as of its time: the rows of the batch lookup, for labels
    that the watermark has passed. Rows later than ``delay`` are dropped; labels without a key or a time pass at once with
    null features; features without one never match; a label is answered once, however micro-batches are cut.

    ``groups``: into how many groups keys are hashed. A group's state and its rows of a micro-batch meet in one call, so
    choose it such that a few thousand rows of a micro-batch fall to each; as with shuffle partitions, a checkpoint keeps
    the number it began with."""
    if groups < 1:
        raise ValueError("groups must be positive")
    l_schema = labels.schema
    f_schema = StructType([features.schema[c] for c in feature_cols])
    age = None if max_age_seconds is None else int(max_age_seconds * 1_000_000)

    def rows(df: DataFrame, ts: str, side: int, cols: Sequence[str], ties: Sequence[str]) -> DataFrame:
        return df.select(F.to_json(F.struct(*keys), JSON).alias("k"), F.col(ts).cast("timestamp").alias("t"), _micros(F.col(ts)).alias("us"),
                         F.lit(side).alias("side"), F.to_json(F.array(*ties), JSON).alias("tie") if ties else F.lit("[]").alias("tie"),
                         F.to_json(F.struct(*cols), JSON).alias("row"))
    whole = lambda ts: F.col(ts).isNotNull() & ~F.greatest(*[F.col(k).isNull() for k in keys], F.lit(False))
    group = F.pmod(F.xxhash64("k"), F.lit(groups)).cast("int").alias("g")
    both = rows(labels.where(whole(label_ts)), label_ts, 1, labels.columns, ()).unionByName(
        rows(features.where(whole(feature_ts)), feature_ts, 0, feature_cols, tie_breakers)).select(group, "*").withWatermark("t", delay)

    def matched(key: tuple, batches: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        began, held = pickle.loads(state.get[0]) if state.exists else (groups, {})  # noqa: S301 (written below)
        if began != groups:
            raise ValueError(f"the checkpoint was begun with {began} groups, not {groups}")
        touched = set()
        if not state.hasTimedOut:
            for b in batches:
                touched.update(b["k"])
                for k, us, side, tie, row in zip(*[b[c].tolist() for c in ("k", "us", "side", "tie", "row")], strict=True):
                    known, wait = held.setdefault(k, ([], []))
                    if side:
                        wait.append((us, row))
                    else:
                        known.append((us, json.loads(tie), row))
        watermark = state.getCurrentWatermarkMs()
        done, due = [], []
        for k, (known, wait) in list(held.items()):
            if k in touched or wait or age is not None:
                answered, known, wait = answer(known, wait, watermark * 1000, age)
                done += answered
                if not (known or wait):
                    del held[k]
                    continue
                held[k] = known, wait
            if wait or age is not None:  # wakes the group up when a label is due, or a key's last feature too old
                due.append(min([t for t, _ in wait] or [known[-1][0] + age]) // 1000)
        if held:
            state.update((pickle.dumps((groups, held)),))
            if due:
                state.setTimeoutTimestamp(max(min(due), watermark + 1))
        elif state.exists:
            state.remove()
        if done:
            yield pd.DataFrame(done, columns=["l", "f"])
    out = both.groupBy("g").applyInPandasWithState(matched, "l string, f string", "held binary", "append", GroupStateTimeout.EventTimeTimeout)
    out = out.select(F.from_json("l", l_schema, JSON).alias("l"), F.from_json("f", f_schema, JSON).alias("f"))
    names = [*[F.col("l")[c].alias(c) for c in labels.columns], *[F.col("f")[c].alias(c) for c in feature_cols]]
    loose = labels.where(~whole(label_ts)).select(*labels.columns, *[F.lit(None).cast(f.dataType).alias(f.name) for f in f_schema])
    return out.select(*names).unionByName(loose)
