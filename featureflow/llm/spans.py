"""Substring dedup over sliding sentence spans: runs of consecutive sentences are hashed, and word windows chosen by
winnowing, which need no sentence edges; equal ones are found by a global join, and what an earlier document has goes."""

from __future__ import annotations

import re
import sys

import numpy as np
import pandas as pd
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from featureflow.llm.common import c, fresh, stored, text_of

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # tasks need not have this package installed

SPACE = r"\x20\x09-\x0D"
STOP = r".!?\n\u3002\uFF01\uFF1F\uFF0E\uFF61\u2026\u0964\u0965\u061F\u06D4\u1362\u1367\u104A\u104B\u17D4\u17D5"  # of many scripts
SPACED_OUT = r"\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF"  # Thai, Lao, Burmese, Khmer: a space ends a clause or sentence
UNSPACED = SPACED_OUT + r"\u3005-\u3007\u3040-\u30FF\u31F0-\u31FF\u3400-\u4DBF\u4E00-\u9FFF\uF900-\uFAFF\U00020000-\U0003FFFF"
SENTENCE = re.compile(f"[^{STOP}]*[{STOP}]*[{SPACE}]*")  # consecutive matches cover the text
CLAUSE = re.compile(f"(?:[^{STOP}{SPACE}]|(?<![{SPACED_OUT}])[\\x20\\x09\\x0B-\\x0D])*[{STOP}]*[{SPACE}]*")
LETTER = re.compile(f"[{UNSPACED}]")
TOKEN = re.compile(f"[^{SPACE}]+")
TOKENS = re.compile(f"[{UNSPACED}]|[^{SPACE}{UNSPACED}]+")
LETTERS = 2         # letters of a script without spaces that count as a word
RUN_SENTENCES = 2   # sentences of a run: longer runs that repeat consist of such runs, which repeat too;
RUN_WORDS = 0       # a run goes on until it has so many words;
SINGLE_WORDS = 50   # a sentence of so many words is a run by itself as well
WINDOW = 26         # words (or letters of a script without spaces) of a hashed window,
CHOSEN = 25         # one of so many consecutive windows is: equal stretches of WINDOW + CHOSEN - 1 share one at least
BASE = 0x9E3779B97F4A7C15


def sentence_runs(text: str | None, sentences: int = RUN_SENTENCES, words: int = RUN_WORDS, single: int = SINGLE_WORDS):
    """(code point lengths of the sentences, runs as (hash, first, last)): from each sentence with words the run of
    ``sentences`` sentences with words, and long sentences alone. A run's hash is XXH128 of its sentences' hashes, which
    are XXH128 of their lower-cased words."""
    unspaced = LETTER.search(text or "")
    parts = [m for m in (CLAUSE if unspaced else SENTENCE).findall(text or "") if m]
    full, count, hashed = [], [], []  # of the sentences that have words
    for i, p in enumerate(parts):
        found = p.lower().split()
        if found:
            line = " ".join(found)
            full.append(i)
            count.append(max(len(found), len(LETTER.findall(line)) // LETTERS) if unspaced else len(found))
            hashed.append(xxhash.xxh128_digest(line))
    runs, n, j = [], 0, 0
    for k, i in enumerate(full):  # j: one past the run from k; n: its words
        while j < len(full) and (j - k < sentences or n < words):
            n += count[j]
            j += 1
        if j - k >= sentences and n >= words:
            runs.append((xxhash.xxh128_digest(b"".join(hashed[k:j])), i, full[j - 1]))
        if count[k] >= single:
            runs.append((hashed[k], i, i))
        n -= count[k]
    return [len(p) for p in parts], runs


def word_windows(text: str | None, size: int = WINDOW, chosen: int = CHOSEN):
    """Windows (hash, start, end) in code points: of each ``chosen`` consecutive windows of ``size`` words the one with the
    smallest rolling hash, so that the choice depends on the words alone. The end is where the next word starts."""
    text = text or ""
    found = list((TOKENS if LETTER.search(text) else TOKEN).finditer(text))
    n = len(found) - size + 1
    if n < 1:
        return []
    lower = [m.group().lower() for m in found]
    at = [0, *[m.start() for m in found[1:]], len(text)]
    with np.errstate(over="ignore"):
        power = np.cumprod(np.full(len(lower), BASE, np.uint64))
        back = np.cumprod(np.full(n, pow(BASE, -1, 2**64), np.uint64))
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(np.fromiter(map(xxhash.xxh64_intdigest, lower), np.uint64, len(lower)) * power)])
        key = (total[size:] - total[:n]) * back
        key ^= key >> np.uint64(32)
        key *= np.uint64(BASE)
    span = min(chosen, n)
    low = np.lib.stride_tricks.sliding_window_view(key, span)
    out, last = [], None
    for p in np.unique(np.arange(n - span + 1) + low.argmin(axis=1)).tolist():
        if last is not None and key[p] == key[last] and p - last < chosen:
            continue  # in a text that repeats itself, one of the equal windows will do
        out.append((xxhash.xxh128_digest(" ".join(lower[p:p + size])), at[p], at[p + size]))
        last = p
    return out


def hashed_spans(text: str | None) -> tuple[bytes, bytes, bytes, bytes]:
    """All of one text, packed: sentence lengths, distinct hashes of runs and windows (16 bytes each), their first spans
    (s, e), and the spans of later runs and windows with a hash that stands earlier in the text."""
    lens, runs = sentence_runs(text)
    at = np.concatenate([[0], np.cumsum(lens)]).astype(np.int64).tolist()
    first, spans, own = [], [], []
    for part in ([(h, at[i], at[j + 1]) for h, i, j in runs], word_windows(text)):
        seen: set = set()
        for h, s, e in part:
            if h in seen:
                own += (s, e)
            else:
                seen.add(h)
                first.append(h)
                spans += (s, e)
    return np.array(lens, "<i4").tobytes(), b"".join(first), np.array(spans, "<i4").tobytes(), np.array(own, "<i4").tobytes()


def runs_column(text: Column) -> Column:
    @F.pandas_udf("lens binary, hs binary, spans binary, own binary")
    def packed_spans(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([hashed_spans(t) for t in texts], columns=["lens", "hs", "spans", "own"])
    return packed_spans(text)


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", out: str = "repeats", keep_text: bool = True) -> DataFrame:
    """``docs`` with a struct ``out``: sentences, removed (number) and spans (s, e in code points, end exclusive) that
    earlier text has already: runs and word windows that a row with a smaller id holds, or that stand earlier in the same
    text. Stretches of 50 words are found wherever they start and end, and lose parts of sentences as well; removed
    counts whole sentences.

    Hashes are reduced to the smallest id a hash (partial aggregation), and joined back on the hash, where Spark splits
    hot ones. Rows with one id count as one document, so repeated rows keep the same sentences; rows without an id are
    one last document: they lose what any other row has, and keep what they share. Null and empty texts have no
    sentences; an empty table gives an empty result; input columns keep their names (``out`` must be free).
    """
    if out.lower() in (n.lower() for n in docs.columns):
        raise ValueError(f"column {out} exists")
    rid, found, dup_rid, dup = fresh(docs, "row_", "found_", "dup_row_", "dup_")
    d = docs.withColumn(found, runs_column(text_of(c(text_col))))
    d = stored((d if keep_text else d.drop(text_col)).withColumn(rid, F.monotonically_increasing_id()), "spans-runs")
    last, hs = F.lit(2**63 - 1), c(found)["hs"]
    pieces = F.when(F.length(hs) > 0, F.transform(F.sequence(F.lit(0), (F.length(hs) / 16).cast("int") - 1), lambda i: F.substring(hs, i * 16 + 1, F.lit(16))))
    mine = d.select(F.coalesce(c(id_col), last).alias("id"), c(rid).alias("rid"), F.posexplode(pieces).alias("no", "h"))
    first = mine.groupBy("h").agg(F.min("id").alias("first"), F.max("id").alias("final")).where("first < final").drop("final")
    again = mine.join(first, "h").where("id > first").groupBy("rid").agg(F.collect_list("no").alias("dup"))
    again = again.select(F.col("rid").alias(dup_rid), F.col("dup").alias(dup))
    d = d.join(again, c(rid) == c(dup_rid), "left")
    d = d.withColumn(out, covered(c(found)["lens"], c(found)["spans"], c(found)["own"], c(dup)))
    return d.drop(rid, found, dup_rid, dup)


def repeats_in(lens: bytes, spans: bytes, own: bytes, dup) -> tuple[int, int, list[dict]]:
    """(sentences, whole sentences removed, merged spans): the spans numbered in ``dup`` and the text's own repeats."""
    ends = np.cumsum(np.frombuffer(lens, "<i4"), dtype=np.int64).tolist()
    every = np.frombuffer(spans, "<i4").reshape(-1, 2)
    gone = every[:0] if dup is None else every[np.asarray(dup, np.int64)]
    merged: list[dict] = []
    for s, e in sorted(map(tuple, np.concatenate([gone, np.frombuffer(own, "<i4").reshape(-1, 2)]).tolist())):
        if merged and s <= merged[-1]["e"]:
            merged[-1]["e"] = max(e, merged[-1]["e"])
        else:
            merged.append({"s": s, "e": e})
    removed, k, at = 0, 0, 0
    for e in ends:
        while k < len(merged) and merged[k]["e"] < e:
            k += 1
        removed += k < len(merged) and merged[k]["s"] <= at
        at = e
    return len(ends), removed, merged


def covered(lens: Column, spans: Column, own: Column, dup: Column) -> Column:
    """``repeats_in`` as a column."""
    @F.pandas_udf("sentences int, removed int, spans array<struct<s:int,e:int>>")
    def spans_of(lens: pd.Series, spans: pd.Series, own: pd.Series, dup: pd.Series) -> pd.DataFrame:
        rows = [repeats_in(*x) for x in zip(lens, spans, own, dup, strict=True)]
        return pd.DataFrame(rows, columns=["sentences", "removed", "spans"])
    return spans_of(lens, spans, own, dup)


def cut(text: Column, spans: Column) -> Column:
    """The text without the spans."""
    @F.pandas_udf("string")
    def cut_text(texts: pd.Series, spans: pd.Series) -> pd.Series:
        def one(t, ss):
            if t is None or ss is None or not len(ss):
                return t
            keep, at = [], 0
            for x in ss:
                keep.append(t[at:x["s"]])
                at = x["e"]
            return "".join(keep) + t[at:]
        return pd.Series([one(t, s) for t, s in zip(texts, spans, strict=True)], dtype=object)
    return cut_text(text, spans)
