"""Phrase collocations by prefix-free parsing.

A document is a sequence of words with a stop between pieces. Windows of ``OVERLAP`` words whose hash meets a condition are
triggers; a chunk reaches from one trigger to the end of the next, so consecutive chunks overlap by a trigger. Where a text
is cut depends on its words alone: copied passages give equal chunks, and the dictionary holds each distinct chunk once with
its parse frequency. n-grams are counted inside the distinct chunks, weighted by those frequencies; an n-gram belongs to the
chunk where it starts before the final trigger, so those inside an overlap count once. ``OVERLAP`` is the longest phrase
less one word, so no phrase is cut.

A phrase can only be as frequent as its parts. Words are counted first, then pairs of frequent words, then longer phrases all
of whose pairs are frequent. What is frequent goes to the tasks as a bitmap of fixed size over hashes: clashes
only let more n-grams through to the exact count.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from featureflow.llm.common import c, stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # tasks need not have this package installed

MAX_WORDS = 4            # of a phrase
OVERLAP = MAX_WORDS - 1  # words of a trigger
TRIGGER = 64             # one window in so many is a trigger
BITMAP_BITS = 26         # of a hash: 8 MB
BATCH_WORDS = 3 << 18    # words counted together inside a task
_UPPER, _LOWER = bytes(range(65, 91)), bytes(range(97, 123))
STOPS = b".,;:!?\n\x0b\x0c\r"
STOP = b"."              # a word can't hold it
NORMAL = bytes.maketrans(_UPPER + b"\t" + STOPS, _LOWER + b" " + b"\n" * len(STOPS))
MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def words_and_stops(text: str | None) -> list[bytes]:
    """Lower-cased words of a text, a stop between pieces and a trigger's length of stops at the end."""
    flat = (text or "").encode().translate(NORMAL).replace(b"\n", b" . ")
    return flat.split() + [STOP] * OVERLAP


class Hashes(dict):
    """word -> XXH64, remembered for so many words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def chunks_of(words: list[bytes], hashes: Hashes, trigger: int = TRIGGER) -> Iterator[bytes]:
    """Chunks of one document, joined by spaces."""
    n = len(words) - OVERLAP
    if n <= 0:
        return
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    with np.errstate(over="ignore"):
        key = sum((h[i:i + n] * MIX[i % len(MIX)] for i in range(OVERLAP)), np.zeros(n, np.uint64))
        key ^= key >> np.uint64(29)
    cuts = np.flatnonzero(key % np.uint64(trigger) == 0).tolist()
    start = 0
    for cut in [*cuts, n]:
        if cut > start:
            yield b" ".join(words[start:cut + OVERLAP])
        start = cut


def parse(docs: DataFrame, group: str, text: str, trigger: int = TRIGGER) -> DataFrame:
    """(grp, chunk, n): the dictionary of distinct chunks a group with their parse frequencies."""
    schema = pa.schema([("grp", pa.string()), ("chunk", pa.binary())])

    def chunked(batches):
        hashes = Hashes()
        groups, chunks, size = [], [], 0
        for b in batches:
            for at, g in enumerate(b.column(0).to_pylist()):
                for x in chunks_of(words_and_stops(b.column(1)[at].as_py()), hashes, trigger):
                    groups.append(g)
                    chunks.append(x)
                    size += len(x)
                    if size > 1 << 22:
                        yield pa.RecordBatch.from_arrays([pa.array(groups, pa.string()), pa.array(chunks, pa.binary())], schema=schema)
                        groups, chunks, size = [], [], 0
        yield pa.RecordBatch.from_arrays([pa.array(groups, pa.string()), pa.array(chunks, pa.binary())], schema=schema)
    d = docs.select(F.coalesce(c(group).cast("string"), F.lit("und")).alias("grp"), c(text).cast("string").alias("text")).where("text is not null")
    return d.mapInArrow(chunked, "grp string, chunk binary").groupBy("grp", "chunk").agg(F.count(F.lit(1)).alias("n"))


def _places(group: str, hashes: np.ndarray, size: int, bits: int = BITMAP_BITS) -> np.ndarray:
    """For each run of ``size`` words, given their hashes, its place in the bitmap."""
    n = max(0, len(hashes) - size + 1)
    with np.errstate(over="ignore"):
        key = sum((hashes[j:j + n] * MIX[j % len(MIX)] for j in range(size)), np.full(n, xxhash.xxh64_intdigest(group.encode()), np.uint64))
        key ^= key >> np.uint64(31)
        key *= MIX[0]
    return (key >> np.uint64(64 - bits)).astype(np.int64)


def _numbered(ids: np.ndarray, places: np.ndarray, size: int, vocabulary: int) -> np.ndarray:
    """A number for the words from each place on, equal where all ``size`` words are."""
    keys, room = ids[places], vocabulary
    for j in range(1, size):
        if room * vocabulary >= 1 << 62:
            keys = np.unique(keys, return_inverse=True)[1]
            room = len(places) + 1
        keys, room = keys * vocabulary + ids[places + j], room * vocabulary
    return keys


def _counted(group: str, chunks: list[bytes], weights: list[int], sizes: tuple[int, ...], known: int, bitmap: np.ndarray | None,
             hashes: Hashes) -> Iterator[tuple[int, list[bytes], np.ndarray]]:
    """(size, phrases, weighted counts) in these chunks of one group. ``bitmap``: which phrases of ``known`` words are
    frequent; others can't be part of a frequent one."""
    parts = [x.split() for x in chunks]
    lens = np.fromiter(map(len, parts), np.int64, len(parts))
    tokens = list(chain.from_iterable(parts))
    code: dict = {STOP: 0}
    ids = np.fromiter((code.setdefault(t, len(code)) for t in tokens), np.int64, len(tokens))
    good = word = ids != 0
    if known:
        h = np.fromiter(map(hashes.__getitem__, code), np.uint64, len(code))[ids]
        at = _places(group, h, known)
        good = bitmap[at >> 3] >> (at & 7).astype(np.uint8) & 1 == 1
    weight = np.repeat(np.array(weights, np.int64), lens)
    inner = np.arange(len(ids)) < np.repeat(np.cumsum(lens) - OVERLAP, lens)  # starts before the final trigger
    for size in sizes:
        n = max(0, len(ids) - size + 1)
        ok = inner[:n].copy()
        for j in range(size):
            ok &= word[j:j + n]
        for j in range(size - known + 1 if known else 0):
            ok &= good[j:j + n]
        places = np.flatnonzero(ok)
        if not len(places):
            continue
        keys = _numbered(ids, places, size, len(code))
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        first = places[order[starts]].tolist()
        yield size, [b" ".join(tokens[i:i + size]) for i in first] if size > 1 else [tokens[i] for i in first], np.add.reduceat(weight[places][order], starts)


def count_phrases(dictionary: DataFrame, sizes: tuple[int, ...], known: int = 0, bitmap: bytes | None = None) -> DataFrame:
    """(grp, phrase, words, f): weighted counts of the phrases of these sizes inside the distinct chunks, as far as all their
    parts of ``known`` words are in the bitmap."""
    held = dictionary.sparkSession.sparkContext.broadcast(bitmap)
    schema = pa.schema([("grp", pa.string()), ("phrase", pa.binary()), ("words", pa.int32()), ("f", pa.int64())])

    def counted(batches):
        bits = None if held.value is None else np.frombuffer(held.value, np.uint8)
        hashes, kept = Hashes(), {}

        def flush(g):
            chunks, weights, _ = kept.pop(g)
            for size, phrases, total in _counted(g, chunks, weights, sizes, known, bits, hashes):
                for at in range(0, len(phrases), 1 << 17):
                    part = phrases[at:at + (1 << 17)]
                    yield pa.RecordBatch.from_arrays([pa.array([g] * len(part), pa.string()), pa.array(part, pa.binary()), pa.array([size] * len(part), pa.int32()),
                                                      pa.array(total[at:at + (1 << 17)], pa.int64())], schema=schema)
        held_words = 0
        for b in batches:
            for g, chunk, n in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                mine = kept.setdefault(g, [[], [], 0])
                mine[0].append(chunk)
                mine[1].append(n)
                size_ = chunk.count(b" ") + 1
                mine[2] += size_
                held_words += size_
                if held_words > BATCH_WORDS:  # the group with the most words goes
                    most = max(kept, key=lambda x: kept[x][2])
                    held_words -= kept[most][2]
                    yield from flush(most)
        for g in list(kept):
            yield from flush(g)
    rows = dictionary.select("grp", "chunk", "n").mapInArrow(counted, "grp string, phrase binary, words int, f bigint")
    return rows.groupBy("grp", "phrase", "words").agg(F.sum("f").alias("f"))


def bitmap_of(frequent: DataFrame, bits: int = BITMAP_BITS) -> bytes:
    """Bitmap of the hashes of phrases, put together by Spark from 64 kB pieces: its size doesn't depend on the data."""
    piece = 19  # bits of a piece
    schema = pa.schema([("part", pa.int32()), ("bits", pa.binary())])

    def mapped(batches):
        hashes, mine = Hashes(), {}
        for b in batches:
            for g, p in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                words = p.split(b" ")
                at = int(_places(g, np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words)), len(words), bits)[0])
                if at >> piece not in mine:
                    mine[at >> piece] = bytearray(1 << piece - 3)
                mine[at >> piece][(at & (1 << piece) - 1) >> 3] |= 1 << (at & 7)
        for part, x in mine.items():
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([bytes(x)], pa.binary())], schema=schema)

    def joined(key, table):
        x = reduce(np.bitwise_or, (np.frombuffer(v.as_py(), np.uint8) for v in table.column("bits")))
        return pa.table({"part": [key[0].as_py()], "bits": [x.tobytes()]}, schema=schema)
    rows = frequent.select("grp", "phrase").mapInArrow(mapped, "part int, bits binary")
    out = bytearray(1 << bits - 3)
    for r in rows.groupBy("part").applyInArrow(joined, "part int, bits binary").toLocalIterator():
        out[r.part << piece - 3:(r.part + 1) << piece - 3] = r.bits
    return bytes(out)


def frequent_phrases(docs: DataFrame, group: str = "lang", text: str = "text", least: int = 30, trigger: int = TRIGGER) -> tuple[DataFrame, DataFrame]:
    """((grp, phrase, words, f) of all phrases of 1 to ``MAX_WORDS`` words with f >= ``least``, (grp, n): words a group)."""
    dictionary = stored(parse(docs, group, text, trigger), "phrases-dictionary")
    single = stored(count_phrases(dictionary, (1,)), "phrases-words")
    totals = single.groupBy("grp").agg(F.sum("f").alias("n"))
    levels = [single.where(F.col("f") >= least)]
    for known, sizes in ((1, (2,)), (2, tuple(range(3, MAX_WORDS + 1)))):
        levels.append(stored(count_phrases(dictionary, sizes, known, bitmap_of(levels[-1])).where(F.col("f") >= least), f"phrases-{sizes[0]}"))
    return reduce(DataFrame.unionByName, levels).withColumn("phrase", F.col("phrase").cast("string")), totals


def collocations(docs: DataFrame, group: str = "lang", text: str = "text", least: int = 30, share: int = 80, top: int = 2000,
                 trigger: int = TRIGGER) -> DataFrame:
    """Rows (grp, rank, phrase, a, l, r, n, score): each group's first ``top`` phrases of 2 to ``MAX_WORDS`` words.

    a counts the phrase, l and r the two parts of its weakest cut (score floor(2000000 a / (l + r)), lowest first, then the
    shortest first part); n the group's words. Phrases inside a longer one that is ``share`` percent as frequent are dropped.
    Order: score and a falling, phrase rising by bytes.
    Null groups are named und, null and empty texts hold no phrases; repeated rows count each; an empty table gives an
    empty result; texts of any length are parsed whole; extra columns are ignored. Sums and products are exact.
    """
    every, totals = frequent_phrases(docs, group, text, least, trigger)
    every = stored(every, "phrases-frequent")
    found = every.where("words > 1").select("grp", "phrase", F.col("words").alias("size"), F.col("f").alias("a"), F.split("phrase", " ").alias("w"))
    f = every.select("grp", "phrase", "f")
    part = lambda at, k: F.array_join(F.slice("w", at, k), " ")
    cuts = found.select("grp", "phrase", "a", "size", "w", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select("grp", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("first"), part(F.col("k") + 1, F.col("size")).alias("rest"))
    cuts = (cuts.join(f.select("grp", F.col("phrase").alias("first"), F.col("f").alias("l")), ["grp", "first"])
            .join(f.select("grp", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["grp", "rest"]))
    score = F.expr("cast((cast(a as decimal(20, 0)) * 2000000BD) div (cast(l as decimal(20, 0)) + cast(r as decimal(20, 0))) as bigint)")
    weakest = cuts.withColumn("score", score).groupBy("grp", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("m"))
    inside = found.where("size > 2").select("grp", F.col("a").alias("longer"), "w", "size", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("k"))
    inside = inside.select("grp", "longer", "w", "k", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("k") + 1)).alias("at"))
    inside = inside.select("grp", part(F.col("at"), F.col("k")).alias("phrase"), "longer").groupBy("grp", "phrase").agg(F.max("longer").alias("longer"))
    exact = lambda name: F.col(name).cast("decimal(20,0)")
    kept = weakest.join(inside, ["grp", "phrase"], "left").where(F.col("longer").isNull() | (exact("longer") * 100 < exact("a") * share))
    kept = kept.join(totals, "grp").select("grp", "phrase", "a", "m.l", "m.r", "n", "m.score")
    from pyspark.sql import Window
    order = Window.partitionBy("grp").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    return kept.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
