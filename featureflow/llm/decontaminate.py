"""Benchmark decontamination with a generalised suffix automaton of normalised test items.

The items' words form one automaton: a state is a set of word sequences that end at the same places of the items. A
document's words are streamed through it; the state and the length of the longest match that ends at each word say which
windows (``window`` consecutive item words; a shorter item is one window) end there. Words inside a window are hit.
Spans of hit words are cut out, and documents whose hit share passes a limit are dropped.

An automaton holds items of at most ``SHARD_WORDS`` words (a longer item by itself), so that what is broadcast has a known
size; more items make more automata, each streams all documents, and their findings are joined by row.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from featureflow.llm.common import c, fresh, stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # tasks need not have this package installed

WINDOW = 10             # words of a window
SHARD_WORDS = 1 << 20   # item words in one automaton
PART_BYTES = 1 << 18    # of a text, split into words at once
_UPPER, _LOWER = bytes(range(65, 91)), bytes(range(97, 123))
_GAPS = bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
NORMAL = bytes.maketrans(_UPPER + _GAPS, _LOWER + b" " * len(_GAPS))  # UTF-8 bytes from 0x80 on stay as they are
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def normal_words(text: str | None) -> Iterator[bytes]:
    """Words of a text, one by one: A-Z lower-cased, runs of anything but ASCII characters that are no letters or digits."""
    flat, at = (text or "").encode().translate(NORMAL), 0
    while at < len(flat):  # very long texts are split part by part
        end = flat.find(b" ", at + PART_BYTES) if at + PART_BYTES < len(flat) else -1
        end = len(flat) if end < 0 else end
        yield from flat[at:end].split()
        at = end


class Automaton:
    """Generalised suffix automaton over word sequences. ``items`` of a state: which items hold a window whose
    occurrence is told by a match that reaches the state with ``window`` words or more; ``ends``: (length, item) of the
    short items that a match in this state ends with, longest first."""

    def __init__(self, items: list[list[bytes]], window: int = WINDOW):
        self.window = window
        self.next: list[dict] = [{}]
        self.link, self.length = [-1], [0]
        self.code: dict[bytes, int] = {}
        paths = []
        for words in items:
            state, path = 0, []
            for w in words:
                state = self._extend(state, self.code.setdefault(w, len(self.code)))
                path.append(state)
            paths.append(path)
        self._mark(items, paths)

    def _extend(self, last: int, x: int) -> int:
        """The state of the item read so far and one more word."""
        nxt, link, length = self.next, self.link, self.length
        if x in nxt[last]:  # another item begins alike
            q = nxt[last][x]
            return q if length[q] == length[last] + 1 else self._clone(last, x, q)
        new = self._state(length[last] + 1, {})
        p = last
        while p >= 0 and x not in nxt[p]:
            nxt[p][x] = new
            p = link[p]
        if p < 0:
            link[new] = 0
        else:
            q = nxt[p][x]
            link[new] = q if length[q] == length[p] + 1 else self._clone(p, x, q)
        return new

    def _state(self, length: int, follow: dict) -> int:
        self.next.append(follow)
        self.link.append(-1)
        self.length.append(length)
        return len(self.next) - 1

    def _clone(self, p: int, x: int, q: int) -> int:
        nxt, link = self.next, self.link
        new = self._state(self.length[p] + 1, dict(nxt[q]))
        link[new], link[q] = link[q], new
        while p >= 0 and nxt[p].get(x) == q:
            nxt[p][x] = new
            p = link[p]
        return new

    def _mark(self, items, paths) -> None:
        """Which items a window's state stands for, and where short items end."""
        at: dict[int, set] = {}
        short: dict[int, list] = {}
        self.home: dict[int, int] = {}  # state -> the state that holds its suffix of ``window`` words
        for no, (words, path) in enumerate(zip(items, paths, strict=True)):
            if len(words) >= self.window:
                for state in path[self.window - 1:]:
                    at.setdefault(self._home(state), set()).add(no)
            elif words:  # its own state may hold longer sequences too: those end with the item as well
                short.setdefault(path[-1], []).append((len(words), no))
        self.items = {s: tuple(sorted(x)) for s, x in at.items()}
        self.ends: list[tuple] = [()] * len(self.next)
        for s in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            self.ends[s] = tuple(sorted(short.get(s, ()), reverse=True)) + self.ends[self.link[s]]

    def _home(self, state: int) -> int:
        if state not in self.home:
            s = state
            while self.length[self.link[s]] >= self.window:
                s = self.link[s]
            self.home[state] = s
        return self.home[state]

    def search(self, words: Iterator[bytes]) -> tuple[int, list[tuple[int, int]], set, int]:
        """(words, spans of hit words, items found, longest match) of a document."""
        nxt, link, length, ends, window = self.next, self.link, self.length, self.ends, self.window
        spans, found, longest, j = [], set(), 0, -1
        state = n = 0
        for j, x in enumerate(map(self.code.get, words)):
            if x is None:
                state = n = 0
                continue
            while x not in nxt[state]:  # the root knows every word of the items
                state = link[state]
                n = length[state]
            state = nxt[state][x]
            n += 1
            if n > longest:
                longest = n
            hit = 0
            if n >= window:
                found.update(self.items[self._home(state)])
                hit = n
            for size, no in ends[state]:
                if size <= n:
                    found.add(no)
                    if size > hit:
                        hit = size
            if hit:
                start = j + 1 - hit
                while spans and spans[-1][0] >= start:
                    spans.pop()
                if spans and spans[-1][1] >= start:
                    spans[-1] = (spans[-1][0], j + 1)
                else:
                    spans.append((start, j + 1))
        return j + 1, spans, found, longest


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def _places(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans of words as spans of code points: from the first word's start to the last one's end."""
    starts, ends = {s for s, _ in spans}, {e - 1 for _, e in spans}
    first, last = {}, {}
    for i, m in enumerate(WORD.finditer(text)):
        if i in starts:
            first[i] = m.start()
        if i in ends:
            last[i + 1] = m.end()
    return [(first[s], last[e]) for s, e in spans]


def _shards(items: DataFrame, id_col: str, text_col: str, most: int) -> Iterator[list[tuple[str, list[bytes]]]]:
    """Items (id as text, words) in parts of at most ``most`` words. The driver holds one part at a time."""
    part, n = [], 0
    rows = items.select(c(id_col).cast("string").alias("id"), c(text_col).cast("string").alias("text"))
    for r in rows.toLocalIterator():
        words = list(normal_words(r.text))
        if not words:
            continue
        if part and n + len(words) > most:
            yield part
            part, n = [], 0
        part.append((r.id, words))
        n += len(words)
    if part:
        yield part


FOUND = "struct<n_words:bigint,n_hit:bigint,longest:bigint,items:array<string>,words:array<struct<s:bigint,e:bigint>>,spans:array<struct<s:bigint,e:bigint>>>"


def _streamed(text: Column, part: list[tuple[str, list[bytes]]], window: int, spark) -> Column:
    """The findings of one automaton, streamed over texts."""
    held = spark.sparkContext.broadcast((vars(Automaton([w for _, w in part], window)), [i for i, _ in part]))

    @F.pandas_udf(FOUND.removeprefix("struct<").removesuffix(">"))
    def automaton_search(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        parts, ids = held.value
        automaton = Automaton([])
        vars(automaton).update(parts)
        names = ("n_words", "n_hit", "longest", "items", "words", "spans")
        for texts in batches:
            rows = []
            for text in texts:
                n, spans, found, longest = automaton.search(normal_words(text))
                rows.append((n, sum(e - s for s, e in spans), longest, sorted({ids[i] for i in found if ids[i] is not None}),
                             _named(spans), _named(_places(text, spans)) if spans else []))
            yield pd.DataFrame(rows, columns=names)
    return automaton_search(text)


def _named(spans) -> list[dict]:
    return [{"s": s, "e": e} for s, e in spans]


def find_contamination(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
                       out: str = "found", window: int = WINDOW, shard_words: int = SHARD_WORDS, keep_text: bool = True) -> DataFrame:
    """``docs`` with a struct ``out``: n_words, n_hit, longest (match, in words), items (ids as text, sorted), words (hit
    spans by word number) and spans (by code point, end exclusive).

    Null and empty texts have no words; items without words match nothing; items with one id count once; an item without
    an id marks words and isn't listed. Repeated rows are found alike, ids of documents play no part, texts of any length
    are streamed whole. No documents or no items give no findings; input columns keep their names (``out`` must be free).
    """
    if out.lower() in (n.lower() for n in docs.columns):
        raise ValueError(f"column {out} exists")
    spark = docs.sparkSession
    names = [n for n in docs.columns if keep_text or n != text_col]
    parts = _shards(items, item_id, item_text, shard_words)
    part = next(parts, [])
    more = next(parts, None)
    whole = c(text_col).cast("string")
    if more is None:
        return docs.select(*[c(n) for n in names], _streamed(whole, part, window, spark).alias(out))
    (rid,) = fresh(docs, "row_")
    docs = stored(docs.withColumn(rid, F.monotonically_increasing_id()), "decontaminate-rows")
    frames = []
    while part:
        new = docs.select(c(rid).alias("rid"), _streamed(whole, part, window, spark).alias("f"))
        frames.append(stored(new.where("f.longest > 0"), "decontaminate-found"))
        part, more = more, next(parts, None)
    found = reduce(DataFrame.unionByName, frames)
    spans = F.array_sort(F.flatten(F.collect_list("f.words")))
    merged = found.groupBy("rid").agg(F.max("f.longest").alias("longest"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("f.items")))).alias("items"),
                                      spans.alias("w"))
    key, m = fresh(docs, "merged_row_", "merged_")
    joined = docs.join(merged.select(F.col("rid").alias(key), F.struct("longest", "items", "w").alias(m)), c(rid) == c(key), "left")
    return joined.select(*[c(n) for n in names], _joined(whole, c(m)).alias(out))


def _joined(text: Column, merged: Column) -> Column:
    """Findings of several automata as one."""
    @F.pandas_udf(FOUND.removeprefix("struct<").removesuffix(">"))
    def joined_findings(texts: pd.Series, found: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for text, longest, items, words in zip(texts, found["longest"], found["items"], found["w"], strict=True):
            spans = [] if words is None else _merged([(int(x["s"]), int(x["e"])) for x in words])
            rows.append((sum(1 for _ in normal_words(text)), sum(e - s for s, e in spans), 0 if items is None else int(longest),
                         [] if items is None else list(items), _named(spans), _named(_places(text, spans)) if spans else []))
        return pd.DataFrame(rows, columns=["n_words", "n_hit", "longest", "items", "words", "spans"])
    return joined_findings(text, merged)


def decontaminate(docs: DataFrame, items: DataFrame, text_col: str = "text", max_share: float = 0.5, min_words: int = WINDOW, **params) -> DataFrame:
    """``docs`` without test items: hit spans of ``min_words`` words or more are cut out of the text, and documents with
    more than ``max_share`` of their words hit are dropped. Rows without hits are left as they are."""
    (f,) = fresh(docs, "found")
    d = find_contamination(docs, items, text_col, out=f, **params)
    d = d.where((c(f)["n_hit"] == 0) | (c(f)["n_hit"] <= max_share * c(f)["n_words"]))
    both = F.arrays_zip(c(f)["words"].alias("w"), c(f)["spans"].alias("p"))
    long = F.transform(F.filter(both, lambda x: x["w"]["e"] - x["w"]["s"] >= min_words), lambda x: x["p"])
    ends = F.concat(F.transform(long, lambda x: x["s"]), F.array(F.length(c(text_col)).cast("long")))
    starts = F.concat(F.array(F.lit(0).cast("long")), F.transform(long, lambda x: x["e"]))
    kept = F.transform(F.arrays_zip(starts.alias("s"), ends.alias("e")),
                       lambda x: F.substring(c(text_col), (x["s"] + 1).cast("int"), (x["e"] - x["s"]).cast("int")))
    clean = F.when(c(f)["n_hit"] > 0, F.array_join(kept, "")).otherwise(c(text_col))
    return d.select(*[clean.alias(n) if n == text_col else c(n) for n in docs.columns])
