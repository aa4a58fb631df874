"""Byte-level BPE encoding and decoding.

A word is a match of the pre-tokenizer's pattern. Its bytes are folded: each step merges the adjacent pair of
lowest rank (leftmost of equals). Spark counts the corpus' distinct words and folds the most frequent ones with
higher-order functions that read ranks from a literal map. That fold takes about 0.1 ms a word, too slow for the
long tail (see the README for figures), so the texts are encoded in Arrow batches: words are looked up in the
broadcast dictionary (its size is bounded), and other words are folded by the same ranked merges, once a worker.
No text is shuffled and the result doesn't depend on the bound. Decoding concatenates the pieces of the ids.
"""

from __future__ import annotations

import base64
import heapq
import json
import re
import sys

import numpy as np
import pandas as pd
import regex
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from featureflow.llm.common import LiteralMap, c, let, stored, text_of

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # tasks need not have this package installed

DICTIONARY_WORDS = 50_000  # words folded by Spark for the broadcast dictionary
MEMO_WORDS = 300_000  # words a Python worker remembers besides; it forgets them all when there are more
TOGETHER = 48  # bytes up to which words are merged many at a time
LONG_WORD = 256  # bytes from which a heap finds the lowest pair
DICTIONARY_WORD_CHARS = 64  # longer words are not in the dictionary

# The pattern of byte-level pre-tokenizers (fixed value), in the spelling of Python's regex module and of Java:
# Unicode white space, and possessive repeats where the next character can't belong to the repeat.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}++| ?\p{N}++| ?[^\p{White_Space}\p{L}\p{N}]++|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
# Texts of Latin-1 characters only, without the few for which the classes of Python's re differ, may use re.
LATIN_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"
NOT_LATIN = "[\x1c-\x1f\xb2\xb3\xb9\xbc-\xbe\u0100-\U0010ffff]"
JAVA_PATTERN = r"(?U)'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s+(?!\S)|\s+"


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a .tiktoken vocabulary file (read on the driver: a vocabulary has a fixed size)."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def pieces_of(text: Column) -> Column:
    """Words of a text in the pre-tokenizer's sense; null reads as empty."""
    return F.regexp_extract_all(text_of(text), F.lit(JAVA_PATTERN), F.lit(0))


def fold_word(ranks: LiteralMap, table: Column, raw: Column) -> Column:
    """Ids of one word, given as binary: its own rank, else its byte array is folded by ranked merges. Each step
    reads the ranks of all adjacent pairs and merges the lowest (of equals the leftmost)."""
    rank = lambda piece: ranks.get(table, piece)

    def merge(state, _):
        parts = state["parts"]
        key = lambda i: F.shiftleft(let(F.concat(F.get(parts, i - 1), F.get(parts, i)), rank).cast("long"), 32).bitwiseOR(i.cast("long"))
        low = F.when(F.size(parts) > 1, F.array_min(F.transform(F.sequence(F.lit(1), F.size(parts) - 1), key)))

        def at(m):
            i = m.bitwiseAND(F.lit(2**32 - 1)).cast("int")  # parts i and i + 1, from 1
            joined = F.concat(F.slice(parts, F.lit(1), i - 1), F.array(F.concat(F.get(parts, i - 1), F.get(parts, i))),
                              F.slice(parts, i + 2, F.size(parts)))
            return F.struct(F.when(m.isNull(), parts).otherwise(joined).alias("parts"), m.isNull().alias("done"))
        return F.when(state["done"], state).otherwise(let(low, at))
    n = F.length(raw)
    start = F.struct(F.transform(F.sequence(F.lit(1), n), lambda i: F.substring(raw, i, F.lit(1))).alias("parts"), F.lit(False).alias("done"))
    folded = F.aggregate(F.sequence(F.lit(1), n), start, merge, lambda s: F.transform(s["parts"], rank))
    whole = let(raw, rank)
    return F.when(whole.isNotNull(), F.array(whole)).otherwise(folded)


def distinct_words(docs: DataFrame, text_col: str) -> DataFrame:
    """(word, n) over all documents. Stretches between single spaces are counted first, and only distinct ones are matched;
    stretches that touch longer white space can give words that no text has, which do no harm."""
    parts = docs.select(F.explode(F.split(text_of(c(text_col)), " ")).alias("part")).groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    words = parts.select(F.explode(pieces_of(F.concat(F.lit(" "), F.col("part")))).alias("word"), "n")
    return words.groupBy("word").agg(F.sum("n").alias("n"))


def dictionary(docs: DataFrame, text_col: str, ranks: dict[bytes, int], limit: int = DICTIONARY_WORDS) -> dict[str, bytes]:
    """Packed ids of at most ``limit`` frequent distinct words of the corpus, each folded once by Spark: the words above the
    lowest count that no more than ``limit`` words pass, read from a histogram of counts (powers of 1.1)."""
    top = distinct_words(docs, text_col).where((F.length("word") <= DICTIONARY_WORD_CHARS) & (F.col("n") > 1))
    level = F.floor(F.log(1.1, F.col("n").cast("double"))).cast("int")
    top = stored(top.select("word", level.alias("level")), "bpe-words")
    held, least = 0, None
    for r in sorted(top.groupBy("level").agg(F.count(F.lit(1)).alias("n")).collect(), key=lambda r: -r.level):  # 460 levels at most
        if held + r.n > limit:
            break
        held, least = held + r.n, r.level
    if least is None:
        return {}
    n, literal = top.sparkSession.sparkContext.defaultParallelism, LiteralMap(ranks, "int", "binary")
    ids = let(literal.table, lambda t: let(F.col("word").cast("binary"), lambda raw: fold_word(literal, t, raw)))
    coded = top.where(F.col("level") >= least).select("word").repartition(n).select("word", ids.alias("ids"))
    return {r.word: pack(r.ids) for r in coded.toLocalIterator()}  # at most ``limit`` rows


def pack(ids: list[int]) -> bytes:
    return np.array(ids, "<u4").tobytes()


def merge_word(raw: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one word: its own rank, else ranked merges, lowest rank first, of equals the leftmost."""
    if raw in ranks:
        return [ranks[raw]]
    if len(raw) > LONG_WORD:
        return _merge_long(raw, ranks)
    none, get = len(ranks) + 1 << 32, ranks.get
    part = [raw[i:i + 1] for i in range(len(raw))]
    pair = [get(raw[i:i + 2], none) for i in range(len(raw) - 1)]
    while pair and (low := min(pair)) != none:
        i = pair.index(low)
        part[i:i + 2] = [part[i] + part[i + 1]]
        del pair[i]
        if i < len(pair):
            pair[i] = get(part[i] + part[i + 1], none)
        if i:
            pair[i - 1] = get(part[i - 1] + part[i], none)
    return [ranks[x] for x in part]


def _merge_long(raw: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges over a linked list of parts with a heap of adjacent pairs: n log n for n bytes."""
    part = [raw[i:i + 1] for i in range(len(raw))]
    after, before = [*range(1, len(raw)), -1], [*range(-1, len(raw) - 1)]
    heap = [(ranks[raw[i:i + 2]], i, 2) for i in range(len(raw) - 1) if raw[i:i + 2] in ranks]
    heapq.heapify(heap)
    while heap:
        _, i, size = heapq.heappop(heap)
        j = after[i] if part[i] is not None else -1
        if j < 0 or len(part[i]) + len(part[j]) != size:
            continue  # one of the two was merged meanwhile
        part[i], part[j] = part[i] + part[j], None
        after[i] = after[j]
        if after[j] >= 0:
            before[after[j]] = i
        for a, b in ((before[i], i), (i, after[i])):
            if a >= 0 and b >= 0 and (r := ranks.get(part[a] + part[b])) is not None:
                heapq.heappush(heap, (r, a, len(part[a]) + len(part[b])))
    return [ranks[x] for x in part if x is not None]


def pair_table(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sorted keys of adjacent pieces as (left rank, right rank), rank of the merged piece, rank of each single byte)."""
    keys, merged = [], []
    for piece, rank in ranks.items():
        for cut in range(1, len(piece)):
            left, right = ranks.get(piece[:cut]), ranks.get(piece[cut:])
            if left is not None and right is not None:
                keys.append(left << 32 | right)
                merged.append(rank)
    keys, merged = np.array(keys, np.int64), np.array(merged, np.int64)
    order = np.argsort(keys)
    return keys[order], merged[order], np.array([ranks[bytes([i])] for i in range(256)], np.int64)


def merge_words(raws: list[bytes], table: tuple[np.ndarray, np.ndarray, np.ndarray]) -> list[bytes]:
    """Packed ids of words of like length by ranked merges, all words together: each step merges every word's lowest pair,
    of equals the leftmost. No word is a piece by itself."""
    keys, merged, single = table
    none = np.int64(1 << 40)
    size = np.fromiter(map(len, raws), np.int64, len(raws))
    width = int(size.max()) + 1
    part = np.full((len(raws), width), -1, np.int64)
    part[np.arange(width) < size[:, None]] = single[np.frombuffer(b"".join(raws), np.uint8)]

    def rank_of(left, right):
        key = left << 32 | right
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        return np.where((keys[at] == key) & (left >= 0) & (right >= 0), merged[at], none)
    pair = np.full((len(raws), width), none)
    pair[:, :-1] = rank_of(part[:, :-1], part[:, 1:])
    out: list = [b""] * len(raws)
    which, column = np.arange(len(raws)), np.arange(width - 1)
    while len(which):
        at = pair.argmin(axis=1)
        low = pair[np.arange(len(which)), at]
        done = low == none
        if done.any():
            for i in np.flatnonzero(done).tolist():
                out[which[i]] = part[i, :size[i]].astype("<u4").tobytes()
            live = ~done
            which, part, pair, size, at, low = which[live], part[live], pair[live], size[live], at[live], low[live]
            if not len(which):
                break
        rows = np.arange(len(which))
        part[:, :-1] = np.take_along_axis(part, column + (column > at[:, None]), axis=1)  # the right piece goes
        pair[:, :-1] = np.take_along_axis(pair, column + (column >= at[:, None]), axis=1)
        part[rows, at] = low
        size -= 1
        pair[rows, at] = rank_of(low, part[rows, at + 1])
        inner = np.flatnonzero(at > 0)
        pair[inner, at[inner] - 1] = rank_of(part[inner, at[inner] - 1], low[inner])
    return out


def encode(docs: DataFrame, path: str, text_col: str = "text", out: str = "ids", limit: int = DICTIONARY_WORDS) -> DataFrame:
    """``docs`` with ``out``: the ids of every whole text, as the vocabulary at ``path`` encodes it without special
    tokens, packed as little-endian unsigned 32-bit integers (``unpack`` gives an array). Null and empty texts
    have no ids; ids, ties and repeated rows play no part; an empty table gives an empty result; input columns
    keep their names (``out`` must be free). Words and texts of any length are encoded whole."""
    if out.lower() in (n.lower() for n in docs.columns):
        raise ValueError(f"column {out} exists")
    ranks = read_ranks(path)
    context = docs.sparkSession.sparkContext
    # all of bounded size; the empty memo is filled by each Python worker for itself and outlives a task
    known = context.broadcast((dictionary(docs, text_col, ranks, limit), ranks, pair_table(ranks), {}))
    pattern = PATTERN

    @F.pandas_udf("binary")
    def bpe_ids(texts: pd.Series) -> pd.Series:
        words, ranks, table, kept = known.value
        memo = kept.setdefault("ids", WordIds())
        every, latin = regex.compile(pattern).findall, re.compile(LATIN_PATTERN).findall
        other = re.compile(NOT_LATIN).search
        done: list[bytes] = []
        for part in text_parts(texts):
            found = [(every if other(t) else latin)(t) if t else () for t in part]
            memo.learn(set().union(*found), words, ranks, table)
            done += [b"".join(map(memo.__getitem__, f)) for f in found]
            memo.forget_long()
        return pd.Series(done, dtype=object)
    once = bpe_ids.asNondeterministic()  # ids that are also decoded are encoded once: Spark would put the call into both places
    return docs.withColumn(out, once(c(text_col)))


def text_parts(texts, chars: int = 1 << 20):
    """Texts in lists of about so many characters."""
    part, n = [], 0
    for t in texts:
        part.append(t)
        n += len(t) if t else 0
        if n >= chars:
            yield part
            part, n = [], 0
    if part:
        yield part


class WordIds(dict):
    """word -> packed ids: the dictionary's words, and others as they come up, up to MEMO_WORDS."""

    def learn(self, found: set[str], words: dict[str, bytes], ranks: dict[bytes, int], table) -> None:
        """Ids of all words of a part of the texts."""
        self.long: list[str] = []
        if not self or len(self) + len(found) > MEMO_WORDS:
            self.clear()
            self.update(words)
        sized: dict[int, list] = {}
        for w in found - self.keys():
            raw = w.encode()
            if raw in ranks:
                self[w] = pack([ranks[raw]])
            elif len(raw) > TOGETHER:
                self[w] = pack(merge_word(raw, ranks))
                self.long.append(w)
            else:
                sized.setdefault(len(raw) + 3 >> 2, []).append((w, raw))
        for group in sized.values():
            for at in range(0, len(group), 1 << 13):
                part = group[at:at + (1 << 13)]
                for (w, _), ids in zip(part, merge_words([raw for _, raw in part], table), strict=True):
                    self[w] = ids

    def forget_long(self) -> None:
        for w in self.long:
            del self[w]


def n_tokens(ids: Column) -> Column:
    return F.floor(F.octet_length(ids) / 4).cast("long")


def unpack(ids: Column) -> Column:
    """Packed ids as an array of int."""
    @F.pandas_udf("array<int>")
    def bpe_unpack(packed: pd.Series) -> pd.Series:
        return pd.Series([None if b is None else np.frombuffer(b, "<u4").astype(np.int32) for b in packed], dtype=object)
    return bpe_unpack(ids)


def decode(ids: Column, path: str) -> Column:
    """The bytes of packed ids: their pieces, concatenated. Null ids give null."""
    ranks = read_ranks(path)
    pieces: list = [b""] * (max(ranks.values()) + 1)
    for piece, i in ranks.items():
        pieces[i] = piece

    @F.pandas_udf("binary")
    def bpe_bytes(packed: pd.Series) -> pd.Series:
        return pd.Series([None if b is None else b"".join([pieces[i] for i in np.frombuffer(b, "<u4").tolist()]) for b in packed],
                         dtype=object)
    return bpe_bytes(ids)
