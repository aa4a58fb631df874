"""Language of texts by a linear-chain conditional random field over words.

Every word has hashed features: its prefixes and suffixes, its character n-grams and itself (the lexicon). The
labels are languages; transition weights are learned with the features by the gradient of the log-likelihood, on
sequences that switch language from stretch to stretch. Forward-backward gives each word's label probabilities, so
code-switched text gets its words labelled one by one; a text's language has the largest mean probability.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window, functions as F

from featureflow.llm.common import c, let, stored, text_of, words

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # tasks need not have this package installed

TRAIN_DOCS = 3000     # labelled documents that the model is fitted on, at most, over the labels in equal shares
TRAIN_LABELS = 300    # (at least 10 a label, so many labels at most: those of the most documents), the first by a hash of their id,
TRAIN_WORDS = 400     # and words of each, the bounds of the training sample: a longer text gives stretches of STRETCH words
HASH_BITS = 16        # of the hash bins that the sample is cut by
STRETCH = 20          # that lie evenly from its first word to its last
SPACE = 1 << 17       # hashed features
PIECE = 1 << 16       # features that are summed at a time
STEPS, BATCH, LENGTH = 600, 64, 40
GROUP = 256           # texts of like length that go through forward-backward together
MEMO_WORDS = 800_000  # words whose features a Python worker remembers
WORD = regex.compile(r"\p{L}+")


def word_features(word: str) -> Iterator[list[int]]:
    """Hashed ids, at most PIECE at a time: the word, affixes of one to three characters, all trigrams with word ends."""
    w = f"^{word}$"
    names = ["w" + word, *[f"p{word[:n]}" for n in (1, 2, 3)], *[f"s{word[-n:]}" for n in (1, 2, 3)]]
    for lo in range(0, len(w) - 2, PIECE):
        grams = [w[i:i + 3] for i in range(lo, min(lo + PIECE, len(w) - 2))]
        yield [zlib.crc32(x.encode("utf-8", "surrogatepass")) % SPACE for x in (names + grams if lo == 0 else grams)]


def word_scores(found: list[str], emit: np.ndarray) -> np.ndarray:
    """Label scores (words, L): the sums of the words' feature weights."""
    out = np.zeros((len(found), emit.shape[1]), emit.dtype)
    flat, rows, starts = [], [], []

    def flush():
        np.add.at(out, rows, np.add.reduceat(emit[flat], starts, axis=0))
        flat.clear(), rows.clear(), starts.clear()
    for i, word in enumerate(found):
        for piece in word_features(word):
            rows.append(i), starts.append(len(flat)), flat.extend(piece)
            if len(flat) >= PIECE:
                flush()
    if rows:
        flush()
    return out


def forward_backward(emit: np.ndarray, step: np.ndarray, size: np.ndarray, pairs: np.ndarray | None = None) -> np.ndarray:
    """Label probabilities (T, B, L) of B sequences: emit is (T, B, L) in log space, step (L, L) transition
    weights, size the lengths, longest first. Scaled to sums of one at every word. The expected transitions are
    added to ``pairs`` (L, L) if it is given."""
    t_max, n, labels = emit.shape
    e, tr = np.exp(emit - emit.max(axis=2, keepdims=True)), np.exp(step - step.max())
    live = np.searchsorted(-size, -np.arange(t_max), side="left")  # sequences with a word at t
    fwd = np.zeros_like(e)
    fwd[0] = e[0] / e[0].sum(axis=1, keepdims=True)
    for t in range(1, t_max):
        a = (fwd[t - 1, : live[t]] @ tr) * e[t, : live[t]]
        fwd[t, : live[t]] = a / a.sum(axis=1, keepdims=True)
    out, back = fwd.copy(), np.ones((n, labels))
    for t in range(t_max - 2, -1, -1):
        b = np.ones((live[t], labels))
        if live[t + 1]:
            ahead = back[: live[t + 1]] * e[t + 1, : live[t + 1]]
            x = ahead @ tr.T
            if pairs is not None:
                joint = fwd[t, : live[t + 1], :, None] * tr * ahead[:, None, :]
                pairs += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            b[: live[t + 1]] = x / x.sum(axis=1, keepdims=True)
        back = b
        p = fwd[t, : live[t]] * b
        out[t, : live[t]] = p / p.sum(axis=1, keepdims=True)
    return out


def fit(samples: list[tuple[str, list[str]]], seed: int = 7) -> dict:
    """Weights from (language, words) samples: {langs, emit (SPACE, L), step (L, L)}. Training sequences join
    stretches of 4 to 20 words of random samples, so transitions see both staying and switching."""
    langs = sorted({lang for lang, w in samples if w})
    n = len(langs)
    model = {"langs": langs, "emit": np.zeros((SPACE, max(n, 1)), np.float32), "step": np.zeros((max(n, 1),) * 2, np.float32)}
    if n < 2:
        return model
    vocab: dict[str, int] = {}
    by = {k: [np.array([vocab.setdefault(x, len(vocab)) for x in w]) for lang, w in samples if lang == lang_k and w]
          for k, lang_k in enumerate(langs)}
    grams, rng = [np.array([i for piece in word_features(w) for i in piece]) for w in vocab], np.random.default_rng(seed)
    emit, step = np.zeros((SPACE, n)), np.zeros((n, n))
    seen, seen_step = np.full((SPACE, n), 1e-3), np.full((n, n), 1e-3)
    for _ in range(STEPS):
        ids, gold = np.zeros((BATCH, LENGTH), np.int64), np.zeros((BATCH, LENGTH), np.int64)
        for b in range(BATCH):
            at = 0
            while at < LENGTH:
                k = int(rng.integers(n))
                doc = by[k][int(rng.integers(len(by[k])))]
                size = min(int(rng.integers(4, 21)), LENGTH - at, len(doc))
                start = int(rng.integers(len(doc) - size + 1))
                ids[b, at:at + size], gold[b, at:at + size] = doc[start:start + size], k
                at += size
        f = [grams[w] for w in ids.ravel()]
        sizes, f = np.array([len(x) for x in f]), np.concatenate(f)
        e = np.add.reduceat(emit[f], np.cumsum(sizes) - sizes, axis=0).reshape(BATCH, LENGTH, n).transpose(1, 0, 2)
        expected = np.zeros((n, n))
        p = forward_backward(e, step, np.full(BATCH, LENGTH), expected).transpose(1, 0, 2)
        grad = np.eye(n)[gold] - p
        flat = np.repeat(grad.reshape(-1, n), sizes, axis=0)
        g = np.stack([np.bincount(f, flat[:, k], SPACE) for k in range(n)], axis=1) / BATCH
        pair = -expected
        np.add.at(pair, (gold[:, :-1].ravel(), gold[:, 1:].ravel()), 1.0)
        pair /= BATCH
        seen += g * g
        emit += 0.3 * g / np.sqrt(seen)
        seen_step += pair * pair
        step += 0.1 * pair / np.sqrt(seen_step)
    model["emit"], model["step"] = emit.astype(np.float32), step.astype(np.float32)
    return model


def _stretches(w: Column) -> Column:
    n = TRAIN_WORDS // STRETCH
    start = lambda i: F.floor(i * (F.size(w) - STRETCH) / (n - 1)).cast("int") + 1
    some = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.slice(w, start(i), F.lit(STRETCH))))
    return F.when(F.size(w) <= TRAIN_WORDS, w).otherwise(some)


def training_sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, docs_bound: int = TRAIN_DOCS) -> DataFrame:
    """(lang, w): about ``docs_bound`` labelled documents outside the held-out part, TRAIN_WORDS words of each, from all over
    its text. Rows without a label, an id or a text take no part; rows of one id and label count once, with the smallest text.

    The first documents by a hash of their id are found from a label's histogram of hashes, so a label's window task sees
    about as many rows as it gives, however many documents and repeated rows the label has."""
    key = F.xxhash64(c(id_col).cast("string"))
    ok = c(lang_col).isNotNull() & c(id_col).isNotNull() & ~held_out(c(id_col)) & c(text_col).isNotNull()
    rest = docs.where(ok).select(c(lang_col).cast("string").alias("lang"), key.alias("key"), c(text_col).alias("text"))
    bin_ = F.shiftright("key", 64 - HASH_BITS)
    hist = rest.select("lang", "key").distinct().groupBy("lang", bin_.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    hist = stored(hist, "langid-hashes")  # 2 ** HASH_BITS rows a label at most
    counts = hist.groupBy("lang").agg(F.sum("n").alias("n")).orderBy(F.col("n").desc(), "lang").limit(TRAIN_LABELS).collect()
    share, left = {}, docs_bound
    for i, r in enumerate(sorted(counts, key=lambda r: (r.n, r.lang))):  # what rare labels leave goes to the others
        share[r.lang] = max(10, min(r.n, left // (len(counts) - i)))
        left -= min(share[r.lang], r.n)
    bound = F.create_map(*[x for k, v in share.items() for x in (F.lit(k), F.lit(v))]) if share else F.lit(None).cast("map<string,int>")
    before = F.sum("n").over(Window.partitionBy("lang").orderBy("bin")) - F.col("n")
    last = hist.withColumn("before", before).where(F.col("before") < bound[F.col("lang")]).groupBy("lang").agg(F.max("bin").alias("last"))
    top = rest.join(F.broadcast(last), "lang").where(bin_ <= F.col("last")).groupBy("lang", "key").agg(F.min("text").alias("text"))
    no = F.row_number().over(Window.partitionBy("lang").orderBy("key"))
    low = F.regexp_replace(F.lower("text"), r"[^\p{L}]+", " ")
    top = top.withColumn("no", no).where(F.col("no") <= bound[F.col("lang")])
    return top.orderBy("key", "lang").select("lang", let(words(low), _stretches).alias("w"))


def held_out(id_col: Column) -> Column:
    """crc32 of the id as text, mod 4, is 2; false for a null id."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict:
    sample = training_sample(docs, id_col, text_col, lang_col)
    return fit([(r.lang, list(r.w)) for r in sample.collect()])  # of bounded size


class WordScores(dict):
    """word -> row of ``table``, the words' label scores."""

    def add(self, words: set[str], emit: np.ndarray) -> None:
        """Makes room for a batch's words; forgets the others when there are more than MEMO_WORDS."""
        new = [w for w in words if w not in self]
        if len(self) + len(new) > MEMO_WORDS:
            self.clear()
            new = list(words)
        if not self:
            self.table = np.zeros((0, emit.shape[1]), np.float32)
        parts = [self.table[: len(self)]]
        first = len(self)
        self.table = np.concatenate([*parts, word_scores(new, emit)])
        self.update(zip(new, range(first, first + len(new)), strict=True))


def label_words(found: list[list[int]], table: np.ndarray, step: np.ndarray) -> list[np.ndarray]:
    """Label probabilities (words, L) for each list of word rows; texts of like length go together."""
    out: list = [None] * len(found)
    order = sorted((i for i, x in enumerate(found) if x), key=lambda i: -len(found[i]))
    for at in range(0, len(order), GROUP):
        part = order[at:at + GROUP]
        size = np.array([len(found[i]) for i in part])
        rows = np.zeros((size[0], len(part)), np.int64)
        for b, i in enumerate(part):
            rows[: size[b], b] = found[i]
        p = forward_backward(table[rows], step, size)
        for b, i in enumerate(part):
            out[i] = p[: size[b], b]
    return out


def predict(docs: DataFrame, model: dict, text_col: str = "text", out: str = "language") -> DataFrame:
    """``docs`` with a struct ``out``: lang (a learned label, or und if the text is null or has no letter) and score,
    the mean probability of that label over the words (0 for und).

    Only the text is read. Ties go to the label that sorts first; with one learned label every text with a letter
    gets it; with none all are und. Ids, repeated rows and extra columns don't matter; an empty table gives an
    empty result; whole texts are labelled, of any length.
    """
    if out.lower() in (n.lower() for n in docs.columns):
        raise ValueError(f"column {out} exists")
    shared = docs.sparkSession.sparkContext.broadcast((model, {}))  # of fixed size; the memo is each worker's own
    pattern = WORD.pattern

    @F.pandas_udf("lang string, score double")
    def language(texts: pd.Series) -> pd.DataFrame:
        known, kept = shared.value
        langs, findall = known["langs"], regex.compile(pattern).findall
        lang, score = np.array(["und"] * len(texts), dtype=object), np.zeros(len(texts))
        if langs:
            for lo in range(0, len(texts), 2048):  # bounds the word rows held at once
                rows = kept.setdefault("rows", WordScores())
                found = [findall(t.lower()) if t else [] for t in texts.iloc[lo:lo + 2048]]
                rows.add(set().union(*found), known["emit"])
                found = [list(map(rows.__getitem__, f)) for f in found]
                for i, p in enumerate(label_words(found, rows.table, known["step"])):
                    if p is not None:
                        mean = p.mean(axis=0, dtype=np.float64)
                        k = int(mean.argmax())
                        lang[lo + i], score[lo + i] = langs[k], min(1.0, float(mean[k]))
        return pd.DataFrame({"lang": lang, "score": score})
    return docs.withColumn(out, language(text_of(c(text_col))))
