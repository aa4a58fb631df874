"""Collocations against plain counting; the parsing alone against its promises."""
import os
import random
import sys
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute as B  # noqa: E402

from featureflow.llm import phrases as P, queries as Q  # noqa: E402

SF = "/root/testdata/sf0.001"
rng = random.Random(12)
NAMES = ("grp", "rank", "phrase", "a", "l", "r", "n", "score")


def text(n):
    return "".join(rng.choice(["a", "B", "c d", "é", "E f g", "\x85", "x\x00"]) + rng.choice([" ", " ", " ", "\t", ", ", ".\n", "\x0b", "  "]) for _ in range(n))


@pytest.mark.parametrize("trigger", [1, 2, 7, 10**6])
def test_every_phrase_is_in_one_chunk(trigger):
    hashes = P.Hashes()
    for _ in range(60):
        words = P.words_and_stops(text(rng.randrange(0, 90)))
        chunks = list(P.chunks_of(words, hashes, trigger))
        for k in (1, 2, 3, 4):
            every = Counter(tuple(words[i:i + k]) for i in range(len(words) - P.OVERLAP))
            parts = Counter(tuple(w[i:i + k]) for w in (x.split(b" ") for x in chunks) for i in range(len(w) - P.OVERLAP))
            assert every == parts
            if chunks:
                bits = np.full(1 << P.BITMAP_BITS - 3, 255, np.uint8)
                got = {p: n for known in (0, 1, 2)[:k] for _, ps, total in P._counted("en", chunks, [3] * len(chunks), (k,), known, bits, hashes)
                       for p, n in zip(ps, total.tolist(), strict=True)}
                assert got == {b" ".join(p): 3 * n for p, n in every.items() if P.STOP not in p and len(p) == k}


@pytest.mark.parametrize("trigger,batch", [(3, 50), (64, P.BATCH_WORDS)])
def test_collocations(spark, monkeypatch, trigger, batch):
    monkeypatch.setattr(P, "BATCH_WORDS", batch)
    docs = [(rng.choice(["en", "de", None, "und", ""]), text(rng.randrange(0, 60))) for _ in range(120)]
    docs += [("en", None), (None, ""), ("en", " . ,"), ("hot", "go go " * 4000)] + [("en", "New York city is big. new york CITY")] * 9
    df = spark.createDataFrame(docs, "lang string, text string").withColumns({n: F.lit("x") for n in ("grp", "chunk", "n", "phrase", "f", "a b")})
    got = P.collocations(df.repartition(5), least=4, top=25, trigger=trigger).select(*NAMES)
    assert sorted(map(tuple, got.collect())) == sorted(B.collocations(docs, 4, top=25))


def test_nothing_to_count(spark):
    assert P.collocations(spark.createDataFrame([], "lang string, text string")).count() == 0
    assert P.collocations(spark.createDataFrame([("en", None), (None, "a b")], "lang string, text string")).count() == 0


def test_exact_products(spark):
    huge = 9 * 10**18  # frequencies of a corpus far beyond this one: products pass 64 bits
    row = spark.range(1).select(F.expr(f"cast((cast({huge} as decimal(20, 0)) * 2000000BD) div (cast({huge} as decimal(20, 0)) + cast({huge} as decimal(20, 0))) as bigint)")).first()
    assert row[0] == 10**6


def test_whole_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("lang", "text").collect()]
    assert sorted(map(tuple, Q.op12_phrases(spark, SF).collect())) == sorted(B.collocations(docs, 30))
