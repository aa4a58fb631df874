"""Decontamination against plain windows, on random word sequences over few words and on the tables."""
import os
import random
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute as B  # noqa: E402

from featureflow.llm import decontaminate as D, queries as Q  # noqa: E402

SF = "/root/testdata/sf0.001"
DOCS, ITEMS = "doc_id bigint, text string", "item_id bigint, text string"
rng = random.Random(13)


def text(n, words="abc"):
    return "".join(rng.choice(words) + rng.choice([" ", ", ", ". ", "-", "\x00"]) for _ in range(n))


@pytest.mark.parametrize("window", [1, 2, 3, 10])
def test_search_equals_windows(window):
    for _ in range(150):
        items = [(i, text(rng.randrange(0, 16), "abcd" if rng.random() < .5 else "ab")) for i in range(rng.randrange(1, 8))]
        docs = [(0, text(rng.randrange(0, 80), "abcdX"))]
        a = D.Automaton([list(D.normal_words(t)) for _, t in items], window)
        n, spans, found, _ = a.search(D.normal_words(docs[0][1]))
        assert (0, n, sum(e - s for s, e in spans), len(found), B.sha(",".join(sorted(map(str, found)))), bool(spans)) == B.contamination(docs, items, window)[0]


@pytest.mark.parametrize("shard", [1, D.SHARD_WORDS])
def test_find_contamination(spark, monkeypatch, shard):
    monkeypatch.setattr(D, "PART_BYTES", 50)
    base = [text(14, "pqrstuvé") for _ in range(6)]
    items = [(i, t) for i, t in enumerate(base)] + [(10, None), (11, ""), (12, "!!"), (3, "Short Item"), (None, "one two"), (14, "Éa éa"), (4, base[0])]
    docs = [(i, t) for i, t in enumerate([None, "", " . ", "short  ITEM here", "one TWO one two", "éa éa", "Éa éa", "x " * 30_000 + base[0] + " y" * 50_000])]
    docs += [(20 + i, text(5) + base[i % 6][rng.randrange(8):] + text(9) + base[(i + 1) % 6] + text(4)) for i in range(30)] + [(None, base[1]), (25, base[2]), (25, base[2])]
    df = spark.createDataFrame(docs, DOCS).withColumns({n: F.lit("x") for n in ("found", "row_", "rid", "words", "items", "n_hit", "merged_rid", "a b")})
    it = spark.createDataFrame(items, ITEMS)
    f = D.find_contamination(df, it, out="f", shard_words=shard)
    got = f.select("doc_id", "f.n_words", "f.n_hit", F.size("f.items"), F.sha2(F.array_join("f.items", ","), 256), F.col("f.n_hit") > 0)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(B.contamination(docs, items), key=repr)
    assert f.columns == [*df.columns, "f"]
    none = spark.createDataFrame([], ITEMS)
    assert D.find_contamination(df, none, out="f").where("f.n_hit > 0").count() == 0
    assert D.find_contamination(df.limit(0), it, out="f").count() == 0


def test_spans_are_cut(spark):
    item = "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11"
    docs = [(1, f"Før, {item.upper()}! and a lot more text stands behind it, so that it may stay; {item}"), (2, item), (3, "clean"), (4, None), (5, "w1 w2")]
    out = D.decontaminate(spark.createDataFrame(docs, DOCS).withColumn("found", F.lit(1)), spark.createDataFrame([(0, item), (1, "clean")], ITEMS),
                          max_share=0.7, min_words=2)
    assert sorted(map(tuple, out.select("doc_id", "text").collect()), key=repr) == [
        (1, "Før, ! and a lot more text stands behind it, so that it may stay; "), (4, None), (5, "w1 w2")]


def test_whole_tables(spark):
    read = lambda n: [tuple(r) for r in spark.read.parquet(f"{SF}/{n}.parquet").select(*(["doc_id", "text"] if n == "documents" else ["item_id", "text"])).collect()]
    want = B.contamination(read("documents"), read("benchmark"))
    assert any(x[-1] for x in want)
    assert sorted(map(tuple, Q.op13_decontaminate(spark, SF).collect())) == sorted(want)
