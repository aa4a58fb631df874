"""Conversation repair against a plain version that works from the end with (cost, audit) tuples."""
import os
import random
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute as B  # noqa: E402

from featureflow.llm import conversations as C, queries as Q  # noqa: E402

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id bigint, turn bigint, role string, text string"
rng = random.Random(11)


def expected(rows):
    kept = B.damaged(rows)
    return sorted(((conv, *B.repaired(kept.get(conv, []))) for conv in {r[0] for r in rows}), key=repr)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def noise(n, conv, turns):
    roles = ["user", "assistant", "system", "user", "assistant", None, "", "tool", "usr", "Äx"]
    texts = ["a.", "b!", "c?", "open end", "", None, " \n", "d.\t ", "e.  ", "f.", "g.", "h.", "x y z."]
    return [(conv, rng.choice([None, *turns]), rng.choice(roles), rng.choice(texts) if rng.random() < .4 else f"t{rng.randrange(10**6)}.")
            for _ in range(n)]


@pytest.mark.parametrize("block", [3, 256])
def test_random_conversations(spark, monkeypatch, block):
    monkeypatch.setattr(C, "BLOCK_ROWS", block)  # tables of blocks, chosen paths and streamed digests of long conversations
    rows = [r for conv in range(120) for r in noise(rng.randrange(1, 14), conv, range(-3, 12))]
    rows += noise(40, None, range(20)) + noise(300, 10**15 + 7, range(-10**6, 10**6, 9973)) + [(500, 2, "user", "same.")] * 70
    rows += [(501, None, "user" if i % 2 else "assistant", "same end.") for i in range(50)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({n: F.lit("x") for n in ("conv", "pos", "n", "kind", "gone", "same", "first", "report", "a b")})
    assert rows_of(Q.repair_report(df.repartition(7))) == expected(rows)


def test_awkward_conversations(spark):
    long = "word " * 300_000
    rows = [(1, 2**63 - 1, "user", long), (1, -2**63, "assistant", long + "."), (2, None, None, None), (3, 0, "system", "only a system text."),
            (4, 1, "user", "q?"), (4, 2, "assistant", "a."), (4, 2, "assistant", "a.")]
    got = rows_of(Q.repair_report(spark.createDataFrame(rows, SCHEMA)))
    want = [(x[0], min(x[1], 2**63 - 1), *x[2:]) for x in expected(rows)]
    assert got == sorted(want, key=repr)
    assert Q.repair_report(spark.createDataFrame([], SCHEMA)).count() == 0


def test_all_rows_dropped_and_ties(spark):
    gone = next(i for i in range(1000) if not B.damaged([(i, 0, "user", "x.")])[i])
    (row,) = Q.repair_report(spark.createDataFrame([(gone, 0, "user", "x.")], SCHEMA)).collect()
    assert tuple(row) == (gone, 0, 0, 0, 0, 0, 0, "", "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855")
    # two user turns: inserting an answer between them costs 3 as rerole does not help and deleting costs 4
    rows = spark.createDataFrame([(1, 0, "user", "a?"), (1, 1, "user", "b?"), (1, 2, "assistant", "c.")], SCHEMA)
    report, turns = C.repair(rows, keep_text=True)
    assert report.select("cost", "audit").collect() == [(3, "KIKK")]
    (blocks,) = turns.collect()
    assert [tuple(t) for t in blocks.turns] == [("K", "user", "a?"), ("I", "assistant", ""), ("K", "user", "b?"), ("K", "assistant", "c.")]


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(Q.op11_conversation_repair(spark, SF)) == expected(rows)
