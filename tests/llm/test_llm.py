"""Corpus operators against plain versions and on awkward tables: nulls, empty and long texts, ties,
repeated rows, empty tables, extra columns with clashing names."""
import os
import random
import sys
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute as B  # noqa: E402

from featureflow.llm import ann, bpe, common, langid, licenses, mixing, pii, quality, queries as Q, simhash, spans, urls  # noqa: E402
from featureflow.llm.components import connected_components  # noqa: E402

SF = "/root/testdata/sf0.001"
rng = random.Random(5)
WORDS = [f"{a}{b}" for a in ("ka", "lo", "mi", "su", "té") for b in ("ra", "ne", "pi", "do", "zu", "x1")]
BODY = " ".join(rng.choice(WORDS) for _ in range(120))
EDGE = [None, "", " \n\t ", "one", "one two three", BODY, BODY, BODY.upper(), BODY + " tail", BODY.replace("kara", "KARA", 1),
        "a b c a b c a b c", "line one\nline one\n\nline two\n \n", "x " * 30000, "y" * 100000, "ünï\x0bcode gap \U0001F600 ok"]
ROWS = [(i, t) for i, t in enumerate(EDGE)] + [(None, BODY), (5, BODY), (77, "mail a.b@c.org_d@e.net. ip 1.2.3.4.5 and 300.1.1.1 007.0.0.255 "
        "card 4111 1111 1111 1111, +1 (555) 010-9999 +12 3")]


def frame(spark, rows=ROWS):
    """With columns whose names clash with the operators' own."""
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    return df.withColumns({n: F.lit("x") for n in ("quality", "size_", "row_", "base_", "words_", "n_words", "a b", "signals_", "found_", "units_")})


def test_simhash(spark):
    got = simhash.simhash_components(frame(spark), "doc_id", "text").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")), "component_id").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(B.simhash(ROWS), key=repr)
    assert simhash.simhash_components(frame(spark, []).select("doc_id", "text")).count() == 0


def test_simhash_links_of_random_fingerprints(spark):
    base = [rng.getrandbits(64) for _ in range(40)]
    fps = set(base)
    for f in base:
        for _ in range(8):
            f ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, 5)))  # chains that drift away
            fps.add(f)
    fps = sorted(fps)
    signed = [(x - 2**64 if x >= 2**63 else x,) for x in fps]
    df = spark.createDataFrame(signed, "fp bigint")
    df = df.select("fp", *simhash.pivot_distances(F.col("fp")))
    for shared in (2, 3):
        got = {}
        for r in simhash._linked(df, 4, shared).collect():
            got.setdefault(r.comp, set()).add(r.fp % 2**64)
        parent = {f: f for f in fps}

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x
        for i, a in enumerate(fps):
            for b in fps[:i]:
                if (a ^ b).bit_count() <= 4:
                    parent[find(a)] = find(b)
        want = {}
        for f in fps:
            want.setdefault(find(f), set()).add(f)
        assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_tied_components_of_a_bucket_have_one_commonest(spark):
    rows = [(key, comp, n) for key in range(20) for comp, n in ((-7, 1), (3, 2), (9, 2), (5, 2))] + [(99, 1, 4)]
    for order in (rows, rows[::-1], sorted(rows, key=lambda r: (r[0], -r[2], r[1]))):
        counts = spark.createDataFrame(order, "key bigint, comp bigint, n bigint").coalesce(1)
        assert {(r.key, r.major) for r in simhash._commonest(counts).collect()} == {(key, 9) for key in range(20)}


def test_one_of_each_group_stays(spark):
    df = frame(spark)
    kept = simhash.drop_near_copies(df)
    assert kept.columns == df.columns
    comps = {c for _, _, c in B.simhash(ROWS)}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(comps)


def test_components(spark):
    chain = [(i, i + 1) for i in range(60)] + [(200, 100 + i) for i in range(50)] + [(7, 7), (None, 3), (300, 301)]
    got = dict(map(tuple, connected_components(spark.createDataFrame(chain, "a bigint, b bigint"), "a", "b").collect()))
    assert got == {**{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(50)}, 200: 100, 300: 300, 301: 300}
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint"), "a", "b").count() == 0


def test_quality_base(spark):
    df = frame(spark).drop("quality").withColumn("source", F.when(F.col("doc_id") < 8, "s"))
    got = quality.judge_documents(df, "source", "text", "quality").select("text", "quality.*").collect()
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == B.quality(r.text)
    assert len(got) == len(ROWS)
    with pytest.raises(ValueError):
        quality.judge_documents(frame(spark).withColumn("source", F.lit("")), out="quality")
    empty = frame(spark, []).withColumn("source", F.lit("s"))
    assert quality.judge_documents(empty, out="q").count() == 0


def test_bad_host_is_rejected_and_small_hosts_shrink(spark):
    good, bad = BODY, "short text"
    rows = [("a", good)] * 200 + [("b", bad)] * 180 + [("b", good)] * 20 + [("c", bad)] + [("d", good)] * 200 + [(None, good)] * 5
    df = spark.createDataFrame(rows, "source string, text string")
    kept = {(r.source, r.kept): r["count"] for r in quality.judge_documents(df, out="q").select("source", "q.kept").groupBy("source", "kept").count().collect()}
    assert kept[("a", True)] == 200 and kept[("b", False)] == 200 and kept[("d", True)] == 200 and kept[(None, True)] == 5


def test_pii_base(spark):
    found = pii.find_pii(frame(spark), "text", "p").select("text", pii.span_text(F.col("p.base")).alias("b")).collect()
    for r in found:
        assert r.b == ",".join(f"{k}:{a}:{e}" for k, a, e in B.pii(r.text))
    assert pii.find_pii(frame(spark, []), "text", "p").count() == 0


def test_pii_bootstrap_finds_new_identifiers_in_seeded_contexts(spark):
    rows = [(i, f"{rng.choice(WORDS)} {rng.choice(WORDS)} call phone: +1 555 010 {1000 + i} {rng.choice(WORDS)}") for i in range(30)]
    rows += [(100, "please call phone: 0155-501-0999, thanks"), (101, f"in the year {2024} nothing 55555 happened")]
    found = pii.find_pii(spark.createDataFrame(rows, "doc_id bigint, text string"), "text", "p")
    got = {r.doc_id: (r.s, r.t) for r in found.select("doc_id", pii.span_text(F.col("p.spans")).alias("s"), pii.redact(F.col("text"), F.col("p.spans")).alias("t")).collect()}
    assert got[100] == ("phone:19:32", "please call phone: <PHONE>, thanks") and got[101][0] == ""


def test_pii_spaced_identifiers_and_contexts_seeded_by_discovery(spark):
    seen = [f"reach desk: +1 555 010 {i:04d} today" for i in range(200)]
    new = ["(555) 010-9999", "020 7946 0958", *[f"0155 501 {i:04d}" for i in range(14)]]
    rows = seen + [f"reach desk: {x} today" for x in new] + [f"fallback nr {x} today" for x in new] + ["fallback nr 0301 555 0123 today", "room 12 at 2024 only"]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string")
    got = [r.t for r in pii.find_pii(df).select("doc_id", pii.redact(F.col("text"), F.col("pii.spans")).alias("t")).orderBy("doc_id").collect()]
    assert got[200:216] == ["reach desk: <PHONE> today"] * 16
    assert got[216:] == ["fallback nr <PHONE> today"] * 17 + ["room 12 at 2024 only"]


def test_mixing(spark):
    rows = [(i, ["s1", "s2", "s3", "s4", None][min(4, i % 7)], " ".join(rng.choice(WORDS) for _ in range(rng.randint(0, 80)))) for i in range(900)]
    rows += [(1, "s1", None), (None, "s2", "a b"), (5, "s1", "same"), (5, "s1", "same"), (9, "tiny", "one two")]
    df = spark.createDataFrame(rows, "doc_id bigint, source string, text string").withColumn("size_", F.lit(1))
    first = mixing.mix(df, out="m").select("doc_id", "source", "text", "m.*").collect()
    again = mixing.mix(df.repartition(7), out="m").select("doc_id", "source", "text", "m.*").collect()
    assert sorted(map(tuple, first), key=repr) == sorted(map(tuple, again), key=repr)
    sizes, taken = B.by_source(rows), {}
    want = B.targets(sizes)
    for r in first:
        taken[r.source] = taken.get(r.source, 0) + r.taken
        assert r.taken <= 3 * r.size and r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source]
    for s in ("s1", "s2", "s3", "s4", None):
        assert taken[s] == pytest.approx(want[s], rel=0.03)
    assert mixing.mix(df.limit(0), out="m").count() == 0


def test_mixing_dual(spark):
    """Rates against the dual solved by plain bisection in numpy: every source meets its target, the length multiplier
    is shared by all sources, and the mix's words lie in texts about as long as the corpus's."""
    g = np.random.default_rng(5)
    rows = [(s, k, int(g.integers(1, 40)), float(round(g.integers(1, 40) * 2.0 ** (k / 4)))) for s, lo, hi in
            (("a", 2, 20), ("b", 10, 40), ("c", 5, 6), (None, 0, 30), ("e", 30, 44)) for k in range(lo, hi)]
    groups = spark.createDataFrame(rows, "source string, class int, n bigint, words double")
    sums = groups.groupBy("source").agg(F.sum("words").cast("long").alias("source_size"))
    sums = sums.unionByName(spark.createDataFrame([("zero", 0)], sums.schema))
    targets = mixing.source_targets(sums)
    got = mixing.solve_rates(groups, targets).select("source", "target", F.explode("classes").alias("k")).select("source", "target", "k.*").collect()
    w, k = np.array([r.words for r in got]), np.array([r["class"] for r in got], float)
    mean = (w * k).sum() / w.sum()
    x = (k - mean) / np.sqrt((w * (k - mean) ** 2).sum() / w.sum())

    def rates(mu):
        out = np.zeros(len(got))
        for s in {r.source for r in got}:
            at = np.array([r.source == s for r in got])
            t, lo, hi = got[int(np.argmax(at))].target, -60.0, 60.0
            for _ in range(200):
                mid = (lo + hi) / 2
                lo, hi = (mid, hi) if (w[at] * np.minimum(3, np.exp(mid + mu * x[at]))).sum() < t else (lo, mid)
            out[at] = np.minimum(3, np.exp(hi + mu * x[at]))
        return out
    lo, hi = -5.0, 5.0
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if -mixing.PENALTY * w.sum() * mid - (w * rates(mid) * x).sum() > 0 else (lo, mid)
    want, flat = rates(lo), rates(0.0)
    assert np.allclose([r.rate for r in got], want, rtol=1e-6)
    assert abs((w * want * x).sum()) < 0.3 * abs((w * flat * x).sum()) and np.abs(want - flat).max() > 0.05


def test_mixing_tells_rows_apart_by_all_columns(spark):
    rows = [(1, "s", "same words here", i) for i in range(40)] + [(2, "t", "other " * 300, 0)]
    df = spark.createDataFrame(rows, "doc_id bigint, source string, text string, extra int")
    runs = [sorted(map(tuple, mixing.mix(df.repartition(n), out="m").select("extra", "m.copies", "source").collect())) for n in (1, 5)]
    assert runs[0] == runs[1]


def test_bpe(spark):
    enc = B.tokenizer(Q.VOCABULARY)
    got = bpe.encode(frame(spark), Q.VOCABULARY, "text", "ids", limit=20)
    got = got.select("text", "ids", bpe.unpack(F.col("ids")).alias("a"), bpe.decode(F.col("ids"), Q.VOCABULARY).alias("d")).collect()
    for r in got:
        ids = enc.encode_ordinary(r.text or "")
        assert list(r.a) == ids and bytes(r.d) == (r.text or "").encode()
    assert bpe.encode(frame(spark, []), Q.VOCABULARY).count() == 0


def test_bpe_folds_agree(spark):
    ranks = bpe.read_ranks(Q.VOCABULARY)
    words = [" the", "Donaudampfschifffahrt", "ünïcödé", "\U0001F600\U0001F600", "aaaaaaaaaaaaaaaaa", "   ", "x", "12345678901"]
    lit = common.LiteralMap(ranks, "int", "binary")
    df = spark.createDataFrame([(w,) for w in words], "w string")
    folded = df.select("w", common.let(lit.table, lambda t: common.let(F.col("w").cast("binary"), lambda raw: bpe.fold_word(lit, t, raw))).alias("ids"))
    for r in folded.collect():
        assert list(r.ids) == bpe.merge_word(r.w.encode(), ranks) == bpe._merge_long(r.w.encode(), ranks) or r.w.encode() in ranks
    long = ("ab" * 2000 + "aaab" * 500).encode()
    assert bpe.merge_word(long, ranks) == B.tokenizer(Q.VOCABULARY).encode_ordinary(long.decode())


def test_urls(spark):
    rows = [(1, "http://a.NET/x"), (2, "http://net/"), (3, "http://a.net"), (4, "https://www.example.net/en/1?x=/de/"), (5, "http://example.com/de/a"),
            (6, "http://badexample.com/de/a"), (7, "http://x.org/fr/"), (8, None), (9, "no url"), (10, "http://cheap-pills.org/en/"), (11, "http://casino.org/fr/1"),
            (11, "http://casino.org/fr/1"), (None, "http://u.com#://v.net/"), (12, "http://fakenet/x"), (13, "")]
    df = spark.createDataFrame(rows, "page_id bigint, url string").withColumn("host_", F.lit(1))
    got = [tuple(r) for r in urls.judge_urls(df, "url", Q.SITE_RULES + urls.WORD_RULES, "j").select("page_id", "j.host", "j.path", "j.rule", "j.verdict").collect()]
    want = [(1, "a.net", "/x", "net/", "block"), (2, "net", "/", "net/", "block"), (3, "a.net", "", None, "allow"),
            (4, "www.example.net", "/en/1", "example.net/en/", "allow"), (5, "example.com", "/de/a", "example.com/de/", "block"),
            (6, "badexample.com", "/de/a", None, "allow"), (7, "x.org", "/fr/", "org/fr/", "allow"), (8, "", "", None, "allow"), (9, "", "", None, "allow"),
            (10, "cheap-pills.org", "/en/", None, "block"), (11, "casino.org", "/fr/1", "org/fr/", "allow"), (11, "casino.org", "/fr/1", "org/fr/", "allow"),
            (None, "u.com", "", None, "allow"), (12, "fakenet", "/x", None, "allow"), (13, "", "", None, "allow")]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert urls.judge_urls(df.limit(0), "url", Q.SITE_RULES, "j").count() == 0


def test_licenses(spark):
    mit = licenses.TEMPLATES[4][1]
    rows = [(1, "intro line\nReleased under the MIT License!\nmore"), (2, mit.upper().replace(" ", "\n ", 9)), (3, None), (4, ""), (5, BODY),
            (6, "Licensed under the Apache Licence, Version 2.0"), (6, "licensed under CC BY-NC 4.0"), (7, "x\n" + mit[:len(mit) // 2])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("grams_", F.lit(0))
    got = [(r.doc_id, r.license and r.license.name, r.license and r.license.line) for r in licenses.scan_licenses(df).collect()]
    assert sorted(got, key=repr) == sorted([(1, "MIT", 1), (2, "MIT", -1), (3, None, None), (4, None, None), (5, None, None), (6, None, None),
                                            (6, "CC-BY-NC-4.0", 0), (7, None, None)], key=repr)


def test_licenses_pruning_loses_nothing(spark):
    def dice(a, b):
        return 2 * len(a & b) / (len(a) + len(b)) if a or b else 0.0
    texts = [" ".join(t.split()[k:]) + tail for _, t in licenses.TEMPLATES for k in (0, 1, 3) for tail in ("", " extra words", " the end of it all here")]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r.license and r.license.dice for r in licenses.scan_licenses(df).collect()}
    for i, t in enumerate(texts):
        best = max(dice(set(licenses.bigrams(t)), set(licenses.bigrams(x))) for _, x in licenses.TEMPLATES)
        assert got[i] == (pytest.approx(best) if best >= 0.8 else None)


def test_licenses_wrapped_or_inside_longer_text_are_found(spark):
    prose = " ".join(rng.choice(WORDS) for _ in range(60))
    wrap = lambda t: "\n * ".join(" ".join(t.split()[i:i + 9]) for i in range(0, len(t.split()), 9))
    named = dict(zip(("apache", "mit", "gpl"), (licenses.TEMPLATES[i][1] for i in (1, 4, 8)), strict=True))
    full = licenses.TEMPLATES[14][1]
    rows = [(1, f"{prose}. This project is licensed under the MIT License. {prose}"), (2, f"/*\n * {wrap(named['mit'])}\n */\n{prose}\n{prose}"),
            (3, f"{prose}\n{wrap(named['apache'])}\n{prose}"), (4, f"{prose}\n{wrap(named['gpl'])}\n{prose}\n{wrap(full)}\n{prose}"),
            (5, f"{prose} of this software under the license of the software {prose}"), (6, None), (7, ""), (8, "license"),
            (9, f"{prose} {named['mit']} {named['mit']} {prose}"), (10, f"{prose}\n{wrap(licenses.TEMPLATES[10][1])}\n{prose}")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("grams_", F.lit(0))
    got = {r.doc_id: r.licenses for r in licenses.find_licenses(df).collect()}
    names = {i: {m.name for m in x} for i, x in got.items()}
    assert names == {1: {"MIT"}, 2: {"MIT"}, 3: {"Apache-2.0"}, 4: {"GPL-3.0", "MIT"}, 5: set(), 6: set(), 7: set(), 8: set(), 9: {"MIT"},
                     10: {"CC-BY-4.0"}}
    assert got[1][0].line == 0 and got[2][0].line == 1 and got[3][0].line == 1 and {m.name: m.line for m in got[4]}["GPL-3.0"] == 1
    assert all(m.dice == pytest.approx(1.0) for i in (1, 2, 3) for m in got[i])
    old = {r.doc_id: r.license for r in licenses.scan_licenses(df).collect()}
    assert not any(old[i] for i in (1, 2, 4, 9))  # no line of these is a notice


def test_nearest(spark):
    g = np.random.default_rng(1)
    centre = g.standard_normal((20, 16))
    x = np.concatenate([centre[g.integers(20, size=900)] + 0.2 * g.standard_normal((900, 16)), np.tile(centre[0], (60, 1))])
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    extra = [(2000, None), (2001, [0.0] * 16), (2002, [float("nan")] * 16), (2003, [1.0, None] + [0.0] * 14), (2004, [1.0] * 3), (None, [1.0] * 16), (5, rows[5][1])]
    df = spark.createDataFrame(rows + extra, "vec_id bigint, embedding array<float>").withColumn("id", F.lit(1)).withColumn("v", F.lit(2))
    x = np.array([[np.float32(a) for a in v] for v in x], np.float64)
    got = {}
    for r in ann.nearest(df, df.where("vec_id % 20 = 0"), block_rows=200, query_rows=16).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    hit = 0
    for q in range(0, 960, 20):
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        d[q] = np.inf
        want = np.lexsort((np.arange(960), d))[:10]
        assert sorted(got[q]) == list(range(1, 11))
        hit += len(set(want) & {v for v, _ in got[q].values()})
        assert all(s == pytest.approx(d[v], rel=1e-12) for v, s in got[q].values())
    assert hit / 480 >= 0.95 and 2000 not in got and 2004 not in got
    small = spark.createDataFrame(rows[:3], "vec_id bigint, embedding array<float>")
    assert ann.nearest(small, small.limit(1)).count() == 2 and ann.nearest(small.limit(0), small.limit(0)).count() == 0


def test_collisions_decide_who_is_verified():
    """Directions without contrast, the hardest case: few vectors are compared, and a known bound needs one round."""
    x = np.random.default_rng(3).standard_normal((2000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    free, bound, hit, kept = ann.Block(np.arange(2000), x), ann.Block(np.arange(2000), x), 0, 0
    for q in range(0, 2000, 100):
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        d[q] = np.inf
        want = set(np.argsort(d)[:10].tolist())
        hit += len(want & set(free.search(x[q], q, 10)[0].tolist()))
        kept += len(want & set(bound.search(x[q], q, 10, float(np.sort(d)[9]))[0].tolist()))
    assert hit >= 180 and kept >= 180
    assert free.verified < 0.2 * 20 * 2000 and bound.verified < 0.2 * 20 * 2000
    rows = np.sort(np.random.default_rng(4).integers(0, 9, (5, 33)).astype(float), axis=1)
    for at in (-1.0, 0.0, 3.0, 3.5, 8.0, 9.0):
        for after in (False, True):
            assert ann._places(rows, np.full(5, at), after).tolist() == [int(np.searchsorted(r, at, "right" if after else "left")) for r in rows]


def test_repeated_spans(spark):
    sentence = lambda n: " ".join(rng.choice(WORDS) for _ in range(n)).capitalize() + "."
    passage = " ".join(sentence(12) for _ in range(5))
    rows = [(i, " ".join(sentence(9) for _ in range(8))) for i in range(20)]
    rows += [(30, f"{sentence(10)} {passage} {sentence(11)}"), (31, f"{passage} {sentence(11)}"), (32, sentence(8) + "\n" + passage), (33, passage + " " + passage),
             (40, None), (41, ""), (None, passage), (31, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("found_", F.lit(1)).withColumn("dup", F.lit(1))
    df = df.withColumns({n: F.lit(1) for n in ("dup_rid", "dup_", "dup_row_", "rid", "h", "no", "first")})
    out = spans.repeated_spans(df).withColumn("left", spans.cut(F.col("text"), F.col("repeats.spans")))
    got = {(r.doc_id, r.text): r for r in out.collect()}
    assert len(got) == len(rows)
    for (i, t), r in got.items():
        if i is not None and (i < 31 or i > 33) or t is None:
            assert r.repeats.removed == 0 and r.left == t
        else:
            assert passage not in r.left and passage.split(". ")[2] not in r.left
    assert spans.repeated_spans(df.limit(0)).count() == 0


def test_passages_inside_sentences_short_runs_and_other_scripts_are_found(spark):
    some = lambda n: " ".join(f"w{rng.getrandbits(40):x}" for _ in range(n))
    inner, short = some(60), f"{some(6)}. {some(7)}."
    han = "".join(chr(rng.randrange(0x4E00, 0x9FA5)) for _ in range(24)) + "。" + "".join(chr(rng.randrange(0x4E00, 0x9FA5)) for _ in range(30)) + "。"
    thai = " ".join("".join(chr(rng.randrange(0x0E01, 0x0E2F)) for _ in range(20)) for _ in range(4))
    rows = [(1, f"{some(8)} {inner} {some(9)}."), (2, f"{some(5)} {inner} {some(4)}."), (3, f"{some(9)}. {short} {some(9)}."), (4, f"{some(3)}. {short} {some(20)}."),
            (5, some(70) + "。" + han), (6, han + some(70)), (7, thai + " " + some(20)), (8, "ก " + thai + " " + some(9))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r for r in spans.repeated_spans(df).withColumn("left", spans.cut(F.col("text"), F.col("repeats.spans"))).collect()}
    assert all(got[i].left == got[i].text for i in (1, 3, 5, 7))
    assert got[4].repeats.removed == 2 and short not in got[4].left
    assert got[6].repeats.removed == 2 and han[:24] not in got[6].left
    assert thai[21:41] not in got[8].left
    words = inner.split()
    assert sum(w in got[2].left for w in words) <= 2 * (spans.CHOSEN - 1) and words[30] not in got[2].left
    assert spans.word_windows("x " * 30000)[1][1] - spans.word_windows("x " * 30000)[0][1] >= 2 * (spans.CHOSEN - 1)


def test_sentence_runs_cover_the_text():
    for t in [*EDGE, "A b. C d! E\nf? g", "...", "3.14 is. pi"]:
        lens, runs = spans.sentence_runs(t, 2, 3, 10)
        assert sum(lens) == len(t or "") and all(i <= j < len(lens) for _, i, j in runs)


def test_language(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.train(docs)
    out = langid.predict(docs, model).where(langid.held_out(F.col("doc_id"))).select("lang", "language.*")
    rows = out.toPandas()
    assert (rows.iloc[:, 0] == rows.iloc[:, 1]).mean() > 0.95 and rows["score"].between(0, 1).all()
    odd = spark.createDataFrame([(None,), ("",), ("12 %% !!",), ("the " * 50000,)], "text string")
    got = [tuple(r) for r in langid.predict(odd, model).select("language.*").collect()]
    assert got[:3] == [("und", 0.0)] * 3 and got[3][0] in model["langs"]
    assert langid.train(docs.limit(0))["langs"] == []


def test_forward_backward_is_exact():
    g = np.random.default_rng(3)
    emit, step, size = g.standard_normal((4, 2, 3)), g.standard_normal((3, 3)), np.array([4, 2])
    pairs = np.zeros((3, 3))
    got, want_pairs = langid.forward_backward(emit, step, size, pairs), np.zeros((3, 3))
    for b, n in enumerate(size):
        total, want, each = 0.0, np.zeros((n, 3)), np.zeros((3, 3))
        for path in np.ndindex(*[3] * n):
            p = np.exp(sum(emit[t, b, y] for t, y in enumerate(path)) + sum(step[a, c] for a, c in zip(path, path[1:], strict=False)))
            total += p
            for t, y in enumerate(path):
                want[t, y] += p
            for a, c in zip(path, path[1:], strict=False):
                each[a, c] += p
        assert np.allclose(got[:n, b], want / total)
        want_pairs += each / total
    assert np.allclose(pairs, want_pairs)


def test_code_switched_words_get_their_own_labels():
    samples = [("aa", ["kara", "lone", "mipi"] * 30), ("bb", ["zuzu", "xoxo", "qaqa"] * 30)] * 5
    model = langid.fit(samples)
    words = ["kara", "mipi", "lone", "kara", "zuzu", "qaqa", "xoxo", "zuzu"]
    scores = langid.WordScores()
    scores.add(set(words), model["emit"])
    (p,) = langid.label_words([[scores[w] for w in words]], scores.table, model["step"])
    assert [model["langs"][k] for k in p.argmax(axis=1)] == ["aa"] * 4 + ["bb"] * 4


def test_pipeline_stages(spark):
    import corpus_pipeline as P
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("quality", F.lit(1))
    text, frames = {r.doc_id: r for r in docs.collect()}, docs
    seen = []
    for name, stage in P.STAGES:
        frames = common.stored(stage(spark, frames, SF), f"test-{name}")
        assert name == "bpe" or frames.columns == docs.columns
        seen.append({r.doc_id for r in frames.collect()})
    assert seen[0] == {i for i, r in text.items() if not B.quality(r.text)[5]}
    comps = {c for _, _, c in B.simhash([(i, text[i].text) for i in sorted(seen[0])])}
    assert seen[1] == comps == seen[2] and seen[3] <= seen[2] and seen[4] == seen[3]
    assert frames.where("not round_trip").count() == 0
    for _, stage in P.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0


def test_every_run_of_sentences_is_hashed(spark):
    some = lambda n: " ".join(f"w{rng.getrandbits(40):x}" for _ in range(n)) + "."
    short, mixed = [some(3) + " " + some(5) for _ in range(20)], [some(60) + " " + some(5) for _ in range(20)]
    rows = [(i, f"{some(9)} {p} {some(9)}") for i, p in enumerate([*short, *mixed] * 2)] + [(None, short[0]), (None, some(7))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = spans.repeated_spans(df).withColumn("left", spans.cut(F.col("text"), F.col("repeats.spans"))).collect()
    for r in got:
        if r.doc_id is not None and r.doc_id < 40:
            assert r.left == r.text
        elif r.doc_id is not None:
            assert r.repeats.removed == 2 and not any(p.split(". ")[1] in r.left for p in (*short, *mixed))
    assert sorted(len(r.left) > 0 for r in got if r.doc_id is None) == [False, True]


def test_near_copies_lose_no_document(spark):
    body = lambda: " ".join(rng.choice(WORDS) for _ in range(60))
    a, b, z = body(), body(), body()
    rows = [(5, a), (5, b), (7, body()), (8, a), (None, b), (None, z), (None, z + " tail"), (None, z), (7, "other words altogether")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({n: F.lit("x") for n in ("row_hash", "keep_id", "keep_row", "row_mark", "comp", "fp")})
    got = simhash.drop_near_copies(df)
    assert got.columns == df.columns
    kept = [(r.doc_id, r.text) for r in got.collect()]
    comps = {r.comp for r in simhash.simhash_components(df).collect()}
    assert len(kept) == len(comps) and {(5, a), (5, b)} <= set(kept) and (8, a) not in kept and (None, b) not in kept


def test_urls_with_rules_without_tokens(spark):
    df = spark.createDataFrame([("http://a.пример.рф/x",), ("http://b.org/",)], "url string")
    rule = urls.site_rule("block", "пример.рф/")
    got = urls.judge_urls(df, "url", [rule, *urls.WORD_RULES], "j").select("j.rule", "j.verdict").collect()
    assert [tuple(r) for r in got] == [(rule.name, "block"), (None, "allow")]


def test_names_of_pii_helpers_may_be_columns(spark):
    df = spark.createDataFrame([(1, "a@b.org")], "doc_id bigint, text string").withColumns({n: F.lit(1) for n in ("rid_", "add_", "s", "e")})
    assert [len(r.pii.spans) for r in pii.find_pii(df).collect()] == [1]


def test_rare_languages_are_learned_and_numbers_are_no_letters(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    rare = [(10**6 + i, " ".join(rng.choice(["qzik", "wqaz", "zzyq", "qwqx"]) for _ in range(80)), "zz") for i in range(8)]
    model = langid.train(docs.unionByName(spark.createDataFrame(rare, docs.schema)))
    assert "zz" in model["langs"]
    odd = spark.createDataFrame([("½ ² ① Ⅷ",), ("qzik wqaz zzyq qwqx " * 9,)], "text string")
    got = [r.language.lang for r in langid.predict(odd, model).collect()]
    assert got == ["und", "zz"]


def test_pii_long_texts_take_time_in_proportion(spark):
    n = 3000  # more than one chunk of a fold, more than one block of a cut
    text = " ".join(f"mail ü{i} u{i}@ex.org no {10000 + i}" for i in range(n))
    r = pii.find_pii(spark.createDataFrame([(text,)], "text string"), "text", "p").select(
        pii.span_text(F.col("p.base")).alias("b"), pii.redact(F.col("text"), F.col("p.spans")).alias("t"), F.size("p.spans").alias("n")).first()
    assert r.b == ",".join(f"{k}:{a}:{e}" for k, a, e in B.pii(text))
    assert r.t == " ".join(f"mail ü{i} <EMAIL> no {10000 + i}" for i in range(n)) and r.n == n


def test_pii_candidates_apart_from_base_spans(spark):
    spans = [(2 * i * 7 % 101, 2 * i * 7 % 101 + 1 + i % 9) for i in range(40)]
    others = [(i * 13 % 97, i * 13 % 97 + 1 + i % 4) for i in range(12)]
    df = spark.createDataFrame([(spans, others), (spans, []), ([], others), ([], [])], "a array<struct<s:int,e:int>>, b array<struct<s:int,e:int>>")
    full = lambda n: F.transform(n, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), F.lit("m").alias("m"), F.lit("b").alias("b")))
    got = df.select(pii._apart(full("a"), full("b")).alias("x"), "a", "b").collect()
    for r in got:
        assert sorted((x.s, x.e) for x in r.x) == sorted((x.s, x.e) for x in r.a if not any(y.s < x.e and x.s < y.e for y in r.b))


def test_pii_redaction_of_overlapping_spans(spark):
    text = "x" * 1500 + "é" * 1500 + "y"
    spans = [(0, 1020, 1030), (1, 1025, 2100), (2, 2100, 2101), (3, 2990, 3001)]
    df = spark.createDataFrame([(text, spans), (text, []), ("", [])], "text string, s array<struct<k:int,s:int,e:int>>")
    got = [r[0] for r in df.select(pii.redact(F.col("text"), F.col("s"))).collect()]
    assert got == [text[:1020] + "<EMAIL><CARD>" + text[2101:2990] + "<PHONE>", text, ""]


def test_training_sample_is_the_first_by_hash(spark):
    """Against plain sorting: shares of the labels, one row an id and label however often it is repeated, and its smallest text."""
    import xxhash
    signed = lambda x: x - 2**64 if x >= 2**63 else x
    key = lambda i: signed(xxhash.xxh64_intdigest(str(i).encode(), 42))
    rows = [(i, f"wort nummer{'abcdefghij'[i % 10]}", "de") for i in range(900)] + [(i, "two words", "en") for i in range(900, 912)]
    rows += [(5, "eins zwei", "de")] * 600 + [(5, "aa", "de"), (None, "x", "de"), (7, None, "de"), (8, "x", None)]
    df = spark.createDataFrame(rows, "doc_id int, text string, lang string")
    got = [(r.lang, " ".join(r.w)) for r in langid.training_sample(df, "doc_id", "text", "lang", 100).collect()]
    free = {(i, lang): None for i, t, lang in rows if i is not None and t and lang and zlib.crc32(str(i).encode()) % 4 != 2}
    few = [x for x in free if x[1] == "en"]
    many = sorted((x for x in free if x[1] == "de"), key=lambda x: key(x[0]))[:100 - len(few)]
    text = lambda x: min(t for i, t, lang in rows if (i, lang) == x and t)
    assert sorted(got) == sorted((x[1], text(x)) for x in few + many)


def test_training_words_come_from_all_over_a_text(spark):
    long = " ".join(f"{'abcdefghij'[i // 1000]}{'klmnopqrst'[i // 100 % 10]}" for i in range(10000))
    rows = [(i, long if i < 8 else "kurz und gut", "xx" if i < 8 else "de") for i in range(40)]
    got = [r.w for r in langid.training_sample(spark.createDataFrame(rows, "doc_id int, text string, lang string"), "doc_id", "text", "lang").collect()]
    every = [w for w in got if len(w) == langid.TRAIN_WORDS]
    assert every and all({x[0] for x in w} == set("abcdefghij") and w[0] == "ak" and w[-1] == "jt" for w in every)
    assert all(w == ["kurz", "und", "gut"] for w in got if len(w) != langid.TRAIN_WORDS)


def test_all_trigrams_of_long_words_count():
    rng = np.random.default_rng(0)
    emit = rng.normal(size=(langid.SPACE, 3))
    found = ["a", "straße", "x" * 30, "".join(rng.choice(list("abcdef"), 150_000))]
    plain = [sum(emit[i] for piece in langid.word_features(w) for i in piece) for w in found]
    assert np.allclose(langid.word_scores(found, emit), plain)
    assert [sum(len(p) for p in langid.word_features(w)) for w in found] == [7 + len(w) for w in found]
