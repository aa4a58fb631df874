"""Registered queries of the corpus operators: opN_<name> over whole tables, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from featureflow.llm import ann, bpe, conversations, decontaminate, langid, licenses, mixing, phrases, pii, quality, simhash, spans, urls
from featureflow.plans.registry import query

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_simhash")
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = simhash.simhash_components(docs, "doc_id", "text", shingle=4, max_bits=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op5_bpe")
def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe_digests(bpe.encode(docs, VOCABULARY, "text", "ids"))


def bpe_digests(coded: DataFrame) -> DataFrame:
    return coded.select("doc_id", bpe.n_tokens(F.col("ids")).alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(bpe.decode(F.col("ids"), VOCABULARY), 256).alias("decoded_sha256"))


OP6_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, doc_id, source, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ln FROM d),
g AS (SELECT rid, p, w[p] || ' ' || w[p + 1] || ' ' || w[p + 2] AS g FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS p FROM w WHERE len(w) >= 3)),
r AS (SELECT rid, count(DISTINCT pos) AS n FROM (
        SELECT rid, unnest([p, p + 1, p + 2]) AS pos FROM (SELECT rid, p, count(*) OVER (PARTITION BY rid, g) AS n FROM g) WHERE n > 1) GROUP BY rid),
s AS (SELECT w.rid, doc_id, source, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
             (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, len(ln) AS n_lines,
             (len(ln) - len(list_distinct(ln)))::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words
      FROM w LEFT JOIN r ON w.rid = r.rid),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
             10 * n_symbols > 3 * n_words OR 4 * n_dup_lines > n_lines AS other_failed FROM s),
h AS (SELECT source, count(*)::DOUBLE AS n, count(*) FILTER (base_failed OR other_failed)::DOUBLE AS f FROM b GROUP BY source),
m AS (SELECT sum(f) / sum(n) AS m, sum(f * f / n) / sum(n) AS sq, count(*) / sum(n) AS share FROM h),
v AS (SELECT m, m * (1 - m) AS spread, sq - m * m - m * (1 - m) * share AS between_hosts FROM m),
a AS (SELECT m, CASE WHEN between_hosts > 0 THEN least(greatest(spread / between_hosts - 1, 1.0), 1e6) ELSE 1e6 END AS k FROM v),
j AS (SELECT h.source, (h.f + a.m * a.k) / (h.n + a.k) <= 0.5 AS host_kept FROM h, a)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND host_kept AS kept
FROM b JOIN j ON b.source IS NOT DISTINCT FROM j.source
"""


@query("op6_host_quality", OP6_SQL)
def op6_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    q = quality.judge_documents(docs, "source", "text", "q", keep_text=False)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return q.select("doc_id", *[F.col(f"q.{n}").alias(n) for n in names])


@query("op9_pii")
def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find_pii(docs, "text", "p", keep_text=False)
    kinds = F.transform("p.base", lambda x: x["k"])
    count = [(F.size(kinds) - F.size(F.array_remove(kinds, i))).cast("long").alias(f"n_{k}") for i, k in enumerate(pii.KINDS)]
    return found.select("doc_id", *count, F.sha2(pii.span_text(F.col("p.base")), 256).alias("base_sha256"),
                        pii.span_text(F.col("p.spans")).alias("spans"))


@query("op10_mixing")
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    m = mixing.mix(docs, out="m", keep_text=False)
    return m.select("doc_id", "m.size", "m.source_size", "m.target", "m.taken", "m.copies", "m.rate")


@query("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


SITE_RULES = [urls.site_rule(v, r) for v, r in (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))]

OP2_SQL = r"""
WITH u AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), h AS (
  SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM u
), r AS (
  SELECT page_id, host, path,
    CASE WHEN ('.' || host) LIKE '%.example.net' AND starts_with(path, '/en/') THEN 'example.net/en/'
         WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/de/') THEN 'example.com/de/'
         WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/fr/') THEN 'org/fr/'
         WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/') THEN 'net/' END AS rule,
    regexp_matches(lower(host || path), '(^|[^a-z0-9])(casino|poker|cheap[-_+]pills|online[-_+]pharmacy|viagra|adult[-_+]x|xxx|porn|spam[-_+]farm|link[-_+]farm|free[-_+]followers|payday[-_+]loans)([^a-z0-9]|$)') AS word
  FROM h
)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow' WHEN word THEN 'block' ELSE 'allow' END AS verdict
FROM r
"""


@query("op2_url_filter", OP2_SQL)
def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    j = urls.judge_urls(pages, "url", SITE_RULES + urls.WORD_RULES, "j")
    return j.select("page_id", "j.host", "j.path", "j.rule", "j.verdict")


@query("op3_license_scan")
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = licenses.find_licenses(docs, "text", "l", threshold=0.8).withColumn("m", F.get("l", F.lit(0)))
    return found.select("doc_id", F.col("m.name").alias("license"), F.col("m.dice").alias("dice"), F.col("m.line").alias("line"),
                        F.array_join("l.name", ",").alias("licenses"))


@query("op4_collision_ann")
def op4_collision_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    found = ann.nearest(rows, rows.where("vec_id % 100 = 0"), "vec_id", "embedding", 10)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


@query("op7_sentence_spans")
def op7_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = spans.repeated_spans(docs, "doc_id", "text", "r", keep_text=False)
    text = F.array_join(F.transform("r.spans", lambda x: F.concat_ws(":", x["s"].cast("string"), x["e"].cast("string"))), ",")
    return found.select("doc_id", F.col("r.sentences").cast("long").alias("sentences"), F.col("r.removed").cast("long").alias("removed"),
                        text.alias("spans"))


@query("op8_language_crf")
def op8_language_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = langid.predict(docs.select("doc_id", "text"), langid.train(docs), "text", "p")
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), F.col("p.lang").alias("lang_pred"), "p.score")


@query("op11_conversation_repair")
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return repair_report(rows)


def repair_report(rows: DataFrame) -> DataFrame:
    found, _ = conversations.repair(conversations.damage(rows), "conv")
    ids = rows.select(F.col("conv_id").alias("id")).distinct()
    every = ids.join(found, F.col("id").eqNullSafe(F.col("conv")), "left")
    zero = {"audit": F.lit(""), "sha256": F.sha2(F.lit(""), 256)}
    cols = [F.coalesce(n, zero.get(n, F.lit(0).cast("long"))).alias(n) for n in (*conversations.NAMES, "sha256")]
    return every.select(F.col("id").alias("conv_id"), *cols).withColumnRenamed("sha256", "repaired_sha256")


OP13_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id,
             list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                         '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
b AS (SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                         '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[p:p + least(len(w), 10) - 1], ' ') AS g
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT k FROM win),
seen AS (SELECT rid, p, k, array_to_string(w[p:p + k - 1], ' ') AS g FROM (SELECT rid, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM d, sizes WHERE len(w) >= k)),
hit AS (SELECT rid, p, seen.k, item_id FROM seen JOIN win ON seen.k = win.k AND seen.g = win.g),
n AS (SELECT rid, count(DISTINCT pos) AS n_hit FROM (SELECT rid, unnest(range(p, p + k)) AS pos FROM hit) GROUP BY rid),
i AS (SELECT rid, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM hit GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (rid) LEFT JOIN i USING (rid)
"""


@query("op13_decontaminate", OP13_SQL)
def op13_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return contamination_report(docs, _table(spark, sf_dir, "benchmark"))


def contamination_report(docs: DataFrame, items: DataFrame) -> DataFrame:
    f = decontaminate.find_contamination(docs, items, out="f", keep_text=False)
    return f.select("doc_id", "f.n_words", "f.n_hit", F.size("f.items").cast("long").alias("n_items"),
                    F.sha2(F.array_join("f.items", ","), 256).alias("items_sha256"), (F.col("f.n_hit") > 0).alias("contaminated"))


OP12_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
f AS (
  SELECT lang, k, phrase, count(*) AS f FROM (
    SELECT lang, k, array_to_string(w[p:p + k - 1], ' ') AS phrase
    FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM w, range(1, 5) AS s(k) WHERE len(w) >= k)) GROUP BY ALL
), n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
g AS MATERIALIZED (SELECT * FROM f WHERE f >= 30),
c AS (SELECT lang, k AS size, phrase, f AS a, string_split(phrase, ' ') AS w FROM g WHERE k > 1),
parts AS (SELECT lang, phrase, a, i, array_to_string(w[1:i], ' ') AS p1, array_to_string(w[i + 1:], ' ') AS p2
          FROM (SELECT *, unnest(range(1, size)) AS i FROM c)),
cut AS (
  SELECT x.lang, x.phrase, a, i, y.f AS l, z.f AS r, ((2000000::HUGEINT * a) // (y.f + z.f))::BIGINT AS score
  FROM parts AS x JOIN g AS y ON y.lang = x.lang AND y.phrase = p1 JOIN g AS z ON z.lang = x.lang AND z.phrase = p2
), low AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, i) = 1),
gone AS (SELECT DISTINCT s.lang, s.phrase FROM c AS s JOIN c AS b ON s.lang = b.lang AND b.size > s.size
         AND contains(' ' || b.phrase || ' ', ' ' || s.phrase || ' ') AND 100::HUGEINT * b.a >= 80::HUGEINT * s.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM low JOIN n USING (lang) WHERE NOT EXISTS (SELECT 1 FROM gone WHERE gone.lang = low.lang AND gone.phrase = low.phrase)
QUALIFY rank <= 2000
"""


@query("op12_phrases", OP12_SQL)
def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("lang", "text")
    return phrases.collocations(docs, "lang", "text").withColumnRenamed("grp", "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
