"""Corpus pipeline: quality rules, near copies, personal data, mixing, tokenizing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
``documents``. ``run`` writes each stage's rows as Parquet in the shared folder (spark.checkpoint.dir) and
the next stage reads them back, so a lost executor costs at most one stage's tasks.

Nulls, empty and very long texts, ties, repeated rows, empty tables and extra columns have the results that
the operators' docstrings define; extra columns pass through every stage but the last.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from featureflow.llm import bpe, mixing, pii, quality, simhash
from featureflow.llm.common import c, fresh, stored

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a base rule or their host's verdict rejects go."""
    (q,) = fresh(docs, "quality")
    judged = quality.judge_documents(docs, "source", "text", q)
    return judged.where(c(q)["kept"]).select(*[c(n) for n in docs.columns])


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: the one with the smallest doc_id."""
    return simhash.drop_near_copies(docs, "doc_id", "text", shingle=4, max_bits=4).select(*[c(n) for n in docs.columns])


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the text is replaced by its kind (<EMAIL>, <IP>, <CARD>, <PHONE>); n_chars follows."""
    (p,) = fresh(docs, "pii")
    found = pii.find_pii(docs, "text", p)
    clean = pii.redact(c("text"), c(p)["spans"])
    cols = [clean.alias(n) if n == "text" else c(n) for n in docs.columns]
    out = found.select(*cols)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix takes it (none to three)."""
    (m,) = fresh(docs, "mix")
    mixed = mixing.mix(docs, "doc_id", "source", "text", out=m).where(c(m)["copies"] > 0)
    (k,) = fresh(mixed, "copy")
    return mixed.withColumn(k, F.explode(F.sequence(F.lit(1), c(m)["copies"].cast("int")))).select(*[c(n) for n in docs.columns])


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document (packed), and whether decoding them gives the text back."""
    base = docs.select("doc_id", "source", "text")
    coded = bpe.encode(base, VOCABULARY, "text", "ids")
    whole = bpe.decode(F.col("ids"), VOCABULARY) == F.coalesce("text", F.lit("")).cast("binary")
    return coded.select("doc_id", "source", "ids", bpe.n_tokens(F.col("ids")).alias("n_tokens"), whole.alias("round_trip"))


STAGES = [("quality", quality_rules), ("simhash", near_copies), ("pii", personal_data), ("mixing", mixture), ("bpe", tokens)]

# SQL has no XXH64 of 4-word shingles, iterated pattern scores or byte-pair merges: the stages are held against
# brute-force versions in tests/llm instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
