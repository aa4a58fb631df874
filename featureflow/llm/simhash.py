"""SimHash near-duplicates with pivot distance tables.

Fingerprints: 64 bits, a bit is 1 if it is set in over half of the text's shingle hashes.
Links: two fingerprints link at ``max_bits`` or fewer differing bits.

The pivot table holds, for each distinct fingerprint, its Hamming distances to fixed reference
fingerprints. The triangle inequality bounds a pair from below by its largest coordinate
difference: pairs over the bound are discarded, survivors are verified by bit_count. One
coordinate over all 64 bits passes 57 % of random pairs at 4 bits, so coordinates alone can't
choose who meets whom without comparing all pairs; pairs therefore meet through references that
see one band of bits each (distances 0 in enough bands, a pigeonhole bound, so no link is lost).
"""

from __future__ import annotations

import sys
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from featureflow.llm.common import c, fresh, stored
from featureflow.llm.components import connected_components

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # tasks need not have this package installed

N_PIVOTS = 18  # nine 7-bit distances in each of two longs
CHUNK = 1 << 16  # shingle hashes counted at once: bounds memory for very long texts


def fingerprint_of(text: str | None, shingle: int = 4) -> int:
    """Signed 64-bit SimHash of one text: A-Z lower-cased, words, ``shingle``-word shingles with
    repeats, XXH64 seed 42. Fewer words: the whole sequence; none or null: zero."""
    found = (text or "").encode("utf-8").lower().split()
    if not found:
        return 0
    flat = b" ".join(found)
    size = np.fromiter(map(len, found), np.int64, len(found))
    ends = np.cumsum(size + 1) - 1
    starts = ends - size
    k = min(shingle, len(found))
    starts, ends = starts[: len(found) - k + 1].tolist(), ends[k - 1:].tolist()
    hashed, n = xxhash.xxh64_intdigest, len(starts)
    total = np.zeros(64, np.int64)
    for at in range(0, n, CHUNK):
        part = np.array([hashed(flat[a:b], 42) for a, b in zip(starts[at:at + CHUNK], ends[at:at + CHUNK], strict=True)],
                        dtype="<u8")
        total += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(total * 2 > n, bitorder="little").view("<i8")[0])


def fingerprint(text: Column, shingle: int = 4) -> Column:
    """SimHash of a text column as a signed long (Arrow batches, numpy inside the task)."""
    @F.pandas_udf("long")
    def simhash64(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint_of(t, shingle) for t in texts], dtype="int64")
    return simhash64(text)


def _mix(i: int) -> int:
    """Fixed pseudo-random 64-bit reference fingerprints (splitmix64), as signed longs."""
    z = (i * 0x9E3779B97F4A7C15) & (2**64 - 1)
    z = ((z ^ (z >> 30)) * 0xBF58476D1CE4E5B9) & (2**64 - 1)
    z = ((z ^ (z >> 27)) * 0x94D049BB133111EB) & (2**64 - 1)
    z ^= z >> 31
    return z - 2**64 if z >= 2**63 else z


def pivot_distances(fp: Column) -> list[Column]:
    """The row of the pivot table for a fingerprint: its distances to the references, 7 bits each."""
    out = []
    for half in range(N_PIVOTS // 9):
        packed = F.lit(0).cast("long")
        for j in range(9):
            d = F.bit_count(fp.bitwiseXOR(F.lit(_mix(half * 9 + j + 1)))).cast("long")
            packed = packed.bitwiseOR(F.shiftleft(d, 7 * j))
        out.append(packed.alias(f"pv{half}"))
    return out


def _within(a: str, b: str, bits: int) -> Column:
    """Largest coordinate difference within ``bits``, then the verified distance."""
    ok = F.lit(True)
    for half in range(N_PIVOTS // 9):
        for j in range(9):
            x = F.shiftrightunsigned(F.col(f"{a}.pv{half}"), 7 * j).bitwiseAND(F.lit(127))
            y = F.shiftrightunsigned(F.col(f"{b}.pv{half}"), 7 * j).bitwiseAND(F.lit(127))
            ok = ok & (F.abs(x - y) <= bits)
    return ok & (F.bit_count(F.col(f"{a}.fp").bitwiseXOR(F.col(f"{b}.fp"))) <= bits)


def band_keys(fp: Column, max_bits: int, shared_bands: int) -> Column:
    """Keys on which fingerprints meet. The bits are cut into max_bits + shared_bands bands; two
    fingerprints at max_bits or fewer differing bits agree on shared_bands bands at least, so they
    share one of the keys, each of which joins the bits of that many bands."""
    n = max_bits + shared_bands
    edges = [round(64 * i / n) for i in range(n + 1)]
    keys = []
    for no, chosen in enumerate(combinations(range(n), shared_bands)):
        mask = sum(((1 << (edges[i + 1] - edges[i])) - 1) << edges[i] for i in chosen)
        mask = mask - 2**64 if mask >= 2**63 else mask
        keys.append(F.xxhash64(F.lit(no), fp.bitwiseAND(F.lit(mask))))  # a hash clash only adds a pair to verify
    return F.array(*keys)


def _commonest(counts: DataFrame) -> DataFrame:
    """(key, major) of the keys with several components (key, comp, n). Equal counts go to the larger name, whatever the
    order of the rows: both sides of the self-join, and tasks run again, must see the same component."""
    return (counts.groupBy("key").agg(F.max_by("comp", F.struct("n", "comp")).alias("major"), F.count(F.lit(1)).alias("comps"))
            .where("comps > 1").drop("comps"))


def _linked(fps: DataFrame, max_bits: int, shared_bands: int) -> DataFrame:
    """(node fp, component fp) for the distinct fingerprints of ``fps`` (fp, pv*) that link to others.

    1. Stars: in each band bucket, the members near the bucket's smallest or largest fingerprint
       (or the one smallest by a hash) link to it, which costs one comparison a member.
    2. Components of the stars. A large group of near copies mostly falls into one component here.
    3. The rest, exactly: in buckets that still hold several components, every member outside the
       bucket's commonest component meets the members of other components; nothing is skipped
       but pairs already known to be connected.
    4. Components again over the contracted links."""
    pv = [f"pv{h}" for h in range(N_PIVOTS // 9)]
    keyed = fps.select("fp", F.explode(band_keys(F.col("fp"), max_bits, shared_bands)).alias("key"))
    heads = keyed.groupBy("key").agg(F.min("fp").alias("a"), F.max("fp").alias("b"),
                                     F.min_by("fp", F.xxhash64("fp")).alias("h")).where("a <> b")
    stars = keyed.join(heads, "key").select("fp", F.explode(F.array_distinct(F.array("a", "b", "h"))).alias("head"))
    stars = stars.where("fp <> head").where(F.bit_count(F.col("fp").bitwiseXOR(F.col("head"))) <= max_bits)
    first = stored(connected_components(stars, "fp", "head", "simhash-stars"), "simhash-first")
    named = stored(fps.join(first, fps.fp == first.node, "left").select(
        "fp", *pv, F.coalesce("component", "fp").alias("comp")), "simhash-named")
    spread = named.select("*", F.explode(band_keys(F.col("fp"), max_bits, shared_bands)).alias("key"))
    mixed = _commonest(spread.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("n")))
    open_rows = spread.join(mixed, "key")
    rest = open_rows.where("comp <> major")
    on = ((F.col("x.key") == F.col("y.key")) & (F.col("x.comp") != F.col("y.comp"))
          & ((F.col("y.comp") == F.col("y.major")) | (F.col("x.fp") < F.col("y.fp"))) & _within("x", "y", max_bits))
    links = rest.alias("x").join(open_rows.alias("y"), on).select(F.col("x.comp").alias("p"), F.col("y.comp").alias("q"))
    second = connected_components(links, "p", "q", "simhash-links").select(
        F.col("node").alias("comp"), F.col("component").alias("last"))
    return named.join(second, "comp", "left").select("fp", F.coalesce("last", "comp").alias("comp"))


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                       max_bits: int = 4, shared_bands: int = 2) -> DataFrame:
    """One row per row of ``docs``: id, ``fp`` (signed long), ``row_hash``, ``component_id``, the smallest
    id among all rows whose fingerprints can be reached over links, and ``comp``, a fingerprint that names them.

    Exact copies collapse to one distinct fingerprint before any pair is looked at. Raise
    ``shared_bands`` (2: 15 keys of about 21 bits; 4: 70 keys of 32 bits) for corpora of billions
    of rows: fewer chance meetings for more keys, the same result.
    Null and blank texts have fingerprint zero and link like any other; null ids keep their row and
    never name a component unless all its ids are null; repeated rows keep one result row each; an
    empty table gives an empty result. Extra columns of any name are ignored.
    """
    rest = [c(n) for n in docs.columns]
    rows = docs.select(c(id_col).alias("id"), fingerprint(c(text_col), shingle).alias("fp"),
                       F.xxhash64(*rest).alias("row_hash"))
    rows = stored(rows, "simhash-rows")
    heads = rows.groupBy("fp").agg(F.min("id").alias("low"))
    fps = stored(heads.select("fp", "low", *pivot_distances(F.col("fp"))), "simhash-pivots")
    comp = stored(_linked(fps.drop("low"), max_bits, shared_bands), "simhash-comp")
    low = fps.select("fp", "low").join(comp, "fp")
    least = low.groupBy("comp").agg(F.min("low").alias("component_id"))
    names = low.select("fp", "comp").join(least, "comp").select("fp", "comp", "component_id")
    return rows.join(names, "fp").select(F.col("id").alias(id_col), "fp", "row_hash", "component_id", "comp")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """The rows of ``docs`` without near copies: of each component the row with the smallest id stays
    (of repeated rows with that id, the one with the smallest content hash, once). A component without
    any id keeps the row with the smallest content hash."""
    found = simhash_components(docs, id_col, text_col, **params)
    keep_id, keep_row, mark = fresh(docs, "keep_id", "keep_row", "row_mark")
    one = F.min(F.struct(c(id_col).isNull().alias("n"), c(id_col).alias("id"), F.col("row_hash").alias("row")))
    keep = found.groupBy("comp").agg(one.alias("one")).select(F.col("one.id").alias(keep_id), F.col("one.row").alias(keep_row))
    marked = docs.withColumn(mark, F.xxhash64(*[c(n) for n in docs.columns]))
    kept = marked.join(keep, (c(mark) == c(keep_row)) & c(id_col).eqNullSafe(c(keep_id)), "left_semi")  # dealt out by content alone
    return kept.dropDuplicates([id_col, mark]).drop(mark)
