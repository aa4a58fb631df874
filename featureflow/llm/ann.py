"""Approximate nearest neighbours by collision counting with query-centred windows.

Every vector is projected on M fixed random directions; a block of vectors keeps one sorted array a direction. A
query opens a window of half-width Z * R round its own projection in each array; virtual rehashing widens the
windows by growing R, and only newly covered entries are counted. A vector whose collisions reach the threshold is
verified by its exact distance. A projected difference is normal with the distance as its deviation, so a vector at
distance R collides in P(|N| < Z) of the directions, and the threshold lies MARGIN standard deviations below that.

A query is first searched in its home block, where R grows from the nearest of a few probed vectors until the k-th
verified distance is at most R. That distance bounds the k-th of the whole table, so every other block is searched
once at that R. Both the first R and the bound come from the data.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window as W, functions as F

from featureflow.llm.common import c, stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # tasks need not have this package installed

DIRECTIONS = 256
Z = 1.0        # half-width of a window at R = 1
MARGIN = 1.0   # standard deviations of a count that a vector at distance R may fall short
GROWTH = 1.06  # of R from round to round
PROBES = 64    # vectors whose nearest distance starts a query's R
BLOCK_ROWS = 16384  # vectors of a block, about
QUERY_ROWS = 4096   # queries of a query block, about


def directions(dim: int, m: int = DIRECTIONS) -> np.ndarray:
    return np.random.default_rng(dim).standard_normal((dim, m))


def threshold(m: int) -> int:
    """Collisions that a vector needs."""
    p = math.erf(Z / math.sqrt(2))
    return max(1, math.floor(m * p - MARGIN * math.sqrt(m * p * (1 - p))))


def _places(rows: np.ndarray, x: np.ndarray, after: bool) -> np.ndarray:
    """Where x[i] belongs in the sorted rows[i], behind equal entries if ``after``: one bisection for all rows."""
    at, every = np.zeros(len(rows), np.int64), np.arange(len(rows))
    for step in 1 << np.arange(rows.shape[1].bit_length() - 1, -1, -1):
        to = at + step
        last = rows[every, np.minimum(to, rows.shape[1]) - 1]
        at = np.where((to <= rows.shape[1]) & ((last <= x) if after else (last < x)), to, at)
    return at


class Block:
    """Sorted arrays of one block of vectors. ``counted`` and ``verified`` add up window entries and exact distances."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, m: int = DIRECTIONS):
        self.ids, self.vectors, self.m = ids, vectors, m
        self.axes = directions(vectors.shape[1], m)
        at = np.ascontiguousarray((vectors @ self.axes).T)
        order = np.argsort(at, axis=1, kind="stable")
        self.sorted, self.order = np.take_along_axis(at, order, axis=1), order.astype(np.int32)
        self.least = max(float((self.sorted[:, -1] - self.sorted[:, 0]).max()) * 1e-9, 1e-300)  # above rounding
        self.counted = self.verified = 0

    def search(self, query: np.ndarray, own: int, k: int, bound: float = math.inf) -> tuple[np.ndarray, np.ndarray]:
        """(ids, distances) of the k nearest found, nearest first, ties to smaller ids. With a finite ``bound``
        vectors farther than it aren't wanted: one round at that radius."""
        n, m, need = len(self.ids), self.m, threshold(self.m)
        centre, hits = query @ self.axes, np.zeros(n, np.int16)
        low = _places(self.sorted, centre, False)
        high, dist, once = low.copy(), np.full(n, np.inf), math.isfinite(bound)
        radius = max(bound if once else self._first_radius(query, own), self.least)
        while True:
            a = np.minimum(_places(self.sorted, centre - Z * radius, False), low)
            b = np.maximum(_places(self.sorted, centre + Z * radius, True), high)
            new = [self.order[i, x:y] for i in range(m) for x, y in ((a[i], low[i]), (high[i], b[i])) if y > x]
            if new:
                new = np.concatenate(new)
                self.counted += len(new)
                hits += np.bincount(new, minlength=n).astype(np.int16)
            low, high, whole = a, b, bool((a == 0).all() and (b == n).all())
            new = np.flatnonzero((hits >= need) & np.isinf(dist))
            if len(new):
                self.verified += len(new)
                dist[new] = np.sqrt(((self.vectors[new] - query) ** 2).sum(axis=1))
                dist[new[self.ids[new] == own]] = np.nan
            if once or whole or np.count_nonzero(dist <= radius) >= k:
                break
            radius *= GROWTH
        near = np.flatnonzero(np.isfinite(dist))
        near = near[np.lexsort((self.ids[near], dist[near]))][:k]
        return self.ids[near], dist[near]

    def _first_radius(self, query: np.ndarray, own: int) -> float:
        """Half of the distance to the nearest of the probed vectors, which lie evenly over the block."""
        some = np.linspace(0, len(self.ids) - 1, min(PROBES, len(self.ids))).astype(int)
        some = some[self.ids[some] != own]
        return float(np.sqrt(((self.vectors[some] - query) ** 2).sum(axis=1)).min()) / 2 if len(some) else 0.0


def _distinct(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors, one vector an id: of several the smallest."""
    rows = sorted(zip(pdf["id"].tolist(), map(tuple, pdf["v"]), strict=True))
    rows = [r for i, r in enumerate(rows) if not i or rows[i - 1][0] != r[0]]
    return np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.float64)


def valid_vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v) of the rows that take part: with an id, no null or non-finite component, not zero, not empty."""
    v = c(vector_col).cast("array<double>")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (df.select(c(id_col).cast("long").alias("id"), v.alias("v")).where("id is not null and v is not null")
            .where(F.coalesce(finite, F.lit(False)) & F.exists("v", lambda x: x != 0)))


def nearest(data: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10,
            block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k nearest found among all rows but its own, by Euclidean
    distance in double precision on the original vectors, nearest first, ties to the smaller id.

    Rows go to blocks by a hash of their id (many copies of one vector spread evenly). Each query is searched in the
    block that its own id falls into; its k-th distance there goes with it to all other blocks. A block of rows meets
    a block of queries in one task of bounded size and gives k rows a query at most; the best k are kept.
    Vectors that are null, empty, zero or hold null or non-finite components take no part, nor do rows without
    an id; vectors are only compared with others of their length. An id names one vector: repeated rows count
    once, of several vectors under one id the smallest counts. Fewer candidates give fewer ranks; empty tables
    give an empty result. Columns beside the two are ignored.
    """
    rows, asked = valid_vectors(data, id_col, vector_col), valid_vectors(queries, id_col, vector_col)
    nb = max(1, -(-rows.count() // block_rows))
    nq = max(1, -(-asked.count() // query_rows))
    part = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    rows = rows.select("*", F.size("v").alias("dim"), part(nb).alias("block"))
    asked = asked.select("*", F.size("v").alias("dim"), part(nb).alias("home"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(nq)).cast("int").alias("qb"))

    def search(block_pdf: pd.DataFrame, query_pdf: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"query_id": np.array([], np.int64), "vec_id": np.array([], np.int64), "score": np.array([], float)})]
        if len(block_pdf) and len(query_pdf):
            index = Block(*_distinct(block_pdf))
            bounds = dict(zip(query_pdf["id"].tolist(), query_pdf["bound"].tolist(), strict=True))
            for q, v in zip(*_distinct(query_pdf), strict=True):
                ids, dist = index.search(v, int(q), k, bounds[int(q)])
                out.append(pd.DataFrame({"query_id": np.int64(q), "vec_id": ids, "score": dist}))
        return pd.concat(out)
    keys = ["dim", "block", "qb"]

    def meet(queries: DataFrame, pairs: DataFrame) -> DataFrame:
        spread = pairs.groupBy("block").agg(F.collect_set("qb").alias("qbs"))
        left = rows.join(spread, "block").select("id", "v", "dim", "block", F.explode("qbs").alias("qb"))
        return left.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInPandas(search, "query_id long, vec_id long, score double")
    order = W.partitionBy("query_id").orderBy("score", "vec_id")
    grid = rows.sparkSession.range(nb).select(F.col("id").cast("int").alias("block"), F.explode(F.sequence(F.lit(0), F.lit(nq - 1))).alias("qb"))
    home = asked.select("id", "v", "dim", "qb", F.col("home").alias("block"), F.lit(float("inf")).alias("bound"))
    found = stored(meet(home, grid), "ann-home")
    if nb > 1:
        reach = found.groupBy(F.col("query_id").alias("id")).agg(F.max("score").alias("far"), F.count(F.lit(1)).alias("n"))
        away = asked.join(reach, "id", "left").select(
            "id", "v", "dim", "qb", "home", F.when(F.col("n") >= k, F.col("far")).otherwise(float("inf")).alias("bound"))
        away = away.select("*", F.explode(F.sequence(F.lit(0), F.lit(nb - 1))).alias("block")).where("block <> home").drop("home")
        found = found.unionByName(meet(away, grid))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
