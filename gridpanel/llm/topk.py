"""Exact top-k inner products, pruned by multi-resolution segment statistics.

Components are turned into floor(scale * x) and compared as integers. A vector
is cut into segments; per segment, its mean and standard deviation give a lower
bound of the squared distance of two vectors,
    sum of length * ((mean_q - mean_x)^2 + (dev_q - dev_x)^2),
and with both norms an upper bound of their inner product. Pairs go through the
resolutions from coarse to fine; those whose bound falls below the k-th exact
score found so far go, and exact scores are computed for the rest.

Queries and candidates are dealt in blocks, every query block meets every
candidate block in one task, and each task sends k rows per query. No step
holds more than two blocks.

Defined results: rows whose vec_id or vector is null, and vectors with a null or
non-finite component, take no part; vectors of different lengths are not
compared (two empty ones score 0); rows that repeat a vec_id are separate rows,
each a candidate for the others; ties go to the smaller vec_id; scores beyond a
long are held at its ends; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridpanel.llm.common import stage
from gridpanel.llm.minhash import sorted_groups

RESOLUTIONS = (4, 16)
EXACT = float(1 << 52)
TILE = 64


def segment_features(x: np.ndarray, segments: int) -> np.ndarray:
    """(rows, 2 * segments): sqrt(length) times mean and deviation per segment; their inner product bounds x's."""
    edges = np.unique(np.linspace(0, x.shape[1], min(segments, x.shape[1]) + 1).astype(int))
    parts = []
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        part, root = x[:, a:b], math.sqrt(b - a)
        parts += [part.mean(axis=1) * root, part.std(axis=1) * root]
    return np.stack(parts, axis=1) if parts else np.zeros((len(x), 1))


def exact_scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of paired rows; in Python integers where doubles could round."""
    if len(q) == 0 or np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * max(q.shape[1], 1) < EXACT:
        return np.einsum("ij,ij->i", q, x).astype(np.int64)
    low, high = -(1 << 63), (1 << 63) - 1
    return np.array([min(max(sum(int(a) * int(b) for a, b in zip(i, j, strict=True)), low), high) for i, j in zip(q, x, strict=True)], np.int64)


class Best:
    """The k best (score, then smaller id) of each query so far, and the k-th score."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.query = self.score = self.row = np.zeros(0, np.int64)
        self.least = np.full(queries, -np.inf)

    def add(self, query: np.ndarray, score: np.ndarray, row: np.ndarray, ids: np.ndarray) -> None:
        query, score, row = (np.concatenate(p) for p in ((self.query, query), (self.score, score), (self.row, row)))
        order = np.lexsort((row, ids[row], ~score, query))
        query, score, row = query[order], score[order], row[order]
        first = np.searchsorted(query, query)
        place = np.arange(len(query)) - first
        self.query, self.score, self.row = query[place < self.k], score[place < self.k], row[place < self.k]
        last = place == self.k - 1
        self.least[query[last]] = score[last]


def top_of_block(q: np.ndarray, x: np.ndarray, q_own: np.ndarray, x_own: np.ndarray, ids: np.ndarray, k: int) -> Best:
    """The k best rows of x for each row of q, leaving out a query's own row."""
    best = Best(len(q), k)
    if not len(q) or not len(x):
        return best
    scale = float(np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * q.shape[1])
    fine_x = [segment_features(x, s) for s in RESOLUTIONS]
    tiles = [_top_of_tile(q[a : a + TILE], x, q_own[a : a + TILE], x_own, ids, k, fine_x, scale) for a in range(0, len(q), TILE)]
    best.query = np.concatenate([t.query + n * TILE for n, t in enumerate(tiles)])
    best.score, best.row, best.least = (np.concatenate([getattr(t, name) for t in tiles]) for name in ("score", "row", "least"))
    return best


def _top_of_tile(q: np.ndarray, x: np.ndarray, q_own: np.ndarray, x_own: np.ndarray, ids: np.ndarray, k: int, fine_x: list[np.ndarray], scale: float) -> Best:
    """A few queries against a block: bounds are small matrix products, exact scores one product where many pairs are left."""
    best = Best(len(q), k)
    slack = 1e-9 * scale + 1e-6
    coarse = segment_features(q, RESOLUTIONS[0]) @ fine_x[0].T
    coarse[q_own[:, None] == x_own[None, :]] = -np.inf
    # Exact scores of the pairs with the highest bounds set the first limits.
    head = np.argpartition(-coarse, min(4 * k, len(x) - 1), axis=1)[:, : 4 * k]
    query = np.repeat(np.arange(len(q)), head.shape[1])
    row = head.reshape(-1)
    real = np.isfinite(coarse[query, row])
    query, row = query[real], row[real]
    best.add(query, exact_scores(q[query], x[row]), row, ids)
    coarse[query, row] = -np.inf
    left = (coarse + slack >= best.least[:, None]) & np.isfinite(coarse)
    for segments, fx in zip(RESOLUTIONS[1:], fine_x[1:], strict=True):
        left &= segment_features(q, segments) @ fx.T + slack >= best.least[:, None]
    query, row = np.nonzero(left)
    if scale < EXACT and len(query) * 16 > left.size:
        score = (q @ x.T)[query, row].astype(np.int64)
    else:
        score = exact_scores(q[query], x[row])
    near = score >= best.least[query]
    best.add(query[near], score[near], row[near], ids)
    return best


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256, candidate_block: int = 1024, query_block: int = 4096) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of each query's k best candidates. vectors: vec_id, embedding."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    valid = vectors.where("vec_id is not null and embedding is not null").where(finite)
    valid = valid.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"), is_query.alias("is_query"))
    valid = stage(valid.withColumn("own", F.monotonically_increasing_id()), "topk-vectors")
    rows, queries = valid.agg(F.count("*"), F.count_if("is_query")).first()
    blocks, query_blocks = max(1, math.ceil(rows / candidate_block)), max(1, math.ceil(queries / query_block))
    block = F.pmod(F.xxhash64("own"), F.lit(blocks))
    part = F.pmod(F.xxhash64("own"), F.lit(query_blocks))
    columns = ["vec_id", "own", "vector", F.size("vector").alias("length")]
    left = valid.where("is_query").select(*columns, F.lit(True).alias("asks"), part.alias("part"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    right = valid.select(*columns, F.lit(False).alias("asks"), F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("part"), block.alias("block"))
    tasks = left.unionByName(right).withColumn("task", F.xxhash64("length", "part", "block"))
    dealt = tasks.repartition("task").sortWithinPartitions("task", "vec_id", "own")

    def work(batches):
        for group in sorted_groups(batches, "task"):
            group = group.combine_chunks()
            length = group.column("length")[0].as_py()
            flat = np.asarray(group.column("vector").combine_chunks().flatten(), np.float64).reshape(len(group), length)
            values = np.floor(scale * flat)
            asks = np.asarray(group.column("asks"))
            ids, own = np.asarray(group.column("vec_id")), np.asarray(group.column("own"))
            best = top_of_block(values[asks], values[~asks], own[asks], own[~asks], ids[~asks], k)
            yield pa.RecordBatch.from_arrays(
                [pa.array(own[asks][best.query]), pa.array(ids[asks][best.query]), pa.array(ids[~asks][best.row]), pa.array(own[~asks][best.row]), pa.array(best.score)],
                ["query_own", "query_id", "vec_id", "own", "score"],
            )

    found = dealt.mapInArrow(work, "query_own long, query_id long, vec_id long, own long, score long")
    order = Window.partitionBy("query_own").orderBy(F.desc("score"), "vec_id", "own")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
