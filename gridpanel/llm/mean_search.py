"""Clustering by rounds of nearest centroids, each found by means and deviations first.

For a vector x and a centroid c of d components, with sums s and deviations v
(root of d times the summed squares around the mean),
    d * |x - c|^2 >= (s_x - s_c)^2 + (v_x - v_c)^2.
Centroids are sorted by their sums. Each vector starts at its own sum and looks
outward; when the first term alone passes the best distance so far, no centroid
further out can win and it stops; one that fails both terms is skipped. The rest
are compared. All of it is done in whole numbers: roots are rounded and the
second inequality leaves room for that, so it rejects no winner.

Rows stay where they are: every round reads the written vectors, sends one sum
per centroid and component, and the driver moves the centroids (k x d numbers).

Defined results: rows with a null vector, a null or non-finite component (also
after scaling) or another number of components go; rows that repeat a vec_id are
separate rows; null vec_ids are clustered, but never start a centroid; with fewer
rows than centroids there are fewer, and without any the cluster is null; of
equally near centroids the first is taken; distances and sums beyond a long are
held at its end; an empty table gives an empty result. Further columns stay; one
named like a result column makes way for it.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpanel.llm import integers
from gridpanel.llm.common import stage

BLOCK_VALUES = 1 << 20
_root = np.frompyfunc(math.isqrt, 1, 1)
ADDED = ("cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def moments(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of rows, and their deviations as whole numbers that are off by less than one."""
    sums = x.sum(axis=1)
    spread = (x * x).sum(axis=1) * x.shape[1] - sums * sums
    return sums, _root(spread).astype(object) if x.dtype == object else np.sqrt(spread.astype(np.float64)).astype(np.int64)


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Number of the nearest centroid and its squared distance, and how many distances were computed.

    x (rows, d) and centroids (k, d) hold integers of one kind.
    """
    n, d = x.shape
    k = len(centroids)
    sums, deviation = moments(x)
    c_sums, c_deviation = moments(centroids)
    order = np.argsort(c_sums, kind="stable")
    in_order = c_sums[order]
    right = np.searchsorted(in_order, sums)
    left = right - 1
    best, number = np.full(n, -1, x.dtype), np.full(n, k)
    compared = 0
    active = np.arange(n)
    while len(active):
        # the next centroid outward, on the side that is nearer
        low, high = left[active], right[active]
        below, above = low >= 0, high < k
        gap_below = sums[active] - in_order[np.maximum(low, 0)]
        gap_above = in_order[np.minimum(high, k - 1)] - sums[active]
        down = below & (~above | (gap_below <= gap_above))
        gap = np.where(down, gap_below, gap_above)
        open_ = (below | above) & ((best[active] < 0) | (gap * gap <= best[active] * d)).astype(bool)
        active, down, gap = active[open_], down[open_], gap[open_]
        c = order[np.where(down, left[active], right[active])]
        left[active[down]] -= 1
        right[active[~down]] += 1
        apart = np.maximum(np.abs(deviation[active] - c_deviation[c]) - 2, 0)
        near = ((best[active] < 0) | (gap * gap + apart * apart <= best[active] * d)).astype(bool)
        rows, c = active[near], c[near]
        compared += len(rows)
        distance = ((x[rows] - centroids[c]) ** 2).sum(axis=1)
        better = ((best[rows] < 0) | (distance < best[rows]) | ((distance == best[rows]) & (c < number[rows]))).astype(bool)
        best[rows[better]], number[rows[better]] = distance[better], c[better]
    return number, best, compared


def _assigned(flat: np.ndarray, centroids: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    x, c = integers.exact(integers.floors(flat, scale), centroids)
    number, distance, _ = nearest(x, c)
    return x, number, distance


def _moves(centroids: np.ndarray, scale: int):
    """Arrow worker: sums of each centroid's vectors by component, then their number."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for _, flat in integers.matrices(batches, "embedding", BLOCK_VALUES):
            x, number, _ = _assigned(flat, centroids, scale)
            new = np.zeros((len(centroids), x.shape[1] + 1), x.dtype)
            integers.add_at(new, number, np.concatenate([x, np.ones((len(x), 1), x.dtype)], axis=1))
            for c in np.unique(number).tolist():
                sums[c] = new[c].astype(object) + sums.get(c, 0)
        yield integers.sum_rows(sums)

    return work


def cluster(vectors: DataFrame, k: int = 40, rounds: int = 5, components: int = 64, scale: int = 256, seed: int = 2, keep: list[str] | None = None) -> DataFrame:
    """The rows that take part (the columns ``keep`` names, else all), with cluster, distance, cluster_inertia, inertia and centroid_sha256.

    Starting centroids: the rows with the smallest sha256 of "seed:vec_id", in that order.
    """
    kept = [c for c in (keep or vectors.columns) if c not in ADDED]
    fitting = vectors.select(*dict.fromkeys([*kept, "vec_id", "embedding"])).where(F.size("embedding") == components).where(integers.finite("embedding", scale))
    rows = stage(fitting, "cluster-vectors")
    draw = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    firsts = rows.where("vec_id is not null").select(draw.alias("draw"), F.col("embedding").cast("array<double>").alias("vector"))
    chosen = [row["vector"] for row in firsts.orderBy("draw", "vector").limit(k).collect()]
    if not chosen:
        nothing = {"cluster": "int", "distance": "long", "cluster_inertia": "long", "inertia": "long", "centroid_sha256": "string"}
        return rows.select(*kept, *[F.lit(None).cast(t).alias(n) for n, t in nothing.items()])
    start = integers.floors(np.array(chosen, np.float64), scale)
    centroids = np.array([[int(x) for x in row] for row in start], object).reshape(len(chosen), components)
    for _ in range(rounds):
        for c, found in integers.totals(rows.select("embedding").mapInArrow(_moves(centroids, scale), integers.SUMS)).items():
            centroids[c] = [found.get(i, 0) // found[components] for i in range(components)]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, flat in integers.matrices(batches, "embedding", BLOCK_VALUES):
            _, number, distance = _assigned(flat, centroids, scale)
            row = table.column("row").combine_chunks()
            yield pa.RecordBatch.from_arrays([row, pa.array(number, pa.int32()), integers.as_long(distance)], ["row", "cluster", "distance"])

    inner = rows.select(F.struct(*kept).alias("row"), "embedding")
    kind = inner.schema["row"].dataType.simpleString()
    assigned = stage(inner.mapInArrow(work, f"row {kind}, cluster int, distance long"), "cluster-assigned")
    names = {c: hashlib.sha256(",".join(str(int(x)) for x in centroids[c]).encode()).hexdigest() for c in range(len(centroids))}
    sha = F.create_map(*[F.lit(v) for pair in names.items() for v in pair])
    per_cluster = assigned.groupBy("cluster").agg(integers.clamped_sum("distance").alias("cluster_inertia"))
    total = assigned.agg(integers.clamped_sum("distance")).first()[0]
    # one row per centroid, so its size is bounded by k
    joined = assigned.join(F.broadcast(per_cluster), "cluster")
    return joined.select("row.*", "cluster", "distance", "cluster_inertia", F.lit(total).cast("long").alias("inertia"), sha[F.col("cluster")].alias("centroid_sha256"))
