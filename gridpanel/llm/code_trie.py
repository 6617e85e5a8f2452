"""Vectors as short codes, one byte per part; nearest entries are found along a trie.

A vector is cut into parts, each part position has a codebook. The distinct parts
of a block of rows, in lexicographic order, are the leaves of a trie with one
level per dimension. It is walked depth first, some thousand sibling nodes at a
time: a node holds the squared distances that its prefix has gathered to all
entries, so what parts have in common is added up once. At a leaf the smallest
sum names the entry, and the part times the number of its rows is added to the
entry's new sum.

Codebooks start as the parts of the smallest ids and are moved to the floors of
their parts' means, a given number of times. The driver holds codebooks and one
sum per codebook number (entries x vector length); rows stay where they are, no
round shuffles more than those sums.

Defined results: rows whose vector is null or holds a null or non-finite
component (also after scaling) go; the vector length is that of the first row in
order of vec_id (nulls last), rows with other lengths stay with a null code and
error; lengths that parts do not divide are cut as evenly as whole positions
allow, and an empty part is at distance 0; rows that repeat a vec_id are separate
rows (in order of their vectors); null vec_ids are encoded, and start a codebook
only where there are not enough others; with fewer rows than entries the codebook
is shorter; of equally near entries the first is taken; errors beyond a long are
held at its end; an empty table gives an empty result. Further columns stay;
one named like a result column makes way for it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpanel.llm import integers
from gridpanel.llm.common import stage

NODES = 2048
BLOCK_VALUES = 1 << 22


class Codebooks(NamedTuple):
    """Entries of each part position: entries[part] is (entries, length of the part), whole numbers."""

    entries: list[np.ndarray]
    edges: list[int]
    scale: int

    @property
    def length(self) -> int:
        return self.edges[-1]

    def sha256(self) -> str:
        """Of all components in decimal, by part, entry and position."""
        numbers = (str(int(x)) for part in self.entries for entry in part for x in entry)
        return hashlib.sha256(",".join(numbers).encode()).hexdigest()


def distinct_rows(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct rows in lexicographic order, the number of each row in them, and how often each occurs."""
    if x.shape[1] == 0:
        return x[:1], np.zeros(len(x), np.int64), np.array([len(x)])
    low = x.min(axis=0)
    widths = [int(w) + 1 for w in x.max(axis=0) - low]
    room = 1
    for w in widths:
        room *= w
    if room < 1 << 62:
        key = np.zeros(len(x), np.int64)
        for k, w in enumerate(widths):
            key = key * w + (x[:, k] - low[k]).astype(np.int64)
        _, one, inverse, counts = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
        return x[one], inverse, counts
    order = np.lexsort(x.T[::-1])
    heads = np.concatenate([[True], (x[order][1:] != x[order][:-1]).any(axis=1)])
    inverse = np.empty(len(x), np.int64)
    inverse[order] = np.cumsum(heads) - 1
    return x[order][heads], inverse, np.bincount(inverse)


def walk(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry of each part and its squared distance; parts are distinct and in lexicographic order."""
    n, depth = parts.shape
    best, distance = np.zeros(n, np.int64), np.zeros(n, parts.dtype)
    fresh = np.ones((depth, n), bool)
    for k in range(depth):
        fresh[k, 1:] = (parts[1:, k] != parts[:-1, k]) | (fresh[k - 1, 1:] if k else False)

    def descend(k: int, starts: np.ndarray, end: int, gathered: np.ndarray) -> None:
        """Children, at dimension k, of neighbouring nodes that start at these parts."""
        children = np.flatnonzero(fresh[k, starts[0] : end]) + starts[0]
        parents = np.searchsorted(starts, children, "right") - 1
        for a in range(0, len(children), NODES):
            rows = children[a : a + NODES]
            sums = gathered[parents[a : a + NODES]] + (parts[rows, k][:, None] - entries[:, k][None, :]) ** 2
            if k == depth - 1:
                best[rows] = sums.argmin(axis=1)
                distance[rows] = sums[np.arange(len(rows)), best[rows]]
            else:
                descend(k + 1, rows, children[a + NODES] if a + NODES < len(children) else end, sums)

    if depth and n:
        descend(0, np.zeros(1, np.int64), n, np.zeros((1, len(entries)), parts.dtype))
    return best, distance


def _cut(x: np.ndarray, edges: list[int], entries: list[np.ndarray]):
    """Per part position: distinct parts and entries (of one kind of integer), row numbers, counts."""
    for p, book in enumerate(entries):
        part, book = integers.exact(x[:, edges[p] : edges[p + 1]], book)
        found, inverse, counts = distinct_rows(part)
        yield found, book, inverse, counts


def prepare(vectors: DataFrame, scale: int) -> DataFrame:
    """Rows that take part, written once: vec_id, embedding and whatever else there is."""
    return stage(vectors.where(integers.finite("embedding", scale)), "code-vectors")


def train(vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256) -> Codebooks | None:
    """Codebooks learned from all rows of ``prepare``'s table; None if it has none."""
    order = [F.asc_nulls_last("vec_id"), "embedding"]
    first = vectors.orderBy(*order).select("embedding").head(1)
    if not first:
        return None
    length = len(first[0][0])
    fitting = vectors.where(F.size("embedding") == length)
    edges = [p * length // parts for p in range(parts + 1)]
    seeds = [row[0] for row in fitting.orderBy(*order).limit(entries).select(F.col("embedding").cast("array<double>")).collect()]
    start = integers.floors(np.array(seeds, np.float64).reshape(len(seeds), length), scale)
    books = [np.array([[int(x) for x in row] for row in start[:, a:b]], object).reshape(len(seeds), b - a) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    for _ in range(rounds if length else 0):
        sums = integers.totals(fitting.select("embedding").mapInArrow(_moves(edges, books, scale), integers.SUMS))
        for p, book in enumerate(books):
            width = edges[p + 1] - edges[p]
            for e in range(len(book)):
                found = sums.get(p * len(book) + e)
                if found is not None:
                    book[e] = [found.get(k, 0) // found[width] for k in range(width)]
    return Codebooks(books, edges, scale)


def _moves(edges: list[int], books: list[np.ndarray], scale: int):
    """Arrow worker: sums of the parts nearest to each entry, component by component, then their number."""
    per_part = len(books[0])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for _, flat in integers.matrices(batches, "embedding", BLOCK_VALUES):
            for p, (found, book, _, counts) in enumerate(_cut(integers.floors(flat, scale), edges, books)):
                best, _ = walk(found, book)
                new = np.zeros((len(book), found.shape[1] + 1), found.dtype)
                weighted = np.concatenate([found * counts[:, None], counts[:, None]], axis=1).astype(found.dtype)
                integers.add_at(new, best, weighted)
                for e in np.unique(best).tolist():
                    old = sums.get(p * per_part + e)
                    sums[p * per_part + e] = new[e].astype(object) + (0 if old is None else old)
        yield integers.sum_rows(sums)

    return work


def encode(vectors: DataFrame, books: Codebooks | None, keep: list[str] | None = None) -> DataFrame:
    """The rows of ``prepare``'s table (the columns ``keep`` names, else all) with code (two hex digits a part, in order) and error (squared distance)."""
    kept = [c for c in (keep or vectors.columns) if c not in ("code", "error")]
    if books is None:
        return vectors.select(*kept, F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    fits = F.size("embedding") == books.length
    plain = vectors.where(~fits).select(*kept, F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    inner = vectors.where(fits).select(F.struct(*kept).alias("row"), "embedding")

    count = len(books.entries[0])
    wide = max(2, len(f"{count - 1:x}"))
    names = np.array([f"{e:0{wide}x}" for e in range(count)])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, flat in integers.matrices(batches, "embedding", BLOCK_VALUES):
            codes, errors = [], []
            for found, book, inverse, _ in _cut(integers.floors(flat, books.scale), books.edges, books.entries):
                best, distance = walk(found, book)
                codes.append(best[inverse])
                errors.append(distance[inverse])
            # a part's distance fits a quarter of a long, their sum perhaps not
            error = sum((e.astype(object) for e in errors), np.zeros(len(table), object))
            joined = ["".join(row) for row in names[np.stack(codes, axis=1)].tolist()]
            row = table.column("row").combine_chunks()
            yield pa.RecordBatch.from_arrays([row, pa.array(joined, pa.string()), integers.as_long(error)], ["row", "code", "error"])

    kind = inner.schema["row"].dataType.simpleString()
    coded = inner.mapInArrow(work, f"row {kind}, code string, error long")
    return coded.select("row.*", "code", "error").unionByName(plain)


def with_label_error(coded: DataFrame) -> DataFrame:
    """Adds label_error: errors summed over equal labels, nulls together."""
    sums = coded.groupBy(F.col("label").alias("_of_label")).agg(integers.clamped_sum("error").alias("label_error"))
    kept = [c for c in coded.columns if c != "label_error"]
    return coded.select(*kept).join(sums, coded["label"].eqNullSafe(sums["_of_label"]), "left").drop("_of_label")
