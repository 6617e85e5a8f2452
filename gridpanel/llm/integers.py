"""Vectors as whole numbers: exact in 64 bits where that is enough, in Python integers beyond.

Also sums of whole numbers of any size over all tasks: each task sends its sums
in digits of 40 bits, Spark adds them up, and the driver, which sees one number
per place, puts the digits together.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIGIT = 40
LARGEST = (1 << 63) - 1
SUMS = "entry long, place long, digit int, total long"
_whole = np.frompyfunc(int, 1, 1)


def finite(vector: str, scale: int) -> Column:
    """The vector and its scaled components are numbers (null counts as false)."""
    return F.coalesce(F.forall(vector, lambda x: F.abs(x.cast("double") * scale) < float("inf")), F.lit(False))


def floors(flat: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x), as doubles; scale is a power of two, so that nothing is rounded."""
    return np.floor(flat.astype(np.float64) * scale)


def exact(*arrays: np.ndarray) -> list[np.ndarray]:
    """The same whole numbers as 64-bit integers if squared distances of them fit, else as Python integers."""
    longest = max((a.shape[-1] for a in arrays if a.ndim), default=0)
    largest = max((int(np.abs(a).max()) for a in arrays if a.size), default=0)
    if 4 * largest**2 * max(longest, 1) ** 2 < 1 << 62:
        return [a.astype(np.int64) for a in arrays]
    return [_whole(a).astype(object) if a.size else a.astype(object) for a in arrays]


def as_long(values: np.ndarray) -> pa.Array:
    """Numbers beyond a long are held at its end."""
    if values.dtype == object:
        values = np.minimum(values, LARGEST).astype(np.int64)
    return pa.array(values)


def clamped_sum(column: str) -> Column:
    """Sum of longs, held at the end of a long."""
    return F.least(F.sum(F.col(column).cast("decimal(19,0)")), F.lit(LARGEST).cast("decimal(38,0)")).cast("long")


def matrices(batches: Iterable[pa.RecordBatch], vector: str, values: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows gathered up to about ``values`` components, and their vectors (of one length) as a matrix."""
    held: list[pa.RecordBatch] = []
    size = 0

    def together():
        table = pa.Table.from_batches(held).combine_chunks()
        flat = table.column(vector).combine_chunks().flatten()
        return table, np.asarray(flat).reshape(len(table), len(flat) // len(table))

    for batch in batches:
        step = max(1, values * max(len(batch), 1) // max(len(batch.column(vector).flatten()), 1))
        for a in range(0, len(batch), step):
            held.append(batch.slice(a, step))
            size += len(held[-1].column(vector).flatten())
            if size >= values:
                yield together()
                held, size = [], 0
    if held:
        yield together()


def sum_rows(sums: dict[int, Iterable[int]]) -> pa.RecordBatch:
    """One task's sums, as rows of SUMS: entry -> numbers by place."""
    rows = [
        (entry, place, digit, ((abs(int(n)) >> (DIGIT * digit)) & ((1 << DIGIT) - 1)) * (1 if n > 0 else -1))
        for entry, numbers in sums.items()
        for place, n in enumerate(numbers)
        for digit in range(-(-abs(int(n)).bit_length() // DIGIT))
    ]
    names = ["entry", "place", "digit", "total"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64()]
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)


def totals(rows: DataFrame) -> dict[int, dict[int, int]]:
    """entry -> place -> sum over all tasks. The caller bounds how many entries and places there are."""
    out: dict[int, dict[int, int]] = {}
    for row in rows.groupBy("entry", "place", "digit").agg(F.sum("total").alias("total")).collect():
        places = out.setdefault(row["entry"], {})
        places[row["place"]] = places.get(row["place"], 0) + (row["total"] << (DIGIT * row["digit"]))
    return out


def add_at(sums: np.ndarray, rows: np.ndarray, values: np.ndarray) -> None:
    """sums[rows[i]] += values[i], exact for integers of both kinds."""
    order = np.argsort(rows, kind="stable")
    heads = np.flatnonzero(np.concatenate([[True], np.diff(rows[order]) != 0])) if len(rows) else np.zeros(0, np.int64)
    if len(heads):
        sums[rows[order][heads]] += np.add.reduceat(values[order], heads, axis=0)
