"""Questions of document groups to a key-value table that is too large for one task.

Groups ask with sorted distinct 64-bit keys, cut by bucket: rows of kind,
bucket, group, keys (packed) and counts (packed). ``merged`` sums counts per key
in two levels, first per bucket and salt (so many groups at a time), then per
bucket; ``answers`` sends each group the values of its keys, in the order in
which it asked. No task holds more than one bucket's distinct keys, and a key
that every group asks for costs one entry per group.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridpanel.llm.minhash import sorted_groups

GROUPS_PER_SALT = 32
REQUEST = "kind int, bucket long, group long, keys binary, counts binary"


def packed(values: np.ndarray, level: int = 1) -> bytes:
    return zstandard.ZstdCompressor(level=level).compress(np.ascontiguousarray(values).tobytes())


def unpacked(blob: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), kind)


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted unsigned 64-bit keys, as differences."""
    return packed(np.diff(keys, prepend=np.uint64(0)))


def unpack_keys(blob: bytes) -> np.ndarray:
    return np.cumsum(unpacked(blob, "<u8"), dtype=np.uint64)


def merge(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and their summed counts."""
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    all_keys, all_counts = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(all_keys)  # sums of whole numbers: equal keys may come in any order
    all_keys, all_counts = all_keys[order], all_counts[order]
    heads = heads_of(all_keys)
    return all_keys[heads], np.add.reduceat(all_counts, heads) if len(heads) else np.zeros(0, np.int64)


def heads_of(keys: np.ndarray) -> np.ndarray:
    """Where each of the sorted keys occurs first."""
    return np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)


def distinct(keys: np.ndarray) -> np.ndarray:
    """Sorted distinct keys, by a plain sort; hash tables would not fit a core's cache."""
    keys = np.sort(keys)
    return keys[heads_of(keys)]


def counted(keys: np.ndarray, counts: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Parts for ``merge``: distinct keys and how often the flag counts is set with them. Plain sorts, no keys are hashed."""
    parts: tuple[list, list] = ([], [])
    for mine, weight in ((keys[counts], 1), (keys[~counts], 0)):
        mine = np.sort(mine)
        heads = heads_of(mine)
        parts[0].append(mine[heads])
        parts[1].append(weight * np.diff(np.append(heads, len(mine))))
    return parts


def request(kind: int, group: int, bucket: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch | None:
    """One group's request as rows, from its sorted keys."""
    order = np.argsort(bucket, kind="stable")
    found, heads = np.unique(bucket[order], return_index=True)
    mine = np.split(order, heads[1:])
    if not len(found):
        return None
    n = len(found)
    return pa.RecordBatch.from_arrays(
        [pa.array([kind] * n, pa.int32()), pa.array(found.astype(np.int64)), pa.array([group] * n, pa.int64()), pa.array([pack_keys(keys[m]) for m in mine], pa.binary()), pa.array([packed(counts[m].astype(np.int64)) for m in mine], pa.binary())],
        ["kind", "bucket", "group", "keys", "counts"],
    )


def merged(asked: DataFrame, groups: int, per_salt: int = GROUPS_PER_SALT) -> DataFrame:
    """kind, bucket, keys, counts of all groups, and total (sum of counts) and known (keys with a count)."""
    if groups > per_salt:
        asked = _merged(_salted(asked, groups, per_salt).withColumn("task", F.xxhash64("kind", "bucket", "salt")))
    return _merged(asked.withColumn("task", F.xxhash64("kind", "bucket")))


def _salted(asked: DataFrame, groups: int, per_salt: int) -> DataFrame:
    return asked.withColumn("salt", F.pmod(F.xxhash64("group"), F.lit(max(1, -(-groups // per_salt)))))


def _merged(rows: DataFrame) -> DataFrame:
    def work(batches):
        for group in sorted_groups(batches, "task"):
            keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
            for k, c in zip(group.column("keys").to_pylist(), group.column("counts").to_pylist(), strict=True):
                keys, counts = merge([keys, unpack_keys(k)], [counts, unpacked(c, "<i8")])
            ends = [pa.array([group.column(n)[0].as_py()], t) for n, t in (("kind", pa.int32()), ("bucket", pa.int64()))]
            totals = [pa.array([int(counts.sum())], pa.int64()), pa.array([int((counts > 0).sum())], pa.int64())]
            yield pa.RecordBatch.from_arrays([*ends, pa.array([pack_keys(keys)], pa.binary()), pa.array([packed(counts)], pa.binary()), *totals], ["kind", "bucket", "keys", "counts", "total", "known"])

    dealt = rows.select("task", "kind", "bucket", "keys", "counts").repartition("task").sortWithinPartitions("task")
    return dealt.mapInArrow(work, "kind int, bucket long, keys binary, counts binary, total long, known long")


def answers(asked: DataFrame, valued: DataFrame, groups: int, kinds: Mapping[int, str], per_salt: int = GROUPS_PER_SALT) -> DataFrame:
    """group, kind, bucket, values (packed, of the type kinds names) in the order of each request's keys."""
    asked = _salted(asked, groups, per_salt)
    salts = asked.select("kind", "bucket", "salt").distinct()
    task = F.xxhash64("kind", "bucket", "salt").alias("task")
    model = valued.join(salts, ["kind", "bucket"]).select(task, F.lit(0).alias("part"), F.lit(None).cast("long").alias("group"), "kind", "bucket", "keys", "values")
    rows = asked.select(task, F.lit(1).alias("part"), "group", "kind", "bucket", "keys", F.lit(None).cast("binary").alias("values"))
    names = ["task", "part", "kind", "keys", "values"]

    def work(batches):
        current = keys = values = None
        for batch in batches:
            out = []
            for t, part, kind, key_blob, value_blob in zip(*(batch.column(n).to_pylist() for n in names), strict=True):
                if part == 0:
                    current, keys, values = t, unpack_keys(key_blob), unpacked(value_blob, kinds[kind])
                    out.append(None)
                elif t != current:
                    raise RuntimeError("a request came before its bucket's values")
                else:
                    out.append(packed(values[np.searchsorted(keys, unpack_keys(key_blob))]))
            done = pa.RecordBatch.from_arrays([*(batch.column(n) for n in ("group", "kind", "bucket")), pa.array(out, pa.binary())], ["group", "kind", "bucket", "values"])
            yield done.filter(pa.array([v is not None for v in out], pa.bool_()))

    dealt = rows.unionByName(model).repartition("task").sortWithinPartitions("task", "part")
    return dealt.mapInArrow(work, "group long, kind int, bucket long, values binary")


def fill(blobs: Mapping[tuple[int, int], bytes], kind: int, dtype: str, bucket: np.ndarray) -> np.ndarray:
    """Values of sorted keys from a group's answers, given the keys' buckets."""
    values = np.zeros(len(bucket))
    if not len(bucket):
        return values
    order = np.argsort(bucket, kind="stable")
    found, heads = np.unique(bucket[order], return_index=True)
    for b, mine in zip(found.tolist(), np.split(order, heads[1:]), strict=True):
        values[mine] = unpacked(blobs[kind, b], dtype)
    return values
