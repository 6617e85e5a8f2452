"""Keyed writes as set operations: insert-if-absent, fill-if-null, key minting.

A batch is first reduced to one row per key, so neither side of the joins
below can be skewed. Keys compare null-safely: a second batch with a NULL
natural key adds nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridpanel.operators.keyed import first_per_key
from gridpanel.operators.ordering import ordered_index
from gridpanel.scratch import stage


def _same_key(left: DataFrame, right: DataFrame, keys: list[str]) -> list[Column]:
    return [left[k].eqNullSafe(right[f"_other_{k}"]) for k in keys]


def _keys_of(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.select(*[F.col(k).alias(f"_other_{k}") for k in keys])


def absent(incoming: DataFrame, stored: DataFrame, keys: list[str], small_batch: bool = False) -> DataFrame:
    """Rows whose key is not stored.

    An anti join cannot broadcast its left side, so a small batch would shuffle
    the whole stored table. With ``small_batch`` the batch is staged and the
    stored keys are first narrowed to those in it: a broadcast if the batch's
    files are small, else a join with the partitioning the anti join needs anyway.
    """
    if small_batch:
        incoming = stage(incoming, "batch")
        stored = present(stored.select(*keys), incoming, keys)
    known = _keys_of(stored, keys)
    return incoming.join(known, _same_key(incoming, known, keys), "left_anti")


def present(incoming: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is stored."""
    known = _keys_of(stored, keys)
    return incoming.join(known, _same_key(incoming, known, keys), "left_semi")


def insert_if_absent(incoming: DataFrame, stored: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The rows to append: per key the first in ``order``, unless the key is stored."""
    return absent(first_per_key(incoming, keys, order), stored, keys)


def fill_if_null(stored: DataFrame, incoming: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The whole table after the batch: stored values win, NULLs are filled, new keys added."""
    batch = first_per_key(incoming, keys, order)
    new = batch.select(*[F.col(c).alias(f"_new_{c}") for c in batch.columns])
    match = [stored[k].eqNullSafe(new[f"_new_{k}"]) for k in keys]
    merged = [
        F.coalesce(stored[c], new[f"_new_{c}"]).alias(c) if c in batch.columns else stored[c]
        for c in stored.columns
    ]
    # A left join and the rows it leaves over: unlike a full join, it can split a key that many stored rows share.
    filled = stored.join(new, match, "left").select(*merged)
    kinds = dict(stored.dtypes)
    added = [F.col(c) if c in batch.columns else F.lit(None).cast(kinds[c]).alias(c) for c in stored.columns]
    return filled.unionByName(absent(batch, stored, keys).select(*added))


def mint_keys(df: DataFrame, order: list[str | Column], name: str, base: int, step: int) -> DataFrame:
    """Surrogate keys base, base+step, ... in the given order."""
    placed = ordered_index(df, order, "_at")
    return placed.withColumn(name, F.lit(base) + F.lit(step) * F.col("_at")).drop("_at")


def highest(df: DataFrame, column: str, default: int = 0) -> int:
    """Largest key in use; one row reaches the driver."""
    top = df.agg(F.max(column).alias("top")).first()["top"]
    return default if top is None else int(top)
