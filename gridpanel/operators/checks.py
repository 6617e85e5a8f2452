"""Constraints Spark does not enforce, as counts of offending rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Rows beyond the first of each key."""
    counted = df.groupBy(*keys).agg((F.count(F.lit(1)) - 1).alias("_extra"))
    return counted.agg(F.lit(name).alias("check"), F.coalesce(F.sum("_extra"), F.lit(0)).alias("offending"))


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str, name: str) -> DataFrame:
    """Child rows whose key has no parent.

    Children are counted per key first, so a key with many rows is one row in the join.
    """
    counted = child.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    lost = counted.join(parent, counted[key] == parent[parent_key], "left_anti")
    return lost.agg(F.lit(name).alias("check"), F.coalesce(F.sum("_rows"), F.lit(0)).alias("offending"))


def nulls(df: DataFrame, column: str, name: str) -> DataFrame:
    return df.agg(F.lit(name).alias("check"), F.count_if(F.col(column).isNull()).alias("offending"))


def longer_than(df: DataFrame, column: str, limit: int, name: str) -> DataFrame:
    return df.agg(F.lit(name).alias("check"), F.count_if(F.length(column) > limit).alias("offending"))


def report(checks: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)
