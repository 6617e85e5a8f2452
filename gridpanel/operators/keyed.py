"""One row per key: first, last and extreme rows, all with map-side combine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _order(order: list[str]) -> Column:
    return F.struct(*order) if len(order) > 1 else F.col(order[0])


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row that comes first in ``order`` for each key, all columns kept."""
    rest = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(F.min_by(F.struct(*rest), _order(order)).alias("_row"))
        .select(*keys, "_row.*")
        .select(*df.columns)
    )


def last_value(df: DataFrame, keys: list[str], value: str, order: list[str]) -> DataFrame:
    """Last value per key of an ordered event list."""
    return df.groupBy(*keys).agg(F.max_by(value, _order(order)).alias(value))


def fastest(df: DataFrame, keys: list[str], measure: str, tie_break: list[str]) -> DataFrame:
    """The whole row with the smallest measure per key; rows without one do not compete."""
    return first_per_key(df.filter(F.col(measure).isNotNull()), keys, [measure, *tie_break])
