"""Points that fall into intervals of the same key (lap and telemetry)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridpanel.functions.scalars import clock_micros


def _micros(column: str) -> Column:
    return clock_micros(F.col(column))


def slice_by_interval(points: DataFrame, laps: DataFrame, keys: list[str], ts: str, start: str, end: str) -> DataFrame:
    """Join points to the laps with ``start <= ts < end``.

    Time is cut into steps as long as the lap, rounded up to a power of two
    microseconds (its level), and the join is a plain equality on
    (keys, level, step). A lap touches two steps at most, a point appears once
    per level that laps of its own keys have, so laps of any mix of lengths
    stay cheap, points meet only laps near in time, and one busy key spreads
    over many tasks.
    """
    level = F.ceil(F.log2((_micros(end) - _micros(start)).cast("double"))).cast("int")
    sized = laps.filter(F.col(start) < F.col(end)).withColumn("_level", level)
    # at most 63 different levels for each key
    levels = sized.groupBy(*keys).agg(F.collect_set("_level").alias("_levels"))
    spread = (
        sized.withColumns({"_from": _micros(start), "_to": _micros(end) - 1})
        .withColumn("_step", F.explode(F.expr("sequence(shiftright(_from, _level), shiftright(_to, _level))")))
        .drop("_from", "_to")
    )
    placed = (
        points.join(levels, keys)
        .withColumns({"_at": _micros(ts), "_level": F.explode("_levels")})
        .withColumn("_step", F.expr("shiftright(_at, _level)"))
        .drop("_at", "_levels")
    )
    return (
        placed.join(spread, [*keys, "_level", "_step"])
        .filter((F.col(ts) >= F.col(start)) & (F.col(ts) < F.col(end)))
        .drop("_level", "_step")
    )
