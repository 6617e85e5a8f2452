"""Validation as columns: bad rows are kept aside with a reason, good rows go on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REASON = "reason"


def with_reason(df: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    """Add the message of the first rule a row breaks; NULL for good rows.

    A rule is (message, condition that marks a bad row).
    """
    reason = F.coalesce(*[F.when(F.coalesce(bad, F.lit(False)), F.lit(message)) for message, bad in rules])
    return df.withColumn(REASON, reason)


def split(df: DataFrame, rules: list[tuple[str, Column]]) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantined rows with their reason)."""
    marked = with_reason(df, rules)
    return marked.filter(F.col(REASON).isNull()).drop(REASON), marked.filter(F.col(REASON).isNotNull())


def error_payload(payload: Column, message: Column) -> Column:
    """A string map with the message merged in, the message winning; NULL payload counts as empty."""
    base = F.coalesce(payload, F.create_map().cast("map<string,string>"))
    rest = F.map_filter(base, lambda k, _: k != F.lit("message"))
    return F.map_concat(rest, F.create_map(F.lit("message"), message))


def required(*columns: str) -> list[tuple[str, Column]]:
    return [(f"{c} is missing", F.col(c).isNull()) for c in columns]


def valid_year(column: str, after: int = 2013, latest: Column | None = None) -> tuple[str, Column]:
    """Years must lie above ``after`` and not beyond the current one."""
    bound = F.year(F.current_date()) if latest is None else latest
    return "Invalid year", (F.col(column) <= after) | (F.col(column) > bound)


def too_long(column: str, limit: int) -> tuple[str, Column]:
    return f"{column} longer than {limit}", F.length(column) > limit
