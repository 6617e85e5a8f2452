"""Scalar helpers over columns: times, offsets, rounding, labels, composite ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def iso_timestamp(ts: Column) -> Column:
    """``2024-05-26T13:00:00``, with ``.ffffff`` only when there are microseconds."""
    text = ts.cast("string")
    whole = F.concat(F.substring(text, 1, 10), F.lit("T"), F.substring(text, 12, 8))
    fraction = F.substring(text, 21, 6)
    return F.when(fraction == "", whole).otherwise(F.concat(whole, F.lit("."), F.rpad(fraction, 6, "0")))


def drop_last_char(text: Column) -> Column:
    return F.left(text, F.greatest(F.length(text) - 1, F.lit(0)))


def date_and_time(date: Column, time_with_zone_letter: Column) -> Column:
    """``2014-03-16`` and ``06:00:00Z`` to a timestamp without zone; NULL if malformed."""
    return F.concat(date, F.lit(" "), drop_last_char(time_with_zone_letter)).try_cast("timestamp_ntz")


def offset_seconds(text: Column) -> Column:
    """``08:00:00`` or ``-05:30:00`` to signed seconds; NULL if malformed."""
    pattern = r"^([+-]?)(\d+):([0-5]\d):([0-5]\d)$"

    def part(i: int) -> Column:
        return F.try_to_number(F.regexp_extract(text, pattern, i), F.lit("999999")).cast("bigint")

    sign = F.when(F.regexp_extract(text, pattern, 1) == "-", -1).otherwise(1)
    return F.when(text.rlike(pattern), sign * (part(2) * 3600 + part(3) * 60 + part(4)))


def parse_offset(text: Column) -> Column:
    """Offset text to an interval."""
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), offset_seconds(text).cast("decimal(18,6)")).cast(
        "interval hour to second"
    )


def interval_micros(interval: Column) -> Column:
    """Length of a day-time interval in microseconds."""
    whole = interval.cast("interval day to second")

    def part(unit: str) -> Column:
        return F.extract(F.lit(unit), whole)

    minutes = (part("DAY").cast("bigint") * 24 + part("HOUR")) * 60 + part("MINUTE")
    return minutes * 60_000_000 + (part("SECOND") * 1_000_000).cast("bigint")


def clock_micros(ts: Column) -> Column:
    """Microseconds of a timestamp without zone since 1970, whatever the session's time zone."""
    return interval_micros(ts - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def interval_text(interval: Column) -> Column:
    """``8:00:00``; negative offsets as ``-5:30:00`` (sign first, not as a negative day)."""
    micros = interval_micros(interval)
    size = F.floor(F.abs(micros) / 1_000_000)
    text = F.concat(
        F.when(micros < 0, F.lit("-")).otherwise(F.lit("")),
        F.format_string("%d:%02d:%02d", F.floor(size / 3600), F.floor(size / 60) % 60, size % 60),
    )
    return F.when(interval.isNotNull(), text)


def round_half_even(x: Column) -> Column:
    return F.bround(x, 0).cast("int")


def composite_id(*parts: Column) -> Column:
    return F.concat(*[p.cast("string") for p in parts])


def membership(position: Column, k: int) -> Column:
    """``IN`` for the first ``k`` places, else ``OUT``."""
    return F.when(position.between(1, k), "IN").otherwise("OUT")


def encode_membership(label: Column) -> Column:
    return F.when(label == "IN", 1).otherwise(0)
