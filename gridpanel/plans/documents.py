"""Stored rows as nested JSON documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpanel.functions.scalars import interval_text, iso_timestamp
from gridpanel.operators.nesting import attach_children, attach_parent
from gridpanel.operators.ordering import index_in_group

_KEEP_NULLS = {"ignoreNullFields": "false"}


def as_json(df: DataFrame, name: str = "document") -> DataFrame:
    """The whole row as one JSON text."""
    return df.select(F.to_json(F.struct(*df.columns), _KEEP_NULLS).alias(name))


def season_documents(plan: DataFrame, meetings: DataFrame) -> DataFrame:
    """Answer requested seasons: per ``serve`` season its meetings as documents, in the order of ``no``
    (``at``: 0, 1, ...; meetings without a number last); per other season one row with its action.

    ``plan`` has (season, action), as ``plans.ingest.seasons_to_load`` gives it.
    """
    served = meetings.join(plan.filter("action = 'serve'").select("season"), "season", "left_semi")
    placed = index_in_group(served, ["season"], [F.col("no").asc_nulls_last(), "meeting_id"], "at")
    documents = placed.select(
        "season", F.lit("serve").alias("action"), "at", F.to_json(F.struct(*meetings.columns), _KEEP_NULLS).alias("document")
    )
    others = plan.filter("action <> 'serve'").select(
        "season", "action", F.lit(None).cast("bigint").alias("at"), F.lit(None).cast("string").alias("document")
    )
    return documents.unionByName(others)


def country_documents(countries: DataFrame, circuits: DataFrame, page_size: int = 1000) -> DataFrame:
    """Countries with their list of circuits, in pages of ``page_size`` circuits."""
    return attach_children(
        countries,
        "country_id",
        circuits.select("country_id", "circuit_id", "circuit_short_name"),
        "country_id",
        ["circuit_id"],
        "circuits",
        page_size,
    )


def circuit_documents(circuits: DataFrame, countries: DataFrame | None = None) -> DataFrame:
    """Flat circuit documents, or with the country nested."""
    if countries is None:
        return circuits.select("circuit_id", "circuit_short_name")
    return attach_parent(circuits, "country_id", countries, "country_id", "country").select(
        "circuit_id", "circuit_short_name", "country"
    )


def meeting_documents(meetings: DataFrame, circuits: DataFrame) -> DataFrame:
    nested = attach_parent(meetings, "circuit_id", circuit_documents(circuits), "circuit_id", "circuit")
    return nested.select(
        "meeting_id",
        "meeting_name",
        "meeting_official_name",
        "circuit",
        iso_timestamp(F.col("date_start")).alias("date_start"),
        interval_text(F.col("gmt_offset")).alias("gmt_offset"),
        "season",
        "no",
    )


def session_documents(sessions: DataFrame, meetings: DataFrame, circuits: DataFrame) -> DataFrame:
    nested = attach_parent(sessions, "meeting_id", meeting_documents(meetings, circuits), "meeting_id", "meeting")
    return nested.select("session_id", "og_session_id", "session_type", "session_name", "meeting")
