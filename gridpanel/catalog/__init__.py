"""Registered queries, each with the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gridpanel.catalog import documents, ingest, panel, reports, tracks, training

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {
    **panel.QUERIES,
    **ingest.QUERIES,
    **documents.QUERIES,
    **reports.QUERIES,
    **tracks.QUERIES,
    **training.QUERIES,
}

SQL: dict[str, str] = {
    **panel.SQL,
    **ingest.SQL,
    **documents.SQL,
    **reports.SQL,
    **tracks.SQL,
    **training.SQL,
}
