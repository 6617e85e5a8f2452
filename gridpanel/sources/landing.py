"""Landed API payloads to typed rows.

Each payload file is one JSON document or array (``multiLine``), so files are
the unit of parallelism; JSON-lines landings split freely (``lines=True``).
A payload fetched per key lies in a folder named after it
(``meeting_key=1219/...``), and the key comes from the path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridpanel.sources import schemas

CORRUPT = "_corrupt"


def read_payload(spark: SparkSession, path: str, schema: str, lines: bool = False) -> DataFrame:
    """Payload rows with the file they came from; malformed ones keep their text in ``_corrupt``."""
    return (
        spark.read.schema(f"{schema}, {CORRUPT} string")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("multiLine", not lines)
        .json(path)
        .withColumn("_file", F.col("_metadata.file_path"))
    )


def parse_documents(texts: DataFrame, schema: str) -> DataFrame:
    """Documents that are held as text (``_file``, ``value``), as ``read_payload`` gives those of files.

    A text that is no document of the schema keeps its text in ``_corrupt``, also
    where single fields have drifted to another type; the fields that fit are read.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = texts.select("_file", F.from_json("value", f"{schema}, {CORRUPT} string", options).alias("_document"), "value")
    # from_json has no document at all for a null text
    missing = F.when(F.col("value").isNull(), F.lit(""))
    names = [c for c in parsed.schema["_document"].dataType.names if c != CORRUPT]
    return parsed.select("_file", *[F.col(f"_document.{c}").alias(c) for c in names], F.coalesce(f"_document.{CORRUPT}", missing).alias(CORRUPT))


def _in_document_order(payload: DataFrame) -> DataFrame:
    # rows of one file stay together and in order, so within a file the id is the place in the array
    return payload.withColumn("ordinal", F.monotonically_increasing_id())


def read_meetings(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Flat array of meetings; document order is (``_file``, ``ordinal``)."""
    return _in_document_order(read_payload(spark, path, schemas.MEETING_PAYLOAD, lines))


def read_sessions(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Sessions of each meeting, from ``meeting_key=<id>`` folders."""
    return _in_document_order(read_payload(spark, path, f"{schemas.SESSION_PAYLOAD}, meeting_key bigint", lines))


def read_position_events(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Ordered position events of each session, from ``session_key=<id>`` folders."""
    return _in_document_order(read_payload(spark, path, f"{schemas.POSITION_PAYLOAD}, session_key bigint", lines))


def _elements(documents: DataFrame, array: str, name: str) -> DataFrame:
    """``_file``, ``ordinal``, the array's elements; an unreadable document is one row with ``_corrupt`` and nothing else."""
    corrupt = [CORRUPT] if CORRUPT in documents.columns else []
    rows = documents.select("_file", *corrupt, F.posexplode_outer(array).alias("ordinal", name))
    there = F.col(name).isNotNull()
    return rows.filter(there | F.col(CORRUPT).isNotNull() if corrupt else there)


def _kept(documents: DataFrame) -> list[str]:
    return ["_file", "ordinal", *([CORRUPT] if CORRUPT in documents.columns else [])]


def circuit_rows(documents: DataFrame) -> DataFrame:
    """Circuits array of nested circuit documents (``_file``, ``MRData``)."""
    return _elements(documents, "MRData.CircuitTable.Circuits", "c").select(
        F.col("c.circuitId").alias("external_id"),
        F.col("c.circuitName").alias("circuit_name"),
        F.col("c.Location.country").alias("country_name"),
        *_kept(documents),
    )


def race_rows(documents: DataFrame) -> DataFrame:
    """Races array of nested season documents, optional sub-documents kept as structs."""
    return _elements(documents, "MRData.RaceTable.Races", "r").select(
        F.expr("try_cast(r.season AS int)").alias("season"),
        F.expr("try_cast(r.round AS int)").alias("round"),
        F.col("r.raceName").alias("race_name"),
        F.col("r.date").alias("date"),
        F.col("r.time").alias("time"),
        F.col("r.Circuit.circuitId").alias("external_id"),
        F.col("r.FirstPractice").alias("first_practice"),
        F.col("r.SecondPractice").alias("second_practice"),
        F.col("r.ThirdPractice").alias("third_practice"),
        F.col("r.Sprint").alias("sprint"),
        *_kept(documents),
    )


def qualifying_rows(documents: DataFrame) -> DataFrame:
    """Races, then results, of doubly nested qualifying documents."""
    races = _elements(documents, "MRData.RaceTable.Races", "r").drop("ordinal")
    results = races.select("*", F.posexplode_outer("r.QualifyingResults").alias("ordinal", "q"))
    there = F.col("q").isNotNull()
    corrupt = CORRUPT in documents.columns
    return results.filter(there | F.col(CORRUPT).isNotNull() if corrupt else there).select(
        F.expr("try_cast(r.season AS int)").alias("season"),
        F.expr("try_cast(r.round AS int)").alias("round"),
        F.expr("try_cast(q.number AS int)").alias("driver_number"),
        F.expr("try_cast(q.position AS int)").alias("position"),
        *_kept(documents),
    )


def read_circuits(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    return circuit_rows(read_payload(spark, path, schemas.CIRCUIT_DOCUMENT, lines))


def read_races(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    return race_rows(read_payload(spark, path, schemas.RACE_DOCUMENT, lines))


def read_qualifying(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    return qualifying_rows(read_payload(spark, path, schemas.QUALIFYING_DOCUMENT, lines))
