"""Data files: ARFF, point lists and the nested geometry document."""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridpanel.operators import quarantine
from gridpanel.scratch import stage
from gridpanel.sources import schemas
from gridpanel.sources.landing import CORRUPT, read_payload

_ATTRIBUTE = re.compile(r"@attribute\s+('[^']+'|\"[^\"]+\"|\S+)\s+(.+)", re.IGNORECASE)


def arff_schema(spark: SparkSession, path: str, first_lines: int = 200) -> str:
    """DDL schema from the header: numeric attributes as double, nominal ones as string.

    Reads the head of the first file (in name order) until its ``@data`` line.
    """
    files = sorted(spark.read.text(path).inputFiles())
    if not files:
        raise FileNotFoundError(f"no files in {path}")
    lines = spark.read.text(files[0])
    while True:
        head = [row["value"].strip() for row in lines.head(first_lines)]
        ends = [k for k, line in enumerate(head) if line.lower().startswith("@data")]
        if ends or len(head) < first_lines:
            break
        first_lines *= 10
    fields = []
    for match in filter(None, map(_ATTRIBUTE.match, head[: ends[0]] if ends else head)):
        name, kind = match.groups()
        numeric = kind.strip().lower() in {"numeric", "real", "integer"}
        fields.append(f"`{name.strip(chr(39) + chr(34))}` {'double' if numeric else 'string'}")
    return ", ".join(fields)


def arff_rows(lines: DataFrame, schema: str, column: str = "value") -> DataFrame:
    """Typed rows from ARFF text lines; header, comment and blank lines are skipped, ``?`` is NULL."""
    text = F.trim(column)
    data = lines.filter((text != "") & ~F.substring(text, 1, 1).isin("@", "%"))
    options = {"quote": "'", "nullValue": "?", "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true"}
    return data.select(F.from_csv(text, schema, options).alias("r")).select("r.*")


def read_arff(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    return arff_rows(spark.read.text(path), schema or arff_schema(spark, path))


def _quoted(text: Column) -> Column:
    """Values with spaces, commas, quotes or the like in single quotes."""
    inner = F.regexp_replace(F.regexp_replace(text, r"\\", r"\\\\"), "'", r"\\'")
    special = text.rlike(r"[\s,{}%'\"\\?]") | (text == "")
    return F.when(special, F.concat(F.lit("'"), inner, F.lit("'"))).otherwise(text)


def arff_lines(
    df: DataFrame, relation: str, attributes: dict[str, str], order: list[str | Column] | None = None
) -> DataFrame:
    """One ``line`` per header entry and row, sorted so that the header comes first.

    ``attributes`` maps a column to its ARFF type (``NUMERIC`` or ``{ IN, OUT}``).
    Written with ``write_lines`` the part files, read in name order, form the file.
    """
    spark = df.sparkSession
    head = [f"@RELATION {relation}", ""]
    head += [f"@ATTRIBUTE {name} {kind}" for name, kind in attributes.items()]
    head += ["", "@DATA"]
    header = spark.range(1).select(F.posexplode(F.array(*[F.lit(text) for text in head])).alias("_at", "line"))
    header = header.select((F.col("_at") - len(head)).alias("_rank"), "line")
    values = [F.coalesce(_quoted(F.col(c).cast("string")), F.lit("?")) for c in attributes]
    keys = [f"_k{i}" for i in range(len(order or []))]
    rows = df.select(
        F.lit(0).alias("_rank"),
        F.concat_ws(",", *values).alias("line"),
        *[(F.col(o) if isinstance(o, str) else o).alias(k) for o, k in zip(order or [], keys)],
    )
    if not keys:  # the rows stay in their partitions, behind the header's
        return header.coalesce(1).select("line").unionByName(rows.select("line"))
    return (
        header.unionByName(rows, allowMissingColumns=True)
        .repartitionByRange("_rank", *keys)
        .sortWithinPartitions("_rank", *keys)
        .select("line")
    )


def write_lines(lines: DataFrame, path: str) -> None:
    lines.write.mode("errorifexists").text(path)


def read_points_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.POINT_CSV).csv(path)


def read_label_points(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.LABEL_POINTS).option("multiLine", True).json(path)


class Geometry(NamedTuple):
    """Track points, corners and rotations, and the documents that could not be read with a reason."""

    points: DataFrame
    corners: DataFrame
    rotations: DataFrame
    rejected: DataFrame


def geometry_rows(documents: DataFrame) -> Geometry:
    """Rows of geometry documents (``_file``, the document's fields, ``_corrupt``), ``track`` being the file."""
    good, bad = quarantine.split(documents.withColumnRenamed("_file", "track"), [("Unreadable document", F.col(CORRUPT).isNotNull())])
    points = good.select("track", F.posexplode("trackData").alias("ordinal", "p")).select("track", "ordinal", "p.*")
    corners = good.select("track", F.posexplode("cornersData").alias("ordinal", "c")).select("track", "ordinal", "c.*")
    rotations = good.select("track", F.col("circuitInfo.rotation").alias("rotation")).where("rotation is not null")
    return Geometry(points, corners, rotations, bad.select("track", CORRUPT, quarantine.REASON))


def read_geometry(spark: SparkSession, path: str) -> Geometry:
    """Geometry documents, one per file, parsed once."""
    return geometry_rows(stage(read_payload(spark, path, schemas.GEOMETRY_DOCUMENT), "geometry"))
