"""What several corpus operators share: columns, staged tables, held-out folds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridpanel.scratch import stage

__all__ = ["SPACES", "WORD", "fold", "lowered", "packed", "read", "row_id", "stage", "text_bytes"]

#: Fixed value: white space of all contracts, as a character class.
SPACES = "\\x20\\x09-\\x0D"
WORD = f"[^{SPACES}]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo folds; a null id falls into fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds, F.lit(0))


def lowered(text: Column) -> Column:
    """A-Z in lower case, all else as it is (the plain function is used where it does the same)."""
    ascii_only = F.octet_length(text) == F.length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def row_id(doc_id: Column, text: Column) -> Column:
    """Tells rows apart that share a doc_id; equal rows stay equal."""
    return F.xxhash64(doc_id, text)


def text_bytes(docs: DataFrame) -> int:
    """Total size of all texts."""
    return docs.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0]


def packed(docs: DataFrame) -> Column:
    """A row as one struct, so that work beside it can use any column name."""
    return F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in docs.columns])
