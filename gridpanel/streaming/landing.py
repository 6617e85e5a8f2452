"""Position payloads that keep landing, loaded as they come.

``load_new_positions`` is the keyed load of the batch plan, run on the files that
arrived since the last run. The query's checkpoint remembers the files; a batch
that is repeated after a failure adds nothing, because stored keys are skipped.
What cannot be stored is written to ``positions_rejected`` with its reason.

``load_settled_positions`` keeps the last position of every entity in a state
store until no file of its session has come for some time, so that a later file
can still revise it before it is stored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gridpanel.plans.ingest import load_final_positions
from gridpanel.sources import schemas
from gridpanel.sources.landing import CORRUPT
from gridpanel.sources.tables import append, read_table


def load_new_positions(spark: SparkSession, landing: str, tables: str, checkpoint: str) -> StreamingQuery:
    """Start a run over all files not yet seen; it ends by itself."""
    payload = (
        spark.readStream.schema(f"{schemas.POSITION_PAYLOAD}, session_key bigint, {CORRUPT} string")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("multiLine", True)
        .json(landing)
        .withColumn("_file", F.col("_metadata.file_path"))
    )

    def load(batch: DataFrame, number: int) -> None:
        _store(spark, tables, batch.withColumn("ordinal", F.monotonically_increasing_id()), number)

    return payload.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _store(spark: SparkSession, tables: str, batch: DataFrame, number: int) -> None:
    stored = read_table(spark, tables, "positions")
    loaded = load_final_positions(batch, read_table(spark, tables, "sessions"), stored, small_batch=True)
    append(loaded.rows, tables, "positions")
    # a file per batch, replaced if the batch is repeated
    loaded.rejected.write.mode("overwrite").parquet(f"{tables}/positions_rejected/batch={number}")


def settled_positions(events: DataFrame, quiet: str, delay: str = "0 seconds") -> DataFrame:
    """Last position per (session_key, driver_number) of a stream, once no file of it has come for ``quiet``.

    events: session_key, driver_number, position, arrived (timestamp), ordinal
    (place in its file). State is kept per entity and session and dropped when the
    watermark, ``delay`` behind the newest arrival, passes the end of the quiet time.
    """
    timed = events.withWatermark("arrived", delay)
    place = F.struct("arrived", "ordinal")
    grouped = timed.groupBy(F.session_window("arrived", quiet), "session_key", "driver_number")
    return grouped.agg(F.max_by("position", place).alias("position"), F.max("arrived").alias("arrived")).drop("session_window")


def position_events(spark: SparkSession, landing: str) -> DataFrame:
    """A stream of the rows of landed position files, with the time their file was written and their place in it."""
    files = spark.readStream.schema("value string, session_key bigint").option("wholetext", True).text(landing)
    kind = f"array<struct<{schemas.POSITION_PAYLOAD}>>"
    # a file that cannot be read is one row without a driver, which the load keeps aside
    array = F.coalesce(F.from_json("value", kind), F.from_json(F.lit("[{}]"), kind))
    rows = files.select("session_key", F.col("_metadata.file_modification_time").alias("arrived"), F.posexplode(array).alias("ordinal", "p"))
    return rows.select("session_key", "arrived", "ordinal", "p.*")


def load_settled_positions(spark: SparkSession, landing: str, tables: str, checkpoint: str, quiet: str = "6 hours") -> StreamingQuery:
    """Start a run over all files not yet seen; sessions that have been quiet for long enough are stored, each with its last positions."""
    settled = settled_positions(position_events(spark, landing), quiet)

    def load(batch: DataFrame, number: int) -> None:
        rows = batch.select("driver_number", "position", "session_key", F.lit(None).cast("string").alias(CORRUPT), F.lit("settled").alias("_file"), F.lit(0).cast("bigint").alias("ordinal"))
        _store(spark, tables, rows, number)

    return (
        settled.writeStream.outputMode("append")
        .foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
