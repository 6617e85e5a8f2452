"""A panel of ranked events derived from the ``lineitem`` table.

Each supplier is an entity; twenty suppliers with consecutive keys form a
field that competes every month. The months of a year are the periods of a
season, the return flag is the session, and the position is the rank by
quantity (whole numbers, so sums are exact) within field, month and session.
A bigger table has more fields, never bigger ones: ranks stay within 1-20.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridpanel.sources.tables import read_inputs

FIELD_SIZE = 20


def results_from_lineitem(spark: SparkSession, folder: str) -> DataFrame:
    (lineitem,) = read_inputs(spark, folder, "lineitem")
    flag = F.col("l_returnflag")
    sessions = [("Race", 0, flag == "R"), ("Qualifying", 4, flag == "N"), ("Sprint", 5, ~flag.isin("R", "N"))]
    # sessions side by side first: one row per entity and month goes through the shuffle
    totals = lineitem.groupBy(
        F.year("l_shipdate").alias("season"),
        F.month("l_shipdate").alias("no"),
        F.col("l_suppkey").alias("driver_number"),
    ).agg(*[F.sum(F.when(chosen, F.col("l_quantity"))).alias(name) for name, _, chosen in sessions])
    entries = F.array(
        *[
            F.struct(F.lit(name).alias("session_name"), F.lit(code).alias("code"), F.col(name).alias("quantity"))
            for name, code, _ in sessions
        ]
    )
    entered = (
        totals.select("season", "no", "driver_number", F.explode(entries).alias("s"))
        .select("season", "no", "driver_number", F.expr(f"driver_number DIV {FIELD_SIZE}").alias("field"), "s.*")
        .filter(F.col("quantity").isNotNull())
    )
    # at most FIELD_SIZE rows per group
    rank = Window.partitionBy("field", "season", "no", "code").orderBy(F.desc("quantity"), "driver_number")
    ranked = entered.withColumn("position", F.row_number().over(rank))
    meeting_id = (F.col("field") * 10_000 + F.col("season")) * 100 + F.col("no")
    return ranked.select(
        (((meeting_id * 10) + F.col("code")) * 100 + F.col("position")).alias("position_id"),
        "driver_number",
        "position",
        "session_name",
        meeting_id.alias("meeting_id"),
        F.concat(F.lit("M"), F.col("no").cast("string"), F.lit("-"), F.col("field").cast("string")).alias(
            "meeting_name"
        ),
        "season",
        "no",
    )
