"""Positions in a total order without pulling the data into one task.

``row_number()`` over an empty partition spec, or over one hot group, sorts
everything in a single task. Here the rows are range-partitioned on the whole
sort key, so every task holds an even slice, and the slices' row counts (one
row per shuffle partition) turn local numbers into global ones.

The sort key must be a total order: end it with a unique column. Equal keys
land in one slice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridpanel.scratch import stage

# monotonically_increasing_id() keeps the row's number within its partition in
# the low 33 bits and the partition number above them (documented layout).
_LOCAL_BITS = 33
_LOCAL_MASK = (1 << _LOCAL_BITS) - 1


def ordered_index(df: DataFrame, order: list[str | Column], name: str = "row_index") -> DataFrame:
    """Add the zero-based position of each row in the order given by ``order``."""
    slices = stage(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_slot", F.monotonically_increasing_id()),
        "ordered",
    ).withColumn("_slice", F.shiftright("_slot", _LOCAL_BITS))
    earlier = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    # one row per shuffle partition, however large the data
    offsets = (
        slices.groupBy("_slice")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_slice", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    )
    return (
        slices.join(F.broadcast(offsets), "_slice")
        .withColumn(name, F.col("_before") + F.col("_slot").bitwiseAND(F.lit(_LOCAL_MASK)))
        .drop("_slice", "_slot", "_before")
    )


def index_in_group(
    df: DataFrame, group: list[str], order: list[str | Column], name: str = "row_index"
) -> DataFrame:
    """Zero-based position within each group, for groups of any size.

    The group's first global position is subtracted; that table (one row per
    group) is staged, so it is broadcast only when its files are small.
    """
    placed = ordered_index(df, [*group, *order], "_at")
    firsts = stage(placed.groupBy(*group).agg(F.min("_at").alias("_first")), "firsts")
    keys = [placed[g].eqNullSafe(firsts[g]) for g in group]
    joined = placed.join(firsts, keys)
    kept = [placed[c] for c in df.columns]
    return joined.select(*kept, (F.col("_at") - F.col("_first")).alias(name))


def previous_row(
    df: DataFrame, group: list[str], order: list[str | Column], columns: list[str], block_rows: int = 65_536
) -> DataFrame:
    """Add ``prev_<c>`` from the row before, within the group; NULL on its first row.

    Works on blocks of ``block_rows`` consecutive rows, each given a copy of
    the last row before it, so no task depends on the size of a group.
    """
    placed = ordered_index(df, [*group, *order], "_at")
    home = F.floor(F.col("_at") / F.lit(block_rows))
    reach = F.floor((F.col("_at") + 1) / F.lit(block_rows))
    spread = placed.withColumn("_block", F.explode(F.sequence(home, reach))).withColumn(
        "_home", F.col("_block") == home
    )
    w = Window.partitionBy("_block").orderBy("_at")
    same = F.lit(True)
    for g in group:
        same = same & F.lag(g).over(w).eqNullSafe(F.col(g))
    added = [F.when(same, F.lag(c).over(w)).alias(f"prev_{c}") for c in columns]
    return spread.select(*df.columns, "_home", *added).filter("_home").drop("_home")
