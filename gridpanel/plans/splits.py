"""Hold-out and expanding-window splits."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridpanel.operators.ordering import ordered_index
from gridpanel.scratch import stage


def holdout(df: DataFrame, key: str, test_percent: int = 20, seed: int = 42) -> DataFrame:
    """Add ``part`` (train / test) from a mixing hash of a key, of any type that has a text form.

    The same key always falls on the same side, on any cluster and after any
    retry, and the side says nothing about the digits of the key.
    """
    digest = F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))))
    number = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return df.withColumn("part", F.when(number % 100 < test_percent, "test").otherwise("train"))


class Folds(NamedTuple):
    """Rows with ``row_index`` and ``test_fold``, and the numbers the folds follow from."""

    rows: DataFrame
    total: int
    test_size: int
    count: int

    def first_test_row(self, fold: int) -> int:
        return self.total - (self.count - fold + 1) * self.test_size

    def train(self, fold: int) -> DataFrame:
        return self.rows.filter(F.col("test_fold") < fold)

    def test(self, fold: int) -> DataFrame:
        return self.rows.filter(F.col("test_fold") == fold)


def fold_of(row_index: Column, total: int, folds: int) -> Column:
    """Fold that tests a row (1..folds), 0 for the rows that only train.

    A row trains in every later fold, so this one number holds all memberships.
    """
    size = total // (folds + 1)
    start = total - folds * size
    return F.when(row_index < start, 0).otherwise(F.floor((row_index - start) / F.lit(size)) + 1).cast("int")


def expanding_window(df: DataFrame, folds: int, order: list[str]) -> Folds:
    """Cut ordered rows into ``folds`` equal tail blocks, each tested on all rows before it.

    ``order`` must end in a unique column.
    """
    placed = ordered_index(df, order)
    total = placed.count()
    size = total // (folds + 1)
    if size == 0:
        raise ValueError(f"{folds} folds need at least {folds + 1} rows, found {total}")
    return Folds(placed.withColumn("test_fold", fold_of(F.col("row_index"), total, folds)), total, size, folds)


def unsplit(folds: Folds, together: list[str]) -> Folds:
    """The same folds with edges moved to the ends of groups, such as races: a group is tested where its first row is.

    A fold can become empty when a group is longer than it. Groups may be of any
    size: one number per group is joined back, and null keys are a group like others.
    """
    firsts = stage(folds.rows.groupBy(*together).agg(F.min("test_fold").alias("_fold")), "first-folds")
    same = [folds.rows[c].eqNullSafe(firsts[c]) for c in together]
    kept = [folds.rows[c] for c in folds.rows.columns if c != "test_fold"]
    return folds._replace(rows=folds.rows.join(firsts, same).select(*kept, F.col("_fold").alias("test_fold")))
