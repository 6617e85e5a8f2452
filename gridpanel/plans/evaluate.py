"""Accuracy and per-class reports as tables.

Everything is computed from confusion counts, which are combined map-side:
their size is set by the number of classes, not by the number of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def confusion(predictions: DataFrame, by: list[str]) -> DataFrame:
    return predictions.groupBy(*by, "label", "prediction").agg(F.count(F.lit(1)).alias("n"))


def accuracy(counts: DataFrame, by: list[str]) -> DataFrame:
    hit = F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0))
    return counts.groupBy(*by).agg((hit / F.sum("n")).alias("accuracy"), F.sum("n").alias("support"))


def fold_mean(per_fold: DataFrame, by: list[str]) -> DataFrame:
    """Mean accuracy over folds, each fold counting the same."""
    return per_fold.groupBy(*by).agg(F.avg("accuracy").alias("accuracy"), F.count(F.lit(1)).alias("folds"))


def _ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))


def per_class(counts: DataFrame, by: list[str]) -> DataFrame:
    """Precision, recall, F1 and support of every class that occurs as label or prediction."""
    sides = F.array(
        F.struct(
            F.col("label").alias("class"),
            F.col("n").alias("support"),
            F.lit(0).cast("bigint").alias("predicted"),
            F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).alias("hit"),
        ),
        F.struct(
            F.col("prediction").alias("class"),
            F.lit(0).cast("bigint").alias("support"),
            F.col("n").alias("predicted"),
            F.lit(0).cast("bigint").alias("hit"),
        ),
    )
    sums = (
        counts.select(*by, F.explode(sides).alias("s"))
        .select(*by, "s.*")
        .groupBy(*by, "class")
        .agg(F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("hit").alias("hit"))
    )
    precision = _ratio(F.col("hit"), F.col("predicted"))
    recall = _ratio(F.col("hit"), F.col("support"))
    return sums.select(
        *by,
        "class",
        precision.alias("precision"),
        recall.alias("recall"),
        _ratio(2.0 * F.col("hit"), F.col("predicted") + F.col("support")).alias("f1_score"),
        "support",
    )


def classification_report(counts: DataFrame, by: list[str]) -> DataFrame:
    """Per-class rows plus ``accuracy``, ``macro avg`` and ``weighted avg``.

    The accuracy row repeats its value: over all classes at once, precision, recall and F1 equal it.
    """
    classes = per_class(counts, by)
    metrics = ["precision", "recall", "f1_score"]

    def weighted(m: str) -> Column:
        return F.sum(F.col(m) * F.col("support")) / F.sum("support")

    macro = classes.groupBy(*by).agg(*[F.avg(m).alias(m) for m in metrics], F.sum("support").alias("support"))
    weight = classes.groupBy(*by).agg(*[weighted(m).alias(m) for m in metrics], F.sum("support").alias("support"))
    overall = accuracy(counts, by).select(
        *by,
        *[F.col("accuracy").alias(m) for m in metrics],
        "support",
    )
    columns = [*by, "class", *metrics, "support"]
    rows = classes.withColumn("class", F.col("class").cast("int").cast("string")).select(*columns)
    for name, table in [("accuracy", overall), ("macro avg", macro), ("weighted avg", weight)]:
        rows = rows.unionByName(table.withColumn("class", F.lit(name)).select(*columns))
    return rows


def last_fold(counts: DataFrame, folds: int) -> DataFrame:
    """Counts of the last fold, the one the printed report is made from."""
    return counts.filter(F.col("fold") == folds)


def metric_rows(accuracies: DataFrame, by: list[str]) -> DataFrame:
    """Long form: one (metric, value) row per line that would be printed."""
    return accuracies.select(*by, F.lit("accuracy").alias("metric"), F.col("accuracy").alias("value"))
