"""Model training on the derived panel.

Scores have no SQL; what a study tests, fold by fold, has, and so have whether
each model finds a label planted in the features and whether each solver ends
within its bounds. Folds, training data and settings are those of the whole
studies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridpanel.catalog.panel import panel_sql
from gridpanel.catalog.reports import HASHED, folds_sql
from gridpanel.plans import compare, evaluate, models, panel, splits, studies
from gridpanel.plans.demo_panel import results_from_lineitem

POINTS_FOLDS, ABLATION_FOLDS = 5, 20
#: A model has found the planted label if its accuracy passes the larger class's share by this.
PLANTED_GAIN = 0.05


def _accuracies(counts: DataFrame) -> DataFrame:
    return evaluate.metric_rows(evaluate.accuracy(counts, ["model"]), ["model"])


def model_compare(spark: SparkSession, folder: str) -> DataFrame:
    """Exact finishing position: five models on one hold-out."""
    return _accuracies(studies.finishing_position(results_from_lineitem(spark, folder)))


def svm_kernel_features(spark: SparkSession, folder: str) -> DataFrame:
    results = results_from_lineitem(spark, folder)
    return _accuracies(studies.finishing_position(results, ("kernel_svm",)))


def gbt_regress_round(spark: SparkSession, folder: str) -> DataFrame:
    """Boosted regression, rounded half to even: how often each predicted position was right."""
    counts = studies.finishing_position(results_from_lineitem(spark, folder), ("boosted_regression",))
    return counts.groupBy("model", "prediction").agg(
        F.sum("n").alias("predicted"),
        F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)).alias("hits"),
    )


def svm_linear(spark: SparkSession, folder: str) -> DataFrame:
    """Top ten by a linear SVM on scaled features, on one hold-out."""
    rows = panel.labelled(panel.feature_panel(results_from_lineitem(spark, folder)), studies.POINTS)
    counts = compare.on_holdout(rows, studies.WITH_SPRINT, ("linear_svm",), models.Settings(svm_c=1.2))
    return evaluate.classification_report(counts, ["model"])


def points_folds(spark: SparkSession, folder: str) -> DataFrame:
    """Top ten: four models over expanding-window folds, report of the last one."""
    results = results_from_lineitem(spark, folder)
    counts = studies.points_finish(results, POINTS_FOLDS)
    return compare.final_report(counts, POINTS_FOLDS)


def points_fold_support(spark: SparkSession, folder: str) -> DataFrame:
    """What every model of the top-ten study was tested on: rows and positives per fold."""
    results = results_from_lineitem(spark, folder)
    counts = studies.points_finish(results, POINTS_FOLDS)
    positives = F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0))
    return counts.groupBy("fold", "model").agg(F.sum("n").alias("test_rows"), positives.alias("positives"))


def _found(counts: DataFrame, by: list[str]) -> DataFrame:
    """Whether a model does better than naming the largest class, by PLANTED_GAIN of the test rows."""
    classes = counts.groupBy(*by, "label").agg(F.sum("n").alias("of_class"), F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)).alias("hits"))
    tested = F.sum("of_class")
    return classes.groupBy(*by).agg(tested.alias("test_rows"), (F.sum("hits") >= F.max("of_class") + PLANTED_GAIN * tested).alias("found"))


def _planted(spark: SparkSession, folder: str, label: Column) -> DataFrame:
    rows = panel.feature_panel(results_from_lineitem(spark, folder))
    return rows.withColumn("label", label.cast("double"))


def _planted_folds(spark: SparkSession, folder: str, count: int) -> splits.Folds:
    return splits.expanding_window(_planted(spark, folder, F.col("qualy_pos").between(1, 5)), count, panel.SORT)


def planted_folds(spark: SparkSession, folder: str) -> DataFrame:
    """The top-ten study on a label that follows from the features (qualified among the first five)."""
    folds = _planted_folds(spark, folder, POINTS_FOLDS)
    counts = compare.over_folds(folds, {"base+sprint": studies.WITH_SPRINT}, settings=models.Settings(svm_c=1.2))
    positives = F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0))
    by = ["fold", "model"]
    return _found(counts, by).join(counts.groupBy(*by).agg(positives.alias("positives")), by)


def planted_ablation(spark: SparkSession, folder: str) -> DataFrame:
    """The podium study (320 fits) on the planted label: every model of every feature set and fold finds it."""
    counts = compare.over_folds(_planted_folds(spark, folder, ABLATION_FOLDS), models.FEATURE_SETS)
    return _found(counts, ["feature_set", "fold", "model"])


def planted_positions(spark: SparkSession, folder: str) -> DataFrame:
    """The five models of the finishing-position study on six bands of the qualifying position."""
    counts = compare.on_holdout(_planted(spark, folder, F.floor((F.col("qualy_pos") - 1) / 4)), studies.WITH_SPRINT)
    return _found(counts, ["model"])


def planted_ring(spark: SparkSession, folder: str) -> DataFrame:
    """Kernel SVM on a label no linear model can find: qualified in the middle of the field."""
    middle = F.col("qualy_pos").between(7, 15)
    counts = compare.on_holdout(_planted(spark, folder, middle), studies.WITH_SPRINT, ("kernel_svm",))
    return _found(counts, ["model"])


def solver_certificates(spark: SparkSession, folder: str) -> DataFrame:
    """How the linear models of the podium study end: gradients and duality gaps within their bounds, on all training rows."""
    rows = panel.labelled(panel.feature_panel(results_from_lineitem(spark, folder)), studies.POINTS)
    study = compare.fold_study(splits.expanding_window(rows, ABLATION_FOLDS, panel.SORT), models.FEATURE_SETS, ("logistic", "linear_svm"))
    compare.run(study)
    return compare.certificates(study).select("feature_set", "fold", "model", "train_rows", "converged")


def ablation(spark: SparkSession, folder: str) -> DataFrame:
    """Podium: four feature sets, four models, mean accuracy over the study's twenty folds."""
    results = results_from_lineitem(spark, folder)
    return compare.mean_accuracy(studies.podium_finish(results))


QUERIES = {
    "model_compare": model_compare,
    "svm_kernel_features": svm_kernel_features,
    "gbt_regress_round": gbt_regress_round,
    "svm_linear": svm_linear,
    "points_folds": points_folds,
    "points_fold_support": points_fold_support,
    "planted_folds": planted_folds,
    "planted_ablation": planted_ablation,
    "planted_positions": planted_positions,
    "planted_ring": planted_ring,
    "solver_certificates": solver_certificates,
    "ablation": ablation,
}

SQL = {
    "points_fold_support": folds_sql(POINTS_FOLDS)
    + """
SELECT test_fold AS fold, model, count(*) AS test_rows, CAST(sum(label) AS BIGINT) AS positives
FROM folds CROSS JOIN (SELECT unnest(['logistic', 'forest', 'linear_svm', 'boosted']) AS model)
WHERE test_fold > 0 GROUP BY ALL""",
    "planted_folds": folds_sql(POINTS_FOLDS)
    + """
SELECT test_fold AS fold, model, count(*) AS test_rows,
       count(*) FILTER (WHERE qualy_pos BETWEEN 1 AND 5) AS positives, true AS found
FROM folds CROSS JOIN (SELECT unnest(['logistic', 'forest', 'linear_svm', 'boosted']) AS model)
WHERE test_fold > 0 GROUP BY ALL""",
    "planted_ablation": folds_sql(ABLATION_FOLDS)
    + """
SELECT feature_set, test_fold AS fold, model, count(*) AS test_rows, true AS found
FROM folds CROSS JOIN (SELECT unnest(['logistic', 'forest', 'linear_svm', 'boosted']) AS model)
     CROSS JOIN (SELECT unnest(['base', 'base+gain', 'base+sprint', 'base+gain+sprint']) AS feature_set)
WHERE test_fold > 0 GROUP BY ALL""",
    "planted_positions": panel_sql()
    + f"""
SELECT model, count(*) AS test_rows, true AS found
FROM panel CROSS JOIN (SELECT unnest(['multinomial', 'tree', 'forest', 'boosted_regression', 'kernel_svm']) AS model)
WHERE {HASHED.format(key="position_id")} GROUP BY model""",
    "planted_ring": panel_sql()
    + f"""
SELECT 'kernel_svm' AS model, count(*) AS test_rows, true AS found FROM panel WHERE {HASHED.format(key="position_id")}""",
    "solver_certificates": folds_sql(ABLATION_FOLDS)
    + f"""
SELECT feature_set, f.fold, model, count(*) AS train_rows, true AS converged
FROM folds CROSS JOIN (SELECT CAST(unnest(range(1, {ABLATION_FOLDS + 1})) AS INTEGER) AS fold) f
     CROSS JOIN (SELECT unnest(['logistic', 'linear_svm']) AS model)
     CROSS JOIN (SELECT unnest(['base', 'base+gain', 'base+sprint', 'base+gain+sprint']) AS feature_set)
WHERE test_fold < f.fold GROUP BY ALL""",
}
