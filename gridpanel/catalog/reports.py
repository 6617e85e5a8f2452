"""Splits, scaling and reports with a rule as the predictor."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridpanel.catalog.panel import panel_sql
from gridpanel.plans import evaluate, models, panel, splits
from gridpanel.plans.demo_panel import results_from_lineitem
from gridpanel.scratch import stage
from gridpanel.sources.tables import read_inputs

FOLDS = 5
TOP = 10


def _folds(spark: SparkSession, folder: str, count: int = FOLDS) -> splits.Folds:
    marked = panel.labelled(panel.feature_panel(results_from_lineitem(spark, folder)), TOP)
    return splits.expanding_window(marked.select("position_id", "label", "qualy_pos", *panel.SORT), count, panel.SORT)


def expanding_window_folds(spark: SparkSession, folder: str) -> DataFrame:
    return _folds(spark, folder).rows.select("position_id", "row_index", "test_fold")


def fold_sizes(spark: SparkSession, folder: str) -> DataFrame:
    """Train and test rows, and positives among them, of every one of twenty folds."""
    folds = _folds(spark, folder, 20)
    tested = folds.rows.groupBy("test_fold").agg(
        F.count(F.lit(1)).alias("rows_here"), F.sum(F.col("label").cast("bigint")).alias("positives_here")
    )
    # at most folds + 1 rows from here on
    later = tested.select(
        F.explode(F.sequence(F.col("test_fold"), F.lit(folds.count))).alias("fold"),
        "test_fold",
        "rows_here",
        "positives_here",
    )
    inside = F.col("test_fold") == F.col("fold")
    return (
        later.filter(F.col("fold") > 0)
        .groupBy("fold")
        .agg(
            F.sum(F.when(~inside, F.col("rows_here"))).alias("train_rows"),
            F.sum(F.when(inside, F.col("rows_here"))).alias("test_rows"),
            F.sum(F.when(~inside, F.col("positives_here"))).alias("train_positives"),
            F.sum(F.when(inside, F.col("positives_here"))).alias("test_positives"),
        )
    )


def race_folds(spark: SparkSession, folder: str) -> DataFrame:
    """Folds whose edges lie between races: none is split between training and test rows."""
    folds = splits.unsplit(_folds(spark, folder), ["season", "no"])
    return folds.rows.select("position_id", "test_fold")


def hash_holdout_split(spark: SparkSession, folder: str) -> DataFrame:
    (orders,) = read_inputs(spark, folder, "orders")
    return splits.holdout(orders.select("o_orderkey", "o_orderpriority"), "o_orderkey")


def standard_scaling(spark: SparkSession, folder: str) -> DataFrame:
    """Panel features scaled with the statistics of the training rows."""
    features = models.FEATURE_SETS["base+gain+sprint"]
    built = panel.feature_panel(results_from_lineitem(spark, folder)).select("position_id", *features)
    rows = stage(splits.holdout(built, "position_id"), "scaling")
    scaling = models.fit_scaling(rows.filter("part = 'train'"), features)
    return rows.select(
        "position_id", "part", *[(F.round(scaling.scaled(f), 6) + 0.0).alias(f"{f}_scaled") for f in features]
    )


def _rule_counts(folds: splits.Folds) -> DataFrame:
    predicted = folds.rows.filter(F.col("test_fold") > 0).select(
        F.col("test_fold").alias("fold"),
        "label",
        F.when(F.col("qualy_pos") <= TOP, 1.0).otherwise(0.0).alias("prediction"),
    )
    return stage(evaluate.confusion(predicted, ["fold"]), "confusion")


def rule_accuracy(spark: SparkSession, folder: str) -> DataFrame:
    """Accuracy per fold of the rule "qualified in the top ten", and its mean as fold 0."""
    per_fold = evaluate.accuracy(_rule_counts(_folds(spark, folder)), ["fold"])
    mean = evaluate.fold_mean(per_fold, []).select(
        F.lit(0).alias("fold"), F.round("accuracy", 6).alias("accuracy"), F.col("folds").alias("support")
    )
    return per_fold.select("fold", F.round("accuracy", 6).alias("accuracy"), "support").unionByName(mean)


def classification_report(spark: SparkSession, folder: str) -> DataFrame:
    """Per-class report of the last fold for the same rule."""
    counts = evaluate.last_fold(_rule_counts(_folds(spark, folder)), FOLDS)
    report = evaluate.classification_report(counts, ["fold"])
    rounded = [F.round(m, 6).alias(m) for m in ("precision", "recall", "f1_score")]
    return report.select("fold", "class", *rounded, "support")


def position_report(spark: SparkSession, folder: str) -> DataFrame:
    """Per-class report with the finishing position as class and the qualifying one as prediction."""
    rows = panel.feature_panel(results_from_lineitem(spark, folder))
    predicted = rows.select(F.col("position").alias("label"), F.col("qualy_pos").alias("prediction"))
    report = evaluate.classification_report(stage(evaluate.confusion(predicted, []), "confusion"), [])
    rounded = [F.round(m, 6).alias(m) for m in ("precision", "recall", "f1_score")]
    return report.select("class", *rounded, "support")


QUERIES = {
    "expanding_window_folds": expanding_window_folds,
    "fold_sizes": fold_sizes,
    "race_folds": race_folds,
    "hash_holdout_split": hash_holdout_split,
    "standard_scaling": standard_scaling,
    "rule_accuracy": rule_accuracy,
    "classification_report": classification_report,
    "position_report": position_report,
}

# -- checks --------------------------------------------------------------------


def folds_sql(folds: int) -> str:
    return (
        panel_sql()
        + f""",
placed AS (
  SELECT *, row_number() OVER (ORDER BY season, no, position, driver_number) - 1 AS row_index,
         count(*) OVER () AS total, count(*) OVER () // {folds + 1} AS size,
         CASE WHEN position <= {TOP} THEN 1 ELSE 0 END AS label
  FROM panel
),
folds AS (
  SELECT *, CAST(CASE WHEN row_index < total - {folds} * size THEN 0
                      ELSE (row_index - (total - {folds} * size)) // size + 1 END AS INTEGER) AS test_fold
  FROM placed
)
"""
    )


def _report_sql(counts: str, key: str) -> str:
    """Report over a relation ``counts(label, prediction, n)``; ``key`` is a leading constant column."""
    return f"""
counts AS ({counts}),
classes AS (
  SELECT class, coalesce(sum(n) FILTER (WHERE label = class), 0) AS support,
         coalesce(sum(n) FILTER (WHERE prediction = class), 0) AS predicted,
         coalesce(sum(n) FILTER (WHERE label = class AND prediction = class), 0) AS hit
  FROM counts JOIN (SELECT label AS class FROM counts UNION SELECT prediction FROM counts) c
    ON c.class = label OR c.class = prediction
  GROUP BY class
),
scored AS (
  SELECT class, support, CASE WHEN predicted = 0 THEN 0 ELSE hit / predicted END AS p,
         CASE WHEN support = 0 THEN 0 ELSE hit / support END AS r, 2 * hit / (predicted + support) AS f
  FROM classes
),
overall AS (SELECT sum(n) FILTER (WHERE label = prediction) / sum(n) AS a, sum(n) AS support FROM counts)
SELECT {key} CAST(CAST(class AS INTEGER) AS VARCHAR) AS class, round(p, 6) AS precision, round(r, 6) AS recall,
       round(f, 6) AS f1_score, CAST(support AS BIGINT) AS support FROM scored
UNION ALL SELECT {key} 'accuracy', round(a, 6), round(a, 6), round(a, 6), CAST(support AS BIGINT) FROM overall
UNION ALL SELECT {key} 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), CAST(sum(support) AS BIGINT)
  FROM scored
UNION ALL SELECT {key} 'weighted avg', round(sum(p * support) / sum(support), 6),
  round(sum(r * support) / sum(support), 6), round(sum(f * support) / sum(support), 6), CAST(sum(support) AS BIGINT)
  FROM scored"""


_SCALED = ["previous_race_pos", "previous_year_pos", "qualy_pos", "gain", "sprint_pos"]
HASHED = "CAST('0x' || left(md5({key} || ':42'), 8) AS BIGINT) % 100 < 20"

SQL = {
    "expanding_window_folds": folds_sql(FOLDS) + "SELECT position_id, row_index, test_fold FROM folds",
    "fold_sizes": folds_sql(20)
    + """
SELECT f.fold, count(*) FILTER (WHERE test_fold < f.fold) AS train_rows,
       count(*) FILTER (WHERE test_fold = f.fold) AS test_rows,
       CAST(sum(label) FILTER (WHERE test_fold < f.fold) AS BIGINT) AS train_positives,
       CAST(sum(label) FILTER (WHERE test_fold = f.fold) AS BIGINT) AS test_positives
FROM folds CROSS JOIN (SELECT CAST(unnest(range(1, 21)) AS INTEGER) AS fold) f GROUP BY f.fold""",
    "race_folds": folds_sql(FOLDS) + "SELECT position_id, min(test_fold) OVER (PARTITION BY season, no) AS test_fold FROM folds",
    "hash_holdout_split": f"""
SELECT o_orderkey, o_orderpriority, CASE WHEN {HASHED.format(key="o_orderkey")} THEN 'test' ELSE 'train' END AS part
FROM orders""",
    "standard_scaling": panel_sql()
    + f""",
split AS (
  SELECT *, CASE WHEN {HASHED.format(key="position_id")} THEN 'test' ELSE 'train' END AS part FROM panel
),
stats AS (
  SELECT {", ".join(f"avg({f}) AS m_{f}, stddev_pop({f}) AS d_{f}" for f in _SCALED)} FROM split WHERE part = 'train'
)
SELECT position_id, part,
       {", ".join(f"round(({f} - m_{f}) / CASE WHEN d_{f} = 0 THEN 1 ELSE d_{f} END, 6) + 0.0 AS {f}_scaled" for f in _SCALED)}
FROM split CROSS JOIN stats""",
    "rule_accuracy": folds_sql(FOLDS)
    + f""",
per_fold AS (
  SELECT test_fold AS fold, avg(CASE WHEN (qualy_pos <= {TOP}) = (label = 1) THEN 1.0 ELSE 0.0 END) AS accuracy,
         count(*) AS support
  FROM folds WHERE test_fold > 0 GROUP BY test_fold
)
SELECT fold, round(accuracy, 6) AS accuracy, support FROM per_fold
UNION ALL SELECT 0, round(avg(accuracy), 6), count(*) FROM per_fold""",
    "classification_report": folds_sql(FOLDS)
    + ","
    + _report_sql(
        f"""SELECT label, CASE WHEN qualy_pos <= {TOP} THEN 1 ELSE 0 END AS prediction, count(*) AS n
            FROM folds WHERE test_fold = {FOLDS} GROUP BY ALL""",
        f"{FOLDS} AS fold,",
    ),
    "position_report": panel_sql()
    + ","
    + _report_sql("SELECT position AS label, qualy_pos AS prediction, count(*) AS n FROM panel GROUP BY ALL", ""),
}
