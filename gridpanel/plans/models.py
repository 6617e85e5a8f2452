"""Classifiers and regressors over panel features, with Spark ML.

Parameters follow the usual single-machine defaults where Spark has the same
knob: an L2 penalty of strength 1/C on the summed loss is ``1 / (C * rows)``
on Spark's mean loss, forests have 100 trees, boosting 100 rounds of depth 3
at rate 0.1. Spark limits the depth of trees; ``max_depth`` is the most it
allows. The linear models and SVMs end by Spark's tolerance (1e-6) unless their
iterations run out before.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.ml import Model
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE = ["previous_race_pos", "previous_year_pos", "qualy_pos"]
FEATURE_SETS: dict[str, list[str]] = {
    "base": BASE,
    "base+gain": [*BASE, "gain"],
    "base+sprint": [*BASE, "sprint_pos"],
    "base+gain+sprint": [*BASE, "gain", "sprint_pos"],
}


@dataclass(frozen=True)
class Settings:
    """Knobs shared by the models; the defaults are the full-size ones.

    Studies use ``gradient_tolerance`` (gradient per row), ``svm_gap`` (duality gap
    over objective) and ``newton_passes`` (most passes over the rows) for linear
    models; ``kernel_features`` is the number of landmark rows of a kernel SVM.
    Tree models train on all rows; tasks read them ``tree_rows`` at a time.
    """

    gradient_tolerance: float = 1e-8
    svm_gap: float = 1e-3
    newton_passes: int = 200
    tree_rows: int = 20_000
    c: float = 1.0
    svm_c: float = 1.0
    linear_iterations: int = 1000
    multinomial_iterations: int = 100_000
    svm_iterations: int = 100_000
    trees: int = 100
    max_depth: int = 30
    boosting_rounds: int = 100
    boosting_depth: int = 3
    boosting_rate: float = 0.1
    kernel_features: int = 64
    seed: int = 48
    boosting_seed: int = 48


@dataclass(frozen=True)
class Scaling:
    """Per-feature mean and population deviation of the training rows."""

    means: dict[str, float]
    deviations: dict[str, float]

    def scaled(self, feature: str) -> Column:
        # a constant feature is only centred
        width = self.deviations[feature] or 1.0
        return (F.col(feature) - F.lit(self.means[feature])) / F.lit(width)

    def apply(self, df: DataFrame, suffix: str = "_scaled") -> DataFrame:
        return df.withColumns({f + suffix: self.scaled(f) for f in self.means})


def fit_scaling(train: DataFrame, features: list[str]) -> Scaling:
    """One aggregate; two numbers per feature reach the driver."""
    stats = train.agg(
        *[F.avg(f).alias(f"mean_{f}") for f in features],
        *[F.stddev_pop(f).alias(f"dev_{f}") for f in features],
    ).first()
    return Scaling(
        {f: float(stats[f"mean_{f}"]) for f in features}, {f: float(stats[f"dev_{f}"]) for f in features}
    )


def kernel_columns(train: DataFrame, features: list[str], count: int, seed: int) -> dict[str, Column]:
    """Random cosine features whose inner products approximate the RBF kernel.

    Rahimi and Recht (2007). The width is ``1 / (features * variance of all
    training entries)``.
    """
    stats = train.select(F.explode(F.array(*[F.col(f).cast("double") for f in features])).alias("x")).agg(
        F.var_pop("x").alias("variance")
    )
    variance = stats.first()["variance"] or 1.0
    gamma = 1.0 / (len(features) * variance)
    draw = np.random.default_rng(seed)
    weights = draw.normal(0.0, math.sqrt(2.0 * gamma), size=(count, len(features)))
    shifts = draw.uniform(0.0, 2.0 * math.pi, size=count)
    columns = {}
    for j in range(count):
        angle = F.lit(float(shifts[j]))
        for w, f in zip(weights[j], features):
            angle = angle + F.lit(float(w)) * F.col(f)
        columns[f"_kernel_{j}"] = F.lit(math.sqrt(2.0 / count)) * F.cos(angle)
    return columns


Predictor = Callable[[DataFrame, str], DataFrame]


def _assembled(df: DataFrame, features: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=features, outputCol="_features").transform(df)


def _predictor(model: Model, prepare: Callable[[DataFrame], DataFrame], rounded: bool = False) -> Predictor:
    """Function that adds one prediction column and nothing else."""

    def predict(df: DataFrame, name: str) -> DataFrame:
        out = model.transform(prepare(df))
        value = F.bround("prediction", 0) if rounded else F.col("prediction")
        return out.select(*df.columns, value.alias(name))

    return predict


def fit(kind: str, train: DataFrame, features: list[str], rows: int, settings: Settings = Settings()) -> Predictor:
    """Train one model of ``kind`` on ``train`` (``rows`` rows, numeric ``label``)."""
    s = settings
    if kind in {"linear_svm", "kernel_svm"}:
        return _fit_svm(kind, train, features, rows, s)

    def prepare(df: DataFrame) -> DataFrame:
        return _assembled(df, features)

    columns = {"featuresCol": "_features", "labelCol": "label"}
    boosting = {"maxDepth": s.boosting_depth, "stepSize": s.boosting_rate, "maxIter": s.boosting_rounds}
    estimators = {
        "logistic": lambda: LogisticRegression(
            maxIter=s.linear_iterations, regParam=1.0 / (s.c * rows), standardization=False, **columns
        ),
        "multinomial": lambda: LogisticRegression(
            family="multinomial",
            maxIter=s.multinomial_iterations,
            regParam=1.0 / (s.c * rows),
            standardization=False,
            **columns,
        ),
        "tree": lambda: DecisionTreeClassifier(maxDepth=s.max_depth, seed=s.seed, **columns),
        "forest": lambda: RandomForestClassifier(
            numTrees=s.trees, maxDepth=s.max_depth, featureSubsetStrategy="sqrt", seed=s.seed, **columns
        ),
        "boosted": lambda: GBTClassifier(seed=s.boosting_seed, **boosting, **columns),
        "boosted_regression": lambda: GBTRegressor(seed=s.boosting_seed, **boosting, **columns),
    }
    model = estimators[kind]().fit(prepare(train).select("_features", "label"))
    return _predictor(model, prepare, rounded=kind == "boosted_regression")


def _fit_svm(kind: str, train: DataFrame, features: list[str], rows: int, s: Settings) -> Predictor:
    svm = LinearSVC(
        featuresCol="_features",
        labelCol="label",
        regParam=1.0 / (s.svm_c * rows),
        maxIter=s.svm_iterations,
        standardization=False,
    )
    if kind == "linear_svm":
        scaling = fit_scaling(train, features)
        derived = {f"_scaled_{f}": scaling.scaled(f) for f in features}
    else:
        derived = kernel_columns(train, features, s.kernel_features, s.seed)

    def prepare(df: DataFrame) -> DataFrame:
        return _assembled(df.withColumns(derived), list(derived))

    ready = prepare(train).select("_features", "label")
    if kind == "linear_svm":
        return _predictor(svm.fit(ready), prepare)
    # one-vs-rest wants classes 0..n-1, each present; the class list is as long as the model itself
    classes = sorted(row["label"] for row in train.select("label").distinct().collect())
    positions = F.create_map(*[F.lit(x) for i, c in enumerate(classes) for x in (c, float(i))])
    many = OneVsRest(classifier=svm, featuresCol="_features", labelCol="label", parallelism=8)
    model = many.fit(ready.withColumn("label", positions[F.col("label")]))
    names = F.array(*[F.lit(c) for c in classes])

    def predict(df: DataFrame, name: str) -> DataFrame:
        chosen = F.element_at(names, F.col("prediction").cast("int") + 1)
        return model.transform(prepare(df)).select(*df.columns, chosen.alias(name))

    return predict
