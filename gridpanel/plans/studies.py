"""The three complete studies: panel, split, models, counts to report from."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpanel.plans import compare, models, panel
from gridpanel.plans.splits import expanding_window

WITH_SPRINT = models.FEATURE_SETS["base+sprint"]
POINTS, PODIUM = 10, 3


def finishing_position(
    results: DataFrame,
    kinds: tuple[str, ...] = compare.POSITION_MODELS,
    settings: models.Settings = models.Settings(),
) -> DataFrame:
    """Exact position as the class, on one hold-out: confusion counts per model."""
    rows = panel.feature_panel(results).withColumn("label", F.col("position").cast("double"))
    return compare.on_holdout(rows, WITH_SPRINT, kinds, settings)


def points_finish(
    results: DataFrame,
    folds: int = 5,
    kinds: tuple[str, ...] = compare.CLASS_MODELS,
    settings: models.Settings = models.Settings(svm_c=1.2),
) -> DataFrame:
    """First ten or not, over expanding-window folds: confusion counts per fold and model."""
    rows = panel.labelled(panel.feature_panel(results), POINTS)
    return compare.over_folds(
        expanding_window(rows, folds, panel.SORT), {"base+sprint": WITH_SPRINT}, kinds, settings
    )


def podium_finish(
    results: DataFrame,
    folds: int = 20,
    feature_sets: dict[str, list[str]] = models.FEATURE_SETS,
    kinds: tuple[str, ...] = compare.CLASS_MODELS,
    settings: models.Settings = models.Settings(),
) -> DataFrame:
    """First three or not, for every feature set: confusion counts per set, fold and model."""
    rows = panel.labelled(
        panel.feature_panel(results, panel.PanelSpec(sentinels=panel.PODIUM_SENTINELS)), PODIUM
    )
    return compare.over_folds(
        expanding_window(rows, folds, panel.SORT), feature_sets, kinds, replace(settings, boosting_seed=42)
    )
