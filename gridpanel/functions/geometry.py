"""2-D track geometry as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LABEL_OFFSET = 500.0


def rotate(x: Column, y: Column, degrees: Column) -> tuple[Column, Column]:
    """Counter-clockwise rotation about the origin."""
    a = F.radians(degrees)
    return x * F.cos(a) - y * F.sin(a), x * F.sin(a) + y * F.cos(a)


def label_point(
    x: Column, y: Column, corner_degrees: Column, track_degrees: Column, distance: float = LABEL_OFFSET
) -> tuple[Column, Column]:
    """Where a corner's label stands: pushed outwards along the corner's angle, then turned with the track."""
    dx, dy = rotate(F.lit(distance), F.lit(0.0), corner_degrees)
    return rotate(x + dx, y + dy, track_degrees)


def corner_label(number: Column, letter: Column) -> Column:
    return F.concat(number.cast("string"), F.coalesce(letter, F.lit("")))


def fit_scale(width: float, height: float, dx: Column, dy: Column) -> Column:
    """Largest uniform factor that keeps a dx by dy box within the canvas; NULL for a single point."""
    return F.least(
        F.when(dx > 0, F.lit(float(width)) / dx),
        F.when(dy > 0, F.lit(float(height)) / dy),
    )
