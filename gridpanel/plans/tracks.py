"""Track geometry over tables of points."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridpanel.functions.geometry import LABEL_OFFSET, corner_label, fit_scale, label_point, rotate
from gridpanel.operators.ordering import previous_row
from gridpanel.scratch import stage


def rotated(points: DataFrame, degrees: str = "rotation") -> DataFrame:
    """Points turned by the angle in column ``degrees``."""
    x, y = rotate(F.col("x"), F.col("y"), F.col(degrees))
    return points.withColumns({"x": x, "y": y})


def labels(corners: DataFrame, rotations: DataFrame, distance: float = LABEL_OFFSET) -> DataFrame:
    """Label text and position, and the turned corner, for every corner of every track."""
    joined = corners.join(rotations, "track")
    label_x, label_y = label_point(F.col("x"), F.col("y"), F.col("angle"), F.col("rotation"), distance)
    corner_x, corner_y = rotate(F.col("x"), F.col("y"), F.col("rotation"))
    return joined.select(
        "track",
        "ordinal",
        corner_label(F.col("number"), F.col("letter")).alias("corner"),
        label_x.alias("x"),
        label_y.alias("y"),
        corner_x.alias("corner_x"),
        corner_y.alias("corner_y"),
    )


def bounds(points: DataFrame, track: str = "track") -> DataFrame:
    """Smallest and largest x and y per track."""
    return points.groupBy(track).agg(
        F.min("x").alias("min_x"), F.max("x").alias("max_x"), F.min("y").alias("min_y"), F.max("y").alias("max_y")
    )


def fit_to_box(points: DataFrame, width: float, height: float, track: str = "track") -> DataFrame:
    """Move and scale every track, uniformly, into a width by height box.

    The bounds (one row per track) are staged, so they are broadcast only when
    their files are small; otherwise a track with very many points is split by
    the adaptive skew join.
    """
    box = stage(bounds(points, track), "bounds")
    scale = fit_scale(width, height, F.col("max_x") - F.col("min_x"), F.col("max_y") - F.col("min_y"))
    factor = F.coalesce(scale, F.lit(1.0))
    moved = points.join(box, track).withColumns(
        {"x": (F.col("x") - F.col("min_x")) * factor, "y": (F.col("y") - F.col("min_y")) * factor}
    )
    return moved.select(*points.columns)


def segments(points: DataFrame, order: list[str], track: str = "track") -> DataFrame:
    """Each point with the one before it on its track and the midpoint between them."""
    pairs = previous_row(points, [track], order, ["x", "y"]).filter(F.col("prev_x").isNotNull())
    return pairs.withColumns(
        {"mid_x": (F.col("prev_x") + F.col("x")) / 2, "mid_y": (F.col("prev_y") + F.col("y")) / 2}
    )


def geometry_documents(
    points: DataFrame, corners: DataFrame, rotations: DataFrame, page_size: int = 10_000
) -> DataFrame:
    """Tracks as nested JSON text: points, corners and rotation; track, page, pages, document.

    Points and corners are paged by their ordinal (``page`` 0, 1, ... of
    ``pages``), so a track of any length stays in bounded rows; the rotation goes
    with page 0. A track of up to ``page_size`` points is one document.
    """
    number = F.floor(F.col("ordinal") / F.lit(page_size)).cast("int")

    def paged(df: DataFrame, name: str, fields: list[str], page: Column = number) -> DataFrame:
        # rows without a page form documents of their own kind
        return df.select("track", page.alias("page"), F.when(page.isNull(), F.lit(name)).alias("_kind"), F.struct(*fields).alias(name))

    def listed(name: str, fields: list[str]) -> Column:
        rows = F.transform(F.sort_array(F.collect_list(name)), lambda p: F.struct(*[p[f].alias(f) for f in fields]))
        return F.when(F.size(rows) > 0, rows).alias(name)

    point, corner = ["x", "y"], ["number", "letter", "x", "y", "angle"]
    info = paged(rotations, "circuitInfo", ["rotation"], F.lit(0))
    # all kinds in one shuffle
    rows = paged(points, "trackData", ["ordinal", *point]).unionByName(paged(corners, "cornersData", ["ordinal", *corner]), allowMissingColumns=True)
    grouped = rows.unionByName(info, allowMissingColumns=True).groupBy("track", "page", "_kind")
    pages = grouped.agg(listed("trackData", point), listed("cornersData", corner), F.collect_list("circuitInfo").alias("_infos"))
    documents = pages.select("track", "page", "trackData", "cornersData", F.explode_outer("_infos").alias("circuitInfo"))
    last = points.select("track", number.alias("page")).unionByName(corners.select("track", number.alias("page"))).unionByName(info.select("track", "page"))
    counts = last.groupBy("track").agg((F.max("page") + 1).alias("pages"))
    joined = documents.join(counts, "track")
    body = F.to_json(F.struct("trackData", "cornersData", "circuitInfo"))
    return joined.select("track", "page", "pages", body.alias("document"))
