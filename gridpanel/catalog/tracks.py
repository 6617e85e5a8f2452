"""Track geometry and lap slices on points derived from ``events``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridpanel.operators.intervals import slice_by_interval
from gridpanel.operators.keyed import fastest
from gridpanel.plans import tracks
from gridpanel.scratch import stage
from gridpanel.sources.tables import read_inputs


def _points(spark: SparkSession, folder: str) -> DataFrame:
    """Users as tracks, events in time order as their points."""
    (events,) = read_inputs(spark, folder, "events")
    return events.select(
        F.col("user_id").alias("track"),
        "ts",
        "event_id",
        F.col("value").alias("x"),
        F.get_json_object("props", "$.k").cast("double").alias("y"),
    )


def _six(*columns: str) -> list:
    return [(F.round(c, 6) + 0.0).alias(c) for c in columns]


def rotate_points(spark: SparkSession, folder: str) -> DataFrame:
    turned = tracks.rotated(_points(spark, folder).withColumn("rotation", F.col("track") % 360))
    return turned.select("event_id", "track", *_six("x", "y"))


def label_offset(spark: SparkSession, folder: str) -> DataFrame:
    """Every event as a corner of its user's track."""
    (events,) = read_inputs(spark, folder, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    corners = events.select(
        F.col("user_id").alias("track"),
        F.col("event_id").alias("ordinal"),
        (k % 20).alias("number"),
        F.when(F.col("event_type") == "error", "A").alias("letter"),
        F.col("value").alias("x"),
        k.cast("double").alias("y"),
        (k * 3.6 - 180).alias("angle"),
    )
    rotations = stage(
        corners.select("track").distinct().withColumn("rotation", (F.col("track") % 360).cast("double")), "rotations"
    )
    placed = tracks.labels(corners, rotations)
    return placed.select(
        F.col("ordinal").alias("event_id"), "track", "corner", *_six("x", "y", "corner_x", "corner_y")
    )


def track_bounds(spark: SparkSession, folder: str) -> DataFrame:
    return tracks.bounds(_points(spark, folder))


def fit_to_box(spark: SparkSession, folder: str) -> DataFrame:
    fitted = tracks.fit_to_box(_points(spark, folder), 800, 600)
    return fitted.select("event_id", "track", *_six("x", "y"))


def segment_midpoints(spark: SparkSession, folder: str) -> DataFrame:
    pairs = tracks.segments(_points(spark, folder), ["ts", "event_id"])
    return pairs.select("event_id", "track", *_six("prev_x", "prev_y", "x", "y", "mid_x", "mid_y"))


def range_slice(spark: SparkSession, folder: str) -> DataFrame:
    """Points within six hours of the start of each user's fastest lap of a day."""
    (events,) = read_inputs(spark, folder, "events")
    points = events.select("user_id", "ts", "event_id", "value")
    laps = fastest(points.withColumn("day", F.to_date("ts")), ["user_id", "day"], "value", ["event_id"]).select(
        "user_id",
        F.col("event_id").alias("lap_id"),
        F.col("ts").alias("lap_start"),
        (F.col("ts") + F.expr("INTERVAL 6 HOURS")).alias("lap_end"),
    )
    matched = slice_by_interval(points, laps, ["user_id"], "ts", "lap_start", "lap_end")
    return matched.select("lap_id", "user_id", "event_id", "value")


QUERIES = {
    "rotate_points": rotate_points,
    "label_offset": label_offset,
    "track_bounds": track_bounds,
    "fit_to_box": fit_to_box,
    "segment_midpoints": segment_midpoints,
    "range_slice": range_slice,
}

# -- checks --------------------------------------------------------------------

_POINTS_SQL = """
points AS (
  SELECT user_id AS track, ts, event_id, value AS x, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS y,
         radians(user_id % 360) AS turn
  FROM events
)
"""
_TURN = "round({x} * cos(turn) - {y} * sin(turn), 6) + 0.0 AS {a}, round({x} * sin(turn) + {y} * cos(turn), 6) + 0.0 AS {b}"

SQL = {
    "rotate_points": f"WITH {_POINTS_SQL} SELECT event_id, track, {_TURN.format(x='x', y='y', a='x', b='y')} FROM points",
    "label_offset": f"""
WITH {_POINTS_SQL},
corners AS (
  SELECT p.*, CAST(CAST(y AS INTEGER) % 20 AS VARCHAR) || CASE WHEN event_type = 'error' THEN 'A' ELSE '' END AS corner,
         x + 500 * cos(radians(y * 3.6 - 180)) AS ox, y + 500 * sin(radians(y * 3.6 - 180)) AS oy
  FROM points p JOIN events USING (event_id)
)
SELECT event_id, track, corner, {_TURN.format(x="ox", y="oy", a="x", b="y")},
       {_TURN.format(x="corners.x", y="corners.y", a="corner_x", b="corner_y")}
FROM corners""",
    "track_bounds": f"""
WITH {_POINTS_SQL}
SELECT track, min(x) AS min_x, max(x) AS max_x, min(y) AS min_y, max(y) AS max_y FROM points GROUP BY track""",
    "fit_to_box": f"""
WITH {_POINTS_SQL},
box AS (SELECT track, min(x) AS x0, max(x) - min(x) AS dx, min(y) AS y0, max(y) - min(y) AS dy FROM points GROUP BY track),
scaled AS (
  SELECT *, coalesce(least(CASE WHEN dx > 0 THEN 800 / dx END, CASE WHEN dy > 0 THEN 600 / dy END), 1) AS factor FROM box
)
SELECT event_id, p.track, round((x - x0) * factor, 6) + 0.0 AS x, round((y - y0) * factor, 6) + 0.0 AS y
FROM points p JOIN scaled s ON s.track = p.track""",
    "segment_midpoints": f"""
WITH {_POINTS_SQL},
pairs AS (
  SELECT event_id, track, lag(x) OVER w AS px, lag(y) OVER w AS py, x, y FROM points
  WINDOW w AS (PARTITION BY track ORDER BY ts, event_id)
)
SELECT event_id, track, round(px, 6) AS prev_x, round(py, 6) AS prev_y, round(x, 6) AS x, round(y, 6) AS y,
       round((px + x) / 2, 6) AS mid_x, round((py + y) / 2, 6) AS mid_y
FROM pairs WHERE px IS NOT NULL""",
    "range_slice": """
WITH laps AS (
  SELECT user_id, event_id AS lap_id, ts AS lap_start FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY value, event_id) = 1
)
SELECT lap_id, e.user_id, e.event_id, e.value
FROM events e JOIN laps l ON l.user_id = e.user_id AND e.ts >= lap_start AND e.ts < lap_start + INTERVAL 6 HOURS""",
}
