"""The feature panel as SQL text over stored tables.

The same rows as ``panel.feature_panel``, for those who have SQL to run: views of
the stored tables, look-ups as correlated scalar subqueries, sentinels as named
parameters. A look-up that finds two rows is an error. The subqueries aggregate,
so Spark turns each into a grouping and an equi-join; without that it would
compare every row with every other. They are shuffles of their own where
``feature_panel`` has one per axis.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridpanel.plans.panel import PanelSpec
from gridpanel.sources.tables import register_views

RESULTS = """
SELECT position_id, driver_number, position, session_name, meeting_id, meeting_name, season, no
FROM positions JOIN sessions USING (session_id) JOIN meetings USING (meeting_id)
"""

#: The one position of a look-up.
ONE = "IF(count(*) > 1, CAST(raise_error('scalar look-up found more than one result') AS INT), max(e.position))"

PANEL = f"""
WITH race AS (SELECT * FROM results WHERE session_name = :race AND position IS NOT NULL),
grid AS (SELECT * FROM results WHERE session_name = :qualifying),
sprint AS (SELECT * FROM results WHERE session_name = :sprint),
-- a gain counts for each of the periods that look back on it
gains AS (
  SELECT driver_number, season, race.no + later AS seen_from, grid.position - race.position AS gain
  FROM grid JOIN race USING (driver_number, season)
  LATERAL VIEW explode(sequence(1, :periods)) AS later
  WHERE grid.no = race.no
)
SELECT r.position_id, r.driver_number, r.position, r.meeting_name, r.season, r.no,
  CASE WHEN r.no = :first_period THEN :no_race ELSE coalesce(
    (SELECT {ONE} FROM race e WHERE e.driver_number = r.driver_number AND e.season = r.season AND e.no = r.no - 1),
    :no_race) END AS previous_race_pos,
  coalesce(
    (SELECT {ONE} FROM race e WHERE e.driver_number = r.driver_number AND e.season = r.season - 1 AND e.meeting_name = r.meeting_name),
    :no_year) AS previous_year_pos,
  coalesce(
    (SELECT {ONE} FROM grid e WHERE e.driver_number = r.driver_number AND e.season = r.season AND e.no = r.no),
    :no_grid) AS qualy_pos,
  coalesce(
    (SELECT CAST(round(avg(g.gain), 0) AS INT) FROM gains g WHERE g.driver_number = r.driver_number AND g.season = r.season AND g.seen_from = r.no),
    :no_gain) AS gain,
  coalesce(
    (SELECT {ONE} FROM sprint e WHERE e.driver_number = r.driver_number AND e.season = r.season AND e.no = r.no),
    :no_sprint) AS sprint_pos
FROM race r
"""


def panel_from_text(spark: SparkSession, root: str, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """The panel of the tables stored under ``root``."""
    register_views(spark, root)
    spark.sql(RESULTS).createOrReplaceTempView("results")
    s = spec.sentinels
    return spark.sql(
        PANEL,
        args={
            "race": "Race",
            "qualifying": "Qualifying",
            "sprint": "Sprint",
            "first_period": spec.first_period,
            "periods": spec.rolling_periods,
            "no_race": s.previous_race,
            "no_year": s.previous_year,
            "no_grid": s.qualifying,
            "no_gain": s.gain,
            "no_sprint": s.sprint,
        },
    )
