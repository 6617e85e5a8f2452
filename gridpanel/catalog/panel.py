"""Panel features on results derived from ``lineitem``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridpanel.plans import panel, panel_text
from gridpanel.plans.demo_panel import results_from_lineitem
from gridpanel.scratch import scratch_path, stage
from gridpanel.sources import tables
from gridpanel.sources.files import arff_lines, arff_rows


def _panel(spark: SparkSession, folder: str, spec: panel.PanelSpec = panel.PanelSpec()) -> DataFrame:
    return panel.feature_panel(results_from_lineitem(spark, folder), spec)


def previous_period(spark: SparkSession, folder: str) -> DataFrame:
    return _panel(spark, folder).select("position_id", "season", "no", "driver_number", "position", "previous_race_pos")


def previous_season(spark: SparkSession, folder: str) -> DataFrame:
    return _panel(spark, folder).select(
        "position_id", "season", "meeting_name", "driver_number", "position", "previous_year_pos"
    )


def rolling_gain(spark: SparkSession, folder: str) -> DataFrame:
    return _panel(spark, folder).select("position_id", "season", "no", "driver_number", "gain")


def session_pivot(spark: SparkSession, folder: str) -> DataFrame:
    s = panel.BEHIND_THE_GRID
    wide = panel.pivot_sessions(results_from_lineitem(spark, folder))
    return wide.select(
        "season",
        "no",
        "driver_number",
        F.coalesce("race", F.lit(s)).alias("race_pos"),
        F.coalesce("qualifying", F.lit(s)).alias("qualy_pos"),
        F.coalesce("sprint", F.lit(s)).alias("sprint_pos"),
    )


def feature_panel_exact(spark: SparkSession, folder: str) -> DataFrame:
    return panel.in_race_order(_panel(spark, folder))


def feature_panel_text(spark: SparkSession, folder: str) -> DataFrame:
    """The same panel from SQL text over stored tables, which are written first, all in one commit."""
    results = results_from_lineitem(spark, folder)
    rows = stage(results.withColumn("session_id", F.expr("position_id DIV 100")), "results")
    root = scratch_path(spark, "tables")
    tables.create_tables(spark, root)
    meetings = rows.select("meeting_id", "meeting_name", "season", "no").distinct()
    absent = {"meeting_official_name": "string", "circuit_id": "bigint", "date_start": "timestamp_ntz", "gmt_offset": "interval hour to second"}
    sessions = rows.select("session_id", "session_name", "meeting_id").distinct()
    changes = {
        "meetings": meetings.withColumns({c: F.lit(None).cast(t) for c, t in absent.items()}),
        "sessions": sessions.withColumns({"og_session_id": F.lit(None).cast("int"), "session_type": F.lit(None).cast("string")}),
        "positions": rows.select("position_id", F.col("driver_number").cast("int").alias("driver_number"), "position", "session_id"),
    }
    tables.commit(spark, root, {name: tables.Change(df) for name, df in changes.items()})
    return panel_text.panel_from_text(spark, root)


def feature_panel_points(spark: SparkSession, folder: str) -> DataFrame:
    return _classes(panel.labelled(_panel(spark, folder), 10))


def feature_panel_podium(spark: SparkSession, folder: str) -> DataFrame:
    spec = panel.PanelSpec(sentinels=panel.PODIUM_SENTINELS)
    return _classes(panel.labelled(_panel(spark, folder, spec), 3))


def _classes(marked: DataFrame) -> DataFrame:
    return panel.in_race_order(marked).select(
        "position_id",
        "driver_number",
        "fin_pos",
        F.col("label").cast("int").alias("label"),
        "meeting_name",
        "season",
        "no",
        "previous_race_pos",
        "previous_year_pos",
        "qualy_pos",
        "gain",
        "sprint_pos",
    )


_ARFF = {
    "position_prev_race": "NUMERIC",
    "position_prev_year": "NUMERIC",
    "position_qualy": "NUMERIC",
    "class": "{ IN, OUT}",
}


def _arff(spark: SparkSession, folder: str) -> DataFrame:
    rows = panel.labelled(_panel(spark, folder), 10).select(
        F.col("previous_race_pos").alias("position_prev_race"),
        F.col("previous_year_pos").alias("position_prev_year"),
        F.col("qualy_pos").alias("position_qualy"),
        F.col("fin_pos").alias("class"),
        *panel.SORT,
    )
    return arff_lines(rows, "panel", _ARFF, list(panel.SORT))


def arff_export(spark: SparkSession, folder: str) -> DataFrame:
    return _arff(spark, folder)


def arff_import(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of the export read back, counted per class and qualifying position."""
    schema = "position_prev_race int, position_prev_year int, position_qualy int, class string"
    rows = arff_rows(_arff(spark, folder), schema, "line")
    return rows.groupBy("class", "position_qualy").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("position_prev_race").alias("prev_race_sum")
    )


# -- checks --------------------------------------------------------------------

RESULTS_SQL = """
totals AS (
  SELECT CAST(year(l_shipdate) AS INTEGER) AS season, CAST(month(l_shipdate) AS INTEGER) AS no, l_suppkey AS driver_number,
         l_suppkey // 20 AS field, l_returnflag AS flag, sum(l_quantity) AS quantity
  FROM lineitem GROUP BY ALL
),
results AS (
  SELECT *,
         CAST(row_number() OVER (PARTITION BY field, season, no, flag ORDER BY quantity DESC, driver_number) AS INTEGER)
           AS position,
         'M' || no || '-' || field AS meeting_name,
         ((field * 10000 + season) * 100 + no) * 10
           + CASE flag WHEN 'R' THEN 0 WHEN 'N' THEN 4 ELSE 5 END AS session_id
  FROM totals
),
race AS (SELECT * FROM results WHERE flag = 'R'),
quali AS (SELECT * FROM results WHERE flag = 'N'),
sprint AS (SELECT * FROM results WHERE flag NOT IN ('R', 'N'))
"""


def panel_sql(sprint: int = 21) -> str:
    """Common table expressions ending in ``panel``, written as plain left joins."""
    return (
        "WITH "
        + RESULTS_SQL
        + f""",
gains AS (
  SELECT r.season, r.no, r.driver_number, q.position - r.position AS gain
  FROM race r JOIN quali q USING (season, no, driver_number)
),
recent AS (
  SELECT r.season, r.no, r.driver_number, round(avg(g.gain), 0) AS gain
  FROM race r
  JOIN gains g ON g.season = r.season AND g.driver_number = r.driver_number AND r.no - g.no BETWEEN 1 AND 3
  GROUP BY ALL
),
panel AS (
  SELECT r.session_id * 100 + r.position AS position_id, r.driver_number, r.position, r.meeting_name, r.season, r.no,
         CASE WHEN r.no = 1 THEN 21 ELSE coalesce(p.position, 21) END AS previous_race_pos,
         coalesce(y.position, 21) AS previous_year_pos,
         coalesce(q.position, 21) AS qualy_pos,
         CAST(coalesce(g.gain, 0) AS INTEGER) AS gain,
         coalesce(s.position, {sprint}) AS sprint_pos
  FROM race r
  LEFT JOIN race p ON p.season = r.season AND p.no = r.no - 1 AND p.driver_number = r.driver_number
  LEFT JOIN race y
    ON y.season = r.season - 1 AND y.meeting_name = r.meeting_name AND y.driver_number = r.driver_number
  LEFT JOIN quali q ON q.season = r.season AND q.no = r.no AND q.driver_number = r.driver_number
  LEFT JOIN sprint s ON s.season = r.season AND s.no = r.no AND s.driver_number = r.driver_number
  LEFT JOIN recent g ON g.season = r.season AND g.no = r.no AND g.driver_number = r.driver_number
)
"""
    )


def _classes_sql(k: int, sprint: int) -> str:
    return (
        panel_sql(sprint)
        + f"""
SELECT position_id, driver_number, CASE WHEN position <= {k} THEN 'IN' ELSE 'OUT' END AS fin_pos,
       CASE WHEN position <= {k} THEN 1 ELSE 0 END AS label,
       meeting_name, season, no, previous_race_pos, previous_year_pos, qualy_pos, gain, sprint_pos
FROM panel"""
    )


QUERIES = {
    "prev_period_position": previous_period,
    "prev_season_position": previous_season,
    "rolling_gain": rolling_gain,
    "session_pivot": session_pivot,
    "feature_panel_exact": feature_panel_exact,
    "feature_panel_text": feature_panel_text,
    "feature_panel_points": feature_panel_points,
    "feature_panel_podium": feature_panel_podium,
    "arff_lines": arff_export,
    "arff_import": arff_import,
}

SQL = {
    "prev_period_position": panel_sql()
    + "SELECT position_id, season, no, driver_number, position, previous_race_pos FROM panel",
    "prev_season_position": panel_sql()
    + "SELECT position_id, season, meeting_name, driver_number, position, previous_year_pos FROM panel",
    "rolling_gain": panel_sql() + "SELECT position_id, season, no, driver_number, gain FROM panel",
    "session_pivot": "WITH "
    + RESULTS_SQL
    + """
SELECT season, no, driver_number,
       coalesce(max(position) FILTER (WHERE flag = 'R'), 21) AS race_pos,
       coalesce(max(position) FILTER (WHERE flag = 'N'), 21) AS qualy_pos,
       coalesce(max(position) FILTER (WHERE flag NOT IN ('R', 'N')), 21) AS sprint_pos
FROM results GROUP BY season, no, driver_number""",
    "feature_panel_exact": panel_sql() + "SELECT * FROM panel",
    "feature_panel_text": panel_sql() + "SELECT * FROM panel",
    "feature_panel_points": _classes_sql(10, 21),
    "feature_panel_podium": _classes_sql(3, -1),
    "arff_lines": panel_sql()
    + """
SELECT previous_race_pos || ',' || previous_year_pos || ',' || qualy_pos || ','
       || CASE WHEN position <= 10 THEN 'IN' ELSE 'OUT' END AS line FROM panel
UNION ALL
SELECT unnest(['@RELATION panel', '', '@ATTRIBUTE position_prev_race NUMERIC', '@ATTRIBUTE position_prev_year NUMERIC',
               '@ATTRIBUTE position_qualy NUMERIC', '@ATTRIBUTE class { IN, OUT}', '', '@DATA']) AS line""",
    "arff_import": panel_sql()
    + """
SELECT CASE WHEN position <= 10 THEN 'IN' ELSE 'OUT' END AS class, qualy_pos AS position_qualy,
       count(*) AS row_count, CAST(sum(previous_race_pos) AS BIGINT) AS prev_race_sum
FROM panel GROUP BY ALL""",
}
