"""Lagged feature panel of ranked events.

Input: one row per entity and session (``Race``, ``Qualifying``, ``Sprint``)
with ``season``, ``no`` (period within the season), ``meeting_name``,
``driver_number`` and ``position``. Output: one row per race result with the
entity's earlier results next to it.

Look-backs go by the value of ``no`` or ``season``, not by row: an entity that
missed period n-1 has no previous result, whatever it did in n-2. They run as
range-frame windows over blocks (``operators.lookback``), so the input is
shuffled once per look-back axis and no group grows with the data.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridpanel.functions.scalars import encode_membership, membership
from gridpanel.operators.lookback import BLOCK, Lookback

RACE, QUALIFYING, SPRINT = "Race", "Qualifying", "Sprint"
BEHIND_THE_GRID = 21
SORT = ["season", "no", "position", "driver_number"]


@dataclass(frozen=True)
class Sentinels:
    """Values that stand for a missing feature."""

    previous_race: int = BEHIND_THE_GRID
    previous_year: int = BEHIND_THE_GRID
    qualifying: int = BEHIND_THE_GRID
    sprint: int = BEHIND_THE_GRID
    gain: int = 0


PODIUM_SENTINELS = Sentinels(sprint=-1)


@dataclass(frozen=True)
class PanelSpec:
    sentinels: Sentinels = field(default_factory=Sentinels)
    rolling_periods: int = 3
    first_period: int = 1
    strict: bool = True
    block_width: int = 64


def join_results(positions: DataFrame, sessions: DataFrame, meetings: DataFrame) -> DataFrame:
    """Positions with their session and meeting; the small tables are broadcast if their files are small."""
    return (
        positions.select("position_id", "driver_number", "position", "session_id")
        .join(sessions.select("session_id", "session_name", "meeting_id"), "session_id")
        .join(meetings.select("meeting_id", "meeting_name", "season", "no"), "meeting_id")
        .select(
            "position_id", "driver_number", "position", "session_name", "meeting_id", "meeting_name", "season", "no"
        )
    )


def pivot_sessions(results: DataFrame, extra_keys: tuple[str, ...] = ()) -> DataFrame:
    """Session results of one entity in one meeting as columns, with the number of rows behind each.

    ``race`` is the worst race position, ``races`` has every race row.
    """

    def of(session: str) -> Column:
        return F.col("session_name") == session

    return (
        results.filter(F.col("session_name").isin(RACE, QUALIFYING, SPRINT))
        .groupBy("season", "no", "meeting_id", "meeting_name", "driver_number", *extra_keys)
        .agg(
            F.collect_list(F.when(of(RACE), F.struct("position_id", "position"))).alias("races"),
            F.max(F.when(of(RACE), F.col("position"))).alias("race"),
            F.max(F.when(of(QUALIFYING), F.col("position"))).alias("qualifying"),
            F.max(F.when(of(SPRINT), F.col("position"))).alias("sprint"),
            F.count_if(of(RACE)).alias("race_rows"),
            F.count_if(of(QUALIFYING)).alias("qualifying_rows"),
            F.count_if(of(SPRINT)).alias("sprint_rows"),
        )
    )


def _by_period(results: DataFrame, spec: PanelSpec) -> DataFrame:
    past = Lookback(("season", "driver_number"), "no", max(1, spec.rolling_periods), spec.block_width)
    # one shuffle serves the pivot and the windows: both are clustered by (season, driver_number, block)
    spread = past.spread(results, ["meeting_id", "driver_number"]).repartition(*past.keys, BLOCK)
    cells = pivot_sessions(spread, (BLOCK,))
    # only race rows look anything up, and in the first period nothing before it
    asks = F.col("race_rows") > 0
    later = asks & ~F.col("no").eqNullSafe(F.lit(spec.first_period))
    here = cells.withColumns(
        {
            "qualifying": past.at("qualifying", "qualifying_rows", 0, spec.strict, asks),
            "sprint": past.at("sprint", "sprint_rows", 0, spec.strict, asks),
            "previous_race": past.at("race", "race_rows", -1, spec.strict, later),
        }
    )
    gained = here.withColumn("gain", F.col("qualifying") - F.col("race"))
    return gained.select(
        *[c for c in here.columns if c not in ("gain", "qualifying_rows", "sprint_rows")],
        past.mean("gain", -spec.rolling_periods, -1).alias("recent_gain"),
    ).filter(past.own()).drop(BLOCK)


def _by_season(cells: DataFrame, spec: PanelSpec) -> DataFrame:
    past = Lookback(("driver_number", "meeting_name"), "season", 1, spec.block_width)
    spread = past.spread(cells, ["meeting_id", "driver_number"])
    found = past.at("race", "race_rows", -1, spec.strict, F.col("race_rows") > 0)
    return spread.withColumn("previous_year", found).filter(past.own())


def feature_panel(results: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """All features of every race result; an entity with two race rows in a meeting has two rows.

    Both look-backs run before rows without a race are dropped, since those
    rows carry the qualifying and sprint results of the same period.
    """
    s = spec.sentinels
    wide = _by_season(_by_period(results, spec), spec).select("*", F.explode("races").alias("_race"))
    wide = wide.filter(F.col("_race.position").isNotNull())
    return wide.select(
        "_race.position_id",
        "driver_number",
        "_race.position",
        "meeting_name",
        "season",
        "no",
        F.when(F.col("no") == spec.first_period, F.lit(s.previous_race))
        .otherwise(F.coalesce("previous_race", F.lit(s.previous_race)))
        .alias("previous_race_pos"),
        F.coalesce("previous_year", F.lit(s.previous_year)).alias("previous_year_pos"),
        F.coalesce("qualifying", F.lit(s.qualifying)).alias("qualy_pos"),
        F.coalesce(F.round("recent_gain", 0).cast("int"), F.lit(s.gain)).alias("gain"),
        F.coalesce("sprint", F.lit(s.sprint)).alias("sprint_pos"),
    )


def in_race_order(panel: DataFrame) -> DataFrame:
    """Rows by season, period and finishing position."""
    return panel.orderBy(*SORT)


def labelled(panel: DataFrame, k: int) -> DataFrame:
    """Replace the position by ``fin_pos`` (IN / OUT of the first ``k``) and add the numeric ``label``."""
    marked = panel.withColumn("fin_pos", membership(F.col("position"), k))
    return marked.withColumn("label", encode_membership(F.col("fin_pos")).cast("double"))
