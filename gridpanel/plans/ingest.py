"""Landed payloads to keyed tables.

Every function returns the rows to append (or the table to replace) and leaves
the stored tables alone; rows that cannot be stored come back with a reason.
Running one twice adds nothing the second time.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridpanel.functions.scalars import composite_id, date_and_time, parse_offset
from gridpanel.operators import quarantine
from gridpanel.operators.keyed import first_per_key, last_value
from gridpanel.operators.upsert import absent, highest, insert_if_absent, mint_keys
from gridpanel.scratch import stage
from gridpanel.sources.landing import CORRUPT
from gridpanel.sources.schemas import TEXT_LIMITS

ORDER = ["_file", "ordinal"]
COUNTRY_BASE = 50_000
CIRCUIT_BASE = 100_000
STEP = 10
# stored session ids below this bound belong to the newer source
NEW_SOURCE_SESSIONS = 10_000


class Loaded(NamedTuple):
    rows: DataFrame
    rejected: DataFrame


def seasons_to_load(
    requested: DataFrame,
    stored: DataFrame,
    scope: tuple[str, ...] = (),
    after: int = 2013,
    latest: Column | None = None,
) -> DataFrame:
    """Read-through rule per requested season: ``serve`` stored rows, ``load`` missing ones, or ``invalid``.

    ``scope`` names further columns that a request is made for (one source of many, say).
    """
    keys = [*scope, "season"]
    wanted = quarantine.with_reason(
        requested.select(*keys).distinct(),
        [*quarantine.required("season"), quarantine.valid_year("season", after, latest)],
    )
    known = stored.select(*[F.col(k).alias(f"_{k}") for k in keys], F.lit(True).alias("_stored")).distinct()
    match = [wanted[k].eqNullSafe(known[f"_{k}"]) for k in keys]
    action = (
        F.when(F.col("reason").isNotNull(), "invalid").when(F.col("_stored"), "serve").otherwise("load")
    )
    return wanted.join(known, match, "left").select(*keys, action.alias("action"), "reason")


def _started() -> Column:
    return F.expr("try_cast(left(date_start, 19) AS timestamp_ntz)")


def unreadable(df: DataFrame) -> list[tuple[str, Column]]:
    """The rule that keeps documents aside which could not be parsed, where the reader tells."""
    return [("Unreadable document", F.col(CORRUPT).isNotNull())] if CORRUPT in df.columns else []


def load_meetings(
    payload: DataFrame, countries: DataFrame, circuits: DataFrame, meetings: DataFrame
) -> dict[str, Loaded]:
    """New countries, circuits and meetings of the flat payload, dimensions first; the payload is parsed once."""
    payload = stage(payload, "meetings")
    good, bad = quarantine.split(
        payload,
        [
            *unreadable(payload),
            *quarantine.required("meeting_key", "circuit_key", "country_key"),
            *[quarantine.too_long(name, limit) for name, limit in TEXT_LIMITS.items()],
            ("Malformed date or time", F.col("date_start").isNotNull() & _started().isNull()),
            ("Malformed offset", F.col("gmt_offset").isNotNull() & parse_offset(F.col("gmt_offset")).isNull()),
        ],
    )
    country_rows = good.select(
        F.col("country_key").alias("country_id"), "country_code", "country_name", *ORDER
    )
    circuit_rows = good.select(
        F.col("circuit_key").alias("circuit_id"),
        "circuit_short_name",
        F.col("country_key").alias("country_id"),
        F.lit(None).cast("string").alias("external_id"),
        *ORDER,
    )
    meeting_rows = good.select(
        F.col("meeting_key").alias("meeting_id"),
        "meeting_name",
        "meeting_official_name",
        F.col("circuit_key").alias("circuit_id"),
        _started().alias("date_start"),
        parse_offset(F.col("gmt_offset")).alias("gmt_offset"),
        F.col("year").alias("season"),
        F.lit(None).cast("int").alias("no"),
        *ORDER,
    )

    def new(rows: DataFrame, stored: DataFrame, key: str) -> Loaded:
        return Loaded(insert_if_absent(rows, stored, [key], ORDER).drop(*ORDER), bad)

    return {
        "countries": new(country_rows, countries, "country_id"),
        "circuits": new(circuit_rows, circuits, "circuit_id"),
        "meetings": new(meeting_rows, meetings, "meeting_id"),
    }


def load_circuits(
    source: DataFrame, countries: DataFrame, circuits: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(new countries, whole circuit table, rejected rows) of the nested circuit document.

    Countries are matched by name and minted only when new; every source row
    uses up a circuit key, whether or not its circuit is new; a known circuit
    only gets its missing external id. Keys start above the stored ones, so a
    later load never gives one out again.
    """
    good, bad = quarantine.split(source, [*unreadable(source), *quarantine.required("circuit_name", "country_name")])
    named = good.select("country_name", *ORDER)
    unknown = insert_if_absent(named, countries, ["country_name"], ORDER)
    country_base = max(COUNTRY_BASE, highest(countries, "country_id") + STEP)
    circuit_base = max(CIRCUIT_BASE, highest(circuits, "circuit_id") + STEP)
    new_countries = stage(
        mint_keys(unknown, ORDER, "country_id", country_base, STEP).select(
            "country_id", F.lit(None).cast("string").alias("country_code"), "country_name"
        ),
        "countries",
    )
    by_name = first_per_key(
        countries.select("country_id", "country_name").unionByName(new_countries.drop("country_code")),
        ["country_name"],
        ["country_id"],
    )
    keyed = mint_keys(good, ORDER, "circuit_id", circuit_base, STEP)
    incoming = keyed.join(by_name, "country_name").select(
        "circuit_id", F.col("circuit_name").alias("circuit_short_name"), "country_id", "external_id", *ORDER
    )
    merged = fill_external_ids(circuits, incoming)
    return new_countries, merged, bad


def fill_external_ids(circuits: DataFrame, incoming: DataFrame) -> DataFrame:
    """Fill a known circuit's missing external id, add unknown circuits, keep all else as stored."""
    rest = [c for c in incoming.columns if c != "circuit_short_name"]
    place = F.struct(*ORDER)
    # the first row of a name counts; its external id is the first one given, as when rows arrive one by one
    batch = stage(
        incoming.groupBy("circuit_short_name")
        .agg(
            F.min_by(F.struct(*rest), place).alias("_row"),
            F.min_by("external_id", F.when(F.col("external_id").isNotNull(), place)).alias("_external_id"),
        )
        .select("circuit_short_name", "_row.circuit_id", "_row.country_id", F.col("_external_id").alias("external_id")),
        "circuits",
    )
    ids = batch.select("circuit_short_name", F.col("external_id").alias("_external_id"))
    filled = circuits.join(ids, "circuit_short_name", "left").withColumn(
        "external_id", F.coalesce("external_id", "_external_id")
    )
    new = absent(batch, circuits, ["circuit_short_name"])
    return filled.select(*circuits.columns).unionByName(new.select(*circuits.columns))


def load_sessions(payload: DataFrame, meetings: DataFrame, sessions: DataFrame, season: int) -> Loaded:
    """New sessions of a season's meetings, payloads landed per meeting; all others are kept aside with a reason."""
    known = meetings.select("meeting_id", F.col("season").alias("_season"))
    placed = payload.join(known, payload["meeting_key"] == known["meeting_id"], "left")
    good, bad = quarantine.split(
        placed,
        [
            *unreadable(payload),
            *quarantine.required("session_key", "meeting_key"),
            ("Unknown meeting", F.col("meeting_id").isNull()),
            ("Meeting of another season", ~F.col("_season").eqNullSafe(F.lit(season))),
        ],
    )
    rows = good.select(
        F.col("session_key").alias("session_id"),
        F.lit(None).cast("int").alias("og_session_id"),
        "session_type",
        "session_name",
        "meeting_id",
        *ORDER,
    )
    return Loaded(insert_if_absent(rows, sessions, ["session_id"], ORDER).drop(*ORDER), bad)


def session_rows(races: DataFrame, carry: list[str] = ORDER) -> DataFrame:
    """One row per session of a race: two fixed ones and those whose sub-document is present.

    The session id is the text meeting id, round and a fixed suffix, read as a number.
    """

    def entry(suffix: str, kind: str, name: str, given=None):
        row = F.struct(
            composite_id(F.col("meeting_id"), F.col("round"), F.lit(suffix)).cast("bigint").alias("session_id"),
            F.lit(kind).alias("session_type"),
            F.lit(name).alias("session_name"),
        )
        return row if given is None else F.when(F.col(given).isNotNull(), row)

    entries = F.array(
        entry("4", "Qualifying", "Qualifying"),
        entry("", "Race", "Race"),
        entry("1", "Practice", "Practice 1", "first_practice"),
        entry("2", "Practice", "Practice 2", "second_practice"),
        entry("3", "Practice", "Practice 3", "third_practice"),
        entry("5", "Race", "Sprint", "sprint"),
    )
    return races.select("meeting_id", *carry, F.explode(F.array_compact(entries)).alias("s")).select(
        "meeting_id", *carry, "s.*"
    )


def load_race_sessions(races: DataFrame, meetings: DataFrame, sessions: DataFrame) -> Loaded:
    """New sessions of a season document; the meeting is found by (season, round)."""
    known = first_per_key(
        meetings.filter(F.col("season").isNotNull() & F.col("no").isNotNull()).select("season", "no", "meeting_id"),
        ["season", "no"],
        ["meeting_id"],
    )
    matched = races.join(known, (races["season"] == known["season"]) & (races["round"] == known["no"]), "left").select(
        *[races[c] for c in races.columns], "meeting_id"
    )
    good, bad = quarantine.split(matched, [*unreadable(races), ("No meeting for this season and round", F.col("meeting_id").isNull())])
    rows = session_rows(good).withColumn("og_session_id", F.lit(None).cast("int"))
    new = insert_if_absent(rows, sessions, ["session_id"], ORDER)
    return Loaded(new.select(*sessions.columns), bad)


def load_race_meetings(races: DataFrame, circuits: DataFrame, meetings: DataFrame) -> Loaded:
    """New meetings of a season document, keys minted above the highest in use.

    Every source row uses up a key; a (season, round) already stored is skipped,
    so a second run adds nothing.
    """
    by_external = first_per_key(
        circuits.filter(F.col("external_id").isNotNull()).select("external_id", "circuit_id"),
        ["external_id"],
        ["circuit_id"],
    )
    base = highest(meetings, "meeting_id") + STEP
    keyed = mint_keys(races, ORDER, "meeting_id", base, STEP)
    found = keyed.join(by_external, "external_id", "left").withColumn(
        "date_start", date_and_time(F.col("date"), F.col("time"))
    )
    good, bad = quarantine.split(
        found,
        [
            *unreadable(races),
            *quarantine.required("season", "round"),
            ("Unknown circuit", F.col("circuit_id").isNull()),
            ("Malformed date or time", F.col("date_start").isNull()),
        ],
    )
    rows = good.select(
        "meeting_id",
        F.col("race_name").alias("meeting_name"),
        F.lit(None).cast("string").alias("meeting_official_name"),
        "circuit_id",
        "date_start",
        parse_offset(F.lit("00:00:00")).alias("gmt_offset"),
        "season",
        F.col("round").alias("no"),
        *ORDER,
    )
    return Loaded(insert_if_absent(rows, meetings, ["season", "no"], ORDER).drop(*ORDER), bad)


def _load_positions(rows: DataFrame, rejected: DataFrame, positions: DataFrame, small_batch: bool) -> Loaded:
    new = absent(rows, positions, ["driver_number", "session_id"], small_batch)
    base = highest(positions, "position_id") + 1
    minted = mint_keys(new, ["session_id", "driver_number"], "position_id", base, 1)
    return Loaded(minted.select(*positions.columns), rejected)


def load_final_positions(
    events: DataFrame,
    sessions: DataFrame,
    positions: DataFrame,
    small_batch: bool = False,
    below: int | None = NEW_SOURCE_SESSIONS,
) -> Loaded:
    """Last valid position per driver and session of the newer source's event lists.

    ``below``: session ids from there on belong to the older source (None: no
    bound). Invalid events, and results without a stored session, are kept
    aside with a reason.
    """
    older = [] if below is None else [("Session of the older source", F.col("session_key") >= below)]
    rules = [*unreadable(events), *quarantine.required("session_key", "driver_number", "position"), *older]
    good, bad = quarantine.split(events, rules)
    # reduced to one row per key before any join, so a session with very many events is no burden
    final = last_value(good, ["session_key", "driver_number"], "position", ORDER)
    rows = final.withColumnRenamed("session_key", "session_id")
    known = sessions.select(F.col("session_id").alias("_session_id")).distinct()
    placed = rows.join(known, rows["session_id"] == known["_session_id"], "left")
    good, lost = quarantine.split(placed, [("Unknown session", F.col("_session_id").isNull())])
    columns = ["session_id", "driver_number", "position", quarantine.REASON]
    rejected = bad.withColumnRenamed("session_key", "session_id").select(*columns).unionByName(lost.select(*columns))
    return _load_positions(good.drop("_session_id"), rejected, positions, small_batch)


def load_qualifying(
    results: DataFrame,
    sessions: DataFrame,
    meetings: DataFrame,
    positions: DataFrame,
    season: int | None = None,
    small_batch: bool = False,
) -> Loaded:
    """First valid position per driver of the qualifying documents, of one season or of all."""
    asked = meetings if season is None else meetings.filter(F.col("season") == season)
    slots = first_per_key(
        sessions.filter(F.col("session_name") == "Qualifying")
        .join(asked.select("meeting_id", "season", F.col("no").alias("round")), "meeting_id")
        .select("season", "round", "session_id"),
        ["season", "round"],
        ["session_id"],
    )
    good, bad = quarantine.split(results, [*unreadable(results), *quarantine.required("driver_number", "position")])
    first = first_per_key(good, ["season", "round", "driver_number"], ORDER)
    placed = first.join(slots, ["season", "round"], "left")
    good, lost = quarantine.split(placed, [("No qualifying session for this season and round", F.col("session_id").isNull())])
    columns = ["season", "round", "driver_number", "position", quarantine.REASON]
    rejected = bad.select(*columns).unionByName(lost.select(*columns))
    return _load_positions(good.select("session_id", "driver_number", "position"), rejected, positions, small_batch)
