"""Explicit schemas of tables, landed payloads and data files.

The field names are fixed by the payload and table formats they describe.
"""

from __future__ import annotations

# -- relational tables ---------------------------------------------------------

COUNTRIES = "country_id bigint, country_code string, country_name string"
CIRCUITS = "circuit_id bigint, circuit_short_name string, country_id bigint, external_id string"
MEETINGS = (
    "meeting_id bigint, meeting_name string, meeting_official_name string, circuit_id bigint, "
    "date_start timestamp_ntz, gmt_offset interval hour to second, season int, no int"
)
SESSIONS = "session_id bigint, og_session_id int, session_type string, session_name string, meeting_id bigint"
POSITIONS = "position_id bigint, driver_number int, position int, session_id bigint"

TEXT_LIMITS = {
    "country_code": 4,
    "country_name": 255,
    "meeting_name": 255,
    "meeting_official_name": 500,
}

# -- landed JSON payloads ------------------------------------------------------

MEETING_PAYLOAD = (
    "meeting_key bigint, meeting_name string, meeting_official_name string, circuit_key bigint, "
    "circuit_short_name string, country_key bigint, country_code string, country_name string, "
    "date_start string, gmt_offset string, year int"
)
SESSION_PAYLOAD = "session_key bigint, session_type string, session_name string"
POSITION_PAYLOAD = "driver_number int, position int"
CIRCUIT_DOCUMENT = (
    "MRData struct<CircuitTable: struct<Circuits: array<struct<"
    "circuitId: string, circuitName: string, Location: struct<country: string>>>>>"
)
_PRACTICE = "struct<date: string, time: string>"
RACE_DOCUMENT = (
    "MRData struct<RaceTable: struct<Races: array<struct<"
    "season: string, round: string, raceName: string, date: string, time: string, "
    "Circuit: struct<circuitId: string>, "
    f"FirstPractice: {_PRACTICE}, SecondPractice: {_PRACTICE}, ThirdPractice: {_PRACTICE}, Sprint: {_PRACTICE}>>>>"
)
QUALIFYING_DOCUMENT = (
    "MRData struct<RaceTable: struct<Races: array<struct<"
    "season: string, round: string, QualifyingResults: array<struct<number: string, position: string>>>>>>"
)

# -- data files ----------------------------------------------------------------

POINT_CSV = "x double, y double"
LABEL_POINTS = "x double, y double, corner string"
GEOMETRY_DOCUMENT = (
    "trackData array<struct<x: double, y: double>>, "
    "cornersData array<struct<number: bigint, letter: string, x: double, y: double, angle: double>>, "
    "circuitInfo struct<rotation: double>"
)
