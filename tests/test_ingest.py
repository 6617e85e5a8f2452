import json
import os
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from gridpanel.plans import documents, ingest
from gridpanel.sources import landing, schemas, tables
from gridpanel.streaming.landing import load_new_positions, load_settled_positions


def land(path, document):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(document if isinstance(document, str) else json.dumps(document))
    return str(path)


@pytest.fixture
def store(spark, tmp_path):
    root = str(tmp_path / "tables")
    tables.create_tables(spark, root)
    return root


def read(spark, root, name):
    return tables.read_table(spark, root, name)


MEETINGS = [
    {
        "meeting_key": 1219, "meeting_name": "Alpha", "meeting_official_name": "Alpha Official", "circuit_key": 61,
        "circuit_short_name": "A-ring", "country_key": 157, "country_code": "AAA", "country_name": "Aland",
        "date_start": "2023-09-15T09:30:00+00:00", "gmt_offset": "08:00:00", "year": 2023,
    },
    {
        "meeting_key": 1220, "meeting_name": "Beta", "meeting_official_name": "Beta Official", "circuit_key": 61,
        "circuit_short_name": "renamed", "country_key": 157, "country_code": "BBB", "country_name": "renamed",
        "date_start": "2023-10-15T09:30:00+00:00", "gmt_offset": "-05:30:00", "year": 2023,
    },
    {"meeting_key": None, "meeting_name": "no key", "circuit_key": 1, "country_key": 1},
    {"meeting_key": 1221, "meeting_name": "long code", "circuit_key": 1, "country_key": 1, "country_code": "TOOLONG"},
]


def load_all_meetings(spark, store, path):
    payload = landing.read_meetings(spark, path)
    loaded = ingest.load_meetings(payload, *[read(spark, store, t) for t in ("countries", "circuits", "meetings")])
    for name in ("countries", "circuits", "meetings"):
        tables.append(loaded[name].rows, store, name)
    return loaded


def test_meetings_load_twice_is_once(spark, store, tmp_path):
    path = land(tmp_path / "m" / "meetings.json", MEETINGS)
    loaded = load_all_meetings(spark, store, path)
    assert loaded["meetings"].rejected.count() == 2
    before = {t: read(spark, store, t).count() for t in ("countries", "circuits", "meetings")}
    load_all_meetings(spark, store, path)
    after = {t: read(spark, store, t).count() for t in ("countries", "circuits", "meetings")}
    assert before == after == {"countries": 1, "circuits": 1, "meetings": 2}
    assert read(spark, store, "countries").first().country_name == "Aland"
    first = read(spark, store, "meetings").orderBy("meeting_id").first()
    assert first.gmt_offset == timedelta(hours=8) and first.no is None and first.season == 2023


def test_malformed_payload_is_kept(spark, tmp_path):
    path = land(tmp_path / "m" / "broken.json", "[{")
    rows = landing.read_meetings(spark, path).cache()
    assert rows.filter(F.col("_corrupt").isNotNull()).count() == 1


def test_sessions_per_meeting(spark, store, tmp_path):
    load_all_meetings(spark, store, land(tmp_path / "m" / "meetings.json", MEETINGS))
    for meeting in (1219, 1220, 999):
        rows = [{"session_key": meeting * 10 + i, "session_type": "Race", "session_name": "Race"} for i in range(2)]
        land(tmp_path / "s" / f"meeting_key={meeting}" / "sessions.json", rows)
    payload = landing.read_sessions(spark, str(tmp_path / "s"))
    new = ingest.load_sessions(payload, read(spark, store, "meetings"), read(spark, store, "sessions"), 2023).rows
    assert sorted(r.session_id for r in new.collect()) == [12190, 12191, 12200, 12201]
    tables.append(new, store, "sessions")
    again = ingest.load_sessions(payload, read(spark, store, "meetings"), read(spark, store, "sessions"), 2023).rows
    assert again.count() == 0


def circuits_document(*rows):
    items = [{"circuitId": i, "circuitName": n, "Location": {"country": c}} for i, n, c in rows]
    return {"MRData": {"CircuitTable": {"Circuits": items}}}


def test_circuits_fill_insert_and_mint(spark, store, tmp_path):
    countries = spark.createDataFrame([(1, "AAA", "Aland")], schemas.COUNTRIES)
    circuits = spark.createDataFrame([(61, "A-ring", 1, None), (62, "B-ring", 1, "kept")], schemas.CIRCUITS)
    path = land(
        tmp_path / "c" / "circuits.json",
        circuits_document(
            ("a", "A-ring", "Aland"), ("b", "B-ring", "Aland"), ("c", "C-ring", "Cland"),
            ("d", "D-ring", "Dland"), ("c2", "C-ring", "Cland"), ("x", None, "Aland"),
        ),
    )
    new_countries, merged, bad = ingest.load_circuits(landing.read_circuits(spark, path), countries, circuits)
    assert {(r.country_id, r.country_name) for r in new_countries.collect()} == {(50_000, "Cland"), (50_010, "Dland")}
    assert {tuple(r) for r in merged.collect()} == {
        (61, "A-ring", 1, "a"), (62, "B-ring", 1, "kept"), (100_020, "C-ring", 50_000, "c"), (100_030, "D-ring", 50_010, "d"),
    }
    assert bad.count() == 1
    tables.append(new_countries, store, "countries")
    tables.replace(merged, store, "circuits")
    again = ingest.load_circuits(
        landing.read_circuits(spark, path), countries.unionByName(new_countries), read(spark, store, "circuits")
    )
    assert again[0].count() == 0 and {tuple(r) for r in again[1].collect()} == {tuple(r) for r in merged.collect()}


RACES = {
    "MRData": {
        "RaceTable": {
            "Races": [
                {"season": "2014", "round": "1", "raceName": "Alpha", "date": "2014-03-16", "time": "06:00:00Z",
                 "Circuit": {"circuitId": "a"}, "FirstPractice": {"date": "d", "time": "t"}, "Sprint": {"date": "d"}},
                {"season": "2014", "round": "2", "raceName": "Gamma", "date": "2014-03-30", "time": "08:00:00Z",
                 "Circuit": {"circuitId": "nowhere"}},
                {"season": "2014", "round": "3", "raceName": "Beta", "date": "2014-04-06", "time": "15:00:00Z",
                 "Circuit": {"circuitId": "b"}, "SecondPractice": {}, "ThirdPractice": {}},
            ]
        }
    }
}


def test_season_document(spark, store, tmp_path):
    path = land(tmp_path / "r" / "2014.json", RACES)
    circuits = spark.createDataFrame([(61, "A-ring", 1, "a"), (62, "B-ring", 1, "b")], schemas.CIRCUITS)
    old = spark.createDataFrame([(1300, "old", None, 61, None, None, 2013, 1)], schemas.MEETINGS)
    tables.append(old, store, "meetings")
    races = landing.read_races(spark, path)
    loaded = ingest.load_race_meetings(races, circuits, read(spark, store, "meetings"))
    assert {(r.meeting_id, r.meeting_name, r.no, str(r.date_start)) for r in loaded.rows.collect()} == {
        (1310, "Alpha", 1, "2014-03-16 06:00:00"), (1330, "Beta", 3, "2014-04-06 15:00:00"),
    }
    assert [r.reason for r in loaded.rejected.collect()] == ["Unknown circuit"]
    tables.append(loaded.rows, store, "meetings")
    assert ingest.load_race_meetings(races, circuits, read(spark, store, "meetings")).rows.count() == 0

    sessions = ingest.load_race_sessions(races, read(spark, store, "meetings"), read(spark, store, "sessions"))
    assert {(r.session_id, r.session_type, r.session_name) for r in sessions.rows.collect()} == {
        (131014, "Qualifying", "Qualifying"), (13101, "Race", "Race"), (131011, "Practice", "Practice 1"),
        (131015, "Race", "Sprint"), (133034, "Qualifying", "Qualifying"), (13303, "Race", "Race"),
        (133032, "Practice", "Practice 2"), (133033, "Practice", "Practice 3"),
    }
    assert sessions.rejected.count() == 1


def test_qualifying_documents(spark, store, tmp_path):
    result = {"season": "2014", "round": "1", "QualifyingResults": [
        {"number": "44", "position": "1"}, {"number": "3", "position": "2"}, {"number": "44", "position": "9"}, {"number": "x", "position": "3"}]}
    path = land(tmp_path / "q" / "1.json", {"MRData": {"RaceTable": {"Races": [result]}}})
    meetings = spark.createDataFrame([(7, "m", None, 1, None, None, 2014, 1)], schemas.MEETINGS)
    sessions = spark.createDataFrame([(70, None, "Qualifying", "Qualifying", 7), (71, None, "Race", "Race", 7)], schemas.SESSIONS)
    stored = spark.createDataFrame([(5, 3, 20, 70)], schemas.POSITIONS)
    loaded = ingest.load_qualifying(landing.read_qualifying(spark, path), sessions, meetings, stored)
    assert [tuple(r) for r in loaded.rows.collect()] == [(6, 44, 1, 70)]
    assert loaded.rejected.count() == 1


def test_final_positions_batch_and_stream(spark, store, tmp_path):
    sessions = spark.createDataFrame([(9001, None, "Race", "Race", 1), (20_000, None, "Race", "Race", 1)], schemas.SESSIONS)
    tables.append(sessions, store, "sessions")
    events = [{"driver_number": d, "position": p} for d, p in [(44, 3), (1, 1), (44, 2), (1, 4), (16, None), (44, 1)]]
    land(tmp_path / "p" / "session_key=9001" / "a.json", events)
    land(tmp_path / "p" / "session_key=20000" / "a.json", events)
    payload = landing.read_position_events(spark, str(tmp_path / "p"))
    loaded = ingest.load_final_positions(payload, read(spark, store, "sessions"), read(spark, store, "positions"))
    assert {(r.session_id, r.driver_number, r.position) for r in loaded.rows.collect()} == {(9001, 44, 1), (9001, 1, 4)}
    reasons = sorted((r.session_id, r.reason) for r in loaded.rejected.collect())
    missing = "position is missing"
    assert reasons == [(9001, missing), *[(20_000, "Session of the older source")] * 5, (20_000, missing)]
    lost = ingest.load_final_positions(payload, read(spark, store, "sessions").limit(0), read(spark, store, "positions"))
    assert lost.rows.count() == 0 and lost.rejected.filter("reason = 'Unknown session'").count() == 2

    def run():
        load_new_positions(spark, str(tmp_path / "p"), store, str(tmp_path / "stream")).awaitTermination()
        return sorted((r.session_id, r.driver_number, r.position) for r in read(spark, store, "positions").collect())

    assert run() == [(9001, 1, 4), (9001, 44, 1)]
    land(tmp_path / "p" / "session_key=9001" / "b.json", [{"driver_number": 44, "position": 9}, {"driver_number": 77, "position": 5}])
    assert run() == [(9001, 1, 4), (9001, 44, 1), (9001, 77, 5)]
    kept_aside = spark.read.parquet(f"{store}/positions_rejected")
    assert kept_aside.filter("reason = 'Session of the older source'").count() == 5


def test_unreadable_documents_are_kept_aside(spark, store, tmp_path):
    good = {"MRData": {"CircuitTable": {"Circuits": [{"circuitId": "a", "circuitName": "A", "Location": {"country": "X"}}]}}}
    land(tmp_path / "c" / "a.json", good)
    (tmp_path / "c" / "b.json").write_text('{"MRData": {"CircuitTable": ')
    circuits, countries = read(spark, store, "circuits"), read(spark, store, "countries")
    _, merged, bad = ingest.load_circuits(landing.read_circuits(spark, str(tmp_path / "c")), countries, circuits)
    assert [r.circuit_short_name for r in merged.collect()] == ["A"]
    assert [r.reason for r in bad.collect()] == ["Unreadable document"]
    for name, reader in (("r", landing.read_races), ("q", landing.read_qualifying)):
        (tmp_path / name).mkdir()
        (tmp_path / name / "b.json").write_text("[{")
        rows = reader(spark, str(tmp_path / name)).collect()
        assert len(rows) == 1 and rows[0]["_corrupt"] == "[{"


def test_a_second_circuit_load_gives_no_key_twice(spark, store, tmp_path):
    def document(*pairs):
        return {"MRData": {"CircuitTable": {"Circuits": [{"circuitId": c, "circuitName": c, "Location": {"country": k}} for c, k in pairs]}}}

    circuits, countries = read(spark, store, "circuits"), read(spark, store, "countries")
    land(tmp_path / "1" / "a.json", document(("A", "Ax")))
    new, merged, _ = ingest.load_circuits(landing.read_circuits(spark, str(tmp_path / "1")), countries, circuits)
    land(tmp_path / "2" / "a.json", document(("B", "Bx"), ("A", "Ax"), ("C", "Ax")))
    stored = countries.unionByName(new)
    more, again, _ = ingest.load_circuits(landing.read_circuits(spark, str(tmp_path / "2")), stored, merged)
    ids = [r.country_id for r in stored.unionByName(more).collect()]
    assert len(ids) == len(set(ids)) == 2
    ids = [r.circuit_id for r in again.collect()]
    assert len(ids) == len(set(ids)) == 3


def test_seasons_to_load(spark):
    asked = spark.createDataFrame([(2013,), (2014,), (2015,), (2015,), (None,), (2999,)], "season int")
    stored = spark.createDataFrame([(2014,)], "season int")
    plan = {r.season: r.action for r in ingest.seasons_to_load(asked, stored).collect()}
    assert plan == {2013: "invalid", 2014: "serve", 2015: "load", None: "invalid", 2999: "invalid"}


def test_documents(spark):
    countries = spark.createDataFrame([(1, "AAA", "Aland"), (2, None, "Empty")], schemas.COUNTRIES)
    circuits = spark.createDataFrame([(61, "A-ring", 1, "a"), (62, "B-ring", 1, None)], schemas.CIRCUITS)
    got = [json.loads(r.document) for r in documents.as_json(documents.country_documents(countries, circuits)).collect()]
    by_id = {d["country_id"]: d for d in got}
    assert [c["circuit_short_name"] for c in by_id[1]["circuits"]] == ["A-ring", "B-ring"]
    assert by_id[2]["circuits"] == [] and by_id[2]["country_code"] is None

    meetings = spark.sql(
        "SELECT 5L AS meeting_id, 'Alpha' AS meeting_name, CAST(NULL AS string) AS meeting_official_name, 61L AS circuit_id,"
        " TIMESTAMP_NTZ '2023-09-15 09:30:00' AS date_start, INTERVAL '-05:30:00' HOUR TO SECOND AS gmt_offset,"
        " 2023 AS season, CAST(NULL AS int) AS no"
    )
    sessions = spark.createDataFrame([(50, None, "Race", "Race", 5)], schemas.SESSIONS)
    (doc,) = [json.loads(r.document) for r in documents.as_json(documents.session_documents(sessions, meetings, circuits)).collect()]
    assert doc["meeting"]["circuit"] == {"circuit_id": 61, "circuit_short_name": "A-ring"}
    assert doc["meeting"]["date_start"] == "2023-09-15T09:30:00" and doc["meeting"]["gmt_offset"] == "-5:30:00"
    nested = documents.circuit_documents(circuits, countries).filter("circuit_id = 62").first()
    assert nested.country.country_name == "Aland"


def test_a_failed_commit_leaves_all_tables_as_they_were(spark, store):
    country = spark.createDataFrame([(1, "AAA", "Aland")], schemas.COUNTRIES)
    circuit = spark.createDataFrame([(61, "A-ring", 1, None)], schemas.CIRCUITS)
    first = tables.commit(spark, store, {"countries": tables.Change(country), "circuits": tables.Change(circuit)})
    fails = spark.range(3).selectExpr("id AS circuit_id", "string(id) AS circuit_short_name", "raise_error('lost') AS country_id", "'' AS external_id")
    more = spark.createDataFrame([(2, "BBB", "Bland")], schemas.COUNTRIES)
    with pytest.raises(Exception, match="lost"):
        tables.commit(spark, store, {"countries": tables.Change(more), "circuits": tables.Change(fails, replace=True)})
    assert [r.country_id for r in read(spark, store, "countries").collect()] == [1]
    assert [r.circuit_id for r in read(spark, store, "circuits").collect()] == [61]
    renamed = read(spark, store, "circuits").withColumn("circuit_short_name", F.lit("new"))
    second = tables.commit(spark, store, {"countries": tables.Change(more), "circuits": tables.Change(renamed, replace=True)})
    assert second == first + 1
    assert sorted(r.country_id for r in read(spark, store, "countries").collect()) == [1, 2]
    assert [r.circuit_short_name for r in read(spark, store, "circuits").collect()] == ["new"]
    assert [r.circuit_short_name for r in tables.read_table(spark, store, "circuits", first).collect()] == ["A-ring"]


def test_of_two_commits_with_one_number_one_wins(spark, store, monkeypatch):
    country = spark.createDataFrame([(1, "AAA", "Aland")], schemas.COUNTRIES)
    before = tables._latest(tables._Store(spark, store))
    tables.append(country, store, "countries")
    monkeypatch.setattr(tables, "_latest", lambda _: (before[0], dict(before[1])))
    with pytest.raises(Exception, match="(?i)exist"):
        tables.append(country, store, "countries")
    monkeypatch.undo()
    assert read(spark, store, "countries").count() == 1


def test_a_later_file_revises_a_session_until_it_is_settled(spark, store, tmp_path):
    sessions = spark.createDataFrame([(9001, None, "Race", "Race", 1), (9002, None, "Race", "Race", 1)], schemas.SESSIONS)
    tables.append(sessions, store, "sessions")
    folder = tmp_path / "p"

    def arrive(session, name, rows, hours):
        path = land(folder / f"session_key={session}" / name, rows)
        os.utime(path, (1_700_000_000 + 3600 * hours,) * 2)

    def run():
        for _ in range(2):  # the watermark of one run decides what the next one settles
            load_settled_positions(spark, str(folder), store, str(tmp_path / "stream"), quiet="6 hours").awaitTermination()
        return sorted((r.session_id, r.driver_number, r.position) for r in read(spark, store, "positions").collect())

    arrive(9001, "a.json", [{"driver_number": 44, "position": 3}, {"driver_number": 1, "position": 1}, {"driver_number": 44, "position": 2}], 0)
    assert run() == []
    arrive(9001, "b.json", [{"driver_number": 44, "position": 1}, {"driver_number": 1, "position": 2}], 2)
    assert run() == []
    arrive(9002, "a.json", [{"driver_number": 16, "position": 5}], 20)
    arrive(9002, "broken.json", '[{"driver_number": 1', 20)
    settled = run()
    assert settled == [(9001, 1, 2), (9001, 44, 1)]
    first = ingest.load_final_positions(landing.read_position_events(spark, str(folder / "session_key=9001")).withColumn("session_key", F.lit(9001)), read(spark, store, "sessions"), read(spark, store, "positions").limit(0))
    assert {(r.session_id, r.driver_number, r.position) for r in first.rows.collect()} == set(settled)


def test_panel_text_refuses_a_second_result(spark, store):
    from gridpanel.plans import panel_text

    tables.commit(spark, store, {
        "meetings": tables.Change(spark.createDataFrame([(1, "m", None, None, None, None, 2020, 1), (2, "n", None, None, None, None, 2020, 2)], schemas.MEETINGS)),
        "sessions": tables.Change(spark.createDataFrame([(10, None, "Race", "Race", 1), (11, None, "Race", "Race", 1), (20, None, "Race", "Race", 2)], schemas.SESSIONS)),
        "positions": tables.Change(spark.createDataFrame([(1, 44, 1, 10), (2, 44, 2, 11), (3, 44, 5, 20)], schemas.POSITIONS)),
    })
    with pytest.raises(Exception, match="(?i)scalar|more than one"):
        panel_text.panel_from_text(spark, store).collect()
    tables.replace(read(spark, store, "positions").where("position_id <> 2"), store, "positions")
    rows = panel_text.panel_from_text(spark, store).collect()
    assert {(r.position_id, r.previous_race_pos, r.qualy_pos) for r in rows} == {(1, 21, 21), (3, 1, 21)}
