import random

import pytest
from pyspark.errors import PySparkException

from gridpanel.plans import panel

SCHEMA = (
    "position_id bigint, driver_number int, position int, session_name string, meeting_id bigint, "
    "meeting_name string, season int, no int"
)


def half_away(x):
    return int(abs(x) + 0.5) * (1 if x >= 0 else -1)


def brute_force(rows, s):
    """The panel by direct look-up, one race row at a time."""
    columns = [f.split()[0] for f in SCHEMA.split(", ")]
    rows = [dict(zip(columns, r)) for r in rows]

    def find(session, driver, **key):
        if any(v is None for v in key.values()):
            return None
        hits = [
            r["position"]
            for r in rows
            if r["session_name"] == session and r["driver_number"] == driver and all(r[k] == v for k, v in key.items())
        ]
        assert len(hits) <= 1
        return hits[0] if hits else None

    def back(value, n):
        return None if value is None else value - n

    def or_else(value, default):
        return default if value is None else value

    out = []
    for r in rows:
        if r["session_name"] != "Race":
            continue
        d, season, no = r["driver_number"], r["season"], r["no"]
        gains = []
        for n in (1, 2, 3):
            race = find("Race", d, season=season, no=back(no, n))
            qualifying = find("Qualifying", d, season=season, no=back(no, n))
            if race is not None and qualifying is not None:
                gains.append(qualifying - race)
        previous = None if no == 1 else find("Race", d, season=season, no=back(no, 1))
        out.append(
            (
                r["position_id"],
                or_else(previous, s.previous_race),
                or_else(find("Race", d, season=back(season, 1), meeting_name=r["meeting_name"]), s.previous_year),
                or_else(find("Qualifying", d, season=season, no=no), s.qualifying),
                half_away(sum(gains) / len(gains)) if gains else s.gain,
                or_else(find("Sprint", d, season=season, no=no), s.sprint),
            )
        )
    return sorted(out)


def features(spark, rows, spec=panel.PanelSpec()):
    built = panel.feature_panel(spark.createDataFrame(rows, SCHEMA), spec)
    wanted = ["position_id", "previous_race_pos", "previous_year_pos", "qualy_pos", "gain", "sprint_pos"]
    return sorted(tuple(r) for r in built.select(*wanted).collect())


def random_results(seed, seasons, periods, drivers):
    draw = random.Random(seed)
    rows, key = [], 0
    for season in seasons:
        for no in periods:
            meeting = season * 1000 + no
            unnumbered, unnamed = draw.random() < 0.15, draw.random() < 0.15
            # at most one venue per season may carry a name for the yearly look-up to be unique
            name = None if unnamed else f"venue {no}"
            for session in ("Qualifying", "Race", "Sprint", "Practice 1"):
                for driver in range(drivers):
                    if draw.random() < 0.25:
                        continue
                    key += 1
                    rows.append(
                        (key, driver, draw.randint(1, 20), session, meeting, name, season, None if unnumbered else no)
                    )
    return rows


@pytest.mark.parametrize("width", [1, 3, 64])
def test_panel_equals_brute_force(spark, width):
    rows = random_results(width, range(2014, 2019), range(0, 9), 6)
    spec = panel.PanelSpec(sentinels=panel.PODIUM_SENTINELS, block_width=width)
    assert features(spark, rows, spec) == brute_force(rows, spec.sentinels)


def test_panel_of_one_entity_over_many_periods(spark):
    """One entity holding nearly all rows is spread over blocks and still exact."""
    rows = random_results(5, [2020], range(1, 400), 1)
    assert features(spark, rows) == brute_force(rows, panel.Sentinels())


def row(key, driver, position, session, no, season=2020, meeting=None, name="venue"):
    return (key, driver, position, session, meeting if meeting is not None else season * 100 + (no or 0), name, season, no)


def test_absent_period_is_not_skipped(spark):
    rows = [row(1, 7, 4, "Race", 2, name="a"), row(2, 7, 9, "Race", 4, name="b")]
    assert [r[1] for r in features(spark, rows)] == [21, 21]


def test_first_period_ignores_an_earlier_one(spark):
    rows = [row(1, 7, 4, "Race", 0, name="a"), row(2, 7, 9, "Race", 1, name="b")]
    assert [r[1] for r in features(spark, rows)] == [21, 21]


def test_unnumbered_meetings_do_not_see_each_other(spark):
    rows = [
        row(1, 7, 4, "Race", None, meeting=1, name="a"),
        row(2, 7, 9, "Race", None, meeting=2, name="b"),
        row(3, 7, 5, "Qualifying", None, meeting=1, name="a"),
        row(4, 7, 6, "Race", None, meeting=3, name="a", season=2021),
    ]
    assert features(spark, rows) == [(1, 21, 21, 21, 0, 21), (2, 21, 21, 21, 0, 21), (4, 21, 4, 21, 0, 21)]


def test_renamed_venue_has_no_previous_year(spark):
    rows = [row(1, 7, 4, "Race", 3, name="old"), row(2, 7, 9, "Race", 3, season=2021, name="new")]
    assert [r[2] for r in features(spark, rows)] == [21, 21]


def test_qualifying_is_matched_by_season_and_period_across_meetings(spark):
    rows = [row(1, 7, 4, "Race", 3, meeting=10), row(2, 7, 6, "Qualifying", 3, meeting=11)]
    assert features(spark, rows)[0][3] == 6


@pytest.mark.parametrize("gains, expected", [((0, 1), 1), ((0, -1), -1), ((2, 3), 3), ((None, 4), 4), ((None, None), 0)])
def test_mean_gain_rounds_half_away_and_skips_missing(spark, gains, expected):
    rows = [row(1, 7, 10, "Race", 4, name="d")]
    for no, gain in zip((2, 3), gains):
        rows.append(row(10 + no, 7, 10, "Race", no, name=f"v{no}"))
        if gain is not None:
            rows.append(row(20 + no, 7, 10 + gain, "Qualifying", no, name=f"v{no}"))
    assert [r[4] for r in features(spark, rows) if r[0] == 1] == [expected]


@pytest.mark.parametrize(
    "rows",
    [
        [row(1, 7, 4, "Race", 2, meeting=1), row(2, 7, 5, "Race", 2, meeting=2, name="x"), row(3, 7, 5, "Race", 3, name="y")],
        [row(1, 7, 4, "Qualifying", 2), row(2, 7, 5, "Qualifying", 2), row(3, 7, 5, "Race", 2)],
    ],
)
def test_second_match_is_an_error(spark, rows):
    with pytest.raises(PySparkException, match="more than one"):
        features(spark, rows)


def test_labels(spark):
    df = spark.createDataFrame([(1,), (3,), (4,), (0,)], "position int")
    got = {r.position: (r.fin_pos, r.label) for r in panel.labelled(df, 3).collect()}
    assert got == {1: ("IN", 1.0), 3: ("IN", 1.0), 4: ("OUT", 0.0), 0: ("OUT", 0.0)}


def test_join_of_the_three_tables(spark):
    positions = spark.createDataFrame([(1, 44, 3, 100), (2, 44, 5, 999)], "position_id bigint, driver_number int, position int, session_id bigint")
    sessions = spark.createDataFrame([(100, "Race", 7)], "session_id bigint, session_name string, meeting_id bigint")
    meetings = spark.createDataFrame([(7, "venue", 2020, 2)], "meeting_id bigint, meeting_name string, season int, no int")
    joined = panel.join_results(positions, sessions, meetings).collect()
    assert [tuple(r) for r in joined] == [(1, 44, 3, "Race", 7, "venue", 2020, 2)]


def _rows(spark, *rows):
    schema = "position_id long, driver_number int, position int, session_name string, meeting_id long, meeting_name string, season int, no int"
    return spark.createDataFrame(list(rows), schema)


def test_look_ups_raise_only_where_they_are_read(spark):
    race, quali = "Race", "Qualifying"
    cases = [
        # a cell with a qualifying row only has nothing to look up
        ((1, 44, 3, race, 1, "A", 2023, 1), (2, 44, 4, race, 1, "A", 2023, 1), (3, 44, 5, quali, 2, "B", 2023, 2)),
        # the first period has no previous one, whatever is stored before it
        ((1, 44, 3, race, 1, "Z", 2023, 0), (2, 44, 4, race, 1, "Z", 2023, 0), (3, 44, 5, race, 2, "B", 2023, 1)),
        # two race rows in the last meeting are two results
        ((1, 44, 3, race, 1, "A", 2023, 1), (2, 44, 4, race, 2, "B", 2023, 2), (3, 44, 9, race, 2, "B", 2023, 2)),
    ]
    for rows in cases:
        expected = sorted((r[0], r[2]) for r in rows if r[3] == race)
        got = panel.feature_panel(_rows(spark, *rows)).collect()
        assert sorted((r.position_id, r.position) for r in got) == expected
    twice = _rows(spark, *cases[0][:2], (3, 44, 5, race, 2, "B", 2023, 2))
    with pytest.raises(PySparkException, match="more than one"):
        panel.feature_panel(twice).collect()
    loose = panel.feature_panel(twice, panel.PanelSpec(strict=False)).collect()
    assert sorted((r.position_id, r.previous_race_pos) for r in loose) == [(1, 21), (2, 21), (3, 4)]
