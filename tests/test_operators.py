import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gridpanel.operators import checks, keyed, nesting, ordering, quarantine, upsert
from gridpanel.operators.intervals import slice_by_interval
from gridpanel.scratch import scratch_root, stage


def hot_rows(n=600, seed=1):
    """A third of all rows in one group."""
    draw = random.Random(seed)
    return [(i, "hot" if draw.random() < 0.34 else f"g{draw.randint(0, 20)}", draw.randint(0, 9)) for i in range(n)]


SCHEMA = "id bigint, g string, v int"


def test_scratch_follows_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert named is None or scratch_root(spark) == named
    staged = stage(spark.range(5), "numbers")
    assert "FileScan" in staged._jdf.queryExecution().executedPlan().toString() and staged.count() == 5


def test_ordered_index_is_the_sorted_position(spark):
    rows = hot_rows()
    placed = ordering.ordered_index(spark.createDataFrame(rows, SCHEMA).repartition(7), [F.desc("v"), "id"])
    expected = {r[0]: i for i, r in enumerate(sorted(rows, key=lambda r: (-r[2], r[0])))}
    assert {r.id: r.row_index for r in placed.collect()} == expected


def test_index_in_group_with_a_hot_group(spark):
    rows = hot_rows() + [(1000, None, 1), (1001, None, 0)]
    placed = ordering.index_in_group(spark.createDataFrame(rows, SCHEMA), ["g"], ["v", "id"]).collect()
    expected = {}
    for g in {r[1] for r in rows}:
        for i, r in enumerate(sorted((r for r in rows if r[1] == g), key=lambda r: (r[2], r[0]))):
            expected[r[0]] = i
    assert {r.id: r.row_index for r in placed} == expected


@pytest.mark.parametrize("block_rows", [1, 7, 65_536])
def test_previous_row_crosses_blocks(spark, block_rows):
    rows = hot_rows(200)
    got = ordering.previous_row(spark.createDataFrame(rows, SCHEMA), ["g"], ["v", "id"], ["id"], block_rows).collect()
    expected = {}
    for g in {r[1] for r in rows}:
        group = sorted((r for r in rows if r[1] == g), key=lambda r: (r[2], r[0]))
        expected.update({r[0]: p[0] if p else None for p, r in zip([None, *group], group)})
    assert {r.id: r.prev_id for r in got} == expected


def test_first_last_and_fastest(spark):
    df = spark.createDataFrame([("a", 1, 5.0), ("a", 2, 3.0), ("a", 3, None), ("b", 9, 3.0), ("b", 4, 3.0)], "k string, o int, v double")
    assert {tuple(r) for r in keyed.first_per_key(df, ["k"], ["o"]).collect()} == {("a", 1, 5.0), ("b", 4, 3.0)}
    assert {tuple(r) for r in keyed.last_value(df, ["k"], "v", ["o"]).collect()} == {("a", None), ("b", 3.0)}
    assert {tuple(r) for r in keyed.fastest(df, ["k"], "v", ["o"]).collect()} == {("a", 2, 3.0), ("b", 4, 3.0)}


def test_insert_if_absent_is_idempotent_and_null_safe(spark):
    stored = spark.createDataFrame([("x", 1), (None, 2)], "k string, v int")
    batch = spark.createDataFrame([("x", 5, 0), ("y", 6, 1), ("y", 7, 0), (None, 8, 2)], "k string, v int, o int")
    new = upsert.insert_if_absent(batch, stored, ["k"], ["o"]).drop("o")
    assert [tuple(r) for r in new.collect()] == [("y", 7)]
    assert upsert.insert_if_absent(batch, stored.unionByName(new), ["k"], ["o"]).count() == 0
    assert upsert.present(batch, stored, ["k"]).count() == 2
    narrowed = upsert.absent(batch, stored, ["k"], small_batch=True).collect()
    assert sorted(tuple(r) for r in narrowed) == sorted(tuple(r) for r in upsert.absent(batch, stored, ["k"]).collect())


def test_fill_if_null_keeps_stored_values(spark):
    stored = spark.createDataFrame([(1, "a", None), (2, "b", "old")], "k int, n string, x string")
    batch = spark.createDataFrame([(1, "z", "new"), (2, "z", "new"), (3, "c", None)], "k int, n string, x string")
    merged = upsert.fill_if_null(stored, batch, ["k"], ["k"])
    assert {tuple(r) for r in merged.collect()} == {(1, "a", "new"), (2, "b", "old"), (3, "c", None)}


def test_minted_keys(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",)], "n string")
    assert {r.n: r.key for r in upsert.mint_keys(df, ["n"], "key", 50_000, 10).collect()} == {"a": 50_000, "b": 50_010, "c": 50_020}
    assert upsert.highest(df.selectExpr("length(n) AS l"), "l") == 1
    assert upsert.highest(df.filter("false").selectExpr("length(n) AS l"), "l") == 0


def test_quarantine_splits_without_losing_rows(spark):
    df = spark.createDataFrame([(2012,), (2014,), (None,), (9999,)], "year int")
    good, bad = quarantine.split(df, [*quarantine.required("year"), quarantine.valid_year("year")])
    assert [r.year for r in good.collect()] == [2014]
    assert {r.year: r.reason for r in bad.collect()} == {
        2012: "Invalid year",
        9999: "Invalid year",
        None: "year is missing",
    }


def test_error_payload_message_wins(spark):
    df = spark.sql("SELECT map('message', 'old', 'code', '410') AS p UNION ALL SELECT CAST(NULL AS map<string,string>)")
    got = df.select(quarantine.error_payload(F.col("p"), F.lit("new")).alias("e")).collect()
    assert sorted((r.e for r in got), key=len) == [{"message": "new"}, {"code": "410", "message": "new"}]


@pytest.mark.parametrize("longest", [1, 40, 400, 100_000])
def test_interval_slice_equals_brute_force(spark, longest):
    draw = random.Random(longest)
    start = datetime(2024, 5, 26)
    points = [("hot" if i % 3 else "cold", start + timedelta(seconds=draw.randint(0, 3000)), i) for i in range(300)]
    laps = []
    for j in range(12):
        begin = start + timedelta(seconds=draw.randint(0, 3000), microseconds=draw.randint(0, 1))
        laps.append(("hot" if j % 2 else "cold", j, begin, begin + timedelta(seconds=draw.randint(-5, longest), microseconds=draw.randint(0, 1))))
    matched = slice_by_interval(
        spark.createDataFrame(points, "k string, ts timestamp_ntz, p int"),
        spark.createDataFrame(laps, "k string, lap int, a timestamp_ntz, b timestamp_ntz"),
        ["k"],
        "ts",
        "a",
        "b",
    )
    expected = {(p[2], lap[1]) for p in points for lap in laps if p[0] == lap[0] and lap[2] <= p[1] < lap[3]}
    got = [(r.p, r.lap) for r in matched.collect()]
    assert len(got) == len(set(got)) and set(got) == expected


def test_interval_slice_ignores_the_session_time_zone(spark):
    """02:30 does not exist in this zone on that day; clock times are compared as they are."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        points = spark.createDataFrame([("a", datetime(2024, 3, 10, 2, 30), 1)], "k string, ts timestamp_ntz, p int")
        lap = [("a", 1, datetime(2024, 3, 10, 2, 0), datetime(2024, 3, 10, 2, 45))]
        laps = spark.createDataFrame(lap, "k string, lap int, a timestamp_ntz, b timestamp_ntz")
        assert slice_by_interval(points, laps, ["k"], "ts", "a", "b").count() == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_no_laps_no_rows(spark):
    points = spark.createDataFrame([("a", datetime(2024, 1, 1), 1)], "k string, ts timestamp_ntz, p int")
    laps = spark.createDataFrame([], "k string, lap int, a timestamp_ntz, b timestamp_ntz")
    assert slice_by_interval(points, laps, ["k"], "ts", "a", "b").count() == 0


def test_children_are_paged_and_empty_lists_stay(spark):
    parents = spark.createDataFrame([(1,), (2,)], "id int")
    children = spark.createDataFrame([(1, i) for i in range(7)], "id int, c int")
    nested = nesting.attach_children(parents, "id", children, "id", ["c"], "cs", page_size=3).collect()
    got = {(r.id, r.page): [c.c for c in r.cs] for r in nested}
    assert {(r.id, r.pages) for r in nested} == {(1, 3), (2, 1)}
    assert got == {(1, 0): [0, 1, 2], (1, 1): [3, 4, 5], (1, 2): [6], (2, 0): []}


def test_constraint_counts(spark):
    df = spark.createDataFrame([(1, "ab"), (1, "abc"), (2, None), (None, "a")], "k int, t string")
    parents = spark.createDataFrame([(1,)], "pk int")
    found = checks.report(
        [
            checks.duplicate_keys(df, ["k"], "dup"),
            checks.orphans(df, "k", parents, "pk", "orphan"),
            checks.nulls(df, "t", "null"),
            checks.longer_than(df, "t", 2, "long"),
        ]
    )
    assert {r.check: r.offending for r in found.collect()} == {"dup": 1, "orphan": 1, "null": 1, "long": 1}
