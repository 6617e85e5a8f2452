import json
import math

import pytest
from pyspark.sql import functions as F

from gridpanel.functions import scalars
from gridpanel.plans import tracks
from gridpanel.sources import files

# Corners (x, y, angle) of a track turned by 315 degrees, and where their labels stand.
ROTATION = 315.0
CORNERS = [
    (1, -7381.10693359375, -4719.94921875, 140.3846313043515),
    (2, -3634.549072265625, -3769.346435546875, 103.01511724015117),
    (3, -2275.6494140625, -3071.90087890625, 168.94984234500842),
    (19, -6718.7294921875, -9704.8701171875, -137.085449208191),
]
LABELS = {
    "1": (-8603.659497855897, 2379.5162519074097),
    "2": (-4970.49697476096, 328.77781209299246),
    "3": (-4060.5225430702294, -148.27141963823055),
    "19": (-12112.907489062029, -2093.3253260829497),
}


def document():
    return {
        "trackData": [{"x": float(i), "y": float(i * i)} for i in range(5)],
        "cornersData": [{"number": n, "letter": "", "x": x, "y": y, "angle": a} for n, x, y, a in CORNERS],
        "circuitInfo": {"rotation": ROTATION},
    }


def test_label_points_match_the_known_ones(spark, tmp_path):
    (tmp_path / "track.json").write_text(json.dumps(document(), indent=4))
    points, corners, rotation, rejected = files.read_geometry(spark, str(tmp_path / "track.json"))
    assert rejected.count() == 0
    got = {r.corner: (r.x, r.y) for r in tracks.labels(corners, rotation).collect()}
    assert set(got) == set(LABELS)
    for corner, (x, y) in LABELS.items():
        assert math.isclose(got[corner][0], x, abs_tol=1e-9) and math.isclose(got[corner][1], y, abs_tol=1e-9)
    assert [r.ordinal for r in points.orderBy("ordinal").collect()] == list(range(5))


@pytest.mark.parametrize("page_size", [2, 100])
def test_geometry_document_round_trip(spark, tmp_path, page_size):
    (tmp_path / "track.json").write_text(json.dumps(document()))
    parts = tracks.geometry_documents(*files.read_geometry(spark, str(tmp_path / "track.json"))[:3], page_size)
    assert {r.pages for r in parts.collect()} == {3 if page_size == 2 else 1}
    pages = [json.loads(r.document) for r in parts.orderBy("page").collect()]
    assert len(pages) == (3 if page_size == 2 else 1)
    assert [p for page in pages for p in page.get("trackData", [])] == document()["trackData"]
    assert [c for page in pages for c in page.get("cornersData", [])] == document()["cornersData"]
    assert pages[0]["circuitInfo"] == {"rotation": ROTATION}


def test_broken_geometry_is_kept_with_a_reason(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(document()))
    (tmp_path / "b.json").write_text(json.dumps(document())[:60])
    read = files.read_geometry(spark, str(tmp_path))
    assert read.points.count() == 5 and read.rotations.count() == 1
    (bad,) = read.rejected.collect()
    assert bad.track.endswith("b.json") and bad.reason == "Unreadable document" and bad["_corrupt"]


def test_rotation_equals_complex_product(spark):
    rows = [(1.0, 2.0, 30.0), (-3.5, 0.25, -200.0)]
    df = spark.createDataFrame(rows, "x double, y double, rotation double")
    for (x, y, a), r in zip(rows, tracks.rotated(df).collect()):
        z = complex(x, y) * complex(math.cos(math.radians(a)), math.sin(math.radians(a)))
        assert math.isclose(r.x, z.real) and math.isclose(r.y, z.imag)


def test_fit_to_box(spark):
    df = spark.createDataFrame([("t", -10.0, 5.0), ("t", 30.0, 25.0), ("one", 7.0, 7.0)], "track string, x double, y double")
    got = {(r.track, r.x, r.y) for r in tracks.fit_to_box(df, 800, 600).collect()}
    assert got == {("t", 0.0, 0.0), ("t", 800.0, 400.0), ("one", 0.0, 0.0)}


def test_segments(spark):
    df = spark.createDataFrame([("t", i, float(i), float(i * i)) for i in range(4)] + [("u", 0, 9.0, 9.0)], "track string, o int, x double, y double")
    got = sorted((r.o, r.mid_x, r.mid_y) for r in tracks.segments(df, ["o"]).collect())
    assert got == [(1, 0.5, 0.5), (2, 1.5, 2.5), (3, 2.5, 6.5)]


ARFF = """% comment
@RELATION demo

@ATTRIBUTE prev_race NUMERIC
@ATTRIBUTE 'class' { IN, OUT}

@DATA
-1,IN
 4 , OUT
?,IN
"""


def test_arff_round_trip(spark, tmp_path):
    (tmp_path / "a.arff").write_text(ARFF)
    path = str(tmp_path / "a.arff")
    assert files.arff_schema(spark, path) == "`prev_race` double, `class` string"
    assert files.arff_schema(spark, path, first_lines=2) == "`prev_race` double, `class` string"
    rows = files.read_arff(spark, path, "prev_race int, class string")
    assert sorted(map(tuple, rows.collect()), key=str) == [(-1, "IN"), (4, "OUT"), (None, "IN")]
    out = str(tmp_path / "out")
    files.write_lines(files.arff_lines(rows, "demo", {"prev_race": "NUMERIC", "class": "{ IN, OUT}"}, ["prev_race"]), out)
    parts = sorted(p for p in (tmp_path / "out").iterdir() if p.name.startswith("part-"))
    lines = "".join(p.read_text() for p in parts).splitlines()
    assert lines[:6] == ["@RELATION demo", "", "@ATTRIBUTE prev_race NUMERIC", "@ATTRIBUTE class { IN, OUT}", "", "@DATA"]
    assert lines[6:] == ["?,IN", "-1,IN", "4,OUT"]


def test_arff_quotes_special_values(spark):
    values = ["plain", "two words", "a,b", "it's", "back\\slash", ""]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "n int, t string")
    lines = files.arff_lines(df, "demo", {"n": "NUMERIC", "t": "STRING"}, ["n"])
    back = files.arff_rows(lines, "n int, t string", "line")
    assert [(r.n, r.t or "") for r in back.orderBy("n").collect()] == list(enumerate(values))


def test_point_files(spark, tmp_path):
    (tmp_path / "p.txt").write_text("1.5,2.5\n-3,4\n")
    (tmp_path / "p.json").write_text('[{"x": 1.5, "y": 2.5, "corner": "1"}]')
    assert [tuple(r) for r in files.read_points_csv(spark, str(tmp_path / "p.txt")).collect()] == [(1.5, 2.5), (-3.0, 4.0)]
    assert [tuple(r) for r in files.read_label_points(spark, str(tmp_path / "p.json")).collect()] == [(1.5, 2.5, "1")]


@pytest.mark.parametrize(
    "text, shown",
    [("08:00:00", "8:00:00"), ("-05:30:00", "-5:30:00"), ("00:00:00", "0:00:00"), ("26:00:01", "26:00:01"), ("soon", None), (None, None)],
)
def test_offset_text(spark, text, shown):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(scalars.interval_text(scalars.parse_offset(F.col("t"))).alias("r")).first().r == shown


def test_times_and_rounding(spark):
    df = spark.createDataFrame([("2014-03-16", "06:00:00Z", 2.5), ("bad", "06:00:00Z", 3.5)], "d string, t string, x double")
    got = df.select(
        scalars.iso_timestamp(scalars.date_and_time(F.col("d"), F.col("t"))).alias("iso"), scalars.round_half_even(F.col("x")).alias("r")
    ).collect()
    assert [tuple(r) for r in got] == [("2014-03-16T06:00:00", 2), (None, 4)]
    micro = spark.sql("SELECT TIMESTAMP_NTZ '2024-01-01 00:00:07.179575' AS t").select(scalars.iso_timestamp(F.col("t")).alias("iso"))
    assert micro.first().iso == "2024-01-01T00:00:07.179575"


def test_geometry_documents_are_parsed_once(spark, folder):
    from gridpanel.catalog import documents

    plan = documents.geometry_round_trip(spark, folder)._jdf.queryExecution().toString().lower()
    assert "from_json" not in plan and "jsontostructs" not in plan


def test_geometry_documents_of_odd_tracks(spark):
    points = spark.createDataFrame([("a", 1, 2.0, 3.0), ("a", 0, 1.0, 1.0), ("a", None, 9.0, 9.0), (None, 0, 5.0, 5.0)], "track string, ordinal int, x double, y double")
    corners = spark.createDataFrame([("a", None, 1, "A", 1.0, 1.0, 90.0), ("b", 3, 2, None, 1.0, 1.0, 0.0)], "track string, ordinal int, number bigint, letter string, x double, y double, angle double")
    rotations = spark.createDataFrame([("a", 10.0), ("a", 20.0), ("c", 30.0)], "track string, rotation double")
    got = sorted(((r.track, r.page, r.pages, r.document) for r in tracks.geometry_documents(points, corners, rotations, 2).collect()), key=str)
    both = '{"trackData":[{"x":1.0,"y":1.0},{"x":2.0,"y":3.0}],"circuitInfo":{"rotation":%s}}'
    assert got == sorted(
        [
            ("a", 0, 1, both % "10.0"),
            ("a", 0, 1, both % "20.0"),
            ("a", None, 1, '{"trackData":[{"x":9.0,"y":9.0}]}'),
            ("a", None, 1, '{"cornersData":[{"number":1,"letter":"A","x":1.0,"y":1.0,"angle":90.0}]}'),
            ("b", 1, 2, '{"cornersData":[{"number":2,"x":1.0,"y":1.0,"angle":0.0}]}'),
            ("c", 0, 1, '{"circuitInfo":{"rotation":30.0}}'),
        ],
        key=str,
    )
