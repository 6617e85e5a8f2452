"""Nested JSON documents and nested payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridpanel.functions.scalars import parse_offset
from gridpanel.operators import quarantine
from gridpanel.operators.nesting import attach_children, attach_parent
from gridpanel.plans import documents, ingest, tracks
from gridpanel.scratch import stage
from gridpanel.sources import files, landing, schemas
from gridpanel.sources.landing import qualifying_rows
from gridpanel.sources.tables import read_inputs

def nested_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Nations with their region and, page by page, their customers."""
    region, nation, customer = read_inputs(spark, folder, "region", "nation", "customer")
    with_region = attach_parent(nation, "n_regionkey", region, "r_regionkey", "region").drop("n_regionkey")
    children = customer.select("c_nationkey", "c_custkey", "c_name")
    nested = attach_children(with_region, "n_nationkey", children, "c_nationkey", ["c_custkey"], "customers")
    return nested.select("n_nationkey", "page", F.to_json(F.struct(*nested.columns)).alias("document"))


def country_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Nations as countries, customers as circuits: stored countries with their list of circuits."""
    nation, customer = read_inputs(spark, folder, "nation", "customer")
    countries = nation.select(F.col("n_nationkey").alias("country_id"), F.substring("n_name", 1, 4).alias("country_code"), F.col("n_name").alias("country_name"))
    circuits = customer.select(F.col("c_custkey").alias("circuit_id"), F.col("c_name").alias("circuit_short_name"), F.col("c_nationkey").alias("country_id"), F.lit(None).cast("string").alias("external_id"))
    nested = documents.country_documents(countries, circuits)
    return nested.select("country_id", "page", "pages", F.to_json(F.struct("country_id", "country_code", "country_name", "circuits")).alias("document"))


def _texts(rows: DataFrame, key: str, document: Column) -> DataFrame:
    """JSON text of each row's document; every thirteenth is cut short, as a broken transfer leaves it."""
    text = F.to_json(document)
    broken = F.col(key) % 13 == 0
    return rows.select(F.col(key).cast("string").alias("_file"), F.when(broken, F.substring(text, 1, 40)).otherwise(text).alias("value"))


def circuit_document_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Customers of a nation and market segment as a nested circuit document, taken apart again; broken ones with a reason."""
    (customer,) = read_inputs(spark, folder, "customer")
    circuits = F.array(
        *[
            F.struct(
                F.concat(F.lit(f"c{k}-"), F.col("c_custkey").cast("string")).alias("circuitId"),
                F.col("c_name").alias("circuitName"),
                F.struct(F.col("c_mktsegment").alias("country")).alias("Location"),
            )
            for k in range(2)
        ]
    )
    document = F.struct(F.struct(F.struct(circuits.alias("Circuits")).alias("CircuitTable")).alias("MRData"))
    parsed = landing.parse_documents(_texts(customer, "c_custkey", document), schemas.CIRCUIT_DOCUMENT)
    rows = landing.circuit_rows(parsed)
    reason = quarantine.with_reason(rows, [("Unreadable document", F.col(landing.CORRUPT).isNotNull())])
    filled = {c: F.coalesce(c, F.lit("")) for c in ("external_id", "circuit_name", "country_name", "reason")}
    return reason.withColumns(filled).select(F.col("_file").cast("bigint").alias("c_custkey"), F.coalesce("ordinal", F.lit(-1)).alias("ordinal"), *filled)


def race_document_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as nested season documents with optional sessions, taken apart again; broken ones with a reason."""
    (orders,) = read_inputs(spark, folder, "orders")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    slot = F.struct(day.alias("date"), F.lit("06:00:00Z").alias("time"))
    race = F.struct(
        F.year("o_orderdate").cast("string").alias("season"),
        F.month("o_orderdate").cast("string").alias("round"),
        F.col("o_orderpriority").alias("raceName"),
        day.alias("date"),
        F.struct(F.col("o_custkey").cast("string").alias("circuitId")).alias("Circuit"),
        F.when(F.col("o_orderstatus") != "P", slot).alias("FirstPractice"),
        F.when(F.col("o_orderstatus") == "F", slot).alias("Sprint"),
    )
    document = F.struct(F.struct(F.struct(F.array(race).alias("Races")).alias("RaceTable")).alias("MRData"))
    parsed = landing.parse_documents(_texts(orders, "o_orderkey", document), schemas.RACE_DOCUMENT)
    rows = quarantine.with_reason(landing.race_rows(parsed), [("Unreadable document", F.col(landing.CORRUPT).isNotNull())])
    return rows.select(
        F.col("_file").cast("bigint").alias("o_orderkey"),
        F.coalesce("season", F.lit(-1)).alias("season"),
        F.coalesce("round", F.lit(-1)).alias("round"),
        F.coalesce("race_name", F.lit("")).alias("race_name"),
        F.coalesce("external_id", F.lit("")).alias("external_id"),
        F.col("first_practice").isNotNull().alias("practised"),
        F.coalesce("sprint.date", F.lit("")).alias("sprint_date"),
        F.coalesce("reason", F.lit("")).alias("reason"),
    )


def geometry_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as track points and corners: written as documents, some broken, read back as points; pages of three."""
    (lineitem,) = read_inputs(spark, folder, "lineitem")
    at = (F.col("l_linenumber") - 1).cast("int").alias("ordinal")
    track = F.col("l_orderkey").cast("string").alias("track")
    points = lineitem.select(track, at, F.col("l_quantity").cast("double").alias("x"), F.col("l_suppkey").cast("double").alias("y"))
    returned = lineitem.where("l_returnflag = 'R'")
    corners = returned.select(track, at, F.col("l_linenumber").cast("bigint").alias("number"), F.lit("A").alias("letter"), F.lit(1.0).alias("x"), F.lit(2.0).alias("y"), F.lit(90.0).alias("angle"))
    rotations = lineitem.select(track).distinct().withColumn("rotation", (F.col("track").cast("bigint") % 360).cast("double"))
    written = tracks.geometry_documents(points, corners, rotations, page_size=3)
    broken = F.col("track").cast("bigint") % 13 == 0
    texts = written.select(
        F.concat_ws("/", "track", "page", "pages").alias("_file"), F.when(broken, F.substring("document", 1, 25)).otherwise(F.col("document")).alias("value")
    )
    # parsed once for the four kinds of rows below
    read = files.geometry_rows(stage(landing.parse_documents(texts, schemas.GEOMETRY_DOCUMENT), "geometry"))
    none = [F.lit(-1).alias("ordinal"), F.lit(-1.0).alias("x")]
    rows = read.points.select("track", F.lit("point").alias("kind"), "ordinal", "x", F.lit("").alias("reason"))
    rows = rows.unionByName(read.corners.select("track", F.lit("corner").alias("kind"), "ordinal", F.col("number").cast("double").alias("x"), F.lit("").alias("reason")))
    rows = rows.unionByName(read.rotations.select("track", F.lit("rotation").alias("kind"), F.lit(-1).alias("ordinal"), F.col("rotation").alias("x"), F.lit("").alias("reason")))
    return rows.unionByName(read.rejected.select("track", F.lit("rejected").alias("kind"), *none, "reason"))


def _stored(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Customers as circuits, orders as meetings, order lines as sessions."""
    customer, orders, lineitem = read_inputs(spark, folder, "customer", "orders", "lineitem")
    circuits = customer.select(
        F.col("c_custkey").alias("circuit_id"), F.col("c_name").alias("circuit_short_name")
    )
    shift = F.when(F.col("o_orderstatus") == "F", "-05:30:00").otherwise("08:00:00")
    meetings = orders.select(
        F.col("o_orderkey").alias("meeting_id"),
        F.col("o_orderpriority").alias("meeting_name"),
        F.lit(None).cast("string").alias("meeting_official_name"),
        F.col("o_custkey").alias("circuit_id"),
        F.col("o_orderdate").alias("date_start"),
        parse_offset(shift).alias("gmt_offset"),
        F.year("o_orderdate").alias("season"),
        F.month("o_orderdate").alias("no"),
    )
    sessions = lineitem.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("session_id"),
        F.lit(None).cast("int").alias("og_session_id"),
        F.col("l_returnflag").alias("session_type"),
        F.col("l_linestatus").alias("session_name"),
        F.col("l_orderkey").alias("meeting_id"),
    )
    return circuits, meetings, sessions


def meeting_documents(spark: SparkSession, folder: str) -> DataFrame:
    circuits, meetings, _ = _stored(spark, folder)
    return documents.as_json(documents.meeting_documents(meetings, circuits))


def session_documents(spark: SparkSession, folder: str) -> DataFrame:
    circuits, meetings, sessions = _stored(spark, folder)
    return documents.as_json(documents.session_documents(sessions, meetings, circuits))


def season_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Order years and the years ten after them as requested seasons, filled orders as the stored meetings."""
    (orders,) = read_inputs(spark, folder, "orders")
    rows = orders.select(
        F.col("o_orderkey").alias("meeting_id"),
        F.col("o_orderpriority").alias("meeting_name"),
        F.year("o_orderdate").alias("season"),
        F.month("o_orderdate").alias("no"),
        "o_orderstatus",
    )
    stored = rows.filter("o_orderstatus = 'F'").drop("o_orderstatus")
    asked = rows.select("season").unionByName(rows.select((F.col("season") + 10).alias("season"))).distinct()
    plan = ingest.seasons_to_load(asked, stored, after=1995, latest=F.lit(2006))
    found = documents.season_documents(plan, stored)
    return found.select("season", "action", F.coalesce("at", F.lit(-1)).alias("at"), F.coalesce("document", F.lit("")).alias("document"))


def nested_payload_rows(spark: SparkSession, folder: str) -> DataFrame:
    """A doubly nested result document per event, as text, taken apart again."""
    (events,) = read_inputs(spark, folder, "events")
    k = F.get_json_object("props", "$.k")
    entry = '{"number": "%s", "position": "%s"}'
    text = F.concat(
        F.format_string(
            '{"MRData": {"RaceTable": {"Races": [{"season": "%s", "round": "%s", ', F.year("ts"), F.month("ts")
        ),
        F.format_string(f'"QualifyingResults": [{entry}, {entry}]', "user_id", k, F.length("event_type"), k),
        F.lit("}]}}}"),
    )
    parsed = events.select(
        F.col("event_id").cast("string").alias("_file"), F.from_json(text, schemas.QUALIFYING_DOCUMENT).alias("doc")
    )
    return qualifying_rows(parsed.select("_file", "doc.MRData")).select(
        F.col("_file").cast("bigint").alias("event_id"), "ordinal", "season", "round", "driver_number", "position"
    )


#: Children per document where nothing else is asked for.
PAGE = 1000

_MEETING_SQL = """
meetings AS (
  SELECT o_orderkey AS meeting_id,
         {'meeting_id': o_orderkey, 'meeting_name': o_orderpriority, 'meeting_official_name': CAST(NULL AS VARCHAR),
          'circuit': CASE WHEN c_custkey IS NULL THEN NULL
                     ELSE {'circuit_id': c_custkey, 'circuit_short_name': c_name} END,
          'date_start': strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S'),
          'gmt_offset': CASE WHEN o_orderstatus = 'F' THEN '-5:30:00' ELSE '8:00:00' END,
          'season': year(o_orderdate), 'no': month(o_orderdate)} AS meeting
  FROM orders LEFT JOIN customer ON c_custkey = o_custkey
)
"""

QUERIES = {
    "season_documents": season_documents,
    "nested_documents": nested_documents,
    "country_documents": country_documents,
    "circuit_document_rows": circuit_document_rows,
    "race_document_rows": race_document_rows,
    "geometry_round_trip": geometry_round_trip,
    "meeting_documents": meeting_documents,
    "session_documents": session_documents,
    "nested_payload_rows": nested_payload_rows,
}

SQL = {
    "season_documents": """
WITH rows_ AS (
  SELECT o_orderkey AS meeting_id, o_orderpriority AS meeting_name, CAST(year(o_orderdate) AS INTEGER) AS season,
         CAST(month(o_orderdate) AS INTEGER) AS no, o_orderstatus
  FROM orders
),
asked AS (SELECT season FROM rows_ UNION SELECT season + 10 FROM rows_),
plan AS (
  SELECT season, CASE WHEN season <= 1995 OR season > 2006 THEN 'invalid'
                      WHEN season IN (SELECT season FROM rows_ WHERE o_orderstatus = 'F') THEN 'serve' ELSE 'load' END AS action
  FROM asked
)
SELECT r.season, 'serve' AS action, row_number() OVER (PARTITION BY r.season ORDER BY no, meeting_id) - 1 AS at,
       CAST(to_json({'meeting_id': meeting_id, 'meeting_name': meeting_name, 'season': r.season, 'no': no}) AS VARCHAR) AS document
FROM rows_ r JOIN plan p ON p.season = r.season AND p.action = 'serve' WHERE o_orderstatus = 'F'
UNION ALL SELECT season, action, -1, '' FROM plan WHERE action <> 'serve'""",
    "nested_documents": f"""
WITH placed AS (
  SELECT c_nationkey, c_custkey, c_name,
         (row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1) // {PAGE} AS page,
         (count(*) OVER (PARTITION BY c_nationkey) - 1) // {PAGE} + 1 AS pages
  FROM customer
),
listed AS (
  SELECT c_nationkey, page, pages, list({{'c_custkey': c_custkey, 'c_name': c_name}} ORDER BY c_custkey) AS customers
  FROM placed GROUP BY c_nationkey, page, pages
)
SELECT n_nationkey, coalesce(page, 0) AS page,
       CAST(to_json({{'n_nationkey': n_nationkey, 'n_name': n_name,
                      'region': {{'r_regionkey': r_regionkey, 'r_name': r_name}},
                      'page': coalesce(page, 0), 'pages': coalesce(pages, 1), 'customers': coalesce(customers, [])}}) AS VARCHAR) AS document
FROM nation JOIN region ON r_regionkey = n_regionkey LEFT JOIN listed ON c_nationkey = n_nationkey""",
    "country_documents": f"""
WITH placed AS (
  SELECT c_nationkey, c_custkey, c_name,
         (row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1) // {PAGE} AS page,
         (count(*) OVER (PARTITION BY c_nationkey) - 1) // {PAGE} + 1 AS pages
  FROM customer
),
listed AS (
  SELECT c_nationkey, page, pages, list({{'circuit_id': c_custkey, 'circuit_short_name': c_name}} ORDER BY c_custkey) AS circuits
  FROM placed GROUP BY c_nationkey, page, pages
)
SELECT n_nationkey AS country_id, coalesce(page, 0) AS page, coalesce(pages, 1) AS pages,
       CAST(to_json({{'country_id': n_nationkey, 'country_code': left(n_name, 4), 'country_name': n_name, 'circuits': coalesce(circuits, [])}}) AS VARCHAR) AS document
FROM nation LEFT JOIN listed ON c_nationkey = n_nationkey""",
    "circuit_document_rows": """
SELECT c_custkey, k AS ordinal, 'c' || k || '-' || c_custkey AS external_id, c_name AS circuit_name, c_mktsegment AS country_name, '' AS reason
FROM customer CROSS JOIN (SELECT unnest([0, 1]) AS k) WHERE c_custkey % 13 <> 0
UNION ALL SELECT c_custkey, -1, '', '', '', 'Unreadable document' FROM customer WHERE c_custkey % 13 = 0""",
    "race_document_rows": """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS season, CAST(month(o_orderdate) AS INTEGER) AS round, o_orderpriority AS race_name,
       CAST(o_custkey AS VARCHAR) AS external_id, o_orderstatus <> 'P' AS practised,
       CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y-%m-%d') ELSE '' END AS sprint_date, '' AS reason
FROM orders WHERE o_orderkey % 13 <> 0
UNION ALL SELECT o_orderkey, -1, -1, '', '', false, '', 'Unreadable document' FROM orders WHERE o_orderkey % 13 = 0""",
    "geometry_round_trip": """
WITH lines_ AS (
  SELECT *, (l_linenumber - 1) // 3 AS page, (max(l_linenumber) OVER (PARTITION BY l_orderkey) - 1) // 3 + 1 AS pages FROM lineitem
),
named AS (SELECT *, l_orderkey || '/' || page || '/' || pages AS track FROM lines_)
SELECT track, 'point' AS kind, CAST(row_number() OVER (PARTITION BY track ORDER BY l_linenumber, l_quantity, l_suppkey) - 1 AS INTEGER) AS ordinal, CAST(l_quantity AS DOUBLE) AS x, '' AS reason
FROM named WHERE l_orderkey % 13 <> 0
UNION ALL
SELECT track, 'corner', CAST(row_number() OVER (PARTITION BY track ORDER BY l_linenumber) - 1 AS INTEGER), CAST(l_linenumber AS DOUBLE), ''
FROM named WHERE l_orderkey % 13 <> 0 AND l_returnflag = 'R'
UNION ALL SELECT DISTINCT l_orderkey || '/0/' || pages, 'rotation', -1, CAST(l_orderkey % 360 AS DOUBLE), '' FROM named WHERE l_orderkey % 13 <> 0
UNION ALL SELECT DISTINCT track, 'rejected', -1, -1.0, 'Unreadable document' FROM (
  SELECT l_orderkey || '/' || page || '/' || pages AS track FROM lines_ WHERE l_orderkey % 13 = 0
  UNION SELECT l_orderkey || '/0/' || pages FROM lines_ WHERE l_orderkey % 13 = 0)""",
    "meeting_documents": f"WITH {_MEETING_SQL} SELECT CAST(to_json(meeting) AS VARCHAR) AS document FROM meetings",
    "session_documents": f"""
WITH {_MEETING_SQL}
SELECT CAST(to_json({{'session_id': l_orderkey * 10 + l_linenumber, 'og_session_id': CAST(NULL AS INTEGER),
                      'session_type': l_returnflag, 'session_name': l_linestatus, 'meeting': meeting}}) AS VARCHAR)
       AS document
FROM lineitem LEFT JOIN meetings ON meeting_id = l_orderkey""",
    "nested_payload_rows": """
SELECT event_id, 0 AS ordinal, CAST(year(ts) AS INTEGER) AS season, CAST(month(ts) AS INTEGER) AS round,
       CAST(user_id AS INTEGER) AS driver_number,
       CAST(json_extract_string(props, '$.k') AS INTEGER) AS position
FROM events
UNION ALL
SELECT event_id, 1, CAST(year(ts) AS INTEGER), CAST(month(ts) AS INTEGER), CAST(length(event_type) AS INTEGER), CAST(json_extract_string(props, '$.k') AS INTEGER)
FROM events""",
}
