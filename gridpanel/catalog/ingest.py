"""Keyed writes, look-ups, validation and payload parsing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridpanel.functions.scalars import date_and_time, interval_text, iso_timestamp, offset_seconds, parse_offset
from gridpanel.operators import checks, quarantine
from gridpanel.operators.keyed import fastest, last_value
from gridpanel.operators.upsert import fill_if_null as fill, highest, insert_if_absent as insert
from gridpanel.plans import ingest
from gridpanel.sources.tables import read_inputs

CUT = "1998-01-01"
# every seventh user stands for a session of the older source, from this id on
OLDER = 1_000_000_000_000


def snowflake_join_chain(spark: SparkSession, folder: str) -> DataFrame:
    lineitem, orders, customer, nation = read_inputs(spark, folder, "lineitem", "orders", "customer", "nation")
    wanted = nation.filter(F.col("n_name") == "NATION_7")
    buyers = customer.join(wanted, customer["c_nationkey"] == wanted["n_nationkey"]).select(
        "c_custkey", "c_name", "n_name"
    )
    open_orders = orders.filter((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") < 250_000))
    kept = open_orders.join(buyers, open_orders["o_custkey"] == buyers["c_custkey"]).select(
        "o_orderkey", "o_orderpriority", "c_name", "n_name"
    )
    lines = lineitem.filter((F.col("l_returnflag") == "R") & (F.col("l_quantity") < 25))
    return lines.join(kept, lines["l_orderkey"] == kept["o_orderkey"]).select(
        "l_orderkey", "l_linenumber", "l_suppkey", "o_orderpriority", "c_name", "n_name"
    )


def _order_batches(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Orders before the cut (already stored) and from it on (the batch)."""
    (orders,) = read_inputs(spark, folder, "orders")
    rows = orders.select("o_custkey", "o_orderpriority", "o_orderkey", "o_orderdate", "o_orderstatus")
    early = F.col("o_orderdate") < F.lit(CUT).cast("timestamp_ntz")
    return rows.filter(early), rows.filter(~early)


def insert_if_absent(spark: SparkSession, folder: str) -> DataFrame:
    """First order of every customer that had none before the cut."""
    stored, batch = _order_batches(spark, folder)
    new = insert(batch, stored.select("o_custkey").distinct(), ["o_custkey"], ["o_orderdate", "o_orderkey"])
    return new.select("o_custkey", "o_orderkey", "o_orderpriority", "o_orderstatus")


def insert_if_absent_pair(spark: SparkSession, folder: str) -> DataFrame:
    """The same for the pair of customer and priority."""
    stored, batch = _order_batches(spark, folder)
    keys = ["o_custkey", "o_orderpriority"]
    new = insert(batch, stored.select(*keys).distinct(), keys, ["o_orderdate", "o_orderkey"])
    return new.select(*keys, "o_orderkey", "o_orderstatus")


def fill_if_null(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers in debt lack their external id; customers of the same key supply it."""
    supplier, customer = read_inputs(spark, folder, "supplier", "customer")
    stored = supplier.select(
        F.col("s_suppkey").alias("key"),
        F.col("s_name").alias("name"),
        F.when(F.col("s_acctbal") >= 0, F.concat(F.lit("S-"), "s_name")).alias("external_id"),
    )
    incoming = customer.select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.concat(F.lit("C-"), "c_name").alias("external_id")
    )
    merged = fill(stored, incoming, ["key"], ["key"])
    return merged.select("key", "name", F.coalesce("external_id", F.lit("")).alias("external_id"))


def _circuit_load(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Parts as circuits: a name is a circuit, a name and brand its country; large parts are stored already."""
    (part,) = read_inputs(spark, folder, "part")
    country = F.concat_ws("/", "p_name", "p_brand")
    circuit = F.concat_ws("/", "p_name", "p_type", F.col("p_size").cast("string"))
    large = part.filter(F.col("p_size") > 40)
    countries = large.groupBy(country.alias("country_name")).agg(F.min("p_partkey").alias("country_id"))
    circuits = (
        large.groupBy(circuit.alias("circuit_short_name"))
        .agg(F.min("p_partkey").alias("circuit_id"), F.max("p_type").alias("kind"))
        .select(
            "circuit_id",
            "circuit_short_name",
            F.lit(0).cast("bigint").alias("country_id"),
            F.when(F.col("kind") != "ECONOMY", F.concat(F.lit("old-"), F.col("circuit_id").cast("string"))).alias(
                "external_id"
            ),
        )
    )
    source = part.select(
        circuit.alias("circuit_name"),
        country.alias("country_name"),
        F.concat(F.lit("new-"), F.col("p_partkey").cast("string")).alias("external_id"),
        F.lit("parts").alias("_file"),
        F.col("p_partkey").alias("ordinal"),
    )
    return ingest.load_circuits(source, countries, circuits)


def mint_countries(spark: SparkSession, folder: str) -> DataFrame:
    return _circuit_load(spark, folder)[0].select("country_id", "country_name")


def merge_circuits(spark: SparkSession, folder: str) -> DataFrame:
    return _circuit_load(spark, folder)[1].select("circuit_id", "circuit_short_name", "country_id", "external_id")


def mint_meetings(spark: SparkSession, folder: str) -> DataFrame:
    """Orders from the cut on as a season document: keys above the highest stored one, circuits by external id."""
    orders, customer = read_inputs(spark, folder, "orders", "customer")
    circuits = customer.select(
        F.col("c_custkey").alias("circuit_id"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_name")).alias("external_id"),
    )
    early = F.col("o_orderdate") < F.lit(CUT).cast("timestamp_ntz")
    meetings = orders.filter(early).select(
        F.col("o_orderkey").alias("meeting_id"),
        F.year("o_orderdate").alias("season"),
        F.col("o_custkey").cast("int").alias("no"),
    )
    races = orders.filter(~early).select(
        F.year("o_orderdate").alias("season"),
        F.col("o_custkey").cast("int").alias("round"),
        F.col("o_orderpriority").alias("race_name"),
        F.to_date("o_orderdate").cast("string").alias("date"),
        F.lit("06:00:00Z").alias("time"),
        F.concat(F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0")).alias("external_id"),
        F.lit("orders").alias("_file"),
        F.col("o_orderkey").alias("ordinal"),
    )
    rows = ingest.load_race_meetings(races, circuits, meetings).rows
    return rows.select(
        "meeting_id", "meeting_name", "circuit_id", "season", "no", iso_timestamp(F.col("date_start")).alias("date_start")
    )


def highest_key(spark: SparkSession, folder: str) -> DataFrame:
    """Next meeting key per source table: the highest key in use plus the step."""
    orders, customer = read_inputs(spark, folder, "orders", "customer")
    parts = [
        (name, highest(df, key) + ingest.STEP)
        for df, key, name in [(orders, "o_orderkey", "orders"), (customer, "c_custkey", "customer")]
    ]
    return spark.createDataFrame(parts, "source string, next_key bigint")


def external_id_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines to suppliers with an external id; lines that miss are kept with a reason."""
    lineitem, supplier = read_inputs(spark, folder, "lineitem", "supplier")
    known = supplier.filter(F.col("s_acctbal") >= 0).select("s_suppkey", "s_name")
    found = lineitem.select("l_orderkey", "l_linenumber", "l_suppkey").join(
        known, F.col("l_suppkey") == F.col("s_suppkey"), "left"
    )
    marked = quarantine.with_reason(found, [("Unknown supplier", F.col("s_suppkey").isNull())])
    return marked.select(
        "l_orderkey",
        "l_linenumber",
        F.coalesce("s_name", F.lit("")).alias("s_name"),
        F.coalesce("reason", F.lit("")).alias("reason"),
    )


def missing_seasons(spark: SparkSession, folder: str) -> DataFrame:
    """Per customer and year: serve stored rows, load, or refuse a year out of range."""
    (orders,) = read_inputs(spark, folder, "orders")
    rows = orders.select("o_custkey", F.year("o_orderdate").alias("season"), "o_orderstatus")
    stored = rows.filter(F.col("o_orderstatus") == "F")
    plan = ingest.seasons_to_load(rows, stored, ("o_custkey",), after=1995, latest=F.lit(2000))
    return plan.withColumn("reason", F.coalesce("reason", F.lit("")))


def quarantine_split(spark: SparkSession, folder: str) -> DataFrame:
    """Events with the rule they break, and an error payload for those that do."""
    (events,) = read_inputs(spark, folder, "events")
    k = F.expr("try_cast(get_json_object(props, '$.k') AS int)")
    rows = events.select("event_id", "event_type", "value", k.alias("k"))
    marked = quarantine.with_reason(
        rows,
        [
            *quarantine.required("k"),
            ("Value too small", F.col("value") < 5),
            ("Invalid k", (F.col("k") <= 3) | (F.col("k") > 95)),
        ],
    )
    payload = F.to_json(quarantine.error_payload(F.create_map(F.lit("event_type"), F.col("event_type")), F.col("reason")))
    bad = F.col("reason").isNotNull()
    return marked.select(
        "event_id",
        F.when(bad, "quarantine").otherwise("good").alias("part"),
        F.coalesce("reason", F.lit("")).alias("reason"),
        F.when(bad, payload).otherwise("").alias("error"),
    )


def json_extract_events(spark: SparkSession, folder: str) -> DataFrame:
    (events,) = read_inputs(spark, folder, "events")
    parsed = events.select("event_id", "user_id", "event_type", F.from_json("props", "k int").alias("p"))
    return parsed.select(
        F.col("event_id").alias("position_id"),
        F.col("user_id").alias("driver_number"),
        F.coalesce("p.k", F.lit(-1)).alias("position"),
        F.col("event_type").alias("session_type"),
        F.lit("Qualifying").alias("session_name"),
    )


def last_value_per_key(spark: SparkSession, folder: str) -> DataFrame:
    (events,) = read_inputs(spark, folder, "events")
    return last_value(events, ["user_id", "event_type"], "value", ["ts", "event_id"])


def final_positions(spark: SparkSession, folder: str) -> DataFrame:
    """Events as position lists (user = session, k = driver), bad ones kept aside, purchases stored before."""
    (events,) = read_inputs(spark, folder, "events")
    k = F.expr("try_cast(get_json_object(props, '$.k') AS int)")
    lists = events.select(
        F.when(F.col("user_id") % 7 == 0, F.col("user_id") + OLDER).otherwise(F.col("user_id")).alias("session_key"),
        k.alias("driver_number"),
        F.length("event_type").alias("position"),
        F.lit("events").alias("_file"),
        F.col("event_id").alias("ordinal"),
        "event_type",
    )
    stored = (
        lists.filter(F.col("event_type") == "purchase")
        .groupBy(F.col("session_key").alias("session_id"), "driver_number")
        .agg(F.min("ordinal").alias("position_id"), F.min("position").alias("position"))
        .select("position_id", "driver_number", "position", "session_id")
    )
    sessions = lists.select(F.col("session_key").alias("session_id")).filter("session_id % 11 <> 0").distinct()
    loaded = ingest.load_final_positions(lists, sessions, stored, below=OLDER)
    columns = ["session_id", F.coalesce("driver_number", F.lit(-1)).alias("driver_number"), "position"]
    good = loaded.rows.select("position_id", *columns, F.lit("").alias("reason"))
    return good.unionByName(loaded.rejected.select(F.lit(-1).cast("bigint").alias("position_id"), *columns, "reason"))


def conditional_row_expansion(spark: SparkSession, folder: str) -> DataFrame:
    (orders,) = read_inputs(spark, folder, "orders")
    races = orders.select(
        F.col("o_orderkey").alias("meeting_id"),
        F.month("o_orderdate").alias("round"),
        F.when(F.col("o_orderpriority") <= "2-HIGH", "given").alias("first_practice"),
        F.when(F.col("o_orderstatus") == "F", "given").alias("second_practice"),
        F.when(F.col("o_totalprice") > 250_000, "given").alias("third_practice"),
        F.when(F.col("o_orderpriority") == "5-LOW", "given").alias("sprint"),
    )
    return ingest.session_rows(races, carry=[])


def text_to_timestamp(spark: SparkSession, folder: str) -> DataFrame:
    (events,) = read_inputs(spark, folder, "events")
    clock = F.col("ts").cast("string")
    date = F.substring(clock, 1, 10)
    time = F.concat(F.substring(clock, 12, 8), F.lit("Z"))
    parsed = date_and_time(date, time)
    return events.select("event_id", iso_timestamp(parsed).alias("started"), F.hour(parsed).alias("hour"))


def interval_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Offsets between -12:15 and 12:15, as text, as interval and back."""
    (events,) = read_inputs(spark, folder, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    rows = events.select("event_id", ((k - 50) * 15).alias("minutes"))
    minutes = F.col("minutes")
    text = F.concat(
        F.when(minutes < 0, "-").otherwise(""),
        F.format_string("%02d:%02d:00", F.expr("abs(minutes) DIV 60"), F.abs("minutes") % 60),
    )
    return rows.select("event_id", text.alias("text")).select(
        "event_id",
        "text",
        offset_seconds(F.col("text")).alias("seconds"),
        interval_text(parse_offset(F.col("text"))).alias("gmt_offset"),
    )


def round_half_even(spark: SparkSession, folder: str) -> DataFrame:
    (orders,) = read_inputs(spark, folder, "orders")
    half = F.col("o_custkey") / 2
    return orders.select(
        "o_orderkey",
        F.bround(half, 0).cast("bigint").alias("half_even"),
        F.round(half, 0).cast("bigint").alias("half_up"),
    )


def fastest_per_group(spark: SparkSession, folder: str) -> DataFrame:
    (events,) = read_inputs(spark, folder, "events")
    rows = events.select("user_id", "event_type", "value", "event_id")
    return fastest(rows, ["user_id", "event_type"], "value", ["event_id"])


def constraint_checks(spark: SparkSession, folder: str) -> DataFrame:
    lineitem, orders, customer, supplier = read_inputs(spark, folder, "lineitem", "orders", "customer", "supplier")
    in_credit = supplier.filter(F.col("s_acctbal") >= 0)
    return checks.report(
        [
            checks.duplicate_keys(orders, ["o_orderkey"], "orders key"),
            checks.duplicate_keys(lineitem, ["l_orderkey", "l_linenumber"], "lineitem key"),
            checks.orphans(lineitem, "l_orderkey", orders, "o_orderkey", "lineitem order"),
            checks.orphans(lineitem, "l_suppkey", in_credit, "s_suppkey", "lineitem supplier in credit"),
            checks.orphans(orders, "o_custkey", customer, "c_custkey", "orders customer"),
            checks.nulls(lineitem, "l_suppkey", "lineitem supplier missing"),
            checks.longer_than(orders, "o_orderpriority", 8, "orders priority length"),
        ]
    )


QUERIES = {
    "snowflake_join_chain": snowflake_join_chain,
    "insert_if_absent": insert_if_absent,
    "insert_if_absent_pair": insert_if_absent_pair,
    "fill_if_null": fill_if_null,
    "mint_countries": mint_countries,
    "merge_circuits": merge_circuits,
    "mint_meetings": mint_meetings,
    "highest_key": highest_key,
    "external_id_lookup": external_id_lookup,
    "missing_seasons": missing_seasons,
    "quarantine_split": quarantine_split,
    "json_extract_events": json_extract_events,
    "last_value_per_key": last_value_per_key,
    "final_positions": final_positions,
    "conditional_row_expansion": conditional_row_expansion,
    "text_to_timestamp": text_to_timestamp,
    "interval_text": interval_texts,
    "round_half_even": round_half_even,
    "fastest_per_group": fastest_per_group,
    "constraint_checks": constraint_checks,
}

# -- checks --------------------------------------------------------------------

_CIRCUITS_SQL = """
source AS (
  SELECT p_partkey, p_name || '/' || p_brand AS country_name, p_name || '/' || p_type || '/' || p_size AS circuit_name,
         p_type, p_size
  FROM part
),
stored_countries AS (
  SELECT country_name, min(p_partkey) AS country_id FROM source WHERE p_size > 40 GROUP BY country_name
),
stored_circuits AS (
  SELECT circuit_name, min(p_partkey) AS circuit_id, max(p_type) AS kind
  FROM source WHERE p_size > 40 GROUP BY circuit_name
),
new_countries AS (
  SELECT greatest(50000, (SELECT max(country_id) + 10 FROM stored_countries)) + 10 * (row_number() OVER (ORDER BY min(p_partkey)) - 1) AS country_id, country_name
  FROM source WHERE country_name NOT IN (SELECT country_name FROM stored_countries) GROUP BY country_name
),
all_countries AS (
  SELECT country_id, country_name FROM stored_countries UNION ALL SELECT country_id, country_name FROM new_countries
),
keyed AS (SELECT *, greatest(100000, (SELECT max(circuit_id) + 10 FROM stored_circuits)) + 10 * (row_number() OVER (ORDER BY p_partkey) - 1) AS circuit_id FROM source),
first_rows AS (SELECT * FROM keyed QUALIFY row_number() OVER (PARTITION BY circuit_name ORDER BY p_partkey) = 1)
"""

_FIRST_ORDER = """
SELECT {columns} FROM orders o
WHERE o_orderdate >= TIMESTAMP '1998-01-01'
  AND NOT EXISTS (SELECT 1 FROM orders e WHERE e.o_orderdate < TIMESTAMP '1998-01-01' AND {match})
QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY o_orderdate, o_orderkey) = 1"""

SQL = {
    "snowflake_join_chain": """
SELECT l_orderkey, l_linenumber, l_suppkey, o_orderpriority, c_name, n_name
FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
JOIN nation ON n_nationkey = c_nationkey
WHERE n_name = 'NATION_7' AND o_orderstatus = 'F' AND o_totalprice < 250000
  AND l_returnflag = 'R' AND l_quantity < 25""",
    "insert_if_absent": _FIRST_ORDER.format(
        columns="o_custkey, o_orderkey, o_orderpriority, o_orderstatus",
        match="e.o_custkey = o.o_custkey",
        keys="o_custkey",
    ),
    "insert_if_absent_pair": _FIRST_ORDER.format(
        columns="o_custkey, o_orderpriority, o_orderkey, o_orderstatus",
        match="e.o_custkey = o.o_custkey AND e.o_orderpriority = o.o_orderpriority",
        keys="o_custkey, o_orderpriority",
    ),
    "fill_if_null": """
SELECT coalesce(s_suppkey, c_custkey) AS key, coalesce(s_name, c_name) AS name,
       coalesce(CASE WHEN s_acctbal >= 0 THEN 'S-' || s_name END, 'C-' || c_name, '') AS external_id
FROM supplier FULL JOIN customer ON c_custkey = s_suppkey""",
    "mint_countries": f"WITH {_CIRCUITS_SQL} SELECT country_id, country_name FROM new_countries",
    "merge_circuits": f"""
WITH {_CIRCUITS_SQL}
SELECT s.circuit_id, s.circuit_name AS circuit_short_name, 0 AS country_id,
       CASE WHEN kind <> 'ECONOMY' THEN 'old-' || s.circuit_id ELSE 'new-' || f.p_partkey END AS external_id
FROM stored_circuits s JOIN first_rows f ON f.circuit_name = s.circuit_name
UNION ALL
SELECT f.circuit_id, f.circuit_name, c.country_id, 'new-' || f.p_partkey
FROM first_rows f JOIN all_countries c ON c.country_name = f.country_name
WHERE f.circuit_name NOT IN (SELECT circuit_name FROM stored_circuits)""",
    "mint_meetings": """
WITH races AS (
  SELECT *, CAST(year(o_orderdate) AS INTEGER) AS season,
         (SELECT max(o_orderkey) FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01')
           + 10 * row_number() OVER (ORDER BY o_orderkey) AS meeting_id
  FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'
)
SELECT meeting_id, o_orderpriority AS meeting_name, c_custkey AS circuit_id, season, CAST(o_custkey AS INTEGER) AS no,
       strftime(o_orderdate, '%Y-%m-%d') || 'T06:00:00' AS date_start
FROM races JOIN customer ON c_custkey = o_custkey AND c_acctbal >= 0
QUALIFY row_number() OVER (PARTITION BY season, o_custkey ORDER BY o_orderkey) = 1""",
    "highest_key": """
SELECT 'orders' AS source, max(o_orderkey) + 10 AS next_key FROM orders
UNION ALL SELECT 'customer', max(c_custkey) + 10 FROM customer""",
    "external_id_lookup": """
SELECT l_orderkey, l_linenumber, coalesce(s_name, '') AS s_name,
       CASE WHEN s_suppkey IS NULL THEN 'Unknown supplier' ELSE '' END AS reason
FROM lineitem LEFT JOIN supplier ON s_suppkey = l_suppkey AND s_acctbal >= 0""",
    "missing_seasons": """
WITH asked AS (
  SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS season, bool_or(o_orderstatus = 'F') AS stored FROM orders GROUP BY ALL
)
SELECT o_custkey, season,
       CASE WHEN season <= 1995 OR season > 2000 THEN 'invalid' WHEN stored THEN 'serve' ELSE 'load' END AS action,
       CASE WHEN season <= 1995 OR season > 2000 THEN 'Invalid year' ELSE '' END AS reason
FROM asked""",
    "quarantine_split": """
WITH rows_ AS (SELECT *, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
marked AS (
  SELECT *, CASE WHEN k IS NULL THEN 'k is missing' WHEN value < 5 THEN 'Value too small'
                 WHEN k <= 3 OR k > 95 THEN 'Invalid k' ELSE '' END AS reason
  FROM rows_
)
SELECT event_id, CASE WHEN reason = '' THEN 'good' ELSE 'quarantine' END AS part, reason,
       CASE WHEN reason = '' THEN ''
            ELSE CAST(to_json({'event_type': event_type, 'message': reason}) AS VARCHAR) END AS error
FROM marked""",
    "json_extract_events": """
SELECT event_id AS position_id, user_id AS driver_number,
       coalesce(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER), -1) AS position,
       event_type AS session_type, 'Qualifying' AS session_name
FROM events""",
    "last_value_per_key": """
SELECT user_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""",
    "final_positions": """
WITH lists AS (
  SELECT event_id, CASE WHEN user_id % 7 = 0 THEN user_id + 1000000000000 ELSE user_id END AS session_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS driver_number,
         CAST(length(event_type) AS INTEGER) AS position, event_type
  FROM events
),
stored AS (
  SELECT session_id, driver_number, min(event_id) AS position_id FROM lists WHERE event_type = 'purchase' GROUP BY ALL
),
judged AS (
  SELECT *, CASE WHEN driver_number IS NULL THEN 'driver_number is missing'
                 WHEN session_id >= 1000000000000 THEN 'Session of the older source' ELSE '' END AS reason
  FROM lists
),
final AS (
  SELECT session_id, driver_number, position FROM judged
  WHERE reason = ''
  QUALIFY row_number() OVER (PARTITION BY session_id, driver_number ORDER BY event_id DESC) = 1
)
SELECT (SELECT max(position_id) FROM stored) + row_number() OVER (ORDER BY session_id, driver_number) AS position_id,
       session_id, driver_number, position, '' AS reason
FROM final ANTI JOIN stored USING (session_id, driver_number) WHERE session_id % 11 <> 0
UNION ALL
SELECT -1, session_id, driver_number, position, 'Unknown session' FROM final WHERE session_id % 11 = 0
UNION ALL
SELECT -1, session_id, coalesce(driver_number, -1), position, reason FROM judged WHERE reason <> ''""",
    "conditional_row_expansion": """
WITH entries AS (
  SELECT *, unnest([
    {'given': true, 'suffix': '4', 'kind': 'Qualifying', 'name': 'Qualifying'},
    {'given': true, 'suffix': '', 'kind': 'Race', 'name': 'Race'},
    {'given': o_orderpriority <= '2-HIGH', 'suffix': '1', 'kind': 'Practice', 'name': 'Practice 1'},
    {'given': o_orderstatus = 'F', 'suffix': '2', 'kind': 'Practice', 'name': 'Practice 2'},
    {'given': o_totalprice > 250000, 'suffix': '3', 'kind': 'Practice', 'name': 'Practice 3'},
    {'given': o_orderpriority = '5-LOW', 'suffix': '5', 'kind': 'Race', 'name': 'Sprint'}]) AS e
  FROM orders
)
SELECT o_orderkey AS meeting_id, CAST(o_orderkey || '' || month(o_orderdate) || e.suffix AS BIGINT) AS session_id,
       e.kind AS session_type, e.name AS session_name
FROM entries WHERE e.given""",
    "text_to_timestamp": """
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS started, CAST(hour(ts) AS INTEGER) AS hour FROM events""",
    "interval_text": """
WITH m AS (SELECT event_id, (CAST(json_extract_string(props, '$.k') AS INTEGER) - 50) * 15 AS minutes FROM events)
SELECT event_id,
       (CASE WHEN minutes < 0 THEN '-' ELSE '' END) || printf('%02d:%02d:00', abs(minutes) // 60, abs(minutes) % 60) AS text,
       CAST(minutes * 60 AS BIGINT) AS seconds,
       (CASE WHEN minutes < 0 THEN '-' ELSE '' END) || printf('%d:%02d:00', abs(minutes) // 60, abs(minutes) % 60)
         AS gmt_offset
FROM m""",
    "round_half_even": """
SELECT o_orderkey, CAST(round_even(o_custkey / 2, 0) AS BIGINT) AS half_even,
       CAST(round(o_custkey / 2, 0) AS BIGINT) AS half_up
FROM orders""",
    "fastest_per_group": """
SELECT user_id, event_type, value, event_id FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY value, event_id) = 1""",
    "constraint_checks": """
SELECT 'orders key' AS "check", count(*) - count(DISTINCT o_orderkey) AS offending FROM orders
UNION ALL SELECT 'lineitem key', count(*) - count(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem
UNION ALL SELECT 'lineitem order', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
UNION ALL SELECT 'lineitem supplier in credit', count(*) FROM lineitem
  WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0)
UNION ALL SELECT 'orders customer', count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)
UNION ALL SELECT 'lineitem supplier missing', count(*) FROM lineitem WHERE l_suppkey IS NULL
UNION ALL SELECT 'orders priority length', count(*) FROM orders WHERE length(o_orderpriority) > 8""",
}
