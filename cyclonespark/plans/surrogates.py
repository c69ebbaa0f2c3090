"""Deterministic surrogate inputs derived from the driver tables.

The driver tables hold no storms, so every registered query first derives a
storm-shaped input from them with integer arithmetic only.  Each surrogate
exists twice: as a Spark DataFrame (input of the operators under test) and as
DuckDB SQL text (input of the independent SQL oracle).  The operators
themselves are never expressed in the SQL side's terms.

* ``deck``      from ``events``   : one ATCF record per event (storm = user).
* ``catalog``   from ``orders``   : storm catalog rows.
* ``flood``     from ``nation`` + ``orders`` : flood events naming storms.
* ``hwm``       from ``lineitem`` : high-water marks.
* ``stations`` from ``supplier``, ``product`` from ``orders``: tide stations and series.
* ``files`` / ``sensors`` from ``part``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cyclonespark.sources.decks import parse_deck_lines


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _i(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _pad(col: Column, width: int) -> Column:
    return F.lpad(col.cast("string"), width, " ")


# ---------------------------------------------------------------------------------------
# deck
# ---------------------------------------------------------------------------------------

def deck_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ATCF text lines (one per event) with ``storm_id`` and ``line_no``."""
    # lines cost far more than the rows that they are made of, and a small file is a single task: dealt out before
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts").repartition(tasks, "event_id")
    eid, uid = F.col("event_id"), F.col("user_id")
    adv = (F.when(F.col("event_type") == "click", "OFCL").when(F.col("event_type") == "purchase", "CARQ")
           .when(F.col("event_type") == "error", "HWRF").when(F.col("event_type") == "signup", "BEST")
           .otherwise("HMON"))
    best = adv == "BEST"
    hour = F.hour("ts")
    ymdh = F.concat(
        F.year("ts").cast("string"), F.lpad(F.month("ts").cast("string"), 2, "0"),
        F.lpad(F.dayofmonth("ts").cast("string"), 2, "0"),
        F.lpad(F.when(best, hour).otherwise(F.floor(hour / 6) * 6).cast("string"), 2, "0"),
    )
    minutes = F.when(best & (eid % 4 == 0), F.lpad(F.minute("ts").cast("string"), 2, "0")).when(best, F.lit("")).otherwise(F.lit("03"))
    tau = F.when(best, F.lit(0)).when(adv == "CARQ", -6 * (eid % 4)).otherwise(12 * (eid % 9))
    lat = F.concat((100 + (eid * 17) % 350).cast("string"), F.when(uid % 10 == 9, "S").otherwise("N"))
    lon = F.concat((300 + (eid * 37) % 600).cast("string"), F.when(uid % 10 == 8, "E").otherwise("W"))
    mslp = F.when(eid % 5 == 0, 0).otherwise(1005 - eid % 90)
    rad = F.when(eid % 3 == 0, 34).when(eid % 3 == 1, 50).otherwise(64)
    radp = F.when(eid % 7 == 0, 0).otherwise(1006 + eid % 8)
    mrd = F.when(eid % 4 == 1, 0).otherwise(10 + eid % 40)
    speed = F.when(eid % 13 == 0, F.lit("")).otherwise((eid % 25).cast("string"))
    name = F.when(eid % 7 == 0, F.lit("INVEST")).when(eid % 7 == 1, F.lit("")).otherwise(F.concat(F.lit("NAME"), (uid % 97).cast("string")))
    basin = F.when(uid % 3 == 0, "AL").when(uid % 3 == 1, "EP").otherwise("CP")
    number = F.lpad((uid % 100).cast("string"), 2, "0")
    fields = [
        _pad(basin, 2), _pad(number, 3), _pad(ymdh, 11), _pad(minutes, 3), _pad(adv, 5), _pad(tau, 4),
        _pad(lat, 5), _pad(lon, 6), _pad(20 + eid % 130, 4), _pad(mslp, 5), _pad(F.lit("TS"), 3),
        _pad(rad, 4), _pad(F.lit("NEQ"), 4), _pad((eid * 7) % 120, 5), _pad((eid * 11) % 100, 5),
        _pad((eid * 13) % 90, 5), _pad((eid * 3) % 80, 5), _pad(radp, 5), _pad(150 + eid % 50, 5),
        _pad(mrd, 4), _pad(30 + eid % 140, 4), _pad(eid % 30, 4), _pad(F.lit("L"), 4), _pad(eid % 20, 4),
        _pad(F.lit(""), 4), _pad((eid * 29) % 360, 4), _pad(speed, 4), _pad(name, 11),
    ]
    return e.select(uid.alias("storm_id"), eid.alias("line_no"), F.concat_ws(",", *fields).alias("line"))


def deck(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed surrogate deck records (``storm_id``, ``line_no`` + typed ATCF fields)."""
    return parse_deck_lines(deck_lines(spark, sf_dir), keep=("storm_id", "line_no"))


DECK_SQL = """
deck_e AS (
  SELECT event_id, user_id, ts,
    CASE event_type WHEN 'click' THEN 'OFCL' WHEN 'purchase' THEN 'CARQ' WHEN 'error' THEN 'HWRF'
                    WHEN 'signup' THEN 'BEST' ELSE 'HMON' END AS adv
  FROM events
),
deck AS (
  SELECT user_id AS storm_id, event_id AS line_no,
    CASE user_id % 3 WHEN 0 THEN 'AL' WHEN 1 THEN 'EP' ELSE 'CP' END AS basin,
    lpad(CAST(user_id % 100 AS VARCHAR), 2, '0') AS storm_number,
    CASE WHEN adv = 'BEST' AND event_id % 4 = 0 THEN lpad(CAST(minute(ts) AS VARCHAR), 2, '0')
         WHEN adv = 'BEST' THEN '' ELSE '03' END AS advisory_number,
    adv AS advisory,
    CAST(20 + event_id % 130 AS DOUBLE) AS max_sustained_wind_speed,
    CAST(CASE WHEN event_id % 5 = 0 THEN 0 ELSE 1005 - event_id % 90 END AS DOUBLE) AS central_pressure,
    'TS' AS development_level,
    CAST(CASE event_id % 3 WHEN 0 THEN 34 WHEN 1 THEN 50 ELSE 64 END AS DOUBLE) AS isotach_radius,
    'NEQ' AS isotach_quadrant_code,
    CAST((event_id * 7) % 120 AS DOUBLE) AS isotach_radius_for_NEQ,
    CAST((event_id * 11) % 100 AS DOUBLE) AS isotach_radius_for_SEQ,
    CAST((event_id * 13) % 90 AS DOUBLE) AS isotach_radius_for_SWQ,
    CAST((event_id * 3) % 80 AS DOUBLE) AS isotach_radius_for_NWQ,
    CAST(CASE WHEN event_id % 7 = 0 THEN 0 ELSE 1006 + event_id % 8 END AS DOUBLE) AS background_pressure,
    CAST(150 + event_id % 50 AS DOUBLE) AS radius_of_last_closed_isobar,
    CAST(CASE WHEN event_id % 4 = 1 THEN 0 ELSE 10 + event_id % 40 END AS DOUBLE) AS radius_of_maximum_winds,
    CAST(30 + event_id % 140 AS DOUBLE) AS gust_speed,
    CAST(event_id % 30 AS DOUBLE) AS eye_diameter,
    'L' AS subregion_code,
    CAST(event_id % 20 AS DOUBLE) AS maximum_wave_height,
    '' AS forecaster_initials,
    CAST((event_id * 29) % 360 AS DOUBLE) AS direction,
    CASE WHEN event_id % 13 = 0 THEN CAST(NULL AS DOUBLE) ELSE CAST(event_id % 25 AS DOUBLE) END AS speed,
    CASE WHEN event_id % 7 = 0 THEN 'INVEST' WHEN event_id % 7 = 1 THEN ''
         ELSE 'NAME' || CAST(user_id % 97 AS VARCHAR) END AS name,
    CAST(NULL AS VARCHAR) AS extra_values,
    CASE WHEN adv = 'BEST' AND event_id % 4 = 0 THEN date_trunc('minute', ts)
         WHEN adv = 'BEST' THEN date_trunc('hour', ts)
         ELSE date_trunc('day', ts) + to_hours(CAST(6 * floor(hour(ts) / 6) AS BIGINT)) END AS record_time,
    CAST(CASE WHEN adv = 'BEST' THEN 0 WHEN adv = 'CARQ' THEN -6 * (event_id % 4)
              ELSE 12 * (event_id % 9) END AS INTEGER) AS forecast_hours,
    (CASE WHEN user_id % 10 = 9 THEN -1 ELSE 1 END) * CAST(100 + (event_id * 17) % 350 AS DOUBLE) / 10.0 AS latitude,
    (CASE WHEN user_id % 10 = 8 THEN 1 ELSE -1 END) * CAST(300 + (event_id * 37) % 600 AS DOUBLE) / 10.0 AS longitude
  FROM deck_e
),
track AS (
  SELECT *,
    CASE WHEN advisory = 'BEST' THEN min(record_time) OVER (PARTITION BY storm_id, advisory)
         ELSE record_time END AS track_start_time,
    CASE WHEN advisory = 'BEST' THEN record_time ELSE record_time + to_hours(CAST(forecast_hours AS BIGINT)) END AS datetime
  FROM deck
)"""


# ---------------------------------------------------------------------------------------
# storm catalog (S3/S4) from orders
# ---------------------------------------------------------------------------------------

def catalog_csv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalog rows as the 21-column CSV text of the storm list (first line is a header-like row)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    k = F.col("o_orderkey")
    basin = F.when(k % 4 == 0, "AL").when(k % 4 == 1, "EP").when(k % 4 == 2, "CP").otherwise("WP")
    number = (k % 40 + 1)
    year = F.year("o_orderdate")
    code = F.concat(basin, F.lpad(number.cast("string"), 2, "0"), year.cast("string"))
    name = F.when(k % 11 == 0, F.lit("")).otherwise(F.concat(F.lit("NAME"), (F.col("o_custkey") % 97).cast("string")))
    klass = F.when(k % 3 == 0, "HU").when(k % 3 == 1, "TS").otherwise("TD")
    start = F.date_format("o_orderdate", "yyyyMMddHH")
    end = F.when(k % 5 == 0, F.lit("")).otherwise(F.date_format(F.col("o_orderdate") + F.expr("INTERVAL 3 DAYS"), "yyyyMMddHH"))
    source = F.when(k % 2 == 0, "ARCHIVE").otherwise("METWATCH")
    cols = [F.concat(F.lit(" "), name), F.concat(F.lit(" "), basin)] + [F.lit("x")] * 5 + [
        number.cast("string"), year.cast("string"), F.concat(F.lit(" "), klass), F.lit("x"), start, end,
    ] + [F.lit("x")] * 5 + [F.concat(F.lit(" "), source), F.lit("x"), F.concat(F.lit(" "), code, F.lit(" "))]
    return o.select(k.alias("line_no"), F.concat_ws(",", *cols).alias("value"))


CATALOG_SQL = """
cat_o AS (
  SELECT o_orderkey AS k, o_custkey, o_orderdate,
    CASE o_orderkey % 4 WHEN 0 THEN 'AL' WHEN 1 THEN 'EP' WHEN 2 THEN 'CP' ELSE 'WP' END AS basin,
    CAST(o_orderkey % 40 + 1 AS INTEGER) AS number,
    CAST(year(o_orderdate) AS INTEGER) AS year
  FROM orders
),
catalog AS (
  SELECT basin || lpad(CAST(number AS VARCHAR), 2, '0') || CAST(year AS VARCHAR) AS nhc_code,
    CASE WHEN k % 11 = 0 THEN NULL ELSE 'NAME' || CAST(o_custkey % 97 AS VARCHAR) END AS name,
    CASE k % 3 WHEN 0 THEN 'HU' WHEN 1 THEN 'TS' ELSE 'TD' END AS class,
    year, ' ' || basin AS basin, number,
    CASE WHEN k % 2 = 0 THEN 'ARCHIVE' ELSE 'METWATCH' END AS source,
    date_trunc('hour', o_orderdate) AS start_date,
    CASE WHEN k % 5 = 0 THEN CAST(NULL AS TIMESTAMP) ELSE date_trunc('hour', o_orderdate) + INTERVAL 3 DAY END AS end_date,
    k AS line_no
  FROM cat_o
)"""


# ---------------------------------------------------------------------------------------
# flood events (S6) from nation x orders; HWM (S7) from lineitem; stations/products
# ---------------------------------------------------------------------------------------

def flood_event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw flood-event records shaped like the survey service's JSON (before rename/decode)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_totalprice")
    k = F.col("o_orderkey")
    storm = F.concat(F.lit("Name"), (F.col("o_custkey") % 97).cast("string"))
    event_name = (F.when(k % 3 == 0, F.concat(F.year("o_orderdate").cast("string"), F.lit(" Hurricane "), storm))
                  .when(k % 3 == 1, F.concat(storm, F.lit(" flood ")))
                  .otherwise(F.concat(F.lit("Riverine "), (k % 13).cast("string"))))
    return o.select(
        k.alias("event_id"), event_name.alias("event_name"),
        F.concat(F.lit("event "), k.cast("string")).alias("event_description"),
        (F.when(k % 3 == 2, 1).when(k % 7 == 0, 7).otherwise(2)).cast("long").alias("event_type_id"),
        (F.when(k % 4 == 0, 1).otherwise(2)).cast("long").alias("event_status_id"),
        (F.col("o_custkey") % 20).cast("long").alias("event_coordinator"),
        F.lit("[]").alias("instruments"),
        F.date_format(F.col("o_orderdate") + F.expr("INTERVAL 30 DAYS"), "yyyy-MM-dd'T'HH:mm:ss").alias("last_updated"),
        F.when(k % 2 == 0, F.col("o_totalprice") % 1000).cast("double").alias("last_updated_by"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("event_start_date"),
        F.when(k % 6 == 0, F.lit(None)).otherwise(F.date_format(F.col("o_orderdate") + F.expr("INTERVAL 5 DAYS"), "yyyy-MM-dd'T'HH:mm:ss")).alias("event_end_date"),
    )


FLOOD_SQL = """
flood_o AS (
  SELECT o_orderkey AS k, o_custkey, o_orderdate, o_totalprice, 'Name' || CAST(o_custkey % 97 AS VARCHAR) AS storm
  FROM orders
),
flood AS (
  SELECT CAST(k AS BIGINT) AS usgs_id,
    CASE WHEN k % 3 = 0 THEN CAST(year(o_orderdate) AS VARCHAR) || ' Hurricane ' || storm
         WHEN k % 3 = 1 THEN storm || ' flood ' ELSE 'Riverine ' || CAST(k % 13 AS VARCHAR) END AS name,
    CAST(year(o_orderdate) AS INTEGER) AS year,
    'event ' || CAST(k AS VARCHAR) AS description,
    CASE WHEN k % 3 = 2 THEN 'RIVERINE_FLOOD' WHEN k % 7 = 0 THEN 'TYPHOON' ELSE 'HURRICANE' END AS event_type,
    CASE WHEN k % 4 = 0 THEN 'ACTIVE' ELSE 'COMPLETED' END AS event_status,
    CAST(o_custkey % 20 AS BIGINT) AS coordinator,
    '[]' AS instruments,
    o_orderdate + INTERVAL 30 DAY AS last_updated,
    CASE WHEN k % 2 = 0 THEN CAST(o_totalprice % 1000 AS DOUBLE) END AS last_updated_by,
    o_orderdate AS start_date,
    CASE WHEN k % 6 = 0 THEN CAST(NULL AS TIMESTAMP) ELSE o_orderdate + INTERVAL 5 DAY END AS end_date
  FROM flood_o
)"""


def hwm_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """High-water marks: event = orders key bucket, quality / type / state from line attributes."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus", "l_shipdate")
    hid = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    return li.select(
        hid.cast("long").alias("hwm_id"),
        (F.col("l_suppkey") % 40).cast("long").alias("site_id"),
        F.col("l_orderkey").cast("long").alias("event_id"),
        (F.col("l_partkey") % 8 + 1).cast("long").alias("hwm_type_id"),
        (F.col("l_linenumber") % 6 + 1).cast("long").alias("hwm_quality_id"),
        F.when(F.col("l_partkey") % 2 == 0, "Coastal").otherwise("Riverine").alias("hwm_environment"),
        F.concat(F.lit("STATE_"), F.col("l_returnflag")).alias("stateName"),
        F.concat(F.lit("COUNTY_"), F.col("l_linestatus"), (F.col("l_suppkey") % 3).cast("string")).alias("countyName"),
        F.when(F.col("l_orderkey") % 3 == 0, 1).otherwise(0).cast("long").alias("stillwater"),
        F.when(F.col("l_partkey") % 5 == 0, F.lit(None)).otherwise(F.col("l_shipdate")).alias("survey_date"),
        F.col("l_shipdate").alias("flag_date"),
        F.col("l_quantity").alias("elev_ft"),
        (F.col("l_quantity") / 10.0).alias("height_above_gnd"),
        (25.0 + (F.col("l_partkey") % 1000) / 100.0).alias("latitude"),
        (-90.0 + (F.col("l_suppkey") % 1000) / 50.0).alias("longitude"),
        F.when(F.col("l_linenumber") == 1, F.lit("")).otherwise(F.concat(F.lit("M"), F.col("l_linenumber").cast("string"))).alias("markerName"),
    )


HWM_SQL = """
hwm AS (
  SELECT CAST(l_orderkey * 8 + l_linenumber AS BIGINT) AS hwm_id,
    CAST(l_suppkey % 40 AS BIGINT) AS site_id,
    CAST(l_orderkey AS BIGINT) AS event_id,
    CAST(l_partkey % 8 + 1 AS BIGINT) AS hwm_type_id,
    CAST(l_linenumber % 6 + 1 AS BIGINT) AS hwm_quality_id,
    CASE WHEN l_partkey % 2 = 0 THEN 'Coastal' ELSE 'Riverine' END AS hwm_environment,
    'STATE_' || l_returnflag AS stateName,
    'COUNTY_' || l_linestatus || CAST(l_suppkey % 3 AS VARCHAR) AS countyName,
    CAST(CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE 0 END AS BIGINT) AS stillwater,
    CASE WHEN l_partkey % 5 = 0 THEN CAST(NULL AS TIMESTAMP) ELSE l_shipdate END AS survey_date,
    l_shipdate AS flag_date,
    l_quantity AS elev_ft,
    l_quantity / 10.0 AS height_above_gnd,
    25.0 + (l_partkey % 1000) / 100.0 AS latitude,
    -90.0 + (l_suppkey % 1000) / 50.0 AS longitude,
    CASE WHEN l_linenumber = 1 THEN NULL ELSE 'M' || CAST(l_linenumber AS VARCHAR) END AS markerName
  FROM lineitem
)"""


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
    k = F.col("s_suppkey")
    return s.select(
        (F.lit(8000000) + k).cast("long").alias("nos_id"),
        F.concat(F.lit("ST"), k.cast("string")).alias("nws_id"),
        (-100.0 + (k * 37) % 400 / 10.0).alias("x"),
        (10.0 + (k * 17) % 350 / 10.0).alias("y"),
        F.when(k % 4 == 0, "historical").otherwise("active").alias("status"),
    )


STATIONS_SQL = """
stations AS (
  SELECT CAST(8000000 + s_suppkey AS BIGINT) AS nos_id, 'ST' || CAST(s_suppkey AS VARCHAR) AS nws_id,
    -100.0 + ((s_suppkey * 37) % 400) / 10.0 AS x, 10.0 + ((s_suppkey * 17) % 350) / 10.0 AS y,
    CASE WHEN s_suppkey % 4 = 0 THEN 'historical' ELSE 'active' END AS status
  FROM supplier
)"""


def station_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Water-level series: one value per order, station from the order's customer."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    k = F.col("o_orderkey")
    return o.select(
        F.lit("water_level").alias("product"),
        (F.lit(8000000) + F.col("o_custkey") % 100).cast("long").alias("nos_id"),
        (F.col("o_orderdate") + F.make_dt_interval(F.lit(0), (k % 24).cast("int"), (k % 10 * 6).cast("int"), F.lit(0))).alias("t"),
        (F.col("o_totalprice") / 100000.0).alias("v"),
        ((k % 100) / 1000.0).alias("s"),
        F.lit("0,0,0,0").alias("f"),
        F.when(k % 10 == 0, "p").otherwise("v").alias("q"),
        F.lit("MSL").alias("datum"),
    )


PRODUCT_SQL = """
product AS (
  SELECT 'water_level' AS product,
    CAST(8000000 + o_custkey % 100 AS BIGINT) AS nos_id,
    o_orderdate + to_hours(CAST(o_orderkey % 24 AS BIGINT)) + to_minutes(CAST(o_orderkey % 10 * 6 AS BIGINT)) AS t,
    o_totalprice / 100000.0 AS v, (o_orderkey % 100) / 1000.0 AS s, '0,0,0,0' AS f,
    CASE WHEN o_orderkey % 10 = 0 THEN 'p' ELSE 'v' END AS q, 'MSL' AS datum
  FROM orders
)"""


def storm_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Water levels in the month of the surrogate storms: one reading per order, in steps of six minutes."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    k = F.col("o_orderkey")
    minutes = (k * 42 % 43200).cast("int")
    return o.select(
        F.when(k % 9 == 0, "hourly_height").otherwise("water_level").alias("product"),
        (F.lit(8000000) + F.col("o_custkey") % 100).cast("long").alias("nos_id"),
        F.timestamp_add("MINUTE", minutes, F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")).alias("t"),
        (F.col("o_totalprice") / 100000.0).alias("v"), ((k % 100) / 1000.0).alias("s"), F.lit("0,0,0,0").alias("f"),
        F.when(k % 10 == 0, "p").otherwise("v").alias("q"), F.when(k % 8 == 0, "NAVD").otherwise("MSL").alias("datum"))


STORM_PRODUCT_SQL = """
storm_product AS (
  SELECT CASE WHEN o_orderkey % 9 = 0 THEN 'hourly_height' ELSE 'water_level' END AS product,
    CAST(8000000 + o_custkey % 100 AS BIGINT) AS nos_id, TIMESTAMP '2024-01-01' + to_minutes(o_orderkey * 42 % 43200) AS t,
    o_totalprice / 100000.0 AS v, (o_orderkey % 100) / 1000.0 AS s, '0,0,0,0' AS f,
    CASE WHEN o_orderkey % 10 = 0 THEN 'p' ELSE 'v' END AS q, CASE WHEN o_orderkey % 8 = 0 THEN 'NAVD' ELSE 'MSL' END AS datum
  FROM orders
)"""


def json_lines(records: DataFrame, id_column: str) -> DataFrame:
    """Records as JSON text, some of it damaged by id: cut off, a text for a number, no object, blank."""
    k = F.col(id_column)
    line = F.to_json(F.struct("*"))
    line = (F.when(k % 101 == 0, F.substring(line, 1, 20)).when(k % 103 == 0, F.regexp_replace(line, f'"{id_column}":[0-9]+', f'"{id_column}":"x"'))
            .when(k % 107 == 0, F.lit("[1]")).when(k % 109 == 0, F.lit("  ")).otherwise(line))
    return records.select(k.alias("line_no"), line.alias("line"))


def json_reason_sql(k: str) -> str:
    return f"CASE WHEN {k} % 101 = 0 THEN 'no record' WHEN {k} % 103 = 0 THEN 'wrong type' WHEN {k} % 107 = 0 THEN 'no record' WHEN {k} % 109 = 0 THEN 'empty' END"


def with_ctes(*parts: str, body: str) -> str:
    return "WITH " + ",\n".join(p.strip() for p in parts) + "\n" + body


def part_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size", "p_type")
    k = F.col("p_partkey")
    return p.select(k.alias("file_id"), (F.col("p_size") % 10 + 1).cast("long").alias("filetype_id"),
                    F.col("p_name").alias("name"), ((k % 300) * 50).cast("long").alias("event_id"))


def part_sensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_type")
    k = F.col("p_partkey")
    return p.select(k.alias("instrument_id"), (F.col("p_size") % 6 + 1).cast("long").alias("sensor_type_id"),
                    (k % 4 + 1).cast("long").alias("deployment_type_id"), ((k % 300) * 50).cast("long").alias("event_id"),
                    F.col("p_type").alias("location_description"))


PARTS_SQL = """
files AS (SELECT p_partkey AS file_id, CAST(p_size % 10 + 1 AS BIGINT) AS filetype_id, p_name AS name,
                 CAST((p_partkey % 300) * 50 AS BIGINT) AS event_id FROM part),
sensors AS (SELECT p_partkey AS instrument_id, CAST(p_size % 6 + 1 AS BIGINT) AS sensor_type_id,
                   CAST(p_partkey % 4 + 1 AS BIGINT) AS deployment_type_id, CAST((p_partkey % 300) * 50 AS BIGINT) AS event_id,
                   p_type AS location_description FROM part)"""
