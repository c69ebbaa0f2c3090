"""Registered queries over files: deck text written and read back, extended and fort.22 tails, survey CSV files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cyclonespark.plans import surrogates as S
from cyclonespark.plans.q_tracks import EXPORT_CTES, FORT22_CTES, MOTION_CTES, atcf_line_sql, moving_track, ordered_track
from cyclonespark.plans.registry import register
from cyclonespark.session import shared_path, stored
from cyclonespark.sinks.atcf import format_atcf, format_fort22
from cyclonespark.sinks.files import write_track_files
from cyclonespark.sources import surveys as U
from cyclonespark.sources.decks import parse_deck_lines, read_deck_lines, with_storm_code


def _storm_of(path: str = "path"):
    """The storm that a file is named after."""
    return F.regexp_extract(path, r"([^/]*)\.[^./]*$", 1).cast("long").alias("storm_id")


# --- S1 / S2 / K1: a deck file a storm, read by blocks ---------------------------------------

@register("deck_files", covers=("S1", "S2", "K1", "P1"), sql=S.with_ctes(S.DECK_SQL, body="""
SELECT storm_id, line_no - 1 + blank_before AS line_no,
  upper(last_value(basin || storm_number || CAST(year(record_time) AS VARCHAR)) OVER (PARTITION BY storm_id ORDER BY line_no
    ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS nhc_code,
  record_time, advisory, forecast_hours, latitude, longitude, max_sustained_wind_speed, central_pressure, name
FROM (SELECT * EXCLUDE (line_no), row_number() OVER w AS line_no,
    count(CASE WHEN line_no % 97 = 0 THEN 1 END) OVER w - CASE WHEN line_no % 97 = 0 THEN 1 ELSE 0 END AS blank_before
  FROM deck WINDOW w AS (PARTITION BY storm_id ORDER BY line_no ROWS UNBOUNDED PRECEDING))"""))
def deck_files(spark, sf_dir):
    """Every storm's deck as a file of its own (some with blank lines), read by blocks and parsed."""
    text = S.deck_lines(spark, sf_dir)
    text = text.withColumn("line", F.when(F.col("line_no") % 97 == 0, F.concat("line", F.lit("\n"))).otherwise(F.col("line")))
    folder = shared_path(spark, "decks")
    write_track_files(text, folder, order=["line_no"])
    # the many files are opened once; what is found by file (comma tails, storm codes) reads the lines again
    lines = stored(read_deck_lines(spark, folder), "lines")
    decks = with_storm_code(parse_deck_lines(lines)).withColumnRenamed("storm_id", "nhc_code")
    return decks.select(_storm_of(), "line_no", "nhc_code", "record_time", "advisory", "forecast_hours", "latitude", "longitude",
                        "max_sustained_wind_speed", "central_pressure", "name")


def extended_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deck lines with the extended wave fields: all of them, the first three, or none."""
    n = F.col("line_no")
    full = F.concat(F.lit(", D, "), n % 12, F.lit(", NEQ, "), n % 200, F.lit(", "), n % 150, F.lit(", "), n % 100, F.lit(",    "))
    short = F.concat(F.lit(", S, "), n % 12, F.lit(", AAA"))
    tail = F.when(n % 3 == 0, full).when(n % 3 == 1, short).otherwise("")
    return S.deck_lines(spark, sf_dir).withColumn("line", F.concat("line", tail))


@register("deck_extended_fields", covers=("S2", "E1"), sql=S.with_ctes(S.DECK_SQL, body="""
SELECT storm_id, line_no, latitude, speed,
  CASE line_no % 3 WHEN 0 THEN 'D' WHEN 1 THEN 'S' END AS depth_code,
  CASE WHEN line_no % 3 < 2 THEN CAST(line_no % 12 AS DOUBLE) END AS isowave,
  CASE line_no % 3 WHEN 0 THEN 'NEQ' WHEN 1 THEN 'AAA' END AS isowave_quadrant_code,
  CASE WHEN line_no % 3 = 0 THEN CAST(line_no % 200 AS DOUBLE) END AS isowave_radius_for_NEQ,
  CASE WHEN line_no % 3 = 0 THEN CAST(line_no % 150 AS DOUBLE) END AS isowave_radius_for_SEQ,
  CASE WHEN line_no % 3 = 0 THEN CAST(line_no % 100 AS DOUBLE) END AS isowave_radius_for_SWQ,
  CAST(NULL AS DOUBLE) AS isowave_radius_for_NWQ
FROM deck"""))
def deck_extended_fields(spark, sf_dir):
    """S2 with ``extras="parse"``: wave fields of the tail, missing and blank ones NULL."""
    decks = parse_deck_lines(extended_lines(spark, sf_dir), extras="parse", keep=("storm_id", "line_no"))
    return decks.select("storm_id", "line_no", "latitude", "speed", "depth_code", "isowave", "isowave_quadrant_code",
                        "isowave_radius_for_NEQ", "isowave_radius_for_SEQ", "isowave_radius_for_SWQ", "isowave_radius_for_NWQ")


# --- K1 / K3: ATCF files, a second run beside the first --------------------------------------

PLAIN_CTES = """
plain_in AS (
  SELECT *, last_value(background_pressure IGNORE NULLS) OVER (PARTITION BY storm_id ORDER BY record_time, advisory, line_no
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS bg_ff FROM track
)"""


@register("atcf_files", covers=("K1", "K3", "S1", "F1"), sql=S.with_ctes(
    S.DECK_SQL, PLAIN_CTES, "plain_fmt AS (" + atcf_line_sql("plain_in") + ")",
    body="""SELECT storm_id, row_number() OVER (PARTITION BY storm_id ORDER BY record_time, advisory, line_no) - 1 AS line_no,
  line || CASE WHEN storm_id % 3 = 0 THEN '' ELSE 'second' END AS line FROM plain_fmt"""))
def atcf_files(spark, sf_dir):
    """A third of the storms is written, then all of them with other text: files that were there stay."""
    lines = format_atcf(ordered_track(spark, sf_dir))
    folder = shared_path(spark, "atcf")
    write_track_files(lines.filter("storm_id % 3 = 0"), folder)
    write_track_files(lines.withColumn("line", F.concat("line", F.lit("second"))), folder)
    return read_deck_lines(spark, folder).select(_storm_of(), "line_no", "line")


# --- K2 / S2: fort.22 files and their tails --------------------------------------------------

@register("fort22_files", covers=("K2", "S1", "S2", "F2", "W5"), sql=S.with_ctes(
    S.DECK_SQL, MOTION_CTES, EXPORT_CTES, FORT22_CTES,
    "f22_fmt AS (" + atcf_line_sql("f22_in", tail=False, fh="CAST(hours_since_start AS VARCHAR)") + ")",
    body="""SELECT storm_id, row_number() OVER (PARTITION BY storm_id ORDER BY record_time, advisory, line_no) - 1 AS line_no,
  CAST(hours_since_start AS INTEGER) AS forecast_hours, latitude, longitude, CAST(cp_i AS DOUBLE) AS central_pressure,
  CAST(CASE WHEN bg_i <= cp_i THEN CASE WHEN cp_i >= 1013 THEN cp_i + 1 ELSE 1013 END ELSE bg_i END AS DOUBLE) AS background_pressure,
  CAST(record_number AS DOUBLE) AS record_number, CAST(NULL AS DOUBLE) AS num_isotachs, CAST(NULL AS DOUBLE) AS holland_b
FROM f22_fmt"""))
def fort22_files(spark, sf_dir):
    """Best tracks as one ``.22`` file a storm, read back with their fort.22 tail."""
    folder = shared_path(spark, "fort22")
    write_track_files(format_fort22(moving_track(spark, sf_dir), advisory="BEST"), folder, suffix=".22")
    decks = parse_deck_lines(read_deck_lines(spark, folder), extras="parse", fort22=True)
    return decks.select(_storm_of(), "line_no", "forecast_hours", "latitude", "longitude", "central_pressure", "background_pressure",
                        "record_number", "num_isotachs", "holland_b")


# --- S8: high-water marks in CSV files, the event found by id or by name ---------------------

@register("hwm_csv_events", covers=("S8",), sql=S.with_ctes(S.HWM_SQL, S.FLOOD_SQL, """
marks AS (SELECT h.hwm_id, h.elev_ft, h.event_id, h.survey_date, f.name, h.event_id % 40 AS file FROM hwm h LEFT JOIN flood f ON f.usgs_id = h.event_id),
firsts AS (SELECT file, arg_min(struct_pack(e := event_id, n := name), hwm_id) AS r FROM marks GROUP BY file)""", body="""
SELECT CAST(m.file AS INTEGER) AS file, CASE WHEN m.file % 2 = 0 THEN r.e ELSE (SELECT min(usgs_id) FROM flood WHERE flood.name = r.n) END AS usgs_id,
  count(*) AS n_marks, max(m.elev_ft) AS max_elev_ft, count(m.survey_date) AS n_surveyed
FROM marks m JOIN firsts USING (file) GROUP BY m.file, r"""))
def hwm_csv_events(spark, sf_dir):
    """Marks exported as CSV in 40 folders, half of them without event ids; their events and what their marks hold."""
    from cyclonespark.plans.q_flood import events

    flood = events(spark, sf_dir)
    marks = S.hwm_records(spark, sf_dir).join(flood.select(F.col("usgs_id").alias("event_id"), F.col("name").alias("eventName")), "event_id", "left")
    marks = marks.withColumn("file", F.col("event_id") % 40).withColumn("event_id", F.when(F.col("file") % 2 == 0, F.col("event_id")))
    folder = shared_path(spark, "hwm")
    marks.repartition("file").write.partitionBy("file").option("header", "true").option("ignoreTrailingWhiteSpace", "false").csv(folder)
    read = U.high_water_marks(U.read_hwm_csv(spark, folder).drop("file"))
    totals = read.groupBy("path").agg(F.count("hwm_id").alias("n_marks"), F.max("elev_ft").alias("max_elev_ft"), F.count("survey_date").alias("n_surveyed"))
    found = totals.join(U.csv_event_ids(read, flood), "path", "left")
    return found.select(F.regexp_extract("path", r"/file=(\d+)/", 1).cast("int").alias("file"), "usgs_id", "n_marks", "max_elev_ft", "n_surveyed")
