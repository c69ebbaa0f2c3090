"""Registered flood-survey queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cyclonespark.operators import correlate as J
from cyclonespark.plans import surrogates as S
from cyclonespark.plans.q_catalog import catalog
from cyclonespark.plans.registry import register
from cyclonespark.schema import FLOOD_EVENT_COLUMNS, hwm_schema
from cyclonespark.sources import surveys as U

EV_COLS = ", ".join(FLOOD_EVENT_COLUMNS)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return U.flood_events(S.flood_event_records(spark, sf_dir))


def hwm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return U.high_water_marks(S.hwm_records(spark, sf_dir))


@register("flood_events", covers=("S6", "J11", "E9"), sql=S.with_ctes(S.FLOOD_SQL, body=f"SELECT {EV_COLS} FROM flood"))
def flood_events(spark, sf_dir):
    return events(spark, sf_dir)


@register("flood_events_filtered", covers=("P12",), sql=S.with_ctes(S.FLOOD_SQL, body=f"""
SELECT {EV_COLS} FROM flood WHERE event_type IN ('HURRICANE', 'TYPHOON') AND event_status = 'COMPLETED'
  AND year IN (1994, 1995, 1996)"""))
def flood_events_filtered(spark, sf_dir):
    return U.flood_events(S.flood_event_records(spark, sf_dir), year=[1994, 1995, 1996],
                          event_type=["HURRICANE", "TYPHOON"], event_status="COMPLETED")


FLOOD_STORMS_SQL = """
fs_ev AS (SELECT * FROM flood WHERE event_type = 'HURRICANE'),
fs_storms AS (SELECT * FROM catalog WHERE line_no <> (SELECT min(line_no) FROM catalog)
              AND year IN (SELECT year FROM fs_ev)),
fs_names AS (SELECT DISTINCT trim(name) AS sn FROM fs_storms WHERE name IS NOT NULL AND trim(name) <> ''),
fs_m AS (
  SELECT e.usgs_id, n.sn, s.nhc_code, s.name AS nhc_name, s.year, s.number, s.basin, s.line_no
  FROM fs_ev e JOIN fs_names n ON regexp_matches(e.name, '(?i)\\b' || n.sn || '\\b')
  JOIN fs_storms s ON s.year = e.year AND contains(upper(s.name), upper(n.sn))
),
fs_best AS (
  SELECT usgs_id, arg_max(nhc_code, (sn, year, number, basin, line_no)) AS nhc_code,
         arg_max(nhc_name, (sn, year, number, basin, line_no)) AS nhc_name
  FROM fs_m GROUP BY usgs_id
),
flood_storms AS (
  SELECT b.nhc_code, e.usgs_id, e.name AS usgs_name, e.year, b.nhc_name, e.description, e.event_type, e.event_status,
    e.coordinator, e.instruments, e.last_updated, e.last_updated_by, e.start_date, e.end_date
  FROM fs_ev e JOIN fs_best b USING (usgs_id)
)"""


def flood_storm_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return J.flood_storms(events(spark, sf_dir), catalog(spark, sf_dir))


@register("flood_storms", covers=("J2", "O3"), sql=S.with_ctes(S.FLOOD_SQL, S.CATALOG_SQL, FLOOD_STORMS_SQL,
                                                               body="SELECT * FROM flood_storms"))
def flood_storms(spark, sf_dir):
    return flood_storm_table(spark, sf_dir).orderBy("usgs_id")


@register("storm_flood_event", covers=("J3",), sql=S.with_ctes(S.FLOOD_SQL, S.CATALOG_SQL, FLOOD_STORMS_SQL, body="""
SELECT c.nhc_code, f.usgs_id FROM (SELECT DISTINCT nhc_code FROM catalog WHERE line_no <> (SELECT min(line_no) FROM catalog)) c
LEFT JOIN (SELECT nhc_code, min(usgs_id) AS usgs_id FROM flood_storms GROUP BY nhc_code) f USING (nhc_code)"""))
def storm_flood_event(spark, sf_dir):
    codes = catalog(spark, sf_dir).select("nhc_code").distinct()
    return J.storm_flood_event(codes, flood_storm_table(spark, sf_dir))


@register("storm_from_event", covers=("P11",), sql=S.with_ctes(S.FLOOD_SQL, S.CATALOG_SQL, FLOOD_STORMS_SQL, body="""
SELECT usgs_id, nhc_code, nhc_name, start_date, end_date FROM flood_storms"""))
def storm_from_event(spark, sf_dir):
    return J.storm_from_event(events(spark, sf_dir), flood_storm_table(spark, sf_dir))


@register("event_by_name", covers=("P15", "O4"), sql=S.with_ctes(S.FLOOD_SQL, body="""
SELECT name AS req_id, min(usgs_id) AS usgs_id FROM flood GROUP BY name"""))
def event_by_name(spark, sf_dir):
    ev = events(spark, sf_dir)
    req = ev.select(F.col("name").alias("req_id"), "name", F.lit(None).cast("int").alias("year")).distinct()
    return U.event_by_name(ev, req)


@register("event_requests", covers=("P15",), sql=S.with_ctes(S.FLOOD_SQL, """
asked AS (
  SELECT c_custkey AS req_id, CASE WHEN c_custkey % 41 <> 0 THEN (1995 + c_custkey % 8) || ' Hurricane Name' || (c_custkey % 110) END AS name,
    CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_custkey % 3 = 0 THEN 1995 + (c_custkey + 1) % 8 ELSE 1995 + c_custkey % 8 END AS year
  FROM customer
)""", body="""
SELECT req_id, usgs_id, CASE WHEN usgs_id IS NOT NULL THEN NULL WHEN name IS NULL THEN 'no name'
  WHEN NOT EXISTS (SELECT 1 FROM flood f WHERE f.name = asked_ids.name) THEN 'unknown name' ELSE 'not in that year' END AS reason
FROM (SELECT a.*, (SELECT min(f.usgs_id) FROM flood f WHERE f.name = a.name AND (a.year IS NULL OR f.year = a.year)) AS usgs_id FROM asked a) asked_ids"""))
def event_requests(spark, sf_dir):
    """Every customer asks for a flood event by name, most with a year; some names or years do not exist."""
    k = F.col("c_custkey")
    name = F.concat((1995 + k % 8).cast("string"), F.lit(" Hurricane Name"), (k % 110).cast("string"))
    year = F.when(k % 5 == 0, F.lit(None)).when(k % 3 == 0, 1995 + (k + 1) % 8).otherwise(1995 + k % 8)
    asked = S.table(spark, sf_dir, "customer").select(k.alias("req_id"), F.when(k % 41 != 0, name).alias("name"), year.cast("int").alias("year"))
    return U.event_requests(events(spark, sf_dir), asked)


HWM_OUT = ("hwm_id, site_id, event_id, hwm_type_id, hwm_quality_id, hwm_environment, stateName, countyName, stillwater, "
           "survey_date, flag_date, elev_ft, height_above_gnd, latitude, longitude, markerName")


@register("high_water_marks", covers=("S7",), sql=S.with_ctes(S.HWM_SQL, body=f"SELECT {HWM_OUT} FROM hwm"))
def high_water_marks(spark, sf_dir):
    return hwm(spark, sf_dir).select(*[c.strip() for c in HWM_OUT.split(",")])


@register("hwm_filtered", covers=("P13", "P14"), sql=S.with_ctes(S.HWM_SQL, S.FLOOD_SQL, body="""
SELECT hwm_id, event_id, stateName, hwm_quality_id FROM hwm
WHERE stateName IN ('STATE_A', 'STATE_N') AND hwm_quality_id IN (1, 2, 3) AND hwm_environment = 'Coastal'
  AND survey_date IS NOT NULL AND stillwater = 0
  AND event_id IN (SELECT usgs_id FROM flood WHERE event_type = 'HURRICANE')"""))
def hwm_filtered(spark, sf_dir):
    q = U.merge_hwm_query({"us_states": ["STATE_A", "STATE_N"], "quality": [1, 2, 3], "still_water": True},
                          environment="Coastal", survey_completed=True, still_water=False, event_type="HURRICANE")
    out = U.filter_hwm(hwm(spark, sf_dir), events=events(spark, sf_dir), **q)
    return out.select("hwm_id", "event_id", "stateName", "hwm_quality_id")


@register("storm_hwm_summary", covers=("J8",), sql=S.with_ctes(S.HWM_SQL, S.FLOOD_SQL, S.CATALOG_SQL, FLOOD_STORMS_SQL, body="""
SELECT f.nhc_code, count(*) AS n_marks, round(avg(h.elev_ft), 6) AS mean_elev_ft, max(h.elev_ft) AS max_elev_ft
FROM flood_storms f JOIN hwm h ON h.event_id = f.usgs_id GROUP BY f.nhc_code"""))
def storm_hwm_summary(spark, sf_dir):
    marks = J.storm_high_water_marks(flood_storm_table(spark, sf_dir), hwm(spark, sf_dir))
    return marks.groupBy("nhc_code").agg(F.count(F.lit(1)).alias("n_marks"), F.round(F.avg("elev_ft"), 6).alias("mean_elev_ft"),
                                        F.max("elev_ft").alias("max_elev_ft"))


@register("event_files", covers=("S9", "P16"), sql=S.with_ctes(S.PARTS_SQL, body="""
SELECT file_id, filetype_id, name, event_id FROM files WHERE event_id IN (50, 100, 150) AND filetype_id IN (1, 2)"""))
def event_files(spark, sf_dir):
    return U.filter_files(S.part_files(spark, sf_dir), event_id=[50, 100, 150], file_type=[1, 2])


@register("event_sensors", covers=("S9", "P16"), sql=S.with_ctes(S.PARTS_SQL, body="""
SELECT instrument_id, sensor_type_id, deployment_type_id, event_id, location_description FROM sensors
WHERE sensor_type_id = 1 AND deployment_type_id IN (2, 3)"""))
def event_sensors(spark, sf_dir):
    return U.filter_sensors(S.part_sensors(spark, sf_dir), sensor_type=1, deployment_type=[2, 3])


# --- S6, S7, S9: records read from JSON text, bad lines put aside ----------------------------

@register("flood_events_json", covers=("S6", "J11"), sql=S.with_ctes(S.FLOOD_SQL, body=f"SELECT {EV_COLS} FROM flood WHERE {S.json_reason_sql('usgs_id')} IS NULL"))
def flood_events_json(spark, sf_dir):
    good, _ = U.json_records(S.json_lines(S.flood_event_records(spark, sf_dir), "event_id"), U.FLOOD_EVENT_RECORD)
    return U.flood_events(good)


@register("high_water_marks_json", covers=("S7",), sql=S.with_ctes(S.HWM_SQL, body=f"""
SELECT hwm_id, site_id, event_id, hwm_quality_id, stateName, survey_date, flag_date, elev_ft, markerName FROM hwm WHERE {S.json_reason_sql('hwm_id')} IS NULL"""))
def high_water_marks_json(spark, sf_dir):
    good, _ = U.json_records(S.json_lines(S.hwm_records(spark, sf_dir), "hwm_id"), hwm_schema())
    return U.high_water_marks(good).select("hwm_id", "site_id", "event_id", "hwm_quality_id", "stateName", "survey_date", "flag_date", "elev_ft", "markerName")


@register("event_files_json", covers=("S9", "P16"), sql=S.with_ctes(S.PARTS_SQL, body=f"""
SELECT file_id, filetype_id, name, event_id FROM files WHERE filetype_id IN (1, 2) AND {S.json_reason_sql('file_id')} IS NULL"""))
def event_files_json(spark, sf_dir):
    good, _ = U.json_records(S.json_lines(S.part_files(spark, sf_dir), "file_id"), U.FILE_RECORD)
    return U.filter_files(good, file_type=[1, 2])


@register("json_quarantine", covers=("S6", "S7", "S9"), sql=S.with_ctes(S.FLOOD_SQL, S.HWM_SQL, S.PARTS_SQL, body=f"""
SELECT 'event' AS record, usgs_id AS line_no, {S.json_reason_sql('usgs_id')} AS reason FROM flood WHERE {S.json_reason_sql('usgs_id')} IS NOT NULL
UNION ALL SELECT 'mark', hwm_id, {S.json_reason_sql('hwm_id')} FROM hwm WHERE {S.json_reason_sql('hwm_id')} IS NOT NULL
UNION ALL SELECT 'file', file_id, {S.json_reason_sql('file_id')} FROM files WHERE {S.json_reason_sql('file_id')} IS NOT NULL
UNION ALL SELECT 'sensor', instrument_id, {S.json_reason_sql('instrument_id')} FROM sensors WHERE {S.json_reason_sql('instrument_id')} IS NOT NULL"""))
def json_quarantine(spark, sf_dir):
    """Lines that hold no record of their schema, with the reason."""
    sources = [("event", S.flood_event_records(spark, sf_dir), "event_id", U.FLOOD_EVENT_RECORD), ("mark", S.hwm_records(spark, sf_dir), "hwm_id", hwm_schema()),
               ("file", S.part_files(spark, sf_dir), "file_id", U.FILE_RECORD), ("sensor", S.part_sensors(spark, sf_dir), "instrument_id", U.SENSOR_RECORD)]
    out = None
    for name, records, key, schema in sources:
        _, bad = U.json_records(S.json_lines(records, key), schema)
        bad = bad.select(F.lit(name).alias("record"), "line_no", "reason")
        out = bad if out is None else out.unionByName(bad)
    return out
