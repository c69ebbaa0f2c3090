"""Registered track queries: ingest, order, motion, length, summaries, export."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cyclonespark.functions.geodesy import inverse_sql
from cyclonespark.operators import tracks as T
from cyclonespark.operators.ordering import order_track, track_rows
from cyclonespark.operators.velocity import compute_velocity
from cyclonespark.plans import surrogates as S
from cyclonespark.plans.registry import register
from cyclonespark.schema import ATCF_COLUMNS

PARSED_COLUMNS = ["storm_id", "line_no", "record_time", "forecast_hours", "latitude", "longitude"] + [
    c for c in ATCF_COLUMNS if c not in ("datetime", "forecast_hours", "latitude", "longitude")
]


def ordered_track(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_track(S.deck(spark, sf_dir))


def moving_track(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compute_velocity(ordered_track(spark, sf_dir))


# --- S1 / E1 / E2 / P1 / S2: parse ATCF text ------------------------------------------------

@register("deck_parse", covers=("S1", "S2", "E1", "E2", "P1"), sql=S.with_ctes(S.DECK_SQL, body=f"""
SELECT {", ".join(PARSED_COLUMNS)} FROM deck"""))
def deck_parse(spark, sf_dir):
    return S.deck(spark, sf_dir).select(*PARSED_COLUMNS)


# --- O1 / A5 / E3: record order, cycle start, valid time -----------------------------------

@register("track_order", covers=("O1", "A5", "E3", "O5"), sql=S.with_ctes(S.DECK_SQL, body="""
SELECT storm_id, line_no, advisory, track_start_time, datetime,
  row_number() OVER (PARTITION BY storm_id ORDER BY record_time, advisory, line_no) AS row_id
FROM track"""))
def track_order(spark, sf_dir):
    from pyspark.sql import Window

    t = ordered_track(spark, sf_dir)
    rid = F.row_number().over(Window.partitionBy("storm_id").orderBy("record_time", "advisory", "line_no"))
    return t.select("storm_id", "line_no", "advisory", "track_start_time", "datetime", rid.alias("row_id"))


@register("track_positions", covers=("O5", "U1"), sql=S.with_ctes(S.DECK_SQL, body="""
SELECT storm_id, line_no, track_start_time,
  row_number() OVER (PARTITION BY storm_id, advisory, track_start_time
    ORDER BY CASE WHEN advisory = 'BEST' THEN datetime END, record_time, advisory, line_no) - 1 AS track_row
FROM track"""))
def track_positions(spark, sf_dir):
    return track_rows(ordered_track(spark, sf_dir)).select("storm_id", "line_no", "track_start_time", "track_row")


@register("track_keys_best_by_row", covers=("U1", "A5", "A10"), sql=S.with_ctes(S.DECK_SQL, body="""
SELECT storm_id, advisory, record_time AS track_start_time, count(*) AS n_rows, min(datetime) AS first_time, max(datetime) AS last_time
FROM track GROUP BY storm_id, advisory, record_time"""))
def track_keys_best_by_row(spark, sf_dir):
    """Tracks where every BEST record keeps its own time as its start."""
    t = T.separate_tracks(order_track(S.deck(spark, sf_dir), best_start="row"))
    tracks = t.groupBy("track_key").agg(F.count(F.lit(1)).alias("n_rows"), F.min("datetime").alias("first_time"), F.max("datetime").alias("last_time"))
    return tracks.select("track_key.*", "n_rows", "first_time", "last_time")


# --- W1-W3: storm motion -------------------------------------------------------------------

_MOTION_INV, _MOTION_OUT = inverse_sql("motion_ref", "storm_id, line_no, advisory, record_time, dt", prefix="mv")
MOTION_CTES = """
motion_base AS (
  SELECT storm_id, advisory, line_no, record_time, longitude, latitude,
    CAST(epoch(datetime) AS BIGINT) AS ep,
    lag(longitude) OVER w AS plon, lag(latitude) OVER w AS plat, lag(CAST(epoch(datetime) AS BIGINT)) OVER w AS pep
  FROM track WINDOW w AS (PARTITION BY storm_id, advisory ORDER BY record_time, line_no)
),
motion_earlier AS (
  SELECT a.storm_id, a.advisory, a.line_no,
    arg_max(b.longitude, (b.record_time, b.line_no)) AS elon, arg_max(b.latitude, (b.record_time, b.line_no)) AS elat,
    arg_max(CAST(epoch(b.datetime) AS BIGINT), (b.record_time, b.line_no)) AS eep
  FROM track a JOIN track b ON a.storm_id = b.storm_id AND a.advisory = b.advisory AND b.datetime < a.datetime
  GROUP BY a.storm_id, a.advisory, a.line_no
),
motion_later AS (
  SELECT a.storm_id, a.advisory, a.line_no,
    arg_min(b.longitude, (b.record_time, b.line_no)) AS llon, arg_min(b.latitude, (b.record_time, b.line_no)) AS llat,
    arg_min(CAST(epoch(b.datetime) AS BIGINT), (b.record_time, b.line_no)) AS lep
  FROM track a JOIN track b ON a.storm_id = b.storm_id AND a.advisory = b.advisory AND b.datetime > a.datetime
  GROUP BY a.storm_id, a.advisory, a.line_no
),
motion_ref AS (
  SELECT m.storm_id, m.advisory, m.line_no, m.record_time,
    m.longitude AS lon1, m.latitude AS lat1,
    CASE WHEN m.pep IS NULL THEN m.longitude WHEN m.pep > m.ep THEN coalesce(e.elon, l.llon) ELSE m.plon END AS lon2,
    CASE WHEN m.pep IS NULL THEN m.latitude WHEN m.pep > m.ep THEN coalesce(e.elat, l.llat) ELSE m.plat END AS lat2,
    m.ep - CASE WHEN m.pep IS NULL THEN m.ep WHEN m.pep > m.ep THEN coalesce(e.eep, l.lep) ELSE m.pep END AS dt
  FROM motion_base m
  LEFT JOIN motion_earlier e USING (storm_id, advisory, line_no)
  LEFT JOIN motion_later l USING (storm_id, advisory, line_no)
),
""" + _MOTION_INV + """,
motion_raw AS (
  SELECT storm_id, advisory, line_no, record_time,
    CASE WHEN dt <> 0 THEN distance / abs(dt) END AS sp,
    CASE WHEN dt = 0 THEN NULL WHEN dt < 0 THEN ((azimuth % 360) + 360) % 360
         ELSE ((back_azimuth % 360) + 360) % 360 END AS dr
  FROM """ + _MOTION_OUT + """
),
motion AS (
  SELECT storm_id, advisory, line_no,
    coalesce(last_value(sp IGNORE NULLS) OVER wf, first_value(sp IGNORE NULLS) OVER wb) * 1.9438 AS speed,
    coalesce(last_value(dr IGNORE NULLS) OVER wf, first_value(dr IGNORE NULLS) OVER wb) AS direction
  FROM motion_raw
  WINDOW wf AS (PARTITION BY storm_id, advisory ORDER BY record_time, line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         wb AS (PARTITION BY storm_id, advisory ORDER BY record_time, line_no ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
)"""
MOTION_SQL = S.with_ctes(S.DECK_SQL, MOTION_CTES, body="""
SELECT storm_id, advisory, line_no, round(speed, 4) AS speed, round(direction, 4) AS direction FROM motion""")


@register("storm_motion", covers=("W1", "W2", "W3", "W4", "G1"), sql=MOTION_SQL)
def storm_motion(spark, sf_dir):
    t = moving_track(spark, sf_dir)
    return t.select("storm_id", "advisory", "line_no", F.round("speed", 4).alias("speed"), F.round("direction", 4).alias("direction"))


# --- A6 / G2 / A2: track length ------------------------------------------------------------

_LEN_INV, _LEN_OUT = inverse_sql("len_legs", "storm_id, advisory, track_start_time", prefix="ln")
LENGTH_CTES = """
len_pts AS (
  SELECT * FROM (
    SELECT storm_id, advisory, track_start_time, record_time, line_no, longitude, latitude,
      row_number() OVER (PARTITION BY storm_id, advisory, track_start_time, longitude, latitude ORDER BY record_time, line_no) AS rn
    FROM track) WHERE rn = 1
),
len_seq AS (
  SELECT *, lead(longitude) OVER w AS nlon, lead(latitude) OVER w AS nlat
  FROM len_pts WINDOW w AS (PARTITION BY storm_id, advisory, track_start_time ORDER BY record_time, line_no)
),
len_legs AS (
  SELECT storm_id, advisory, track_start_time, longitude AS lon1, latitude AS lat1, nlon AS lon2, nlat AS lat2
  FROM len_seq WHERE nlon IS NOT NULL
),
""" + _LEN_INV + """,
len_track AS (
  SELECT p.storm_id, p.advisory, p.track_start_time, p.n_points, l.length_m
  FROM (SELECT storm_id, advisory, track_start_time, count(*) AS n_points FROM len_pts GROUP BY ALL) p
  LEFT JOIN (SELECT storm_id, advisory, track_start_time, sum(distance) AS length_m FROM """ + _LEN_OUT + """ GROUP BY ALL) l
  USING (storm_id, advisory, track_start_time)
  WHERE p.n_points >= 2
)"""


@register("track_length", covers=("A2", "A6", "G1", "G2", "U5"), sql=S.with_ctes(S.DECK_SQL, LENGTH_CTES, body="""
SELECT storm_id, advisory, track_start_time, n_points, round(length_m, 3) AS length_m FROM len_track"""))
def track_length(spark, sf_dir):
    t = T.track_length(ordered_track(spark, sf_dir))
    return t.select("storm_id", "advisory", "track_start_time", "n_points", F.round("length_m", 3).alias("length_m"))


# --- F1 / F1b / W7 / F2 / W5 / W6: export text ------------------------------------------

def _sql_pad(expr: str, width: int) -> str:
    return f"(CASE WHEN length({expr}) < {width} THEN lpad({expr}, {width}, ' ') ELSE {expr} END)"


def _sql_int(expr: str) -> str:
    return f"CAST(CAST(round_even(coalesce(CAST({expr} AS DOUBLE), -99999.0), 0) AS BIGINT) AS VARCHAR)"


def _sql_hemi(expr: str, pos: str, neg: str) -> str:
    t = _sql_int(expr)
    return f"(CASE WHEN contains({t}, '-') THEN replace({t}, '-', '') || '{neg}' ELSE {t} || '{pos}' END)"


def atcf_line_sql(rel: str, tail: bool = True, fh: str = "CAST(forecast_hours AS VARCHAR)") -> str:
    from cyclonespark.schema import ATCF_WIDTHS

    string_fields = {"basin", "storm_number", "advisory_number", "advisory", "development_level",
                     "isotach_quadrant_code", "subregion_code", "forecaster_initials", "name"}
    parts = []
    for name in ATCF_COLUMNS[:-1]:
        if name == "datetime":
            e = "strftime(CASE WHEN advisory = 'BEST' THEN datetime ELSE track_start_time END, '%Y%m%d%H')"
        elif name == "forecast_hours":
            e = fh
        elif name == "latitude":
            e = _sql_hemi("latitude * 10", "N", "S")
        elif name == "longitude":
            e = _sql_hemi("longitude * 10", "E", "W")
        elif name == "central_pressure":
            e = "CAST(cp_i AS VARCHAR)"
        elif name == "background_pressure":
            e = "CAST(CASE WHEN bg_i <= cp_i THEN CASE WHEN cp_i >= 1013 THEN cp_i + 1 ELSE 1013 END ELSE bg_i END AS VARCHAR)"
        elif name in string_fields:
            e = f"CAST({name} AS VARCHAR)"
        else:
            e = _sql_int(name)
        parts.append(f"coalesce(replace({_sql_pad(e, ATCF_WIDTHS[name])}, '-99999', ''), '')")
    if tail:
        parts.append("coalesce(extra_values, '')")
    return (f"SELECT *, concat_ws(',', {', '.join(parts)}) AS line FROM (SELECT *, "
            f"CAST(round_even(coalesce(central_pressure, -99999.0), 0) AS BIGINT) AS cp_i, "
            f"CAST(round_even(coalesce(bg_ff, -99999.0), 0) AS BIGINT) AS bg_i FROM {rel})")


EXPORT_CTES = """
export_in AS (
  SELECT t.* REPLACE (m.speed AS speed, m.direction AS direction),
    last_value(t.background_pressure IGNORE NULLS) OVER (PARTITION BY t.storm_id ORDER BY t.record_time, t.advisory, t.line_no
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS bg_ff
  FROM track t JOIN motion m USING (storm_id, advisory, line_no)
)"""


@register("atcf_lines", covers=("F1", "F1b", "W7", "K1"), sql=S.with_ctes(
    S.DECK_SQL, MOTION_CTES, EXPORT_CTES, "export_fmt AS (" + atcf_line_sql("export_in") + ")",
    body="SELECT storm_id, line_no, line FROM export_fmt"))
def atcf_lines(spark, sf_dir):
    from cyclonespark.sinks.atcf import format_atcf

    return format_atcf(moving_track(spark, sf_dir)).select("storm_id", "line_no", "line")


FORT22_CTES = """
f22_rank AS (
  SELECT storm_id, datetime, dense_rank() OVER (PARTITION BY storm_id ORDER BY datetime) AS record_number
  FROM (SELECT DISTINCT storm_id, datetime FROM export_in)
),
f22_t0 AS (
  SELECT storm_id, arg_min(datetime, (record_time, advisory, line_no)) AS t0 FROM export_in GROUP BY storm_id
),
f22_in AS (
  SELECT e.*, r.record_number,
    CAST(trunc(CAST(epoch(e.datetime) - epoch(z.t0) AS DOUBLE) / 3600) AS BIGINT) AS hours_since_start
  FROM export_in e JOIN f22_rank r USING (storm_id, datetime) JOIN f22_t0 z USING (storm_id)
  WHERE e.advisory = 'BEST'
)"""


@register("fort22_best_lines", covers=("F2", "W5", "W6", "K2"), sql=S.with_ctes(
    S.DECK_SQL, MOTION_CTES, EXPORT_CTES, FORT22_CTES,
    "f22_fmt AS (" + atcf_line_sql("f22_in", tail=False, fh="CAST(hours_since_start AS VARCHAR)") + ")",
    body="""SELECT storm_id, line_no, line || ',' || (CASE WHEN length(CAST(record_number AS VARCHAR)) < 4
      THEN lpad(CAST(record_number AS VARCHAR), 4, ' ') ELSE CAST(record_number AS VARCHAR) END) AS line FROM f22_fmt"""))
def fort22_best_lines(spark, sf_dir):
    from cyclonespark.sinks.atcf import format_fort22

    return format_fort22(moving_track(spark, sf_dir), advisory="BEST").select("storm_id", "line_no", "line")


# --- P2 / P3 / P4 / P17: advisory selection ------------------------------------------------

@register("advisory_deck_a", covers=("P2", "P3", "P4"), sql=S.with_ctes(S.DECK_SQL, body="""
SELECT storm_id, line_no, advisory FROM deck WHERE advisory IN ('OFCL', 'OFCP', 'HMON', 'CARQ', 'HWRF')"""))
def advisory_deck_a(spark, sf_dir):
    from cyclonespark.operators.filters import default_deck, select_advisories

    deck = default_deck(["OFCL", "HWRF"])
    return select_advisories(S.deck(spark, sf_dir), file_deck=deck).select("storm_id", "line_no", "advisory")


@register("ofcl_without_helper", covers=("P17", "P2"), sql=S.with_ctes(S.DECK_SQL, body="""
SELECT storm_id, line_no, advisory FROM deck WHERE advisory IN ('OFCL', 'CARQ') AND advisory <> 'CARQ'"""))
def ofcl_without_helper(spark, sf_dir):
    from cyclonespark.operators.filters import drop_helpers, requested_advisories, select_advisories

    _, helpers = requested_advisories("a", ["OFCL"])
    loaded = select_advisories(S.deck(spark, sf_dir), file_deck="a", advisories=["OFCL"])
    return drop_helpers(loaded, helpers).select("storm_id", "line_no", "advisory")


# --- P5 / P7 / E7 / E8 / J7: per-storm time slices -----------------------------------------

SLICE_CTES = """
slice_bounds AS (
  SELECT storm_id, arg_min(datetime, (record_time, advisory, line_no)) AS s0,
         arg_max(datetime, (record_time, advisory, line_no)) AS e0
  FROM track GROUP BY storm_id
),
slice_req AS (
  SELECT storm_id, s0, e0,
    CASE WHEN s0 + INTERVAL 1 DAY BETWEEN s0 AND e0 THEN s0 + INTERVAL 1 DAY ELSE s0 END AS s1,
    CASE WHEN e0 - INTERVAL 12 HOUR BETWEEN s0 AND e0 THEN e0 - INTERVAL 12 HOUR ELSE e0 END AS e1
  FROM slice_bounds
)"""


@register("track_time_slice", covers=("P5", "P7", "E7", "E8", "J7"), sql=S.with_ctes(S.DECK_SQL, SLICE_CTES, body="""
SELECT t.storm_id, t.line_no, t.datetime FROM track t JOIN slice_req b USING (storm_id)
WHERE b.s1 <= b.e1 AND t.datetime BETWEEN b.s1 AND b.e1"""))
def track_time_slice(spark, sf_dir):
    from cyclonespark.operators.filters import slice_by_storm_bounds

    t = ordered_track(spark, sf_dir)
    return slice_by_storm_bounds(t, start=86400, end=-43200).select("storm_id", "line_no", "datetime")


@register("storm_bounds", covers=("P7", "A3"), sql=S.with_ctes(S.DECK_SQL, SLICE_CTES, body="""
SELECT storm_id, s0 AS start_date, e0 AS end_date FROM slice_bounds"""))
def storm_bounds_q(spark, sf_dir):
    from cyclonespark.operators.ordering import storm_bounds

    return storm_bounds(ordered_track(spark, sf_dir))


@register("forecast_cycle_slice", covers=("P6", "P5"), sql=S.with_ctes(S.DECK_SQL, SLICE_CTES, body="""
SELECT t.storm_id, t.line_no, t.track_start_time, t.datetime
FROM track t JOIN slice_bounds b USING (storm_id)
JOIN (SELECT storm_id, max(track_start_time) AS ft FROM track WHERE advisory = 'OFCL' GROUP BY storm_id) f USING (storm_id)
WHERE t.advisory <> 'BEST' AND t.track_start_time = f.ft AND t.datetime BETWEEN b.s0 AND b.e0"""))
def forecast_cycle_slice(spark, sf_dir):
    from cyclonespark.operators.filters import forecast_cycle, select_advisories, time_slice
    from cyclonespark.operators.ordering import storm_bounds

    t = select_advisories(ordered_track(spark, sf_dir), file_deck="a")
    latest = t.filter(F.col("advisory") == "OFCL").groupBy("storm_id").agg(F.max("track_start_time").alias("_ft"))
    t = t.join(storm_bounds(ordered_track(spark, sf_dir)), "storm_id").join(latest, "storm_id")
    t = time_slice(forecast_cycle(t, F.col("_ft")), F.col("start_date"), F.col("end_date"))
    return t.select("storm_id", "line_no", "track_start_time", "datetime")


# --- P18 / P21 / A7 / A8 / E12: isotachs and radii ----------------------------------------

MEAN_RADIUS_SQL = "(CASE WHEN ((CASE WHEN isotach_radius_for_NEQ IS NOT NULL AND isotach_radius_for_NEQ <> 0 THEN 1 ELSE 0 END) + (CASE WHEN isotach_radius_for_SEQ IS NOT NULL AND isotach_radius_for_SEQ <> 0 THEN 1 ELSE 0 END) + (CASE WHEN isotach_radius_for_SWQ IS NOT NULL AND isotach_radius_for_SWQ <> 0 THEN 1 ELSE 0 END) + (CASE WHEN isotach_radius_for_NWQ IS NOT NULL AND isotach_radius_for_NWQ <> 0 THEN 1 ELSE 0 END)) > 0 THEN (coalesce(nullif(isotach_radius_for_NEQ, 0), 0) + coalesce(nullif(isotach_radius_for_SEQ, 0), 0) + coalesce(nullif(isotach_radius_for_SWQ, 0), 0) + coalesce(nullif(isotach_radius_for_NWQ, 0), 0)) / ((CASE WHEN isotach_radius_for_NEQ IS NOT NULL AND isotach_radius_for_NEQ <> 0 THEN 1 ELSE 0 END) + (CASE WHEN isotach_radius_for_SEQ IS NOT NULL AND isotach_radius_for_SEQ <> 0 THEN 1 ELSE 0 END) + (CASE WHEN isotach_radius_for_SWQ IS NOT NULL AND isotach_radius_for_SWQ <> 0 THEN 1 ELSE 0 END) + (CASE WHEN isotach_radius_for_NWQ IS NOT NULL AND isotach_radius_for_NWQ <> 0 THEN 1 ELSE 0 END)) END)"


@register("isotach_50_radii", covers=("P18", "P21", "A7", "E12"), sql=S.with_ctes(S.DECK_SQL, body=f"""
SELECT storm_id, line_no,
  nullif(radius_of_maximum_winds, 0) AS radius_of_maximum_winds,
  nullif(central_pressure, 0) AS central_pressure, nullif(background_pressure, 0) AS background_pressure,
  round({MEAN_RADIUS_SQL}, 6) AS mean_radius_nmi,
  round({MEAN_RADIUS_SQL} * 1852.0, 4) AS mean_radius_m
FROM track WHERE isotach_radius = 50"""))
def isotach_50_radii(spark, sf_dir):
    from cyclonespark.functions.timeutil import NMI_TO_M
    from cyclonespark.operators.filters import isotach, zero_to_null

    t = zero_to_null(isotach(ordered_track(spark, sf_dir), 50))
    m = T.mean_quadrant_radius()
    return t.select("storm_id", "line_no", "radius_of_maximum_winds", "central_pressure", "background_pressure",
                    F.round(m, 6).alias("mean_radius_nmi"), F.round(m * NMI_TO_M, 4).alias("mean_radius_m"))


@register("strongest_isotach_radius", covers=("A8",), sql=S.with_ctes(S.DECK_SQL, body="""
SELECT storm_id, advisory, track_start_time, datetime,
  arg_max(greatest(nullif(isotach_radius_for_NEQ, 0), nullif(isotach_radius_for_SEQ, 0), nullif(isotach_radius_for_SWQ, 0), nullif(isotach_radius_for_NWQ, 0)),
          (record_time, advisory, line_no)) AS max_isotach_radius
FROM track GROUP BY storm_id, advisory, track_start_time, datetime"""))
def strongest_isotach_radius(spark, sf_dir):
    return T.strongest_isotach_radius(ordered_track(spark, sf_dir))


# --- A1 / A4 / A10 / A11 / A3: storm summaries --------------------------------------------

@register("storm_name", covers=("A1",), sql=S.with_ctes(S.DECK_SQL, body="""
SELECT storm_id, max(name) AS name FROM (SELECT storm_id, CASE WHEN name IS NULL THEN NULL WHEN row_number() OVER (PARTITION BY storm_id ORDER BY name IS NULL, -n, f) = 1 THEN name END AS name FROM (
  SELECT storm_id, name, count(*) AS n, min((record_time, advisory, line_no)) AS f FROM track GROUP BY storm_id, name))
GROUP BY storm_id"""))
def storm_name(spark, sf_dir):
    return T.storm_name(ordered_track(spark, sf_dir))


@register("storm_name_catalog", covers=("A1",), sql=S.with_ctes(S.DECK_SQL, S.CATALOG_SQL, """
coded AS (SELECT * EXCLUDE (storm_id, name), CASE WHEN storm_id % 2 = 1 THEN name END AS name,
    (['AL', 'EP', 'CP', 'WP'])[storm_id % 4 + 1] || lpad(CAST(storm_id % 40 + 1 AS VARCHAR), 2, '0') || CAST(1992 + storm_id % 7 AS VARCHAR) AS code FROM track),
names AS (SELECT code, name, row_number() OVER (PARTITION BY code ORDER BY name IS NULL, -n, f) AS rn FROM (
  SELECT code, name, count(*) AS n, min((record_time, advisory, line_no)) AS f FROM coded GROUP BY code, name)),
firsts AS (SELECT nhc_code, arg_min(struct_pack(n := name), (year, number, basin, line_no)).n AS name FROM catalog
  WHERE line_no <> (SELECT min(line_no) FROM catalog) GROUP BY nhc_code)""", body="""
SELECT n.code AS storm_id, CASE WHEN trim(coalesce(n.name, '')) = '' THEN lower(f.name) ELSE n.name END AS name
FROM names n LEFT JOIN firsts f ON f.nhc_code = n.code WHERE n.rn = 1"""))
def storm_name_catalog(spark, sf_dir):
    """Every other deck has no names: those storms are named by the catalog."""
    from cyclonespark.plans.q_catalog import catalog
    from cyclonespark.sources.catalogs import catalog_order

    k = F.col("storm_id")
    basin = F.element_at(F.array(*[F.lit(b) for b in ("AL", "EP", "CP", "WP")]), (k % 4 + 1).cast("int"))
    code = F.concat(basin, F.lpad((k % 40 + 1).cast("string"), 2, "0"), (1992 + k % 7).cast("string"))
    track = ordered_track(spark, sf_dir).withColumn("name", F.when(k % 2 == 1, F.col("name"))).withColumn("storm_id", code)
    cat = catalog(spark, sf_dir)
    first = cat.groupBy("nhc_code").agg(F.min_by(F.struct("name"), F.struct(*catalog_order(cat))).alias("s"))
    return T.storm_name(track, first.select("nhc_code", "s.name"))


@register("storm_attributes", covers=("A4", "E9"), sql=S.with_ctes(S.DECK_SQL, body="""
SELECT storm_id,
  arg_min(basin, (record_time, advisory, line_no)) AS basin,
  arg_min(storm_number, (record_time, advisory, line_no)) AS storm_number,
  CAST(year(arg_min(datetime, (record_time, advisory, line_no))) AS INTEGER) AS year,
  upper(arg_max(basin, (record_time, advisory, line_no)) || arg_max(storm_number, (record_time, advisory, line_no))
        || CAST(year(arg_max(datetime, (record_time, advisory, line_no))) AS VARCHAR)) AS nhc_code
FROM track GROUP BY storm_id"""))
def storm_attributes(spark, sf_dir):
    return T.storm_attributes(ordered_track(spark, sf_dir))


@register("track_summary", covers=("A11", "A10", "A3", "A2"), sql=S.with_ctes(S.DECK_SQL, LENGTH_CTES, body="""
SELECT b.storm_id, n_rows, n_advisories, n_tracks, n_times, round(duration_h, 6) AS duration_h, round(l.length_m, 3) AS length_m
FROM (SELECT storm_id, count(*) AS n_rows, count(DISTINCT advisory) AS n_advisories,
        count(DISTINCT (advisory, track_start_time)) AS n_tracks, count(DISTINCT datetime) AS n_times,
        (epoch(arg_max(datetime, (record_time, advisory, line_no))) - epoch(arg_min(datetime, (record_time, advisory, line_no)))) / 3600.0 AS duration_h
      FROM track GROUP BY storm_id) b
LEFT JOIN (SELECT storm_id, sum(length_m) AS length_m FROM len_track GROUP BY storm_id) l USING (storm_id)"""))
def track_summary(spark, sf_dir):
    s = T.track_summary(ordered_track(spark, sf_dir))
    return s.select("storm_id", "n_rows", "n_advisories", "n_tracks", "n_times",
                    F.round("duration_h", 6).alias("duration_h"), F.round("length_m", 3).alias("length_m"))


# --- U1 / U2: separate and combine --------------------------------------------------------

@register("combined_order", covers=("U1", "U2"), sql=S.with_ctes(S.DECK_SQL, body="""
SELECT storm_id, line_no, advisory, track_start_time,
  row_number() OVER (PARTITION BY storm_id ORDER BY af, track_start_time, record_time, advisory, line_no) AS combined_rank
FROM (SELECT *, min((record_time, advisory, line_no)) OVER (PARTITION BY storm_id, advisory) AS af FROM track)"""))
def combined_order(spark, sf_dir):
    from pyspark.sql import Window

    t = T.combine_order(T.separate_tracks(ordered_track(spark, sf_dir)))
    rank = F.row_number().over(Window.partitionBy("storm_id").orderBy("combine_key"))
    return t.select("storm_id", "line_no", "advisory", "track_start_time", rank.alias("combined_rank"))


# --- O6: first file time at or after the requested end -------------------------------------

@register("first_time_after_end", covers=("O6",), sql=S.with_ctes(S.DECK_SQL, SLICE_CTES, body="""
SELECT t.storm_id, min(CASE WHEN t.datetime >= b.e0 - INTERVAL 1 DAY THEN t.datetime END) AS file_end_date
FROM track t JOIN slice_bounds b USING (storm_id) GROUP BY t.storm_id"""))
def first_time_after_end(spark, sf_dir):
    from cyclonespark.operators.ordering import storm_bounds

    t = ordered_track(spark, sf_dir)
    b = storm_bounds(t).select("storm_id", (F.col("end_date") - F.expr("INTERVAL 1 DAY")).alias("end_date"))
    return T.first_time_at_or_after(t.join(b, "storm_id"))


# --- A12 / W13: comparisons ---------------------------------------------------------------

@register("track_equal", covers=("A12",), sql=S.with_ctes(S.DECK_SQL, body="""
SELECT count(*) = 0 AS equal, count(*) AS n_differences FROM (
  (SELECT storm_id, line_no, advisory, latitude, longitude FROM deck
   EXCEPT ALL SELECT storm_id, line_no, advisory, latitude, longitude FROM deck WHERE advisory <> 'HMON')
  UNION ALL
  (SELECT storm_id, line_no, advisory, latitude, longitude FROM deck WHERE advisory <> 'HMON'
   EXCEPT ALL SELECT storm_id, line_no, advisory, latitude, longitude FROM deck))"""))
def track_equal(spark, sf_dir):
    d = S.deck(spark, sf_dir).select("storm_id", "line_no", "advisory", "latitude", "longitude")
    return T.frames_equal(d, d.filter(F.col("advisory") != "HMON"))


@register("position_changes", covers=("W13",), sql=S.with_ctes(S.DECK_SQL, body="""
SELECT storm_id, line_no FROM deck WHERE line_no % 10 = 3"""))
def position_changes(spark, sf_dir):
    from cyclonespark.operators.velocity import changed_positions

    d = S.deck(spark, sf_dir)
    moved = d.withColumn("longitude", F.when(F.col("line_no") % 10 == 3, F.col("longitude") + 0.1).otherwise(F.col("longitude")))
    return changed_positions(d, moved, key=("storm_id", "line_no"))


_MOVED = "line_no % 37 = 3"


def moved_track(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The surrogate track with some positions edited."""
    return ordered_track(spark, sf_dir).withColumn("longitude", F.when(F.expr(_MOVED), F.col("longitude") + 0.1).otherwise(F.col("longitude")))


@register("motion_recomputed", covers=("W4", "W13"), sql=S.with_ctes(S.DECK_SQL, f"""
track_m AS (SELECT * REPLACE (CASE WHEN {_MOVED} THEN longitude + 0.1 ELSE longitude END AS longitude) FROM track)""",
    re.sub(r"\btrack\b", "track_m", MOTION_CTES), f"""
todo AS (SELECT storm_id, line_no, {_MOVED} OR speed IS NULL AS changed FROM track_m),
ref_prev AS (
  SELECT storm_id, advisory, line_no, datetime, lag(line_no) OVER w AS prev, lag(datetime) OVER w AS prev_at
  FROM track_m WINDOW w AS (PARTITION BY storm_id, advisory ORDER BY record_time, line_no)
),
ref_line AS (
  SELECT r.storm_id, r.line_no, CASE WHEN any_value(prev_at) > r.datetime THEN coalesce(
      arg_max(b.line_no, (b.record_time, b.line_no)) FILTER (b.datetime < r.datetime),
      arg_min(b.line_no, (b.record_time, b.line_no)) FILTER (b.datetime > r.datetime)) ELSE any_value(prev) END AS ref
  FROM ref_prev r JOIN track_m b ON b.storm_id = r.storm_id AND b.advisory = r.advisory GROUP BY r.storm_id, r.line_no, r.datetime
)""", body="""
SELECT t.storm_id, t.line_no, round(CASE WHEN a.changed OR coalesce(b.changed, false) THEN m.speed ELSE t.speed END, 4) AS speed,
  round(CASE WHEN a.changed OR coalesce(b.changed, false) THEN m.direction ELSE t.direction END, 4) AS direction
FROM track_m t JOIN motion m ON m.storm_id = t.storm_id AND m.line_no = t.line_no JOIN todo a ON a.storm_id = t.storm_id AND a.line_no = t.line_no
JOIN ref_line r ON r.storm_id = t.storm_id AND r.line_no = t.line_no LEFT JOIN todo b ON b.storm_id = r.storm_id AND b.line_no = r.ref"""))
def motion_recomputed(spark, sf_dir):
    from cyclonespark.operators.velocity import changed_positions, recompute_changed

    moved = moved_track(spark, sf_dir)
    changed = changed_positions(ordered_track(spark, sf_dir), moved, key=("storm_id", "line_no"))
    out = recompute_changed(moved, changed)
    return out.select("storm_id", "line_no", F.round("speed", 4).alias("speed"), F.round("direction", 4).alias("direction"))


# --- P19: decks whose RAD field is missing ---------------------------------------------------

@register("deck_rad_check", covers=("P19",), sql=S.with_ctes(S.DECK_SQL, body="""
SELECT storm_id, count(*) FILTER (WHERE line_no % 17 = 0) AS rows_without_rad FROM deck GROUP BY storm_id"""))
def deck_rad_check(spark, sf_dir):
    from cyclonespark.sources.decks import rad_field_check

    # every 17th line ends before its RAD field, every 19th of the others has a blank one
    d = S.deck_lines(spark, sf_dir)
    fields = F.split("line", ",")
    blank = F.transform(fields, lambda x, i: F.when(i == 11, F.lit("    ")).otherwise(x))
    cut = F.when(F.col("line_no") % 17 == 0, F.array_join(F.slice(fields, 1, 10), ","))
    d = d.withColumn("line", F.coalesce(cut, F.when(F.col("line_no") % 19 == 0, F.array_join(blank, ",")), "line"))
    bad = rad_field_check(d, file_col="storm_id")
    return d.select("storm_id").distinct().join(bad, "storm_id", "left").select(
        "storm_id", F.coalesce("rows_without_rad", F.lit(0)).cast("long").alias("rows_without_rad"))
