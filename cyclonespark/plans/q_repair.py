"""Registered repair queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from cyclonespark.operators import repair as R
from cyclonespark.plans import surrogates as S
from cyclonespark.plans.q_tracks import ordered_track
from cyclonespark.plans.registry import register

REF_CTES = """
carq_cyc AS (SELECT DISTINCT storm_id, track_start_time FROM track WHERE advisory = 'CARQ'),
carq_ref0 AS (
  SELECT storm_id, track_start_time,
    arg_min(radius_of_maximum_winds, (record_time, advisory, line_no)) AS rmw0,
    arg_min(background_pressure, (record_time, advisory, line_no)) AS bg0,
    arg_min(central_pressure, (record_time, advisory, line_no)) AS pc0,
    arg_min(max_sustained_wind_speed, (record_time, advisory, line_no)) AS vmax0
  FROM track WHERE advisory = 'CARQ' AND forecast_hours = 0 GROUP BY storm_id, track_start_time
),
carq_ref AS (SELECT c.storm_id, c.track_start_time, r.rmw0, r.bg0, r.pc0, r.vmax0
             FROM carq_cyc c LEFT JOIN carq_ref0 r USING (storm_id, track_start_time)),
carq_first AS (SELECT storm_id, rmw0, bg0, pc0, vmax0 FROM (
  SELECT *, row_number() OVER (PARTITION BY storm_id ORDER BY track_start_time) AS rn FROM carq_ref) WHERE rn = 1),
refs AS (
  SELECT o.storm_id, o.track_start_time,
    CASE WHEN s.storm_id IS NOT NULL THEN s.rmw0 ELSE f.rmw0 END AS rmw0,
    CASE WHEN s.storm_id IS NOT NULL THEN s.bg0 ELSE f.bg0 END AS bg0,
    CASE WHEN s.storm_id IS NOT NULL THEN s.pc0 ELSE f.pc0 END AS pc0,
    CASE WHEN s.storm_id IS NOT NULL THEN s.vmax0 ELSE f.vmax0 END AS vmax0
  FROM (SELECT DISTINCT storm_id, track_start_time FROM track WHERE advisory = 'OFCL') o
  JOIN carq_first f ON f.storm_id = o.storm_id
  LEFT JOIN carq_ref s ON s.storm_id = o.storm_id AND s.track_start_time = o.track_start_time
),
rep_in AS (
  SELECT t.*, r.rmw0, r.bg0, r.pc0, r.vmax0,
    (t.radius_of_maximum_winds IS NULL OR t.radius_of_maximum_winds = 0) AS rmw_missing,
    (t.central_pressure IS NULL OR t.central_pressure = 0) AS pc_missing,
    (t.background_pressure IS NULL OR t.background_pressure = 0) AS bg_missing
  FROM track t JOIN refs r USING (storm_id, track_start_time) WHERE t.advisory = 'OFCL'
),
rep_other AS (
  SELECT t.* FROM track t
  WHERE NOT (t.advisory = 'OFCL' AND EXISTS (SELECT 1 FROM refs r WHERE r.storm_id = t.storm_id AND r.track_start_time = t.track_start_time))
),
rep_persist AS (
  SELECT * REPLACE (
    CASE WHEN rmw_missing THEN rmw0 ELSE radius_of_maximum_winds END AS radius_of_maximum_winds,
    CASE WHEN bg_missing THEN bg0 ELSE background_pressure END AS background_pressure)
  FROM rep_in
)"""

OUT_COLS = "storm_id, line_no, advisory, radius_of_maximum_winds, round(background_pressure, 6) AS background_pressure, round(central_pressure, 6) AS central_pressure"


def _out(df):
    return df.select("storm_id", "line_no", "advisory", "radius_of_maximum_winds",
                     F.round("background_pressure", 6).alias("background_pressure"),
                     F.round("central_pressure", 6).alias("central_pressure"))


@register("carq_reference", covers=("J4",), sql=S.with_ctes(S.DECK_SQL, REF_CTES, body="""
SELECT storm_id, track_start_time, rmw0, bg0, pc0, vmax0 FROM refs"""))
def carq_reference(spark, sf_dir):
    r = R.carq_reference(ordered_track(spark, sf_dir))
    return r.select("storm_id", "track_start_time", "ref.rmw0", "ref.bg0", "ref.pc0", "ref.vmax0")


HOLLAND_SQL = """
rep_holland AS (
  SELECT * REPLACE (
    CASE WHEN pc_missing THEN
      CASE WHEN vmax0 IS NULL OR bg0 IS NULL OR pc0 IS NULL THEN NULL
           WHEN bg0 = pc0 THEN background_pressure
           ELSE (-(max_sustained_wind_speed * max_sustained_wind_speed) * 1.15 * exp(1)) / ((vmax0 * vmax0 * 1.15 * exp(1)) / (bg0 - pc0)) + background_pressure END
    ELSE central_pressure END AS central_pressure)
  FROM rep_persist
)"""


@register("ofcl_repair_persistent", covers=("M1", "M2", "M6", "M7", "M10", "P21"), sql=S.with_ctes(
    S.DECK_SQL, REF_CTES, HOLLAND_SQL, body=f"""
SELECT {OUT_COLS} FROM rep_holland
UNION ALL SELECT {OUT_COLS} FROM rep_other"""))
def ofcl_repair_persistent(spark, sf_dir):
    return _out(R.correct_ofcl(ordered_track(spark, sf_dir), rmw_fill="persistent", pc_fill="persistent_holland_b"))


def _r34_sql(scale: str) -> str:
    q = ["isotach_radius_for_NEQ", "isotach_radius_for_SEQ", "isotach_radius_for_SWQ", "isotach_radius_for_NWQ"]
    num = " + ".join(f"coalesce(nullif({c}, 0), 0)" for c in q)
    den = " + ".join(f"(CASE WHEN {c} IS NOT NULL AND {c} <> 0 THEN 1 ELSE 0 END)" for c in q)
    return f"0.85 * (CASE WHEN ({den}) > 0 THEN ({num}) / ({den}) END) * {scale}"


CHAVAS_SQL = f"""
chv_a AS (SELECT *, {_r34_sql('1852.0')} AS r34own FROM rep_persist WHERE pc_missing),
chv_b AS (
  SELECT *, CASE WHEN isotach_radius > 35 THEN last_value(CASE WHEN isotach_radius <= 35 THEN r34own END IGNORE NULLS)
      OVER (PARTITION BY storm_id, advisory, track_start_time ORDER BY record_time, advisory, line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
    ELSE r34own END AS r34,
    CASE WHEN 0.5144 * (max_sustained_wind_speed - 0.55 * speed) < 20 THEN 20.0
         ELSE 0.5144 * (max_sustained_wind_speed - 0.55 * speed) END AS vv,
    7.292e-5 * sin(radians(latitude)) AS fo2
  FROM chv_a
),
rep_chavas AS (
  SELECT * EXCLUDE (r34own, r34, vv, fo2) REPLACE (
    round_even(background_pressure + 2 + coalesce(-6.60 + -0.0127 * vv * vv + -5.506 * fo2 * r34 + 109.013 * fo2 * r34 / vv,
                                                   20.23 + -1.54 * vv), 0) AS central_pressure)
  FROM chv_b
  UNION ALL SELECT * FROM rep_persist WHERE NOT pc_missing
)"""


@register("ofcl_repair_chavas", covers=("M8", "W8", "M10"), sql=S.with_ctes(S.DECK_SQL, REF_CTES, CHAVAS_SQL, body=f"""
SELECT {OUT_COLS} FROM rep_chavas
UNION ALL SELECT {OUT_COLS} FROM rep_other"""))
def ofcl_repair_chavas(spark, sf_dir):
    return _out(R.correct_ofcl(ordered_track(spark, sf_dir), rmw_fill="persistent", pc_fill="regression_chavas_2025"))


CK_SQL = f"""
ck_a AS (SELECT *, {_r34_sql('1.0')} AS r34own FROM rep_persist WHERE pc_missing),
ck_b AS (
  SELECT *, CASE WHEN isotach_radius > 35 THEN last_value(CASE WHEN isotach_radius <= 35 THEN r34own END IGNORE NULLS)
      OVER (PARTITION BY storm_id, advisory, track_start_time ORDER BY record_time, advisory, line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
    ELSE r34own END AS r34
  FROM ck_a
),
ck_c AS (
  SELECT *, coalesce(last_value(r34 IGNORE NULLS) OVER wf, first_value(r34 IGNORE NULLS) OVER wb) AS r34f,
    CASE WHEN max_sustained_wind_speed - 1.5 * pow(speed, 0.63) < 25 THEN 25.0
         ELSE max_sustained_wind_speed - 1.5 * pow(speed, 0.63) END AS vsrm
  FROM ck_b
  WINDOW wf AS (PARTITION BY storm_id, advisory, track_start_time ORDER BY record_time, advisory, line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         wb AS (PARTITION BY storm_id, advisory, track_start_time ORDER BY record_time, advisory, line_no ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
),
ck_d AS (
  SELECT *, (r34f / 9 - 3) / (max_sustained_wind_speed * pow((66.785 - 0.09102 * max_sustained_wind_speed + 1.0619 * (latitude - 25)) / 500,
                                 0.1147 + 0.0055 * max_sustained_wind_speed - 0.001 * (latitude - 25))) AS s0
  FROM ck_c
),
rep_ck AS (
  SELECT * EXCLUDE (r34own, r34, r34f, vsrm, s0) REPLACE (
    round_even(background_pressure + 2 + CASE WHEN latitude < 18
        THEN 5.962 - 0.267 * vsrm - pow(vsrm / 18.26, 2.0) - 6.8 * (CASE WHEN s0 < 0.4 THEN 0.4 ELSE s0 END)
        ELSE 23.286 - 0.483 * vsrm - pow(vsrm / 24.524, 2.0) - 12.587 * (CASE WHEN s0 < 0.4 THEN 0.4 ELSE s0 END) - 0.483 * latitude END, 0)
      AS central_pressure)
  FROM ck_d
  UNION ALL SELECT * FROM rep_persist WHERE NOT pc_missing
)"""


@register("ofcl_repair_courtney_knaff", covers=("M9", "W9", "M10"), sql=S.with_ctes(S.DECK_SQL, REF_CTES, CK_SQL, body=f"""
SELECT {OUT_COLS} FROM rep_ck
UNION ALL SELECT {OUT_COLS} FROM rep_other"""))
def ofcl_repair_courtney_knaff(spark, sf_dir):
    return _out(R.correct_ofcl(ordered_track(spark, sf_dir), rmw_fill="persistent", pc_fill="regression_courtney_knaff_2009"))


def _values(rows) -> str:
    return "(VALUES " + ", ".join("(" + ", ".join(str(v) for v in row) + ")" for row in rows) + ")"


_BIAS_ROWS = _values((12 * i, *row) for i, row in enumerate(zip(R.BIAS_LAT, R.BIAS_VMAX, R.BIAS_R34, R.BIAS_R50, R.BIAS_R64, strict=True)))
_COEF_ROWS = _values((n, hour, f"{row}::DOUBLE[]") for n, rows in R.COEFS.items() for hour, row in zip(R.COEF_HOURS, rows, strict=False))
_COEF_LAST = _values((n, f"{rows[-1]}::DOUBLE[]") for n, rows in R.COEFS.items())
_QUADRANTS = ["isotach_radius_for_NEQ", "isotach_radius_for_SEQ", "isotach_radius_for_SWQ", "isotach_radius_for_NWQ"]
_GRID_HOURS = ", ".join(f"({h})" for h in R.SMOOTHING_EXTRA_HOURS)

REGRESSION_SQL = f"""
reg_rows AS (
  SELECT *, {_r34_sql('1.0')} / 0.85 AS mean_radius, greatest({", ".join(f"nullif({q}, 0)" for q in _QUADRANTS)}) AS max_radius,
    row_number() OVER (PARTITION BY storm_id, track_start_time, forecast_hours ORDER BY line_no) AS pos
  FROM rep_in
),
reg_hours AS (
  SELECT storm_id, track_start_time, forecast_hours AS h, any_value(rmw0) AS rmw0, count(*) AS n, min(line_no) FILTER (rmw_missing) AS asks,
    max(max_sustained_wind_speed) FILTER (pos = 1) AS vmax, max(latitude) FILTER (pos = 1) AS lat, max(radius_of_maximum_winds) FILTER (pos = 1) AS rmw,
    [max(mean_radius) FILTER (pos = 1), max(mean_radius) FILTER (pos = 2), max(mean_radius) FILTER (pos = 3)] AS means, count(mean_radius) > 0 AS has,
    arg_max({{'maxr': max_radius, 'iso': isotach_radius, 'vmax': max_sustained_wind_speed, 'rmw': radius_of_maximum_winds}}, line_no) AS fin
  FROM reg_rows GROUP BY storm_id, track_start_time, forecast_hours
),
reg_bias(hb, b_lat, b_vmax, b34, b50, b64) AS {_BIAS_ROWS},
reg_coef(cn, ch, a) AS {_COEF_ROWS},
reg_coef_last(cn, a) AS {_COEF_LAST},
reg_steps AS (
  SELECT storm_id, track_start_time, h, rmw0, vmax - b_vmax AS v, lat - b_lat AS lat, has,
    [means[1] - b34, means[2] - b50, means[3] - b64][1:n] AS own,
    row_number() OVER (PARTITION BY storm_id, track_start_time ORDER BY asks) AS k
  FROM reg_hours JOIN reg_bias ON hb = least(h, 120) WHERE asks IS NOT NULL AND h >= 12 AND n <= 3
),
reg_fold(storm_id, track_start_time, k, h, radii) AS (
  SELECT DISTINCT storm_id, track_start_time, 0::BIGINT, 0, [NULL::DOUBLE] FROM reg_steps
  UNION ALL
  SELECT s.storm_id, s.track_start_time, s.k, s.h,
    CASE WHEN s.has THEN s.own WHEN s.v > 50 THEN f.radii[1:2] WHEN s.v > 34 THEN f.radii[1:1] ELSE [NULL::DOUBLE] END
  FROM reg_fold f JOIN reg_steps s ON s.storm_id = f.storm_id AND s.track_start_time = f.track_start_time AND s.k = f.k + 1
),
reg_known AS (
  SELECT s.*, list_filter(f.radii, lambda r: r IS NOT NULL) AS r FROM reg_steps s JOIN reg_fold f USING (storm_id, track_start_time, k)
),
reg_raw AS (
  SELECT storm_id, track_start_time, x.h, rmw0,
    pow(rmw0, a[2]) * coalesce(list_aggregate(list_transform(r, lambda y, i: pow(y, a[i + 2])), 'product'), 1)
      * pow(v, a[len(r) + 3]) * exp(a[1] + a[len(r) + 4] * lat) AS est
  FROM (SELECT g.*, coalesce(c.a, l.a) AS a FROM reg_known g JOIN reg_coef_last l ON l.cn = len(g.r) LEFT JOIN reg_coef c ON c.cn = len(g.r) AND c.ch = g.h) x
  UNION ALL SELECT storm_id, track_start_time, h, rmw0, rmw0 FROM reg_hours WHERE asks IS NOT NULL AND h < 12
),
reg_est AS (
  SELECT storm_id, track_start_time, h, CASE WHEN est IS NULL OR isnan(est) THEN greatest(120.0, rmw0) ELSE greatest(least(est, greatest(120.0, rmw0)), 5.0) END AS est FROM reg_raw
),
sm_points AS (SELECT storm_id, track_start_time, h, coalesce(est, rmw) AS r FROM reg_hours LEFT JOIN reg_est USING (storm_id, track_start_time, h)),
sm_hours AS (
  SELECT storm_id, track_start_time, h AS g FROM sm_points
  UNION SELECT storm_id, track_start_time, extra.h FROM (SELECT DISTINCT storm_id, track_start_time FROM sm_points) CROSS JOIN (VALUES {_GRID_HOURS}) extra(h)
),
sm_ends AS (
  SELECT storm_id, track_start_time, g, arg_max({{'h': h, 'r': r}}, h) FILTER (h <= g) AS p, arg_min({{'h': h, 'r': r}}, h) FILTER (h >= g) AS n
  FROM sm_hours JOIN sm_points USING (storm_id, track_start_time) GROUP BY storm_id, track_start_time, g
),
sm_grid AS (
  SELECT storm_id, track_start_time, g, CASE WHEN p IS NULL THEN n.r WHEN n IS NULL OR p.h = g THEN p.r ELSE p.r + ((g - p.h) / (n.h - p.h)) * (n.r - p.r) END AS r FROM sm_ends
),
sm_mean AS (
  SELECT a.storm_id, a.track_start_time, a.g, avg(b.r) AS mean
  FROM sm_grid a JOIN sm_grid b ON a.storm_id = b.storm_id AND a.track_start_time = b.track_start_time AND abs(a.g - b.g) <= 12 GROUP BY ALL
),
sm_origin AS (SELECT storm_id, track_start_time, arg_min(forecast_hours, line_no) AS origin FROM rep_in GROUP BY ALL),
sm_fix AS (
  SELECT storm_id, track_start_time, h, coalesce(mean < fin.maxr OR fin.maxr IS NULL, false) AS use, mean, fin.maxr AS maxr, fin.maxr * fin.iso / nullif(fin.vmax, 0) AS bounded, coalesce(est, fin.rmw) AS own
  FROM reg_hours JOIN sm_origin USING (storm_id, track_start_time) JOIN sm_mean m USING (storm_id, track_start_time) LEFT JOIN reg_est USING (storm_id, track_start_time, h)
  WHERE m.g = h - origin AND h <> 0
),
rep_regression AS (
  SELECT t.* REPLACE (
    CASE WHEN coalesce(CASE WHEN f.use THEN f.mean ELSE f.own END > f.maxr, false) THEN f.bounded WHEN f.use THEN f.mean ELSE coalesce(e.est, t.radius_of_maximum_winds) END AS radius_of_maximum_winds,
    CASE WHEN bg_missing THEN bg0 ELSE background_pressure END AS background_pressure)
  FROM rep_in t LEFT JOIN reg_est e ON e.storm_id = t.storm_id AND e.track_start_time = t.track_start_time AND e.h = t.forecast_hours
  LEFT JOIN sm_fix f ON f.storm_id = t.storm_id AND f.track_start_time = t.track_start_time AND f.h = t.forecast_hours
)"""


def _rounded(columns: str) -> str:
    return columns.replace("radius_of_maximum_winds", "round(radius_of_maximum_winds, 6) AS radius_of_maximum_winds")


@register("ofcl_repair_regression", covers=("M3", "M4", "M5", "W10", "W11", "J10", "E11", "M10"), sql=S.with_ctes(
    S.DECK_SQL, REF_CTES, REGRESSION_SQL, HOLLAND_SQL.replace("FROM rep_persist", "FROM rep_regression"), body=f"""
SELECT {_rounded(OUT_COLS)} FROM rep_holland
UNION ALL SELECT {_rounded(OUT_COLS)} FROM rep_other""").replace("WITH ", "WITH RECURSIVE ", 1))
def ofcl_repair_regression(spark, sf_dir):
    """Default repair: Penny regression with smoothing, persistent Holland B."""
    out = R.correct_ofcl(ordered_track(spark, sf_dir))
    return _out(out).withColumn("radius_of_maximum_winds", F.round("radius_of_maximum_winds", 6))


# --- M1: Holland B and its inversions ------------------------------------------------------

@register("holland_b_inversions", covers=("M1", "E12"), sql=S.with_ctes(S.DECK_SQL, body="""
SELECT storm_id, line_no, round(b, 6) AS b, round(bg - v * v * 1.15 * exp(1.0) / b, 6) AS central_from_b,
  round(sqrt(b * (bg - pc) / (1.15 * exp(1.0))), 6) AS wind_from_b
FROM (SELECT *, v * v * 1.15 * exp(1.0) / (bg - pc) AS b FROM (
  SELECT storm_id, line_no, max_sustained_wind_speed * 0.5144 AS v, background_pressure * 100 AS bg, nullif(central_pressure, 0) * 100 AS pc
  FROM deck) WHERE bg > pc)"""))
def holland_b_inversions(spark, sf_dir):
    """B of every record with a pressure deficit, and the pressure and wind that it gives back."""
    from cyclonespark.functions import pressure as P

    deck = S.deck(spark, sf_dir).select("storm_id", "line_no", (F.col("max_sustained_wind_speed") * 0.5144).alias("v"),
                                        (F.col("background_pressure") * 100).alias("bg"), (F.nullif("central_pressure", F.lit(0.0)) * 100).alias("pc"))
    v, bg, pc, b = (F.col(c) for c in ("v", "bg", "pc", "b"))
    out = deck.filter(bg > pc).withColumn("b", P.holland_b(v, bg, pc))
    return out.select("storm_id", "line_no", F.round("b", 6).alias("b"), F.round(P.central_from_holland_b(v, bg, b), 6).alias("central_from_b"),
                      F.round(P.vmax_from_holland_b(b, bg, pc), 6).alias("wind_from_b"))
