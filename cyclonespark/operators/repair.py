"""Forecast repair of OFCL cycles from the CARQ consensus.

Per OFCL cycle (storm, track_start_time):

1. J4  reference record: first tau-0 record of the CARQ cycle with the same start,
       else of the storm's first CARQ cycle (a left join + a per-storm fallback);
2. masks of missing RMW / central / background pressure (0 or NULL), taken once;
3. RMW: ``persistent`` (M2), or the Penny et al. (2023) regression (M3/M4) with the
       24 h moving-mean smoothing (M5 = W10 + W11);
4. M6  background pressure from the reference;
5. central pressure: persistent Holland B (M7), Chavas (M8) or Courtney-Knaff (M9).

Records of a cycle are reduced to one struct per lead hour, a cycle's hours (at most the
distinct lead hours of the format, whatever the number of records) to one sorted array, and one
``F.aggregate`` walks it, carrying the isotach radii from hour to hour; the moving mean reads the
same array.  Records are shuffled by cycle once; the cycle's answer, a map from lead hour, is
joined back on that partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cyclonespark.functions import pressure as P
from cyclonespark.functions.columns import let
from cyclonespark.functions.timeutil import NMI_TO_M, clamp
from cyclonespark.operators.ordering import ORDER_COLUMNS, row_key
from cyclonespark.operators.tracks import max_quadrant_radius, mean_quadrant_radius

CYCLE = ["storm_id", "advisory", "track_start_time"]

# --- FIXED VALUES: Penny et al. (2023) bias corrections, lead hours 0, 12, ..., 120 ---------
BIAS_LAT = [0.0063, 0.0301, 0.0299, 0.0085, -0.0199, -0.0354, -0.0799, -0.1240, -0.1572, -0.1982, -0.1706]
BIAS_VMAX = [-0.8047, -0.2003, -0.2001, -0.4070, -0.6271, -0.7515, -0.3369, -0.3338, -0.3930, -0.8167, -1.4322]
BIAS_R34 = [-2.0503, -5.5195, -7.7374, -8.4337, -8.1458, -10.2065, -12.6435, 0, 0, 0, 0]
BIAS_R50 = [-0.7659, -3.2270, -4.5476, -6.2219, -7.7406, -8.5449, -10.0759, 0, 0, 0, 0]
BIAS_R64 = [-0.5082, -2.4170, -3.6993, -4.7795, 0, 0, 0, 0, 0, 0, 0]

# --- FIXED VALUES: Penny et al. (2023) regression coefficients by number of radii ----------
# rows follow the lead hours 12, 24, 36, 48, 72, 96, 120 (as far as listed); a lead hour that
# is not listed, or beyond the rows of its table, uses the last row
COEF_HOURS = [12, 24, 36, 48, 72, 96, 120]
COEFS = {
    3: [
        [3.1894, 0.3524, 0.1208, -0.1091, 0.5862, -0.8070, 0.0057],
        [4.4373, 0.1473, 0.1045, -0.1112, 0.7566, -1.0689, 0.0061],
        [4.9447, 0.0784, 0.1168, -0.1448, 0.8246, -1.1709, 0.0059],
        [5.1818, 0.0549, 0.1335, -0.2345, 0.8972, -1.2038, 0.0063],
    ],
    2: [
        [3.1131, 0.3680, 0.1589, 0.4710, -0.9111, 0.0068],
        [4.1567, 0.1834, 0.2085, 0.5873, -1.1841, 0.0073],
        [4.6694, 0.1062, 0.2330, 0.6295, -1.3122, 0.0074],
        [4.9434, 0.0459, 0.3027, 0.5828, -1.3675, 0.0079],
        [4.7906, 0.0157, 0.3953, 0.5321, -1.3617, 0.0067],
    ],
    1: [
        [2.6272, 0.4230, 0.6320, -0.9117, 0.0064],
        [3.6525, 0.2142, 0.8222, -1.2158, 0.0082],
        [4.2822, 0.0884, 0.9059, -1.3656, 0.0091],
        [4.7700, -0.0042, 0.9225, -1.4349, 0.0102],
        [4.7307, -0.0365, 0.9153, -1.3882, 0.0086],
    ],
    0: [
        [2.1633, 0.6360, -0.3314, 0.0154],
        [3.7884, 0.3953, -0.5738, 0.0219],
        [5.0213, 0.1999, -0.7481, 0.0276],
        [5.8092, 0.0615, -0.8508, 0.0318],
        [6.3321, -0.0362, -0.9079, 0.0343],
        [6.6181, 0.0041, -0.9599, 0.0295],
        [6.7073, -0.0028, -0.9478, 0.0257],
    ],
}
SMOOTHING_EXTRA_HOURS = [60, 84, 108]  # FIXED VALUES: hours always added before smoothing


def _lit_array(values) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def _bias(table, hour: Column) -> Column:
    """Bias at min(hour, 120); NULL when that hour is not a multiple of 12."""
    h = F.least(hour, F.lit(120))
    return F.when(h % 12 == 0, F.element_at(_lit_array(table), (h / 12).cast("int") + 1))


def _coefs(n_radii: Column, hour: Column) -> Column:
    """Coefficient row for the number of radii and the lead hour."""
    idx = F.coalesce(F.array_position(F.array(*[F.lit(h) for h in COEF_HOURS]), hour.cast("int")).cast("int"), F.lit(0))
    branches = None
    for n, rows in COEFS.items():
        table = F.array(*[_lit_array(r) for r in rows])
        pick = F.when((idx > 0) & (idx <= len(rows)), F.element_at(table, idx)).otherwise(F.element_at(table, len(rows)))
        branches = F.when(n_radii == n, pick) if branches is None else branches.when(n_radii == n, pick)
    return branches


# ---------------------------------------------------------------------------------------
# CARQ reference record of every OFCL cycle
# ---------------------------------------------------------------------------------------

def storm_references(track: DataFrame) -> DataFrame:
    """Per storm with a CARQ cycle: ``refs``, a map from cycle start to its reference record, and ``first_ref``."""
    ref_struct = F.struct(
        F.col("radius_of_maximum_winds").alias("rmw0"), F.col("background_pressure").alias("bg0"),
        F.col("central_pressure").alias("pc0"), F.col("max_sustained_wind_speed").alias("vmax0"))
    carq = track.filter((F.col("advisory") == "CARQ") & F.col("track_start_time").isNotNull()).groupBy("storm_id", "track_start_time").agg(
        F.min_by(ref_struct, F.when(F.col("forecast_hours") == 0, row_key())).alias("ref"))
    return carq.groupBy("storm_id").agg(
        F.map_from_entries(F.collect_list(F.struct("track_start_time", "ref"))).alias("refs"),
        F.min_by("ref", "track_start_time").alias("first_ref"))


def _reference() -> Column:
    """The record of the cycle's own start, else of the storm's first CARQ cycle."""
    own = F.map_contains_key("refs", F.col("track_start_time"))
    return F.when(own, F.try_element_at("refs", F.col("track_start_time"))).otherwise(F.col("first_ref"))


def carq_reference(track: DataFrame) -> DataFrame:
    """One row per OFCL cycle with the reference record's rmw0, bg0, pc0, vmax0 (NULL if none)."""
    ofcl = track.filter((F.col("advisory") == "OFCL") & F.col("track_start_time").isNotNull()).select("storm_id", "track_start_time").distinct()
    # storms without CARQ are not repaired
    return ofcl.join(storm_references(track), "storm_id").select("storm_id", "track_start_time", _reference().alias("ref"))


# ---------------------------------------------------------------------------------------
# M8 / M9 on a set of records (windows run over the records given, in record order)
# ---------------------------------------------------------------------------------------

def _carried_r34(df: DataFrame, partition, scale: float) -> DataFrame:
    """R34 = 0.85 * mean radius * scale; rows above 35 kt take the last 34-kt value."""
    w = Window.partitionBy(*partition).orderBy(*ORDER_COLUMNS).rowsBetween(Window.unboundedPreceding, 0)
    own = F.lit(0.85) * mean_quadrant_radius() * F.lit(scale)
    df = df.withColumn("_r34_own", own)
    carried = F.last(F.when(F.col("isotach_radius") <= 35, F.col("_r34_own")), ignorenulls=True).over(w)
    return df.withColumn("_r34", F.when(F.col("isotach_radius") > 35, carried).otherwise(F.col("_r34_own"))).drop("_r34_own")


def chavas_pressure(df: DataFrame, partition=("storm_id", "advisory", "track_start_time"), out: str = "central_pressure") -> DataFrame:
    """M8: central pressure = bround(bg + 2 + dP) with the Chavas (2025) deficit."""
    df = _carried_r34(df, partition, NMI_TO_M)
    dp = P.chavas_delta_p(F.col("max_sustained_wind_speed"), F.col("speed"), F.col("latitude"), F.col("_r34"))
    return df.withColumn(out, F.bround(F.col("background_pressure") + 2 + dp, 0)).drop("_r34")


def courtney_knaff_pressure(df: DataFrame, partition=("storm_id", "advisory", "track_start_time"), out: str = "central_pressure") -> DataFrame:
    """M9: central pressure with the Courtney & Knaff (2009) deficit; R34 filled forward then backward."""
    df = _carried_r34(df, partition, 1.0)
    wf = Window.partitionBy(*partition).orderBy(*ORDER_COLUMNS).rowsBetween(Window.unboundedPreceding, 0)
    wb = Window.partitionBy(*partition).orderBy(*[F.desc(c) for c in ORDER_COLUMNS]).rowsBetween(Window.unboundedPreceding, 0)
    filled = F.coalesce(F.last("_r34", ignorenulls=True).over(wf), F.last("_r34", ignorenulls=True).over(wb))
    df = df.withColumn("_r34f", filled)
    dp = P.courtney_knaff_delta_p(F.col("max_sustained_wind_speed"), F.col("speed"), F.col("latitude"), F.col("_r34f"))
    return df.withColumn(out, F.bround(F.col("background_pressure") + 2 + dp, 0)).drop("_r34", "_r34f")


# ---------------------------------------------------------------------------------------
# M3 / M4: RMW regression as one walk over a cycle's lead hours
# ---------------------------------------------------------------------------------------

def cycle_hours(ofcl: DataFrame) -> DataFrame:
    """Per cycle: ``hours``, a struct per lead hour in the order in which the hours first lack an RMW
    (those that never do first), and ``origin``, the lead hour of the first record."""
    at = Window.partitionBy(*CYCLE, "forecast_hours").orderBy(*ORDER_COLUMNS)
    rows = ofcl.select(*CYCLE, *[c for c in ORDER_COLUMNS if c not in CYCLE], "forecast_hours", "max_sustained_wind_speed", "latitude", "radius_of_maximum_winds",
                       "isotach_radius", "_rmw_missing", mean_quadrant_radius().alias("_mean"), max_quadrant_radius().alias("_max"))
    rows = rows.withColumn("_pos", F.row_number().over(at))
    nth = lambda c, i: F.max(F.when(F.col("_pos") == i, F.col(c)))
    last = F.struct(F.col("_max").alias("maxr"), F.col("isotach_radius").alias("iso"), F.col("max_sustained_wind_speed").alias("vmax"), F.col("radius_of_maximum_winds").alias("rmw"))
    hours = rows.groupBy(*CYCLE, "forecast_hours").agg(
        F.min(F.when(F.col("_rmw_missing"), row_key())).alias("asks"),
        F.min(row_key()).alias("_first"),
        F.count(F.lit(1)).alias("n"),
        nth("max_sustained_wind_speed", 1).alias("vmax"),
        nth("latitude", 1).alias("lat"),
        nth("radius_of_maximum_winds", 1).alias("rmw"),
        F.array(*[nth("_mean", i) for i in (1, 2, 3)]).alias("means"),
        (F.count("_mean") > 0).alias("has"),
        F.max_by(last, row_key()).alias("last"),
    )
    entry = F.struct("asks", F.col("forecast_hours").alias("hour"), "n", "vmax", "lat", "rmw", "means", "has", "last")
    return hours.groupBy(*CYCLE).agg(F.sort_array(F.collect_list(entry)).alias("hours"), F.coalesce(F.min_by("forecast_hours", "_first"), F.lit(0)).alias("origin"))


def crowded_hours(track: DataFrame) -> DataFrame:
    """OFCL (cycle, hour) with more records than the regression has isotachs, and how many."""
    hours = track.filter((F.col("advisory") == "OFCL") & (F.col("forecast_hours") >= 12)).groupBy(*CYCLE, "forecast_hours")
    return hours.agg(F.count(F.lit(1)).alias("n_records")).filter("n_records > 3")


def _radii(carried: Column, x: Column, vmax: Column) -> Column:
    """The radii known at an hour: its own means without their bias, else what the wind allows of those carried."""
    own = F.transform(F.slice(x["means"], F.lit(1), x["n"].cast("int")), lambda m, i: m - F.get(F.array(*[_bias(t, x["hour"]) for t in (BIAS_R34, BIAS_R50, BIAS_R64)]), i))
    allowed = F.when(vmax > 50, 2).when(vmax > 34, 1).otherwise(0)
    none = F.array(F.lit(None).cast("double"))
    return F.when(x["has"], own).when(allowed == 0, none).otherwise(F.slice(carried, F.lit(1), allowed))


def _estimate(x: Column, vmax: Column, radii: Column, rmw0: Column) -> Column:
    """rmw0 ** a1 * prod(r_i ** a_(1+i)) * vmax ** a_(n+2) * exp(a0 + a_last * lat)."""
    def with_coefs(present):
        def value(a):
            n = F.size(present)
            product = F.aggregate(F.zip_with(present, F.slice(a, F.lit(3), n), F.pow), F.lit(1.0), lambda p, r: p * r)
            return F.pow(rmw0, F.get(a, F.lit(1))) * product * F.pow(vmax, F.get(a, n + 2)) * F.exp(F.get(a, F.lit(0)) + F.get(a, n + 3) * (x["lat"] - _bias(BIAS_LAT, x["hour"])))
        return let(_coefs(F.size(present), x["hour"]), value)
    return let(F.filter(radii, lambda r: r.isNotNull() & ~F.isnan(r)), with_coefs)


def regression_rmw(hours: Column, rmw0: Column) -> Column:
    """A map from lead hour to the regression RMW of the hours that lack one (M3, M4).

    The regression knows three isotachs.  An hour >= 12 with more records, or without a row in the bias
    table, has no estimate: its RMW stays missing and it carries nothing to later hours; ``crowded_hours`` lists the former.
    """
    upper = F.greatest(F.lit(120.0), rmw0)
    # an undefined estimate lands on the upper bound, as in the original
    bounded = lambda v: F.when(v.isNull() | F.isnan(v), upper).otherwise(clamp(v, 5.0, upper))
    entry = lambda x, v: F.struct(x["hour"].alias("hour"), v.alias("rmw"))
    asked = F.filter(hours, lambda x: x["asks"].isNotNull() & x["hour"].isNotNull())
    early = F.transform(F.filter(asked, lambda x: x["hour"] < 12), lambda x: entry(x, bounded(rmw0)))
    later = F.filter(asked, lambda x: (x["hour"] >= 12) & (x["n"] <= 3) & _bias(BIAS_VMAX, x["hour"]).isNotNull())

    def step(state, x):
        return let(x["vmax"] - _bias(BIAS_VMAX, x["hour"]), lambda vmax: let(_radii(state["radii"], x, vmax), lambda radii: F.struct(
            radii.alias("radii"), F.concat(state["done"], F.array(entry(x, bounded(_estimate(x, vmax, radii, rmw0))))).alias("done"))))

    start = F.struct(F.array(F.lit(None).cast("double")).alias("radii"), F.array().cast("array<struct<hour:int,rmw:double>>").alias("done"))
    walked = F.aggregate(later, start, step, lambda state: state["done"])
    return F.map_from_entries(F.concat(early, walked))


# ---------------------------------------------------------------------------------------
# M5: moving mean over lead hours (W10) and write-back bound
# ---------------------------------------------------------------------------------------

def hour_points(hours: Column, estimates: Column) -> Column:
    """(h, r) of each lead hour's first record after the regression, by hour."""
    known = F.filter(hours, lambda x: x["hour"].isNotNull())
    return F.sort_array(F.transform(known, lambda x: F.struct(x["hour"].alias("h"), F.coalesce(F.try_element_at(estimates, x["hour"]), x["rmw"]).alias("r"))))


def hour_grid(points: Column) -> Column:
    """(h, r) of the lead hours and 60/84/108, the latter interpolated linearly (constant beyond the ends)."""
    grid = F.array_sort(F.array_distinct(F.concat(F.transform(points, lambda p: p["h"]), F.array(*[F.lit(h) for h in SMOOTHING_EXTRA_HOURS]))))

    def between(p, n, g):
        share = (g - p["h"]) / (n["h"] - p["h"])
        return F.when(p.isNull(), n["r"]).when(n.isNull() | (p["h"] == g), p["r"]).otherwise(p["r"] + share * (n["r"] - p["r"]))

    def at(g):
        below, above = F.filter(points, lambda p: p["h"] <= g), F.filter(points, lambda p: p["h"] >= g)
        ends = F.struct(F.try_element_at(below, F.lit(-1)).alias("p"), F.get(above, F.lit(0)).alias("n"))
        return F.struct(g.alias("h"), let(ends, lambda e: between(e["p"], e["n"], g)).alias("r"))

    return F.transform(grid, at)


def smoothed_rmw(hours: Column, estimates: Column, grid: Column, origin: Column) -> Column:
    """A map from lead hour (not 0) to what W11 makes of its records: the 24 h mean where it is below the
    largest radius of the hour's last record or that is missing; above it, that radius scaled by isotach / wind.

    The grid counts from the cycle's first record, so a grid hour g is the lead hour ``origin + g``.
    """
    def entry(x):
        g = x["hour"] - origin
        near = F.transform(F.filter(grid, lambda v: (F.abs(v["h"] - g) <= 12) & v["r"].isNotNull()), lambda v: v["r"])
        mean = F.when(F.size(near) > 0, F.aggregate(near, F.lit(0.0), lambda a, r: a + r) / F.size(near))

        def bound(s):
            maxr, last = x["last"]["maxr"], F.coalesce(F.try_element_at(estimates, x["hour"]), x["last"]["rmw"])
            return let((s["mean"] < maxr) | maxr.isNull(), lambda use: F.struct(
                F.coalesce(use, F.lit(False)).alias("use"), s["mean"].alias("mean"),
                F.coalesce(F.when(use, s["mean"]).otherwise(last) > maxr, F.lit(False)).alias("over"),
                F.try_divide(maxr * x["last"]["iso"], x["last"]["vmax"]).alias("bounded")))

        return F.struct(x["hour"].alias("hour"), let(F.struct(mean.alias("mean")), bound).alias("fix"))

    written = F.filter(hours, lambda x: (x["hour"] != 0) & F.exists(grid, lambda v: v["h"] == x["hour"] - origin))
    return F.map_from_entries(F.transform(written, entry))


# ---------------------------------------------------------------------------------------
# Whole repair
# ---------------------------------------------------------------------------------------

RMW_FILLS = ("none", None, "persistent", "regression_penny_2023", "regression_penny_2023_with_smoothing", "regression_penny_2023_no_smoothing")


def _with_reference(ofcl: DataFrame, track: DataFrame, rmw_fill: str | None) -> DataFrame:
    """OFCL records with ``ref``, ``_repaired`` (the storm has CARQ) and, for the regressions, ``_estimate`` and ``_fix``."""
    regression = str(rmw_fill).startswith("regression")
    cycles = cycle_hours(ofcl) if regression else ofcl.select(*CYCLE).distinct()
    cycles = cycles.join(storm_references(track), "storm_id").withColumn("ref", _reference()).drop("refs", "first_ref")
    found = ["ref", F.lit(True).alias("_repaired")]
    if regression:
        cycles = cycles.withColumn("_estimates", regression_rmw(F.col("hours"), F.col("ref.rmw0")))
        found.append("_estimates")
    if regression and rmw_fill != "regression_penny_2023_no_smoothing":
        cycles = cycles.withColumn("_points", hour_points(F.col("hours"), F.col("_estimates"))).withColumn("_grid", hour_grid(F.col("_points")))
        cycles = cycles.withColumn("_fixes", smoothed_rmw(F.col("hours"), F.col("_estimates"), F.col("_grid"), F.col("origin")))
        found.append("_fixes")
    return ofcl.join(cycles.select(*CYCLE, *found), CYCLE, "left").withColumn("_repaired", F.coalesce("_repaired", F.lit(False)))


def correct_ofcl(track: DataFrame, rmw_fill: str = "regression_penny_2023",
                 pc_fill: str = "persistent_holland_b") -> DataFrame:
    """Repair OFCL cycles from the CARQ reference; other advisories pass through unchanged.

    ``rmw_fill``: none | persistent | regression_penny_2023 (with smoothing) |
    regression_penny_2023_no_smoothing.  ``pc_fill``: none | persistent_holland_b |
    regression_chavas_2025 | regression_courtney_knaff_2009.
    """
    if rmw_fill not in RMW_FILLS:
        raise ValueError(f"unknown rmw_fill {rmw_fill!r}")
    missing = lambda c: F.col(c).isNull() | (F.col(c) == 0)
    is_ofcl = F.col("advisory").eqNullSafe("OFCL")
    others = track.filter(~is_ofcl)
    ofcl = track.filter(is_ofcl).repartition(*CYCLE).withColumn("_rmw_missing", missing("radius_of_maximum_winds"))
    ofcl = _with_reference(ofcl, track, rmw_fill)
    ofcl = ofcl.withColumns({f"_{k}_missing": missing(c) & F.col("_repaired") for k, c in (("pc", "central_pressure"), ("bg", "background_pressure"))})

    rmw = F.col("radius_of_maximum_winds")
    if rmw_fill == "persistent":
        rmw = F.when(F.col("_rmw_missing") & F.col("_repaired"), F.col("ref.rmw0")).otherwise(rmw)
    if "_estimates" in ofcl.columns:
        rmw = F.coalesce(F.try_element_at("_estimates", F.col("forecast_hours")), rmw)
    if "_fixes" in ofcl.columns:
        ofcl = ofcl.withColumn("_fix", F.try_element_at("_fixes", F.col("forecast_hours")))
        rmw = F.when(F.col("_fix.over"), F.col("_fix.bounded")).when(F.col("_fix.use"), F.col("_fix.mean")).otherwise(rmw)
    ofcl = ofcl.withColumn("radius_of_maximum_winds", rmw)

    ofcl = ofcl.withColumn("background_pressure",
                           F.when(F.col("_bg_missing"), F.col("ref.bg0")).otherwise(F.col("background_pressure")))

    if pc_fill == "persistent_holland_b":
        b = P.holland_b(F.col("ref.vmax0"), F.col("ref.bg0"), F.col("ref.pc0"))
        ref_ok = F.col("ref.vmax0").isNotNull() & F.col("ref.bg0").isNotNull() & F.col("ref.pc0").isNotNull()
        pc = F.when(ref_ok, P.central_from_holland_b(F.col("max_sustained_wind_speed"), F.col("background_pressure"), b))
        ofcl = ofcl.withColumn("central_pressure", F.when(F.col("_pc_missing"), pc).otherwise(F.col("central_pressure")))
    elif pc_fill in ("regression_chavas_2025", "regression_courtney_knaff_2009"):
        fn = chavas_pressure if pc_fill == "regression_chavas_2025" else courtney_knaff_pressure
        miss = fn(ofcl.filter(F.col("_pc_missing")), partition=CYCLE)
        ofcl = ofcl.filter(~F.col("_pc_missing")).unionByName(miss)
    elif pc_fill not in ("none", None):
        raise ValueError(f"unknown pc_fill {pc_fill!r}")

    return others.unionByName(ofcl.select(*others.columns))
