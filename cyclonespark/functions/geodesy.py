"""WGS84 geodesics as Spark Column expressions (no Python worker).

The inverse problem (distance and azimuths between two points) and the direct
problem (point at an azimuth and distance) use Vincenty's formulae.  The fixed
number of iterations is unrolled into chained projections (one materialised
column per iteration), so everything runs in whole-stage generated code.  The
longitude iteration contracts by about the flattening (1/298) per step, so 6
iterations reach double precision for every pair that is not nearly antipodal
(storm legs are short).

Coincident points give distance 0 and both azimuths 0.

Inputs are expected to be data columns: when every coordinate is a literal the
optimizer constant-folds the chained iterations into one ever-growing expression.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# FIXED VALUES: WGS84 ellipsoid
WGS84_A = 6378137.0
WGS84_F = 1 / 298.257223563
WGS84_B = (1 - WGS84_F) * WGS84_A

ITERATIONS = 6


def _c(value) -> Column:
    return value if isinstance(value, Column) else F.col(value)


def _reduced_latitude(lat_deg: Column) -> Column:
    return F.atan(F.lit(1 - WGS84_F) * F.tan(F.radians(lat_deg)))


def _inverse_terms(c, lam: Column) -> dict[str, Column]:
    """Sigma terms of one Vincenty step at longitude difference ``lam`` (inlined expressions)."""
    sl, cl = F.sin(lam), F.cos(lam)
    t1 = c("cu2") * sl
    t2 = c("cu1") * c("su2") - c("su1") * c("cu2") * cl
    cs = c("su1") * c("su2") + c("cu1") * c("cu2") * cl
    ss = F.sqrt(t1 * t1 + t2 * t2)
    sig = F.atan2(ss, cs)
    sa = F.when(ss == 0, F.lit(0.0)).otherwise(c("cu1") * c("cu2") * sl / ss)
    ca2 = F.lit(1.0) - sa * sa
    c2sm = F.when(ca2 == 0, F.lit(0.0)).otherwise(cs - F.lit(2.0) * c("su1") * c("su2") / ca2)
    return {"sl": sl, "cl": cl, "cs": cs, "ss": ss, "sig": sig, "sa": sa, "ca2": ca2, "c2sm": c2sm}


def with_inverse(df: DataFrame, lon1, lat1, lon2, lat2, out: str = "_inv",
                 iterations: int = ITERATIONS) -> DataFrame:
    """Add struct column ``out`` = <distance (m), azimuth, back_azimuth> from point 1 to point 2.

    ``azimuth`` is the forward azimuth at point 1 (degrees, (-180, 180]);
    ``back_azimuth`` is the azimuth at point 2 pointing back to point 1.
    One projection per iteration materialises lambda; the terms inside an iteration
    are inlined and shared through codegen's common-subexpression elimination.
    """
    p = f"__{out}_"
    lon1, lat1, lon2, lat2 = (_c(x) for x in (lon1, lat1, lon2, lat2))
    c = lambda n: F.col(p + n)
    u1, u2 = _reduced_latitude(lat1), _reduced_latitude(lat2)
    df = df.select("*", F.sin(u1).alias(p + "su1"), F.cos(u1).alias(p + "cu1"), F.sin(u2).alias(p + "su2"),
                   F.cos(u2).alias(p + "cu2"), F.radians(lon2 - lon1).alias(p + "big_l"))
    df = df.withColumn(p + "lam", c("big_l"))
    f = F.lit(WGS84_F)
    for _ in range(iterations):
        t = _inverse_terms(c, c("lam"))
        cc = f / 16 * t["ca2"] * (F.lit(4.0) + f * (F.lit(4.0) - F.lit(3.0) * t["ca2"]))
        lam = c("big_l") + (F.lit(1.0) - cc) * f * t["sa"] * (
            t["sig"] + cc * t["ss"] * (t["c2sm"] + cc * t["cs"] * (F.lit(-1.0) + F.lit(2.0) * t["c2sm"] * t["c2sm"])))
        df = df.withColumn(p + "lam", lam)
    t = _inverse_terms(c, c("lam"))
    df = df.select("*", *[v.alias(p + k) for k, v in t.items()])
    usq = c("ca2") * F.lit((WGS84_A ** 2 - WGS84_B ** 2) / WGS84_B ** 2)
    ba = F.lit(1.0) + usq / 16384 * (F.lit(4096.0) + usq * (F.lit(-768.0) + usq * (F.lit(320.0) - F.lit(175.0) * usq)))
    bb = usq / 1024 * (F.lit(256.0) + usq * (F.lit(-128.0) + usq * (F.lit(74.0) - F.lit(47.0) * usq)))
    dsig = bb * c("ss") * (c("c2sm") + bb / 4 * (
        c("cs") * (F.lit(-1.0) + F.lit(2.0) * c("c2sm") * c("c2sm"))
        - bb / 6 * c("c2sm") * (F.lit(-3.0) + F.lit(4.0) * c("ss") * c("ss")) * (F.lit(-3.0) + F.lit(4.0) * c("c2sm") * c("c2sm"))))
    az1 = F.degrees(F.atan2(c("cu2") * c("sl"), c("cu1") * c("su2") - c("su1") * c("cu2") * c("cl")))
    az2f = F.degrees(F.atan2(c("cu1") * c("sl"), F.lit(-1.0) * c("su1") * c("cu2") + c("cu1") * c("su2") * c("cl")))
    same = c("ss") == 0
    result = F.struct(
        F.when(same, F.lit(0.0)).otherwise(F.lit(WGS84_B) * ba * (c("sig") - dsig)).alias("distance"),
        F.when(same, F.lit(0.0)).otherwise(az1).alias("azimuth"),
        F.when(same, F.lit(0.0)).when(az2f > 0, az2f - 180.0).otherwise(az2f + 180.0).alias("back_azimuth"),
    )
    keep = [x for x in df.columns if not x.startswith(p)]
    return df.select(*keep, result.alias(out))


def with_direct(df: DataFrame, lon, lat, azimuth_deg, distance_m, out: str = "_dir",
                iterations: int = ITERATIONS) -> DataFrame:
    """Add struct column ``out`` = <lon, lat> reached from (lon, lat) along an azimuth after a distance."""
    p = f"__{out}_"
    lon, lat, az, s = (_c(x) for x in (lon, lat, azimuth_deg, distance_m))
    c = lambda n: F.col(p + n)
    f = F.lit(WGS84_F)
    a1 = F.radians(az)
    tu1 = F.lit(1 - WGS84_F) * F.tan(F.radians(lat))
    cu1 = F.lit(1.0) / F.sqrt(F.lit(1.0) + tu1 * tu1)
    sa = cu1 * F.sin(a1)
    ca2 = F.lit(1.0) - sa * sa
    usq = ca2 * F.lit((WGS84_A ** 2 - WGS84_B ** 2) / WGS84_B ** 2)
    ba = F.lit(1.0) + usq / 16384 * (F.lit(4096.0) + usq * (F.lit(-768.0) + usq * (F.lit(320.0) - F.lit(175.0) * usq)))
    bb = usq / 1024 * (F.lit(256.0) + usq * (F.lit(-128.0) + usq * (F.lit(74.0) - F.lit(47.0) * usq)))
    df = df.select("*", (tu1 * cu1).alias(p + "su1"), cu1.alias(p + "cu1"), F.atan2(tu1, F.cos(a1)).alias(p + "sig1"),
                   sa.alias(p + "sa"), F.sin(a1).alias(p + "sa1"), F.cos(a1).alias(p + "ca1"), ca2.alias(p + "ca2"),
                   bb.alias(p + "bb"), (s / (F.lit(WGS84_B) * ba)).alias(p + "sig0"), F.radians(lon).alias(p + "lon0"))
    df = df.withColumn(p + "sig", c("sig0"))
    for _ in range(iterations):
        c2sm = F.cos(F.lit(2.0) * c("sig1") + c("sig"))
        ss, cs = F.sin(c("sig")), F.cos(c("sig"))
        dsig = c("bb") * ss * (c2sm + c("bb") / 4 * (
            cs * (F.lit(-1.0) + F.lit(2.0) * c2sm * c2sm)
            - c("bb") / 6 * c2sm * (F.lit(-3.0) + F.lit(4.0) * ss * ss) * (F.lit(-3.0) + F.lit(4.0) * c2sm * c2sm)))
        df = df.withColumn(p + "sig", c("sig0") + dsig)
    c2sm = F.cos(F.lit(2.0) * c("sig1") + c("sig"))
    ss, cs = F.sin(c("sig")), F.cos(c("sig"))
    tmp = c("su1") * ss - c("cu1") * cs * c("ca1")
    lat2 = F.atan2(c("su1") * cs + c("cu1") * ss * c("ca1"), F.lit(1 - WGS84_F) * F.sqrt(c("sa") * c("sa") + tmp * tmp))
    lamd = F.atan2(ss * c("sa1"), c("cu1") * cs - c("su1") * ss * c("ca1"))
    cc = f / 16 * c("ca2") * (F.lit(4.0) + f * (F.lit(4.0) - F.lit(3.0) * c("ca2")))
    big_l = lamd - (F.lit(1.0) - cc) * f * c("sa") * (
        c("sig") + cc * ss * (c2sm + cc * cs * (F.lit(-1.0) + F.lit(2.0) * c2sm * c2sm)))
    lon2 = F.pmod(F.degrees(c("lon0") + big_l) + F.lit(540.0), F.lit(360.0)) - F.lit(180.0)
    keep = [x for x in df.columns if not x.startswith(p)]
    return df.select(*keep, F.struct(lon2.alias("lon"), F.degrees(lat2).alias("lat")).alias(out))


def direct_points(lon: np.ndarray, lat: np.ndarray, azimuth_deg: np.ndarray, distance_m: np.ndarray,
                  iterations: int = ITERATIONS) -> tuple[np.ndarray, np.ndarray]:
    """``with_direct`` over numpy arrays (lon, lat of the points reached), for tasks that make many points of one row."""
    f, a1 = WGS84_F, np.radians(azimuth_deg)
    tu1 = (1 - f) * np.tan(np.radians(lat))
    cu1 = 1.0 / np.sqrt(1.0 + tu1 * tu1)
    su1, sa1, ca1 = tu1 * cu1, np.sin(a1), np.cos(a1)
    sig1, sa = np.arctan2(tu1, ca1), cu1 * sa1
    ca2 = 1.0 - sa * sa
    usq = ca2 * ((WGS84_A ** 2 - WGS84_B ** 2) / WGS84_B ** 2)
    ba = 1.0 + usq / 16384 * (4096.0 + usq * (-768.0 + usq * (320.0 - 175.0 * usq)))
    bb = usq / 1024 * (256.0 + usq * (-128.0 + usq * (74.0 - 47.0 * usq)))
    sig0 = distance_m / (WGS84_B * ba)
    sig = sig0
    for _ in range(iterations):
        c2sm, ss, cs = np.cos(2.0 * sig1 + sig), np.sin(sig), np.cos(sig)
        sig = sig0 + bb * ss * (c2sm + bb / 4 * (cs * (-1.0 + 2.0 * c2sm * c2sm)
                                - bb / 6 * c2sm * (-3.0 + 4.0 * ss * ss) * (-3.0 + 4.0 * c2sm * c2sm)))
    c2sm, ss, cs = np.cos(2.0 * sig1 + sig), np.sin(sig), np.cos(sig)
    tmp = su1 * ss - cu1 * cs * ca1
    lat2 = np.arctan2(su1 * cs + cu1 * ss * ca1, (1 - f) * np.sqrt(sa * sa + tmp * tmp))
    lamd = np.arctan2(ss * sa1, cu1 * cs - su1 * ss * ca1)
    cc = f / 16 * ca2 * (4.0 + f * (4.0 - 3.0 * ca2))
    big_l = lamd - (1.0 - cc) * f * sa * (sig + cc * ss * (c2sm + cc * cs * (-1.0 + 2.0 * c2sm * c2sm)))
    return np.mod(np.degrees(np.radians(lon) + big_l) + 540.0, 360.0) - 180.0, np.degrees(lat2)


def direct_sql(source: str, keep: str, iterations: int = ITERATIONS, prefix: str = "gd") -> tuple[str, str]:
    """DuckDB text of the direct problem: (CTEs, final relation) with ``keep``, lon, lat from a relation with lon1, lat1, az (degrees), dist (m)."""
    fl, usq = repr(WGS84_F), repr((WGS84_A ** 2 - WGS84_B ** 2) / WGS84_B ** 2)
    steps = [f"""{prefix}0 AS (SELECT {keep}, lon1, sin(radians(az)) AS sa1, cos(radians(az)) AS ca1, dist, atan((1 - {fl}) * tan(radians(lat1))) AS u1 FROM {source}),
{prefix}a AS (SELECT *, sin(u1) AS su1, cos(u1) AS cu1, atan2(tan(u1), ca1) AS sig1, cos(u1) * sa1 AS sa FROM {prefix}0),
{prefix}b AS (SELECT *, 1 - sa * sa AS ca2, (1 - sa * sa) * {usq} AS usq FROM {prefix}a),
{prefix}c AS (SELECT *, dist / ({WGS84_B!r} * (1 + usq / 16384 * (4096 + usq * (-768 + usq * (320 - 175 * usq))))) AS sig0,
  usq / 1024 * (256 + usq * (-128 + usq * (74 - 47 * usq))) AS bb FROM {prefix}b),
{prefix}s0 AS (SELECT *, sig0 AS sig FROM {prefix}c)"""]
    for i in range(1, iterations + 1):
        steps.append(f"""{prefix}s{i} AS (SELECT * EXCLUDE (sig, m), sig0 + bb * sin(sig) * (m + bb / 4 * (cos(sig) * (-1 + 2 * m * m)
  - bb / 6 * m * (-3 + 4 * sin(sig) * sin(sig)) * (-3 + 4 * m * m))) AS sig FROM (SELECT *, cos(2 * sig1 + sig) AS m FROM {prefix}s{i - 1}))""")
    steps.append(f"""{prefix}e AS (SELECT *, cos(2 * sig1 + sig) AS m, su1 * sin(sig) - cu1 * cos(sig) * ca1 AS tmp, {fl} / 16 * ca2 * (4 + {fl} * (4 - 3 * ca2)) AS cc FROM {prefix}s{iterations}),
{prefix}out AS (SELECT {keep}, degrees(atan2(su1 * cos(sig) + cu1 * sin(sig) * ca1, (1 - {fl}) * sqrt(sa * sa + tmp * tmp))) AS lat,
  ((lon1 + degrees(atan2(sin(sig) * sa1, cu1 * cos(sig) - su1 * sin(sig) * ca1)
    - (1 - cc) * {fl} * sa * (sig + cc * sin(sig) * (m + cc * cos(sig) * (-1 + 2 * m * m)))) + 540) % 360) - 180 AS lon FROM {prefix}e)""")
    return ",\n".join(steps), f"{prefix}out"


# ---------------------------------------------------------------------------------------
# DuckDB text of the same inverse solution (used by the SQL oracles): an unrolled chain of
# CTEs, one per iteration, over a relation exposing lon1, lat1, lon2, lat2.
# ---------------------------------------------------------------------------------------

def inverse_sql(source: str, keep: str, iterations: int = ITERATIONS, prefix: str = "gi") -> tuple[str, str]:
    """Return (cte_text, final_relation) computing distance/azimuth/back_azimuth columns.

    ``source`` is a relation with columns lon1, lat1, lon2, lat2 and the ``keep`` columns.
    """
    fl = repr(WGS84_F)
    ctes = [
        f"""{prefix}0 AS (SELECT {keep}, lon1, lat1, lon2, lat2,
            sin(atan((1 - {fl}) * tan(radians(lat1)))) AS su1, cos(atan((1 - {fl}) * tan(radians(lat1)))) AS cu1,
            sin(atan((1 - {fl}) * tan(radians(lat2)))) AS su2, cos(atan((1 - {fl}) * tan(radians(lat2)))) AS cu2,
            radians(lon2 - lon1) AS big_l, radians(lon2 - lon1) AS lam FROM {source})"""
    ]
    for i in range(1, iterations + 1):
        prev = f"{prefix}{i - 1}"
        ctes.append(
            f"""{prefix}{i}s AS (SELECT *, sqrt((cu2 * sin(lam)) * (cu2 * sin(lam)) + (cu1 * su2 - su1 * cu2 * cos(lam)) * (cu1 * su2 - su1 * cu2 * cos(lam))) AS ss,
                su1 * su2 + cu1 * cu2 * cos(lam) AS cs FROM {prev}),
            {prefix}{i}t AS (SELECT *, atan2(ss, cs) AS sig, CASE WHEN ss = 0 THEN 0.0 ELSE cu1 * cu2 * sin(lam) / ss END AS sa FROM {prefix}{i}s),
            {prefix}{i}u AS (SELECT *, 1.0 - sa * sa AS ca2 FROM {prefix}{i}t),
            {prefix}{i}v AS (SELECT *, CASE WHEN ca2 = 0 THEN 0.0 ELSE cs - 2.0 * su1 * su2 / ca2 END AS c2sm,
                {fl} / 16 * ca2 * (4.0 + {fl} * (4.0 - 3.0 * ca2)) AS cc FROM {prefix}{i}u),
            {prefix}{i} AS (SELECT {keep}, lon1, lat1, lon2, lat2, su1, cu1, su2, cu2, big_l,
                big_l + (1.0 - cc) * {fl} * sa * (sig + cc * ss * (c2sm + cc * cs * (-1.0 + 2.0 * c2sm * c2sm))) AS lam
                FROM {prefix}{i}v)"""
        )
    last = f"{prefix}{iterations}"
    usq = repr((WGS84_A ** 2 - WGS84_B ** 2) / WGS84_B ** 2)
    ctes.append(
        f"""{prefix}fs AS (SELECT *, sqrt((cu2 * sin(lam)) * (cu2 * sin(lam)) + (cu1 * su2 - su1 * cu2 * cos(lam)) * (cu1 * su2 - su1 * cu2 * cos(lam))) AS ss,
            su1 * su2 + cu1 * cu2 * cos(lam) AS cs FROM {last}),
        {prefix}ft AS (SELECT *, atan2(ss, cs) AS sig, CASE WHEN ss = 0 THEN 0.0 ELSE cu1 * cu2 * sin(lam) / ss END AS sa FROM {prefix}fs),
        {prefix}fu AS (SELECT *, 1.0 - sa * sa AS ca2 FROM {prefix}ft),
        {prefix}fv AS (SELECT *, CASE WHEN ca2 = 0 THEN 0.0 ELSE cs - 2.0 * su1 * su2 / ca2 END AS c2sm, ca2 * {usq} AS usq FROM {prefix}fu),
        {prefix}fw AS (SELECT *, 1.0 + usq / 16384 * (4096.0 + usq * (-768.0 + usq * (320.0 - 175.0 * usq))) AS big_a,
            usq / 1024 * (256.0 + usq * (-128.0 + usq * (74.0 - 47.0 * usq))) AS big_b FROM {prefix}fv),
        {prefix}fx AS (SELECT *, big_b * ss * (c2sm + big_b / 4 * (cs * (-1.0 + 2.0 * c2sm * c2sm)
            - big_b / 6 * c2sm * (-3.0 + 4.0 * ss * ss) * (-3.0 + 4.0 * c2sm * c2sm))) AS dsig,
            degrees(atan2(cu2 * sin(lam), cu1 * su2 - su1 * cu2 * cos(lam))) AS az1,
            degrees(atan2(cu1 * sin(lam), -1.0 * su1 * cu2 + cu1 * su2 * cos(lam))) AS az2f FROM {prefix}fw),
        {prefix}out AS (SELECT {keep}, lon1, lat1, lon2, lat2,
            CASE WHEN ss = 0 THEN 0.0 ELSE {WGS84_B!r} * big_a * (sig - dsig) END AS distance,
            CASE WHEN ss = 0 THEN 0.0 ELSE az1 END AS azimuth,
            CASE WHEN ss = 0 THEN 0.0 WHEN az2f > 0 THEN az2f - 180.0 ELSE az2f + 180.0 END AS back_azimuth
            FROM {prefix}fx)"""
    )
    return ",\n".join(ctes), f"{prefix}out"

