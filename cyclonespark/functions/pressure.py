"""Wind-pressure relations as Column expressions (M1, M8, M9 formula parts).

All constants below are FIXED VALUES of the published relations.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# FIXED VALUES: Holland B relation
RHO = 1.15
E = math.e

# FIXED VALUES: Chavas et al. (2025) regression
OMEGA = 7.292e-5
BETA_00 = -6.60
BETA_V20 = -0.0127
BETA_FR = -5.506
BETA_FRDV = 109.013
BETA_01 = 20.23
BETA_V11 = -1.54

# FIXED VALUES: Courtney & Knaff (2009) regression
CK_X0, CK_XV, CK_XL = 0.1147, 0.0055, 0.001
CK_R0, CK_RV, CK_RL = 66.785, 0.09102, 1.0619
CK_HI = (23.286, 0.483, 24.524, 12.587, 0.483)
CK_LO = (5.962, 0.267, 18.26, 6.8)


def holland_b(vmax: Column, background: Column, central: Column) -> Column:
    """M1: B = v^2 rho e / (bg - pc)."""
    return F.try_divide(vmax * vmax * F.lit(RHO) * F.lit(E), background - central)


def central_from_holland_b(vmax: Column, background: Column, b: Column) -> Column:
    """M1 inversion: pc = -v^2 rho e / B + bg (a NULL B, i.e. bg0 == pc0, is infinite and gives bg).

    NULL winds or background, and a zero B, leave the pressure NULL.
    """
    deficit = -(vmax * vmax) * F.lit(RHO) * F.lit(E)
    return F.when(b.isNull(), F.when(vmax.isNotNull(), F.lit(0.0))).otherwise(F.try_divide(deficit, b)) + background


def vmax_from_holland_b(b: Column, background: Column, central: Column) -> Column:
    """M1 inversion: v = sqrt(B (bg - pc) / (rho e))."""
    return F.sqrt(b * (background - central) / (F.lit(RHO) * F.lit(E)))


def chavas_delta_p(vmax_kt: Column, speed_kt: Column, lat: Column, r34_m: Column) -> Column:
    """Pressure deficit of the Chavas (2025) relation; NULL R34 uses the intensity-only form."""
    v = F.lit(0.5144) * (vmax_kt - F.lit(0.55) * speed_kt)
    v = F.when(v < 20, F.lit(20.0)).otherwise(v)
    fo2 = F.lit(OMEGA) * F.sin(F.radians(lat))
    full = (F.lit(BETA_00) + F.lit(BETA_V20) * v * v + F.lit(BETA_FR) * fo2 * r34_m
            + F.lit(BETA_FRDV) * fo2 * r34_m / v)
    return F.coalesce(full, F.lit(BETA_01) + F.lit(BETA_V11) * v)


def courtney_knaff_delta_p(vmax_kt: Column, speed_kt: Column, lat: Column, r34_filled_nmi: Column) -> Column:
    """Pressure deficit of the Courtney & Knaff (2009) relation (R34 already filled both ways)."""
    vsrm = vmax_kt - F.lit(1.5) * F.pow(speed_kt, F.lit(0.63))
    vsrm = F.when(vsrm < 25, F.lit(25.0)).otherwise(vsrm)
    v500 = r34_filled_nmi / 9 - 3
    x = F.lit(CK_X0) + F.lit(CK_XV) * vmax_kt - F.lit(CK_XL) * (lat - 25)
    rmax = F.lit(CK_R0) - F.lit(CK_RV) * vmax_kt + F.lit(CK_RL) * (lat - 25)
    v500c = vmax_kt * F.pow(rmax / 500, x)
    s = F.try_divide(v500, v500c)
    s = F.when(s < 0.4, F.lit(0.4)).otherwise(s)
    a, b, c, d, e = CK_HI
    hi = F.lit(a) - F.lit(b) * vsrm - F.pow(vsrm / c, F.lit(2.0)) - F.lit(d) * s - F.lit(e) * lat
    a2, b2, c2, d2 = CK_LO
    lo = F.lit(a2) - F.lit(b2) * vsrm - F.pow(vsrm / c2, F.lit(2.0)) - F.lit(d2) * s
    return F.when(lat < 18, lo).otherwise(hi)
