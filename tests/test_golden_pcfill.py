"""Pressure fills (Chavas 2025, Courtney & Knaff 2009) against the original's golden decks."""

import glob
import os

import pytest

from cyclonespark.operators.ordering import order_track
from cyclonespark.operators.repair import chavas_pressure, courtney_knaff_pressure
from cyclonespark.operators.velocity import compute_velocity
from cyclonespark.sinks.atcf import format_atcf
from cyclonespark.sources.decks import parse_deck_lines, read_deck_lines, with_storm_code
from tests.conftest import REFERENCE_DATA

INPUTS = sorted(glob.glob(os.path.join(REFERENCE_DATA, "input/test_pcfill/*.dat")))


def _golden(name, method):
    path = os.path.join(REFERENCE_DATA, "reference/test_pcfill", f"{name}_{method}.dat")
    if not os.path.exists(path):
        return None
    with open(path) as fh:
        return [line.rstrip("\n") for line in fh if line.strip()]


@pytest.mark.skipif(not INPUTS, reason="golden data not available")
def test_pressure_fill_goldens(spark):
    decks = with_storm_code(parse_deck_lines(read_deck_lines(spark, INPUTS)))
    # decks read from files keep each BEST row's own start and the file's motion
    loaded = compute_velocity(order_track(decks, best_start="row"), mode="missing")
    chavas = compute_velocity(chavas_pressure(loaded, partition=("path",)), mode="compute").cache()
    ck = compute_velocity(courtney_knaff_pressure(chavas, partition=("path",)), mode="compute")
    results = {
        "chavas": format_atcf(chavas, extended=True, ffill_partition=("path",)),
        "courtney": format_atcf(ck, extended=True, ffill_partition=("path",)),
    }
    checked = 0
    for method, df in results.items():
        rows = df.select("path", "line_no", "line").collect()
        by_file = {}
        for r in rows:
            by_file.setdefault(os.path.basename(r["path"])[:-4], []).append((r["line_no"], r["line"]))
        for name, lines in by_file.items():
            want = _golden(name, method)
            if want is None:
                continue
            got = [line for _, line in sorted(lines)]
            assert len(got) == len(want), name
            bad = [(g, w) for g, w in zip(got, want) if g != w]
            assert not bad, f"{name} {method}: {len(bad)} of {len(want)} differ; first {bad[0]}"
            checked += len(want)
    assert checked == 2 * 1819
