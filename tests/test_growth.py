"""Steps whose rows, sorts or shuffles must not outgrow their input, and their results against plain rules."""

import math
import random

from pyspark.sql import functions as F

from cyclonespark.operators import geometry as G
from cyclonespark.operators.correlate import flood_storms
from cyclonespark.operators.ordering import order_track
from cyclonespark.operators.velocity import compute_velocity
from cyclonespark.plans import surrogates as S
from cyclonespark.sources import catalogs as C
from tests.conftest import SF


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_vertices_are_no_rows(spark):
    swaths = _plan(G.wind_swaths(G.isotachs(compute_velocity(order_track(S.deck(spark, SF))), 34)))
    assert "collect_list" not in swaths
    assert "explode(sequence" not in swaths


def test_search_meets_each_shape_once_and_any_ring(spark):
    rng = random.Random(5)
    shapes = []
    for i in range(60):
        x, y, r = rng.uniform(-20, 20), rng.uniform(-20, 20), 2.0 ** rng.uniform(-6, 6)
        ring = [(x + r * rng.uniform(0.2, 1) * math.cos(t / 2), y + r * rng.uniform(0.2, 1) * math.sin(t / 2)) for t in range(rng.choice((4, 12, 25)))]
        shapes.append((i, ring))
    shapes.append((60, [(-4.0, -4.0), (4.0, -4.0), (4.0, 4.0), (-4.0, 4.0)]))
    shapes.append((61, [(-900.0, -900.0), (900.0, -900.0), (900.0, 900.0), (-900.0, 900.0)]))
    table = spark.createDataFrame(shapes, "id int, ring array<struct<lon: double, lat: double>>")
    cells = G.shape_cells(table)
    assert cells.count() == len(shapes)
    points = [(i, rng.uniform(-25, 25), rng.uniform(-25, 25)) for i in range(2500)] + [(9000 + i, float(i % 9 - 4), float(i // 9 - 4)) for i in range(81)]
    pts = spark.createDataFrame([*points, points[0]], "n int, x double, y double")
    got = sorted((r.n, r.id) for r in G.points_in_shapes(pts, table, ["id"]).collect())
    want = sorted((r.n, r.id) for r in pts.crossJoin(table).filter(G.point_in_ring(F.col("x"), F.col("y"), F.col("ring"))).collect())
    assert got == want and len({i for _, i in got}) > 20


def test_names_are_cut_once_a_year(spark):
    cat = spark.createDataFrame([(f"AL{i:02d}2005", "RITA" if i % 2 else "ANN RITA", 2005, " AL", i, i) for i in range(1, 30)],
                                "nhc_code string, name string, year int, basin string, number int, line_no long")
    from cyclonespark.schema import FLOOD_EVENT_COLUMNS

    ev = spark.createDataFrame([(i, "2005 Hurricane Rita", 2005, "HURRICANE") for i in (1, 2, 2)], "usgs_id long, name string, year int, event_type string")
    for c in FLOOD_EVENT_COLUMNS:
        if c not in ev.columns:
            ev = ev.withColumn(c, F.lit(None).cast("string"))
    out = flood_storms(ev, cat)
    assert sorted((r.usgs_id, r.nhc_code, r.nhc_name) for r in out.collect()) == [(1, "AL292005", "RITA"), (2, "AL292005", "RITA"), (2, "AL292005", "RITA")]
    lines = _plan(out).splitlines()
    depth = lambda s: len(s) - len(s.lstrip(" :+-"))
    cuts = [i for i, line in enumerate(lines) if "Generate explode(" in line]
    assert cuts
    for i in cuts:  # each cut lies over an aggregation
        below = []
        for line in lines[i + 1:]:
            if depth(line) <= depth(lines[i]):
                break
            below.append(line)
        assert any("Aggregate" in line for line in below)


def test_lookups_meet_few_storms(spark):
    rows = [(f"{b}{n:02d}2005", "RITA", 2005, f" {b}", n, n) for b in ("AL", "EP") for n in range(1, 40)]
    cat = spark.createDataFrame([*rows, *rows, ("XX012005", None, 2005, " XX", 1, None)], "nhc_code string, name string, year int, basin string, number int, line_no long")
    asked = spark.createDataFrame([(1, 2005, None, None, "rita"), (2, 2005, "ep", None, "ri.*"), (3, 2005, "ep", 7, "rita"), (4, 2005, None, 1, None),
                                   (5, 2005, "xx", None, None), (6, 2005, "xx", None, "rita"), (7, 2004, None, None, "rita")],
                                  "req_id int, year int, basin string, number int, name string")
    out = C.lookup_storms(cat, asked)
    assert {r.req_id: r.nhc_code for r in out.collect()} == {1: "AL012005", 2: "EP012005", 3: "EP072005", 4: "AL012005", 5: "XX012005"}
    # storms meet in a hash aggregation of a long before any is picked
    assert "storms-" in out._jdf.queryExecution().executedPlan().toString()
