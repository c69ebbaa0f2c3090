"""Intervals, filters, sinks and sources on small fixtures."""

import datetime as dt
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from cyclonespark.functions.timeutil import clamp, relative_to_interval, subset_interval
from cyclonespark.operators.filters import default_deck, isotach, requested_advisories, storm_status, valid_advisories
from cyclonespark.schema import HWM_COLUMNS
from cyclonespark.sinks.atcf import format_fort22, write_track_text
from cyclonespark.sources import catalogs as C
from cyclonespark.sources import surveys as U
from cyclonespark.sources.decks import deck_catalog, deck_path, parse_deck_lines, rad_field_check

T0 = dt.datetime(2018, 9, 1)
T1 = dt.datetime(2018, 9, 11)


def _one(spark, col):
    return spark.range(1).select(col.alias("v")).first()["v"]


def test_relative_times(spark):
    s, e = F.lit(T0).cast("timestamp_ntz"), F.lit(T1).cast("timestamp_ntz")
    assert _one(spark, relative_to_interval(s, e, 86400)) == T0 + dt.timedelta(days=1)
    assert _one(spark, relative_to_interval(s, e, dt.timedelta(days=-2))) == T1 - dt.timedelta(days=2)
    assert _one(spark, relative_to_interval(s, e, dt.datetime(2018, 9, 5))) == dt.datetime(2018, 9, 5)
    assert _one(spark, relative_to_interval(s, e, dt.timedelta(days=20))) is None
    with pytest.raises(Exception):
        _one(spark, relative_to_interval(s, e, dt.timedelta(days=20), strict=True))


def test_subset_interval_falls_back_to_bounds(spark):
    s, e = F.lit(T0).cast("timestamp_ntz"), F.lit(T1).cast("timestamp_ntz")
    r = _one(spark, subset_interval(s, e, dt.timedelta(days=1), dt.timedelta(days=30)))
    assert (r["start"], r["end"]) == (T0 + dt.timedelta(days=1), T1)
    assert _one(spark, subset_interval(s, e, dt.timedelta(days=8), dt.timedelta(days=-5))) is None
    assert _one(spark, clamp(F.lit(150.0), 5.0, 120.0)) == 120.0


def test_advisory_rules():
    assert default_deck(["BEST"]) == "b" and default_deck(["OFCL"]) == "a"
    assert "BEST" not in valid_advisories("a") and valid_advisories("b") == ["BEST"]
    assert requested_advisories("a", ["ofcl"]) == (["OFCL"], ["CARQ"])
    assert requested_advisories("b", ["OFCL"]) == (["BEST"], [])


def test_isotach_validation(spark):
    with pytest.raises(ValueError):
        isotach(spark.range(1), 40)


def test_storm_status(spark):
    now = F.lit(dt.datetime(2020, 1, 31)).cast("timestamp_ntz")
    st = lambda s, e: _one(spark, storm_status(F.lit(s).cast("timestamp_ntz"), F.lit(e).cast("timestamp_ntz"), now))
    assert st(dt.datetime(2020, 1, 20), None) == "REALTIME"
    assert st(dt.datetime(2019, 11, 1), None) == "HISTORICAL"
    assert st(dt.datetime(2020, 1, 20), dt.datetime(2020, 1, 25)) == "HISTORICAL"


LINES = [
    "AL, 06, 2018083006,   , BEST,   0, 128N,  169W,  20, 1008, LO,   0,    ,    0,    0,    0,    0, 1010,  150,  50,   0,   0,   L,   0,    , 270,  10,     INVEST,",
    "AL, 06, 2018083012, 30, BEST,   0, 128S,  179E,  25, 1007, LO,    ,    ,    0,    0,    0,    0, 1010,  150,  50,   0,   0,   L,   0,    , 270,  10,        SIX,",
]


def test_parse_fields_and_rad_check(spark):
    df = spark.createDataFrame([("f", i, line) for i, line in enumerate(LINES)], "path string, line_no long, line string")
    rows = parse_deck_lines(df).orderBy("line_no").collect()
    assert rows[0].latitude == 12.8 and rows[0].longitude == -16.9
    assert rows[1].latitude == -12.8 and rows[1].longitude == 17.9
    assert rows[1].record_time == dt.datetime(2018, 8, 30, 12, 30)
    assert rows[1].isotach_radius is None
    assert rad_field_check(df).count() == 0  # a blank RAD field is there


def test_sink_skips_and_overwrites(spark):
    from cyclonespark.operators.ordering import order_track
    from cyclonespark.sources.decks import with_storm_code

    df = spark.createDataFrame([("f", i, line) for i, line in enumerate(LINES)], "path string, line_no long, line string")
    track = order_track(with_storm_code(parse_deck_lines(df)))
    lines = format_fort22(track, advisory="BEST")
    out = os.path.join(tempfile.mkdtemp(prefix="cyclonespark-sink-"), "tracks")
    write_track_text(lines, out, suffix=".22")
    first = sorted(r.value for r in spark.read.text(out).collect())
    assert len(first) == 2 and first[0].endswith("   1")
    write_track_text(lines.withColumn("line", F.lit("x")), out, overwrite=False, suffix=".22")
    assert sorted(r.value for r in spark.read.text(out).collect()) == first
    write_track_text(lines.withColumn("line", F.lit("x")), out, overwrite=True, suffix=".22")
    assert {r.value for r in spark.read.text(out).collect()} == {"x"}
    with pytest.raises(NotImplementedError):
        write_track_text(lines, out, suffix=".csv")


def test_sink_knows_ids_that_look_like_numbers(spark):
    lines = spark.createDataFrame([(i, dt.datetime(2020, 1, 1), "BEST", 1, i) for i in ("007", "7", "AL06")], "storm_id string, record_time timestamp_ntz, advisory string, line_no long, line string")
    out = os.path.join(tempfile.mkdtemp(prefix="cyclonespark-sink-"), "tracks")
    for _ in range(2):
        write_track_text(lines, out)
    assert sorted(r.value for r in spark.read.text(out).collect()) == ["007", "7", "AL06"]


def test_recomputed_motion_equals_a_whole_recomputation_where_it_can_differ(spark):
    from cyclonespark.operators.ordering import order_track
    from cyclonespark.operators.velocity import changed_positions, compute_velocity, recompute_changed
    from cyclonespark.plans import surrogates as S

    track = order_track(S.deck(spark, "/root/testdata/sf0.001"))
    assert recompute_changed(track, track.select("storm_id", "line_no").limit(0)).filter("speed IS NULL").count() == 0
    moved = track.withColumn("latitude", F.when(F.col("line_no") % 50 == 1, F.col("latitude") + 0.2).otherwise(F.col("latitude")))
    changed = changed_positions(track, moved, key=("storm_id", "line_no"))
    key = lambda df: {(r.storm_id, r.line_no): (r.speed, r.direction) for r in df.collect()}
    got, whole, own = key(recompute_changed(moved, changed)), key(compute_velocity(moved)), key(track)
    edited = {(r.storm_id, r.line_no) for r in changed.collect()}
    assert len(got) == len(own) and len(edited) > 10
    new = {k for k in got if got[k] != own[k]}
    assert all(got[k] == whole[k] for k in new | edited) and all(got[k] == own[k] for k in got.keys() - new)
    assert len(edited) < len(new | edited) < len(got)


def test_deck_listing_and_paths(spark):
    listing = spark.createDataFrame([("aal062018.dat.gz",), ("bal062018.dat",), ("bal052017.dat",)], "filename string")
    assert [r.filename for r in deck_catalog(listing, file_deck="b").collect()] == ["bal062018.dat", "bal052017.dat"]
    assert [r.filename for r in deck_catalog(listing, year=2017).collect()] == ["bal052017.dat"]
    row = spark.range(1).select(
        deck_path(F.lit("AL062018"), F.lit("a"), F.lit("ARCHIVE")).alias("a"),
        deck_path(F.lit("AL062018"), F.lit("b"), F.lit("aid_public")).alias("b"),
        deck_path(F.lit("AL062018"), F.lit("f"), F.lit("aid_public")).alias("f")).first()
    assert (row.a, row.b, row.f) == ("archive/2018/aal062018.dat.gz", "btk/bal062018.dat", "fix/fal062018.dat")


def test_html_table_catalog(spark):
    html = ("<html><table><tr><th>id</th><th>name</th></tr>"
            "<tr><td>al06</td><td>Hurricane Florence</td></tr>"
            "<tr><td>ep14</td><td>Subtropical Storm <b>Lane</b></td></tr></table></html>")
    pages = spark.createDataFrame([(2018, html)], "year int, html string")
    rows = C.catalog_from_items(C.html_table_items(pages)).orderBy("nhc_code").collect()
    assert [(r.nhc_code, r.name, r["class"], r.basin, r.number) for r in rows] == [
        ("AL062018", "Florence", "HU", "AL", 6), ("EP142018", "Lane", "ST", "EP", 14)]


def test_flood_event_json_and_empty_hwm(spark):
    d = tempfile.mkdtemp(prefix="cyclonespark-json-")
    rec = [{"event_id": 283, "event_name": "Florence Sep 2018", "event_description": "x", "event_type_id": 2,
            "event_status_id": 2, "event_coordinator": 35, "instruments": [], "last_updated": "2018-09-07T15:05:56.149271",
            "last_updated_by": 35.0, "event_start_date": "2018-09-07T05:00:00", "event_end_date": "2018-10-07T05:00:00"}]
    with open(os.path.join(d, "events.json"), "w") as fh:
        json.dump(rec, fh)
    ev = U.flood_events(U.read_flood_event_json(spark, os.path.join(d, "events.json"))).first()
    assert (ev.usgs_id, ev.event_type, ev.event_status, ev.year) == (283, "HURRICANE", "COMPLETED", 2018)
    assert ev.start_date == dt.datetime(2018, 9, 7, 5)
    empty = os.path.join(d, "hwm.json")
    with open(empty, "w") as fh:
        fh.write("[]")
    hwm = U.high_water_marks(U.read_hwm_json(spark, empty))
    assert hwm.count() == 0 and hwm.columns == HWM_COLUMNS


def test_hwm_query_refinement():
    q = U.merge_hwm_query({"event_id": 182, "quality": [1, 2]}, quality=None, us_states=["FL"])
    assert q["event_id"] == 182 and q["quality"] == [1, 2] and q["us_states"] == ["FL"]


def test_hwm_csv_event_lookup(spark):
    d = tempfile.mkdtemp(prefix="cyclonespark-csv-")
    with open(os.path.join(d, "a.csv"), "w") as fh:
        fh.write("hwm_id,event_id,eventName,elev_ft\n5,,Florence Sep 2018,3.5\n7,,Florence Sep 2018,4.0\n")
    with open(os.path.join(d, "b.csv"), "w") as fh:
        fh.write("hwm_id,event_id,eventName,elev_ft\n9,182,Irma September 2017,2.0\n")
    events = spark.createDataFrame([(283, "Florence Sep 2018"), (182, "Irma September 2017")], "usgs_id long, name string")
    csv = U.read_hwm_csv(spark, [os.path.join(d, "a.csv"), os.path.join(d, "b.csv")])
    got = {os.path.basename(r.path): r.usgs_id for r in U.csv_event_ids(csv, events).collect()}
    assert got == {"a.csv": 283, "b.csv": 182}


def test_word_spans_and_substrings(spark):
    from cyclonespark.operators.correlate import substrings, word_spans

    row = spark.createDataFrame([("2020 TS Marco - Hurricane  Laura", "IDA")], "t string, n string").select(
        word_spans(F.col("t")).alias("w"), substrings(F.col("n")).alias("s")).first()
    assert "Marco" in row.w and "Hurricane  Laura" in row.w and "TS Marco - Hurricane" in row.w
    assert "arco" not in row.w and " Laura" not in row.w
    assert sorted(row.s) == sorted(["I", "ID", "IDA", "D", "DA", "A"])


def test_missing_winds_leave_the_pressure_missing(spark):
    from cyclonespark.functions.pressure import central_from_holland_b

    rows = spark.createDataFrame([(None, 1010.0, 1.2), (40.0, 1010.0, None), (40.0, 1010.0, 0.0)], "v double, bg double, b double")
    got = [r[0] for r in rows.select(central_from_holland_b(F.col("v"), F.col("bg"), F.col("b"))).collect()]
    assert got == [None, 1010.0, None]


def test_missing_name_is_no_name(spark):
    from cyclonespark.operators.ordering import ORDER_COLUMNS
    from cyclonespark.operators.tracks import storm_name

    base = spark.createDataFrame([("s", None, 1), ("s", None, 2), ("s", "IDA", 3), ("t", None, 4)], "storm_id string, name string, line_no long")
    for c in ORDER_COLUMNS:
        if c not in base.columns:
            base = base.withColumn(c, F.lit(0))
    assert {r.storm_id: r.name for r in storm_name(base).collect()} == {"s": "IDA", "t": None}


def test_empty_lists_do_not_filter_and_event_filters_need_events(spark):
    from cyclonespark.sources.surveys import filter_hwm

    marks = spark.createDataFrame([(1, "TX"), (2, "LA")], "event_id long, stateName string")
    assert filter_hwm(marks, us_states=[]).count() == 2
    with pytest.raises(ValueError):
        filter_hwm(marks, event_type="HURRICANE")


def test_rad_check_counts_short_lines_only(spark):
    from cyclonespark.sources.decks import rad_field_check

    full = ",".join(["x"] * 28)
    blank = ",".join(["x"] * 11 + ["  "] + ["x"] * 16)
    lines = spark.createDataFrame([("a", full), ("a", blank), ("b", ",".join(["x"] * 10)), ("b", full)], "path string, line string")
    assert [(r.path, r.rows_without_rad) for r in rad_field_check(lines).collect()] == [("b", 1)]


def test_one_event_meets_one_storm_per_name(spark):
    from cyclonespark.operators.correlate import flood_storms
    from cyclonespark.schema import FLOOD_EVENT_COLUMNS

    cat = spark.createDataFrame([("AL012005", "IRENE", 2005, 1, "AL"), ("AL022005", "RENE", 2005, 2, "AL"), ("AL032005", "IRENE", 2005, 3, "AL")],
                                "nhc_code string, name string, year int, number int, basin string")
    ev = spark.createDataFrame([(7, "2005 Hurricane Rene flood", 2005, "HURRICANE"), (8, "Irenes 2005", 2005, "HURRICANE")], "usgs_id int, name string, year int, event_type string")
    for c in FLOOD_EVENT_COLUMNS:
        if c not in ev.columns:
            ev = ev.withColumn(c, F.lit(None).cast("string"))
    # "Rene" is part of IRENE too; the last storm in catalog order wins
    assert [(r.usgs_id, r.nhc_code) for r in flood_storms(ev, cat).collect()] == [(7, "AL032005")]


def test_storm_lookup_by_code(spark):
    from cyclonespark.sources.catalogs import storm_by_code

    cat = spark.createDataFrame([("AL062018", "FLORENCE")], "nhc_code string, name string")
    req = spark.createDataFrame([(1, "al062018"), (2, "XX")], "req_id int, code string")
    assert {r.req_id: r.name for r in storm_by_code(cat, req).collect()} == {1: "FLORENCE", 2: None}


def test_filters_take_enumeration_names(spark):
    marks = spark.createDataFrame([(1, 1, 2, "Coastal"), (2, 3, 2, "Riverine"), (3, 1, 5, "Coastal")],
                                  "hwm_id long, hwm_type_id long, hwm_quality_id long, hwm_environment string")
    ids = lambda **q: sorted(r.hwm_id for r in U.filter_hwm(marks, **q).collect())
    assert ids(hwm_type="MUD") == ids(hwm_type=1) == ids(hwm_type=["mud"]) == [1, 3]
    assert ids(quality=["VERY_POOR", 2], environment="Coastal") == ids(quality=[5, "2"], environment="COASTAL") == [1, 3]
    with pytest.raises(ValueError):
        U.filter_hwm(marks, hwm_type="SNOW")
    sensors = spark.createDataFrame([(1, 1, 2), (2, 3, 9)], "instrument_id long, sensor_type_id long, deployment_type_id long")
    assert U.filter_sensors(sensors, sensor_type="THERMOMETER", deployment_type="RAPID_DEPLOYMENT").count() == 1
    files = spark.createDataFrame([(1, 13), (2, 1)], "file_id long, filetype_id long")
    assert U.filter_files(files, file_type="HYDROGRAPH").first().file_id == 1


def test_region_mappings_with_holes(spark):
    from cyclonespark.sources.stations import stations_in_geojson

    outer = "[[0,0],[10,0],[10,10],[0,10],[0,0]]"
    hole = "[[4,4],[6,4],[6,6],[4,6],[4,4]]"
    island = "[[4.5,4.5],[5.5,4.5],[5.5,5.5],[4.5,5.5],[4.5,4.5]]"
    regions = spark.createDataFrame([
        (1, '{"type": "Polygon", "coordinates": [%s, %s]}' % (outer, hole)),
        (2, '{"type": "MultiPolygon", "coordinates": [[%s, %s], [%s]]}' % (outer, hole, island)),
        (3, None), (4, '{"type": "Point", "coordinates": [5, 5]}'), (5, '{"type": "Polygon", "coordinates": []}'),
    ], "region_id int, geojson string")
    stations = spark.createDataFrame([(1, 5.0, 5.0, "ACTIVE"), (2, 1.0, 1.0, "ACTIVE"), (3, 4.2, 4.2, "ACTIVE"), (4, 11.0, 5.0, "ACTIVE"), (5, 2.0, 2.0, "HISTORICAL")],
                                     "nos_id long, x double, y double, status string")
    got = sorted((r.region_id, r.nos_id) for r in stations_in_geojson(stations, regions).collect())
    assert got == [(1, 2), (1, 5), (2, 1), (2, 2), (2, 5)]
    assert stations_in_geojson(stations, regions, status="HISTORICAL").count() == 2


def test_json_lines_and_their_quarantine(spark, tmp_path):
    from cyclonespark.sources import surveys as U

    lines = ['{"file_id": 1, "name": "a", "event_id": 5}', '{"file_id": "x"}', '{"file_id": 2', "[3]", "", '{"other": 1}', "plain", '{"file_id": 4, "more": {"a": [1]}, "name": "é\\n"}']
    (tmp_path / "files.json").write_text("\n".join(lines))
    good, bad = U.read_json_lines(spark, str(tmp_path / "files.json"), U.FILE_RECORD)
    assert good.columns == ["file_id", "filetype_id", "name", "event_id"]
    assert sorted((r.file_id or 0, r.name or "") for r in good.collect()) == [(0, ""), (1, "a"), (4, "é\n")]
    assert sorted((r.reason, r.line) for r in bad.collect()) == sorted([("wrong type", lines[1]), ("no record", lines[2]), ("no record", "[3]"), ("empty", ""), ("no record", "plain")])
    none = spark.createDataFrame([(None,)], "line string")
    assert [r.reason for r in U.json_records(none, U.FILE_RECORD)[1].collect()] == ["empty"]
    assert U.json_records(none.filter("line = ''"), U.FILE_RECORD)[0].count() == 0


def test_event_requests_report_what_is_missing(spark):
    from cyclonespark.sources import surveys as U

    events = spark.createDataFrame([(7, "A", 2001), (5, "A", 2002), (9, "B", None)], "usgs_id long, name string, year int")
    asked = spark.createDataFrame([(1, "A", None), (2, "A", 2001), (3, "A", 1999), (4, "C", None), (5, None, 2001), (6, "B", None), (7, "B", 2001), (1, "A", None)], "req_id int, name string, year int")
    got = sorted(map(tuple, U.event_requests(events, asked).collect()))
    assert got == [(1, 5, None), (2, 7, None), (3, None, "not in that year"), (4, None, "unknown name"), (5, None, "no name"), (6, 9, None), (7, None, "not in that year")]
    assert U.event_requests(events.limit(0), asked).filter("reason IS NULL").count() == 0


def test_storm_requests_give_a_reason(spark):
    cat = spark.createDataFrame([("AL062018", "FLORENCE", 2018, " AL", 6), ("AL012018", None, 2018, " AL", 1), ("EP022018", "BUD", 2018, " EP", 2)],
                                "nhc_code string, name string, year int, basin string, number int")
    asked = [(1, 2018, "al", None, "florence"), (2, 2018, "ep", None, "florence"), (3, 2018, None, None, "ida"), (4, 2017, None, None, "florence"),
             (5, None, None, None, "florence"), (6, 2018, "cp", None, None), (7, 2018, None, 1, None), (8, 2018, None, None, "b.d"), (8, 2018, None, None, "b.d"),
             (9, 2018, "al", None, "b.d")]
    req = spark.createDataFrame(asked, "req_id int, year int, basin string, number int, name string")
    got = {r.req_id: (r.nhc_code, r.reason) for r in C.storm_requests(cat, req).collect()}
    assert got == {1: ("AL062018", None), 2: (None, "other basin or number"), 3: (None, "no such name in that year"), 4: (None, "no storm in that year"),
                   5: (None, "no year"), 6: (None, "other basin or number"), 7: ("AL012018", None), 8: ("EP022018", None), 9: (None, "other basin or number")}
    assert C.storm_requests(cat, req).count() == 9 and C.storm_requests(cat.limit(0), req).filter("nhc_code IS NOT NULL").count() == 0
