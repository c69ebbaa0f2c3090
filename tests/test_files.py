"""Deck files: block-wise line numbers against plain Python, named track files, their commit and abort."""

import datetime as dt
import gzip
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from cyclonespark.sinks.files import write_track_files
from cyclonespark.sources.decks import parse_deck_lines, read_deck_lines


def _folder():
    return tempfile.mkdtemp(prefix="cyclonespark-files-")


@pytest.fixture
def small_blocks(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)


@pytest.mark.parametrize("whole", [0, 40_000, 1 << 20])
def test_whole_and_split_files_number_alike(spark, small_blocks, monkeypatch, whole):
    monkeypatch.setattr("cyclonespark.sources.decks.WHOLE_FILE", whole)
    rng = random.Random(6)
    folder, want = _folder(), set()
    for f in range(6):
        body = ["" if rng.random() < 0.1 else "x" * rng.randrange(1, 900) + f" {f}:{i}" for i in range((90, 200, 0, 1, 3, 90)[f])]
        end = "\r\n" if f == 1 else "\n"
        data = end.join(body).encode() + (b"" if f == 3 else end.encode())
        name = f"{folder}/d{f}.dat" + (".gz" if f == 5 else "")
        with (gzip.open if f == 5 else open)(name, "wb") as out:
            out.write(data)
        want |= {(os.path.basename(name), i, line) for i, line in enumerate(body) if line.strip()}
    lines = read_deck_lines(spark, folder)
    rows = lines.collect()
    assert len(rows) == len(want) and {(os.path.basename(r.path), r.line_no, r.line) for r in rows} == want
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert "Generate posexplode" in plan  # small files need no second reading


def test_line_numbers_of_split_files(spark, small_blocks):
    rng = random.Random(5)
    folder, want = _folder(), set()
    for f in range(5):
        body = ["" if rng.random() < 0.1 else "x" * rng.randrange(1, 900) + f" {f}:{i}" for i in range(0 if f == 4 else 90)]
        end = "\r\n" if f == 1 else "\n"
        data = end.join(body).encode() + (b"" if f == 2 else end.encode())
        name = f"{folder}/d{f}.dat" + (".gz" if f == 3 else "")
        with (gzip.open if f == 3 else open)(name, "wb") as out:
            out.write(data)
        want |= {(os.path.basename(name), i, line) for i, line in enumerate(body) if line.strip()}
    lines = read_deck_lines(spark, folder)
    rows = lines.collect()
    got = {(os.path.basename(r.path), r.line_no, r.line) for r in rows}
    assert len(rows) == len(want) and got == want
    plain = spark.read.text(folder).select("_metadata.file_path", "_metadata.file_block_start").distinct().groupBy("file_path").count()
    assert plain.filter("file_path LIKE '%d0.dat'").first()["count"] > 20  # the file was really read in pieces


def test_no_lines(spark):
    folder = _folder()
    open(f"{folder}/empty.dat", "w").close()
    assert read_deck_lines(spark, folder).collect() == []


def test_comma_tails_count_by_file(spark):
    head = "AL, 06, 2018083012,   , BEST,   0, 129N,  184W,  25, 1007, TD,  34, NEQ,    0,    0,    0,    0, 1011,  150,  60,  35,   0,   L,   0,    ,   0,   0,     FLORENCE,"
    lines = spark.createDataFrame([("a", 0, head + "x"), ("a", 1, head + "D, 12"), ("b", 0, head + "y"), (None, 0, head + "z")],
                                  "path string, line_no long, line string")
    got = {(r.path, r.line_no): r.extra_values for r in parse_deck_lines(lines).collect()}
    assert got == {("a", 0): None, ("a", 1): None, ("b", 0): "y", (None, 0): "z"}


def _lines(spark, rows):
    rows = [(s, dt.datetime(2020, 1, 1), "BEST", i, line) for s, i, line in rows]
    return spark.createDataFrame(rows, "storm_id string, record_time timestamp_ntz, advisory string, line_no long, line string")


def _read(folder):
    return {n: open(f"{folder}/{n}").read() for n in os.listdir(folder)}


def test_one_named_file_a_storm(spark):
    out = f"{_folder()}/tracks"
    write_track_files(_lines(spark, [("007", 2, "b"), ("007", 1, "a"), ("7", 1, None), ("AL/06", 1, "é")]), out)
    assert _read(out) == {"007.dat": "a\nb\n", "7.dat": "\n", "AL%2F06.dat": "é\n"}
    write_track_files(_lines(spark, [("007", 1, "new"), ("8", 1, "c")]), out)
    assert _read(out)["007.dat"] == "a\nb\n" and _read(out)["8.dat"] == "c\n"
    write_track_files(_lines(spark, [("007", 1, "new")]), out, overwrite=True)
    assert _read(out) == {"007.dat": "new\n", "7.dat": "\n", "AL%2F06.dat": "é\n", "8.dat": "c\n"}
    write_track_files(_lines(spark, []), out, suffix=".22")
    assert len(_read(out)) == 4
    with pytest.raises(NotImplementedError):
        write_track_files(_lines(spark, []), out, suffix=".csv")


def test_a_failed_job_leaves_no_file(spark):
    out = f"{_folder()}/tracks"
    rows = _lines(spark, [(str(i), i, "x") for i in range(50)])
    # no file system takes a name this long: its task fails while others have written theirs
    bad = rows.withColumn("storm_id", F.when(F.col("line_no") == 33, F.repeat(F.lit("9"), 300)).otherwise(F.col("storm_id")))
    with pytest.raises(Exception, match="too long"):
        write_track_files(bad, out)
    assert os.listdir(out) == []
    write_track_files(rows, out)
    assert len(os.listdir(out)) == 50
    with pytest.raises(Exception, match="storm_id"):
        write_track_files(_lines(spark, [(None, 1, "x")]), out)
