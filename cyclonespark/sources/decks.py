"""ATCF deck ingest (a/b/f decks and fort.22 files, plain or gzip).

``read_deck_lines`` turns many files into one ``(path, line_no, line)`` table in
parallel over the blocks of files; ``parse_deck_lines`` turns any such line table
into typed track records.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cyclonespark.schema import (
    ATCF_COLUMNS,
    EXTRA_ATCF_COLUMNS,
    FORT22_COLUMNS,
    NUMERIC_COLUMNS,
)


#: files of up to so many bytes are read whole
WHOLE_FILE = 1 << 20


def read_deck_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """One row per non-blank physical line of files or folders: ``path, line_no (0-based, blank lines counted), line``.

    Files of up to ``WHOLE_FILE`` bytes are read whole, once, and cut into lines where they are read.  Longer plain
    files are split into blocks like any text, longer gzip files are one block.  A block's lines are numbered where
    they are read; the counts of the blocks before it in its file, one row a block, are joined on.  Both branches
    read the same blocks, so a repeated task numbers as the first did.
    """
    if isinstance(paths, str):
        paths = [paths]
    reader = lambda: spark.read.option("lineSep", "\n").option("recursiveFileLookup", "true")
    path, size = F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size")
    strip = lambda c: F.regexp_replace(c, "\r$", "").alias("line")
    # a file is left out by its size when files are listed, so neither branch opens the other's
    small = reader().text(list(paths), wholetext=True).filter(size <= WHOLE_FILE)
    small = small.select(path, F.posexplode(F.split("value", "\n")).alias("_at", "line")).select("path", F.col("_at").cast("long").alias("line_no"), strip("line"))
    raw = reader().text(list(paths)).filter(size > WHOLE_FILE).select(
        path, F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_at"), strip("value"))
    blocks = raw.groupBy("path", "_block").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("path", "_block", (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_start"))
    lines = raw.join(starts, ["path", "_block"])
    lines = lines.select("path", (F.col("_start") + F.col("_at")).cast("long").alias("line_no"), "line")
    return small.unionByName(lines).filter(F.length(F.trim("line")) > 0)


def _field(fields: Column, index: int) -> Column:
    # F.get returns NULL past the end: missing trailing fields stay NULL
    return F.trim(F.get(fields, index))


def parse_latlon(text: Column, positive: str, negative: str) -> Column:
    """``"123N"`` -> 12.3, ``"123S"`` -> -12.3 (tenths of degrees with hemisphere letter)."""
    t = F.trim(text)
    digits = F.regexp_extract(t, r"^\s*([-+]?[0-9.]+)", 1)
    value = F.when(digits == "", F.lit(None).cast("double")).otherwise(digits.try_cast("double")) / 10.0
    return (
        F.when(t.endswith(negative), -value)
        .when(t.endswith(positive), value)
        .otherwise(value)
    )


def parse_record_time(ymdh: Column, advisory: Column, minutes: Column) -> Column:
    """Record time: BEST rows append the minutes field when present, others ``00``."""
    ymdh = F.trim(ymdh)
    mins = F.when((advisory == "BEST") & (F.length(F.trim(minutes)) > 0), F.trim(minutes)).otherwise(F.lit("00"))
    text = F.concat(ymdh, mins)
    ok = text.rlike(r"^[0-9]{12}$")
    return F.when(
        ok,
        F.try_make_timestamp_ntz(
            F.substring(text, 1, 4).cast("int"),
            F.substring(text, 5, 2).cast("int"),
            F.substring(text, 7, 2).cast("int"),
            F.substring(text, 9, 2).cast("int"),
            F.substring(text, 11, 2).cast("int"),
            F.lit(0),
        ),
    )


def parse_deck_lines(lines: DataFrame, extras: str = "null", fort22: bool = False,
                     keep: Sequence[str] = ("path", "line_no")) -> DataFrame:
    """Typed records from a ``line`` column.

    ``extras="null"`` reproduces the observable behaviour of the original reader
    (extended tail columns always null, tail kept in ``extra_values``);
    ``extras="parse"`` splits the tail into the extended (or fort.22) columns.
    """
    kept = [k for k in keep if k in lines.columns]
    # split once per line (one projection), then address the fields
    lines = lines.select(*kept, F.split(F.col("line"), ",", len(ATCF_COLUMNS)).alias("_fields"))
    fields = F.col("_fields")
    cols: list[Column] = [F.col(k) for k in kept]
    raw = {name: _field(fields, i) for i, name in enumerate(ATCF_COLUMNS)}

    for name in ATCF_COLUMNS:
        if name in ("datetime", "latitude", "longitude", "forecast_hours"):
            continue
        if name in NUMERIC_COLUMNS:
            cols.append(F.when(raw[name] == "", F.lit(None).cast("double"))
                        .otherwise(raw[name].try_cast("double")).alias(name))
        elif name == "extra_values":
            cols.append(F.get(fields, len(ATCF_COLUMNS) - 1).alias(name))
        else:
            cols.append(raw[name].alias(name))
    cols.append(parse_record_time(raw["datetime"], raw["advisory"], raw["advisory_number"]).alias("record_time"))
    cols.append(raw["forecast_hours"].try_cast("int").alias("forecast_hours"))
    cols.append(parse_latlon(raw["latitude"], "N", "S").alias("latitude"))
    cols.append(parse_latlon(raw["longitude"], "E", "W").alias("longitude"))
    out = lines.select(*cols)

    tail_columns = FORT22_COLUMNS if fort22 else EXTRA_ATCF_COLUMNS[:-1]
    if extras == "parse":
        tail = F.split(F.col("extra_values"), ",")
        out = out.select("*", *[
            (F.trim(F.get(tail, i)).try_cast("double") if (c in NUMERIC_COLUMNS or fort22) else F.trim(F.get(tail, i))).alias(c)
            for i, c in enumerate(tail_columns)
        ])
    else:
        out = out.select("*", *[
            F.lit(None).cast("double" if c in NUMERIC_COLUMNS else "string").alias(c)
            for c in EXTRA_ATCF_COLUMNS[:-1]
        ])
        # a file whose tails hold commas gets the (empty) extended columns instead of its tail
        comma = F.coalesce(F.col("extra_values").contains(","), F.lit(False))
        if "path" in out.columns:
            # one row a file, so that no record is shuffled for it
            files = out.groupBy(F.col("path").alias("_path")).agg(F.max(comma).alias("_comma"))
            out = out.join(files, F.col("path").eqNullSafe(F.col("_path"))).drop("_path")
            comma = F.col("_comma")
        out = out.withColumn("extra_values", F.when(comma, F.lit(None).cast("string")).otherwise(F.col("extra_values"))).drop("_comma")
    return out


def with_storm_code(decks: DataFrame, file_col: str = "path") -> DataFrame:
    """``storm_id`` = basin + number + year of the last record of each file (one storm per deck)."""
    last = F.max_by(F.struct("basin", "storm_number", "record_time"), F.col("line_no")).alias("_last")
    code = F.upper(F.concat("_last.basin", "_last.storm_number", F.year("_last.record_time").cast("string")))
    codes = decks.groupBy(F.col(file_col).alias("_file")).agg(last).select("_file", code.alias("storm_id"))
    return decks.join(codes, F.col(file_col).eqNullSafe(F.col("_file"))).drop("_file")


def rad_field_check(lines: DataFrame, file_col: str = "path") -> DataFrame:
    """Files with a line (column ``line``) that ends before its RAD field; a blank field is there.

    One row per bad file.
    """
    n_fields = F.size(F.split("line", ","))
    position = ATCF_COLUMNS.index("isotach_radius")
    return (lines.groupBy(file_col)
            .agg(F.count(F.when(n_fields <= position, 1)).alias("rows_without_rad"))
            .filter(F.col("rows_without_rad") > 0))


# ---------------------------------------------------------------------------------------
# Deck listing and deck path rules
# ---------------------------------------------------------------------------------------

def deck_catalog(listing: DataFrame, file_deck: str | None = None, year=None, name_col: str = "filename") -> DataFrame:
    """Keep deck files of a listing: deck letter = first char of the name, year inside the name.

    Sorted newest name first (descending), like the archive directory crawl.
    """
    out = listing.withColumn("file_deck", F.substring(F.col(name_col), 1, 1))
    if file_deck is not None:
        decks = [file_deck] if isinstance(file_deck, str) else list(file_deck)
        out = out.filter(F.col("file_deck").isin(decks))
    if year is not None:
        years = [year] if isinstance(year, (int, str)) else list(year)
        cond = F.lit(False)
        for y in years:
            cond = cond | F.col(name_col).contains(str(y))
        out = out.filter(cond)
    return out.orderBy(F.col(name_col).desc())


def deck_path(nhc_code: Column, file_deck: Column, mode: Column) -> Column:
    """Relative location of a deck: archive/<year>/<deck><code>.dat.gz, or the real-time folders."""
    code = F.lower(nhc_code)
    year = F.substring(nhc_code, 5, 4)
    deck = F.coalesce(F.lower(file_deck), F.lit("a"))
    historical = F.upper(mode).isin("ARCHIVE", "HISTORICAL")
    folder = (
        F.when(historical, F.concat(F.lit("archive/"), year))
        .when(deck == "a", F.lit("aid_public"))
        .when(deck == "b", F.lit("btk"))
        .when(deck == "f", F.lit("fix"))
    )
    suffix = F.when(historical | (deck == "a"), F.lit(".dat.gz")).otherwise(F.lit(".dat"))
    return F.when(folder.isNotNull(), F.concat(folder, F.lit("/"), deck, code, suffix))
