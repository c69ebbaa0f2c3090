"""ATCF and fort.22 export (F1, F1b, F2, W7) and the text sinks (K1-K3).

Formatting is pure Column work; the sink writes one text file per storm by
hash-partitioning on ``storm_id`` and sorting each partition by record order
(``write.partitionBy`` then gives one folder per storm).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cyclonespark.operators.ordering import ORDER_COLUMNS
from cyclonespark.operators.tracks import hours_since_first, record_numbers
from cyclonespark.schema import ATCF_COLUMNS, ATCF_WIDTHS, EXTRA_ATCF_COLUMNS

MISSING = -99999  # FIXED VALUE: integer stand-in for missing numbers in the export

_STRING_FIELDS = {"basin", "storm_number", "advisory_number", "advisory", "development_level",
                  "isotach_quadrant_code", "subregion_code", "forecaster_initials", "name",
                  "depth_code", "isowave_quadrant_code", "extra_values"}


def pad_left(text: Column, width: int) -> Column:
    """Left pad with blanks to ``width``; longer text is kept whole (never truncated)."""
    return F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit(" "))


def _int_text(value: Column) -> Column:
    return F.rint(F.coalesce(value.cast("double"), F.lit(float(MISSING)))).cast("long").cast("string")


def _hemisphere(text: Column, pos: str, neg: str) -> Column:
    """``text`` of tenths without its sign, and the hemisphere's letter."""
    return F.concat(F.translate(text, "-", ""), F.when(text.contains("-"), neg).otherwise(pos))


def format_atcf(track: DataFrame, advisory: str | None = None, extended: bool = False,
                ffill_partition=("storm_id",), tail: bool = True) -> DataFrame:
    """one ``line`` per record, ATCF text with the original's widths and missing-value rules.

    * forecast records print their cycle start as time;
    * background pressure is forward-filled in record order (W7) before formatting;
    * pressures are repaired (F1b): background <= central -> 1013, and if central >= 1013
      then background = central + 1;
    * NULL numbers print empty.
    """
    w = Window.partitionBy(*ffill_partition).orderBy(*ORDER_COLUMNS).rowsBetween(Window.unboundedPreceding, 0)
    df = track.withColumn("_bg", F.last("background_pressure", ignorenulls=True).over(w))
    if advisory is not None:
        df = df.filter(F.col("advisory") == advisory)
    best = F.col("advisory") == "BEST"
    when = F.when(best, F.col("datetime")).otherwise(F.col("track_start_time"))
    fields: dict[str, Column] = {}
    for name in ATCF_COLUMNS[:-1]:
        if name == "datetime":
            fields[name] = F.date_format(when, "yyyyMMddHH")
        elif name == "forecast_hours":
            fields[name] = F.col("forecast_hours").cast("string")
        elif name == "latitude":
            fields[name] = _hemisphere(F.col("_lat"), "N", "S")
        elif name == "longitude":
            fields[name] = _hemisphere(F.col("_lon"), "E", "W")
        elif name in ("central_pressure", "background_pressure"):
            continue
        elif name in _STRING_FIELDS:
            fields[name] = F.col(name).cast("string")
        else:
            fields[name] = _int_text(F.col(name))
    whole = lambda c: F.rint(F.coalesce(F.col(c), F.lit(float(MISSING)))).cast("long")
    # numbers that a field needs more than once are made once
    df = df.withColumns({"_cp": whole("central_pressure"), "_bg0": whole("_bg"), "_lat": _int_text(F.col("latitude") * 10), "_lon": _int_text(F.col("longitude") * 10)})
    cp, bg0 = F.col("_cp"), F.col("_bg0")
    repaired = F.when(bg0 <= cp, F.when(cp >= 1013, cp + 1).otherwise(F.lit(1013))).otherwise(bg0)
    fields["central_pressure"] = cp.cast("string")
    fields["background_pressure"] = repaired.cast("string")
    order = list(ATCF_COLUMNS[:-1])
    if extended:
        for name in EXTRA_ATCF_COLUMNS[:-1]:
            fields[name] = F.col(name).cast("string") if name in _STRING_FIELDS else _int_text(F.col(name))
        order += EXTRA_ATCF_COLUMNS[:-1]
    texts = []
    for name in order:
        text = fields[name]
        if name in ATCF_WIDTHS:
            text = pad_left(text, ATCF_WIDTHS[name])
        texts.append(F.coalesce(F.replace(text, F.lit(str(MISSING)), F.lit("")), F.lit("")))
    if tail:
        texts.append(F.coalesce(F.col("extra_values"), F.lit("")))
    return df.withColumn("line", F.concat_ws(",", *texts)).drop("_bg", "_cp", "_bg0", "_lat", "_lon")


def format_fort22(track: DataFrame, advisory: str | None = None) -> DataFrame:
    """ATCF fields without the extended / tail columns, plus the record number.

    The record number ranks valid times over all selected records (before the advisory
    filter); for a BEST export the TAU field holds hours since the first record (W6).
    """
    numbered = record_numbers(track)
    if advisory == "BEST":
        numbered = hours_since_first(numbered).withColumn("forecast_hours", F.col("hours_since_start"))
    out = format_atcf(numbered, advisory=advisory, extended=False, tail=False)
    return out.withColumn("line", F.concat_ws(",", F.col("line"), pad_left(F.col("record_number").cast("string"), 4)))


def write_track_text(lines: DataFrame, path: str, overwrite: bool = False, suffix: str = ".dat") -> None:
    """K1/K2/K3: write ``line`` text, one folder per storm, records in record order.

    ``suffix`` must be ``.dat`` (ATCF) or ``.22`` (fort.22); existing targets are
    skipped storm by storm unless ``overwrite`` (dynamic partition overwrite: only
    the written storms are replaced); new storms are always written.
    """
    if suffix not in (".dat", ".22"):
        raise NotImplementedError(f"suffix {suffix!r}: only '.dat' and '.22' can be written")
    spark = lines.sparkSession
    todo = lines.select("storm_id", *ORDER_COLUMNS, "line")
    if not overwrite:
        there = _written_storms(spark, path)
        if there is not None:
            todo = todo.join(there, F.col("storm_id").cast("string") == F.col("_there"), "left_anti")
    ordered = (todo.repartition("storm_id")
               .sortWithinPartitions("storm_id", *ORDER_COLUMNS)
               .select("storm_id", "line"))
    writer = ordered.write.option("partitionOverwriteMode", "dynamic")
    writer.mode("overwrite" if overwrite else "append").partitionBy("storm_id").text(path)


def _written_storms(spark: SparkSession, path: str) -> DataFrame | None:
    """Storms that a target folder holds already; None for a new folder."""
    try:
        # the given type keeps an id such as 007 from being read as a number
        old = spark.read.schema("value string, storm_id string").text(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return old.select(F.col("storm_id").alias("_there")).distinct()
