"""Storm catalogs (S3, S4, S5) and storm lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cyclonespark.schema import CATALOG_COLUMNS, CATALOG_CSV_COLUMNS
from cyclonespark.session import stored

CATALOG_CSV_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in CATALOG_CSV_COLUMNS])


def read_catalog_csv(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Raw 21-column catalog text; the first physical line of each file is consumed as a header."""
    return spark.read.schema(CATALOG_CSV_SCHEMA).option("header", "true").option("enforceSchema", "true").csv(paths)


def parse_catalog_lines(lines: DataFrame, col: str = "value", keep=("line_no",)) -> DataFrame:
    """The same 21 positional columns from a DataFrame of CSV text lines (JVM ``from_csv``)."""
    ddl = ", ".join(f"`{c}` STRING" for c in CATALOG_CSV_COLUMNS)
    kept = [k for k in keep if k in lines.columns]
    return lines.select(*kept, F.from_csv(F.col(col), ddl).alias("r")).select(*kept, "r.*")


def _yyyymmddhh(text: Column) -> Column:
    t = F.trim(text)
    return F.when(t.rlike(r"^[0-9]{10}$"), F.try_make_timestamp_ntz(
        F.substring(t, 1, 4).cast("int"), F.substring(t, 5, 2).cast("int"), F.substring(t, 7, 2).cast("int"),
        F.substring(t, 9, 2).cast("int"), F.lit(0), F.lit(0)))


def _blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def storm_catalog(raw: DataFrame, year=None, parse_dates: bool = True) -> DataFrame:
    """S3 (``parse_dates``) / S4: the nine catalog columns, sorted by (year, number, basin).

    ``basin`` keeps its text as read (the catalog prints a leading blank), names,
    classes and sources are trimmed with blank as NULL, the code is trimmed.
    """
    out = raw.select(
        *([F.col("line_no")] if "line_no" in raw.columns else []),
        F.trim("nhc_code").alias("nhc_code"),
        _blank_to_null(F.col("name")).alias("name"),
        _blank_to_null(F.col("class")).alias("class"),
        F.trim("year").try_cast("int").alias("year"),
        F.col("basin"),
        F.trim("number").try_cast("int").alias("number"),
        _blank_to_null(F.col("source")).alias("source"),
        (_yyyymmddhh(F.col("start_date")) if parse_dates else F.col("start_date")).alias("start_date"),
        (_yyyymmddhh(F.col("end_date")) if parse_dates else F.col("end_date")).alias("end_date"),
    )
    if year is not None:
        years = [int(year)] if isinstance(year, (int, str)) else [int(y) for y in year]
        out = out.filter(F.col("year").isin(years))
    return out.select(*CATALOG_COLUMNS, *(["line_no"] if "line_no" in out.columns else []))


def catalog_order(catalog: DataFrame) -> list[str]:
    """O2: (year, number, basin), ties in file order when the line number is known."""
    return ["year", "number", "basin"] + (["line_no"] if "line_no" in catalog.columns else [])


def sort_catalog(catalog: DataFrame) -> DataFrame:
    return catalog.orderBy(*catalog_order(catalog))


def storm_class(long_name: Column) -> Column:
    """E5: class from the long name; the last matching rule wins."""
    ln = long_name
    return (F.when(ln.rlike("(?i)subtropical"), F.lit("ST"))
            .when(ln.rlike("(?i)tropical depression"), F.lit("TD"))
            .when(ln.rlike("(?i)tropical storm"), F.lit("TS"))
            .when(ln.rlike("(?i)tropical cyclone") | ln.rlike("(?i)hurricane"), F.lit("HU")))


def catalog_from_items(items: DataFrame) -> DataFrame:
    """S5 rows (identifier, long_name, year) -> catalog columns (E5, E6), source GIS_ARCHIVE."""
    code = F.upper(F.concat(F.col("identifier"), F.col("year").cast("string")))
    name = F.element_at(F.split(F.trim(F.col("long_name")), r"\s+"), -1)
    return items.select(
        code.alias("nhc_code"),
        _blank_to_null(name).alias("name"),
        storm_class(F.col("long_name")).alias("class"),
        F.col("year").cast("int").alias("year"),
        F.substring(code, 1, 2).alias("basin"),
        F.substring(code, 3, 2).try_cast("int").alias("number"),
        F.lit("GIS_ARCHIVE").alias("source"),
        F.lit(None).cast("timestamp_ntz").alias("start_date"),
        F.lit(None).cast("timestamp_ntz").alias("end_date"),
    )


def html_table_items(pages: DataFrame, html_col: str = "html", year_col: str = "year") -> DataFrame:
    """(identifier, long_name, year) from the rows of each page's first ``<table>`` (header row skipped)."""
    table = F.regexp_extract(F.col(html_col), r"(?is)<table[^>]*>(.*?)</table>", 1)
    rows = F.regexp_extract_all(table, F.lit(r"(?is)<tr[^>]*>(.*?)</tr>"), 1)
    exploded = pages.select(F.col(year_col).alias("year"), F.posexplode(rows).alias("pos", "row")).filter("pos > 0")
    cells = F.regexp_extract_all(F.col("row"), F.lit(r"(?is)<td[^>]*>(.*?)</td>"), 1)
    strip = lambda c: F.trim(F.regexp_replace(c, r"<[^>]*>", ""))
    return exploded.select(strip(F.get(cells, 0)).alias("identifier"), strip(F.get(cells, 1)).alias("long_name"), "year")


def add_missing_codes(primary: DataFrame, secondary: DataFrame) -> DataFrame:
    """J1 + U3: append secondary-catalog storms whose code the primary catalog lacks."""
    extra = secondary.join(primary.select("nhc_code"), "nhc_code", "left_anti")
    return primary.unionByName(extra.select(*CATALOG_COLUMNS), allowMissingColumns=True)


def lookup_storms(catalog: DataFrame, requests: DataFrame) -> DataFrame:
    """P9 batch form: per request (req_id, year, basin?, number?, name?) the first catalog match.

    basin *contains*, number equal, name full match of the upper-cased request (a regex);
    "first" = catalog order (year, number, basin).

    The catalog is first reduced to its first storm per (year, name, basin, number), and a request to
    the names it asks for: a plain name is itself, a regex is matched once against the
    distinct (year, name) pairs.  Both then join on (year, name); requests without a name join the catalog
    reduced to the first storm per (year, basin, number).  A request with a number joins on it too, one without
    meets the first storm of each basin only, so that no request meets every number of its name or year.
    """
    meta = r"[.^$*+?()\[\]{}|\\]"
    # equal storms first meet in a hash aggregation of one long (NULL lines come first, as in the order below)
    line = F.coalesce(F.col("line_no").cast("long"), F.lit(-(2**63))) if "line_no" in catalog.columns else F.lit(0).cast("long")
    cat = catalog.groupBy("nhc_code", "name", "year", F.col("basin").alias("_basin"), "number").agg(F.min(line).alias("_line"))
    cat = stored(cat, "storms")  # four steps read it
    order = F.struct("year", "number", "_basin", "_line")
    storm = F.min_by(F.struct("nhc_code", "name", "year", "_basin", "number", "_line"), order).alias("s")
    named = cat.filter(F.col("name").isNotNull()).groupBy("year", "name", "_basin", "number").agg(storm)
    whole = cat.groupBy("year", "_basin", "number").agg(storm)

    req = requests.select("req_id", "year", F.upper("basin").alias("_rbasin"), F.col("number").alias("_rnumber"), F.upper("name").alias("name"))
    plain = req.filter(F.col("name").isNotNull() & ~F.col("name").rlike(meta))
    regex = req.filter(F.col("name").rlike(meta))
    # each distinct regex of a year meets the year's distinct names once
    asked = regex.select("year", F.col("name").alias("_regex")).distinct()
    full = F.concat(F.lit("^(?:"), F.col("_regex"), F.lit(")$"))
    hits = named.select("year", "name").distinct().join(asked, "year").filter(F.regexp_like("name", full))
    spelled = regex.withColumnRenamed("name", "_regex").join(hits, ["year", "_regex"]).drop("_regex")

    in_basin = F.col("_rbasin").isNull() | F.col("_basin").contains(F.col("_rbasin"))

    def met(wanted: DataFrame, storms: DataFrame, by: list[str]) -> DataFrame:
        numbered = wanted.filter(F.col("_rnumber").isNotNull()).withColumn("number", F.col("_rnumber")).join(storms, [*by, "number"])
        # without a number only the first storm of a basin counts
        firsts = storms.groupBy(*by, "_basin").agg(F.min_by("s", F.struct("s.year", "s.number", "s._basin", "s._line")).alias("s"))
        unnumbered = wanted.filter(F.col("_rnumber").isNull()).join(firsts, by)
        return numbered.filter(in_basin).select("req_id", "s").unionByName(unnumbered.filter(in_basin).select("req_id", "s"))

    found = met(plain.unionByName(spelled), named, ["year", "name"]).unionByName(met(req.filter(F.col("name").isNull()).drop("name"), whole, ["year"]))
    best = found.groupBy("req_id").agg(F.min_by("s", F.struct("s.year", "s.number", "s._basin", "s._line")).alias("s"))
    return best.select("req_id", "s.nhc_code", "s.name", "s.year", F.trim("s._basin").alias("basin"), "s.number")


def storm_requests(catalog: DataFrame, requests: DataFrame) -> DataFrame:
    """P9 with a report: every request of ``lookup_storms`` with its storm, or the ``reason`` why there is none:
    ``no year``, ``no storm in that year``, ``no such name in that year`` (names that no storm of the year matches) or
    ``other basin or number``.

    The lookup itself, and a second one for the requests it left open, by year and name alone; both are
    equi-joins.  Repeated ``req_id`` are one request.
    """
    found = lookup_storms(catalog, requests).withColumnRenamed("year", "_year").withColumnRenamed("basin", "_basin").withColumnRenamed("number", "_number").withColumnRenamed("name", "_name")
    met = requests.select("req_id", "year", "basin", "number", "name").dropDuplicates(["req_id"]).join(found, "req_id", "left")
    nothing = F.lit(None)
    open_ = met.filter(F.col("nhc_code").isNull() & F.col("name").isNotNull()).select(
        "req_id", "year", nothing.cast("string").alias("basin"), nothing.cast("int").alias("number"), "name")
    named = lookup_storms(catalog, open_).select("req_id", F.lit(True).alias("_named"))
    years = catalog.select("year").distinct().withColumn("_any", F.lit(True))
    reason = (F.when(F.col("nhc_code").isNotNull(), F.lit(None)).when(F.col("year").isNull(), "no year")
              .when(F.col("_any").isNull(), "no storm in that year")
              .when(F.col("name").isNotNull() & F.col("_named").isNull(), "no such name in that year").otherwise("other basin or number"))
    return met.join(named, "req_id", "left").join(years, "year", "left").select(
        "req_id", "nhc_code", F.col("_name").alias("name"), F.col("_year").alias("year"), F.col("_basin").alias("basin"),
        F.col("_number").alias("number"), reason.cast("string").alias("reason"))


def storm_by_code(catalog: DataFrame, requests: DataFrame) -> DataFrame:
    """P10: storms by code, in any letter case: ``requests(req_id, code)`` to the catalog row (NULL columns when unknown)."""
    asked = requests.select("req_id", F.upper(F.trim("code")).alias("_code"))
    storms = catalog.withColumn("_code", F.upper(F.trim("nhc_code")))
    return asked.join(storms, "_code", "left").drop("_code")


def parse_name_year(text: Column) -> Column:
    """P10: 'florence2018' -> struct(name, year) when exactly four digits are present, else NULL."""
    digits = F.length(F.regexp_replace(text, r"[^0-9]", ""))
    return F.when(digits == 4, F.struct(
        F.upper(F.substring(text, F.lit(1), F.length(text) - 4)).alias("name"),
        F.substring(text, -4, 4).cast("int").alias("year")))
