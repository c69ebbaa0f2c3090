"""Registered catalog queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cyclonespark.operators.filters import storm_status
from cyclonespark.plans import surrogates as S
from cyclonespark.plans.registry import register
from cyclonespark.schema import CATALOG_COLUMNS
from cyclonespark.sources import catalogs as C
from cyclonespark.sources.decks import deck_catalog, deck_path

CAT_COLS = ", ".join(CATALOG_COLUMNS)


def raw_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = S.catalog_csv_lines(spark, sf_dir)
    first = lines.agg(F.min("line_no").alias("_first"))
    # the first physical line is consumed as header, like the original reader
    body = lines.join(F.broadcast(first), lines.line_no == first._first, "left_anti")  # one row
    return C.parse_catalog_lines(body)


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.storm_catalog(raw_catalog(spark, sf_dir))


CAT_BODY = "SELECT {cols} FROM catalog WHERE line_no <> (SELECT min(line_no) FROM catalog)"


@register("storm_catalog", covers=("S3", "E4", "O2"), sql=S.with_ctes(S.CATALOG_SQL, body=CAT_BODY.format(cols=CAT_COLS)))
def storm_catalog(spark, sf_dir):
    return C.sort_catalog(catalog(spark, sf_dir)).select(*CATALOG_COLUMNS)


@register("storm_catalog_years", covers=("P8", "S3"), sql=S.with_ctes(S.CATALOG_SQL, body=CAT_BODY.format(cols=CAT_COLS)
                                                                    + " AND year IN (1994, 1996)"))
def storm_catalog_years(spark, sf_dir):
    return C.storm_catalog(raw_catalog(spark, sf_dir), year=[1994, 1996]).select(*CATALOG_COLUMNS)


@register("storm_archive", covers=("S4",), sql=S.with_ctes(S.CATALOG_SQL, body=f"""
SELECT nhc_code, name, class, year, basin, number, source, strftime(start_date, '%Y%m%d%H') AS start_date,
  strftime(end_date, '%Y%m%d%H') AS end_date FROM catalog WHERE line_no <> (SELECT min(line_no) FROM catalog)"""))
def storm_archive(spark, sf_dir):
    raw = raw_catalog(spark, sf_dir)
    out = C.storm_catalog(raw, parse_dates=False).select(*CATALOG_COLUMNS)
    return out.withColumn("start_date", F.nullif(F.trim("start_date"), F.lit(""))).withColumn(
        "end_date", F.nullif(F.trim("end_date"), F.lit("")))


# --- S5: HTML catalog from page list items ----------------------------------------------

ITEM_PATTERN = r'<li><a href="[^"]*">([^<]*)</a></li>'
PREFIXES = ["Hurricane", "Tropical Storm", "Tropical Depression", "Subtropical Storm", "Post-Tropical Cyclone"]


def archive_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive pages (html, year): each page's list items as the rows of a ``<table>``, a second table behind it."""
    pages = S.table(spark, sf_dir, "pages").select("page_id", "html")
    prefix = F.array(*[F.lit(p) for p in PREFIXES])

    def row(text, at):
        pos = at + 1
        code = F.concat(F.when(pos % 2 == 0, "al").otherwise("ep"), F.lpad(pos.cast("string"), 2, "0"))
        name = F.concat(F.element_at(prefix, (pos % 5 + 1).cast("int")), F.lit(" "), text)
        return F.concat(F.lit('<tr class="storm">\n <td><a href="/">'), code, F.lit("</a></td><td> <b>"), name, F.lit("</b> </td>\n</tr>"))

    rows = F.array_join(F.transform(F.regexp_extract_all("html", F.lit(ITEM_PATTERN), 1), row), "\n")
    return pages.select(
        F.concat(F.lit("<html><TABLE border=1><tr><th>id</th><th>name</th></tr>"), rows,
                 F.lit("</TABLE><table><tr><td>x</td></tr><tr><td>zz99</td><td>Hurricane Other</td></tr></table></html>")).alias("html"),
        (F.lit(1992) + F.col("page_id") % 8).alias("year"))


def page_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(identifier, long_name, year) of the first table of each archive page."""
    return C.html_table_items(archive_pages(spark, sf_dir))


HTML_SQL = """
html_items AS (
  SELECT page_id, unnest(its) AS text, unnest(range(1, len(its) + 1)) AS pos
  FROM (SELECT page_id, regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)</a></li>', 1) AS its FROM pages)
),
html_rows AS (
  SELECT CASE WHEN pos % 2 = 0 THEN 'al' ELSE 'ep' END || lpad(CAST(pos AS VARCHAR), 2, '0') AS identifier,
    (['Hurricane', 'Tropical Storm', 'Tropical Depression', 'Subtropical Storm', 'Post-Tropical Cyclone'])[pos % 5 + 1] || ' ' || text AS long_name,
    CAST(1992 + page_id % 8 AS INTEGER) AS year
  FROM html_items
),
html_catalog AS (
  SELECT upper(identifier || CAST(year AS VARCHAR)) AS nhc_code,
    nullif(trim(regexp_split_to_array(trim(long_name), '\\s+')[-1]), '') AS name,
    CASE WHEN regexp_matches(long_name, '(?i)subtropical') THEN 'ST'
         WHEN regexp_matches(long_name, '(?i)tropical depression') THEN 'TD'
         WHEN regexp_matches(long_name, '(?i)tropical storm') THEN 'TS'
         WHEN regexp_matches(long_name, '(?i)tropical cyclone') OR regexp_matches(long_name, '(?i)hurricane') THEN 'HU' END AS class,
    year, substr(upper(identifier || CAST(year AS VARCHAR)), 1, 2) AS basin,
    TRY_CAST(substr(upper(identifier || CAST(year AS VARCHAR)), 3, 2) AS INTEGER) AS number,
    'GIS_ARCHIVE' AS source, CAST(NULL AS TIMESTAMP) AS start_date, CAST(NULL AS TIMESTAMP) AS end_date
  FROM html_rows
)"""


@register("html_catalog", covers=("S5", "E5", "E6"), sql=S.with_ctes(HTML_SQL, body=f"SELECT {CAT_COLS} FROM html_catalog"))
def html_catalog(spark, sf_dir):
    return C.catalog_from_items(page_items(spark, sf_dir))


@register("catalog_union", covers=("J1", "U3", "O2"), sql=S.with_ctes(S.CATALOG_SQL, HTML_SQL, body=f"""
SELECT {CAT_COLS} FROM catalog WHERE line_no <> (SELECT min(line_no) FROM catalog)
UNION ALL
SELECT {CAT_COLS} FROM html_catalog h WHERE NOT EXISTS (
  SELECT 1 FROM catalog c WHERE c.nhc_code = h.nhc_code AND c.line_no <> (SELECT min(line_no) FROM catalog))"""))
def catalog_union(spark, sf_dir):
    merged = C.add_missing_codes(catalog(spark, sf_dir), C.catalog_from_items(page_items(spark, sf_dir)))
    return C.sort_catalog(merged).select(*CATALOG_COLUMNS)


# --- P9 / P10 / O4: storm lookups ---------------------------------------------------------

def lookup_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = S.table(spark, sf_dir, "customer").select("c_custkey")
    k = F.col("c_custkey")
    return c.select(
        k.alias("req_id"), (F.lit(1992) + k % 7).cast("int").alias("year"),
        F.when(k % 2 == 0, F.lit("al")).alias("basin"),
        F.when(k % 3 == 0, (k % 40 + 1)).cast("int").alias("number"),
        F.when(k % 5 == 4, F.lit(None)).when(k % 5 == 3, F.lit("name1[0-9]"))
        .otherwise(F.concat(F.lit("name"), (k % 97).cast("string"))).alias("name"),
    )


REQ_SQL = """
reqs AS (
  SELECT c_custkey AS req_id, CAST(1992 + c_custkey % 7 AS INTEGER) AS year,
    CASE WHEN c_custkey % 2 = 0 THEN 'al' END AS basin,
    CAST(CASE WHEN c_custkey % 3 = 0 THEN c_custkey % 40 + 1 END AS INTEGER) AS number,
    CASE WHEN c_custkey % 5 = 4 THEN NULL WHEN c_custkey % 5 = 3 THEN 'name1[0-9]'
         ELSE 'name' || CAST(c_custkey % 97 AS VARCHAR) END AS name
  FROM customer
),
cat_body AS (SELECT * FROM catalog WHERE line_no <> (SELECT min(line_no) FROM catalog))"""


@register("storm_lookup", covers=("P9", "O4"), sql=S.with_ctes(S.CATALOG_SQL, REQ_SQL, body="""
SELECT req_id, nhc_code, name, year, basin, number FROM (
  SELECT r.req_id, c.nhc_code, c.name, c.year, trim(c.basin) AS basin, c.number,
    row_number() OVER (PARTITION BY r.req_id ORDER BY c.year, c.number, c.basin, c.line_no) AS rn
  FROM cat_body c JOIN reqs r ON c.year = r.year
    AND (r.basin IS NULL OR contains(c.basin, upper(r.basin)))
    AND (r.number IS NULL OR c.number = r.number)
    AND (r.name IS NULL OR coalesce(regexp_full_match(c.name, upper(r.name)), false))
) WHERE rn = 1"""))
def storm_lookup(spark, sf_dir):
    return C.lookup_storms(catalog(spark, sf_dir), lookup_requests(spark, sf_dir))


@register("storm_requests", covers=("P9", "P2"), sql=S.with_ctes(S.CATALOG_SQL, REQ_SQL, """
asked AS (SELECT req_id, CASE WHEN req_id % 50 = 7 THEN NULL WHEN req_id % 50 = 8 THEN 1900 ELSE year END AS year, basin, number, name FROM reqs),
hit AS (
  SELECT r.req_id, c.nhc_code, c.name, c.year, trim(c.basin) AS basin, c.number,
    row_number() OVER (PARTITION BY r.req_id ORDER BY c.year, c.number, c.basin, c.line_no) AS rn
  FROM cat_body c JOIN asked r ON c.year = r.year
    AND (r.basin IS NULL OR contains(c.basin, upper(r.basin))) AND (r.number IS NULL OR c.number = r.number)
    AND (r.name IS NULL OR coalesce(regexp_full_match(c.name, upper(r.name)), false)))""", body="""
SELECT r.req_id, h.nhc_code, h.name, h.year, h.basin, h.number,
  CASE WHEN h.nhc_code IS NOT NULL THEN NULL WHEN r.year IS NULL THEN 'no year'
    WHEN NOT EXISTS (SELECT 1 FROM cat_body c WHERE c.year = r.year) THEN 'no storm in that year'
    WHEN r.name IS NOT NULL AND NOT EXISTS (SELECT 1 FROM (SELECT DISTINCT year, name FROM cat_body) c
      WHERE c.year = r.year AND regexp_full_match(c.name, upper(r.name))) THEN 'no such name in that year'
    ELSE 'other basin or number' END AS reason
FROM asked r LEFT JOIN (SELECT * FROM hit WHERE rn = 1) h USING (req_id)"""))
def storm_requests(spark, sf_dir):
    """The requests of ``storm_lookup``, some without a year or of a year without storms; each with its storm or a reason."""
    k = F.col("req_id") % 50
    asked = lookup_requests(spark, sf_dir).withColumn("year", F.when(k == 8, 1900).when(k != 7, F.col("year")))
    return C.storm_requests(catalog(spark, sf_dir), asked)


# --- P10: codes in any letter case, with blanks; some name no storm ----------------------
@register("storm_by_code", covers=("P10",), sql=S.with_ctes(S.CATALOG_SQL, """
coded AS (SELECT o_custkey, CASE o_custkey % 3 WHEN 0 THEN 'al' WHEN 1 THEN 'Ep' ELSE ' XX' END || lpad(CAST(o_custkey % 45 AS VARCHAR), 2, '0')
    || CAST(year(o_orderdate) AS VARCHAR) || ' ' AS code, o_orderkey FROM orders),
firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY nhc_code ORDER BY year, number, basin, line_no) AS rn
  FROM catalog WHERE line_no <> (SELECT min(line_no) FROM catalog)) WHERE rn = 1)""", body="""
SELECT o_orderkey AS req_id, nhc_code, f.name, f.class, f.year, f.number, f.start_date FROM coded LEFT JOIN firsts f ON f.nhc_code = upper(trim(code))"""))
def storm_by_code(spark, sf_dir):
    k = F.col("o_custkey")
    code = F.concat(F.when(k % 3 == 0, "al").when(k % 3 == 1, "Ep").otherwise(" XX"), F.lpad((k % 45).cast("string"), 2, "0"),
                    F.year("o_orderdate").cast("string"), F.lit(" "))
    asked = S.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("req_id"), code.alias("code"))
    cat = catalog(spark, sf_dir)
    first = cat.groupBy("nhc_code").agg(F.min_by(F.struct(*[c for c in cat.columns if c != "nhc_code"]), F.struct(*C.catalog_order(cat))).alias("s"))
    return C.storm_by_code(first.select("nhc_code", "s.*"), asked).select("req_id", "nhc_code", "name", "class", "year", "number", "start_date")


@register("storm_by_name_year", covers=("P10", "P9"), sql=S.with_ctes(S.CATALOG_SQL, REQ_SQL, body="""
SELECT req_id, nhc_code FROM (
  SELECT r.req_id, c.nhc_code, row_number() OVER (PARTITION BY r.req_id ORDER BY c.year, c.number, c.basin, c.line_no) AS rn
  FROM (SELECT * REPLACE (translate(name, '0123456789', 'ABCDEFGHIJ') AS name) FROM cat_body) c
  JOIN (SELECT c_custkey AS req_id, upper(translate('name' || CAST(c_custkey % 97 AS VARCHAR), '0123456789', 'abcdefghij')) AS name,
          CAST(1992 + c_custkey % 7 AS INTEGER) AS year FROM customer) r
    ON c.year = r.year AND c.name = r.name
) WHERE rn = 1"""))
def storm_by_name_year(spark, sf_dir):
    # every customer asks for a storm; names of the surrogate carry digits, the "name + 4-digit year" form needs letters
    k = F.col("c_custkey")
    name = F.concat(F.lit("name"), (k % 97).cast("string"))
    req = S.table(spark, sf_dir, "customer").select(k.alias("req_id"), name.alias("name"), (F.lit(1992) + k % 7).alias("year"))
    text = F.concat(F.translate("name", "0123456789", "abcdefghij"), F.col("year").cast("string"))
    parsed = req.select("req_id", C.parse_name_year(text).alias("p")).select(
        "req_id", F.col("p.year").alias("year"), F.col("p.name").alias("name"),
        F.lit(None).cast("string").alias("basin"), F.lit(None).cast("int").alias("number"))
    cat = catalog(spark, sf_dir).withColumn("name", F.translate("name", "0123456789", "ABCDEFGHIJ"))
    return C.lookup_storms(cat, parsed).select("req_id", "nhc_code")


# --- P20: storm status ---------------------------------------------------------------------

@register("storm_status", covers=("P20",), sql=S.with_ctes(S.CATALOG_SQL, body="""
SELECT nhc_code, CASE WHEN (end_date IS NULL OR TIMESTAMP '1997-06-01 00:00:00' - end_date < INTERVAL 1 DAY)
  AND NOT coalesce(TIMESTAMP '1997-06-01 00:00:00' - start_date > INTERVAL 30 DAY, false) THEN 'REALTIME' ELSE 'HISTORICAL' END AS status
FROM catalog WHERE line_no <> (SELECT min(line_no) FROM catalog)"""))
def storm_status_q(spark, sf_dir):
    cat = catalog(spark, sf_dir)
    as_of = F.lit("1997-06-01 00:00:00").cast("timestamp_ntz")
    return cat.select("nhc_code", storm_status(F.col("start_date"), F.col("end_date"), as_of).alias("status"))


# --- S11 / S12 / U4: deck listings and deck paths ------------------------------------------

@register("deck_listing", covers=("S11", "U4"), sql=S.with_ctes(S.CATALOG_SQL, body="""
SELECT filename, file_deck FROM (
  SELECT d || lower(nhc_code) || '.dat' AS filename, d AS file_deck
  FROM catalog, (SELECT unnest(['a', 'b', 'f']) AS d))
WHERE file_deck = 'b' AND contains(filename, '1995')"""))
def deck_listing(spark, sf_dir):
    codes = catalog_codes(spark, sf_dir)  # listing of every deck of every catalog storm
    listing = codes.select(F.explode(F.array(F.lit("a"), F.lit("b"), F.lit("f"))).alias("d"), "nhc_code").select(
        F.concat("d", F.lower("nhc_code"), F.lit(".dat")).alias("filename"))
    return deck_catalog(listing, file_deck="b", year=1995).select("filename", "file_deck")


def catalog_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = S.catalog_csv_lines(spark, sf_dir)
    return C.parse_catalog_lines(lines).select(F.trim("nhc_code").alias("nhc_code"))


@register("deck_paths", covers=("S12",), sql=S.with_ctes(S.CATALOG_SQL, body="""
SELECT nhc_code, CASE WHEN source = 'ARCHIVE' THEN 'archive/' || substr(nhc_code, 5, 4) || '/a' || lower(nhc_code) || '.dat.gz'
                      ELSE 'aid_public/a' || lower(nhc_code) || '.dat.gz' END AS a_path,
  CASE WHEN source = 'ARCHIVE' THEN 'archive/' || substr(nhc_code, 5, 4) || '/b' || lower(nhc_code) || '.dat.gz'
       ELSE 'btk/b' || lower(nhc_code) || '.dat' END AS b_path
FROM catalog WHERE line_no <> (SELECT min(line_no) FROM catalog)"""))
def deck_paths(spark, sf_dir):
    cat = catalog(spark, sf_dir)
    mode = F.when(F.col("source") == "ARCHIVE", F.lit("ARCHIVE")).otherwise(F.lit("aid_public"))
    return cat.select("nhc_code", deck_path(F.col("nhc_code"), F.lit("a"), mode).alias("a_path"),
                      deck_path(F.col("nhc_code"), F.lit("b"), mode).alias("b_path"))
