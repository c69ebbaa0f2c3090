"""Registered station queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cyclonespark.operators.geometry import box_ring
from cyclonespark.plans import surrogates as S
from cyclonespark.plans.registry import register
from cyclonespark.sources import stations as ST

BOX = (-90.05, 15.05, -70.05, 35.05)
BOX_SQL = "x > -90.05 AND x < -70.05 AND y > 15.05 AND y < 35.05"
WINDOW = ("1995-01-01 00:00:00", "1995-12-31 23:59:59")


def region(spark: SparkSession) -> DataFrame:
    return spark.range(1).select(F.lit(1).alias("region_id"), box_ring(*BOX).alias("ring"))


def region_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ST.stations_in_region(S.stations(spark, sf_dir), region(spark))


@register("stations_in_region", covers=("J5", "G7"), sql=S.with_ctes(S.STATIONS_SQL, body=f"""
SELECT nos_id, nws_id, x, y, status FROM stations WHERE {BOX_SQL}"""))
def stations_in_region(spark, sf_dir):
    return region_stations(spark, sf_dir).select("nos_id", "nws_id", "x", "y", "status")


@register("active_stations_in_region", covers=("J5",), sql=S.with_ctes(S.STATIONS_SQL, body=f"""
SELECT nos_id FROM stations WHERE {BOX_SQL} AND status = 'active'"""))
def active_stations_in_region(spark, sf_dir):
    return ST.stations_in_region(S.stations(spark, sf_dir), region(spark), status="active").select("nos_id")


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.lit(WINDOW[0]).cast("timestamp_ntz")
    end = F.lit(WINDOW[1]).cast("timestamp_ntz")
    return ST.station_series(region_stations(spark, sf_dir), S.station_products(spark, sf_dir), start, end)


SERIES_SQL = f"""
ser AS (
  SELECT p.nos_id, p.t, s.nws_id, s.x, s.y, p.v, p.s, p.f, p.q FROM product p
  JOIN (SELECT * FROM stations WHERE {BOX_SQL}) s USING (nos_id)
  WHERE p.t BETWEEN TIMESTAMP '{WINDOW[0]}' AND TIMESTAMP '{WINDOW[1]}' AND p.datum = 'MSL'
)"""


@register("station_series", covers=("S10", "J6", "J7", "E10"), sql=S.with_ctes(S.STATIONS_SQL, S.PRODUCT_SQL, SERIES_SQL, body="""
SELECT nos_id, t, dense_rank() OVER (ORDER BY t) AS time_index, nws_id, x, y, v, s, f, q FROM ser"""))
def station_series(spark, sf_dir):
    return series(spark, sf_dir)


@register("station_maximum", covers=("A9",), sql=S.with_ctes(S.STATIONS_SQL, S.PRODUCT_SQL, SERIES_SQL, body="""
SELECT nos_id, max(v) AS max_v FROM ser GROUP BY nos_id"""))
def station_maximum(spark, sf_dir):
    return ST.station_maximum(series(spark, sf_dir))


@register("station_bounds", covers=("A13",), sql=S.with_ctes(S.STATIONS_SQL, body=f"""
SELECT min(x) AS min_lon, min(y) AS min_lat, max(x) AS max_lon, max(y) AS max_lat FROM stations WHERE {BOX_SQL}"""))
def station_bounds(spark, sf_dir):
    from cyclonespark.operators.tracks import track_bounds

    pts = region_stations(spark, sf_dir).select(F.col("x").alias("longitude"), F.col("y").alias("latitude"))
    return track_bounds(pts.withColumn("_k", F.lit(1)), key=("_k",)).drop("_k")
