"""Track-level aggregates, keys and record numbering.

A *track* is one (storm, advisory, forecast cycle).  Nothing here collects a
track or a storm into an array: points stay rows with their record order, and
lengths, counts and bounds are partial-aggregated sums / min / max.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cyclonespark.functions.geodesy import with_inverse
from cyclonespark.operators.ordering import epoch_seconds, row_key
from cyclonespark.schema import QUADRANT_COLUMNS, TRACK_KEY


def track_points(track: DataFrame) -> DataFrame:
    """The distinct points of each track in record order (first occurrence kept)."""
    w = Window.partitionBy(*TRACK_KEY, "longitude", "latitude").orderBy("record_time", "advisory", "line_no")
    pts = (track.select(*TRACK_KEY, "record_time", "line_no", "longitude", "latitude")
           .withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn"))
    ws = Window.partitionBy(*TRACK_KEY).orderBy("record_time", "line_no")
    return pts.withColumn("point_seq", F.row_number().over(ws))


def track_legs(track: DataFrame) -> DataFrame:
    """Consecutive legs of every track's distinct points, with geodesic length (m)."""
    pts = track_points(track)
    w = Window.partitionBy(*TRACK_KEY).orderBy("point_seq")
    nxt = F.lead(F.struct(F.col("longitude").alias("lon"), F.col("latitude").alias("lat")), 1).over(w)
    legs = pts.withColumn("_next", nxt).filter(F.col("_next").isNotNull()).select(
        *TRACK_KEY, "point_seq",
        F.col("longitude").alias("lon1"), F.col("latitude").alias("lat1"),
        F.col("_next.lon").alias("lon2"), F.col("_next.lat").alias("lat2"),
    )
    legs = with_inverse(legs, "lon1", "lat1", "lon2", "lat2", out="_leg")
    return legs.withColumn("leg_m", F.col("_leg.distance")).drop("_leg")


def track_length(track: DataFrame) -> DataFrame:
    """A2: geodesic length of every track with at least two distinct points."""
    pts = track_points(track).groupBy(*TRACK_KEY).agg(F.count(F.lit(1)).alias("n_points"))
    lengths = track_legs(track).groupBy(*TRACK_KEY).agg(F.sum("leg_m").alias("length_m"))
    return pts.filter("n_points >= 2").join(lengths, TRACK_KEY, "left")


def track_summary(track: DataFrame) -> DataFrame:
    """A11 (+A3, A10): per storm rows, advisories, cycles, unique times, length and duration."""
    lengths = track_length(track).groupBy("storm_id").agg(F.sum("length_m").alias("length_m"))
    base = track.groupBy("storm_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct("advisory").alias("n_advisories"),
        F.countDistinct("advisory", "track_start_time").alias("n_tracks"),
        F.countDistinct("datetime").alias("n_times"),
        ((epoch_seconds(F.max_by("datetime", row_key())) - epoch_seconds(F.min_by("datetime", row_key()))) / 3600.0)
        .alias("duration_h"),
    )
    return base.join(lengths, "storm_id", "left")


def storm_name(track: DataFrame, catalog: DataFrame | None = None) -> DataFrame:
    """A1: most frequent name of each storm (ties: first seen); blank -> catalog name lower-cased."""
    counts = track.groupBy("storm_id", "name").agg(F.count(F.lit(1)).alias("_n"), F.min(row_key()).alias("_first"))
    # a missing name is no name, but a storm without any stays
    rank = F.struct(F.col("name").isNull().alias("none"), (-F.col("_n")).alias("n"), F.col("_first").alias("f"))
    best = counts.groupBy("storm_id").agg(F.min_by("name", rank).alias("name"))
    if catalog is not None:
        cat = catalog.select(F.col("nhc_code").alias("storm_id"), F.lower("name").alias("_cat"))
        best = best.join(cat, "storm_id", "left").select(
            "storm_id",
            F.when(F.trim(F.coalesce("name", F.lit(""))) == "", F.col("_cat")).otherwise(F.col("name")).alias("name"),
        )
    return best


def storm_attributes(track: DataFrame) -> DataFrame:
    """A4: basin, number and year of the first record; storm code from the last record."""
    first = F.min_by(F.struct("basin", "storm_number", "datetime"), row_key())
    last = F.max_by(F.struct("basin", "storm_number", "datetime"), row_key())
    return track.groupBy("storm_id").agg(first.alias("_f"), last.alias("_l")).select(
        "storm_id",
        F.col("_f.basin").alias("basin"),
        F.col("_f.storm_number").alias("storm_number"),
        F.year("_f.datetime").alias("year"),
        F.upper(F.concat(F.col("_l.basin"), F.col("_l.storm_number"), F.year("_l.datetime").cast("string"))).alias("nhc_code"),
    )


def mean_quadrant_radius(cols=QUADRANT_COLUMNS):
    """Row-wise mean of the quadrant radii, zeros and NULLs skipped (NULL if none)."""
    arr = F.filter(F.array(*[F.col(c) for c in cols]), lambda x: x.isNotNull() & (x != 0))
    return F.when(F.size(arr) > 0, F.aggregate(arr, F.lit(0.0), lambda a, x: a + x) / F.size(arr))


def max_quadrant_radius(cols=QUADRANT_COLUMNS):
    """Row-wise max of the quadrant radii with zeros as missing."""
    return F.greatest(*[F.when(F.col(c) != 0, F.col(c)) for c in cols])


def strongest_isotach_radius(track: DataFrame) -> DataFrame:
    """At every (track, valid time) the max quadrant radius of the last record (strongest isotach)."""
    return track.groupBy(*TRACK_KEY, "datetime").agg(
        F.max_by(max_quadrant_radius(), row_key()).alias("max_isotach_radius"))


def record_numbers(track: DataFrame) -> DataFrame:
    """Dense rank of the valid time within each storm, over all selected records.

    Ranked on the distinct (storm, time) pairs - a tiny, pre-aggregated table - and
    joined back, so no window ever holds a whole storm's records.
    """
    times = track.select("storm_id", "datetime").distinct()
    ranked = times.withColumn("record_number", F.dense_rank().over(Window.partitionBy("storm_id").orderBy("datetime")))
    return track.join(ranked, ["storm_id", "datetime"], "left")


def hours_since_first(track: DataFrame) -> DataFrame:
    """Hours from the storm's first record (in record order) to each record."""
    first = track.groupBy("storm_id").agg(F.min_by("datetime", row_key()).alias("_t0"))
    return track.join(first, "storm_id", "left").withColumn(
        "hours_since_start", ((epoch_seconds(F.col("datetime")) - epoch_seconds(F.col("_t0"))) / 3600).cast("int")
    ).drop("_t0")


def separate_tracks(track: DataFrame) -> DataFrame:
    """Tracks are separated by the key (storm, advisory, track_start_time).

    The original repeats the whole BEST set under every distinct BEST start time;
    that repetition is an all-pairs product within a group and is not rebuilt:
    BEST rows keep one start time (the storm's earliest) and form one track.
    """
    return track.withColumn("track_key", F.struct(*[F.col(c) for c in TRACK_KEY]))


def combine_order(track: DataFrame) -> DataFrame:
    """Order key of concatenated tracks: advisory by first appearance, then cycle, then record."""
    first = track.groupBy("storm_id", "advisory").agg(F.min(row_key()).alias("_adv_first"))
    return track.join(first, ["storm_id", "advisory"], "left").withColumn(
        "combine_key", F.struct(F.col("_adv_first"), F.col("track_start_time"), row_key())
    ).drop("_adv_first")


def first_time_at_or_after(track: DataFrame, end_col: str = "end_date") -> DataFrame:
    """Per storm, the first record time >= the requested end."""
    return track.groupBy("storm_id").agg(
        F.min(F.when(F.col("datetime") >= F.col(end_col), F.col("datetime"))).alias("file_end_date"))


def frames_equal(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: ``equal`` is true when both multiset differences are empty."""
    a = left.exceptAll(right).select(F.lit(1).alias("x"))
    b = right.exceptAll(left).select(F.lit(1).alias("x"))
    n = a.unionByName(b).agg(F.count("x").alias("n_differences"))
    return n.select((F.col("n_differences") == 0).alias("equal"), "n_differences")


def track_bounds(points: DataFrame, key=("storm_id",)) -> DataFrame:
    """Bounding box of point sets."""
    return points.groupBy(*key).agg(
        F.min("longitude").alias("min_lon"), F.min("latitude").alias("min_lat"),
        F.max("longitude").alias("max_lon"), F.max("latitude").alias("max_lat"),
    )
