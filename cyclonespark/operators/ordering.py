"""Row order, forecast-cycle keys and valid times.

The record order of a storm is the stable sort by (record time, advisory) with
ties in file order.  It is carried as the three ordering columns
``ORDER_COLUMNS`` rather than a storm-wide ``row_number`` so that no operator
needs a whole storm in one task just to number its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ORDER_COLUMNS = ["record_time", "advisory", "line_no"]


def row_order() -> list[Column]:
    return [F.col(c).asc() for c in ORDER_COLUMNS]


def row_key() -> Column:
    """Comparable struct giving the record order (for ``min_by`` / ``max_by``)."""
    return F.struct(*[F.col(c) for c in ORDER_COLUMNS])


def add_hours(ts: Column, hours: Column) -> Column:
    return ts + F.make_dt_interval(F.lit(0), hours.cast("int"), F.lit(0), F.lit(0))


def epoch_seconds(ts: Column) -> Column:
    return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)


def order_track(decks: DataFrame, best_start: str = "earliest") -> DataFrame:
    """Add ``track_start_time`` and the valid ``datetime`` to parsed deck records.

    * non-BEST rows: cycle start = record time; valid time = record time + TAU hours.
    * BEST rows: valid time = record time; cycle start = earliest BEST time of the
      storm (``best_start="earliest"``) or the row's own time (``"row"``).
    """
    best = F.col("advisory") == "BEST"
    if best_start == "earliest":
        w = Window.partitionBy("storm_id", "advisory")
        best_start_col = F.min("record_time").over(w)
    else:
        best_start_col = F.col("record_time")
    return (
        decks.withColumn("track_start_time", F.when(best, best_start_col).otherwise(F.col("record_time")))
        .withColumn("datetime", F.when(best, F.col("record_time"))
                    .otherwise(add_hours(F.col("record_time"), F.coalesce(F.col("forecast_hours"), F.lit(0)))))
    )


def storm_bounds(track: DataFrame) -> DataFrame:
    """Default bounds per storm = valid time of the first / last record in record order."""
    return track.groupBy("storm_id").agg(
        F.min_by("datetime", row_key()).alias("start_date"),
        F.max_by("datetime", row_key()).alias("end_date"),
    )


def track_rows(track: DataFrame) -> DataFrame:
    """``track_row``, each record's place (from 0) in its track (storm, advisory, cycle start).

    BEST records go by valid time, forecast records by their place in the deck; ties in deck order.
    """
    by_time = F.when(F.col("advisory") == "BEST", F.col("datetime"))
    w = Window.partitionBy("storm_id", "advisory", "track_start_time").orderBy(by_time, *ORDER_COLUMNS)
    return track.withColumn("track_row", F.row_number().over(w) - 1)
