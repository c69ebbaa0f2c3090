"""Storm <-> flood-event correlation.

J2 matches an event to a storm when a storm name occurs in the event name as a
whole word (case-insensitive) and a storm of the event's year has a name that
contains it; of several matches the alphabetically last name and then the last
storm in catalog order wins.  Both steps are exact equi-joins:

* the event name is cut into its word-bounded substrings (every span from the
  start of one word to the end of a later word, separators kept), which equal a
  storm name exactly when the name occurs there with word boundaries;
* storm names are cut into all their substrings, so "name contains word" is an
  equality on (year, substring); of these only storm names are kept, and of all storms of
  a year that contain one only the winner, before any event is joined.

Both cut sets are made once a year and name, not once a storm or event, and are bounded by the length of one
name; an event's name meets one storm per name in it, never all storms of its year.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cyclonespark.schema import FLOOD_EVENT_COLUMNS


def word_spans(text: Column) -> Column:
    """All substrings of ``text`` that start at a word start and end at a word end."""
    pieces = F.regexp_extract_all(text, F.lit(r"(\w+|\W+)"), 1)
    idx = F.sequence(F.lit(1), F.greatest(F.size(pieces), F.lit(1)))
    words = F.filter(idx, lambda i: F.element_at(pieces, i).rlike(r"^\w"))
    return F.flatten(F.transform(words, lambda a: F.transform(
        F.filter(words, lambda b: b >= a),
        lambda b: F.array_join(F.slice(pieces, a, b - a + 1), ""))))


def substrings(text: Column) -> Column:
    """Every non-empty substring of ``text``."""
    n = F.length(text)
    starts = F.sequence(F.lit(1), F.greatest(n, F.lit(1)))
    return F.flatten(F.transform(starts, lambda s: F.transform(
        F.sequence(F.lit(1), F.greatest(n - s + 1, F.lit(1))), lambda ln: F.substring(text, s, ln))))


def flood_storms(events: DataFrame, catalog: DataFrame, year=None) -> DataFrame:
    """J2 + O3: hurricane flood events with the NHC storm they name, one row per event."""
    ev = events.filter(F.col("event_type") == "HURRICANE")
    if year is not None:
        years = [year] if isinstance(year, int) else list(year)
        ev = ev.filter(F.col("year").isin(years))
    asked = ev.select("year", "name").distinct()
    # one storm a year and name, the last in catalog order, before names are cut; the long maximum keeps the first step a hash aggregation
    order = [c for c in ("year", "number", "basin", "line_no") if c in catalog.columns]
    same = ["nhc_code", "name", *[c for c in ("year", "number", "basin") if c in catalog.columns]]
    last = F.max("line_no" if "line_no" in catalog.columns else F.lit(0)).alias("line_no")
    pick = F.struct(*order) if order else F.col("nhc_code")
    per_name = catalog.groupBy(*same).agg(last).groupBy("year", "name").agg(
        F.max(pick).alias("_pick"), F.max_by(F.struct("nhc_code", F.col("name").alias("nhc_name")), pick).alias("m"))
    storms = per_name.join(asked.select("year").distinct(), "year", "left_semi")
    names = (storms.select(F.trim("name").alias("sn")).filter(F.col("sn").isNotNull() & (F.col("sn") != ""))
             .groupBy(F.upper("sn").alias("_key")).agg(F.max("sn").alias("sn")))
    subs = storms.select("year", "_pick", "m", F.explode(F.array_distinct(substrings(F.upper("name")))).alias("_key"))
    # one storm a year and word: the last in catalog order of those whose name contains it
    winners = subs.join(names, "_key").groupBy("year", "_key").agg(F.max_by("m", "_pick").alias("m"), F.first("sn").alias("sn"))
    spans = asked.select("year", "name", F.explode(F.array_distinct(F.transform(word_spans(F.col("name")), lambda x: F.upper(x)))).alias("_key"))
    named = spans.join(winners, ["year", "_key"]).groupBy("year", "name").agg(F.max("sn").alias("sn"), F.max_by("m", "sn").alias("m"))
    best = ev.select("usgs_id", "year", "name").join(named, ["year", "name"]).groupBy("usgs_id").agg(F.max_by("m", "sn").alias("m"))
    out = ev.join(best, "usgs_id").select(
        F.col("m.nhc_code").alias("nhc_code"), "usgs_id", F.col("name").alias("usgs_name"), "year",
        F.col("m.nhc_name").alias("nhc_name"), *[c for c in FLOOD_EVENT_COLUMNS if c not in ("usgs_id", "name", "year")])
    return out


def storm_flood_event(codes: DataFrame, flood: DataFrame) -> DataFrame:
    """Flood-event id of each storm code (NULL when none; lowest id when several)."""
    ids = flood.groupBy("nhc_code").agg(F.min("usgs_id").alias("usgs_id"))
    return codes.join(ids, "nhc_code", "left")


def storm_from_event(events: DataFrame, flood: DataFrame) -> DataFrame:
    """Storm of a flood event, inheriting the event's start / end as requested bounds."""
    return flood.select("usgs_id", "nhc_code", "nhc_name").join(
        events.select("usgs_id", "start_date", "end_date"), "usgs_id")


def storm_high_water_marks(flood: DataFrame, hwm: DataFrame) -> DataFrame:
    """(storm -> event -> marks) as two equi-joins."""
    return flood.select("nhc_code", F.col("usgs_id").alias("event_id")).join(hwm, "event_id")
