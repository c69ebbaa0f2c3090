"""Flood-survey sources: events (S6), high-water marks (S7, S8), files and sensors.

Inputs are JSON / CSV files (or DataFrames with the same raw fields); decoding of
enumerations is a literal map lookup inside the JVM (J11).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cyclonespark.schema import (
    DEPLOYMENT_TYPES,
    EVENT_STATUSES,
    EVENT_TYPES,
    FILE_TYPES,
    FLOOD_EVENT_COLUMNS,
    HWM_COLUMNS,
    HWM_ENVIRONMENTS,
    HWM_QUALITIES,
    HWM_TYPES,
    SENSOR_TYPES,
    hwm_schema,
)

# FIXED VALUES: field names of the event service
EVENT_RENAMES = {
    "event_id": "usgs_id",
    "event_name": "name",
    "event_start_date": "start_date",
    "event_end_date": "end_date",
    "event_description": "description",
    "event_coordinator": "coordinator",
}


def iso_timestamp(text: Column) -> Column:
    """ISO-8601 text (date, 'T' or blank separator, optional fraction) -> TIMESTAMP_NTZ; bad text -> NULL."""
    pat = r"^\s*(\d{4})-(\d{2})-(\d{2})(?:[T ](\d{2}):(\d{2})(?::(\d{2}(?:\.\d+)?))?)?"
    part = lambda i: F.regexp_extract(text, pat, i)
    ok = text.rlike(pat)
    sec = F.when(part(6) == "", F.lit("0")).otherwise(part(6)).cast("decimal(16,6)")
    hh = F.when(part(4) == "", F.lit("0")).otherwise(part(4)).cast("int")
    mi = F.when(part(5) == "", F.lit("0")).otherwise(part(5)).cast("int")
    return F.when(ok, F.try_make_timestamp_ntz(part(1).cast("int"), part(2).cast("int"), part(3).cast("int"), hh, mi, sec))


def _as_timestamp(c: Column, dtype: str) -> Column:
    return c if dtype.startswith("timestamp") else iso_timestamp(c.cast("string"))


def decode(value: Column, mapping: dict[int, str], strict: bool = False) -> Column:
    """Id -> enumeration name; unknown ids are an error (strict) or NULL."""
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    name = F.element_at(m, value.cast("int")) if not strict else F.coalesce(
        F.element_at(m, value.cast("int")), F.raise_error(F.concat(F.lit("unknown id "), value.cast("string"))).cast("string"))
    return name


# ---------------------------------------------------------------------------------------
# records as JSON text, one a line
# ---------------------------------------------------------------------------------------

# FIXED VALUES: fields of the services' event, file and sensor records
FLOOD_EVENT_RECORD = ("event_id long, event_name string, event_description string, event_type_id long, event_status_id long, event_coordinator long, "
                      "instruments string, last_updated string, last_updated_by double, event_start_date string, event_end_date string")
FILE_RECORD = "file_id long, filetype_id long, name string, event_id long"
SENSOR_RECORD = "instrument_id long, sensor_type_id long, deployment_type_id long, event_id long, location_description string"


def _ddl(schema) -> str:
    return schema if isinstance(schema, str) else ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def json_records(lines: DataFrame, schema, text: str = "line") -> tuple[DataFrame, DataFrame]:
    """The records of ``lines`` that fit ``schema`` (a DDL string or StructType), and a quarantine table of the other lines.

    Records have the schema's columns, a missing field is NULL.  The quarantine keeps the columns of ``lines`` and
    a ``reason``: ``empty``, ``no record`` (not a JSON object) or ``wrong type`` (a value that its column
    cannot hold).  Both come from one projection over the lines; no line is lost and none stops the job.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    blank = F.col(text).isNull() | (F.trim(text) == "")
    is_object = F.get_json_object(text, "$").startswith("{")
    read = lines.withColumn("_r", F.from_json(text, f"{_ddl(schema)}, _corrupt string", options))
    reason = F.when(blank, "empty").when(~F.coalesce(is_object, F.lit(False)), "no record").when(F.col("_r._corrupt").isNotNull(), "wrong type")
    read = read.withColumn("reason", reason)
    return read.filter("reason IS NULL").select("_r.*").drop("_corrupt"), read.filter("reason IS NOT NULL").drop("_r")


def read_json_lines(spark: SparkSession, paths: str | Sequence[str], schema) -> tuple[DataFrame, DataFrame]:
    """``json_records`` of text files (splittable; the quarantine names the file)."""
    lines = spark.read.text(paths).select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("path"))
    return json_records(lines, schema)


def read_flood_event_json(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    return spark.read.option("multiLine", "true").json(paths)


def flood_events(raw: DataFrame, year=None, event_type=None, event_status=None, strict: bool = False) -> DataFrame:
    """S6 + J11 + E9 + P12: renamed, typed, decoded flood events, optionally filtered."""
    dtypes = dict(raw.dtypes)
    df = raw.withColumnsRenamed({k: v for k, v in EVENT_RENAMES.items() if k in raw.columns})
    df = df.withColumns({
        "start_date": _as_timestamp(F.col("start_date"), dtypes.get("event_start_date", "string")),
        "end_date": _as_timestamp(F.col("end_date"), dtypes.get("event_end_date", "string")),
        "last_updated": _as_timestamp(F.col("last_updated"), dtypes.get("last_updated", "string")),
        "event_type": decode(F.col("event_type_id"), EVENT_TYPES, strict),
        "event_status": decode(F.col("event_status_id"), EVENT_STATUSES, strict),
    })
    df = df.withColumn("year", F.year("start_date"))
    df = df.select(*FLOOD_EVENT_COLUMNS)
    return filter_events(df, year=year, event_type=event_type, event_status=event_status)


def _as_list(v):
    return [v] if isinstance(v, (str, int)) else list(v)


def _ids(values, table: dict) -> list:
    """Stored values of enumeration members given by number, stored value or name (any case); others raise."""
    names = {name: key for key, name in table.items()}
    out = []
    for v in _as_list(values):
        text = str(v).strip()
        if text.isdigit():
            out.append(int(text))
        elif text.upper() in names:
            out.append(names[text.upper()])
        else:
            raise ValueError(f"{v!r} is neither an id nor a name; known are {table}")
    return out


def filter_events(events: DataFrame, year=None, event_type=None, event_status=None) -> DataFrame:
    """Type / status / year lists (None = no filter)."""
    if event_type is not None:
        events = events.filter(F.col("event_type").isin([str(x) for x in _as_list(event_type)]))
    if event_status is not None:
        events = events.filter(F.col("event_status").isin([str(x) for x in _as_list(event_status)]))
    if year is not None:
        events = events.filter(F.col("year").isin([int(x) for x in _as_list(year)]))
    return events


def event_by_name(events: DataFrame, requests: DataFrame) -> DataFrame:
    """P15 batch form: per requested (req_id, name, year?) the first event with exactly that name."""
    from pyspark.sql import Window

    e, r = events.alias("e"), requests.alias("r")
    cond = (F.col("e.name") == F.col("r.name")) & (F.col("r.year").isNull() | (F.col("e.year") == F.col("r.year")))
    w = Window.partitionBy("r.req_id").orderBy("e.usgs_id")
    return (e.join(r, cond).withColumn("_rn", F.row_number().over(w)).filter("_rn = 1")
            .select("r.req_id", F.col("e.usgs_id").alias("usgs_id")))


def event_requests(events: DataFrame, requests: DataFrame) -> DataFrame:
    """P15 with a report: every request (req_id, name, year?) with its first event, or the ``reason`` why there is none:
    ``no name`` (a NULL one), ``unknown name`` or ``not in that year``.

    One equi-join on the name and one partial aggregation; strict callers test ``reason`` in the
    result instead of counting in a pass of their own.
    """
    named = events.select("name", F.col("year").alias("_year"), "usgs_id")
    met = requests.select("req_id", "name", "year").join(named, "name", "left")
    fits = F.col("year").isNull() | (F.col("_year") == F.col("year"))
    out = met.groupBy("req_id", "name", "year").agg(F.min(F.when(fits, F.col("usgs_id"))).alias("usgs_id"), F.count("usgs_id").alias("_named"))
    reason = F.when(F.col("usgs_id").isNotNull(), F.lit(None)).when(F.col("name").isNull(), "no name").when(F.col("_named") == 0, "unknown name").otherwise("not in that year")
    return out.select("req_id", "usgs_id", reason.cast("string").alias("reason"))


# ---------------------------------------------------------------------------------------
# high-water marks
# ---------------------------------------------------------------------------------------

def read_hwm_json(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Explicit 49-column schema, so an empty input still has every column."""
    return spark.read.schema(hwm_schema()).option("multiLine", "true").json(paths)


def high_water_marks(raw: DataFrame) -> DataFrame:
    """Dates coerced (bad -> NULL), empty marker names -> NULL."""
    dtypes = dict(raw.dtypes)
    out = raw
    for c in ("survey_date", "flag_date"):
        if c in raw.columns:
            out = out.withColumn(c, _as_timestamp(F.col(c), dtypes[c]))
    if "markerName" in raw.columns:
        out = out.withColumn("markerName", F.when(F.length("markerName") == 0, F.lit(None)).otherwise(F.col("markerName")))
    return out


def read_hwm_csv(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """CSV exports keyed by ``hwm_id`` (header row, types inferred from the known columns)."""
    raw = spark.read.option("header", "true").csv(paths).withColumn("path", F.col("_metadata.file_path"))
    casts = {f.name: f.dataType for f in hwm_schema().fields if f.name in raw.columns}
    return raw.withColumns({c: F.col(c).try_cast(t) for c, t in casts.items() if c not in ("survey_date", "flag_date")})


def csv_event_ids(hwm_csv: DataFrame, events: DataFrame) -> DataFrame:
    """The event of each CSV file: first row's ``event_id``, else the event named by ``eventName``."""
    first = hwm_csv.groupBy("path").agg(F.min_by(F.struct(
        F.col("event_id") if "event_id" in hwm_csv.columns else F.lit(None).cast("long").alias("event_id"),
        F.col("eventName") if "eventName" in hwm_csv.columns else F.lit(None).cast("string").alias("eventName"),
    ), F.col("hwm_id")).alias("f"))
    named = events.groupBy("name").agg(F.min("usgs_id").alias("_by_name"))
    out = first.join(named, F.col("f.eventName") == F.col("name"), "left")
    return out.select("path", F.coalesce(F.col("f.event_id"), F.col("_by_name")).alias("usgs_id"))


HWM_FILTER_KEYS = ("event_id", "event_type", "event_status", "us_states", "us_counties", "hwm_type",
                   "quality", "environment", "survey_completed", "still_water")


def merge_hwm_query(previous: dict | None, **changes) -> dict:
    """A refined query keeps previous values wherever the new value is None."""
    merged = dict.fromkeys(HWM_FILTER_KEYS)
    if previous:
        merged.update({k: v for k, v in previous.items() if k in merged})
    merged.update({k: v for k, v in changes.items() if k in merged and v is not None})
    return merged


def filter_hwm(hwm: DataFrame, events: DataFrame | None = None, **query) -> DataFrame:
    """Conjunctive filter; lists mean IN, None and an empty list mean no filter.

    An event type or status without ``events`` cannot be applied and raises.

    Event type / status are attributes of the event: they are applied with a
    semi-join against the (small, pre-filtered) event table.
    """
    q = {k: None if isinstance(v, (list, tuple, set)) and not v else v for k, v in merge_hwm_query(None, **query).items()}
    if (q["event_type"] is not None or q["event_status"] is not None) and events is None:
        raise ValueError("event_type and event_status need the table of events")
    out = hwm
    if q["event_id"] is not None:
        out = out.filter(F.col("event_id").isin([int(x) for x in _as_list(q["event_id"])]))
    if q["us_states"] is not None:
        out = out.filter(F.col("stateName").isin(_as_list(q["us_states"])))
    if q["us_counties"] is not None:
        out = out.filter(F.col("countyName").isin(_as_list(q["us_counties"])))
    if q["hwm_type"] is not None:
        out = out.filter(F.col("hwm_type_id").isin(_ids(q["hwm_type"], HWM_TYPES)))
    if q["quality"] is not None:
        out = out.filter(F.col("hwm_quality_id").isin(_ids(q["quality"], HWM_QUALITIES)))
    if q["environment"] is not None:
        out = out.filter(F.col("hwm_environment").isin(_ids(q["environment"], HWM_ENVIRONMENTS)))
    if q["survey_completed"] is not None:
        out = out.filter(F.col("survey_date").isNotNull() == bool(q["survey_completed"]))
    if q["still_water"] is not None:
        out = out.filter(F.col("stillwater") == (1 if q["still_water"] else 0))
    if q["event_type"] is not None or q["event_status"] is not None:
        ev = filter_events(events, event_type=q["event_type"], event_status=q["event_status"]).select(
            F.col("usgs_id").alias("event_id"))
        out = out.join(ev, "event_id", "left_semi")
    return out


# ---------------------------------------------------------------------------------------
# files and sensors
# ---------------------------------------------------------------------------------------

def read_json_table(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    return spark.read.option("multiLine", "true").json(paths)


def filter_files(files: DataFrame, event_id=None, file_type=None) -> DataFrame:
    """Files of events and of types, each an id or an enumeration name, or a list of them."""
    if event_id is not None:
        files = files.filter(F.col("event_id").isin([int(x) for x in _as_list(event_id)]))
    if file_type is not None:
        files = files.filter(F.col("filetype_id").isin(_ids(file_type, FILE_TYPES)))
    return files


def filter_sensors(sensors: DataFrame, event_id=None, sensor_type=None, deployment_type=None) -> DataFrame:
    """Sensors of events, types and deployments, each an id or an enumeration name, or a list of them."""
    if event_id is not None:
        sensors = sensors.filter(F.col("event_id").isin([int(x) for x in _as_list(event_id)]))
    if sensor_type is not None:
        sensors = sensors.filter(F.col("sensor_type_id").isin(_ids(sensor_type, SENSOR_TYPES)))
    if deployment_type is not None:
        sensors = sensors.filter(F.col("deployment_type_id").isin(_ids(deployment_type, DEPLOYMENT_TYPES)))
    return sensors
