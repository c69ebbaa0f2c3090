"""Column layouts of the inputs and outputs.

All lists below are FIXED VALUES of the ATCF / fort.22 text formats and of the
flood-survey tables; they must stay exactly as written (order matters).
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- FIXED VALUES: ATCF a/b-deck positional fields (28 + tail), in file order -------------
ATCF_COLUMNS = [
    "basin",                          # BASIN
    "storm_number",                   # CY
    "datetime",                       # YYYYMMDDHH
    "advisory_number",                # TECHNUM/MIN
    "advisory",                       # TECH
    "forecast_hours",                 # TAU
    "latitude",                       # LatN/S
    "longitude",                      # LonE/W
    "max_sustained_wind_speed",       # VMAX
    "central_pressure",               # MSLP
    "development_level",              # TY
    "isotach_radius",                 # RAD
    "isotach_quadrant_code",          # WINDCODE
    "isotach_radius_for_NEQ",         # RAD1
    "isotach_radius_for_SEQ",         # RAD2
    "isotach_radius_for_SWQ",         # RAD3
    "isotach_radius_for_NWQ",         # RAD4
    "background_pressure",            # RADP
    "radius_of_last_closed_isobar",   # RRP
    "radius_of_maximum_winds",        # MRD
    "gust_speed",                     # GUSTS
    "eye_diameter",                   # EYE
    "subregion_code",                 # SUBREGION
    "maximum_wave_height",            # MAXSEAS
    "forecaster_initials",            # INITIALS
    "direction",                      # DIR
    "speed",                          # SPEED
    "name",                           # STORMNAME
    "extra_values",                   # USERDEFINED (tail, unsplit)
]

# --- FIXED VALUES: extended a-deck tail fields ------------------------------------------
EXTRA_ATCF_COLUMNS = [
    "depth_code",
    "isowave",
    "isowave_quadrant_code",
    "isowave_radius_for_NEQ",
    "isowave_radius_for_SEQ",
    "isowave_radius_for_SWQ",
    "isowave_radius_for_NWQ",
    "extra_values",
]

# --- FIXED VALUES: fort.22 tail fields --------------------------------------------------
FORT22_COLUMNS = [
    "record_number",
    "num_isotachs",
    "isotach_select_1",
    "isotach_select_2",
    "isotach_select_3",
    "isotach_select_4",
    "radius_of_maximum_winds_quadrant_1",
    "radius_of_maximum_winds_quadrant_2",
    "radius_of_maximum_winds_quadrant_3",
    "radius_of_maximum_winds_quadrant_4",
    "holland_b",
    "holland_b_quadrant_1",
    "holland_b_quadrant_2",
    "holland_b_quadrant_3",
    "holland_b_quadrant_4",
    "max_sustained_wind_speed_1",
    "max_sustained_wind_speed_2",
    "max_sustained_wind_speed_3",
    "max_sustained_wind_speed_4",
]

# --- FIXED VALUES: fields parsed as numbers (blank -> NULL) -----------------------------
NUMERIC_COLUMNS = [
    "max_sustained_wind_speed",
    "central_pressure",
    "isotach_radius",
    "isotach_radius_for_NEQ",
    "isotach_radius_for_SEQ",
    "isotach_radius_for_SWQ",
    "isotach_radius_for_NWQ",
    "background_pressure",
    "radius_of_last_closed_isobar",
    "radius_of_maximum_winds",
    "gust_speed",
    "eye_diameter",
    "maximum_wave_height",
    "direction",
    "speed",
    "isowave",
    "isowave_radius_for_NEQ",
    "isowave_radius_for_SEQ",
    "isowave_radius_for_SWQ",
    "isowave_radius_for_NWQ",
]

QUADRANT_COLUMNS = [
    "isotach_radius_for_NEQ",
    "isotach_radius_for_SEQ",
    "isotach_radius_for_SWQ",
    "isotach_radius_for_NWQ",
]

# --- FIXED VALUES: ATCF export widths (left pad; never truncate) ------------------------
ATCF_WIDTHS = {
    "basin": 2,
    "storm_number": 3,
    "datetime": 11,
    "advisory_number": 3,
    "advisory": 5,
    "forecast_hours": 4,
    "latitude": 5,
    "longitude": 6,
    "max_sustained_wind_speed": 4,
    "central_pressure": 5,
    "development_level": 3,
    "isotach_radius": 4,
    "isotach_quadrant_code": 4,
    "isotach_radius_for_NEQ": 5,
    "isotach_radius_for_SEQ": 5,
    "isotach_radius_for_SWQ": 5,
    "isotach_radius_for_NWQ": 5,
    "background_pressure": 5,
    "radius_of_last_closed_isobar": 5,
    "radius_of_maximum_winds": 4,
    "gust_speed": 4,
    "eye_diameter": 4,
    "subregion_code": 4,
    "maximum_wave_height": 4,
    "forecaster_initials": 4,
    "direction": 4,
    "speed": 4,
    "name": 11,
    "depth_code": 2,
    "isowave": 3,
    "isowave_quadrant_code": 4,
    "isowave_radius_for_NEQ": 5,
    "isowave_radius_for_SEQ": 5,
    "isowave_radius_for_SWQ": 5,
    "isowave_radius_for_NWQ": 5,
    "record_number": 4,
}

# --- FIXED VALUES: enumerations ---------------------------------------------------------
FILE_DECKS = ["a", "b", "f"]                       # advisory, best track, fixes
ATCF_MODES = {"HISTORICAL": "ARCHIVE", "REALTIME": "aid_public"}
ADVISORIES = ["BEST", "OFCL", "OFCP", "HMON", "CARQ", "HWRF"]
EVENT_TYPES = {1: "RIVERINE_FLOOD", 2: "HURRICANE", 3: "DROUGHT", 4: "NOREASTER", 6: "TSUNAMI", 7: "TYPHOON"}
EVENT_STATUSES = {1: "ACTIVE", 2: "COMPLETED"}
HWM_TYPES = {
    1: "MUD", 2: "DEBRIS", 3: "VEGETATION_LINE", 4: "SEED_LINE",
    5: "STAIN_LINE", 6: "MELTED_SNOW_LINE", 7: "DIRECT_OBSERVATION", 8: "OTHER",
}
HWM_QUALITIES = {1: "EXCELLENT", 2: "GOOD", 3: "FAIR", 4: "POOR", 5: "VERY_POOR", 6: "UNKNOWN"}
HWM_ENVIRONMENTS = {"Coastal": "COASTAL", "Riverine": "RIVERINE"}
SENSOR_TYPES = {
    1: "PRESSURE_TRANSDUCER", 2: "METEROLOGICAL_STATION", 3: "THERMOMETER",
    4: "WEBCAM", 5: "RAPID_DEPLOYMENT_GAGE", 6: "RAIN_GAGE",
}
FILE_TYPES = {
    1: "PHOTO", 2: "DATA", 3: "HISTORIC_CITATION", 4: "FIELD_SHEETS", 5: "LEVEL_NOTES", 6: "SITE_SKETCH",
    7: "OTHER", 8: "LINK", 9: "NGS_DATASHEET", 10: "SKETCH", 11: "LANDOWNER_PERMISSION_FORM", 13: "HYDROGRAPH",
}
DEPLOYMENT_TYPES = {
    1: "WATER_LEVEL", 2: "WAVE_HEIGHT", 3: "BAROMETRIC", 4: "TEMPERATURE", 5: "WIND_SPEED",
    6: "HUMIDITY", 7: "AIR_TEMPERATURE", 8: "WATER_TEMPERATURE", 9: "RAPID_DEPLOYMENT",
}

# keys of one track: a storm, one advisory (technique) and one forecast cycle
TRACK_KEY = ["storm_id", "advisory", "track_start_time"]

# --- FIXED VALUES: high-water-mark columns (JSON service layout) -------------------------
HWM_COLUMNS = [
    "latitude", "longitude", "eventName", "hwmTypeName", "hwmQualityName", "verticalDatumName",
    "verticalMethodName", "approvalMember", "markerName", "horizontalMethodName",
    "horizontalDatumName", "flagMemberName", "surveyMemberName", "site_no", "siteDescription",
    "sitePriorityName", "networkNames", "stateName", "countyName", "siteZone", "sitePermHousing",
    "site_latitude", "site_longitude", "hwm_id", "waterbody", "site_id", "event_id",
    "hwm_type_id", "hwm_quality_id", "latitude_dd", "longitude_dd", "survey_date", "elev_ft",
    "vdatum_id", "vcollect_method_id", "bank", "marker_id", "hcollect_method_id", "hwm_notes",
    "hwm_environment", "flag_date", "stillwater", "hdatum_id", "hwm_label", "files",
    "height_above_gnd", "hwm_locationdescription", "flag_member_id", "survey_member_id",
]

_HWM_DOUBLES = {"latitude", "longitude", "site_latitude", "site_longitude", "latitude_dd",
                "longitude_dd", "elev_ft", "height_above_gnd"}
_HWM_LONGS = {"hwm_id", "site_id", "event_id", "hwm_type_id", "hwm_quality_id", "vdatum_id",
              "vcollect_method_id", "marker_id", "hcollect_method_id", "hdatum_id",
              "flag_member_id", "survey_member_id", "stillwater"}


def hwm_schema() -> T.StructType:
    fields = []
    for name in HWM_COLUMNS:
        if name in _HWM_DOUBLES:
            dtype = T.DoubleType()
        elif name in _HWM_LONGS:
            dtype = T.LongType()
        else:
            dtype = T.StringType()
        fields.append(T.StructField(name, dtype, True))
    return T.StructType(fields)


# --- FIXED VALUES: storm catalog CSV layout (21 positional columns) ---------------------
CATALOG_CSV_COLUMNS = [
    "name", "basin", "c2", "c3", "c4", "c5", "c6", "number", "year", "class", "c10",
    "start_date", "end_date", "c13", "c14", "c15", "c16", "c17", "source", "c19", "nhc_code",
]

CATALOG_COLUMNS = ["nhc_code", "name", "class", "year", "basin", "number", "source", "start_date", "end_date"]

FLOOD_EVENT_COLUMNS = [
    "usgs_id", "name", "year", "description", "event_type", "event_status", "coordinator",
    "instruments", "last_updated", "last_updated_by", "start_date", "end_date",
]
