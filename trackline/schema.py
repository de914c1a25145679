"""Table contracts, header aliases and fixed reference values.

Every stored table has a fixed ``StructType``; raw files are read as
strings under an explicit schema and typed once by ``operators.clean``.
Times are ``TIMESTAMP_NTZ`` holding UTC wall-clock values, so results do not
depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Source header names, in file order (17 columns).
# ---------------------------------------------------------------------------
SOURCE_COLUMNS = [
    "MMSI", "BaseDateTime", "LAT", "LON", "SOG", "COG", "Heading",
    "VesselName", "IMO", "CallSign", "VesselType", "Status",
    "Length", "Width", "Draft", "Cargo", "TransceiverClass",
]

# Canonical (stored) name for each source header, same order as above.
CANONICAL_COLUMNS = [
    "mmsi", "base_datetime", "latitude", "longitude", "sog", "cog", "heading",
    "vessel_name", "imo", "call_sign", "vessel_type", "status",
    "length", "width", "draft", "cargo", "transceiver_class",
]

SOURCE_TO_CANONICAL = dict(zip(SOURCE_COLUMNS, CANONICAL_COLUMNS))

# Header aliases seen in "standard" position files (lower-cased header -> canonical).
STANDARD_ALIASES = {
    "mmsi": "mmsi",
    "timestamp": "base_datetime",
    "time": "base_datetime",
    "datetime": "base_datetime",
    "basedatetime": "base_datetime",
    "lat": "latitude",
    "latitude": "latitude",
    "lon": "longitude",
    "lng": "longitude",
    "longitude": "longitude",
    "sog": "sog",
    "speed": "sog",
    "cog": "cog",
    "course": "cog",
    "heading": "heading",
    "vesselname": "vessel_name",
    "vessel_name": "vessel_name",
    "name": "vessel_name",
    "shipname": "vessel_name",
    "imo": "imo",
    "callsign": "call_sign",
    "call_sign": "call_sign",
    "vesseltype": "vessel_type",
    "vessel_type": "vessel_type",
    "shiptype": "vessel_type",
    "status": "status",
    "navstatus": "status",
    "length": "length",
    "width": "width",
    "draft": "draft",
    "cargo": "cargo",
    "transceiverclass": "transceiver_class",
    "transceiver_class": "transceiver_class",
}

NUMERIC_COLUMNS = ["latitude", "longitude", "sog", "cog", "heading", "length", "width", "draft", "cargo"]
TEXT_COLUMNS = ["vessel_name", "imo", "call_sign", "vessel_type", "status", "transceiver_class"]

# ---------------------------------------------------------------------------
# Tokens read as missing (the pandas CSV reader's default list).
# ---------------------------------------------------------------------------
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
]

# ---------------------------------------------------------------------------
# Cleaning and scoring thresholds.
# ---------------------------------------------------------------------------
LAT_RANGE = (-90.0, 90.0)
LON_RANGE = (-180.0, 180.0)
SPEED_RANGE = (0.0, 50.0)          # knots, cleaning and quality score
CHECK_SPEED_RANGE = (0.0, 100.0)   # knots, table constraint
CHECK_ANGLE_RANGE = (0.0, 360.0)   # degrees, cog and heading constraint
MOVING_PAIR_MEAN_KNOTS = 1.0       # leg is "moving" when mean of its two sog >= this
MOVING_POINT_KNOTS = 1.0           # point is "moving" when sog > this (traffic views)
EARTH_RADIUS_NM = 3440.065         # haversine radius
METERS_PER_NM = 1852.0
WGS84_A = 6378137.0
WGS84_F = 1.0 / 298.257223563

# ---------------------------------------------------------------------------
# Vessel type codes (code, description, category).
# ---------------------------------------------------------------------------
VESSEL_TYPE_CODES = [
    (30, "Fishing", "Fishing"),
    (31, "Towing", "Tug/Pilot"),
    (32, "Towing length > 200m", "Tug/Pilot"),
    (33, "Dredging/Underwater operations", "Other"),
    (34, "Diving operations", "Other"),
    (35, "Military operations", "Military"),
    (36, "Sailing", "Pleasure"),
    (37, "Pleasure craft", "Pleasure"),
    (40, "High speed craft (HSC)", "Passenger"),
    (50, "Pilot vessel", "Tug/Pilot"),
    (51, "Search and rescue vessel", "Other"),
    (52, "Tug", "Tug/Pilot"),
    (53, "Port tender", "Tug/Pilot"),
    (54, "Anti-pollution equipment", "Other"),
    (55, "Law enforcement", "Government"),
    (60, "Passenger", "Passenger"),
    (70, "Cargo", "Cargo"),
    (71, "Cargo, all ships carrying DG", "Cargo"),
    (72, "Cargo, Hazard cat A", "Cargo"),
    (73, "Cargo, Hazard cat B", "Cargo"),
    (74, "Cargo, Hazard cat C", "Cargo"),
    (75, "Cargo, Hazard cat D", "Cargo"),
    (80, "Tanker", "Tanker"),
    (81, "Tanker, Hazard cat A", "Tanker"),
    (82, "Tanker, Hazard cat B", "Tanker"),
    (83, "Tanker, Hazard cat C", "Tanker"),
    (84, "Tanker, Hazard cat D", "Tanker"),
    (89, "Other type", "Other"),
]

# ---------------------------------------------------------------------------
# Navigation status codes (code, description).
# ---------------------------------------------------------------------------
NAVIGATION_STATUS_CODES = [
    (0, "Under way using engine"),
    (1, "At anchor"),
    (2, "Not under command"),
    (3, "Restricted manoeuvrability"),
    (4, "Constrained by her draught"),
    (5, "Moored"),
    (6, "Aground"),
    (7, "Engaged in fishing"),
    (8, "Under way sailing"),
    (11, "Power-driven vessel towing astern"),
    (12, "Power-driven vessel pushing ahead"),
    (14, "AIS-SART (active)"),
    (15, "Undefined (default)"),
]

# ---------------------------------------------------------------------------
# Struct contracts
# ---------------------------------------------------------------------------
POSITIONS_SCHEMA = T.StructType([
    T.StructField("mmsi", T.LongType(), False),
    T.StructField("base_datetime", T.TimestampNTZType(), False),
    T.StructField("latitude", T.DoubleType(), False),
    T.StructField("longitude", T.DoubleType(), False),
    T.StructField("sog", T.DoubleType(), True),
    T.StructField("cog", T.DoubleType(), True),
    T.StructField("heading", T.DoubleType(), True),
    T.StructField("vessel_name", T.StringType(), True),
    T.StructField("imo", T.StringType(), True),
    T.StructField("call_sign", T.StringType(), True),
    T.StructField("vessel_type", T.StringType(), True),
    T.StructField("status", T.StringType(), True),
    T.StructField("length", T.DoubleType(), True),
    T.StructField("width", T.DoubleType(), True),
    T.StructField("draft", T.DoubleType(), True),
    T.StructField("cargo", T.DoubleType(), True),
    T.StructField("transceiver_class", T.StringType(), True),
    T.StructField("ingest_seq", T.LongType(), True),
])

METRICS_COLUMNS = [
    "mmsi", "vessel_name", "total_distance_nm", "total_time_hours", "moving_time_hours",
    "at_dock_time_hours", "point_count", "avg_speed_knots", "max_speed_knots",
]

EXTENT_COLUMNS = [
    "min_speed_knots", "first_position_time", "last_position_time",
    "start_latitude", "start_longitude", "end_latitude", "end_longitude",
]

METRICS_SCHEMA = T.StructType([
    T.StructField("mmsi", T.LongType(), False),
    T.StructField("vessel_name", T.StringType(), True),
    T.StructField("total_distance_nm", T.DoubleType(), True),
    T.StructField("total_time_hours", T.DoubleType(), True),
    T.StructField("moving_time_hours", T.DoubleType(), True),
    T.StructField("at_dock_time_hours", T.DoubleType(), True),
    T.StructField("point_count", T.LongType(), True),
    T.StructField("avg_speed_knots", T.DoubleType(), True),
    T.StructField("max_speed_knots", T.DoubleType(), True),
    T.StructField("min_speed_knots", T.DoubleType(), True),
    T.StructField("first_position_time", T.TimestampNTZType(), True),
    T.StructField("last_position_time", T.TimestampNTZType(), True),
    T.StructField("start_latitude", T.DoubleType(), True),
    T.StructField("start_longitude", T.DoubleType(), True),
    T.StructField("end_latitude", T.DoubleType(), True),
    T.StructField("end_longitude", T.DoubleType(), True),
    T.StructField("last_updated", T.TimestampNTZType(), True),
])

VESSEL_TYPE_SCHEMA = T.StructType([
    T.StructField("code", T.IntegerType(), False),
    T.StructField("description", T.StringType(), False),
    T.StructField("category", T.StringType(), True),
])

NAV_STATUS_SCHEMA = T.StructType([
    T.StructField("code", T.IntegerType(), False),
    T.StructField("description", T.StringType(), False),
])
