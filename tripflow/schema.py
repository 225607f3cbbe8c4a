"""Table layouts and the fixed values of the trip data model."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _D, _F = T.StringType(), T.DoubleType(), T.FloatType()
_I, _H, _L, _B = T.IntegerType(), T.ShortType(), T.LongType(), T.BooleanType()
_NTZ, _TS = T.TimestampNTZType(), T.TimestampType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


# ---- monthly files ---------------------------------------------------------------------------

CLEAN_TRIPS = _struct(
    ride_id=_S, rideable_type=_S, started_at=_NTZ, ended_at=_NTZ,
    start_station_id=_S, start_station_name=_S, start_lat=_D, start_lng=_D,
    end_station_id=_S, end_station_name=_S, end_lat=_D, end_lng=_D,
    member_casual=_S, tripduration_seconds=_D, bikeid=_S, usertype=_S,
    birth_year=_L, gender=_L, source_file=_S,
)
CLEAN_COLUMNS = CLEAN_TRIPS.fieldNames()

TRIPS = _struct(
    ride_id=_S, rideable_type=_S, started_at=_NTZ, ended_at=_NTZ,
    start_station_id=_S, start_station_name=_S, start_lat=_F, start_lng=_F,
    end_station_id=_S, end_station_name=_S, end_lat=_F, end_lng=_F,
    member_casual=_S, tripduration_seconds=_I, bikeid=_S, usertype=_S,
    birth_year=_H, gender=_H, source_file=_S, load_timestamp=_NTZ, year_month=_S,
)
TRIP_KEY = ["ride_id", "started_at"]
# a ride id stands once in a month of the warehouse
MONTH_KEY = ["year_month", "ride_id"]

STATIONS = _struct(
    station_id=_S, station_name=_S, latitude=_D, longitude=_D, first_seen=_NTZ, last_seen=_NTZ,
)
LEDGER = _struct(source_file=_S, records_loaded=_L, load_date=_NTZ)
FILE_MANIFEST = _struct(key=_S, url=_S, size=_L, etag=_S, last_modified=_S)

# ---- live trip events ------------------------------------------------------------------------

# Every field that may arrive as number or text is read as text and coerced later.
EVENT = _struct(
    trip_id=_S, bike_id=_S, start_time=_S, end_time=_S, start_station_id=_S, end_station_id=_S,
    rider_age=_S, trip_duration=_S, bike_type=_S, member_casual=_S, ingested_at=_S, source_ip=_S,
)
EVENT_REQUIRED = [
    "trip_id", "bike_id", "start_time", "end_time", "start_station_id", "end_station_id",
    "trip_duration", "bike_type",
]

TRIP_METADATA = _struct(
    trip_id=_S, bike_id=_I, start_time=_NTZ, end_time=_NTZ, start_station_id=_I, end_station_id=_I,
    rider_age=_I, trip_duration=_I, bike_type=_S, member_casual=_S,
    quality_score=T.DecimalType(5, 2), quality_issues=T.ArrayType(_S), is_valid=_B,
    ingested_at=_NTZ, processed_at=_NTZ, created_at=_NTZ,
)
# What a resent trip changes in the metadata table; every other column keeps its first value.
METADATA_REFRESHED = ["quality_score", "quality_issues", "processed_at"]

HEALTH_CHECKS = _struct(service=_S, status=_S, error=_S, message_count=_L, trip_count=_L)
ALERTS = _struct(id=_S, level=_S, type=_S, message=_S, timestamp=_NTZ)

# ---- fixed values ----------------------------------------------------------------------------

# Header spellings after normalisation, per target column (cleaning of raw files).
CLEAN_SYNONYMS = {
    "tripduration_seconds": ["tripduration", "trip_duration"],
    "started_at": ["starttime", "start_time"],
    "ended_at": ["stoptime", "stop_time"],
    "start_station_id": ["start_station_id_"],
    "start_station_name": ["start_station_name_"],
    "start_lat": ["start_station_latitude", "start_station_latitude_"],
    "start_lng": ["start_station_longitude", "start_station_longitude_"],
    "end_station_id": ["end_station_id_"],
    "end_station_name": ["end_station_name_"],
    "end_lat": ["end_station_latitude", "end_station_latitude_"],
    "end_lng": ["end_station_longitude", "end_station_longitude_"],
    "bikeid": ["bike_id", "bike_id_"],
    "usertype": ["user_type", "user_type_"],
    "birth_year": ["birth_year_", "birth_year__"],
}

# Header spellings known to the warehouse load.
LOAD_SYNONYMS = {
    "tripduration_seconds": ["tripduration", "trip_duration"],
    "started_at": ["starttime", "start_time"],
    "ended_at": ["stoptime", "stop_time"],
    "start_lat": ["start_station_latitude"],
    "start_lng": ["start_station_longitude"],
    "end_lat": ["end_station_latitude"],
    "end_lng": ["end_station_longitude"],
    "bikeid": ["bike_id"],
    "usertype": ["user_type"],
    "birth_year": ["birth_year_"],
}

# CSV cells that mean "no value".
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Limits of a usable trip and of a rider's birth year.
MAX_DURATION_SECONDS = 86400
MIN_BIRTH_YEAR = 1900

# Text columns that the warehouse load fills, and the labels it uses.
LOAD_TEXT_COLUMNS = [
    "rideable_type", "start_station_id", "start_station_name", "end_station_id",
    "end_station_name", "member_casual", "bikeid", "usertype",
]
COORDINATES = ["start_lat", "start_lng", "end_lat", "end_lng"]
DEFAULT_BIKE = "classic_bike"
UNKNOWN_MEMBER = "unknown"
UNKNOWN_MEMBER_LABEL = "(desconocido)"

# Names of monthly archives in the public trip data.
MONTHLY_ARCHIVE_MARKER = "citibike-tripdata"
MONTHLY_ARCHIVE_NAME_LENGTH = 28
MONTHLY_ARCHIVE_SUFFIX = "-citibike-tripdata.csv.zip"
OTHER_CITY_PREFIX = "JC-"

# Quality bands, lowest score first met from the top.
QUALITY_BANDS = [("EXCELLENT", 90), ("GOOD", 75), ("FAIR", 60)]
LOWEST_BAND = "POOR"
