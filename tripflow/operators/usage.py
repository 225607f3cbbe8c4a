"""Usage queries on the trips table.

All take the trips and an optional filter (first day, last day, member types). Counts and sums are
partial aggregates; medians are exact and folded to (group, duration) counts before the merge.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow import schema
from tripflow.functions import quality as Q
from tripflow.functions import trips as C

Day = dt.date | str | None

# Rows of each report, and the bounds of the map sample.
TOP_STATIONS = 20
TOP_BIKES = 10
TOP_BIRTH_YEARS = 20
LONGEST_TRIPS = 20
LONG_TRIP_SECONDS = 7200
MAP_SAMPLE, MAP_SAMPLE_MIN, MAP_SAMPLE_MAX, MAP_SAMPLE_STEP = 5000, 1000, 20000, 1000


def _as_day(value: Day) -> dt.date | None:
    return dt.date.fromisoformat(value) if isinstance(value, str) else value


def trip_filter(
    trips: DataFrame, d0: Day = None, d1: Day = None, members: list[str] | tuple = ()
) -> DataFrame:
    """Trips started from ``d0`` to the end of ``d1`` by the given member types (none: all).

    A bound is repeated on ``year_month`` where the table has it, so that the scan opens only the
    month folders it needs.
    """
    d0, d1 = _as_day(d0), _as_day(d1)
    if d0 and d1 and d0 > d1:
        raise ValueError(f"first day {d0} is after last day {d1}")
    partitioned = "year_month" in trips.columns
    if d0:
        trips = trips.where(F.col("started_at") >= F.lit(str(d0)).cast("timestamp_ntz"))
        if partitioned:
            trips = trips.where(F.col("year_month") >= f"{d0:%Y-%m}")
    if d1:
        after = d1 + dt.timedelta(days=1)
        trips = trips.where(F.col("started_at") < F.lit(str(after)).cast("timestamp_ntz"))
        if partitioned:
            trips = trips.where(F.col("year_month") <= f"{d1:%Y-%m}")
    if members:
        trips = trips.where(C.text_fill(F.col("member_casual")).isin(list(members)))
    return trips


def trip_range(trips: DataFrame) -> DataFrame:
    """First and last start and the number of rows, over all trips."""
    return trips.agg(
        F.min("started_at").alias("min_started_at"),
        F.max("started_at").alias("max_started_at"),
        F.count("*").alias("n_rows"),
    )


def _median(duration: str = "tripduration_seconds", weight: str = "trips") -> Column:
    return F.percentile(F.col(duration), F.lit(0.5), F.col(weight))


def trip_kpis(trips: DataFrame, d0: Day = None, d1: Day = None, members=()) -> DataFrame:
    """Trips, average and exact median seconds, distinct start and end stations.

    Three narrow folds instead of one wide distinct aggregation: trips to counts per duration (at
    most one row per second of a day), and to the distinct start and end stations. Each reads its
    own column, and no row is expanded once per distinct count.
    """
    rows = trip_filter(trips, d0, d1, members)

    def distinct(column: str) -> Column:
        return rows.select(column).distinct().agg(F.count(column)).scalar()

    seconds = F.col("tripduration_seconds")
    known = F.when(seconds.isNotNull(), F.col("trips"))
    folded = rows.groupBy("tripduration_seconds").agg(F.count("*").alias("trips"))
    return folded.agg(
        F.coalesce(F.sum("trips"), F.lit(0)).alias("trips"),
        Q.exact_average(F.sum(seconds.cast("bigint") * known), F.sum(known), 10, 1)
        .alias("avg_secs"),
        _median().alias("p50_secs"),
    ).select(
        "*",
        distinct("start_station_id").alias("start_stations"),
        distinct("end_station_id").alias("end_stations"),
    )


def trips_per_day(trips: DataFrame, d0: Day = None, d1: Day = None, members=()) -> DataFrame:
    rows = trip_filter(trips, d0, d1, members)
    return rows.groupBy(C.day(F.col("started_at")).alias("day")) \
        .agg(F.count("*").alias("trips")).orderBy("day")


def _top(rows: DataFrame, key: Column, name: str, counted: str, n: int) -> DataFrame:
    return rows.groupBy(key.alias(name)).agg(F.count("*").alias(counted)) \
        .orderBy(F.desc(counted), F.asc_nulls_first(name)).limit(n)


def top_start_stations(trips: DataFrame, d0: Day = None, d1: Day = None, members=()) -> DataFrame:
    label = C.station_label(F.col("start_station_name"), F.col("start_station_id"))
    return _top(trip_filter(trips, d0, d1, members), label, "station", "trips", TOP_STATIONS)


def top_end_stations(trips: DataFrame, d0: Day = None, d1: Day = None, members=()) -> DataFrame:
    label = C.station_label(F.col("end_station_name"), F.col("end_station_id"))
    return _top(trip_filter(trips, d0, d1, members), label, "station", "trips", TOP_STATIONS)


def duration_by_member(trips: DataFrame, d0: Day = None, d1: Day = None, members=()) -> DataFrame:
    """Average and exact median seconds per member type, most trips first."""
    rows = trip_filter(trips, d0, d1, members)
    member = F.coalesce("member_casual", F.lit(schema.UNKNOWN_MEMBER_LABEL))
    folded = rows.groupBy(member.alias("member_casual"), "tripduration_seconds") \
        .agg(F.count("*").alias("trips"))
    known = F.col("tripduration_seconds").isNotNull()
    return folded.groupBy("member_casual").agg(
        Q.exact_average(
            F.sum(F.col("tripduration_seconds").cast("bigint") * F.col("trips")),
            F.sum(F.when(known, F.col("trips"))), 10, 1).alias("avg_secs"),
        _median().alias("p50_secs"),
        F.sum("trips").alias("trips"),
    ).orderBy(F.desc("trips"), "member_casual")


def top_bikes(trips: DataFrame, d0: Day = None, d1: Day = None, members=()) -> DataFrame:
    """Most used bikes; trips without a bike id count as one bike."""
    rows = trip_filter(trips, d0, d1, members)
    return _top(rows, F.col("bikeid"), "bikeid", "trips", TOP_BIKES)


def trips_per_hour(trips: DataFrame, d0: Day = None, d1: Day = None, members=()) -> DataFrame:
    rows = trip_filter(trips, d0, d1, members)
    return rows.groupBy(C.hour_of_day(F.col("started_at")).alias("hour")) \
        .agg(F.count("*").alias("trips")).orderBy("hour")


def trips_per_weekday(trips: DataFrame, d0: Day = None, d1: Day = None, members=()) -> DataFrame:
    # days are folded first, so the name is formatted once per day and not once per trip
    rows = trip_filter(trips, d0, d1, members)
    days = rows.groupBy(C.day(F.col("started_at")).alias("day")).agg(F.count("*").alias("trips"))
    return days.groupBy(C.weekday_name(F.col("day")).alias("weekday")) \
        .agg(F.sum("trips").alias("trips")).orderBy(F.desc("trips"), "weekday")


def top_birth_years(trips: DataFrame, d0: Day = None, d1: Day = None, members=()) -> DataFrame:
    """Most frequent birth years; the 0 that the load profile fills in counts as a year."""
    rows = trip_filter(trips, d0, d1, members).where(F.col("birth_year").isNotNull())
    return _top(rows, F.col("birth_year"), "birth_year", "trips", TOP_BIRTH_YEARS)


def longest_trips(trips: DataFrame, d0: Day = None, d1: Day = None, members=()) -> DataFrame:
    rows = trip_filter(trips, d0, d1, members)
    return rows.where(F.col("tripduration_seconds") > LONG_TRIP_SECONDS) \
        .select("ride_id", "started_at", "ended_at", "tripduration_seconds") \
        .orderBy(F.desc("tripduration_seconds"), "ride_id", "started_at", "ended_at") \
        .limit(LONGEST_TRIPS)


def map_sample(
    trips: DataFrame, d0: Day = None, d1: Day = None, members=(), n: int = MAP_SAMPLE,
    repeatable: bool = True,
) -> DataFrame:
    """Start positions of ``n`` trips; the smallest ride ids, or any when not ``repeatable``."""
    if not MAP_SAMPLE_MIN <= n <= MAP_SAMPLE_MAX or n % MAP_SAMPLE_STEP:
        raise ValueError(
            f"n must go from {MAP_SAMPLE_MIN} to {MAP_SAMPLE_MAX} in steps of {MAP_SAMPLE_STEP}")
    rows = trip_filter(trips, d0, d1, members).where(
        F.col("start_lat").isNotNull() & F.col("start_lng").isNotNull())
    if repeatable:
        rows = rows.orderBy("ride_id", "started_at", "start_lat", "start_lng")
    return rows.limit(n).select(F.col("start_lat").alias("lat"), F.col("start_lng").alias("lon"))
