"""The two dashboards as named queries over one filtered, shared base."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame

from tripflow.operators import quality, usage

USAGE_COLUMNS = [
    "ride_id", "started_at", "ended_at", "start_station_id", "start_station_name", "start_lat",
    "start_lng", "end_station_id", "end_station_name", "member_casual", "tripduration_seconds",
    "bikeid", "birth_year",
]


def _usage_queries(base: DataFrame, trips: DataFrame) -> dict[str, DataFrame]:
    queries: list[Callable[[DataFrame], DataFrame]] = [
        usage.trip_kpis, usage.trips_per_day, usage.top_start_stations, usage.top_end_stations,
        usage.duration_by_member, usage.top_bikes, usage.trips_per_hour, usage.trips_per_weekday,
        usage.top_birth_years, usage.longest_trips, usage.map_sample,
    ]
    report = {query.__name__: query(base) for query in queries}
    # the overall range is over all trips, whatever the selection
    report["trip_range"] = usage.trip_range(trips)
    return report


def usage_report(
    trips: DataFrame, d0: usage.Day = None, d1: usage.Day = None, members=()
) -> dict[str, DataFrame]:
    """All usage queries over one selection of trips; each reads its own few columns from the files."""
    return _usage_queries(usage.trip_filter(trips, d0, d1, members), trips)


@contextmanager
def shared_usage_report(
    trips: DataFrame, d0: usage.Day = None, d1: usage.Day = None, members=()
) -> Iterator[dict[str, DataFrame]]:
    """The same with the selected columns kept in executor memory and disk until the block ends.

    For the queries of one dashboard refresh over a selection that fits the cluster.
    """
    base = usage.trip_filter(trips, d0, d1, members)
    base = base.select(*[c for c in USAGE_COLUMNS if c in base.columns]).persist()
    try:
        yield _usage_queries(base, trips)
    finally:
        base.unpersist()


def quality_report(metadata: DataFrame, as_of: Column) -> dict[str, DataFrame]:
    """All quality queries over the metadata table."""
    queries: list[Callable[[DataFrame], DataFrame]] = [
        quality.overview, quality.score_histogram, quality.validity_split,
        quality.trips_by_bike_type, quality.trips_by_member, quality.recent_trips,
        quality.recent_scores, quality.quality_summary, quality.issue_frequency,
        quality.hourly_stats,
    ]
    report = {query.__name__: query(metadata) for query in queries}
    report["hourly_trend"] = quality.hourly_trend(metadata, as_of)
    return report
