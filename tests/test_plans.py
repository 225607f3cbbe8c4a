"""The plans the library promises: pruned scans, no Python, no shuffle where none is needed."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import SF, rows

from tripflow import fixtures as X
from tripflow import schema
from tripflow.catalog import QUERIES
from tripflow.functions.trips import year_month
from tripflow.operators import usage
from tripflow.plans import reports
from pyspark.sql import functions as F


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def stored(spark, tmp_path):
    trips = X.trips(spark, SF).withColumn("year_month", year_month(F.col("started_at")))
    trips.write.partitionBy("year_month").parquet(str(tmp_path / "trips"))
    return spark.read.parquet(str(tmp_path / "trips"))


def test_filter_prunes_months_and_reaches_the_scan(spark, tmp_path):
    trips = stored(spark, tmp_path)
    kept = usage.trips_per_day(trips, dt.date(1997, 3, 5), "1997-04-02", ["member"])
    scan = [p for p in plan(kept).splitlines() if "FileScan" in p][0]
    assert "PartitionFilters: [isnotnull(year_month" in scan and "1997-03" in scan
    assert "GreaterThanOrEqual(started_at,1997-03-05T00:00)" in scan
    assert "ReadSchema: struct<started_at:timestamp_ntz,member_casual:string>" in scan
    days = [r[0] for r in rows(kept)]
    assert min(days) >= dt.date(1997, 3, 5) and max(days) <= dt.date(1997, 4, 2)


def test_filter_bounds(spark):
    trips = spark.sql("""SELECT * FROM VALUES (TIMESTAMP_NTZ'2024-01-01 00:00:00', 'member'),
        (TIMESTAMP_NTZ'2024-01-02 23:59:59', NULL), (TIMESTAMP_NTZ'2024-01-03 00:00:00', 'member')
        AS t(started_at, member_casual)""")
    assert usage.trip_filter(trips, "2024-01-01", "2024-01-02").count() == 2
    assert usage.trip_filter(trips, members=["member"]).count() == 2
    assert usage.trip_filter(trips, members=[""]).count() == 1
    assert usage.trip_filter(trips).count() == 3
    with pytest.raises(ValueError):
        usage.trip_filter(trips, "2024-01-02", "2024-01-01")
    with pytest.raises(ValueError):
        usage.map_sample(trips, n=1500)


def test_top_lists_do_not_sort_everything(spark):
    for name in ("top_bikes", "longest_trips", "map_sample", "recent_trips"):
        assert "TakeOrderedAndProject" in plan(QUERIES[name](spark, SF))


def test_queries_run_without_python(spark):
    for name, query in QUERIES.items():
        if (not name.endswith(("_stream", "_run", "_rows")) or name == "score_stream") and name != "metadata_after_fold":
            shown = plan(query(spark, SF))
            assert "Python" not in shown and "MapInPandas" not in shown, name
            assert "CartesianProduct" not in shown, name


def test_issue_totals_reuse_one_aggregation(spark):
    df = QUERIES["issue_frequency"](spark, SF)
    df.collect()
    assert "ReusedExchange" in plan(df) or plan(df).count("FileScan") == 1


def test_reports_share_a_selection(spark):
    trips = X.trips(spark, SF)
    alone = reports.usage_report(trips, "1997-01-01", "1997-12-31")
    with reports.shared_usage_report(trips, "1997-01-01", "1997-12-31") as shared:
        assert set(alone) == set(shared) and len(alone) == 12
        for name in ("trip_kpis", "top_bikes", "trips_per_hour", "trip_range"):
            assert rows(alone[name]) == rows(shared[name])
    metadata = X.trip_metadata(spark, SF)
    found = reports.quality_report(metadata, F.lit("2024-01-30").cast("timestamp_ntz"))
    assert len(found) == 11 and found["overview"].first().total_trips == metadata.count()


def test_layouts(spark):
    assert len(schema.CLEAN_COLUMNS) == 19 and len(schema.TRIP_METADATA) == 16
    assert X.trip_metadata(spark, SF).select(*schema.TRIP_METADATA.fieldNames()).schema.simpleString() \
        == schema.TRIP_METADATA.simpleString()
