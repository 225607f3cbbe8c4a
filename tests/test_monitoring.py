from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tripflow import schema
from tripflow.operators import monitoring
from tripflow.plans.monitoring import run_monitoring

NOW = dt.datetime(2024, 1, 1, 12)
UP = {"api": ("healthy", None, None, None), "s3": ("healthy", None, None, None),
      "postgresql": ("healthy", None, None, 50), "sqs": ("healthy", None, 10, None)}


def checks(spark, **changes):
    items = {**UP, **changes}
    return spark.createDataFrame([(s, *v) for s, v in items.items()], schema.HEALTH_CHECKS)


def trips(spark, scores, valid, minutes=5):
    at = NOW - dt.timedelta(minutes=minutes)
    return spark.createDataFrame(
        [(Decimal(s), i < valid, at) for i, s in enumerate(scores)],
        "quality_score decimal(5,2), is_valid boolean, processed_at timestamp_ntz")


def fired(spark, health, metadata):
    now = F.lit(NOW).cast("timestamp_ntz")
    metrics = monitoring.observability_metrics(health, metadata, now)
    return [r.type for r in monitoring.alerts(metrics).collect()]


GOOD = (["70", "70", "70", "70", "70"], 4)  # average 70, ratio 0.8: both bounds are strict


@pytest.mark.parametrize("changes, scores, expected", [
    ({}, GOOD, []),
    ({"sqs": ("healthy", None, 1000, None)}, GOOD, []),
    ({"sqs": ("healthy", None, 1001, None)}, GOOD, ["sqs_backlog"]),
    ({"sqs": ("unhealthy", "x", 5000, None)}, GOOD, ["system_degraded"]),
    ({"sqs": ("unknown", "x", None, None)}, GOOD, ["system_degraded"]),
    ({"api": ("unhealthy", None, None, None)}, GOOD, ["system_degraded", "api_down"]),
    ({}, (["69.50", "70"], 2), ["low_data_quality"]),
    ({}, (["90"] * 100, 79), ["high_invalid_data"]),
    ({}, ([], 0), ["low_data_quality"]),
])
def test_alert_rules(spark, changes, scores, expected):
    assert fired(spark, checks(spark, **changes), trips(spark, *scores)) == expected


def test_only_the_last_hour_counts(spark):
    assert fired(spark, checks(spark), trips(spark, ["10"], 0, minutes=61)) == ["low_data_quality"]
    assert fired(spark, checks(spark), trips(spark, ["100"], 1, minutes=60)) == []


def test_metrics_row_and_summary(spark):
    now = F.lit(NOW).cast("timestamp_ntz")
    row = monitoring.observability_metrics(
        checks(spark, s3=("unhealthy", "x", None, None), postgresql=("unhealthy", "y", None, 9)),
        trips(spark, ["80", "90"], 1), now).first()
    assert row.system_status == "degraded" and row.degraded_services == ["postgresql", "s3"]
    assert (row.message_count, row.total_trips, row.avg_quality_score) == (10, None, 85.0)
    assert (row.total_trips_last_hour, row.valid_trips_last_hour) == (2, 1)
    assert rows(monitoring.system_status(checks(spark))) == [("healthy", [])]


def test_monitoring_run_writes_alerts_only_when_there_are_any(spark, tmp_path):
    at = F.lit(NOW).cast("timestamp_ntz")
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    run_monitoring(checks(spark), trips(spark, *GOOD), at, good)
    assert spark.read.parquet(f"{good}/system_metrics").count() == 1
    assert not list((tmp_path / "good").glob("alerts/date=*"))
    for _ in range(2):
        _, alerts = run_monitoring(
            checks(spark, api=("unhealthy", "gone", None, None)), trips(spark, *GOOD), at, bad)
    stored = spark.read.parquet(f"{bad}/alerts").collect()
    assert len(stored) == 1 and stored[0].alert_count == 2
    assert rows(monitoring.alert_summary(alerts)) == [(2, 0, 2)]
    assert [f.name for f in monitoring.alert_rows(alerts).schema] == schema.ALERTS.fieldNames()
    assert "gone" in {r.type: r.message for r in alerts.collect()}["api_down"]
