"""Monitoring run: metrics from the service table and the metadata, then the alert rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from tripflow.operators import monitoring
from tripflow.sources.tables import write_monitoring


def run_monitoring(
    checks: DataFrame, metadata: DataFrame, as_of: Column, path: str
) -> tuple[DataFrame, DataFrame]:
    """(metrics, alerts) of the moment, also written below ``path``; the caller unpersists ``metrics``."""
    metrics = monitoring.observability_metrics(checks, metadata, as_of.cast("timestamp_ntz"))
    # one row: kept so that the last hour is read once for metrics and alerts
    metrics = metrics.persist()
    fired = monitoring.alerts(metrics)
    write_monitoring(metrics, fired, path, as_of)
    return metrics, fired
