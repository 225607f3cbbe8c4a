"""Service status, observability metrics and alert rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.operators.quality import last_hour_quality

HEALTHY = "healthy"

# Service names and alert bounds, all of them strict.
API, QUEUE, DATABASE = "api", "sqs", "postgresql"
LOW_SCORE = 70
LOW_VALID_RATIO = 0.8
LONG_QUEUE = 1000


def _of(service: str, value: Column) -> Column:
    return F.max(F.when(F.col("service") == service, value))


def _of_healthy(service: str, name: str) -> Column:
    """A number a service reports, 0 when it reports none, NULL when it is not healthy."""
    return _of(service, F.when(F.col("status") == HEALTHY, F.coalesce(F.col(name), F.lit(0))))


def _status() -> list[Column]:
    all_up = F.coalesce(F.bool_and(F.col("status") == HEALTHY), F.lit(True))
    down = F.when(F.col("status") != HEALTHY, F.col("service"))
    return [
        F.when(all_up, HEALTHY).otherwise("degraded").alias("system_status"),
        F.sort_array(F.collect_set(down)).alias("degraded_services"),
    ]


def system_status(checks: DataFrame) -> DataFrame:
    """One row: healthy when every service is, and the services that are not, by name.

    ``checks`` has one row per service, a list that is short by nature.
    """
    return checks.agg(*_status())


def observability_metrics(checks: DataFrame, metadata: DataFrame, as_of: Column) -> DataFrame:
    """One row: status, degraded services, quality of the last hour, queue and table sizes."""
    services = checks.agg(
        *_status(),
        F.coalesce(_of(API, F.col("status")), F.lit("unknown")).alias("api_status"),
        _of(API, F.lit(True)).isNotNull().alias("api_checked"),
        _of(API, F.col("error")).alias("api_error"),
        _of_healthy(QUEUE, "message_count").alias("message_count"),
        _of_healthy(DATABASE, "trip_count").alias("total_trips"),
    )
    quality = last_hour_quality(metadata, as_of)
    # one row on either side by construction: both are global aggregates
    row = quality.select(F.struct(*quality.columns).alias("quality")).scalar()
    return services.select(as_of.alias("timestamp"), "*", row.alias("_quality")) \
        .select("timestamp", *services.columns, "_quality.*")


def alerts(metrics: DataFrame) -> DataFrame:
    """One row per broken rule: type, severity, message, value."""
    average, total = F.col("avg_quality_score"), F.col("total_trips_last_hour")
    valid = F.col("valid_trips_last_hour")
    ratio = valid / F.nullif(total, F.lit(0))
    queued = F.col("message_count")
    # Type, severity and wording of each alert, in rule order.
    rules = [
        (F.col("system_status") != HEALTHY, "system_degraded", "high",
         F.concat(F.lit("services affected: "), F.array_join("degraded_services", ", ")),
         F.size("degraded_services").cast("double")),
        (F.col("api_checked") & (F.col("api_status") != HEALTHY), "api_down", "high",
         F.concat(F.lit("API down: "), F.coalesce("api_error", F.lit("not available"))),
         F.lit(None).cast("double")),
        (average < LOW_SCORE, "low_data_quality", "medium",
         F.format_string("average score %.1f", average), average),
        (ratio < LOW_VALID_RATIO, "high_invalid_data", "medium",
         F.format_string("%d of %d trips valid", valid, total), ratio),
        (queued > LONG_QUEUE, "sqs_backlog", "medium",
         F.format_string("%d messages waiting", queued), queued.cast("double")),
    ]
    fired = [
        F.when(broken, F.struct(
            F.lit(kind).alias("type"), F.lit(severity).alias("severity"),
            message.alias("message"), value.alias("value"),
        )) for broken, kind, severity, message, value in rules
    ]
    return metrics.select("timestamp", F.explode(F.array(*fired)).alias("alert")) \
        .where(F.col("alert").isNotNull()).select("timestamp", "alert.*")


def alert_summary(fired: DataFrame) -> DataFrame:
    """One row: high, medium and all alerts."""
    return fired.agg(
        F.count_if(F.col("severity") == "high").alias("high_alerts"),
        F.count_if(F.col("severity") == "medium").alias("medium_alerts"),
        F.count("*").alias("alert_count"),
    )


def alert_rows(fired: DataFrame) -> DataFrame:
    """Alerts in the layout of the alerts table, with a key that repeats on a rerun."""
    key = F.md5(F.concat_ws("|", "type", "message", F.col("timestamp").cast("string")))
    return fired.select(
        key.alias("id"), F.col("severity").alias("level"), "type", "message", "timestamp")
