"""The two quality rule sets, declared as data and evaluated in one narrow projection.

``score_stream`` judges a trip on arrival, ``score_batch`` judges stored trips again with other
rules, points and threshold. Both parse each field once, then evaluate every rule as a boolean
column, so the plan is two code-generated projections without a shuffle or a Python function.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow import schema
from tripflow.functions import parsing as P
from tripflow.functions.once import compute_once

STREAM_VALID_FROM = 50
BATCH_VALID_FROM = 60

# Bike types and member types that the stream rules accept.
BIKE_TYPES = ["electric", "classic", "docked"]
MEMBER_TYPES = ["member", "casual"]


@dataclass(frozen=True)
class Rule:
    issue: str
    points: int
    broken: Column


def apply_rules(
    df: DataFrame, rules: list[Rule], valid_from: int, score: str, issues: str, valid: str
) -> DataFrame:
    """Add score (100 less the points of broken rules, at least 0), issues in rule order, valid."""
    flags = [f"__broken_{i}" for i in range(len(rules))]
    judged = df.withColumns({
        flag: F.coalesce(rule.broken, F.lit(False)) for flag, rule in zip(flags, rules)
    })
    lost = reduce(
        lambda left, right: left + right,
        [F.when(F.col(f), rule.points).otherwise(0) for f, rule in zip(flags, rules)],
    )
    named = [F.when(F.col(f), rule.issue).otherwise("") for f, rule in zip(flags, rules)]
    kept = [F.col(c) for c in df.columns if c not in (score, issues, valid)]
    return judged.select(
        *kept,
        F.greatest(F.lit(0), F.lit(100) - lost).alias(score),
        F.array_remove(F.array(*named), "").alias(issues),
        (lost <= 100 - valid_from).alias(valid),
    )


# ---- on arrival ------------------------------------------------------------------------------


def coerce_event(df: DataFrame) -> DataFrame:
    """Parse the text fields of an event once into ``_``-prefixed helper columns.

    Fields are converted in a fixed order; an infinite number stops the conversion of the fields
    after it, which then raise no issue of their own.
    """
    age = P.or_default(F.col("rider_age"), "0")
    texts = {
        "bike": F.col("bike_id"), "start_station": F.col("start_station_id"),
        "end_station": F.col("end_station_id"), "age": age, "duration": F.col("trip_duration"),
    }
    start, end = F.col("start_time"), F.col("end_time")
    parsed = compute_once(df, {
        **{f"_{name}_number": P.to_num(text) for name, text in texts.items()},
        "_start": P.iso_ts(start), "_end": P.iso_ts(end),
        "_zones_differ": P.has_offset(start) != P.has_offset(end),
    })
    stopped = F.lit(False)
    stops, values = {}, {}
    for name in texts:
        number = F.col(f"_{name}_number")
        stops[f"_{name}_stopped"] = stopped
        stopped = stopped | P.is_infinite(number)
        values[f"_{name}"] = P.whole(number)
    return parsed.withColumns({
        **stops,
        "_conversion_failed": stopped,
        **values,
        "_comparable": F.coalesce(
            F.col("_start").isNotNull() & F.col("_end").isNotNull() & ~F.col("_zones_differ"),
            F.lit(False)),
        "_seconds": P.seconds_between(F.col("_start"), F.col("_end")),
    })


def stream_rules() -> list[Rule]:
    def unconverted(name: str) -> Column:
        return (
            F.col(f"_{name}_number").isNull() & ~F.col(f"_{name}_stopped")
        )

    start, end = F.col("_start"), F.col("_end")
    duration, age = F.col("_duration"), F.col("_age")
    member = P.or_default(F.col("member_casual"), "casual")
    same_station = F.coalesce(F.col("_start_station").cast("string"), F.col("start_station_id")) \
        .eqNullSafe(F.coalesce(F.col("_end_station").cast("string"), F.col("end_station_id")))
    readable_duration = duration.isNotNull()
    return [
        Rule("invalid_bike_id", 10, unconverted("bike")),
        Rule("invalid_start_station", 10, unconverted("start_station")),
        Rule("invalid_end_station", 10, unconverted("end_station")),
        Rule("invalid_rider_age", 10, unconverted("age")),
        Rule("invalid_trip_duration", 10, unconverted("duration")),
        Rule("invalid_member_type", 5,
             ~F.lower(member).isin(MEMBER_TYPES) & ~F.col("_conversion_failed")),
        Rule("type_conversion_error", 20, F.col("_conversion_failed")),
        Rule("duration_mismatch", 20,
             F.col("_comparable") & (F.abs(F.col("_seconds") - duration) > 60)),
        Rule("time_parsing_error", 25, ~(F.col("_comparable") & readable_duration)),
        Rule("invalid_time_sequence", 30, F.col("_comparable") & (end <= start)),
        Rule("excessive_duration", 15, duration > schema.MAX_DURATION_SECONDS),
        Rule("suspicious_age", 10, (age > 0) & ~age.between(16, 100)),
        Rule("same_station_short_trip", 5, same_station & (duration < 300)),
        Rule("invalid_bike_type", 25,
             ~F.lower(F.coalesce(F.col("bike_type"), F.lit(""))).isin(BIKE_TYPES)),
    ]


def score_stream(df: DataFrame, keep_parsed: bool = False) -> DataFrame:
    """Score events on arrival: quality_score, quality_issues, is_valid (from 50 points).

    ``keep_parsed`` leaves the ``_``-prefixed parsed columns on the rows for the writers.
    """
    columns = df.columns
    scored = apply_rules(
        coerce_event(df), stream_rules(), STREAM_VALID_FROM,
        "quality_score", "quality_issues", "is_valid",
    )
    if keep_parsed:
        return scored
    added = ["quality_score", "quality_issues", "is_valid"]
    return scored.select(*[c for c in columns if c not in added], *added)


# ---- stored trips ----------------------------------------------------------------------------


def _column(df: DataFrame, name: str) -> Column:
    """The column, or a NULL text when the frame has none of that name."""
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def _kind(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType if name in df.columns else T.StringType()


def _parsed_number(df: DataFrame, name: str) -> tuple[Column, Column]:
    """(number, unreadable): typed columns are taken as they are, text is parsed."""
    value = _column(df, name)
    if isinstance(_kind(df, name), T.StringType):
        number = P.to_num(value)
        return number, value.isNotNull() & number.isNull() & ~P.is_nan_text(value)
    number = value.cast("double")
    return F.when(~F.isnan(number), number), F.lit(False)


def _parsed_time(df: DataFrame, name: str) -> tuple[Column, Column]:
    """(time, zoned)"""
    value = _column(df, name)
    kind = _kind(df, name)
    if isinstance(kind, T.StringType):
        return P.to_ts(value), F.coalesce(P.has_offset(value), F.lit(False))
    return value.cast("timestamp_ntz"), F.lit(isinstance(kind, T.TimestampType))


def _unreadable_time(df: DataFrame, name: str, parsed: str) -> Column:
    """Some text, but no time came out of it; an empty text is missing, not unreadable."""
    if isinstance(_kind(df, name), T.StringType):
        return P.blank_to_null(_column(df, name)).isNotNull() & F.col(parsed).isNull()
    return F.lit(False)


def batch_rules(df: DataFrame) -> list[Rule]:
    def missing(name: str) -> Column:
        value = _column(df, name)
        kind = _kind(df, name)
        if isinstance(kind, T.StringType):
            return value.isNull() | (value == "")
        if isinstance(kind, (T.DoubleType, T.FloatType)):
            return value.isNull() | F.isnan(value)
        return value.isNull()

    start, end, seconds = F.col("_start"), F.col("_end"), F.col("_seconds")
    duration, age = F.col("_duration"), F.col("_age")
    same_station = _column(df, "start_station_id").cast("string").eqNullSafe(
        _column(df, "end_station_id").cast("string"))
    incomparable = (
        start.isNotNull() & end.isNotNull() & (F.col("_start_zoned") != F.col("_end_zoned"))
    )
    comparable = ~incomparable & ~F.col("_start_bad") & ~F.col("_end_bad")
    return [
        *[Rule(f"missing_{name}", 10, missing(name)) for name in schema.EVENT_REQUIRED],
        Rule("invalid_time_sequence", 25, comparable & (start > end)),
        Rule("duration_mismatch", 15, comparable & (F.abs(seconds - duration) > 60)),
        Rule("time_parsing_error", 25, ~comparable | F.col("_duration_bad")),
        Rule("invalid_age", 20, ~age.between(16, 100)),
        Rule("invalid_age_format", 10, F.col("_age_bad")),
        Rule("invalid_duration", 15, ~duration.between(60, schema.MAX_DURATION_SECONDS)),
        Rule("same_station_long_duration", 5, same_station & (duration > 3600)),
        Rule("duration_calculation_error", 15, F.col("_duration_bad")),
    ]


def score_batch(df: DataFrame) -> DataFrame:
    """Score stored trips again: replaces quality_score and quality_issues, adds is_valid_quality.

    A missing time, duration or age only counts as missing; an empty duration or age is also
    unreadable. A frame without an age column is judged with age 0.
    """
    columns = df.columns
    age = "rider_age"
    if age not in df.columns:
        number, unreadable = F.lit(0.0), F.lit(False)
    else:
        number, unreadable = _parsed_number(df, age)
    duration, duration_bad = _parsed_number(df, "trip_duration")
    start, start_zoned = _parsed_time(df, "start_time")
    end, end_zoned = _parsed_time(df, "end_time")
    parsed = compute_once(df, {
        "_age": number, "_age_bad": F.coalesce(unreadable, F.lit(False)),
        "_duration": duration, "_duration_bad": F.coalesce(duration_bad, F.lit(False)),
        "_start": start, "_start_zoned": start_zoned,
        "_end": end, "_end_zoned": end_zoned,
    }).withColumns({
        "_start_bad": _unreadable_time(df, "start_time", "_start"),
        "_end_bad": _unreadable_time(df, "end_time", "_end"),
        "_seconds": P.seconds_between(F.col("_start"), F.col("_end")),
    })
    scored = apply_rules(
        parsed, batch_rules(df), BATCH_VALID_FROM,
        "quality_score", "quality_issues", "is_valid_quality",
    )
    added = ["quality_score", "quality_issues", "is_valid_quality"]
    return scored.select(*[c for c in columns if c not in added], *added)
