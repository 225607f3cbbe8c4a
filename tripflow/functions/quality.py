"""Columns derived from a quality score."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripflow import schema


def quality_band(score: Column) -> Column:
    bands = iter(schema.QUALITY_BANDS)
    name, lowest = next(bands)
    label = F.when(score >= lowest, name)
    for name, lowest in bands:
        label = label.when(score >= lowest, name)
    return label.otherwise(schema.LOWEST_BAND)


def score_bucket(score: Column) -> Column:
    """Lower bound of the ten-point bucket."""
    return (F.floor(score / 10) * 10).cast("bigint")


def bucket_label(bucket: Column) -> Column:
    return F.concat_ws("-", bucket.cast("string"), (bucket + 10).cast("string"))


def status_label(valid: Column) -> Column:
    return F.when(valid, "Valid").otherwise("Invalid")


def display_time(moment: Column) -> Column:
    return F.date_format(moment, "MM/dd HH:mm:ss")


def display_score(score: Column) -> Column:
    return F.bround(score, 1)


def issues_json(issues: Column) -> Column:
    return F.to_json(issues)


def exact_average(total: Column, count: Column, precision: int, scale: int) -> Column:
    """sum / count in decimals, rounded half up once; NULL when there are no rows."""
    quotient = total.cast("decimal(20,0)") / F.nullif(count, F.lit(0)).cast("decimal(15,0)")
    return quotient.cast(f"decimal({precision},{scale})")


def exact_score_average(scores: Column, scale: int = 2) -> Column:
    """Average of decimal(5,2) scores, rounded half up to ``scale``."""
    total = F.sum(scores.cast("decimal(5,2)")).cast("decimal(20,2)")
    count = F.nullif(F.count(scores), F.lit(0)).cast("decimal(15,0)")
    return (total / count).cast(f"decimal(10,{scale})")


def percentage(part: Column, whole: Column) -> Column:
    """100 * part / whole with two decimals."""
    quotient = (part * 100).cast("decimal(20,0)") / F.nullif(whole, F.lit(0)).cast("decimal(15,0)")
    return quotient.cast("decimal(10,2)")
