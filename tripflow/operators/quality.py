"""Quality queries on the trip metadata table and on freshly scored batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow import schema
from tripflow.functions import quality as Q
from tripflow.functions import trips as C

# Rows of the two recent lists.
RECENT_TRIPS = 10
RECENT_SCORES = 5


def _valid(column: str = "is_valid") -> Column:
    return F.count_if(F.col(column))


def _invalid(column: str = "is_valid") -> Column:
    return F.count_if(~F.col(column))


def _mean(column: str = "quality_score") -> Column:
    """Unrounded average as a double, from an exact sum."""
    return F.sum(column).cast("double") / F.nullif(F.count(column), F.lit(0))


# ---- views -----------------------------------------------------------------------------------


def quality_summary(metadata: DataFrame) -> DataFrame:
    """Per processing day: trips, valid, invalid, average score, valid percentage."""
    return metadata.groupBy(C.day(F.col("processed_at")).alias("date")).agg(
        F.count("*").alias("total_trips"),
        _valid().alias("valid_trips"),
        _invalid().alias("invalid_trips"),
        Q.exact_score_average(F.col("quality_score")).alias("avg_quality_score"),
        Q.percentage(_valid(), F.count("*")).alias("valid_percentage"),
    ).orderBy(F.desc("date"))


def issue_frequency(metadata: DataFrame) -> DataFrame:
    """Trips per issue and their share of all trips, those without an issue included.

    Trips are folded to one row per combination of issues, of which there are few; the issues are
    unnested from these rows and the total is taken from the same aggregation. The outer unnesting
    keeps both uses of that aggregation alike, so that it runs once and its result is reused.
    """
    combinations = metadata.groupBy("quality_issues").agg(F.count("*").alias("trips"))
    total = combinations.agg(F.sum("trips")).scalar()
    unnested = combinations.select(F.explode_outer("quality_issues").alias("issue"), "trips")
    return unnested.where(F.col("issue").isNotNull()).groupBy("issue").agg(F.sum("trips").alias("frequency")) \
        .select("issue", "frequency", Q.percentage(F.col("frequency"), total).alias("percentage")) \
        .orderBy(F.desc("frequency"), "issue")


def hourly_stats(metadata: DataFrame) -> DataFrame:
    return metadata.groupBy(C.hour_start(F.col("processed_at")).alias("hour")).agg(
        F.count("*").alias("trips_processed"),
        Q.exact_score_average(F.col("quality_score")).alias("avg_quality"),
        _valid().alias("valid_count"),
        _invalid().alias("invalid_count"),
    ).orderBy(F.desc("hour"))


# ---- dashboard -------------------------------------------------------------------------------


def overview(metadata: DataFrame) -> DataFrame:
    return metadata.agg(
        F.count("*").alias("total_trips"),
        _mean().alias("avg_quality_score"),
        _valid().alias("valid_trips"),
        _invalid().alias("invalid_trips"),
    )


def score_histogram(metadata: DataFrame) -> DataFrame:
    bucket = Q.score_bucket(F.col("quality_score")).alias("score_bucket")
    return metadata.groupBy(bucket).agg(F.count("*").alias("trips")) \
        .select("score_bucket", Q.bucket_label(F.col("score_bucket")).alias("score_range"), "trips") \
        .orderBy("score_bucket")


def validity_split(metadata: DataFrame) -> DataFrame:
    return metadata.groupBy("is_valid").agg(F.count("*").alias("trips")) \
        .select(Q.status_label(F.col("is_valid")).alias("status"), "trips")


def hourly_trend(metadata: DataFrame, as_of: Column) -> DataFrame:
    """Trips and average score per hour of the 24 hours before ``as_of``."""
    recent = metadata.where(F.col("processed_at") >= as_of - F.expr("INTERVAL '24' HOUR"))
    return recent.groupBy(C.hour_start(F.col("processed_at")).alias("hour")).agg(
        F.count("*").alias("trips"), _mean().alias("avg_quality"),
    ).orderBy("hour")


def trips_by_bike_type(metadata: DataFrame) -> DataFrame:
    return metadata.groupBy("bike_type").agg(F.count("*").alias("trips")) \
        .orderBy(F.desc("trips"), "bike_type")


def trips_by_member(metadata: DataFrame) -> DataFrame:
    return metadata.where(F.col("member_casual").isNotNull()).groupBy("member_casual") \
        .agg(F.count("*").alias("trips")).orderBy(F.desc("trips"), "member_casual")


def recent_trips(metadata: DataFrame, n: int = RECENT_TRIPS) -> DataFrame:
    """Newest processed trips in display form."""
    newest = metadata.select("trip_id", "bike_type", "quality_score", "is_valid", "processed_at") \
        .orderBy(F.desc("processed_at"), "trip_id").limit(n)
    return newest.select(
        "trip_id", "bike_type",
        Q.display_score(F.col("quality_score")).alias("quality"),
        Q.status_label(F.col("is_valid")).alias("status"),
        Q.display_time(F.col("processed_at")).alias("processed_at"),
    )


def recent_scores(metadata: DataFrame, n: int = RECENT_SCORES) -> DataFrame:
    return metadata.orderBy(F.desc("processed_at"), "trip_id").limit(n) \
        .select("trip_id", "quality_score", "is_valid")


# ---- checks ----------------------------------------------------------------------------------


def last_hour_quality(metadata: DataFrame, as_of: Column) -> DataFrame:
    """One row: average score (0 without trips), trips and valid trips of the last hour."""
    recent = metadata.where(F.col("processed_at") >= as_of - F.expr("INTERVAL '1' HOUR"))
    return recent.agg(
        F.coalesce(_mean(), F.lit(0.0)).alias("avg_quality_score"),
        F.count("*").alias("total_trips_last_hour"),
        _valid().alias("valid_trips_last_hour"),
    )


def validity_totals(metadata: DataFrame) -> DataFrame:
    return metadata.agg(
        _mean().alias("avg_score"), _valid().alias("valid_count"),
        _invalid().alias("invalid_count"),
    )


def processed_on(metadata: DataFrame, day: Column) -> DataFrame:
    """Number of trips processed on a day."""
    start = day.cast("timestamp_ntz")
    return metadata.where(
        (F.col("processed_at") >= start)
        & (F.col("processed_at") < start + F.expr("INTERVAL '1' DAY"))
    ).agg(F.count("*").alias("trips"))


def reconcile(sent: DataFrame, stored: DataFrame, key: str = "trip_id") -> DataFrame:
    """One row: distinct keys sent, keys of them that are not stored, and the loss in percent."""
    keys = sent.select(key).distinct()
    found = stored.select(F.col(key).alias("_stored")).distinct()
    joined = keys.join(found, F.col(key) == F.col("_stored"), "left")
    lost = F.count_if(F.col("_stored").isNull())
    return joined.agg(
        F.count("*").alias("sent"),
        lost.alias("lost"),
        F.coalesce(Q.percentage(lost, F.count("*")), F.lit(0).cast("decimal(10,2)"))
        .alias("loss_percentage"),
    )


# ---- freshly scored batches ------------------------------------------------------------------


def quality_bands(scored: DataFrame) -> DataFrame:
    """Rows per quality band."""
    return scored.groupBy(Q.quality_band(F.col("quality_score")).alias("quality_band")) \
        .agg(F.count("*").alias("trips"))


def batch_quality_stats(scored: DataFrame, as_of: Column) -> DataFrame:
    """One report row: rows per band, total, valid, invalid, average score, time of the report."""
    band = Q.quality_band(F.col("quality_score"))
    names = [name for name, _ in schema.QUALITY_BANDS] + [schema.LOWEST_BAND]
    return scored.agg(
        F.struct(*[F.count_if(band == name).alias(name) for name in names]).alias("quality_bands"),
        F.count("*").alias("total_records"),
        _valid("is_valid_quality").alias("valid_records"),
        _invalid("is_valid_quality").alias("invalid_records"),
        _mean().alias("avg_score"),
    ).withColumn("timestamp", as_of)


def batch_profile(batch: DataFrame) -> DataFrame:
    """Rows and first and last arrival per bike type of a batch."""
    return batch.groupBy("bike_type").agg(
        F.count("*").alias("trips"),
        F.min("ingested_at").alias("min_ingested_at"),
        F.max("ingested_at").alias("max_ingested_at"),
    )
