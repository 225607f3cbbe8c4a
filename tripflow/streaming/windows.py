"""Hourly and daily statistics of scored trips as tumbling windows on processing time."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tripflow.functions import quality as Q
from tripflow.sources import files, log, tables


def windowed_stats(
    scored: DataFrame, width: str = "1 hour", delay: str = "10 minutes"
) -> DataFrame:
    """Trips, average score, valid and invalid per window; state is one row per open window."""
    moments = scored.withColumn("processed_at", F.col("processed_at").cast("timestamp"))
    return moments.withWatermark("processed_at", delay) \
        .groupBy(F.window("processed_at", width).alias("window")).agg(
            F.count("*").alias("trips_processed"),
            Q.exact_score_average(F.col("quality_score")).alias("avg_quality"),
            F.count_if(F.col("is_valid")).alias("valid_count"),
            F.count_if(~F.col("is_valid")).alias("invalid_count"),
        ).select(F.col("window.start").alias("hour"), "trips_processed", "avg_quality",
                 "valid_count", "invalid_count")


def hourly_stream(scored: DataFrame, delay: str = "10 minutes") -> DataFrame:
    return windowed_stats(scored, "1 hour", delay)


def daily_stream(scored: DataFrame, delay: str = "10 minutes") -> DataFrame:
    return windowed_stats(scored, "1 day", delay).withColumnRenamed("hour", "date")


def store_windows(stats: DataFrame, path: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Store every window that a micro-batch changes, open ones too; a repeated batch replaces itself.

    Only windows that the watermark leaves open stay in the state. A batch is its query's id and its number: a new
    checkpoint begins at number 0 again, and adds to what an earlier one has stored.
    """
    def run(changed: DataFrame, number: int) -> None:
        query = changed.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or ""
        changed.withColumns({"stored_at": F.current_timestamp(), "batch": F.lit(tables.batch_key(query, number))}) \
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)

    writer = stats.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(run)
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.start()


def read_windows(spark: SparkSession, path: str) -> DataFrame:
    """The last stored state of every window (its column is the first one).

    A new checkpoint reads its source from the beginning, so its windows count in place of those of an earlier
    one; windows that it hasn't reached yet stay as they were.
    """
    rows = spark.read.parquet(path)
    key = rows.columns[0]
    others = [c for c in rows.columns if c not in (key, "stored_at", "batch")]
    return rows.groupBy(key).agg(F.max_by(F.struct(*others), F.struct("stored_at", "batch")).alias("last")) \
        .select(key, "last.*")


# ---- windows that never close: sums by batch instead of state ----------------------------------

SUMS = T.StructType([
    T.StructField("start", T.TimestampType()), T.StructField("run", T.StringType()),
    T.StructField("trips", T.LongType()), T.StructField("scores", T.DecimalType(20, 2)),
    T.StructField("scored", T.LongType()), T.StructField("valid", T.LongType()), T.StructField("invalid", T.LongType()),
    T.StructField("stored_at", T.TimestampType()),
])
#: batches between two folds of the sums
FOLD_EVERY = 120


def window_sums(scored: DataFrame, width: str = "1 hour") -> DataFrame:
    """Sums of each window from which all its statistics follow; sums of batches add up to those of all rows."""
    moments = scored.withColumn("_at", F.col("processed_at").cast("timestamp"))
    return moments.groupBy(F.window("_at", width).alias("window")).agg(
        F.count("*").alias("trips"), F.sum(F.col("quality_score").cast("decimal(5,2)")).cast("decimal(20,2)").alias("scores"),
        F.count("quality_score").alias("scored"), F.count_if(F.col("is_valid")).alias("valid"),
        F.count_if(~F.col("is_valid")).alias("invalid"),
    ).select(F.col("window.start").alias("start"), "trips", "scores", "scored", "valid", "invalid")


def store_sums(
    scored: DataFrame, path: str, checkpoint: str, width: str = "1 hour", available_now: bool = False,
    fold_every: int | None = FOLD_EVERY,
) -> StreamingQuery:
    """Store the sums of every micro-batch; :func:`read_sums` adds them up.

    No window closes, so no row is too late: one that comes after its window's watermark would have passed adds
    to the stored window like any other. There is no state, and a repeated batch replaces its own folder. Rows without
    a time of processing are in no window.
    """
    def run(rows: DataFrame, number: int) -> None:
        spark = rows.sparkSession
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or ""
        if fold_every and number and number % fold_every == 0:
            fold_sums(spark, path)
        window_sums(rows, width).withColumns({
            "run": F.lit(query), "stored_at": F.current_timestamp(), "batch": F.lit(tables.batch_key(query, number)),
        }).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(f"{path}/sums")

    writer = scored.writeStream.option("checkpointLocation", checkpoint).foreachBatch(run)
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.start()


def _live(spark: SparkSession, path: str, done: dict[str, int]) -> list[str]:
    names = (f.partition("=")[2] for f in files.subfolders(spark, f"{path}/sums") if f.startswith("batch="))
    return sorted(n for n in names if not log.is_done(n, done))


def _added(spark: SparkSession, path: str, state: dict, live: list[str]) -> DataFrame:
    """A row for each window and run: the last fold and the batches after it."""
    rows = spark.createDataFrame([], SUMS)
    if state:
        rows = spark.read.schema(SUMS).parquet(f"{path}/folded/{state['fold']}")
    if live:
        rows = rows.unionByName(spark.read.schema(SUMS).parquet(*[f"{path}/sums/batch={n}" for n in live]))
    return rows.groupBy("start", "run").agg(*[
        (F.max if c == "stored_at" else F.sum)(c).cast(SUMS[c].dataType).alias(c)
        for c in SUMS.fieldNames() if c not in ("start", "run")])


def fold_sums(spark: SparkSession, path: str) -> bool:
    """Add all stored batches up into the next version; whether one was put (see ``tables.fold_metadata``)."""
    versions = log.VersionLog(spark, path)
    number, state = versions.latest()
    done = state.get("done", {})
    for name in files.subfolders(spark, f"{path}/sums"):
        if name.startswith("batch=") and log.is_done(name.partition("=")[2], done):
            files.remove(spark, f"{path}/sums/{name}")
    for name in files.subfolders(spark, f"{path}/folded"):
        if int(name[2:14]) < number:
            files.remove(spark, f"{path}/folded/{name}")
    live = _live(spark, path, done)
    if not live:
        return False
    fold = f"v={number + 1:012d}-{uuid.uuid4().hex[:8]}"
    _added(spark, path, state, live).write.parquet(f"{path}/folded/{fold}")
    if versions.put(number + 1, {"fold": fold, "done": log.extended(done, live)}):
        return True
    files.remove(spark, f"{path}/folded/{fold}")
    return False


def read_sums(spark: SparkSession, path: str) -> DataFrame:
    """Statistics of every window, as :func:`windowed_stats` names them, late rows included.

    A new checkpoint reads its source from the beginning: where it has reached a window, its sums count alone.
    """
    state = log.VersionLog(spark, path).latest()[1]
    rows = _added(spark, path, state, _live(spark, path, state.get("done", {})))
    sums = [c for c in SUMS.fieldNames() if c not in ("start", "run", "stored_at")]
    last = rows.groupBy("start").agg(F.max_by(F.struct(*sums), F.struct("stored_at", "run")).alias("s"))
    average = (F.col("s.scores") / F.nullif(F.col("s.scored"), F.lit(0)).cast("decimal(15,0)")).cast("decimal(10,2)")
    return last.select(
        F.col("start").alias("hour"), F.col("s.trips").alias("trips_processed"), average.alias("avg_quality"),
        F.col("s.valid").alias("valid_count"), F.col("s.invalid").alias("invalid_count"))
