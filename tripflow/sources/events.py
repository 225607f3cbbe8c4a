"""Trip events: JSON bodies to text columns, arrival stamp, stored events by age."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow import schema
from tripflow.functions import parsing as P
from tripflow.functions.once import compute_once
from tripflow.sources import bronze


# bounds of a micro-batch, so that a backlog comes in pieces
MAX_FILES = 1000
MAX_OFFSETS = 1_000_000


def file_events(spark: SparkSession, path: str, max_files: int = MAX_FILES) -> DataFrame:
    """Stream of JSON bodies, one per line, from files that arrive in a folder."""
    return spark.readStream.format("text").option("maxFilesPerTrigger", max_files).load(path)


def kafka_events(
    spark: SparkSession, servers: str, topic: str, max_offsets: int = MAX_OFFSETS
) -> DataFrame:
    """Stream of JSON bodies from a topic; needs the Kafka package on the class path."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers) \
        .option("subscribe", topic).option("maxOffsetsPerTrigger", max_offsets)
    return reader.load().select(F.col("value").cast("string").alias("value"))


def parse_bodies(bodies: DataFrame, column: str = "value") -> DataFrame:
    """JSON bodies to text fields with defaults, parsed once per row.

    ``_rejected`` holds the body of a row that lacks a required field, and is NULL on good rows.
    """
    rows = compute_once(
        bodies.select(F.col(column).alias("_body")),
        {"event": F.from_json("_body", schema.EVENT, {"mode": "PERMISSIVE"})},
    ).select("_body", "event.*")
    incomplete = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in schema.EVENT_REQUIRED])
    return rows.withColumns({
        "rider_age": F.coalesce("rider_age", F.lit("0")),
        "member_casual": F.coalesce("member_casual", F.lit("casual")),
        "_rejected": F.when(incomplete, F.coalesce("_body", F.lit(""))),
    }).drop("_body")


def split_rejected(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows without a reason to reject, rejected bodies) of parsed rows."""
    kept = rows.where(F.col("_rejected").isNull()).drop("_rejected")
    rejected = rows.where(F.col("_rejected").isNotNull())
    return kept, rejected.select(F.col("_rejected").alias("body"))


def parse_events(bodies: DataFrame, column: str = "value") -> tuple[DataFrame, DataFrame]:
    """(events, rejected): a body without a required field is rejected."""
    return split_rejected(parse_bodies(bodies, column))


def stamp_ingest(events: DataFrame, now: Column | None = None, queued: bool = False) -> DataFrame:
    """Arrival time in UTC, as text like the other event fields.

    At the door the stamp is always ours, whatever a sender wrote. ``queued`` bodies have passed the door
    before: their stamp stays, and one is given only where it lacks.
    """
    moment = F.current_timestamp() if now is None else now
    stamp = F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    own = F.coalesce(P.blank_to_null(F.col("ingested_at")), stamp) if queued else stamp
    return events.withColumn("ingested_at", own)


def read_bronze_since(
    spark: SparkSession, root: str, as_of: Column, minutes: int = 15, form: str = "parquet",
    layout: T.StructType | None = None,
) -> DataFrame:
    """Stored events of files written in the last minutes, both ends included.

    A bronze folder with an index of arrivals (see :mod:`tripflow.sources.bronze`) is listed only where the bounds
    ask for it. In other folders the bounds are on file metadata: all files are listed, those outside the bounds are
    dropped from the scan unopened. Adds the file's path, size and time. Without a ``layout`` JSON
    files of a folder without an index are all read once more to infer one.
    """
    upper = as_of.cast("timestamp")
    lower = upper - F.make_dt_interval(mins=F.lit(minutes))
    if bronze.has_index(spark, root):
        # the bounds name the folders, so their values are needed now
        first, last = spark.range(1).select(F.unix_micros(lower), F.unix_micros(upper)).first()
        lower, upper = F.timestamp_micros(F.lit(first)), F.timestamp_micros(F.lit(last))
        rows = bronze.read_between(spark, root, first // 1000, last // 1000, form, layout)
        written = F.col("_last_modified")
        return rows.where((written >= lower) & (written <= upper))
    # a file may be gone by now (compacted); a damaged one fails the read, it is never half read
    reader = spark.read.option("ignoreMissingFiles", True)
    if form == "json":
        # a file may hold one event, or an array of events
        reader = reader.option("multiLine", True).option("mode", "PERMISSIVE")
    if layout is not None:
        reader = reader.schema(layout)
    rows = reader.format(form).load(root)
    written = F.col("_metadata.file_modification_time")
    return rows.where((written >= lower) & (written <= upper)).select(
        *[c for c in rows.columns if c != "_corrupt_record"],
        F.col("_metadata.file_path").alias("_file_path"),
        F.col("_metadata.file_size").alias("_file_size"),
        written.alias("_last_modified"),
    )
