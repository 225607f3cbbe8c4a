"""Event ingest: JSON bodies to scored bronze rows, metadata arrivals and rejected rows.

Delivery is at least once from the source and once in the sinks: every sink keeps the rows of a
micro-batch under its run (the query of a checkpoint) and number, and a repeated batch replaces them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tripflow.functions import parsing as P
from tripflow.operators import keyed
from tripflow.operators.scoring import score_stream
from tripflow.sources import events as E
from tripflow.sources import tables

# Wait of the poll loop between flushes.
FLUSH_EVERY = "5 seconds"
#: helper columns of the parser that the sinks are made from
KEPT = ["_bike", "_start_station", "_end_station", "_age", "_duration", "_start", "_end", "_rejected"]
#: batches between two folds of the metadata: every ten minutes
FOLD_EVERY = 120


@dataclass(frozen=True)
class Sinks:
    bronze: str
    metadata: str
    quarantine: str
    rejected: str
    bronze_form: str = "parquet"


def coerced(scored: DataFrame) -> DataFrame:
    """Event fields as stored in bronze: whole numbers where they converted, else as they came."""
    numbers = {
        "bike_id": "_bike", "start_station_id": "_start_station",
        "end_station_id": "_end_station", "rider_age": "_age", "trip_duration": "_duration",
    }
    return scored.withColumns({
        **{name: F.coalesce(F.col(parsed).cast("string"), F.col(name))
           for name, parsed in numbers.items()},
        "member_casual": P.or_default(F.col("member_casual"), "casual"),
    })


def score_events(parsed: DataFrame, now: Column | None = None, queued: bool = False) -> DataFrame:
    """Arrival stamp, score and processing time; helper columns of the parser stay on the rows."""
    stamped = E.stamp_ingest(parsed, now, queued)
    moment = F.current_timestamp() if now is None else now
    return score_stream(stamped, keep_parsed=True) \
        .withColumn("processed_at", moment.cast("timestamp_ntz"))


def split_events(scored: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(bronze, metadata, quarantine) rows of scored events."""
    kept, poison = keyed.quarantine(scored)
    return coerced(kept), keyed.metadata_eligible(keyed.metadata_rows(kept)), poison


def write_batch(bodies: DataFrame, batch: str, sinks: Sinks, queued: bool = False) -> None:
    """Write one micro-batch to all sinks; parsed and scored once for all of them, without a shuffle."""
    scored = score_events(E.parse_bodies(bodies), queued=queued)
    # what only the rules read is not kept for the sinks
    scored = scored.drop(*[c for c in scored.columns if c.startswith("_") and c not in KEPT]).persist()
    try:
        events, rejected = E.split_rejected(scored)
        bronze, metadata, poison = split_events(events)
        tables.write_bronze(bronze, sinks.bronze, batch, sinks.bronze_form)
        tables.append_metadata(metadata, sinks.metadata, batch)
        _write_aside(poison.drop(*[c for c in poison.columns if c.startswith("_")]),
                     sinks.quarantine, batch)
        _write_aside(rejected, sinks.rejected, batch)
    finally:
        scored.unpersist()


def _write_aside(rows: DataFrame, path: str, batch: str) -> None:
    rows.withColumn("batch", F.lit(batch)).write.mode("overwrite") \
        .option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)


def ingest_stream(
    bodies: DataFrame, sinks: Sinks, checkpoint: str, available_now: bool = False,
    queued: bool = False, fold_every: int | None = FOLD_EVERY,
) -> StreamingQuery:
    """Run the ingest over a stream of JSON bodies (see ``sources.events``).

    The metadata is folded before every ``fold_every``-th batch, so that a read never finds more than so
    many batches of arrivals.
    """
    def run(df: DataFrame, number: int) -> None:
        spark = df.sparkSession
        # the id of the checkpoint's query: it outlives restarts, and a new checkpoint has another
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or ""
        if fold_every and number and number % fold_every == 0:
            tables.fold_metadata(spark, sinks.metadata)
        write_batch(df, tables.batch_key(query, number), sinks, queued)

    writer = bodies.writeStream.option("checkpointLocation", checkpoint).foreachBatch(run)
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=FLUSH_EVERY).start()
