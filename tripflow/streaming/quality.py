"""Quality look-back as a stream over bronze: each stored event is judged once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tripflow.plans.quality_batch import judge_and_store

# The schedule of the look-back.
LOOK_BACK_MINUTES = 15


def bronze_stream(
    spark: SparkSession, root: str, layout: T.StructType, form: str = "parquet"
) -> DataFrame:
    return spark.readStream.schema(layout).format(form).load(root)


def quality_stream(
    bronze: DataFrame, silver: str, reports: str, checkpoint: str,
    as_of: Column | None = None, available_now: bool = True,
) -> StreamingQuery:
    """Score new bronze rows, store silver and the report of the hour."""
    def run(batch: DataFrame, number: int) -> None:
        judge_and_store(batch, silver, reports, as_of)

    writer = bronze.writeStream.option("checkpointLocation", checkpoint).foreachBatch(run)
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{LOOK_BACK_MINUTES} minutes").start()
