"""Look-back over recent bronze files: judge again, report, move good trips to silver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.operators.quality import batch_quality_stats
from tripflow.operators.scoring import score_batch
from tripflow.sources.events import read_bronze_since
from tripflow.sources.tables import write_quality_report, write_silver


def judge_and_store(
    batch: DataFrame, silver: str, reports: str, as_of: Column | None = None
) -> None:
    """Score a batch once, then write its valid rows and its report. An empty batch writes none.

    The moment is read once, so that both writes fall into one hour.
    """
    if as_of is None:
        as_of = F.lit(batch.sparkSession.range(1).select(F.current_timestamp()).first()[0])
    moment = as_of
    scored = score_batch(batch).persist()
    try:
        if scored.isEmpty():
            return
        write_silver(batch.sparkSession, scored, silver, moment, ["processed_at", "ingested_at"])
        stats = batch_quality_stats(scored, moment.cast("timestamp_ntz"))
        write_quality_report(stats, reports, moment)
    finally:
        scored.unpersist()


def run_quality_batch(
    spark: SparkSession, bronze: str, silver: str, reports: str, as_of: Column,
    minutes: int = 15, form: str = "parquet",
) -> None:
    recent = read_bronze_since(spark, bronze, as_of, minutes, form)
    judge_and_store(recent, silver, reports, as_of)
