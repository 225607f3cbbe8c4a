"""From raw documents to a training mixture: language ID, exact and near duplicates, benchmark text, mixing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read back as the
next stage's docs. All but the last return the columns of ``documents`` and drop rows; the last lists the
documents of the mix and how many words of each it takes.

* language_id: rows without any letter, or without text, go (``und``), and rows whose text of 50 letters or more is clearly in
  another language than their label says (``language_id.rejected``). It learns from a bounded sample of the labelled rows given to it.
* exact_dedup: of equal texts the row with the largest id stays; of rows that repeat it, one.
* near_dedup: of each component of near duplicates (five words, similarity 0.8) the row with the smallest id
  stays; rows that repeat its id stay with it only if their texts are in the same component.
* decontamination: rows that contain a passage of the benchmark go.
* mixing: a row for each document of which the mix takes words: doc_id, source, size, source_size, target, taken.

NULL ids, NULL sources and further columns pass through; empty tables give empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripflow.llm import common, decontamination, exact_dedup, language_id, mixing, near_dedup


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.keep_identified(docs, language_id.sample(docs))


def drop_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_one(docs)


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.keep_one(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.clean(docs, common.table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs).where("taken > 0")


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact),
    ("near_dedup", drop_near),
    ("decontamination", drop_benchmark),
    ("mixing", mix_sources),
]

#: Language ID, near duplicates and alignment can't be said in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read back."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


PIPELINE_QUERIES = {"pipeline": run}
PIPELINE_SQL = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
