"""Set operations: union of frames, difference of file sets, structure check."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.operators.keyed import anti_join


def union_all(frames: list[DataFrame]) -> DataFrame:
    """All rows of all frames, by column name; a missing column is NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def difference(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """Rows of ``left`` whose key is absent on the right."""
    return anti_join(left, right, [on], null_safe=True)


def schema_check(df: DataFrame, expected: list[str], key: list[str]) -> DataFrame:
    """(kind, item) findings: missing and extra columns, and keys that occur more than once.

    Duplicate keys are one finding with their number, so the result stays short.
    """
    spark = df.sparkSession
    columns = [("missing", c) for c in expected if c not in df.columns]
    columns += [("extra", c) for c in df.columns if c not in expected]
    findings = spark.createDataFrame(columns, "kind string, item string")
    if not set(key) <= set(df.columns):
        return findings
    repeated = df.groupBy(*key).agg(F.count("*").alias("n")).where(F.col("n") > 1)
    count = repeated.agg(F.count("*").alias("keys")).where(F.col("keys") > 0).select(
        F.lit("duplicate_key").alias("kind"),
        F.concat(F.lit(",".join(key) + ": "), F.col("keys").cast("string")).alias("item"),
    )
    return findings.unionByName(count)
