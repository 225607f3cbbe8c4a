"""Spark session settings the library relies on."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    # naive and zoned times are compared in one zone
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # runtime re-planning: coalesced shuffles, split hot partitions, checked broadcasts
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # month '01' must stay text when a folder is read back
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # no Python stack walk on every column expression
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # the JVM never compiles a method above this size; such a stage runs faster operator by operator
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


SHUFFLE_TASK_BYTES = 200 * 1024 * 1024


def shuffle_partitions(moved_bytes: int, cores: int) -> int:
    """Tasks of a shuffle: about 200 MB each, and at least two per core."""
    return max(2 * cores, -(-moved_bytes // SHUFFLE_TASK_BYTES))


def build_session(
    app: str = "tripflow", master: str | None = None, moved_bytes: int | None = None,
    **overrides: str,
) -> SparkSession:
    """Session with the settings above; ``master`` is left to spark-submit unless given.

    ``moved_bytes`` is the size of the largest shuffle to expect (a full load or metadata fold
    moves whole rows). It sets the number of shuffle tasks to start from; adaptive execution merges
    them where a query moves less, but cannot cut tasks that start too large for memory.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **overrides}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if moved_bytes:
        tasks = shuffle_partitions(moved_bytes, spark.sparkContext.defaultParallelism)
        spark.conf.set("spark.sql.shuffle.partitions", str(tasks))
    return spark


def apply_settings(spark: SparkSession) -> SparkSession:
    """The settings above on a session made elsewhere, as far as they can still be changed."""
    for key, value in SETTINGS.items():
        if spark.conf.isModifiable(key):
            spark.conf.set(key, value)
    return spark


#: for jobs over whole trip files: pieces small enough to sort in memory, folders written as their rows come
FILE_JOB = {"spark.sql.files.maxPartitionBytes": "32m", "spark.sql.maxConcurrentOutputFileWriters": "16"}


@contextmanager
def using(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """These settings for the jobs run inside."""
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for ``checkpoint()``: the cluster's own one, else a folder for a local run."""
    context = spark.sparkContext
    current = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not context.getCheckpointDir():
            context.setCheckpointDir(current)
        return current
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    current = tempfile.mkdtemp(prefix="tripflow-checkpoint-")
    context.setCheckpointDir(current)
    return current
