"""Stored tables on plain Parquet: appended, replaced by partition, or kept as versions.

No writer overwrites a folder that its own plan reads: results that replace what they were made
from are first written to the checkpoint folder of the cluster, so a lost executor costs a task
and never the table.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow import schema
from tripflow.operators import keyed
from tripflow.session import FILE_JOB, ensure_checkpoint_dir, using
from tripflow.sources import files, log
from tripflow.sources.bronze import note_arrival
from tripflow.sources.key_index import KeyIndex


def read_table(spark: SparkSession, path: str, view: str | None = None) -> DataFrame:
    """Stored table, with a temporary view of that name for SQL."""
    df = spark.read.parquet(path)
    if view:
        df.createOrReplaceTempView(view)
    return df


def read_jdbc(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """Table of a relational database, split by the given JDBC partition options."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def _read_or_empty(spark: SparkSession, path: str, layout: T.StructType) -> DataFrame:
    if not files.exists(spark, path):
        return spark.createDataFrame([], layout)
    return spark.read.schema(layout).parquet(path)


def replace_partitions(df: DataFrame, path: str, by: list[str]) -> None:
    """Replace the partitions that occur in the rows, leave all others.

    The rebalance hint keeps a partition with many rows in several files and tasks.
    """
    df.hint("rebalance", *by).write.mode("overwrite") \
        .option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


# ---- warehouse trips -------------------------------------------------------------------------


def append_trips(rows: DataFrame, path: str, by_month: bool = False) -> None:
    """Rows that are read month by month (``by_month``) are written by the tasks that hold them."""
    (rows if by_month else rows.hint("rebalance", "year_month")).write.mode("append") \
        .option("compression", "zstd").partitionBy("year_month").parquet(path)


def trip_index(spark: SparkSession, path: str) -> KeyIndex:
    """Filters of the stored ride ids, beside the months of the trips."""
    return KeyIndex(spark, path, f"{path.rstrip('/')}/_ride_ids", "ride_id", "year_month")


def keys_folder(spark: SparkSession) -> str:
    """A new name for the keys of a merge."""
    return f"{ensure_checkpoint_dir(spark)}/tripflow-keys-{uuid.uuid4().hex}"


def store_keys(new: DataFrame, folder: str, *more: Column) -> DataFrame:
    """Month and ride id of each new trip, as bytes, stored under ``keys`` in a folder; the trips need not be read again for them.

    ``more`` are further columns to store. A digest hardly ever comes twice, so no dictionary of them is tried.
    """
    new.select(F.col("year_month").alias("month"), *keyed.short_key(F.col("ride_id")), *more) \
        .write.option("compression", "zstd").option("parquet.enable.dictionary#digest", "false").parquet(f"{folder}/keys")
    return new.sparkSession.read.parquet(f"{folder}/keys")


def fresh_trips(
    spark: SparkSession, path: str, new: DataFrame, order: list[str], months: list[str], listing: str,
    ids: DataFrame | None = None,
) -> DataFrame | None:
    """The new trips whose ride id their month doesn't hold, of equal ids the first in order; None if there are none.

    Keys move, rows don't: the keys of the new trips are counted together with those of the stored files that may
    hold one of them. What is listed of them is short, and joined with the rows: in a month that is mostly new the
    keys that are stored or come twice, in one that is mostly stored the others. Only rows whose key comes
    twice, or is one of the few new ones, are ranked. The list is stored in the new folder ``listing``. ``ids`` are
    the keys where they have been stored (:func:`store_keys`).
    """
    index = trip_index(spark, path)
    if ids is None:
        ids = new.select(F.col("year_month").alias("month"), *keyed.short_key(F.col("ride_id")))
    rows_of = {r.month: r.n for r in ids.groupBy("month").agg(F.count("*").alias("n")).collect()}
    paths, met = index.hits(
        ids.select("month", keyed.long_key(F.col("digest"), F.col("text")).alias("key")), months, sum(rows_of.values()))
    held = sorted(m for m, n in met.items() if 2 * n > rows_of.get(m, 0))  # this is a matter of cost alone
    in_held = F.coalesce(F.col("month").isin(held), F.lit(False)) if held else F.lit(False)
    counted = keyed.key_counts(ids, index.keys(paths))
    counted.where(F.when(in_held, ~F.col("stored")).otherwise(F.col("stored") | (F.col("n") > 1))) \
        .write.option("compression", "zstd").parquet(listing)
    listed = spark.read.parquet(listing)
    # one row: what there is to do
    todo = listed.agg(F.bool_or(~F.col("stored")).alias("ranked"), F.bool_or(~in_held).alias("dropped")).first()
    keys = ["year_month", "digest", "text"]
    rows = new.select("*", *keyed.short_key(F.col("ride_id")))
    parts = []
    if set(rows_of or months) - set(held):
        plain = rows.where(~F.col("year_month").isin(held) | F.col("year_month").isNull()) if held else rows
        named = listed.where(~in_held).withColumnRenamed("month", "year_month")
        parts.append(keyed.anti_join(plain, named, keys, null_safe=True) if todo.dropped else plain)
    if todo.ranked:
        named = listed.where(~F.col("stored")).withColumnRenamed("month", "year_month")
        parts.append(keyed.first_per_key(keyed.semi_join(rows, named, keys), schema.MONTH_KEY, order))
    return reduce(DataFrame.unionByName, parts).drop("digest", "text") if parts else None


def merge_trips(
    spark: SparkSession, path: str, new: DataFrame, loaded_at: Column, order: list[str],
    months: list[str] | None = None, by_month: bool = False, keys: str | None = None,
) -> None:
    """Append the new trips whose ride id their month doesn't hold; of equal ids the first in order.

    A ride id stands once in a month (and so does a ride id and its start). Stored files are read, their
    ids alone, only where the filters of the month say that one of the new ids may be there.
    ``new`` is read more than once: pass rows that are cheap to read again; its keys are stored meanwhile, in the folder
    ``keys`` if the caller has done so (:func:`store_keys`), which is removed. The months of the new rows are a short
    list (twelve a year), collected to name the folders unless the caller knows them. ``by_month``: the rows are read
    month by month, so that they can be written where they are.
    """
    if months is None:
        months = [r.year_month for r in new.select("year_month").distinct().collect()]
    if not months:
        if keys:
            files.remove(spark, keys)
        return
    with using(spark, FILE_JOB):
        if keys is None:
            keys = keys_folder(spark)
            ids = store_keys(new, keys)
        else:
            ids = spark.read.parquet(f"{keys}/keys")
        fresh = fresh_trips(spark, path, new, order, months, f"{keys}/listed", ids)
        if fresh is not None:
            append_trips(fresh.withColumn("load_timestamp", loaded_at).select(*schema.TRIPS.fieldNames()), path, by_month)
        files.remove(spark, keys)
        trip_index(spark, path).catch_up(months)


# ---- small tables as versions ----------------------------------------------------------------


def _latest(spark: SparkSession, root: str) -> int | None:
    """Newest complete version; one without its success mark is the rest of a failed job."""
    numbers = sorted(
        (int(name[2:]) for name in files.subfolders(spark, root) if name.startswith("v=")),
        reverse=True)
    return next((n for n in numbers if files.exists(spark, f"{root}/v={n}/_SUCCESS")), None)


def read_snapshot(spark: SparkSession, root: str, layout: T.StructType) -> DataFrame:
    latest = _latest(spark, root)
    if latest is None:
        return spark.createDataFrame([], layout)
    return spark.read.schema(layout).parquet(f"{root}/v={latest}")


def write_snapshot(spark: SparkSession, root: str, df: DataFrame) -> int:
    """Write the next version; readers see it once it is complete."""
    number = (_latest(spark, root) or 0) + 1
    df.write.mode("overwrite").parquet(f"{root}/v={number}")
    return number


def save_stations(spark: SparkSession, root: str, new: DataFrame) -> int:
    current = read_snapshot(spark, root, schema.STATIONS)
    return write_snapshot(spark, root, keyed.upsert_stations(current, new))


def save_ledger(spark: SparkSession, root: str, new: DataFrame) -> int:
    current = read_snapshot(spark, root, schema.LEDGER)
    return write_snapshot(spark, root, keyed.upsert_ledger(current, new))


# ---- trip metadata: arrivals by batch, folded when read --------------------------------------

ARRIVALS = T.StructType([
    *schema.TRIP_METADATA.fields,
    T.StructField("tie", T.LongType()), T.StructField("batch", T.StringType()),
])
# the stamp of receipt decides, then the batch (batches of a run arrive in turn), then the content
ARRIVAL_ORDER = ["ingested_at", "batch", "tie"]


def batch_key(run: str, batch: int) -> str:
    """Name of a micro-batch: the run (one for each checkpoint) and the number in it.

    A number alone isn't enough: with a new checkpoint, or a second query on the same sinks, numbers
    begin at 0 again.
    """
    return f"{run}-{batch:012d}"


def append_metadata(rows: DataFrame, root: str, batch: str) -> None:
    """Store the arrivals of one batch; the same batch written again replaces itself.

    A stored table grows by what arrives: nothing already stored is read or rewritten here.
    """
    columns = schema.TRIP_METADATA.fieldNames()
    rows.select(
        *columns, F.xxhash64(*columns).alias("tie"), F.lit(batch).alias("batch"),
    ).write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy("batch").parquet(f"{root}/arrivals")


def _arrived(spark: SparkSession, root: str, done: dict[str, int]) -> list[str]:
    """Batches with arrivals that the fold doesn't hold."""
    names = {f.split("=", 1)[1] for f in files.subfolders(spark, f"{root}/arrivals") if f.startswith("batch=")}
    return sorted(n for n in names if not log.is_done(n, done))


def _fold(spark: SparkSession, root: str, state: dict) -> DataFrame:
    """The fold that a version names."""
    if not state:
        return spark.createDataFrame([], schema.TRIP_METADATA)
    return spark.read.schema(schema.TRIP_METADATA).parquet(f"{root}/folded/{state['fold']}")


def _metadata(spark: SparkSession, root: str, state: dict, arrived: list[str], refresh_valid: bool) -> DataFrame:
    folded = _fold(spark, root, state)
    if not arrived:
        return folded
    # only the folders of these batches: others may be going away
    arrivals = spark.read.schema(ARRIVALS).option("basePath", f"{root}/arrivals") \
        .parquet(*[f"{root}/arrivals/batch={batch}" for batch in arrived])
    ids = arrivals.select("trip_id").distinct()
    again = folded.join(ids, "trip_id", "left_semi").select(*folded.columns)
    changed = keyed.upsert_metadata(again, arrivals, ARRIVAL_ORDER, refresh_valid)
    return keyed.anti_join(folded, ids, ["trip_id"]).unionByName(changed)


def read_metadata(spark: SparkSession, root: str, refresh_valid: bool = False) -> DataFrame:
    """The metadata table: last fold plus the arrivals after it, one row per trip.

    Only trips that have arrived since are folded again; all others come from the stored fold as they
    are, so filters and columns reach its files, and nothing of it is sorted or aggregated.
    """
    state = log.VersionLog(spark, root).latest()[1]
    return _metadata(spark, root, state, _arrived(spark, root, state.get("done", {})), refresh_valid)


def fold_metadata(spark: SparkSession, root: str) -> bool:
    """Fold all finished batches into the next version; whether one was put.

    One log entry names the fold and, for each run, the last batch in it, so rows and batches change together: a crash
    before it leaves the version as it was, and of two writers one is void. Arrivals that the version read here
    already holds are removed now, not when it was put, so that a reader of the version before keeps its files.
    """
    versions = log.VersionLog(spark, root)
    number, state = versions.latest()
    done = state.get("done", {})
    for name in files.subfolders(spark, f"{root}/arrivals"):
        if name.startswith("batch=") and log.is_done(name.split("=", 1)[1], done):
            files.remove(spark, f"{root}/arrivals/{name}")
    for name in files.subfolders(spark, f"{root}/folded"):
        # folds before the last one, and those of writers that died or were too late long ago
        if int(name[2:14]) < number:
            files.remove(spark, f"{root}/folded/{name}")
    arrived = _arrived(spark, root, done)
    if not arrived:
        return False
    fold = f"v={number + 1:012d}-{uuid.uuid4().hex[:8]}"
    _metadata(spark, root, state, arrived, False).write.parquet(f"{root}/folded/{fold}")
    if versions.put(number + 1, {"fold": fold, "done": log.extended(done, arrived)}):
        return True
    files.remove(spark, f"{root}/folded/{fold}")
    return False


# ---- bronze, silver, reports -----------------------------------------------------------------


def write_bronze(rows: DataFrame, path: str, batch: str, form: str = "parquet") -> None:
    """Scored events under year and month of their start; a batch (see :func:`batch_key`) written
    again replaces itself. Its folders are then entered in the index of arrivals."""
    start = F.col("_start")
    stored = rows.where(start.isNotNull()).withColumns({
        "year": F.date_format(start, "yyyy"), "month": F.date_format(start, "MM"),
        "batch": F.lit(batch),
    })
    stored = stored.drop(*[c for c in stored.columns if c.startswith("_")])
    with using(rows.sparkSession, FILE_JOB):
        stored.write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
            .partitionBy("year", "month", "batch").format(form).save(path)
    note_arrival(rows.sparkSession, path, batch, stored.schema)


def _at(df: DataFrame, as_of: Column) -> DataFrame:
    return df.withColumns({
        "date": F.date_format(as_of, "yyyy-MM-dd"), "hour": F.date_format(as_of, "HH")})


def write_silver(
    spark: SparkSession, scored: DataFrame, path: str, as_of: Column, order: list[str]
) -> None:
    """Valid trips under date and hour of processing; within an hour the last of a trip stays.

    The rows already stored for the hour are merged in; the merged rows pass through the
    checkpoint folder before they replace the hour.
    """
    new = _at(scored.where(F.col("is_valid_quality")), as_of)
    # a last tie-break by content, so that a repeated run keeps the same row
    plain = [c for c, kind in new.dtypes if not kind.startswith(("array", "map", "struct"))]
    latest = [*[F.desc(c) for c in order], F.xxhash64(*plain)]
    rows = keyed.first_per_key(new, ["date", "hour", "trip_id"], latest)
    if files.exists(spark, path):
        stored = spark.read.schema(rows.schema).parquet(path).where(
            (F.col("date") == F.date_format(as_of, "yyyy-MM-dd"))
            & (F.col("hour") == F.date_format(as_of, "HH")))
        kept = keyed.anti_join(stored, rows, ["date", "hour", "trip_id"])
        ensure_checkpoint_dir(spark)
        rows = rows.unionByName(kept).checkpoint()
    replace_partitions(rows, path, ["date", "hour"])


def write_quality_report(stats: DataFrame, path: str, as_of: Column) -> None:
    """One report per date and hour; the last run of an hour stays."""
    _at(stats, as_of).write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy("date", "hour").parquet(path)


def write_monitoring(metrics: DataFrame, alerts: DataFrame, path: str, as_of: Column) -> None:
    """Metrics of a minute, and its alerts when there are any."""
    minute = F.date_format(as_of, "HHmm")
    _at(metrics, as_of).withColumn("minute", minute).write.mode("overwrite") \
        .option("partitionOverwriteMode", "dynamic") \
        .partitionBy("date", "hour", "minute").parquet(f"{path}/system_metrics")
    # one row with all alerts of the run: rules are few, so the list is short
    fired = alerts.agg(
        F.max("timestamp").alias("timestamp"), F.count("*").alias("alert_count"),
        F.collect_list(F.struct("type", "severity", "message", "value")).alias("alerts"),
    ).where(F.col("alert_count") > 0)
    _at(fired, as_of).withColumn("minute", minute).write.mode("overwrite") \
        .option("partitionOverwriteMode", "dynamic") \
        .partitionBy("date", "hour", "minute").parquet(f"{path}/alerts")
