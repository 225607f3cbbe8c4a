"""Trip tables derived from the driver's tables, row for row and over the whole tables.

``events`` becomes raw trip events (text), ``lineitem`` becomes raw and typed monthly trips,
``orders`` and ``customer`` become file listings. Rows are damaged by rules on their own values so
that every check of the library has something to find. No row is left out.
"""

from __future__ import annotations

import csv
import io
import zipfile
from functools import reduce

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.functions import trips as C
from tripflow.operators.keyed import metadata_eligible, metadata_rows, quarantine
from tripflow.operators.scoring import score_stream
from tripflow.session import FILE_JOB, using

THIS_YEAR = 2026


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _every(key: str, n: int) -> Column:
    return F.col(key) % n == 0


def _plus(moment: Column, seconds: Column) -> Column:
    micros = F.unix_micros(moment.cast("timestamp")) + seconds * 1000000
    return F.timestamp_micros(micros).cast("timestamp_ntz")


# ---- events ----------------------------------------------------------------------------------


def as_trip_events(events: DataFrame) -> DataFrame:
    """Rows of ``events`` as raw trip events: text fields, some damaged; works on a stream too."""
    base = events.select(
        "event_id", "user_id", "event_type", F.col("ts").cast("timestamp_ntz").alias("ts"),
        F.date_trunc("second", "ts").cast("timestamp_ntz").alias("start"),
        F.floor(F.col("value") * 60).cast("bigint").alias("seconds"),
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
    )
    end = F.when(_every("event_id", 41), _plus(F.col("start"), F.lit(-100))) \
        .otherwise(_plus(F.col("start"), F.col("seconds")))
    reported = F.when(_every("event_id", 53), F.lit(90000)) \
        .when(_every("event_id", 43), F.col("seconds") + 3600).otherwise(F.col("seconds"))
    iso = "yyyy-MM-dd'T'HH:mm:ss"
    kind = F.col("event_type")
    return base.select(
        F.concat(F.lit("trip_"), F.col("event_id")).alias("trip_id"),
        F.when(_every("event_id", 37), "abc")
        .when(_every("event_id", 31), F.concat(F.col("user_id"), F.lit(".9")))
        .otherwise(F.col("user_id").cast("string")).alias("bike_id"),
        F.when(_every("event_id", 59), "x")
        .when(_every("event_id", 47), F.date_format("start", iso))
        .otherwise(F.concat(F.date_format("start", iso), F.lit("Z"))).alias("start_time"),
        F.concat(F.date_format(end, iso), F.lit("Z")).alias("end_time"),
        (F.col("user_id") % 50).cast("string").alias("start_station_id"),
        (F.col("k") % 50).cast("string").alias("end_station_id"),
        F.when(_every("event_id", 29), F.lit(None)).when(_every("event_id", 71), "abc")
        .otherwise((F.col("k") + 5).cast("string")).alias("rider_age"),
        F.when(_every("event_id", 61), "abc").otherwise(reported.cast("string"))
        .alias("trip_duration"),
        F.when(kind == "click", "electric").when(kind == "view", "classic")
        .when(kind == "purchase", "docked").when(kind == "signup", "cargo").otherwise("")
        .alias("bike_type"),
        F.when(_every("event_id", 67), "guest").when(F.col("event_id") % 3 == 0, "member")
        .when(F.col("event_id") % 3 == 1, "casual").alias("member_casual"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("ingested_at"),
        F.lit(None).cast("string").alias("source_ip"),
        F.col("ts").alias("processed_at"),
    )


def trip_events(spark: SparkSession, sf: str) -> DataFrame:
    return as_trip_events(table(spark, sf, "events").repartition("event_id"))


def scored_events(spark: SparkSession, sf: str) -> DataFrame:
    return score_stream(trip_events(spark, sf), keep_parsed=True)


def trip_metadata(spark: SparkSession, sf: str) -> DataFrame:
    """Metadata rows of all events that reach the table."""
    kept, _ = quarantine(scored_events(spark, sf))
    return metadata_eligible(metadata_rows(kept))


def resent_metadata(spark: SparkSession, sf: str) -> DataFrame:
    """The same rows under one trip id per rider and day, so that ids repeat."""
    day = F.date_format("processed_at", "yyyyMMdd")
    return trip_metadata(spark, sf).withColumn(
        "trip_id", F.concat(F.lit("u"), F.col("bike_id"), F.lit("d"), day))


def last_event(spark: SparkSession, sf: str) -> Column:
    """The moment of the queries that look back: the newest event."""
    return table(spark, sf, "events").agg(F.max(F.col("ts").cast("timestamp_ntz"))).scalar()


def health_checks(spark: SparkSession, sf: str) -> DataFrame:
    """One row per service, made from the totals of one event type each."""
    kind = F.col("event_type")
    service = F.when(kind == "click", "api").when(kind == "view", "s3") \
        .when(kind == "purchase", "postgresql").when(kind == "signup", "sqs").otherwise("worker")
    totals = table(spark, sf, "events").groupBy(service.alias("service")).agg(
        F.count("*").alias("events"), F.sum(F.floor("value").cast("bigint")).alias("units"))
    down = F.col("units") % 2 == 0
    return totals.select(
        "service",
        F.when(F.col("service") == "sqs", "healthy").when(down, "unhealthy").otherwise("healthy")
        .alias("status"),
        F.when(down, F.concat(F.lit("units "), F.col("units"))).alias("error"),
        F.col("events").alias("message_count"), F.col("events").alias("trip_count"),
    )


# ---- monthly trips ---------------------------------------------------------------------------

def _trip_base(lines: DataFrame) -> DataFrame:
    spread = F.col("l_partkey") * 7919 + F.col("l_suppkey") * 104729 + F.col("l_orderkey") * 31
    minutes = F.col("l_quantity").cast("bigint") * F.col("l_linenumber")
    return lines.select(
        "*", _plus(F.col("l_shipdate"), spread % 86400).alias("started"),
        (minutes * 60 + F.col("l_partkey") % 60).alias("seconds"),
        (F.col("l_partkey") % 331).alias("to_station"),
    )


def trips(spark: SparkSession, sf: str) -> DataFrame:
    """Typed trips in the layout the usage queries read; ride ids repeat as order lines do."""
    base = _trip_base(table(spark, sf, "lineitem"))

    def name(station: str) -> Column:
        renamed = F.when(F.col("l_linenumber") > 4, " (new)").otherwise("")
        label = F.concat(F.lit("Station "), F.col(station).cast("string"), renamed)
        return F.when(F.col(station) % 7 != 0, label)

    def coordinate(station: str, origin: float) -> Column:
        return F.when(F.col(station) % 11 != 0, F.lit(origin) + F.col(station) / 1000.0)

    flag = F.col("l_returnflag")
    return base.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("ride_id"),
        F.col("started").alias("started_at"),
        _plus(F.col("started"), F.col("seconds")).alias("ended_at"),
        F.col("l_suppkey").cast("string").alias("start_station_id"),
        name("l_suppkey").alias("start_station_name"),
        coordinate("l_suppkey", 40.0).alias("start_lat"),
        coordinate("l_suppkey", -74.0).alias("start_lng"),
        F.col("to_station").cast("string").alias("end_station_id"),
        name("to_station").alias("end_station_name"),
        coordinate("to_station", 40.0).alias("end_lat"),
        coordinate("to_station", -74.0).alias("end_lng"),
        F.when(flag == "R", "member").when(flag == "A", "casual").alias("member_casual"),
        F.col("seconds").cast("int").alias("tripduration_seconds"),
        F.when(F.col("l_discount") > 0, (F.col("l_orderkey") % 5000).cast("string"))
        .alias("bikeid"),
        F.when(F.col("l_linenumber") == 7, F.lit(None)).when(F.col("l_tax") == 0, F.lit(0))
        .otherwise(1940 + F.col("l_partkey") % 70).cast("smallint").alias("birth_year"),
        F.concat(F.date_format("l_shipdate", "yyyyMM"), F.lit("-trips.csv")).alias("source_file"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("position"),
    )


RAW_ORDER = ["_order", "_line", "_part", "_supplier", "_price", "_shipped"]


def raw_trips(spark: SparkSession, sf: str) -> DataFrame:
    """Monthly rows as they come from files: text under legacy headers, ride ids from 2000 on."""
    return _raw(table(spark, sf, "lineitem").repartition("l_orderkey", "l_linenumber"))


def _raw(lines: DataFrame, keep: list[str] | tuple = ()) -> DataFrame:
    base = _trip_base(lines)
    line, flag = F.col("l_linenumber"), F.col("l_returnflag")
    modern = F.year("l_shipdate") >= 2000
    iso, us = "yyyy-MM-dd HH:mm:ss", "M/d/yyyy HH:mm:ss"
    given = (
        F.when(F.col("l_discount") == 0, "NA")
        .when((F.col("l_tax") == 0) & (line == 7), "0")
        .when((F.col("l_tax") == 0.08) & (line == 6), "90000")
        .when((F.col("l_tax") == 0.07) & (line == 5), "abc")
        .otherwise(F.col("seconds").cast("string"))
    )
    return base.select(
        F.when(modern & (F.col("l_suppkey") % 50 != 0), F.concat_ws("-", "l_orderkey", line))
        .alias("Ride ID"),
        F.when(modern, "electric_bike").alias("rideable.type"),
        F.when(F.col("l_orderkey") % 97 == 0, "bad time")
        .when(F.col("l_orderkey") % 5 == 1, F.date_format("started", us))
        .otherwise(F.date_format("started", iso)).alias("Start Time"),
        F.date_format(_plus(F.col("started"), F.col("seconds")), iso).alias("Stop Time"),
        given.alias("Trip Duration"),
        F.when(line == 4, F.concat(F.lit(" "), "l_suppkey"))
        .otherwise(F.col("l_suppkey").cast("string")).alias("Start Station ID"),
        F.when(F.col("l_suppkey") % 7 == 0, "None")
        .otherwise(F.concat(F.lit("Station "), "l_suppkey")).alias("Start Station Name"),
        (F.lit(40.0) + F.col("l_suppkey") / 1000.0).cast("string").alias("Start Station Latitude"),
        F.when(F.col("l_suppkey") % 11 == 0, "?")
        .otherwise((F.lit(-74.0) + F.col("l_suppkey") / 1000.0).cast("string"))
        .alias("Start Station Longitude"),
        F.col("to_station").cast("string").alias("End Station ID"),
        F.concat(F.lit("Station "), "to_station").alias("End Station Name"),
        (F.lit(40.0) + F.col("to_station") / 1000.0).cast("string").alias("End Station Latitude"),
        (F.lit(-74.0) + F.col("to_station") / 1000.0).cast("string")
        .alias("End Station Longitude"),
        F.when(F.col("l_discount") == 0.1, "").otherwise((F.col("l_orderkey") % 5000).cast("string"))
        .alias("Bike ID"),
        F.when(flag == "N", "Dependent").when(F.col("l_linestatus") == "F", "Subscriber")
        .otherwise("Customer").alias("User Type"),
        F.when(modern & (flag == "R"), "member").when(modern & (flag == "A"), "casual")
        .alias("member_casual"),
        F.when(F.col("l_tax") == 0, "").when(line == 1, "1899")
        .when(line == 2, F.concat((1940 + F.col("l_partkey") % 90).cast("string"), F.lit(".0")))
        .otherwise((1940 + F.col("l_partkey") % 90).cast("string")).alias("Birth Year"),
        F.when(line % 4 == 3, "x").otherwise((line % 4).cast("string")).alias("Gender"),
        F.concat(F.lit("/raw/"), F.date_format("l_shipdate", "yyyyMM"), F.lit("-trips.csv"))
        .alias("source_file"),
        F.col("l_orderkey").alias("_order"), line.alias("_line"), F.col("l_partkey").alias("_part"),
        F.col("l_suppkey").alias("_supplier"),
        *[F.col(c).alias("_price") for c in lines.columns if c == "l_extendedprice"],
        F.col("l_shipdate").alias("_shipped"), *keep,
    )


_LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax", "l_returnflag",
         "l_linestatus", "l_shipdate"]


def monthly_trips(spark: SparkSession, sf: str, folder: str) -> DataFrame:
    """The rows of :func:`raw_trips` (but for the price), read file by file: order lines are first stored as one folder a file."""
    lines = table(spark, sf, "lineitem")
    name = F.date_format("l_shipdate", "yyyyMM").alias("_file")
    with using(spark, FILE_JOB):
        lines.select(*_LINE, name).hint("rebalance", "_file").write.option("compression", "zstd").partitionBy("_file").parquet(folder)
    return _raw(spark.read.parquet(folder))


def write_raw_csv(spark: SparkSession, sf: str, folder: str) -> None:
    """The monthly rows as CSV files, one a month, with line breaks inside names; some files are damaged.

    Files of July have a row with too many fields, those of November end inside quotes.
    """
    lines = table(spark, sf, "lineitem")
    name = F.concat(F.date_format("l_shipdate", "yyyyMM"), F.lit("-trips.csv")).alias("_file")
    # lines are dealt to their files as they are in the table, narrower than as text; head, wide and cut rows go with them
    files = lines.select(name).distinct()
    month = F.substring("_file", 5, 2)
    extra = [files.select("_file", F.lit(0).alias("_at"))] + [
        files.where(month == m).select("_file", F.lit(at).alias("_at")) for m, at in (("07", 2), ("11", 3))]
    dealt = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [lines.select("*", name, F.lit(1).alias("_at")), *extra]) \
        .repartition("_file").sortWithinPartitions("_file", "_at")
    rows = _raw(dealt, ["_file", "_at"])
    columns = [c for c in rows.columns if c != "source_file" and not c.startswith("_")]
    broken = F.when(F.col("Start Station ID") == "5", F.concat(F.lit("Station\n\"5\", "), "Start Station ID")) \
        .otherwise(F.col("Start Station Name"))
    cells = [(broken if c == "Start Station Name" else F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(columns)]
    options = {"escape": '"', "quoteAll": "true", "nullValue": ""}
    text = F.when(F.col("_at") == 1, F.to_csv(F.struct(*cells), options)).when(F.col("_at") == 0, ",".join(columns)) \
        .when(F.col("_at") == 2, "," * len(columns)).otherwise('"R1,"",')
    rows.select(text.alias("value"), F.col("_file").alias("source_file")) \
        .write.partitionBy("source_file").option("lineSep", "\n").text(folder)


# ---- file listings ---------------------------------------------------------------------------


def _archive_name() -> Column:
    ending = F.when(F.col("o_orderstatus") == "F", ".csv.zip") \
        .when(F.col("o_orderstatus") == "O", ".ZIP").otherwise(".html")
    city = F.when(F.col("o_custkey") % 20 == 0, "jc-").when(F.col("o_custkey") % 10 == 0, "JC-") \
        .otherwise("")
    return F.concat(
        city, F.date_format("o_orderdate", "yyyyMM"), F.lit("-"), F.col("o_orderkey"),
        F.lit("-tripdata"), ending)


def file_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """One archive per order; cheap priority orders have no known size."""
    size = F.when(F.col("o_orderpriority") != "5-LOW", F.floor("o_totalprice").cast("bigint"))
    return table(spark, sf, "orders").select(
        F.concat(F.lit("data/"), _archive_name()).alias("key"), size.alias("size"))


def local_archives(spark: SparkSession, sf: str) -> DataFrame:
    """Archives held locally: those of urgent and low priority, every other one incomplete."""
    held = table(spark, sf, "orders").where(
        F.col("o_orderpriority").isin("1-URGENT", "5-LOW"))
    size = F.floor("o_totalprice").cast("bigint") - F.col("o_custkey") % 2
    return held.select(_archive_name().alias("name"), size.alias("size"))


def _zip_orders(folder: str):
    """A zip of the CSV lines of a group of orders, written to the folder."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        month, part = group["month"].iloc[0], int(group["part"].iloc[0])
        lines = io.StringIO()
        writer = csv.writer(lines, lineterminator="\n")
        writer.writerow(["bikeid", "start station name", "usertype"])
        writer.writerows(group[["o_orderkey", "station", "o_orderstatus"]].itertuples(index=False))
        packed = io.BytesIO()
        with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
            archive.writestr(f"{month}-{part}.csv", lines.getvalue())
        name = f"{folder}/{month}-{part}.zip"
        store, path = fs.FileSystem.from_uri(name if ":" in name else f"file://{name}")
        store.create_dir(path.rpartition("/")[0], recursive=True)
        with store.open_output_stream(path) as out:
            out.write(packed.getvalue())
        return pd.DataFrame({"archive": [name]})

    return run


def write_archives(spark: SparkSession, sf: str, folder: str) -> None:
    """Zip archives of the orders: one for each month and range of order keys.

    Station names hold a line break in every fifth order.
    """
    orders = table(spark, sf, "orders").select(
        F.date_format("o_orderdate", "yyyyMM").alias("month"), F.floor(F.col("o_orderkey") / 100_000).alias("part"),
        "o_orderkey", "o_orderstatus", F.when(F.col("o_orderkey") % 5 == 0, F.concat(
            F.col("o_custkey").cast("string"), F.lit("\n"), "o_orderpriority")).otherwise(
                F.col("o_custkey").cast("string")).alias("station"))
    orders.groupBy("month", "part").applyInPandas(_zip_orders(folder), "archive string") \
        .write.format("noop").mode("overwrite").save()
