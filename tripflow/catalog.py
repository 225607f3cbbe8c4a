"""Every query and operator as a named job ``(spark, sf_dir) -> DataFrame`` on the driver's tables.

Results are flattened for comparison with other engines: whole numbers as bigint, decimals and
floats as double, lists as joined text, dates as text.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow import fixtures as X
from tripflow import schema
from tripflow.functions import quality as Q
from tripflow.functions import trips as C
from tripflow.operators import cleaning, keyed, monitoring, quality, scoring, sets, usage
from tripflow.plans import load as load_jobs
from tripflow.plans.quality_batch import judge_and_store
from tripflow.session import ensure_checkpoint_dir
from tripflow.sources import archives, bronze, csv_files, files, tables
from tripflow.sources.events import read_bronze_since
from tripflow.sources.raw import files_to_clean, read_clean, read_inspected, write_clean
from tripflow.streaming import ingest, windows
from tripflow.streaming import quality as look_back

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def plain(df: DataFrame) -> DataFrame:
    """Simple column types only; a nullable whole number of the clean profile stays as it is."""
    out = []
    for name, kind in df.dtypes:
        column = F.col(f"`{name}`")
        if kind.startswith("decimal") or kind == "float":
            column = column.cast("double")
        elif kind in ("tinyint", "smallint", "int"):
            column = column.cast("bigint")
        elif kind == "date":
            column = column.cast("string")
        elif kind == "timestamp":
            column = column.cast("timestamp_ntz")
        elif kind == "array<string>":
            column = F.array_join(column, ",")
        out.append(column.alias(name))
    return df.select(*out)


def query(make: Query) -> Query:
    QUERIES[make.__name__] = lambda spark, sf: plain(make(spark, sf))
    return make


# ---- usage -----------------------------------------------------------------------------------

for _operator in (
    usage.trip_range, usage.trip_kpis, usage.trips_per_day, usage.top_start_stations,
    usage.top_end_stations, usage.duration_by_member, usage.top_bikes, usage.trips_per_hour,
    usage.trips_per_weekday, usage.top_birth_years, usage.longest_trips, usage.map_sample,
):
    QUERIES[_operator.__name__] = (
        lambda spark, sf, operator=_operator: plain(operator(X.trips(spark, sf))))


@query
def trip_filter(spark: SparkSession, sf: str) -> DataFrame:
    return usage.trips_per_day(X.trips(spark, sf), "1997-03-01", "1998-02-28", ["member", "casual"])


# ---- quality ---------------------------------------------------------------------------------

for _operator in (
    quality.quality_summary, quality.issue_frequency, quality.hourly_stats, quality.overview,
    quality.score_histogram, quality.validity_split, quality.trips_by_bike_type,
    quality.trips_by_member, quality.recent_trips, quality.recent_scores, quality.validity_totals,
):
    QUERIES[_operator.__name__] = (
        lambda spark, sf, operator=_operator: plain(operator(X.trip_metadata(spark, sf))))


@query
def hourly_trend(spark: SparkSession, sf: str) -> DataFrame:
    return quality.hourly_trend(X.trip_metadata(spark, sf), X.last_event(spark, sf))


@query
def last_hour_quality(spark: SparkSession, sf: str) -> DataFrame:
    return quality.last_hour_quality(X.trip_metadata(spark, sf), X.last_event(spark, sf))


@query
def processed_on(spark: SparkSession, sf: str) -> DataFrame:
    return quality.processed_on(X.trip_metadata(spark, sf), F.lit("2024-01-15").cast("date"))


@query
def reconcile(spark: SparkSession, sf: str) -> DataFrame:
    return quality.reconcile(X.trip_events(spark, sf), X.trip_metadata(spark, sf))


@query
def batch_profile(spark: SparkSession, sf: str) -> DataFrame:
    return quality.batch_profile(X.trip_events(spark, sf))


@query
def quality_bands(spark: SparkSession, sf: str) -> DataFrame:
    return quality.quality_bands(scoring.score_batch(X.trip_events(spark, sf)))


@query
def batch_quality_stats(spark: SparkSession, sf: str) -> DataFrame:
    scored = scoring.score_batch(X.trip_events(spark, sf))
    return quality.batch_quality_stats(scored, X.last_event(spark, sf)) \
        .select("quality_bands.*", "*").drop("quality_bands")


@query
def score_stream(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.score_stream(X.trip_events(spark, sf)) \
        .select("trip_id", "quality_score", "quality_issues", "is_valid")


@query
def score_batch(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.score_batch(X.trip_events(spark, sf)) \
        .select("trip_id", "quality_score", "quality_issues", "is_valid_quality")


@query
def metadata_eligible(spark: SparkSession, sf: str) -> DataFrame:
    return X.trip_metadata(spark, sf).select(
        "trip_id", "bike_id", "start_time", "end_time", "start_station_id", "end_station_id",
        "rider_age", "trip_duration", "bike_type", "member_casual", "quality_score", "is_valid")


@query
def quarantine(spark: SparkSession, sf: str) -> DataFrame:
    _, rejected = keyed.quarantine(X.scored_events(spark, sf))
    return rejected.select("trip_id", "quality_score", "quality_issues")


# ---- monthly files and the warehouse ---------------------------------------------------------


def _as_doubles(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("double") for n in names})


@query
def clean_trips(spark: SparkSession, sf: str) -> DataFrame:
    return _as_doubles(
        cleaning.with_file_names(cleaning.clean_rows(X.raw_trips(spark, sf), X.THIS_YEAR)), "birth_year", "gender")


@query
def dedupe_rides(spark: SparkSession, sf: str) -> DataFrame:
    rows = cleaning.clean_trips(X.raw_trips(spark, sf), X.THIS_YEAR, X.RAW_ORDER)
    return _as_doubles(rows, "birth_year", "gender")


def _loaded(spark: SparkSession, sf: str, keep=()) -> DataFrame:
    cleaned = cleaning.with_file_names(cleaning.clean_rows(X.raw_trips(spark, sf), X.THIS_YEAR))
    stored = cleaned.withColumn("source_file", F.concat(F.lit("/clean/"), "source_file"))
    return cleaning.load_trips(stored, X.THIS_YEAR, keep)


@query
def warehouse_trips(spark: SparkSession, sf: str) -> DataFrame:
    return _loaded(spark, sf)


@query
def ride_keys(spark: SparkSession, sf: str) -> DataFrame:
    rows = X.trips(spark, sf)
    key = C.ride_key(
        F.col("source_file"), F.col("started_at"), F.col("ended_at"), F.col("bikeid"))
    return rows.select(F.col("ride_id").alias("original_id"), key.alias("ride_key"))


@query
def insert_if_absent(spark: SparkSession, sf: str) -> DataFrame:
    new = X.trips(spark, sf)
    stored = new.where(F.col("started_at") < F.lit("1998-01-01").cast("timestamp_ntz"))
    rows = keyed.insert_if_absent(stored, new, [
        "tripduration_seconds", "start_station_id", "end_station_id", "bikeid"])
    return rows.select(
        "ride_id", "started_at", "tripduration_seconds", "start_station_id", "end_station_id")


def _split(spark: SparkSession, sf: str, day: str) -> tuple[DataFrame, DataFrame]:
    rows, bound = X.trips(spark, sf), F.lit(day).cast("timestamp_ntz")
    return rows.where(F.col("started_at") < bound), rows.where(F.col("started_at") >= bound)


def _at(text: str):
    return F.lit(text).cast("timestamp_ntz")


@query
def build_stations(spark: SparkSession, sf: str) -> DataFrame:
    return keyed.build_stations(X.trips(spark, sf), ["position"], _at("2001-01-01"))


@query
def upsert_stations(spark: SparkSession, sf: str) -> DataFrame:
    before, after = _split(spark, sf, "1998-01-01")
    return keyed.upsert_stations(
        keyed.build_stations(before, ["position"], _at("1998-01-01")),
        keyed.build_stations(after, ["position"], _at("2001-01-01")))


@query
def upsert_ledger(spark: SparkSession, sf: str) -> DataFrame:
    before, _ = _split(spark, sf, "1999-01-01")
    _, after = _split(spark, sf, "1998-01-01")
    return keyed.upsert_ledger(
        keyed.ledger_entries(before, _at("1999-01-01")),
        keyed.ledger_entries(after, _at("2001-01-01")))


@query
def upsert_metadata(spark: SparkSession, sf: str) -> DataFrame:
    rows = X.resent_metadata(spark, sf).withColumn("sent", F.col("processed_at"))
    half = _at("2024-01-16")
    columns = schema.TRIP_METADATA.fieldNames()
    none = rows.where(F.lit(False)).select(*columns)
    stored = keyed.upsert_metadata(none, rows.where(F.col("processed_at") < half), ["sent"])
    after = keyed.upsert_metadata(stored, rows.where(F.col("processed_at") >= half), ["sent"])
    return after.select(
        "trip_id", "bike_id", "start_time", "trip_duration", "bike_type", "member_casual",
        "is_valid", "quality_score", "quality_issues", "processed_at")


@query
def schema_check(spark: SparkSession, sf: str) -> DataFrame:
    rows = X.trips(spark, sf)
    return sets.schema_check(rows, schema.TRIPS.fieldNames(), schema.TRIP_KEY)


@query
def files_to_load(spark: SparkSession, sf: str) -> DataFrame:
    before, _ = _split(spark, sf, "1998-01-01")
    paths = X.trips(spark, sf).select("source_file").distinct()
    return archives.files_to_load(paths, keyed.ledger_entries(before, _at("1998-01-01")))


# ---- file listings ---------------------------------------------------------------------------


@query
def select_archives(spark: SparkSession, sf: str) -> DataFrame:
    return archives.select_archives(X.file_manifest(spark, sf), include="^199[5-8]")


@query
def archives_to_fetch(spark: SparkSession, sf: str) -> DataFrame:
    return archives.archives_to_fetch(
        X.file_manifest(spark, sf), X.local_archives(spark, sf)).select("key")


@query
def transfer_summary(spark: SparkSession, sf: str) -> DataFrame:
    code = F.col("o_orderstatus")
    status = F.when(code == "F", "ok").when(code == "O", "skipped") \
        .otherwise(F.concat(F.lit("failed: "), "o_orderpriority"))
    return archives.transfer_summary(
        X.table(spark, sf, "orders").select(status.alias("status")))


@query
def entries_to_extract(spark: SparkSession, sf: str) -> DataFrame:
    lead = F.when(F.col("o_orderstatus") == "P", "._").otherwise("")
    name = F.concat(lead, F.lit("Trips_"), F.col("o_custkey"), F.lit(".csv"))
    entries = X.table(spark, sf, "orders").select(
        F.date_format("o_orderdate", "yyyyMM").alias("archive"),
        F.concat(F.lit("in/"), F.col("o_orderkey"), F.lit("/"), name).alias("entry"),
        name.alias("name"))
    existing = X.table(spark, sf, "customer").select(
        F.concat(F.lit("_trips_"), F.col("c_custkey"), F.lit(".CSV")).alias("name"),
        F.floor("c_acctbal").cast("bigint").alias("size"))
    return archives.entries_to_extract(entries, existing)


@query
def files_to_clean_query(spark: SparkSession, sf: str) -> DataFrame:
    orders = X.table(spark, sf, "orders")
    month = F.date_format("o_orderdate", "yyyyMM")
    csvs = orders.select(
        F.concat(F.lit("/raw/"), month, F.lit("-trips.csv")).alias("path")).distinct()
    done = orders.where(F.col("o_orderdate") < _at("1998-01-01")).select(
        F.concat(F.lit("/clean/"), month, F.lit("-trips__clean.parquet")).alias("path"))
    return files_to_clean(csvs, done)


QUERIES["files_to_clean"] = QUERIES.pop("files_to_clean_query")


@query
def latest_month_archive(spark: SparkSession, sf: str) -> DataFrame:
    orders = X.table(spark, sf, "orders")
    name = F.concat(
        F.date_format("o_orderdate", "yyyyMM"), F.lit(schema.MONTHLY_ARCHIVE_SUFFIX))
    stored = orders.where(F.col("o_orderstatus") == "F").select(
        F.concat(F.lit("historical/"), name).alias("key"))
    return archives.latest_month_archive(
        orders.select(name.alias("key")), dt.date(2001, 9, 3), stored)


# ---- monitoring ------------------------------------------------------------------------------


@query
def system_status(spark: SparkSession, sf: str) -> DataFrame:
    return monitoring.system_status(X.health_checks(spark, sf))


def _metrics(spark: SparkSession, sf: str) -> DataFrame:
    return monitoring.observability_metrics(
        X.health_checks(spark, sf), X.trip_metadata(spark, sf), X.last_event(spark, sf))


@query
def observability_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return _metrics(spark, sf)


@query
def alerts(spark: SparkSession, sf: str) -> DataFrame:
    return monitoring.alerts(_metrics(spark, sf)).select("type", "severity", "value")


@query
def alert_summary(spark: SparkSession, sf: str) -> DataFrame:
    return monitoring.alert_summary(monitoring.alerts(_metrics(spark, sf)))


# ---- streams ---------------------------------------------------------------------------------


def _scratch(spark: SparkSession) -> str:
    """New folder below the shared one of the cluster."""
    return f"{ensure_checkpoint_dir(spark)}/tripflow-{uuid.uuid4().hex}"


def _event_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The events table as a stream of files."""
    layout = X.table(spark, sf, "events").schema
    return spark.readStream.schema(layout).option("pathGlobFilter", "events.parquet") \
        .parquet(sf)


@query
def hourly_late(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly statistics of a stream whose second half of rows comes first, folded between its two runs."""
    root = _scratch(spark)
    events = X.table(spark, sf, "events")
    half = F.lit("2024-01-16").cast("timestamp_ntz")

    def arrive(rows: DataFrame) -> None:
        rows.write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(events.schema).parquet(f"{root}/in")
        windows.store_sums(scoring.score_stream(X.as_trip_events(stream)), f"{root}/windows", f"{root}/checkpoint",
                           available_now=True).awaitTermination()

    arrive(events.where(F.col("ts") >= half))
    windows.fold_sums(spark, f"{root}/windows")
    arrive(events.where(F.col("ts") < half))
    return windows.read_sums(spark, f"{root}/windows")


@query
def ingest_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Runs the ingest over all events as JSON bodies, then reads the metadata it stored."""
    root = _scratch(spark)
    sinks = ingest.Sinks(
        f"{root}/bronze", f"{root}/metadata", f"{root}/quarantine", f"{root}/rejected")
    bodies = X.as_trip_events(_event_stream(spark, sf)).drop("processed_at").select(
        F.to_json(F.struct("*")).alias("value"))
    ingest.ingest_stream(bodies, sinks, f"{root}/checkpoint", available_now=True, queued=True) \
        .awaitTermination()
    return tables.read_metadata(spark, sinks.metadata).select(
        "trip_id", "bike_id", "start_time", "end_time", "rider_age", "trip_duration",
        "member_casual", "quality_score", "quality_issues", "is_valid", "ingested_at")


def _windows(spark: SparkSession, sf: str, make) -> DataFrame:
    """All windows over all events, the last ones included, as the stream leaves them."""
    root = _scratch(spark)
    scored = scoring.score_stream(X.as_trip_events(_event_stream(spark, sf)))
    windows.store_windows(make(scored), f"{root}/windows", f"{root}/checkpoint", available_now=True).awaitTermination()
    return windows.read_windows(spark, f"{root}/windows")


@query
def hourly_stream(spark: SparkSession, sf: str) -> DataFrame:
    return _windows(spark, sf, windows.hourly_stream)


@query
def daily_stream(spark: SparkSession, sf: str) -> DataFrame:
    return _windows(spark, sf, windows.daily_stream)


# ---- what the writers leave in their tables --------------------------------------------------


@query
def metadata_after_fold(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs whose batches have one number, with a fold between them."""
    root, half = _scratch(spark), _at("2024-01-16")
    rows = X.resent_metadata(spark, sf)
    tables.append_metadata(rows.where(F.col("processed_at") < half), root, tables.batch_key("a", 0))
    tables.fold_metadata(spark, root)
    tables.append_metadata(rows.where(F.col("processed_at") >= half), root, tables.batch_key("b", 0))
    return tables.read_metadata(spark, root).select(
        "trip_id", "bike_id", "start_time", "trip_duration", "bike_type", "member_casual",
        "is_valid", "quality_score", "quality_issues", "processed_at")


def _sinks(spark: SparkSession, sf: str) -> ingest.Sinks:
    """The sinks after one batch of all events; those of classic bikes come without their bike type."""
    root = _scratch(spark)
    sinks = ingest.Sinks(f"{root}/bronze", f"{root}/metadata", f"{root}/quarantine", f"{root}/rejected")
    events = X.trip_events(spark, sf).drop("processed_at").withColumn(
        "bike_type", F.when(F.col("bike_type") != "classic", F.col("bike_type")))
    bodies = events.select(F.to_json(F.struct("*")).alias("value"))
    for _ in range(2):
        ingest.write_batch(bodies, tables.batch_key("run", 0), sinks, queued=True)
    return sinks


@query
def bronze_rows(spark: SparkSession, sf: str) -> DataFrame:
    return bronze.read_bronze(spark, _sinks(spark, sf).bronze).select(
        "trip_id", "quality_score", "quality_issues", "is_valid")


def _packed(spark: SparkSession, sf: str) -> tuple[str, int]:
    """Bronze of two batches, the first (members) packed and its folder removed, and the time between the two."""
    path = f"{_scratch(spark)}/bronze"
    # the time of bronze rows is the start of the trip, whether the score could use it or not
    scored = ingest.split_events(ingest.score_events(X.trip_events(spark, sf).withColumn("_rejected", F.lit(None).cast("string")), queued=True))[0]
    member = F.coalesce(F.col("member_casual") == "member", F.lit(False))
    tables.write_bronze(scored.where(member), path, tables.batch_key("run", 0))
    time.sleep(1.1)
    between = time.time_ns() // 1000
    time.sleep(1.1)
    for _ in range(2):
        bronze.compact_bronze(spark, path, keep_minutes=0)
    tables.write_bronze(scored.where(~member), path, tables.batch_key("run", 1))
    return path, between


@query
def bronze_packed_rows(spark: SparkSession, sf: str) -> DataFrame:
    """All stored events, of a packed batch and of one in its own folders."""
    return bronze.read_bronze(spark, _packed(spark, sf)[0]).select(
        "trip_id", "quality_score", "quality_issues", "is_valid")


@query
def bronze_since_bounds(spark: SparkSession, sf: str) -> DataFrame:
    """Look-back that ends between two batches: the first one, found in the packed parts, and none of the second."""
    path, between = _packed(spark, sf)
    return read_bronze_since(spark, path, F.timestamp_micros(F.lit(between)), 60).select(
        "trip_id", "quality_score", "quality_issues", "is_valid")


@query
def rejected_rows(spark: SparkSession, sf: str) -> DataFrame:
    rejected = spark.read.parquet(_sinks(spark, sf).rejected)
    return rejected.select(F.get_json_object("body", "$.trip_id").alias("trip_id"))


def _judged(spark: SparkSession, sf: str) -> str:
    """Silver and reports of a look-back over all events, run twice."""
    root = _scratch(spark)
    for _ in range(2):
        judge_and_store(X.trip_events(spark, sf), f"{root}/silver", f"{root}/reports",
                        F.lit("2024-02-01 10:00:00").cast("timestamp"))
    return root


@query
def silver_rows(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{_judged(spark, sf)}/silver").select(
        "trip_id", F.col("quality_score").cast("bigint").alias("quality_score"), "quality_issues")


@query
def quality_report_rows(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{_judged(spark, sf)}/reports").select(
        "quality_bands.*", "total_records", "valid_records", "invalid_records", "date", "hour")


@query
def monitoring_rows(spark: SparkSession, sf: str) -> DataFrame:
    root, metrics = _scratch(spark), _metrics(spark, sf)
    tables.write_monitoring(metrics, monitoring.alerts(metrics), root, F.lit("2024-02-01 10:07:00").cast("timestamp"))
    stored = spark.read.parquet(f"{root}/system_metrics").select("date", "hour", "minute", "total_trips_last_hour")
    return stored.join(spark.read.parquet(f"{root}/alerts").select("minute", "alert_count"), "minute", "left")


@query
def issues_json(spark: SparkSession, sf: str) -> DataFrame:
    rows = scoring.score_batch(X.trip_events(spark, sf))
    return rows.select("trip_id", Q.issues_json(F.col("quality_issues")).alias("issues"))


@query
def union_all(spark: SparkSession, sf: str) -> DataFrame:
    customers = X.table(spark, sf, "customer").select(
        F.col("c_name").alias("name"), F.col("c_nationkey").cast("bigint").alias("nation"))
    parts = X.table(spark, sf, "part").select(F.col("p_name").alias("name"))
    return sets.union_all([customers, parts])


def _house(spark: SparkSession, sf: str) -> load_jobs.Warehouse:
    """The warehouse after the clean files were loaded, cleaned and loaded again with a lost ledger."""
    root = _scratch(spark)
    house = load_jobs.Warehouse(f"{root}/house")
    rows = cleaning.with_file_names(cleaning.clean_rows(X.monthly_trips(spark, sf, f"{root}/lines"), X.THIS_YEAR))
    for _ in range(2):
        write_clean(rows, f"{root}/clean", by_file=True)
        load_jobs.load(spark, f"{root}/clean", house, X.THIS_YEAR, _at("2026-01-01"))
        held = tables.read_snapshot(spark, house.ledger, schema.LEDGER)
        tables.write_snapshot(spark, f"{root}/seen", held)
        tables.write_snapshot(spark, house.ledger, spark.createDataFrame([], schema.LEDGER))
    tables.write_snapshot(spark, house.ledger, tables.read_snapshot(spark, f"{root}/seen", schema.LEDGER))
    return house


@query
def load_trips_run(spark: SparkSession, sf: str) -> DataFrame:
    trips = spark.read.parquet(_house(spark, sf).trips)
    rides = trips.groupBy("year_month", *keyed.short_key(F.col("ride_id"))).agg(F.count("*").alias("n"))
    return rides.groupBy("year_month").agg(
        F.sum("n").alias("trips"), F.count(F.coalesce("digest", F.encode("text", "UTF-8"))).alias("rides"))


@query
def ledger_run(spark: SparkSession, sf: str) -> DataFrame:
    ledger = tables.read_snapshot(spark, _house(spark, sf).ledger, schema.LEDGER)
    return ledger.select(F.substring_index("source_file", "=", -1).alias("source_file"), "records_loaded", "load_date")


def _month_file(path: Column) -> Column:
    return F.regexp_extract(path, "source_file=([^/]+)/", 1)


@query
def raw_csv_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Clean rows of monthly CSV files with line breaks in fields, and the files that are damaged."""
    root = _scratch(spark)
    X.write_raw_csv(spark, sf, f"{root}/csv")
    rows, bad = read_inspected(spark, csv_files.inspect(spark, files.list_files(spark, f"{root}/csv", ".txt")))
    clean = cleaning.clean_rows(rows, X.THIS_YEAR)
    counts = clean.groupBy(_month_file(F.col("source_file")).alias("source_file")).agg(
        F.count("*").alias("trips"), F.sum("tripduration_seconds").cast("bigint").alias("seconds"),
        F.count_if(F.contains("start_station_name", F.lit("\n"))).alias("broken_names"), F.lit(None).cast("string").alias("error"))
    none = F.lit(None).cast("bigint")
    named = spark.createDataFrame(sorted(bad.items()), "path string, error string").select(
        _month_file(F.col("path")).alias("source_file"), none.alias("trips"), none.alias("seconds"), none.alias("broken_names"),
        "error")
    return counts.unionByName(named)


@query
def stored_ride_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Of all ride ids, those that a third of the trips have stored, found through the filters of each month."""
    root = _scratch(spark)
    rows = X.trips(spark, sf).select("ride_id", C.year_month(F.col("started_at")).alias("year_month"), "position")
    for part in (0, 3):
        rows.where(F.col("position") % 9 == part).select("ride_id", "year_month") \
            .write.mode("append").partitionBy("year_month").parquet(f"{root}/trips")
    months = [r.year_month for r in rows.select("year_month").distinct().collect()]
    new = rows.select(F.col("year_month").alias("month"), F.col("ride_id").alias("key")).distinct()
    found = tables.trip_index(spark, f"{root}/trips").stored(new, months)
    return found.groupBy(F.col("month").alias("year_month")).agg(F.count("*").alias("rides"))


@query
def extract_run(spark: SparkSession, sf: str) -> DataFrame:
    """Records of the archives of all orders, extracted in two runs that share their header."""
    root = _scratch(spark)
    X.write_archives(spark, sf, f"{root}/zips")
    names = archives.list_entries(spark, f"{root}/zips").select("name", F.lit(1).cast("bigint").alias("size"))
    early = F.col("name") < "1996"
    load_jobs.extract(spark, f"{root}/zips", f"{root}/text", names.where(early))
    load_jobs.extract(spark, f"{root}/zips", f"{root}/text", names.where(~early))
    return archives.read_extracted(spark, f"{root}/text").select(
        F.col("bikeid").cast("bigint").alias("order_key"), F.col("start_station_name").alias("station"),
        "usertype", F.substring("source_file", 1, 6).alias("month"))


# ---- rules that the plain tables never break ---------------------------------------------------


@query
def score_stream_damaged(spark: SparkSession, sf: str) -> DataFrame:
    """Events with unreadable stations, and with an infinite bike id, behind which nothing is converted."""
    events = X.trip_events(spark, sf)
    n = F.substring_index("trip_id", "_", -1).cast("bigint")
    return scoring.score_stream(events.withColumns({
        "start_station_id": F.when(n % 13 == 0, "abc").otherwise(F.col("start_station_id")),
        "end_station_id": F.when(n % 17 == 0, "abc").otherwise(F.col("end_station_id")),
        "bike_id": F.when(n % 19 == 0, "inf").otherwise(F.col("bike_id")),
    })).select("trip_id", "quality_score", "quality_issues", "is_valid")


@query
def score_batch_missing(spark: SparkSession, sf: str) -> DataFrame:
    """Stored trips in which every required field is missing now and then."""
    events = X.trip_events(spark, sf)
    n = F.substring_index("trip_id", "_", -1).cast("bigint")
    gone = {"bike_id": 13, "start_time": 17, "end_time": 19, "start_station_id": 23, "end_station_id": 11, "trip_duration": 7}
    damaged = events.withColumns({c: F.when(n % k != 0, F.col(c)) for c, k in gone.items()})
    return scoring.score_batch(damaged).select("trip_id", "quality_score", "quality_issues", "is_valid_quality")


@query
def alerts_all(spark: SparkSession, sf: str) -> DataFrame:
    """Alerts of metrics made worse: API down, half of the trips valid, low scores."""
    worse = _metrics(spark, sf).withColumns({
        "api_status": F.lit("unhealthy"), "avg_quality_score": F.col("avg_quality_score") / 2,
        "valid_trips_last_hour": F.floor(F.col("total_trips_last_hour") / 2).cast("bigint"),
    })
    return monitoring.alerts(worse).select("type", "severity", "value")


# ---- readers -----------------------------------------------------------------------------------


@query
def bronze_since_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Stored events of files written in the last hour."""
    return read_bronze_since(spark, _sinks(spark, sf).bronze, F.current_timestamp(), 60).select(
        "trip_id", "quality_score", "quality_issues", "is_valid")


@query
def quality_stream_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Silver of the look-back as a stream, started twice over the same stored events."""
    root = _scratch(spark)
    X.trip_events(spark, sf).write.parquet(f"{root}/bronze")
    layout = spark.read.parquet(f"{root}/bronze").schema
    for _ in range(2):
        look_back.quality_stream(
            look_back.bronze_stream(spark, f"{root}/bronze", layout), f"{root}/silver", f"{root}/reports",
            f"{root}/checkpoint", as_of=F.lit("2024-02-01 10:00:00").cast("timestamp")).awaitTermination()
    return tables.read_table(spark, f"{root}/silver").select(
        "trip_id", F.col("quality_score").cast("bigint").alias("quality_score"), "quality_issues")


@query
def read_clean_rows(spark: SparkSession, sf: str) -> DataFrame:
    root = _scratch(spark)
    write_clean(cleaning.with_file_names(cleaning.clean_rows(X.raw_trips(spark, sf), X.THIS_YEAR)), root)
    name = F.regexp_extract("source_file", "source_file=([^/]+)/", 1)
    return read_clean(spark, root).groupBy(name.alias("source_file")).agg(
        F.count("*").alias("n"), F.min("started_at").alias("first"), F.max("ended_at").alias("last"))
