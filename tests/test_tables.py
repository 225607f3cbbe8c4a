from __future__ import annotations

import datetime as dt

from conftest import rows
from pyspark.sql import functions as F
from test_keyed import DAY, arrival

from tripflow import schema
from tripflow.operators.scoring import score_batch
from tripflow.plans.quality_batch import run_quality_batch
from tripflow.session import shuffle_partitions
from tripflow.sources import tables
from tripflow.sources.events import read_bronze_since


def metadata(spark, *items):
    return spark.createDataFrame(list(items), schema.TRIP_METADATA)


def test_metadata_log_folds_and_replays(spark, tmp_path):
    root, key = str(tmp_path), tables.batch_key
    assert tables.read_metadata(spark, root).count() == 0
    first = metadata(spark, arrival("a", 1, 100, True, bike=7), arrival("b", 1, 90, True))
    second = metadata(spark, arrival("a", 2, 40, False, bike=8))
    third = metadata(spark, arrival("a", 3, 70, False, bike=9), arrival("c", 1, 80, True))
    tables.append_metadata(first, root, key("r", 0))
    tables.append_metadata(first, root, key("r", 0))   # the same batch again
    tables.append_metadata(second, root, key("r", 1))
    tables.fold_metadata(spark, root)
    tables.append_metadata(third, root, key("r", 2))
    found = {r.trip_id: r for r in tables.read_metadata(spark, root).collect()}
    assert sorted(found) == ["a", "b", "c"]
    assert (found["a"].bike_id, found["a"].is_valid, int(found["a"].quality_score)) == (7, True, 70)
    tables.fold_metadata(spark, root)
    whole = sorted((tuple(r) for r in found.values()), key=repr)
    assert rows(tables.read_metadata(spark, root)) == whole
    # another run begins at batch 0 again, after a fold: nothing is hidden
    tables.append_metadata(metadata(spark, arrival("d", 1, 60, True)), root, key("s", 0))
    assert {r.trip_id for r in tables.read_metadata(spark, root).collect()} == set("abcd")
    tables.fold_metadata(spark, root)
    tables.fold_metadata(spark, root)
    assert {r.trip_id for r in tables.read_metadata(spark, root).collect()} == set("abcd")
    assert list((tmp_path / "arrivals").glob("batch=*")) == []


def test_metadata_is_read_without_a_fold(spark, tmp_path):
    root = str(tmp_path)
    tables.append_metadata(metadata(spark, arrival("a", 1, 100, True), arrival("b", 1, 90, True)), root, "r-0")
    tables.fold_metadata(spark, root)

    def plan():
        recent = tables.read_metadata(spark, root).where(F.col("processed_at") > F.lit(DAY))
        return recent._jdf.queryExecution().executedPlan().toString()

    quiet = plan()
    assert "Aggregate" not in quiet and "Sort" not in quiet and "Exchange" not in quiet
    assert "GreaterThan(processed_at" in quiet
    tables.append_metadata(metadata(spark, arrival("a", 2, 40, False)), root, "r-1")
    assert "GreaterThan(processed_at" in plan()


def test_snapshots_are_versions(spark, tmp_path):
    root = str(tmp_path / "stations")
    one = spark.createDataFrame([("a", "A", 1.0, 1.0, DAY, DAY)], schema.STATIONS)
    two = spark.createDataFrame([("a", None, 2.0, None, DAY, DAY)], schema.STATIONS)
    assert tables.save_stations(spark, root, one) == 1
    assert tables.save_stations(spark, root, two) == 2
    (tmp_path / "stations" / "v=3").mkdir()  # the rest of a failed job is not read
    assert rows(tables.read_snapshot(spark, root, schema.STATIONS)) == [("a", "A", 2.0, 1.0, DAY, DAY)]


def scored(spark, *items):
    return spark.createDataFrame(
        list(items), "trip_id string, quality_score int, is_valid_quality boolean, n int")


def test_silver_last_of_the_hour_stays(spark, tmp_path):
    path = str(tmp_path / "silver")

    def at(text):
        return F.lit(text).cast("timestamp_ntz")

    tables.write_silver(spark, scored(spark, ("a", 90, True, 1), ("a", 80, True, 2), ("x", 10, False, 1)),
                        path, at("2024-01-01 10:05:00"), ["n"])
    tables.write_silver(spark, scored(spark, ("a", 70, True, 1), ("b", 70, True, 1)),
                        path, at("2024-01-01 10:50:00"), ["n"])
    tables.write_silver(spark, scored(spark, ("a", 60, True, 1)),
                        path, at("2024-01-01 11:00:00"), ["n"])
    found = spark.read.parquet(path).select("date", "hour", "trip_id", "quality_score")
    assert rows(found) == [("2024-01-01", "10", "a", 70), ("2024-01-01", "10", "b", 70),
                           ("2024-01-01", "11", "a", 60)]


def test_bronze_look_back_and_quality_batch(spark, tmp_path):
    bronze = str(tmp_path / "bronze")
    line = {"trip_id": "t1", "bike_id": "1", "start_time": "2024-01-15T10:00:00Z",
            "end_time": "2024-01-15T10:30:00Z", "start_station_id": "1", "end_station_id": "2",
            "rider_age": "25", "trip_duration": "1800", "bike_type": "classic",
            "ingested_at": "2024-01-15T10:31:00Z", "processed_at": "2024-01-15T10:31:05Z"}
    df = spark.createDataFrame([tuple(line.values())], ", ".join(f"{c} string" for c in line))
    tables.write_bronze(df.withColumn("_start", F.lit("2024-01-15").cast("timestamp_ntz")), bronze, "r-0")
    written = spark.read.parquet(bronze).select("_metadata.file_modification_time").first()[0]
    assert {r.month for r in spark.read.parquet(bronze).select("month").collect()} == {"01"}

    def recent(seconds):
        return read_bronze_since(
            spark, bronze, F.lit(written + dt.timedelta(seconds=seconds)).cast("timestamp"))

    assert recent(0).count() == 1 and recent(900).count() == 1       # both ends count
    assert recent(901).count() == 0 and recent(-1).count() == 0
    assert {"_file_path", "_file_size", "_last_modified"} <= set(recent(0).columns)
    silver, reports = str(tmp_path / "silver"), str(tmp_path / "reports")
    at = F.lit(written + dt.timedelta(minutes=5)).cast("timestamp")
    for _ in range(2):
        run_quality_batch(spark, bronze, silver, reports, at)
    assert [r.trip_id for r in spark.read.parquet(silver).collect()] == ["t1"]
    report = spark.read.parquet(reports).collect()
    assert len(report) == 1 and report[0].total_records == 1
    assert report[0].quality_bands.asDict() == {"EXCELLENT": 1, "GOOD": 0, "FAIR": 0, "POOR": 0}


def test_json_look_back_with_a_layout(spark, tmp_path):
    (tmp_path / "t.json").write_text('[{"trip_id": "a", "bike_id": 7, "rider_age": 30}]')
    row = read_bronze_since(spark, str(tmp_path), F.current_timestamp(), 60, "json", schema.EVENT)
    assert [(r.trip_id, r.bike_id, r.rider_age) for r in row.collect()] == [("a", "7", "30")]


def test_shuffle_tasks_follow_the_data():
    assert shuffle_partitions(10, cores=8) == 16
    assert shuffle_partitions(100 * 1024 ** 4, cores=4000) == 524288


def test_json_arrays_are_read_as_rows(spark, tmp_path):
    (tmp_path / "trip_1.json").write_text('[{"trip_id": "a", "bike_id": 1}, {"trip_id": "b", "bike_id": 2}]')
    (tmp_path / "trip_2.json").write_text('{"trip_id": "c", "bike_id": 3}')
    (tmp_path / "trip_3.json").write_text('{"trip_id": ')
    now = F.current_timestamp()
    found = read_bronze_since(spark, str(tmp_path), now, 60, form="json")
    assert {r.trip_id for r in found.collect() if r.trip_id} == {"a", "b", "c"}
    # six fields missing, and no age at all counts as age 0
    assert score_batch(found.where("trip_id = 'a'")).first().quality_score == 100 - 6 * 10 - 20
