from __future__ import annotations

import json

from conftest import SF, rows
from pyspark.sql import functions as F
from test_scoring import VECTORS

from tripflow import fixtures as X
from tripflow.operators import keyed, quality
from tripflow.operators.scoring import score_batch, score_stream
from tripflow.sources import events as E
from tripflow.sources import tables
from tripflow.streaming import ingest, windows
from tripflow.streaming import quality as look_back


def sinks_under(root):
    return ingest.Sinks(f"{root}/bronze", f"{root}/metadata", f"{root}/quarantine", f"{root}/rejected")


def run(spark, source, sinks, root, checkpoint="checkpoint", **more):
    ingest.ingest_stream(
        E.file_events(spark, source, max_files=1), sinks, f"{root}/{checkpoint}", available_now=True, **more
    ).awaitTermination()


def test_ingest_replay_and_batch_agree(spark, tmp_path):
    source, root = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    events = [{k: v for k, v in {**e, "trip_id": str(n)}.items() if v is not None}
              for n, e, _, _ in VECTORS]
    (source / "1.json").write_text("\n".join(map(json.dumps, events)))
    sinks = sinks_under(root)
    run(spark, str(source), sinks, root)
    resent = {**events[0], "trip_duration": 5400, "bike_id": 99}   # numbers instead of text
    broken = {k: v for k, v in events[0].items() if k != "bike_type"}
    (source / "2.json").write_text(
        "\n".join([json.dumps(resent), json.dumps(broken), "no json"]))
    run(spark, str(source), sinks, root)
    run(spark, str(source), sinks, root)   # nothing new: nothing changes

    stored = {r.trip_id: r for r in tables.read_metadata(spark, sinks.metadata).collect()}
    first = stored["1"]
    assert (first.bike_id, first.trip_duration, first.is_valid) == (1, 1800, True)
    assert int(first.quality_score) == 80 and first.quality_issues == ["duration_mismatch"]
    poison = {r.trip_id for r in spark.read.parquet(sinks.quarantine).collect()}
    assert poison == {"23", "23.1", "24", "25"}
    assert spark.read.parquet(sinks.rejected).count() == 2
    bronze = spark.read.parquet(sinks.bronze)
    assert bronze.count() == len(VECTORS) - 4 + 1
    assert {(r.year, r.month) for r in bronze.select("year", "month").collect()} == {("2024", "01")}
    assert {"18", "20"} <= {r.trip_id for r in bronze.collect()} and "18" not in stored
    assert not [c for c in bronze.columns if c.startswith("_")]
    # a batch that is delivered again replaces its own rows
    bodies = spark.read.text(str(source / "2.json"))
    key = sorted(p.name for p in (tmp_path / "out" / "rejected").glob("batch=*"))[-1].split("=", 1)[1]
    ingest.write_batch(bodies, key, sinks)
    assert spark.read.parquet(sinks.bronze).count() == len(VECTORS) - 4 + 1
    assert len(tables.read_metadata(spark, sinks.metadata).collect()) == len(stored)


def test_a_new_checkpoint_adds_to_the_sinks(spark, tmp_path):
    """Another query on the same sinks counts its batches from 0; nothing stored is lost or hidden."""
    body = {k: v for k, v in VECTORS[0][1].items() if v is not None}
    root = str(tmp_path / "out")
    sinks = sinks_under(root)
    for number, trips in enumerate((("a", "b"), ("c",), ("d",))):
        source = tmp_path / f"in{number}"
        source.mkdir()
        for trip in trips:
            (source / f"{trip}.json").write_text(
                json.dumps({**body, "trip_id": trip, "ingested_at": "1999-01-01T00:00:00Z"}) + "\nno json")
        run(spark, str(source), sinks, root, f"checkpoint{number}", fold_every=1)
    stored = tables.read_metadata(spark, sinks.metadata).collect()
    assert {r.trip_id for r in stored} == set("abcd") and spark.read.parquet(sinks.bronze).count() == 4
    assert spark.read.parquet(sinks.rejected).count() == 4
    assert all(r.ingested_at.year > 2000 for r in stored)   # stamped at the door, whatever the sender says


def test_a_batch_moves_no_rows(spark):
    scored = ingest.score_events(E.parse_bodies(spark.createDataFrame([("{}",)], "value string")))
    assert "Exchange" not in scored._jdf.queryExecution().executedPlan().toString()


def test_queued_bodies_keep_their_stamp(spark):
    events = spark.createDataFrame([("2024-01-01T00:00:00Z",), ("",)], "ingested_at string")
    now = F.lit("2025-01-01 00:00:00").cast("timestamp")
    assert [r[0][:4] for r in E.stamp_ingest(events, now, queued=True).collect()] == ["2024", "2025"]
    assert [r[0][:4] for r in E.stamp_ingest(events, now).collect()] == ["2025", "2025"]


def test_events_take_defaults(spark):
    bodies = spark.createDataFrame([(json.dumps({
        "trip_id": "a", "bike_id": 101, "start_time": "s", "end_time": "e", "start_station_id": 1.5,
        "end_station_id": "2", "trip_duration": 1e3, "bike_type": "x", "extra": {"k": 1}}),)],
        "value string")
    events, rejected = E.parse_events(bodies)
    row = events.first()
    assert (row.rider_age, row.member_casual, row.bike_id) == ("0", "casual", "101")
    assert row.start_station_id == "1.5" and float(row.trip_duration) == 1000.0
    assert rejected.count() == 0


def test_json_is_parsed_once(spark):
    events, _ = E.parse_events(spark.createDataFrame([("{}",)], "value string"))
    plan = events._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_quality_stream_judges_each_row_once(spark, tmp_path):
    bronze = str(tmp_path / "bronze")
    events = X.trip_events(spark, SF)
    scored = ingest.coerced(score_stream(events, keep_parsed=True)).withColumn(
        "processed_at", F.col("processed_at").cast("timestamp_ntz"))
    tables.write_bronze(scored, bronze, "r-0")
    stored = spark.read.parquet(bronze)
    at = F.lit("2024-02-01 10:00:00").cast("timestamp")
    for _ in range(2):
        stream = look_back.bronze_stream(spark, bronze, stored.schema)
        look_back.quality_stream(stream, f"{tmp_path}/silver", f"{tmp_path}/reports",
                                 f"{tmp_path}/checkpoint", as_of=at).awaitTermination()
    silver = spark.read.parquet(f"{tmp_path}/silver")
    expected = score_batch(stored).where("is_valid_quality")
    assert rows(silver.select("trip_id", "quality_score")) == rows(
        expected.select("trip_id", "quality_score"))
    report = spark.read.parquet(f"{tmp_path}/reports").collect()
    assert len(report) == 1 and report[0].total_records == stored.count()


def test_windows_equal_batch_statistics(spark, tmp_path):
    layout = X.table(spark, SF, "events").schema
    stream = spark.readStream.schema(layout).option("pathGlobFilter", "events.parquet").parquet(SF)
    scored = score_stream(X.as_trip_events(stream))
    for make, batch, key in (
        (windows.hourly_stream, quality.hourly_stats, "hour"),
        (windows.daily_stream, quality.quality_summary, "date"),
    ):
        name = f"w_{key}"
        make(scored).writeStream.outputMode("complete").format("memory").queryName(name) \
            .trigger(availableNow=True).start().awaitTermination()
        mine = {(r[0].replace(tzinfo=None).isoformat()[:13]): tuple(r[1:]) for r in
                spark.table(name).collect()}
        whole = batch(score_stream(X.trip_events(spark, SF)))
        if key == "date":
            whole = whole.select(F.col("date").cast("timestamp").alias("date"), "total_trips",
                                 "avg_quality_score", "valid_trips", "invalid_trips")
        theirs = {r[0].isoformat()[:13]: tuple(r[1:]) for r in whole.collect()}
        assert mine == theirs


def test_windows_of_a_new_checkpoint(spark, tmp_path):
    """A new checkpoint over the same folder: its windows count, although its batches begin at 0 again."""
    source, path = str(tmp_path / "in"), str(tmp_path / "windows")
    events = X.table(spark, SF, "events")
    cuts = events.approxQuantile("event_id", [0.3, 0.6, 0.9], 0.0)

    def add(low, high):
        events.where((F.col("event_id") > low) & (F.col("event_id") <= high)).coalesce(1).write.mode("append").parquet(source)

    def stream(checkpoint, files):
        raw = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", files).parquet(source)
        windows.store_windows(windows.daily_stream(score_stream(X.as_trip_events(raw)), "400 days"), path,
                              str(tmp_path / checkpoint), available_now=True).awaitTermination()
        return rows(windows.read_windows(spark, path).select("date", "trips_processed", "valid_count"))

    def whole():
        stored = score_stream(X.as_trip_events(spark.read.parquet(source)))
        return rows(quality.quality_summary(stored).select(
            F.col("date").cast("timestamp").alias("date"), F.col("total_trips"), F.col("valid_trips")))

    for low, high in zip([-1, *cuts], cuts):
        add(low, high)
    first = stream("one", 1)
    assert first == whole()
    add(cuts[-1], 1 << 40)
    second = stream("two", 1000)
    assert second == whole() and sum(r[1] for r in second) == events.count() > sum(r[1] for r in first)
    assert stream("one", 1) == whole()                       # the first goes on where it was


def test_no_loss_between_sent_and_stored(spark):
    events = X.trip_events(spark, SF)
    kept, poison = keyed.quarantine(score_stream(events, keep_parsed=True))
    row = quality.reconcile(events, kept.unionByName(poison)).first()
    assert (row.lost, float(row.loss_percentage)) == (0, 0.0) and row.sent == events.count()


def test_late_rows_add_to_closed_windows(spark, tmp_path):
    """Sums of batches: rows a month late count, folds and a repeated batch change nothing, windows add up to all rows."""
    source, path = str(tmp_path / "in"), str(tmp_path / "windows")
    events = X.table(spark, SF, "events")
    cuts = [1 << 40, *reversed(events.approxQuantile("event_id", [0.25, 0.5, 0.75], 0.0)), -1]

    def stream(checkpoint, **options):
        raw = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(source)
        windows.store_sums(score_stream(X.as_trip_events(raw)), path, str(tmp_path / checkpoint),
                           available_now=True, **options).awaitTermination()
        return rows(windows.read_sums(spark, path))

    def whole():
        return rows(quality.hourly_stats(score_stream(X.as_trip_events(spark.read.parquet(source)))).select(
            F.col("hour").cast("timestamp"), "trips_processed", "avg_quality", "valid_count", "invalid_count"))

    for high, low in zip(cuts, cuts[1:]):  # the last events come first
        events.where((F.col("event_id") > low) & (F.col("event_id") <= high)).coalesce(1).write.mode("append").parquet(source)
        got = stream("one", fold_every=2)
        assert got == whole()
    assert sum(r[1] for r in got) == events.count()
    assert windows.fold_sums(spark, path) and rows(windows.read_sums(spark, path)) == got
    assert not windows.fold_sums(spark, path) and list((tmp_path / "windows" / "sums").glob("batch=*")) == []
    assert stream("two") == got  # a new checkpoint over the same rows counts none of them twice


def test_what_only_the_rules_read_is_not_kept_for_the_sinks(spark, tmp_path, monkeypatch):
    from tripflow.streaming import ingest as jobs

    seen, root = [], str(tmp_path)
    monkeypatch.setattr(jobs.tables, "write_bronze", lambda rows, *_: seen.append(rows.columns))
    jobs.write_batch(spark.createDataFrame([('{"trip_id": "a", "bike_id": 1}',)], "value string"), "r-0", jobs.Sinks(
        f"{root}/bronze", f"{root}/metadata", f"{root}/quarantine", f"{root}/rejected"))
    assert {c for c in seen[0] if c.startswith("_")} <= {*jobs.KEPT} and "_start" in seen[0]
