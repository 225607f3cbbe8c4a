from __future__ import annotations

import datetime as dt
from decimal import Decimal

from conftest import rows
from pyspark.sql import functions as F

from tripflow import schema
from tripflow.operators import keyed, sets

DAY = dt.datetime(2024, 1, 1)


def stations(spark, *items):
    return spark.createDataFrame(list(items), schema.STATIONS)


def test_station_upsert(spark):
    later, earlier = dt.datetime(2024, 2, 1), dt.datetime(2023, 1, 1)
    current = stations(spark, ("a", "A", 1.0, 1.0, DAY, DAY), ("b", "B", 1.0, 1.0, DAY, DAY))
    new = stations(spark, ("a", None, 0.0, None, later, later), ("b", "B2", 2.0, 2.0, earlier, earlier),
                   ("c", "C", None, None, later, later))
    assert rows(keyed.upsert_stations(current, new)) == [
        ("a", "A", 0.0, 1.0, DAY, later), ("b", "B2", 2.0, 2.0, DAY, DAY),
        ("c", "C", None, None, later, later)]


def test_first_station_row_starts_before_ends(spark):
    trips = spark.createDataFrame(
        [(2, "s", "late", 1.0, 1.0, "t", "t", 5.0, 5.0), (1, "u", "u", 1.0, 1.0, "s", "as end", 9.0, 9.0),
         (3, " s ", "later", 2.0, 2.0, "nan", "x", 1.0, 1.0), (4, "", "x", 1.0, 1.0, None, "x", 1.0, 1.0)],
        "n long, start_station_id string, start_station_name string, start_lat double, start_lng double,"
        "end_station_id string, end_station_name string, end_lat double, end_lng double")
    found = keyed.build_stations(trips, ["n"], F.lit(DAY).cast("timestamp_ntz"))
    assert [(r[0], r[1]) for r in rows(found)] == [("s", "late"), ("t", "t"), ("u", "u")]


def trips(spark, *items):
    return spark.createDataFrame(list(items), "ride_id string, started_at timestamp_ntz, n int")


def test_insert_if_absent_and_replay(spark):
    current = trips(spark, ("a", DAY, 1))
    new = trips(spark, ("a", DAY, 2), ("b", DAY, 4), ("b", DAY, 3), ("a", dt.datetime(2024, 1, 2), 5))
    fresh = keyed.insert_if_absent(current, new, ["n"])
    assert rows(fresh) == [("a", dt.datetime(2024, 1, 2), 5), ("b", DAY, 3)]
    stored = current.unionByName(fresh)
    assert keyed.insert_if_absent(stored, new, ["n"]).count() == 0


def test_insert_moves_new_rows_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fresh = keyed.insert_if_absent(trips(spark, ("a", DAY, 1)), trips(spark, ("a", DAY, 2)), ["n"])
        plan = fresh._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2  # one for each side


def test_ledger_replaces_by_file(spark):
    current = spark.createDataFrame([("f", 1, DAY), ("g", 2, DAY)], schema.LEDGER)
    loaded = spark.createDataFrame([("g",), ("g",), ("g",), ("h",)], "source_file string")
    new = keyed.ledger_entries(loaded, F.lit("2024-03-01").cast("timestamp_ntz"))
    found = rows(keyed.upsert_ledger(current, new))
    assert [(f, n) for f, n, _ in found] == [("f", 1), ("g", 3), ("h", 1)]


def arrival(trip, minute, score, valid, bike=1):
    at = DAY + dt.timedelta(minutes=minute)
    return (trip, bike, DAY, DAY, 1, 2, 30, 60, "classic", "member", Decimal(score), [f"i{score}"],
            valid, at, at, at)


def test_metadata_keeps_first_and_refreshes_three(spark):
    columns = schema.TRIP_METADATA
    sent = [arrival("a", 1, 100, True, bike=7), arrival("a", 2, 40, False, bike=8),
            arrival("b", 1, 90, True)]
    none = spark.createDataFrame([], columns)
    at_once = keyed.upsert_metadata(none, spark.createDataFrame(sent, columns), ["ingested_at"])
    stepwise = none
    for row in sent:
        stepwise = keyed.upsert_metadata(
            stepwise, spark.createDataFrame([row], columns), ["ingested_at"])
    replayed = keyed.upsert_metadata(
        stepwise, spark.createDataFrame(sent, columns), ["ingested_at"])
    assert rows(at_once) == rows(stepwise) == rows(replayed)
    a = {r.trip_id: r for r in at_once.collect()}["a"]
    assert (a.bike_id, a.is_valid, a.quality_score) == (7, True, Decimal(40))
    assert a.quality_issues == ["i40"] and a.processed_at == DAY + dt.timedelta(minutes=2)
    fresh = keyed.upsert_metadata(
        none, spark.createDataFrame(sent, columns), ["ingested_at"], refresh_valid=True)
    assert {r.trip_id: r.is_valid for r in fresh.collect()} == {"a": False, "b": True}


def test_sets_and_structure(spark):
    a = spark.createDataFrame([("x",), (None,)], "k string")
    b = spark.createDataFrame([("y", 1)], "k string, n int")
    assert rows(sets.union_all([a, b])) == [("x", None), ("y", 1), (None, None)]
    assert rows(sets.difference(a, spark.createDataFrame([(None,)], "k string"), "k")) == [("x",)]
    df = spark.createDataFrame([("r", 1), ("r", 1), ("q", 2)], "ride_id string, odd int")
    assert rows(sets.schema_check(df, ["ride_id", "started_at"], ["ride_id"])) == [
        ("duplicate_key", "ride_id: 1"), ("extra", "odd"), ("missing", "started_at")]
