"""Versions by one writer each, packed bronze, look-backs by index, the metadata fold as one commit."""

from __future__ import annotations

import datetime as dt
import threading

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_keyed import arrival
from test_tables import metadata

from tripflow.sources import bronze, files, tables
from tripflow.sources.events import read_bronze_since
from tripflow.sources.log import VersionLog


def put(spark, root, batch, *items):
    df = spark.createDataFrame([(str(i), m) for i, m in items], "trip_id string, start string")
    tables.write_bronze(df.withColumn("_start", F.col("start").cast("timestamp_ntz")), root, batch)


def ids(df):
    return sorted(int(r.trip_id) for r in df.select("trip_id").collect())


def moment(spark, root, batch):
    return spark.read.parquet(f"{root}/year=2024/month=01/batch={batch}").select(
        "_metadata.file_modification_time").first()[0]


def test_one_writer_puts_a_version(spark, tmp_path):
    log = VersionLog(spark, str(tmp_path))
    assert log.latest() == (0, {})
    won = []

    def write(i):
        if log.put(1, {"by": i}):
            won.append(i)

    writers = [threading.Thread(target=write, args=(i,)) for i in range(8)]
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    assert len(won) == 1 and log.latest() == (1, {"by": won[0]})
    assert [p.name for p in (tmp_path / "_log").iterdir()] == ["000000000001.json"]
    assert all(log.put(n, {"n": n}) for n in range(2, 40)) and log.latest() == (39, {"n": 39})
    assert len(list((tmp_path / "_log").iterdir())) == 20


def test_rows_are_the_same_before_during_and_after(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "bronze")
    for n in range(6):
        put(spark, root, f"r-{n}", (n, "2024-01-05"), (10 + n, "2024-02-05"))
    put(spark, root, "s-0", (100, "2024-01-05"))
    whole = ids(bronze.read_bronze(spark, root))
    held = bronze.read_bronze(spark, root)  # planned before, read after
    during = []
    original = VersionLog.put

    def watched(self, number, state):
        during.append(ids(bronze.read_bronze(spark, root)))
        done = original(self, number, state)
        during.append(ids(bronze.read_bronze(spark, root)))
        return done

    monkeypatch.setattr(VersionLog, "put", watched)
    assert bronze.compact_bronze(spark, root, keep_minutes=0, now=dt.datetime.now(dt.timezone.utc) + dt.timedelta(hours=1))
    assert during == [whole, whole] and ids(held) == whole
    assert ids(bronze.read_bronze(spark, root)) == whole and len(whole) == 13
    # nothing new: the folders go, the rows stay
    assert not bronze.compact_bronze(spark, root, keep_minutes=0)
    assert files.glob(spark, f"{root}/year=*/month=*/batch=*") == [] and ids(bronze.read_bronze(spark, root)) == whole
    # a small part is packed again with what has come, a month without news stays as it is
    before = VersionLog(spark, root).latest()[1]["parts"]
    put(spark, root, "r-6", (200, "2024-02-06"))
    later = dt.datetime.now(dt.timezone.utc) + dt.timedelta(hours=1)
    assert bronze.compact_bronze(spark, root, keep_minutes=0, now=later)
    parts = VersionLog(spark, root).latest()[1]["parts"]
    assert [p["version"] == q["version"] for p, q in zip(parts, before)] == [True, False] and len(parts) == 2
    put(spark, root, "r-6", (200, "2024-02-06"))  # a batch repeated after it was packed isn't seen twice
    assert ids(bronze.read_bronze(spark, root)) == whole + [200]
    assert not bronze.compact_bronze(spark, root, keep_minutes=0)
    assert ids(bronze.read_bronze(spark, root)) == whole + [200]


def test_young_batches_stay(spark, tmp_path):
    root = str(tmp_path / "bronze")
    put(spark, root, "r-0", (0, "2024-01-05"))
    assert not bronze.compact_bronze(spark, root, keep_minutes=60)
    assert ids(bronze.read_bronze(spark, root)) == [0]


def test_a_late_compaction_is_void(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "bronze")
    put(spark, root, "r-0", (0, "2024-01-05"))
    later = dt.datetime.now(dt.timezone.utc) + dt.timedelta(hours=1)
    original, first = VersionLog.put, []

    def beaten(self, number, state):
        if not first:  # another compaction does all of its work before this one puts its version
            first.append(1)
            assert bronze.compact_bronze(spark, root, keep_minutes=0, now=later)
        return original(self, number, state)

    monkeypatch.setattr(VersionLog, "put", beaten)
    assert not bronze.compact_bronze(spark, root, keep_minutes=0, now=later)
    assert ids(bronze.read_bronze(spark, root)) == [0]
    assert len(files.subfolders(spark, f"{root}/_packed")) == 1


def test_look_back_reads_its_own_folders(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "bronze")
    put(spark, root, "r-0", (0, "2024-01-05"), (7, "2024-03-05"))
    put(spark, root, "r-1", (1, "2024-01-05"))
    # r-0 came two days ago: its files and its entries say so
    old = dt.datetime.now().timestamp() - 2 * 86400
    import os
    for path in (tmp_path / "bronze").glob("year=*/month=*/batch=r-0/*.parquet"):
        os.utime(path, (old, old))
    for path in (tmp_path / "bronze" / "_arrivals").glob("*/*.r-0"):
        path.unlink()
    bronze.note_arrival(spark, root, "r-0", bronze._layout(spark, root))
    recent = read_bronze_since(spark, root, F.current_timestamp(), 60)
    assert ids(recent) == [1] and {f.split("batch=")[1][:3] for f in recent.inputFiles()} == {"r-1"}
    then = F.lit(dt.datetime.fromtimestamp(old, dt.timezone.utc)).cast("timestamp") + F.expr("INTERVAL 1 MINUTE")
    assert ids(read_bronze_since(spark, root, then, 15)) == [0, 7]
    listed = []
    names = files.names
    monkeypatch.setattr(files, "names", lambda spark, path: listed.append(path) or names(spark, path))
    read_bronze_since(spark, root, then, 15)
    assert sum("_arrivals" in p for p in listed) <= 3 and not [p for p in listed if "year=" in p]
    # packed, a look-back finds the same rows with the file they came in; parts outside the bounds aren't opened
    later = dt.datetime.now(dt.timezone.utc) + dt.timedelta(hours=1)
    assert bronze.compact_bronze(spark, root, keep_minutes=0, now=later)
    bronze.compact_bronze(spark, root, keep_minutes=0, now=later)
    again = read_bronze_since(spark, root, then, 15)
    assert ids(again) == [0, 7] and all("batch=r-0/" in r._file_path for r in again.collect())
    assert ids(read_bronze_since(spark, root, F.current_timestamp(), 60)) == [1]
    march = read_bronze_since(spark, root, F.current_timestamp(), 60).inputFiles()
    assert not [f for f in march if "month=03" in f]
    nothing = read_bronze_since(spark, root, F.lit("2020-01-01").cast("timestamp"), 15)
    assert nothing.count() == 0 and {"trip_id", "month", "_file_path"} <= set(nothing.columns)


@pytest.mark.parametrize("step", ["write", "put"])
def test_a_crash_in_the_fold_loses_nothing(spark, tmp_path, monkeypatch, step):
    root, key = str(tmp_path), tables.batch_key
    tables.append_metadata(metadata(spark, arrival("a", 1, 100, True)), root, key("r", 0))
    tables.fold_metadata(spark, root)
    tables.append_metadata(metadata(spark, arrival("a", 2, 40, False), arrival("b", 1, 90, True)), root, key("r", 1))
    whole = rows(tables.read_metadata(spark, root))

    class Crash(Exception):
        pass

    def crash(*_, **__):
        raise Crash

    with monkeypatch.context() as m:
        m.setattr(tables.log, "extended" if step == "write" else "put_new", crash)
        with pytest.raises(Crash):
            tables.fold_metadata(spark, root)
    assert rows(tables.read_metadata(spark, root)) == whole
    assert tables.fold_metadata(spark, root) and rows(tables.read_metadata(spark, root)) == whole
    assert not tables.fold_metadata(spark, root) and rows(tables.read_metadata(spark, root)) == whole
    assert len(files.subfolders(spark, f"{root}/folded")) <= 2


def test_two_folds_at_once(spark, tmp_path, monkeypatch):
    root, key = str(tmp_path), tables.batch_key
    tables.append_metadata(metadata(spark, arrival("a", 1, 100, True)), root, key("r", 0))
    original, first = VersionLog.put, []

    def beaten(self, number, state):
        if not first:
            first.append(1)
            tables.append_metadata(metadata(spark, arrival("c", 1, 80, True)), root, key("s", 0))
            assert tables.fold_metadata(spark, root)
        return original(self, number, state)

    monkeypatch.setattr(VersionLog, "put", beaten)
    assert not tables.fold_metadata(spark, root)
    assert {r.trip_id for r in tables.read_metadata(spark, root).collect()} == {"a", "c"}
    tables.append_metadata(metadata(spark, arrival("d", 1, 80, True)), root, key("s", 1))
    assert tables.fold_metadata(spark, root)
    assert {r.trip_id for r in tables.read_metadata(spark, root).collect()} == {"a", "c", "d"}
