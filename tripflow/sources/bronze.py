"""Bronze events: folders by month and batch, an index of their arrival, and parts packed from old batches.

* ``year=/month=/batch=``: what the ingest writes, a few small files every few seconds.
* ``_arrivals/day=/``: an empty file for each of those folders, whose name holds the time of its files; a look-back
  lists the days it asks for and reads the folders it needs, however many there are.
* ``_packed/v=/year=/month=``: batches of some age, packed into files of full size. Rows keep their batch and the
  path, size and time of the file they came in, so a look-back at any time gives the same rows as before.
* ``_log``: versions (see :mod:`tripflow.sources.log`). A version names the packed parts and, for each run, the last
  batch that they hold; whatever batch comes after is read from its own folder. So rows move from folders to parts in one
  step. Folders go one compaction later, so that readers of the version before keep their files.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.sources import files
from tripflow.sources.log import VersionLog, extended, is_done, put_new, split_key

#: a part at least this large is never packed again
PART_BYTES = 1 << 30
#: batches stay in their own folders this long
KEEP_MINUTES = 60
ORIGIN = ["_file_path", "_file_size", "_last_modified"]
_DAY = 86_400_000


def _day(ms: int) -> str:
    return dt.datetime.fromtimestamp(ms / 1000, dt.timezone.utc).strftime("%Y-%m-%d")


def note_arrival(spark: SparkSession, root: str, batch: str, layout: T.StructType) -> None:
    """Enter the folders of a written batch in the index; a batch entered again has one more entry.

    The entry follows the rows: between the two a look-back misses a batch that it finds a moment later.
    """
    for folder, times in files.times_of_glob(spark, f"{root}/year=*/month=*/batch={batch}").items():
        year, month = (part.partition("=")[2] for part in folder.split("/")[-3:-1])
        if times:
            files.touch(spark, f"{root}/_arrivals/day={_day(min(times))}/"
                               f"{min(times)}.{max(times)}.{year}.{month}.{batch}")
    if not files.exists(spark, f"{root}/_layout.json"):
        put_new(spark, f"{root}/_layout.json", layout.json())


def has_index(spark: SparkSession, root: str) -> bool:
    return files.exists(spark, f"{root}/_layout.json")


def _layout(spark: SparkSession, root: str) -> T.StructType:
    return T.StructType.fromJson(json.loads(files.read_text(spark, f"{root}/_layout.json")))


def _arrived(spark: SparkSession, root: str, first: int, last: int) -> list[tuple[str, str]]:
    """(folder, batch) with files written between these times (milliseconds), from the index of their days."""
    found = set()
    day = first - _DAY  # an entry lies under the day of its first file
    days = []
    while _day(day) <= _day(last):
        days.append(f"{root}/_arrivals/day={_day(day)}")
        day += _DAY
    for names in files.names_of(spark, days).values():
        for name in names:
            begin, end, year, month, batch = name.split(".", 4)
            if int(begin) <= last and int(end) >= first:
                found.add((f"{root}/year={year}/month={month}/batch={batch}", batch))
    return sorted(found)


def _folders(spark: SparkSession, root: str) -> list[tuple[str, str, int]]:
    """(folder, batch, last change) of every batch folder."""
    return [(path, path.rpartition("batch=")[2], changed)
            for path, changed in files.glob(spark, f"{root}/year=*/month=*/batch=*")]


def _rows(spark: SparkSession, root: str, folders: list[str], parts: list[dict], form: str,
          layout: T.StructType | None) -> DataFrame:
    """Rows of batch folders and packed parts, with the columns of their origin."""
    out = []
    if folders:
        # a folder may be packed and gone by now; a damaged file fails the read, it is never half read
        reader = spark.read.option("ignoreMissingFiles", True).option("basePath", root)
        if form != "parquet" or layout is not None:
            reader = reader.schema(layout or _layout(spark, root))
        rows = reader.format(form).load(folders)
        meta = F.col("_metadata")
        out.append(rows.select(
            *rows.columns, meta.file_path.alias(ORIGIN[0]), meta.file_size.alias(ORIGIN[1]),
            meta.file_modification_time.alias(ORIGIN[2])))
    for version in sorted({p["version"] for p in parts}):
        base = f"{root}/_packed/{version}"
        out.append(spark.read.option("basePath", base).option("mergeSchema", True).parquet(
            *[f"{base}/year={p['year']}/month={p['month']}" for p in parts if p["version"] == version]))
    if not out:
        origin = T.StructType().add(ORIGIN[0], "string").add(ORIGIN[1], "long").add(ORIGIN[2], "timestamp")
        fields = {f.name: f for f in [*(layout or _layout(spark, root)).fields, *origin.fields]}
        return spark.createDataFrame([], T.StructType(list(fields.values())))
    all_rows = out[0]
    for more in out[1:]:
        all_rows = all_rows.unionByName(more, allowMissingColumns=True)
    return all_rows


def read_bronze(spark: SparkSession, root: str, form: str = "parquet", layout: T.StructType | None = None) -> DataFrame:
    """All stored events, packed or not, as of one version."""
    state = VersionLog(spark, root).latest()[1]
    done = state.get("done", {})
    live = [path for path, batch, _ in _folders(spark, root) if not is_done(batch, done)]
    return _rows(spark, root, live, state.get("parts", []), form, layout).drop(*ORIGIN)


def read_between(spark: SparkSession, root: str, first: int, last: int, form: str = "parquet",
                 layout: T.StructType | None = None) -> DataFrame:
    """Events of the folders and parts that hold files written between two moments (milliseconds).

    Those outside the bounds are neither listed nor opened. Adds path, size and time of the file; the caller
    filters by that time.
    """
    state = VersionLog(spark, root).latest()[1]
    done = state.get("done", {})
    live = [path for path, batch in _arrived(spark, root, first, last) if not is_done(batch, done)]
    parts = [p for p in state.get("parts", []) if p["first"] <= last and p["last"] >= first]
    # an entry may outlive its folder where a batch was written by a job that never ended
    live = [path for path in live if files.exists(spark, path)]
    return _rows(spark, root, live, parts, form, layout)


def compact_bronze(spark: SparkSession, root: str, form: str = "parquet", layout: T.StructType | None = None,
                   keep_minutes: float = KEEP_MINUTES, part_bytes: int = PART_BYTES,
                   now: dt.datetime | None = None) -> bool:
    """Pack the batches older than ``keep_minutes`` into the parts of their months; whether a version was put.

    A month's part that is still small is packed again with what has come; large ones stay. Of a run, only
    batches before its first younger one are taken. Readers see all rows once before, during and after; if another
    compaction is faster, this one's work is removed.
    """
    log = VersionLog(spark, root)
    number, state = log.latest()
    done, parts = state.get("done", {}), state.get("parts", [])
    _sweep(spark, root, number, state)
    moment = (now or dt.datetime.now(dt.timezone.utc)).timestamp() * 1000
    folders = [f for f in _folders(spark, root) if not is_done(f[1], done)]
    young: dict[str, int] = {}
    for _, batch, changed in folders:
        if changed > moment - keep_minutes * 60_000:
            run, n = split_key(batch)
            young[run] = min(n, young.get(run, n))
    old = [(path, batch) for path, batch, _ in folders
           if split_key(batch)[1] < young.get(split_key(batch)[0], split_key(batch)[1] + 1)]
    if not old:
        return False
    months = {tuple(part.partition("=")[2] for part in path.split("/")[-3:-1]) for path, _ in old}
    again = [p for p in parts if (p["year"], p["month"]) in months and p["bytes"] < part_bytes]
    version = f"v={number + 1:012d}-{uuid.uuid4().hex[:8]}"
    target = f"{root}/_packed/{version}"
    rows = _rows(spark, root, [path for path, _ in old], again, form, layout)
    # files in order of arrival, so that a look-back skips those outside its bounds
    rows.hint("rebalance", "year", "month").sortWithinPartitions("year", "month", ORIGIN[2]) \
        .write.partitionBy("year", "month").parquet(target)
    times = spark.read.parquet(target).groupBy("year", "month").agg(
        F.unix_millis(F.min(ORIGIN[2])).alias("first"), F.unix_millis(F.max(ORIGIN[2])).alias("last")).collect()
    fresh = [{"version": version, "year": r.year, "month": r.month, "first": r.first, "last": r.last,
              "bytes": files.size(spark, f"{target}/year={r.year}/month={r.month}")} for r in times]
    changed = {"done": extended(done, [batch for _, batch in old]),
               "parts": sorted([p for p in parts if p not in again] + fresh,
                               key=lambda p: (p["year"], p["month"], p["version"]))}
    if log.put(number + 1, changed):
        return True
    files.remove(spark, target)
    return False


def _sweep(spark: SparkSession, root: str, number: int, state: dict) -> None:
    """Remove what neither the last version nor a later one can name: packed batches, replaced parts, their entries."""
    if not number:
        return
    done = state["done"]
    for path, batch, _ in _folders(spark, root):
        if is_done(batch, done):
            files.remove(spark, path)
    named = {(p["version"], p["year"], p["month"]) for p in state["parts"]}
    for version in files.subfolders(spark, f"{root}/_packed"):
        if int(version[2:14]) > number:
            continue  # another compaction may be writing it
        for path, _ in files.glob(spark, f"{root}/_packed/{version}/year=*/month=*"):
            year, month = (part.partition("=")[2] for part in path.split("/")[-2:])
            if (version, year, month) not in named:
                files.remove(spark, path)
    for day in files.subfolders(spark, f"{root}/_arrivals"):
        names = files.names(spark, f"{root}/_arrivals/{day}")
        if all(is_done(name.split(".", 4)[4], done) for name in names):
            files.remove(spark, f"{root}/_arrivals/{day}")
