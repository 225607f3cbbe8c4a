"""Keyed merges as pure functions ``(current, new) -> next`` and the row splits before them.

Plain Parquet has no row-level merge, so each merge is a join or an aggregation on the key and a
writer of :mod:`tripflow.sources.tables` persists the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripflow import schema
from tripflow.functions import parsing as P
from tripflow.functions import trips as C


def _key_join(left: DataFrame, right: DataFrame, on: list[str], null_safe: bool, how: str) -> DataFrame:
    keys = right.select(*[F.col(c).alias(f"_seen_{c}") for c in on])
    same = F.lit(True)
    for c in on:
        mine, seen = F.col(c), F.col(f"_seen_{c}")
        same = same & (mine.eqNullSafe(seen) if null_safe else mine == seen)
    return left.join(keys, same, how)


def anti_join(
    left: DataFrame, right: DataFrame, on: list[str], null_safe: bool = False
) -> DataFrame:
    """Rows of ``left`` whose key is not in ``right``; with ``null_safe`` NULL equals NULL."""
    return _key_join(left, right, on, null_safe, "left_anti")


def semi_join(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Rows of ``left`` whose key is in ``right``; NULL equals NULL."""
    return _key_join(left, right, on, True, "left_semi")


def first_per_key(df: DataFrame, key: list[str], order: list[str | Column]) -> DataFrame:
    """First row per key in the given order, limited per task before the shuffle."""
    window = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


# ---- warehouse -------------------------------------------------------------------------------


def insert_if_absent(
    current: DataFrame, new: DataFrame, order: list[str | Column], key: list[str] | None = None
) -> DataFrame:
    """Rows of ``new`` to append: first per key (ride_id, started_at), none that is stored already.

    Ranking comes first: its group limit leaves one row per key and task before the shuffle, and
    the anti join then runs on the same partitioning without moving the new rows again.
    """
    key = list(key or schema.TRIP_KEY)
    return anti_join(first_per_key(new, key, order), current, key)


def short_key(key: Column) -> list[Column]:
    """A text key without loss as ``digest`` (the 16 bytes of a hex md5) or ``text`` (any other)."""
    is_digest = key.rlike(r"\A[0-9a-f]{32}\z")
    return [F.when(is_digest, F.unhex(key)).alias("digest"), F.when(~is_digest, key).alias("text")]


def long_key(digest: Column, text: Column) -> Column:
    """The text of a :func:`short_key`."""
    return F.coalesce(F.lower(F.hex(digest)), text)


def key_counts(new: DataFrame, stored: DataFrame) -> DataFrame:
    """Of each key of ``new`` (month, key; or month and :func:`short_key`): its rows there (n), and whether it is stored.

    The keys move alone, as bytes. NULL is one key, which is never stored.
    """
    def side(rows: DataFrame, n: int) -> DataFrame:
        key = ["digest", "text"] if "digest" in rows.columns else short_key(F.col("key"))
        return rows.select("month", *key, F.lit(n).alias("n"), F.lit(n == 0).alias("stored"))

    both = side(new, 1).unionByName(side(stored.where(F.col("key").isNotNull()), 0))
    return both.groupBy("month", "digest", "text").agg(
        F.sum("n").alias("n"), F.bool_or("stored").alias("stored")).where(F.col("n") > 0)


def first_station_rows(trips: DataFrame, order: list[str]) -> DataFrame:
    """Where each station comes first: its role there and the place (``order``), start rows before end rows.

    For long tables: the least place is folded by hash, no row is sorted. The last column of the place is a number
    that is never NULL.
    """
    def side(role: int, prefix: str) -> Column:
        return F.struct(F.lit(role).alias("role"), C.clean_station_id(F.col(f"{prefix}_station_id")).alias("station_id"))

    sides = trips.select(
        F.explode(F.array(side(0, "start"), side(1, "end"))).alias("side"), *order,
    ).select("side.*", *order).where(F.col("station_id").isNotNull())
    least = sides.groupBy("station_id", "role", *order[:-1]).agg(F.min(order[-1]).alias(order[-1]))
    return first_per_key(least, ["station_id"], ["role", *order])


def build_stations(trips: DataFrame, order: list[str], seen_at: Column, firsts: DataFrame | None = None) -> DataFrame:
    """First name and position of each station, start rows before end rows.

    Both stations of a trip come from one pass over it. Positions may differ from trip to trip, so
    nothing is grouped by them: each task keeps its first row per station and only those move. With ``firsts``
    (:func:`first_station_rows`, a short table of known size) only the rows named there are ranked.
    """
    if firsts is not None:
        trips = semi_join(trips, firsts.select(*order).distinct(), order)

    def side(role: int, prefix: str) -> Column:
        return F.struct(
            F.lit(role).alias("role"),
            C.clean_station_id(F.col(f"{prefix}_station_id")).alias("station_id"),
            F.col(f"{prefix}_station_name").alias("station_name"),
            F.col(f"{prefix}_lat").cast("double").alias("latitude"),
            F.col(f"{prefix}_lng").cast("double").alias("longitude"),
        )

    sides = trips.select(
        F.explode(F.array(side(0, "start"), side(1, "end"))).alias("side"), *order,
    ).select("side.*", *order).where(F.col("station_id").isNotNull())
    first = first_per_key(sides, ["station_id"], ["role", *order])
    return first.select(
        "station_id", "station_name", "latitude", "longitude",
        seen_at.alias("first_seen"), seen_at.alias("last_seen"),
    )


def upsert_stations(current: DataFrame, new: DataFrame) -> DataFrame:
    """New name and position unless NULL, greatest last_seen, first_seen kept."""
    old, fresh = current.alias("old"), new.alias("new")

    def either(first: str, second: str, name: str) -> Column:
        return F.coalesce(F.col(f"{first}.{name}"), F.col(f"{second}.{name}")).alias(name)

    return old.join(fresh, F.col("old.station_id") == F.col("new.station_id"), "full_outer").select(
        either("old", "new", "station_id"),
        either("new", "old", "station_name"),
        either("new", "old", "latitude"),
        either("new", "old", "longitude"),
        either("old", "new", "first_seen"),
        F.greatest(F.col("old.last_seen"), F.col("new.last_seen")).alias("last_seen"),
    )


def ledger_entries(trips: DataFrame, loaded_at: Column) -> DataFrame:
    """Rows loaded per source file."""
    return trips.groupBy("source_file").agg(F.count("*").alias("records_loaded")) \
        .withColumn("load_date", loaded_at)


def ledger_of(files: DataFrame, counts: DataFrame | None, loaded_at: Column) -> DataFrame:
    """An entry for every file (``source_file``), of 0 rows where ``counts`` (source_file, n) has none."""
    names = files.select("source_file").distinct()
    if counts is None:
        rows = names.withColumn("records_loaded", F.lit(0).cast("bigint"))
    else:
        sums = counts.groupBy("source_file").agg(F.sum("n").alias("n"))
        rows = names.join(sums, "source_file", "left").select(
            "source_file", F.coalesce("n", F.lit(0)).alias("records_loaded"))
    return rows.withColumn("load_date", loaded_at)


def upsert_ledger(current: DataFrame, new: DataFrame) -> DataFrame:
    """Replace the entry of a file that is loaded again."""
    return anti_join(current, new, ["source_file"]).unionByName(new)


# ---- trip metadata ---------------------------------------------------------------------------


def upsert_metadata(
    current: DataFrame, new: DataFrame, order: list[str], refresh_valid: bool = False
) -> DataFrame:
    """First values of a trip, with score, issues and processed_at of its last arrival.

    ``order`` names the arrival order inside ``new``; a stored row comes before all new ones. The
    validity flag keeps its first value unless ``refresh_valid`` is set. Both sides are folded by
    one aggregation on trip_id that combines per task before its shuffle.
    """
    columns = current.columns
    arrivals = new.select(
        *columns, F.struct(F.lit(1).alias("_round"), *order).alias("_arrival"))
    before_all = [F.lit(None).cast(kind).alias(c) for c, kind in new.select(*order).dtypes]
    stored = current.select(
        *columns, F.struct(F.lit(0).alias("_round"), *before_all).alias("_arrival"))
    return fold_metadata(stored.unionByName(arrivals), columns, refresh_valid)


def fold_metadata(
    changes: DataFrame, columns: list[str], refresh_valid: bool = False
) -> DataFrame:
    """One row per trip from all its arrivals, ordered by ``_arrival``."""
    refreshed = [c for c in schema.METADATA_REFRESHED if c in columns]
    if refresh_valid:
        refreshed.append("is_valid")
    fixed = [c for c in columns if c not in refreshed and c != "trip_id"]
    folded = changes.groupBy("trip_id").agg(
        F.min_by(F.struct(*fixed), "_arrival").alias("_first"),
        F.max_by(F.struct(*refreshed), "_arrival").alias("_last"),
    )
    return folded.select("trip_id", "_first.*", "_last.*").select(*columns)


def metadata_rows(scored: DataFrame) -> DataFrame:
    """Scored events (with parsed columns) in the layout of the metadata table."""
    def stamp(name: str) -> Column:
        kind = dict(scored.dtypes).get(name)
        if kind is None:
            return F.lit(None).cast("timestamp_ntz")
        return P.iso_ts(F.col(name)) if kind == "string" else F.col(name).cast("timestamp_ntz")

    def number(name: str) -> Column:
        return P.whole(F.col(name), "int")

    return scored.withColumns({
        "bike_id": number("_bike"), "start_time": F.col("_start"), "end_time": F.col("_end"),
        "start_station_id": number("_start_station"), "end_station_id": number("_end_station"),
        "rider_age": number("_age"), "trip_duration": number("_duration"),
        "member_casual": P.or_default(F.col("member_casual"), "casual"),
        "quality_score": F.col("quality_score").cast("decimal(5,2)"),
        "ingested_at": stamp("ingested_at"), "processed_at": stamp("processed_at"),
        "created_at": stamp("processed_at"),
    })


def metadata_eligible(rows: DataFrame) -> DataFrame:
    """Rows that fit the metadata table: required values present, texts within their lengths."""
    required = [
        "trip_id", "bike_id", "start_time", "end_time", "start_station_id", "end_station_id",
        "rider_age", "trip_duration", "bike_type", "quality_score", "is_valid",
    ]
    fits = F.lit(True)
    for c in required:
        fits = fits & F.col(c).isNotNull()
    for c, longest in {"trip_id": 255, "bike_type": 50, "member_casual": 10}.items():
        fits = fits & (F.coalesce(F.length(c), F.lit(0)) <= longest)
    return rows.where(fits)


def is_poison(scored: DataFrame) -> Column:
    """Events no worker can finish: no start time, or a duration or age that stayed text."""
    return (
        F.col("_start").isNull() | F.col("_duration").isNull() | F.col("_age").isNull()
        | F.col("bike_type").isNull()
    )


def quarantine(scored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept, rejected) of scored events that still carry their parsed columns."""
    poison = is_poison(scored)
    return scored.where(~poison), scored.where(poison)
