"""What the text operators share: whole-column byte arrays, word hashes, tables in the shared folder.

Texts reach Python as Arrow batches. ``pieces`` cuts a batch into runs of rows of bounded bytes, so that
the numpy arrays of a task stay small whatever the length of the texts; a single text larger than the
bound is a piece of its own.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from tripflow.session import ensure_checkpoint_dir

PIECE_BYTES = 1 << 20
BATCH_ROWS = "1000"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new name under the folder that the cluster shares (``spark.checkpoint.dir``)."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/tripflow-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read back: one computation, no lineage, and whatever
    an executor that dies later held can be read again by another."""
    spark = df.sparkSession
    path = shared_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written meanwhile go when it is written, not when the driver collects its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """The store of a file in the shared folder, and its path there; a task's way to plain files."""
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def small_batches(spark: SparkSession) -> None:
    """Bound the rows of an Arrow batch: a batch of long texts must fit a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def keep_rows(docs: DataFrame, kept: DataFrame, digest: Column) -> DataFrame:
    """The rows of ``docs`` whose id and digest are in ``kept`` (doc_id, digest); of rows that repeat both, one.

    NULL ids match NULL ids. Join and ranking use the same three keys, so the rows move once.
    """
    mark = "_kept"
    while any(c.startswith(mark) for c in docs.columns):
        mark = f"_{mark}"
    key, nth, id_ = [f"{mark}_id", f"{mark}_null", f"{mark}_digest"], f"{mark}_nth", F.col("doc_id")
    left = docs.withColumns({key[0]: F.coalesce(id_, F.lit(0).cast("long")), key[1]: id_.isNull(), key[2]: digest})
    right = kept.select(F.coalesce(id_, F.lit(0).cast("long")).alias(key[0]), id_.isNull().alias(key[1]),
                        F.col("digest").alias(key[2])).distinct()
    plain = [f.name for f in docs.schema if isinstance(f.dataType, AtomicType) and f.name != "text"]
    first = Window.partitionBy(*key).orderBy(*[F.col(f"`{c}`") for c in plain])
    joined = left.join(right, key, "left_semi").withColumn(nth, F.row_number().over(first))
    return joined.where(F.col(nth) == 1).drop(*key, nth)


def crc_part(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; NULL ids count as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % parts


def pieces(batch: pa.RecordBatch, column: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose texts in ``column`` take at most ``limit`` bytes together."""
    n = batch.num_rows
    if not n:
        return
    at = batch.schema.get_field_index(column)
    _, offsets = text_bytes(batch.column(at))
    begin = 0
    while begin < n:
        end = int(np.searchsorted(offsets, offsets[begin] + limit, side="right")) - 1
        end = min(n, max(begin + 1, end))
        yield batch.slice(begin, end - begin)
        begin = end


def text_bytes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in a row, and where each begins (n + 1 offsets); NULL is empty.

    A view of Arrow's own buffers.
    """
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    if array.null_count:
        array = array.fill_null("" if not pa.types.is_binary(array.type) else b"")
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    kind = np.int64 if wide else np.int32
    n = len(array)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, places, data = array.buffers()
    offsets = np.frombuffer(places, kind)[array.offset:array.offset + n + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0]:offsets[-1]], offsets - offsets[0]


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lower(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z; every other byte, and so every other character, stays."""
    return _LOWER[data]


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of every maximal run of true values that doesn't cross a text's border."""
    n = len(inside)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    cut = offsets[1:-1]
    cut = cut[(cut > 0) & (cut < n)]
    begins[cut] |= inside[cut]
    ends[cut - 1] |= inside[cut - 1]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


# Two odd multipliers of the splitmix64 finaliser (fixed values)
_MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX_2 = np.uint64(0x94D049BB133111EB)
_GOLDEN = 0x9E3779B97F4A7C15


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Bits of 64-bit values stirred (splitmix64), another way for each seed."""
    x = x + np.uint64((_GOLDEN * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * _MIX_1
    x = (x ^ (x >> np.uint64(27))) * _MIX_2
    return x ^ (x >> np.uint64(31))


_BYTE_CODE = mix(np.arange(256, dtype=np.uint64), 11)
_BASE = 0x5851F42D4C957F2D
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base ** 0 ... base ** (n - 1) modulo 2 ** 64, kept by the worker for the next piece."""
    got = _powers.get(base)
    if got is None or len(got) < n:
        size = max(n, PIECE_BYTES + 1)
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        got = np.multiply.accumulate(steps)
        if size <= 4 * PIECE_BYTES:
            _powers[base] = got
    return got[:n]


def span_hashes(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every byte span: differences of one running polynomial sum, shifted to place 0."""
    if not len(begins):
        return np.zeros(0, np.uint64)
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE_CODE[data] * _power(_BASE, n), out=sums[1:])
    values = (sums[ends] - sums[begins]) * _power(_BASE_INVERSE, n)[begins]
    return mix(values ^ (ends - begins).astype(np.uint64))


def words(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z, and the first word of each
    text in that list (n + 1 places)."""
    data, offsets = text_bytes(array)
    data = lower(data)
    begins, ends = runs(~_SPACE[data], offsets)
    return span_hashes(data, begins, ends), np.searchsorted(begins, offsets)


def signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)
