"""Exact duplicates by composable polynomial fingerprints.

A text is cut into chunks of bytes. A chunk's hash is a polynomial in two bases modulo two primes; hashes
of neighbours combine to the hash of both, H(xy) = H(x) * B ** len(y) + H(y), so a huge text needs no
more memory than a chunk. Texts of equal length and fingerprint are compared chunk by chunk with the
text of their class's leader, so that a collision can't merge two texts.

Results for special rows: a NULL text is the empty text; a NULL id sorts below every id (a class of NULL ids
only keeps a NULL one); rows that repeat an id and its text are single rows of one class, of which one
stays; an empty table gives an empty table. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm import common

CHUNK = 1 << 14
# the two largest primes below 2 ** 31 (fixed values), and a base for each
PRIMES = (2147483647, 2147483629)
BASES = (1103515245, 69069069)
#: members of a class that meet one copy of the leader's text
SALT_ROWS = 500


def _tables() -> list[np.ndarray]:
    """base ** (CHUNK - 1) ... base ** 0 for each prime: a chunk's hash is one dot product, which stays
    below 2 ** 8 * 2 ** 31 * CHUNK = 2 ** 53."""
    out = []
    for prime, base in zip(PRIMES, BASES, strict=True):
        powers = [1]
        for _ in range(CHUNK - 1):
            powers.append(powers[-1] * base % prime)
        out.append(np.array(powers[::-1], dtype=np.int64))
    return out


_TABLES: list[np.ndarray] = []


def chunk_hash(chunk: np.ndarray) -> tuple[int, int]:
    """Hashes of at most CHUNK bytes; a byte counts as its value + 1, so leading zeros count."""
    if not _TABLES:
        _TABLES.extend(_tables())
    values = chunk.astype(np.int64) + 1
    n = len(values)
    return tuple(int(values @ t[CHUNK - n:]) % p for t, p in zip(_TABLES, PRIMES, strict=True))


def combine(left: tuple[int, int], right: tuple[int, int], right_length: int) -> tuple[int, int]:
    """Fingerprint of two neighbours from theirs: the left one is shifted by the right one's length."""
    return tuple((a * pow(b, right_length, p) + c) % p
                 for a, c, b, p in zip(left, right, BASES, PRIMES, strict=True))


def fingerprint(data: np.ndarray) -> tuple[int, int]:
    total = (0, 0)
    for at in range(0, len(data), CHUNK):
        chunk = data[at:at + CHUNK]
        total = combine(total, chunk_hash(chunk), len(chunk))
    return total


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in common.pieces(batch, "text"):
            data, offsets = common.text_bytes(piece.column(1))
            prints = np.zeros(piece.num_rows, np.int64)
            for i in range(piece.num_rows):
                high, low = fingerprint(data[offsets[i]:offsets[i + 1]])
                prints[i] = high << 31 | low
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), pa.array(prints), pa.array(np.diff(offsets)), piece.column(2)],
                ["doc_id", "print", "bytes", "text_sha256"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, print (two 31-bit hashes), bytes, text_sha256; a row for each row."""
    common.small_batches(docs.sparkSession)
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", text.alias("text"), F.sha2(text, 256).alias("text_sha256")).mapInArrow(
        _fingerprints, "doc_id long, print long, bytes long, text_sha256 string")


def _chunks(text):
    """Chunks of a text with their place; characters, so that no chunk cuts one."""
    return F.posexplode(F.transform(
        F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.length(text) / CHUNK).cast("int") - 1)),
        lambda k: F.substring(text, k * CHUNK + 1, F.lit(CHUNK)))).alias("chunk_no", "chunk")


def classes(docs: DataFrame, printed: Callable[[DataFrame], DataFrame] = fingerprints) -> DataFrame:
    """doc_id, row (a row's own number), text_sha256, class columns print, bytes, other, keep_row,
    keep_id and group_size for every row.

    ``other`` is empty for texts equal to the leader's; the rest of a class (a fingerprint collision)
    is told apart by digest.
    """
    key = ["print", "bytes"]
    prints = common.stored(
        printed(docs).withColumn("row", F.monotonically_increasing_id()), "prints")
    groups = prints.groupBy(*key).agg(
        F.max(F.struct("doc_id", "row", "text_sha256")).alias("leader"),
        F.count("*").alias("size")).where("size > 1")
    leads = F.expr("doc_id <=> leader.doc_id AND text_sha256 = leader.text_sha256")
    members = prints.join(groups, key).select(
        "doc_id", "text_sha256", *key, "size", leads.alias("leads")).distinct()
    texts = docs.select(F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.withColumn("digest", F.sha2("text", 256))
    found = texts.join(members, F.expr("id <=> doc_id AND digest = text_sha256"))
    salts = F.ceil(F.col("size") / SALT_ROWS).cast("long")
    whole = found.where("NOT leads").withColumn("salt", F.pmod(F.xxhash64("doc_id"), salts)).select(
        "doc_id", "text_sha256", *key, "salt", _chunks(F.col("text")))
    first = found.where("leads").dropDuplicates(["doc_id", "text_sha256"]).select(
        *key, F.explode(F.sequence(F.lit(0).cast("long"), salts - 1)).alias("salt"), "text")
    first = first.select(*key, "salt", _chunks(F.col("text"))).withColumnRenamed("chunk", "leader_chunk")
    unlike = whole.join(first, [*key, "salt", "chunk_no"], "left").where(
        ~F.col("chunk").eqNullSafe(F.col("leader_chunk"))).select(
            F.col("doc_id").alias("id"), F.col("text_sha256").alias("digest")).distinct()
    told = prints.join(unlike, F.expr("id <=> doc_id AND digest = text_sha256"), "left")
    told = told.withColumn("other", F.coalesce("digest", F.lit(""))).drop("id", "digest")
    key = [*key, "other"]
    final = told.groupBy(*key).agg(F.max(F.struct("doc_id", "row")).alias("stays"),
                                   F.count("*").alias("group_size"))
    final = final.select(*key, F.col("stays.row").alias("keep_row"), F.col("stays.doc_id").alias("keep_id"),
                         "group_size")
    return told.join(final, key)


def dedupe(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row; of equal texts the row with the
    largest id stays."""
    return classes(docs).select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), "text_sha256")


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows that stay, all columns as they are."""
    stay = classes(docs).where("row = keep_row").select("doc_id", F.col("text_sha256").alias("digest"))
    return common.keep_rows(docs, stay, F.sha2(F.coalesce("text", F.lit("")), 256))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe(common.table(spark, sf_dir, "documents"))


SQL = {"op10_exact_dedup": """
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents"""}
