"""Token counts by a separator scan of flat token files.

A token file holds identifiers of two or four bytes and nothing else: the tokens of a document, an end-of-document
identifier, the next document. The scan knows only names and sizes. Files are cut into blocks; a task
reads its blocks and finds all separators of a block by one comparison. A document may reach over
any number of blocks: a prefix scan over the blocks of a file gives the number of separators and the
place of the last one before each block, from which lengths and ordinals follow.

Results for special rows: a NULL or empty text has 0 tokens; a NULL id is an id; repeated rows are documents of their
own; an empty table writes no file and gives no rows; tokens behind the last separator of a file are a document with
``closed`` false. Other columns are not looked at.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripflow.llm import common

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: the identifier after the vocabulary's last one is free
END_OF_DOCUMENT = 50256
# how the vocabulary's texts were split into words (a fixed value)
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BLOCK_TOKENS = 1 << 20

_ENCODINGS: dict[str, tiktoken.Encoding] = {}


def encoding(vocabulary: str) -> tiktoken.Encoding:
    """The tokenizer of a file of ranks, once for each worker process."""
    if vocabulary not in _ENCODINGS:
        with open(vocabulary, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        _ENCODINGS[vocabulary] = tiktoken.Encoding(
            "ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _ENCODINGS[vocabulary]


def write_files(docs: DataFrame, folder: str, vocabulary: str = VOCABULARY,
                end: int = END_OF_DOCUMENT, width: int = 2) -> DataFrame:
    """Write a token file for each partition; file, ordinal and doc_id of every row.

    The name of a file is new in every attempt of a task, so that a repeated or doubled task never writes
    into another's file; the files of the returned rows are those of the attempts that count.
    """
    kind = np.dtype(f"<u{width}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, name, out, ordinal = encoding(vocabulary), f"{folder}/{uuid.uuid4().hex}.tokens", None, 0
        for batch in batches:
            for piece in common.pieces(batch, "text"):
                if out is None:
                    store, path = common.opened(name)
                    store.create_dir(path.rpartition("/")[0], recursive=True)
                    out = store.open_output_stream(path)
                for text in piece.column(1).to_pylist():
                    tokens = coder.encode_to_numpy(text or "", disallowed_special=())
                    out.write(tokens.astype(kind).tobytes() + np.array([end], kind).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * piece.num_rows), pa.array(np.arange(ordinal, ordinal + piece.num_rows)),
                     piece.column(0)], ["file", "ordinal", "doc_id"])
                ordinal += piece.num_rows
        if out is not None:
            out.close()

    common.small_batches(docs.sparkSession)
    rows = docs.select("doc_id", "text").mapInArrow(run, "file string, ordinal long, doc_id long")
    return common.stored(rows, "token-files")


def _blocks(width: int, block: int):
    """Names of files -> their blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                store, path = common.opened(name)
                n = -(-store.get_file_info(path).size // width)
                starts = np.arange(0, n, block)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(starts), pa.string()), pa.array(starts),
                     pa.array(np.minimum(block, n - starts))], ["file", "start", "tokens"])
    return run


def _separators(width: int, end: int):
    """A block -> its number of separators, the place behind the last one, and the lengths that they close.

    The first length counts from the block's start; what came before is added by the prefix scan.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, start, tokens in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                store, path = common.opened(name)
                with store.open_input_file(path) as file:
                    ids = np.frombuffer(file.read_at(tokens * width, start * width), f"<u{width}")
                at = np.flatnonzero(ids == end)
                lengths = np.diff(at, prepend=-1) - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name]), pa.array([start]), pa.array([tokens]), pa.array([len(at)]),
                     pa.array([start + int(at[-1]) + 1 if len(at) else None], pa.int64()),
                     pa.array([lengths], pa.list_(pa.int64()))],
                    ["file", "start", "tokens", "separators", "last", "lengths"])
    return run


def count(files: DataFrame, end: int = END_OF_DOCUMENT, width: int = 2, block: int = BLOCK_TOKENS) -> DataFrame:
    """file, ordinal, n_tokens (without the separator), closed: a row for each document of the files.

    ``files`` has a column ``file``. Nothing but their bytes says where a document begins.
    """
    blocks = files.select("file").distinct().mapInArrow(_blocks(width, block), "file string, start long, tokens long")
    found = blocks.repartition("file", "start").mapInArrow(
        _separators(width, end),
        "file string, start long, tokens long, separators long, last long, lengths array<long>")
    found = common.stored(found, "separators")
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    scanned = found.select(
        "file", "start", "lengths", (F.col("start") + F.col("tokens")).alias("stop"), "last",
        F.coalesce(F.sum("separators").over(before), F.lit(0)).alias("base"),
        F.coalesce(F.max("last").over(before), F.lit(0)).alias("begun"))
    closed = scanned.select("file", "start", "base", "begun", F.posexplode("lengths").alias("k", "length")).select(
        "file", (F.col("base") + F.col("k")).alias("ordinal"),
        (F.col("length") + F.when(F.col("k") == 0, F.col("start") - F.col("begun")).otherwise(0)).alias("n_tokens"),
        F.lit(True).alias("closed"))
    rest = found.groupBy("file").agg(
        F.sum("separators").alias("ordinal"),
        (F.max(F.col("start") + F.col("tokens")) - F.coalesce(F.max("last"), F.lit(0))).alias("n_tokens"))
    return closed.union(rest.where("n_tokens > 0").select("file", "ordinal", "n_tokens", F.lit(False).alias("closed")))


def count_tokens(docs: DataFrame, vocabulary: str = VOCABULARY, block: int = BLOCK_TOKENS) -> DataFrame:
    """doc_id, n_tokens for every row, by way of token files in the shared folder.

    Both sides of the join have a row for each document. Their stored files are some hundred times smaller than the rows
    (names of files repeat, lengths are packed lists), so that by size on disk Spark would send all of them to the driver.
    """
    rows = write_files(docs, common.shared_folder(docs.sparkSession, "tokens"), vocabulary)
    return rows.join(count(rows, block=block).hint("merge"), ["file", "ordinal"]).select("doc_id", "n_tokens")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(common.table(spark, sf_dir, "documents"))
