from __future__ import annotations

import numpy as np
import pytest
from conftest import SF
from helpers import ODD, frame, read
from pyspark.sql import functions as F

from tripflow.llm import token_counts as tc


@pytest.mark.parametrize("block", [7, 1000, 1 << 20])
def test_blocks_of_any_size(spark, block):
    docs = read(spark, SF)
    coder = tc.encoding(tc.VOCABULARY)
    got = {r.doc_id: r.n_tokens for r in tc.count_tokens(docs, block=block).collect()}
    assert got == {r.doc_id: len(coder.encode_ordinary(r.text)) for r in docs.collect()}


@pytest.mark.parametrize("width", [2, 4])
def test_files_of_others(spark, tmp_path, width):
    """Flat files written elsewhere: empty documents, a document over several blocks, an unclosed one, an empty file."""
    ids = [1, 2, 0, 0, *[5] * 9, 0, 3]
    np.array(ids, f"<u{width}").tofile(tmp_path / "a.tokens")
    np.array([0], f"<u{width}").tofile(tmp_path / "b.tokens")
    np.array([], f"<u{width}").tofile(tmp_path / "c.tokens")
    files = spark.createDataFrame([(f"{tmp_path}/{c}.tokens",) for c in "abc"], "file string")
    got = tc.count(files, end=0, width=width, block=3).collect()
    assert sorted((r.file[-8], r.ordinal, r.n_tokens, r.closed) for r in got) == [
        ("a", 0, 2, True), ("a", 1, 0, True), ("a", 2, 9, True), ("a", 3, 1, False), ("b", 0, 0, True)]


def test_odd_rows(spark):
    got = tc.count_tokens(frame(spark, ODD, clash=True)).collect()
    coder = tc.encoding(tc.VOCABULARY)
    assert sorted(((r.doc_id, r.n_tokens) for r in got), key=str) == sorted(
        ((r[0], len(coder.encode_ordinary(r[1] or ""))) for r in ODD), key=str)


def test_empty(spark):
    assert tc.count_tokens(frame(spark, [])).collect() == []


def test_documents_do_not_meet_on_the_driver(spark):
    """The stored rows are far smaller than what a broadcast would make of them."""
    got = tc.count_tokens(spark.range(3000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("a b "), F.col("id").cast("int") % 7).alias("text")))
    assert got.count() == 3000 and got.where("n_tokens > 0").count() == 3000 - 429
    shown = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in shown and "Broadcast" not in shown
