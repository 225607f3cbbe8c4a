from __future__ import annotations

import hashlib

import numpy as np
from helpers import ODD, frame
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripflow.llm import exact_dedup
from tripflow.llm.exact_dedup import CHUNK, combine, dedupe, fingerprint


@given(st.binary(max_size=60), st.binary(max_size=60))
def test_fingerprints_combine(x, y):
    a, b, both = (fingerprint(np.frombuffer(z, np.uint8)) for z in (x, y, x + y))
    assert combine(a, b, len(y)) == both


def test_huge_text_is_the_polynomial_of_its_bytes():
    data = np.random.default_rng(0).integers(0, 256, 3 * CHUNK + 17).astype(np.uint8)
    expected = []
    for prime, base in zip(exact_dedup.PRIMES, exact_dedup.BASES, strict=True):
        h = 0
        for byte in data.tolist():
            h = (h * base + byte + 1) % prime
        expected.append(h)
    assert fingerprint(data) == tuple(expected)


def test_odd_rows(spark):
    got = dedupe(frame(spark, ODD, clash=True)).collect()
    assert len(got) == len(ODD)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert [r.kept for r in by[1]] == [False] and by[1][0].keep_id == 2 and by[2][0].group_size == 2
    assert by[6][0].kept and {(r.keep_id, r.group_size, r.kept) for r in by[5]} == {(6, 3, False)}
    assert by[None][0].kept and by[4][0].group_size == 1
    assert by[3][0].text_sha256 == hashlib.sha256(b" \n\t ").hexdigest()


def test_repeated_row_stays_once(spark):
    got = dedupe(frame(spark, [(7, "x"), (7, "x"), (3, "x")])).collect()
    assert sorted((r.doc_id, r.keep_id, r.kept) for r in got) == [(3, 7, False), (7, 7, False), (7, 7, True)]
    kept = exact_dedup.keep_one(frame(spark, [(7, "x"), (7, "x"), (3, "x"), (None, None)], clash=True))
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == [(7, "x"), (None, None)]
    assert "_kept_id" in kept.columns and len(kept.columns) == 17


def test_equal_fingerprints_of_unlike_texts(spark):
    def collide(docs):
        return docs.select("doc_id", F.lit(1).cast("long").alias("print"), F.octet_length("text").cast("long").alias("bytes"),
                           F.sha2("text", 256).alias("text_sha256"))

    long = "y" * (2 * CHUNK)
    rows = [(1, "ab"), (2, "ba"), (3, "ab"), (4, "ba"), (5, long + "a"), (6, long + "b"), (7, long + "a")]
    got = exact_dedup.classes(frame(spark, rows), collide).collect()
    assert {r.doc_id: r.keep_id for r in got} == {1: 3, 3: 3, 2: 4, 4: 4, 5: 7, 7: 7, 6: 6}


def test_large_group_is_salted(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "SALT_ROWS", 3)
    got = dedupe(frame(spark, [(i, "copy") for i in range(40)] + [(99, "other")])).collect()
    assert {(r.keep_id, r.group_size) for r in got} == {(39, 40), (99, 1)}
    assert sum(r.kept for r in got) == 2


def test_empty(spark):
    assert dedupe(frame(spark, [])).collect() == []
    assert exact_dedup.keep_one(frame(spark, [])).collect() == []
