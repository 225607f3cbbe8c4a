"""Runs against every stretch tried, and texts that have very many of them."""

from __future__ import annotations

import hashlib
import random
import time
import zlib
from fractions import Fraction

import numpy as np
import pytest
from helpers import LONG, ODD, frame
from pyspark.sql import functions as F

from tripflow.llm import periodic_runs as P


def brute(words, least=24):
    """Maximal stretches of every period, the smallest period of each stretch kept."""
    found, n = {}, len(words)
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, 3 * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((s, length, q) for (s, length), q in found.items())


def collapsed(words, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def random_texts(n, seed):
    chance = random.Random(seed)
    for _ in range(n):
        letters = "ab" if chance.random() < .3 else "abcdefghij"
        words = []
        while len(words) < chance.randrange(1, 150):
            unit = chance.choices(letters, k=chance.randrange(1, 40))
            words += unit * (chance.randrange(3, 8) if chance.random() < .6 else 1)
            words += unit[:chance.randrange(len(unit))]
        yield words


def fibonacci(n):
    a, b = ["a"], ["a", "b"]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


CASES = [*random_texts(250, 5), ["x"] * 200, fibonacci(250), ["a", "b"] * 11 + ["a"], ["a", "b"] * 12, ["a"] * 23, ["a"] * 24,
         [str(i % 8) for i in range(24)], [str(i % 9) for i in range(26)], [str(i % 9) for i in range(27)],
         [str(bin(i).count("1") % 2) for i in range(200)], list("ab" * 20 + "c") * 5]


def test_find():
    for least in (24, 5):
        numbers = [np.array([hash(w) % 1000003 for w in words], np.int64) for words in CASES]
        doc = np.repeat(np.arange(len(numbers)), [len(x) for x in numbers])
        starts = np.cumsum([0, *(len(x) for x in numbers)])
        got = P.find(np.concatenate(numbers), doc, least)
        owner = doc[got[:, 0]]
        for i, words in enumerate(CASES):
            mine = got[owner == i]
            assert [(s - starts[i], length, q) for s, length, q in mine.tolist()] == brute(words, least)


def test_only_documents_that_may_have_runs_are_indexed():
    numbers = [np.arange(100), np.tile(np.arange(10), 5), np.arange(7)]
    doc = np.repeat(np.arange(3), [len(x) for x in numbers])
    assert list(P.repeats(np.concatenate(numbers), doc, 8)) == [1]


def test_least_gram():
    assert P.least_gram(24) == 8 and P.least_gram(3) == 1
    for least in range(3, 60):
        g = P.least_gram(least)
        assert all(max(least - q, 2 * q) >= 2 * g - 1 for q in range(1, 2 * g))


@pytest.mark.parametrize("clash", [False, True])
def test_detect(spark, clash):
    texts = [" \n".join(words) for words in CASES]
    rows = {r.doc_id: r for r in P.detect(frame(spark, list(enumerate(texts)), clash)).collect()}
    for i, words in enumerate(CASES):
        runs = brute(words)
        assert [tuple(r) for r in rows[i].runs] == runs and rows[i].n_words == len(words)
        assert rows[i].collapsed == collapsed(words, runs)


def test_odd_rows(spark):
    rows = P.digests(P.detect(frame(spark, [*ODD, (7, "wort " * 5 + "ä\x0b\x0cö\x85x", None, None, 0)]))).collect()
    assert len(rows) == len(ODD) + 1 and sum(r.n_runs for r in rows) == 1
    by = {r.doc_id: r for r in rows}
    assert (by[4].start, by[4].length, by[4].period, by[4].exponent_milli) == (0, 60_000, 1, 60_000_000)
    assert by[4].collapsed_sha256 == hashlib.sha256(b"word end").hexdigest()
    assert by[1].start is None and by[1].runs_sha256 == by[2].collapsed_sha256 == hashlib.sha256(b"").hexdigest()
    assert by[7].collapsed_sha256 == hashlib.sha256("wort wort wort wort wort ä ö\x85x".encode()).hexdigest()
    assert P.detect(frame(spark, [])).collect() == []


def test_best_is_exact_and_digests(spark):
    words = ["a"] * 30 + ["b"] + ["c"] * 30 + [str(i % 3) for i in range(100)]
    runs = brute(words)
    row = P.digests(P.detect(frame(spark, [(1, " ".join(words))]))).first()
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]))
    assert (row.start, row.length, row.period) == best and row.n_runs == len(runs)
    text = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    assert row.runs_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_edited(spark):
    texts = [(i, " ".join(f"w{k}" for k in range(i % 61))) for i in range(300)] + [(None, "a b")]
    got = frame(spark, texts).select("doc_id", "text", P.edited(F.col("text"), F.col("doc_id")).alias("new")).collect()
    changed = 0
    for r in got:
        words = r.text.split()
        h = zlib.crc32(str(r.doc_id).encode()) if r.doc_id is not None else 1
        if h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
            changed += words != r.text.split()
        assert r.new.split() == words
    assert changed > 5


@pytest.mark.parametrize("words", [["a"] * 400_000, fibonacci(400_000), [str(i % 1000) for i in range(400_000)]])
def test_repetitive_texts_end(words):
    numbers = np.unique(words, return_inverse=True)[1].astype(np.int64)
    begun = time.time()
    runs = P.find(numbers, np.zeros(len(words), np.int64))
    assert time.time() - begun < 60 and len(runs) >= 1


def test_slices(monkeypatch):
    monkeypatch.setattr(P, "TEXT_SLICE", 5)
    text = b"ab cde f ghijklmn  op " * 9
    assert b"".join(P._slices(text)) == text and all(part.split() for part in P._slices(text) if part.strip())
    assert [w for part in P._slices(text) for w in part.split()] == text.split()
    assert P._numbers([text, b"", b" "])[1].tolist() == [45, 0, 0]
    assert P._collapsed(text, None) == b" ".join(text.split()) and LONG
