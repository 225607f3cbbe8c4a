"""Divergences, terms and skybands against plain counting."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import ODD, frame, lower

from tripflow.llm import divergence_audit as D


def expected(rows, min_docs=3, top=200):
    docs = [(lang or "", source or "", re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", lower(text or "")))
            for _, text, lang, source, *_ in rows]
    out = set()
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        spread = Counter(t for d in mine for t in set(d[2]))
        kept = {t for t, n in spread.items() if n >= min_docs}
        groups = defaultdict(Counter)
        for _, source, found in mine:
            groups[source].update(t for t in found if t in kept)
        whole = sum(groups.values(), Counter())

        def shares(counts):
            total = sum(counts.values()) + len(kept)
            return {t: 1 + 10 ** 9 * (counts[t] + 1) // total for t in kept}

        q, p = shares(whole), {source: shares(counts) for source, counts in groups.items()}
        for source, counts in groups.items():
            pairs = [(sum((p[source][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in groups if o != source]
            mined = [((p[source][t] - q[t]) ** 2 // q[t], t) for t in kept if counts[t] and p[source][t] > q[t]]
            for part, found in (("pair", pairs), ("term", mined)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                for rank, (value, item) in enumerate(found, 1):
                    if part == "pair" or rank <= top:
                        out.add((lang, source, part, item, value, rank))
    return out


def texts(n, seed=1):
    chance = random.Random(seed)
    words = ["Ähre", "der", "THE", "the", "x9y", "ß", "κόσμε", "日本", *(f"{a}{b}" for a in "abcdefgh" for b in "mnopq")]
    return [(i, " ".join(chance.choices(words, [1 + (hash_(w, i % 5) % 9) for w in words], k=chance.randrange(0, 60))),
             "en" if i % 3 else None, None if i % 5 == 4 else f"s{i % 5}", 0) for i in range(n)]


def hash_(word, k):
    return sum(word.encode()) * (k + 3)


@pytest.mark.parametrize("block,bucket", [(64, 1 << 18), (2, 20)])
def test_brute_force(spark, monkeypatch, block, bucket):
    monkeypatch.setattr(D, "BLOCK", block)
    monkeypatch.setattr(D, "BUCKET_ROWS", bucket)
    rows = texts(90)
    found = [tuple(r) for r in D.audit(frame(spark, rows, clash=True), top=7).collect()]
    assert len(found) == len(set(found)) and set(found) == expected(rows, top=7)


def test_odd_rows(spark):
    rows = [*ODD, (9, "!!! 123", "xx", "lonely", 0), (10, "the SAME text", "en", "b", 0)]
    found = [tuple(r) for r in D.audit(frame(spark, rows)).collect()]
    assert len(found) == len(set(found)) and set(found) == expected(rows)


def test_empty(spark):
    assert D.audit(frame(spark, [])).collect() == []


def test_language_without_terms_has_pairs_of_no_value(spark):
    rows = [(1, "a", "en", "x", 0), (2, "b", "en", "y", 0)]
    assert {tuple(r) for r in D.audit(frame(spark, rows)).collect()} == {
        ("en", "x", "pair", "y", 0, 1), ("en", "y", "pair", "x", 0, 1)}


def test_skyband():
    chance = np.random.default_rng(3)
    for size, k in ((0, 3), (1, 1), (400, 1), (400, 7), (3000, 20)):
        n, low, order = chance.integers(1, 30, size), chance.integers(1, 40, size), chance.permutation(size)
        beaten = ((n[None, :] >= n[:, None]) & (low[None, :] <= low[:, None]) & (order[None, :] < order[:, None])).sum(1)
        assert sorted(D.skyband(n, low, order, k)) == list(np.flatnonzero(beaten < k))


def test_counts_in_parts(spark, monkeypatch):
    """Texts longer than a slice, and sums handed on early, count the same."""
    data = b"one two " * 50 + b"three"
    monkeypatch.setattr(D, "TEXT_SLICE", 7)
    assert [data[a:b] for a, b in D._slices(data, 0, len(data))][0] == b"one two"
    assert b"".join(data[a:b] for a, b in D._slices(data, 0, len(data))) == data
    found = Counter(t for a, b in D._slices(data, 0, len(data)) for t in D._TERM.findall(data, a, b))
    assert found == Counter(data.split())


def test_share_is_exact(spark):
    from pyspark.sql import functions as F

    n, total, v = 9_300_000_000_001, 31_000_000_000_007, 12_345
    got = spark.range(1).select(D.share(F.lit(n), F.lit(total), F.lit(v))).first()[0]
    assert got == 1 + 10 ** 9 * (n + 1) // (total + v)
