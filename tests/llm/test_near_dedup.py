from __future__ import annotations

import math
import random

import numpy as np
import pytest
from conftest import SF
from helpers import ODD, frame, lower, read

from tripflow.llm import near_dedup
from tripflow.llm.near_dedup import bands, components, linked, near_duplicates, sketches


def brute(rows, width, percent):
    """component_id by comparing all pairs."""
    sets = {}
    for i, text in rows:
        w = [x for x in __import__("re").findall(r"[^\x20\x09-\x0D]+", lower(text or ""))]
        sets[i] = {tuple(w[k:k + width]) for k in range(len(w) - width + 1)} or ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * len(sets[a] | sets[b]):
                    x, y = sorted((find(a), find(b)))
                    root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("width, threshold", [(3, 0.85), (5, 0.8)])
def test_against_all_pairs(spark, width, threshold):
    docs = read(spark, SF)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(docs, width, threshold).collect()}
    assert got == brute([(r.doc_id, r.text) for r in docs.collect()], width, round(100 * threshold))


def test_large_group(spark, monkeypatch):
    """A group larger than buckets and blocks, with copies on both sides of the threshold."""
    monkeypatch.setattr(near_dedup, "SMALL", 4)
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    dice = random.Random(3)
    base = [f"w{dice.randrange(10**6)}" for _ in range(120)]
    rows = []
    for i in range(90):
        words = base[:]
        for _ in range(dice.randrange(9)):
            words[dice.randrange(len(words))] = f"x{dice.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, rows[i][1]) for i in range(30)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(frame(spark, rows), 3, 0.85).collect()}
    expected = brute(rows, 3, 85)
    assert got == expected and 1 < len({c for _, c in expected.values()}) < 90


def test_sketches_estimate_similarity_and_fill_every_bin():
    dice, t = np.random.default_rng(0), bands(0.85) * near_dedup.ROWS
    for size, changed in ((400, 40), (20, 2), (1, 0)):
        agree = []
        for _ in range(40):
            a = dice.integers(0, 2**63, size).astype(np.uint64)
            b = a.copy()
            b[:changed] = dice.integers(0, 2**63, changed)
            x = sketches([np.unique(a), np.unique(b)], t)
            assert (x < np.iinfo(np.uint64).max).all()
            agree.append((x[0] == x[1]).mean())
        true = (size - changed) / (size + changed)
        assert abs(np.mean(agree) - true) < 4 * math.sqrt(max(true * (1 - true), 1e-9) / t / 40) + 1e-9


def test_bands_reach_the_wanted_miss():
    for threshold in (0.8, 0.85):
        assert (1 - threshold ** near_dedup.ROWS) ** bands(threshold) <= near_dedup.MISS


def test_linked_counts_exactly(monkeypatch):
    monkeypatch.setattr(near_dedup, "COLUMNS", 3)
    left = [np.array([1, 2, 3, 4], np.uint64), np.array([9], np.uint64)]
    right = [np.array([1, 2, 3], np.uint64), np.array([9], np.uint64), np.array([7, 8], np.uint64)]
    assert linked(left, right, 75).tolist() == [[True, False, False], [False, True, False]]


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 30)] + [(40, 41), (50, 41), (7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 31)}, 40: 40, 41: 40, 50: 40}


def test_odd_rows(spark):
    got = near_duplicates(frame(spark, ODD, clash=True), 3, 0.85).collect()
    assert len(got) == len(ODD)
    by = {r.doc_id: r for r in got}
    assert all(by[i].n_shingles == 0 and by[i].component_id == i and by[i].kept for i in (1, 2, 3))
    assert by[6].component_id == 5 and not by[6].kept and by[5].kept
    assert by[None].component_id is None and by[None].kept
    few = near_duplicates(frame(spark, [(1, "One two"), (2, "one  TWO"), (3, "one")]), 3, 0.85).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in few} == {1: (1, 1), 2: (1, 1), 3: (1, 3)}


def test_keep_one(spark):
    kept = near_dedup.keep_one(frame(spark, ODD, clash=True))
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 5] and len(kept.columns) == 17


def test_empty(spark):
    assert near_duplicates(frame(spark, [])).collect() == []
    assert near_duplicates(frame(spark, [(1, None), (2, "")])).count() == 2
