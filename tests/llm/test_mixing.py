from __future__ import annotations

import math

import pytest
from conftest import SF
from helpers import ODD, frame, read

from tripflow.llm import mixing


def brute_targets(sizes: dict) -> dict:
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(order)}
    capped, total = {}, 1.5 * sum(sizes.values())
    while True:
        rest = [s for s in order if s not in capped]
        left = total - sum(capped.values())
        given = {s: left * weight[s] / sum(weight[r] for r in rest) for s in rest}
        above = [s for s in rest if given[s] > 2 * sizes[s]]
        if not above:
            return {**capped, **given}
        capped |= {s: 2.0 * sizes[s] for s in above}


def words(text):
    import re
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def check(docs, got):
    sizes = {}
    for r in docs:
        sizes[r.source] = sizes.get(r.source, 0) + words(r.text)
    targets = brute_targets(sizes)
    source = {}
    for r in got:
        assert r.source_size == sizes[r.source] and math.isclose(r.target, targets[r.source], rel_tol=1e-9, abs_tol=1e-9)
        assert 0 <= r.taken <= 2 * r.size
        source[r.source] = source.get(r.source, 0) + r.taken
    for s, taken in source.items():
        assert abs(taken - targets[s]) <= 5 * mixing.BLOCK_WORDS + 0.01 * targets[s]


@pytest.mark.parametrize("bucket, bits", [(2000, 15), (3, 2)])
def test_targets_are_met(spark, monkeypatch, bucket, bits):
    """However the windows are cut: the same words of every document."""
    monkeypatch.setattr(mixing, "BUCKET_ROWS", bucket)
    monkeypatch.setattr(mixing, "CHUNK_BITS", bits)
    docs = read(spark, SF)
    got = mixing.mix(docs).collect()
    check(docs.collect(), got)
    assert sorted(map(tuple, got)) == sorted(map(tuple, mixing.mix(docs.repartition(3)).collect()))


def test_hot_and_tiny_sources(spark):
    rows = [(i, "w " * (i % 50), "en", "hot", 0) for i in range(2000)] + [(9000, "one two", "en", "tiny", 0),
                                                                        (9001, None, "en", "none", 0), (9002, "z " * 500, "en", None, 0)]
    docs = frame(spark, rows)
    check(docs.collect(), mixing.mix(docs).collect())


def test_schedule_is_even(spark):
    """Every run of slots has nearly its share of every source."""
    sources = spark.createDataFrame([(0, 600.0), (1, 300.0), (2, 100.0)], "nth int, target double")
    rows = mixing.schedule(spark, sources, 1).orderBy("slot").collect()
    assert len(rows) == 1000
    for nth, share in ((0, 0.6), (1, 0.3), (2, 0.1)):
        mine = [r for r in rows if r.nth == nth]
        assert [r["rank"] for r in mine] == list(range(len(mine)))
        seen = 0
        for i, r in enumerate(rows, 1):
            seen += r.nth == nth
            assert abs(seen - share * i) < 4


def test_odd_rows(spark):
    docs = frame(spark, ODD, clash=True)
    got = mixing.mix(docs).collect()
    assert len(got) == len(ODD) and {r.size for r in got if r.doc_id in (1, 2, 3)} == {0}
    check(docs.collect(), got)
    assert mixing.mix(frame(spark, [])).collect() == []
    assert [r.taken for r in mixing.mix(frame(spark, [(1, None), (2, "")])).collect()] == [0, 0]


def test_no_python(spark):
    plan = mixing.mix(read(spark, SF))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def near(docs, got, cap=2.0):
    """Every source within one pass of a document or 5 % of its target, none at zero."""
    longest, taken, target, size = {}, {}, {}, {}
    for r in got:
        longest[r.source] = max(longest.get(r.source, 0), r.size)
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source], size[r.source] = r.target, r.source_size
        assert r.taken <= math.ceil(cap) * r.size
    for s, words_taken in taken.items():
        if size[s]:
            assert words_taken > 0 and abs(words_taken - target[s]) <= max(0.05 * target[s], min(longest[s], 0.05 * target[s] + 1))
            assert words_taken <= cap * size[s] + 1


def test_many_small_sources(spark):
    even = [(i, "w " * 20, "en", f"s{i:03d}", 0) for i in range(300)]
    got = mixing.mix(frame(spark, even)).collect()
    near(even, got)
    assert abs(sum(r.taken for r in got) - 9000) <= 300
    rising = [(i, "w " * n, "en", f"s{n:02d}", 0) for n in range(1, 41) for i in range(n * 100, n * 100 + 1 + n % 3)]
    near(rising, mixing.mix(frame(spark, rising)).collect())
    mixed = [*rising, *[(10_000 + i, "w " * 300, "en", "hot", 0) for i in range(500)]]
    near(mixed, mixing.mix(frame(spark, mixed)).collect())


def test_a_cap_with_a_fraction(spark):
    docs = [(i, "w " * 50, "en", "ab"[i % 2], 0) for i in range(40)] + [(99, "w " * 10, "en", "c", 0)]
    got = mixing.mix(frame(spark, docs), weights=(1, 1, 50), cap=1.5).collect()
    near(docs, got, 1.5)
    assert sum(r.taken for r in got if r.source == "c") == 15


@pytest.mark.parametrize("n", [1, 2, 3, 7, 97, 1000, 30030, (1 << 31) + 11, (1 << 40) - 7, (1 << 41) + 5])
def test_every_slot_has_its_place(spark, n):
    a = mixing.stride(n)
    inverse = pow(a, -1, n) if n > 1 else 0
    places = sorted({0, 1 % n, n // 3, n // 2, n - 1})
    df = spark.createDataFrame([(p,) for p in places], "p long").select(mixing.times_modulo(mixing.F.col("p"), inverse, n).alias("s"))
    assert [r.s * a % n for r in df.collect()] == places


def test_slots_are_exact(spark):
    sources = spark.createDataFrame([(i, 1 + i * 37 % 11) for i in range(500)] + [(500, 4000)], "nth int, slots long")
    rows = mixing.schedule(spark, sources).collect()
    counts = {}
    for r in rows:
        counts[r.nth] = counts.get(r.nth, 0) + 1
    assert counts == {r.nth: r.slots for r in sources.collect()} and sorted(r.slot for r in rows) == list(range(len(rows)))
