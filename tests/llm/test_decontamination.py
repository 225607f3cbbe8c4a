from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF
from helpers import LONG, ODD, frame, read

from tripflow.llm import common
from tripflow.llm import decontamination as dc

PASSAGE = "The quick brown fox jumps over the lazy dog, then rests under the old oak tree until noon."


def distance(item: bytes, text: bytes) -> int:
    """Fewest edits between the passage and any part of the text, by the whole table."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def plain(text: str) -> bytes:
    raw = np.frombuffer(text.encode(), np.uint8)
    return dc.plain(raw, np.array([0, len(raw)]))[0].tobytes()


def test_edited_passages_against_the_whole_table():
    dice = random.Random(5)
    words = [w for w in PASSAGE.lower().split()]
    known = dc.index([(1, PASSAGE)])
    budget = int(known.edits[0])
    for _ in range(60):
        item = list(PASSAGE)
        for _ in range(dice.randrange(9)):
            at = dice.randrange(len(item))
            item[at:at + dice.randrange(2)] = dice.choice(["", "x", "yz"])
        around = [" ".join(dice.choices(words, k=12)) for _ in range(2)]
        text = f"{around[0]} {''.join(item)} {around[1]}"
        found = dc.search(known, *common.text_bytes(pa.array(["", text, None])))
        edits = distance(plain(PASSAGE).strip(), plain(text))
        assert [(r, p, used) for r, p, used, _, _ in found] == ([(1, 0, edits)] if edits <= budget else [])


def test_spans_are_code_points(spark):
    text = f"Élan vital – 1\n{PASSAGE.upper()}\nñandú"
    bench = spark.createDataFrame([(7, PASSAGE), (8, None), (9, ""), (10, "short")], "item_id long, text string")
    row, = dc.leaks(frame(spark, [(3, text)]), bench).collect()
    assert (row.doc_id, row.item_id, row.edits) == (3, 7, 0)
    assert text[row.begin:row.end].strip(".") == PASSAGE.upper().strip(".")


@pytest.mark.parametrize("block", [1 << 22, 3000])
def test_all_planted_passages(spark, monkeypatch, block):
    """Every text that holds a passage unchanged is found, whatever the blocks of the benchmark."""
    monkeypatch.setattr(dc, "BLOCK_CHARS", block)
    docs, bench = read(spark, SF), read(spark, SF, "benchmark")
    got = {(r.doc_id, r.item_id) for r in dc.leaks(docs, bench).collect()}
    items = bench.collect()
    holds = {(d.doc_id, b.item_id) for d in docs.collect() for b in items
             if plain(b.text).strip() in plain(d.text)}
    assert holds and holds == {x for x in got if x in holds} and len(got) <= len(holds) + 2
    kept = {r.doc_id for r in dc.clean(docs, bench).collect()}
    assert kept == {r.doc_id for r in docs.collect()} - {d for d, _ in got}


def test_odd_rows(spark):
    bench = spark.createDataFrame([(1, PASSAGE), (1, PASSAGE), (None, PASSAGE[:60])], "item_id long, text string")
    rows = [*ODD, (None, f"{LONG} {PASSAGE}", "en", "a", 1), (5, PASSAGE, None, None, None)]
    docs = frame(spark, rows, clash=True)
    got = dc.leaks(docs, bench).collect()
    assert sorted(((r.doc_id, r.item_id) for r in got), key=str) == sorted(
        [(d, i) for d in (None, 5) for i in (1, 1, None)], key=str)
    kept = dc.clean(docs, bench)
    assert kept.columns == docs.columns and kept.count() == len(ODD)


def test_empty(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, PASSAGE)], "item_id long, text string")
    assert dc.leaks(frame(spark, ODD), none).collect() == [] and dc.clean(frame(spark, ODD), none).count() == len(ODD)
    assert dc.leaks(frame(spark, []), some).collect() == [] and dc.clean(frame(spark, []), some).count() == 0


def found(known, *texts):
    return dc.search(known, *common.text_bytes(pa.array(list(texts))))


def test_repetitive_texts_end():
    import time
    import tracemalloc
    known = dc.index([(1, "a" * 300), (2, "ab " * 333), (3, "a" * 1000)])
    begun = time.time()
    tracemalloc.start()
    got = found(known, "a" * 1_000_000, "b" * 1_000_000, "ab " * 100_000, "a" * 299, "a" * 200)
    assert tracemalloc.get_traced_memory()[1] < 500 << 20
    tracemalloc.stop()
    assert [(r, p, used) for r, p, used, _, _ in got] == [(0, 0, 0), (0, 2, 0), (2, 1, 0), (3, 0, 1)]
    assert time.time() - begun < 60


def test_periodic_passages_against_the_whole_table():
    """Passages and texts of few letters, where q-grams repeat: the whole table finds the same."""
    dice = random.Random(8)
    for trial in range(80):
        unit = "".join(dice.choices("ab ", k=dice.randrange(1, 6)))
        item = (unit * 60)[:dice.randrange(12, 70)].strip()
        text = list((unit * 80)[dice.randrange(5):dice.randrange(20, 120)])
        for _ in range(dice.randrange(6)):
            if text:
                text[dice.randrange(len(text))] = dice.choice(["a", "b", "", "c"])
        text = "".join(text)
        known = dc.index([(1, item)])
        if not known.ids or len(known.texts[0]) < dc.Q:
            continue
        fewest = distance(plain(item).strip(), plain(text))
        want = [(0, 0, fewest)] if fewest <= known.edits[0] else []
        assert [x[:3] for x in found(known, text)] == want, (item, text)


def test_many_passages_against_the_whole_table():
    """All passages in all texts: none is lost among others, none is found where it isn't."""
    dice = random.Random(9)
    vocabulary = ["".join(dice.choices("abcdefgh", k=dice.randrange(2, 8))) for _ in range(60)]
    items = [" ".join(dice.choices(vocabulary, k=dice.randrange(3, 9))) for _ in range(25)]
    texts = []
    for _ in range(12):
        middle = list(dice.choice(items))
        for _ in range(dice.randrange(4)):
            middle[dice.randrange(len(middle))] = dice.choice(["", "z", "qq"])
        texts.append(" ".join(dice.choices(vocabulary, k=15)) + " " + "".join(middle) + " " + " ".join(dice.choices(vocabulary, k=15)))
    known = dc.index(list(enumerate(items)))
    got = {(r, known.ids[p]): used for r, p, used, _, _ in found(known, *texts)}
    edits = dict(zip(known.ids, known.edits.tolist(), strict=True))
    want = {}
    for r, text in enumerate(texts):
        for i, item in enumerate(items):
            fewest = distance(plain(item).strip(), plain(text))
            if len(plain(item).strip()) >= dc.Q and fewest <= edits[i]:
                want[r, i] = fewest
    assert got == want and len(want) >= 8


def test_one_replaced_word():
    """At least 0.9 of the passages of 12 words or more are found when one of their words is another."""
    dice = random.Random(3)
    vocabulary = "treaty accord border river nation office letter paper signed during winter evening the of and to in was by".split()
    hit = 0
    for _ in range(300):
        item = [dice.choice(vocabulary) for _ in range(dice.randrange(12, 25))]
        changed = list(item)
        at = dice.randrange(len(item))
        changed[at] = dice.choice([w for w in vocabulary if w != item[at]])
        around = " ".join(dice.choices(vocabulary, k=30))
        hit += bool(found(dc.index([(1, " ".join(item))]), f"{around} {' '.join(changed)} {around}"))
    assert hit >= 270


def test_short_passages_between_borders():
    known = dc.index([(1, "red panda"), (2, "Red  panda!"), (3, "panda"), (4, "a b")])
    got = found(known, "the red panda ate", "the red pandas ate", "bored panda", "Red-Panda", "x a b", "xa b", None, "")
    assert [(r, known.ids[p], used) for r, p, used, _, _ in got] == [(0, 1, 0), (0, 2, 0), (3, 1, 0), (3, 2, 0), (4, 4, 0)]
    assert [(a, b) for r, _, _, a, b in got if r == 0] == [(4, 13)] * 2
