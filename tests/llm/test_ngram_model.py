from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from conftest import SF
from helpers import ODD, frame, lower, read

from tripflow.llm import common
from tripflow.llm import ngram_model as nm


class Brute:
    """The same model from counters of words."""

    def __init__(self, texts):
        lines = [self.tokens(t) for t in texts]
        self.c = Counter(w for t in lines for w in t)
        self.n, self.v = sum(self.c.values()), len(self.c)
        self.pairs = Counter((a, b) for t in lines for a, b in zip(["^"] + t, t, strict=False))
        self.context, self.ns, self.types = Counter(), defaultdict(lambda: [0, 0, 0]), Counter()
        for (a, b), n in self.pairs.items():
            self.context[a] += n
            self.ns[a][min(n, 3) - 1] += 1
            self.types[b] += 1
        self.d = nm.discounts(Counter(self.pairs.values()))
        self.d_types = nm.discounts(Counter(self.types.values()))
        self.total = sum(self.types.values())
        often = Counter(min(k, 3) for k in self.types.values())
        self.left = sum(self.d_types[i] * often[i + 1] for i in range(3)) / max(self.total, 1)

    @staticmethod
    def tokens(text):
        return re.findall(r"[^\x20\x09-\x0D]+", lower(text or "")) + [None]

    def low(self, w):
        if not self.total:
            return 1 / (self.v + 1)
        k = self.types[w]
        return max(k - (0, *self.d_types)[min(k, 3)], 0) / self.total + self.left / (self.v + 1)

    def p(self, a, b):
        if not self.context[a]:
            return self.low(b)
        left = sum(self.d[i] * self.ns[a][i] for i in range(3)) / self.context[a]
        n = self.pairs[a, b]
        return max(n - (0, *self.d)[min(n, 3)], 0) / self.context[a] + left * self.low(b)

    def row(self, text):
        t = self.tokens(text)
        return (len(t), sum(self.c[w] > 0 for w in t), self.n,
                sum(math.log10((self.c[w] + 0.5) / (self.n + 0.5 * (self.v + 1))) for w in t),
                sum(math.log10(self.p(a, b)) for a, b in zip(["^"] + t, t, strict=False)))


def check(model: Brute, rows, got):
    assert len(rows) == len(got)
    for (_, text), r in zip(rows, got, strict=True):
        n, known, train, base, score = model.row(text)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, train)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and math.isclose(r.score, score, rel_tol=1e-9)
        assert math.isclose(r.perplexity, 10 ** min(300, -score / n), rel_tol=1e-9)


def test_whole_table(spark, monkeypatch):
    monkeypatch.setattr(nm, "SHARD_BYTES", 1 << 14)
    got = nm.op7_lm_scoring(spark, SF).orderBy("doc_id").collect()
    rows = [(r.doc_id, r.text) for r in read(spark, SF).orderBy("doc_id").collect()]
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in rows}
    assert {r.doc_id: r.held_out for r in got} == held
    model = Brute([t for i, t in rows if not held[i]])
    check(model, rows, got)
    # a probability: all words and one unknown one together
    for context in ("the", "of", None, "^", "never seen"):
        assert math.isclose(sum(model.p(context, w) for w in model.c) + model.p(context, "unknown word"), 1)


def test_odd_rows(spark):
    rows = [(r[0], r[1]) for r in ODD if len(r[1] or "") < 1000]
    docs = frame(spark, [r for r in ODD if len(r[1] or "") < 1000], clash=True).coalesce(1)
    got = nm.score(docs, nm.train(docs)).collect()
    check(Brute([t for _, t in rows]), rows, got)
    long = nm.score(frame(spark, ODD), nm.train(frame(spark, ODD))).where("doc_id = 4").first()
    assert long.n_tokens == 60_002 == long.n_known


def test_words_with_equal_halves_of_their_hashes_are_kept_apart(spark):
    names = np.array([f"w{i}" for i in range(400_000)])
    hashes, _ = common.words(pa.array([" ".join(names)]))
    order = np.argsort(hashes)
    high = hashes[order] >> np.uint64(32)
    at = np.flatnonzero(high[1:] == high[:-1])
    assert len(at)
    for k in at[:2]:
        often, rare = names[order[k]], names[order[k + 1]]
        rows = [(i, f"a{i} {often} b{i} {often} c") for i in range(40)] + [(50, f"d {rare} e"), (51, f"{rare} c {often}")]
        docs = frame(spark, rows)
        check(Brute([t for _, t in rows]), rows, nm.score(docs, nm.train(docs)).orderBy("doc_id").collect())


def test_second_words():
    dice = np.random.default_rng(2)
    words = dice.integers(0, 2**63, 1000).astype(np.uint64) * np.uint64(2)
    keys, before = nm.pair_keys(words, np.array([0, 400, 1000]))
    assert (nm.second_words(keys, before) == words).all() and before[0] == before[400] == nm.BEGIN


def test_nothing_to_learn_from(spark):
    model = nm.train(frame(spark, []))
    assert nm.score(frame(spark, []), model).collect() == []
    check(Brute([]), [(1, "a b")], nm.score(frame(spark, [(1, "a b")]), model).collect())


def test_unmix():
    x = np.random.default_rng(0).integers(0, 2**63, 1000).astype(np.uint64) * np.uint64(2)
    assert (nm.unmix(common.mix(x)) == x).all()


def test_discounts_of_few_counts():
    assert nm.discounts({}) == (0.5, 1.0, 1.5)
    assert all(0 < d <= k for k, d in enumerate(nm.discounts({1: 10, 2: 5, 3: 3, 4: 2}), 1))


def test_counts_above_32_bits(tmp_path):
    before, words = np.array([3, 3, 1 << 63], np.uint64), np.array([5, 9 << 58, 7], np.uint64)
    counts = np.array([7, (1 << 32) + 5, (1 << 32) - 1])
    batch = pa.RecordBatch.from_arrays([pa.array(common.signed(before)), pa.array(common.signed(words)), pa.array(counts)],
                                       ["before", "word", "n"])
    made = [r for part in nm._write_counts(str(tmp_path), 1)(iter([batch])) for r in part.to_pylist()]
    files = {r["id"]: (r["path"], r["n"]) for r in made if r["kind"] == "pairs"}
    large = {r["id"] % (1 << 64): r["n"] for r in made if r["kind"] == "large"}
    model = nm.Model(1, files, {}, 0, 0, (0.5, 1.0, 1.5), (0.5, 1.0, 1.5), 0, {}, large)
    keys = common.mix(common.mix(before, 1) + words)
    found = model.find("pairs", keys, (0,), nm.pair_shards(before, words, 1))
    assert found[0].tolist() == counts.tolist() and len(large) == 2 == len(files)


def test_few_files_are_open(spark, monkeypatch):
    monkeypatch.setattr(nm, "SHARD_BYTES", 1 << 11)
    docs = read(spark, SF)
    model = nm.train(docs)
    assert len(model.pairs) > 100
    texts = pa.array([r.text for r in docs.limit(20).collect()])
    wanted = [x.tolist() for x in model.score(texts)]
    again = nm.Model(**{**model.__getstate__()})
    monkeypatch.setattr(nm, "OPEN_FILES", 4)
    assert [x.tolist() for x in again.score(texts)] == wanted and len(again._open) == 4
