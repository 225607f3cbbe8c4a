"""The pipeline against the same five steps done by hand."""

from __future__ import annotations

import corpus_pipeline
import pytest
from conftest import SF
from helpers import ODD, frame, read
from test_decontamination import plain
from test_mixing import check
from test_near_dedup import brute

from tripflow.llm import language_id
from tripflow.llm.common import stored

STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def after(spark):
    """What each stage keeps of the smallest table."""
    docs, out = read(spark, SF), {}
    out["documents"] = docs
    for name, stage in corpus_pipeline.STAGES:
        out[name] = docs = stored(stage(spark, docs, SF), name)
    return out


def rows(df):
    return sorted((tuple(r) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()), key=repr)


def test_each_stage(spark, after):
    before = rows(after["documents"])
    kept = rows(after["language_id"])
    assert kept == [r for r in before if any(c.isalpha() for c in r[1] or "")]
    last = {}
    for r in kept:
        last[r[1]] = max(last.get(r[1], r), r, key=lambda x: x[0])
    kept = rows(after["exact_dedup"])
    assert kept == sorted(last.values(), key=repr)
    parts = brute([r[:2] for r in kept], 5, 80)
    before, kept = kept, rows(after["near_dedup"])
    assert kept == [r for r in before if parts[r[0]][1] == r[0]] and len(kept) < len(before)
    items = [plain(r.text).strip() for r in read(spark, SF, "benchmark").collect()]
    before, kept = kept, rows(after["decontamination"])
    assert set(kept) <= {r for r in before if not any(i in plain(r[1]) for i in items)} and len(before) > len(kept) > len(before) - 30
    mixed = after["mixing"].collect()
    assert {r.doc_id for r in mixed} <= {r[0] for r in kept} and all(r.taken > 0 for r in mixed)


def test_language_stage_decides(spark):
    """Texts under another language's label go, their like without a label stay; a letter test in place of the model
    would keep them all. Rows of the sample itself are taken at their word."""
    docs = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in read(spark, SF.replace("0.001", "0.01")).collect()]
    long = [r for r in docs if r[1] and r[2] not in (None, "en") and sum(map(str.isalpha, r[1])) >= 300][:80]
    # a share of 4 in 100 of the rows said to be English
    changed = [(100_000 + i, f"{r[1]} {i}", "en" if i % 3 == 0 else None, r[3], r[4]) for i, r in enumerate(long)]
    table = frame(spark, docs + changed)
    learnt = {(lang, text) for lang, text in language_id.sample(table)}
    wrong = {r[0] for r in changed if r[2] and not any(r[1].startswith(t) and r[2] == lang for lang, t in learnt)}
    kept = {r.doc_id for r in STAGES["language_id"](spark, table, SF).select("doc_id").collect()}
    assert len(wrong) >= 15 and len(kept & wrong) <= 0.1 * len(wrong)
    assert {r[0] for r in changed if not r[2]} <= kept
    letters = {r[0] for r in docs if any(c.isalpha() for c in r[1] or "")}
    assert len(letters - kept) <= 0.002 * len(letters)


def test_run_is_all_stages(spark, after):
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, after["mixing"].collect()))


def test_mix_meets_its_targets(spark, after):
    from tripflow.llm.mixing import mix
    check(after["decontamination"].collect(), mix(after["decontamination"]).collect())


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_odd_and_empty_rows(spark, name):
    docs = frame(spark, ODD, clash=True)
    got = STAGES[name](spark, docs, SF)
    assert name == "mixing" or got.columns == docs.columns
    assert 0 < got.count() <= len(ODD)
    assert STAGES[name](spark, frame(spark, []), SF).count() == 0
