"""Source divergence audit: which words make a source differ from its language and from its other sources.

Terms are ``[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+`` with A-Z lower-cased. A language keeps the V terms that stand in
at least ``min_docs`` of its documents. Every group, a (lang, source) pair that occurs, gives each kept term the
smoothed share p = 1 + floor(10^9 * (count + 1) / (N + V)), N its count of kept terms; the language gives q the same
way. All of it is in whole numbers, so the result does not depend on the order of anything.

* ``terms``: the ``top`` terms of a group by floor((p - q)^2 / q) where p > q. A term is beaten by every term of a
  higher count in the group, a lower one in the language and an earlier spelling, whatever N and V are. So a
  partition keeps its skyband, the terms that fewer than ``top`` others beat, the skybands are merged, and only what
  is left is given its exact value and ranked.
* ``pairs``: for each two groups of a language the sum of floor((p - q)^2 / q) over all kept terms, q the other's.
  Terms are dealt into buckets of about ``BUCKET_ROWS`` rows, sources into blocks of about ``BLOCK`` names; a task
  has the shares of two blocks over one bucket and adds them up in a matrix of ``SLICE`` terms at a time.

NULL text, lang and source count as ''. Repeated rows count as documents of their own, ids are not read. A group
without terms still has its pairs; a language without kept terms gives pairs of value 0 and no terms. An empty table
gives an empty result; further columns are not read. Sums are exact below 9 * 10^18, which holds for V up to 10^9.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripflow.llm import common

SCALE = 1_000_000_000
MIN_DOCS = 3
TOP = 200

#: entries that a task counts before it hands them on; rows of a skyband before it is cut to size
HELD = 1 << 19
BAND_ROWS = 1 << 16
BUCKET_ROWS = 1 << 18
BLOCK = 64
SLICE = 1 << 13
TEXT_SLICE = 1 << 20

_TERM = re.compile(rb"[a-z\x80-\xff]+")
_COUNTED = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()),
                      ("n", pa.int64()), ("docs", pa.int64())])
_BAND = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()),
                   ("n", pa.int64()), ("lang_n", pa.int64())])
_SUMS = "lang string, source string, item string, part long, seen long, rest long, v long"


# ---- counts ----------------------------------------------------------------------------------------


def _slices(data: bytes, begin: int, end: int) -> Iterator[tuple[int, int]]:
    """A text in parts of about ``TEXT_SLICE`` bytes that don't cut a term."""
    while begin < end:
        stop = min(end, begin + TEXT_SLICE)
        cut = _TERM.match(data, stop, end)
        stop = cut.end() if cut else stop
        yield begin, stop
        begin = stop


def _emitted(held: dict) -> Iterator[pa.RecordBatch]:
    for (lang, source), (counts, docs) in held.items():
        terms = list(counts)
        for at in range(0, len(terms), BAND_ROWS):
            part = terms[at:at + BAND_ROWS]
            yield pa.RecordBatch.from_arrays([
                pa.repeat(pa.scalar(lang, pa.string()), len(part)), pa.repeat(pa.scalar(source, pa.string()), len(part)),
                pa.array(part, pa.binary()).cast(pa.string()),
                pa.array([counts[t] for t in part], pa.int64()), pa.array([docs[t] for t in part], pa.int64()),
            ], schema=_COUNTED)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of the terms of each group, added up as far as memory allows."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    size = 0
    for batch in batches:
        for piece in common.pieces(batch, "text"):
            data, offsets = common.text_bytes(piece.column("text"))
            text, places = data.tobytes().lower(), offsets.tolist()
            groups = zip(piece.column("lang").to_pylist(), piece.column("source").to_pylist())
            for row, group in enumerate(groups):
                counts, docs = held.setdefault(group, (Counter(), Counter()))
                before, seen = len(counts), set()
                for begin, end in _slices(text, places[row], places[row + 1]):
                    found = _TERM.findall(text, begin, end)
                    counts.update(found)
                    seen.update(found)
                docs.update(seen)
                size += len(counts) - before + 1
                if size >= HELD:
                    yield from _emitted(held)
                    held, size = {}, 0
    yield from _emitted(held)


def group_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs), one row or more for each group and term."""
    common.small_batches(docs.sparkSession)
    return _named(docs, F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        _counted, "lang string, source string, term string, n long, docs long")


def _named(docs: DataFrame, *more: Column) -> DataFrame:
    return docs.select(F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"), *more)


def kept_terms(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, source, term, n, lang_n, new): counts of the kept terms; ``new`` is 1 in one row of each term.

    Tasks hand on sums, which are dealt by language and term once: the sums of a group and those of its
    language are both made there.
    """
    term = Window.partitionBy("lang", "term")
    sums = group_counts(docs).repartition("lang", "term").groupBy("lang", "term", "source").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    return sums.withColumns({
        "lang_n": F.sum("n").over(term), "lang_docs": F.sum("docs").over(term),
        "new": (F.min("source").over(term) == F.col("source")).cast("long"),
    }).where(F.col("lang_docs") >= min_docs).select("lang", "source", "term", "n", "lang_n", "new")


def group_totals(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """(lang, source, total, lang_total, v) of every group that occurs, those without terms too."""
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.sum("new").alias("new"))
    langs = sums.groupBy("lang").agg(F.sum("total").alias("lang_total"), F.sum("new").alias("v"))
    groups = _named(docs).distinct()
    return groups.join(sums.drop("new"), ["lang", "source"], "left").join(langs, "lang", "left").fillna(
        0, ["total", "lang_total", "v"])


def share(n: Column, total: Column, v: Column) -> Column:
    """1 + floor(10^9 * (n + 1) / (total + v)), exactly; the product needs more than 64 bits."""
    above = F.lit(SCALE).cast("decimal(10,0)") * (n + 1).cast("decimal(20,0)")
    return F.call_function("div", above, F.greatest(total + v, F.lit(1)).cast("decimal(20,0)")) + 1


# ---- the terms of a group ----------------------------------------------------------------------------


def skyband(n: np.ndarray, lang_n: np.ndarray, order: np.ndarray, k: int) -> np.ndarray:
    """Places of the rows that fewer than ``k`` others beat: n not lower, lang_n not higher, order smaller.

    Rows are looked at so that whatever beats a row comes before it. A row with k rows above it has k of
    them in the skyband, so each block is compared with the skyband so far and with itself.
    """
    ranked = np.lexsort((order, lang_n, -n))
    keep: list[np.ndarray] = []
    low, first = np.zeros(0, lang_n.dtype), np.zeros(0, order.dtype)
    at = 0
    while at < len(ranked):
        size = max(1, min(1024, (1 << 23) // (len(low) + 1024)))
        block = ranked[at:at + size]
        l, o = lang_n[block][:, None], order[block][:, None]
        beaten = ((low[None, :] <= l) & (first[None, :] < o)).sum(1)
        inside = (lang_n[block][None, :] <= l) & (order[block][None, :] < o)
        beaten += (inside & (n[block][None, :] >= n[block][:, None])).sum(1)
        block = block[beaten < k]
        keep.append(block)
        low, first = np.concatenate([low, lang_n[block]]), np.concatenate([first, order[block]])
        at += size
    return np.concatenate(keep) if keep else np.zeros(0, np.int64)


def _cut(table: pa.Table, k: int) -> pa.Table:
    """The skyband of the rows of one group."""
    if table.num_rows <= k:
        return table
    term = table.column("term").cast(pa.binary()).to_pylist()
    order = np.empty(len(term), np.int64)
    order[sorted(range(len(term)), key=term.__getitem__)] = np.arange(len(term))
    n, lang_n = table.column("n").to_numpy(), table.column("lang_n").to_numpy()
    return table.take(pa.array(np.sort(skyband(n, lang_n, order, k))))


def _bands(k: int):
    """Skybands of the groups in a partition; a group that grows past ``BAND_ROWS`` rows is cut meanwhile."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], list] = {}
        rows: Counter = Counter()
        for batch in batches:
            codes = pa.Table.from_arrays([batch.column(0), batch.column(1), pa.array(np.arange(batch.num_rows))],
                                         ["lang", "source", "at"]).group_by(["lang", "source"]).aggregate([("at", "list")])
            for lang, source, at in zip(codes["lang"].to_pylist(), codes["source"].to_pylist(), codes["at_list"]):
                key = (lang, source)
                held.setdefault(key, []).append(pa.Table.from_batches([batch]).take(at.values))
                rows[key] += len(at.values)
                if rows[key] >= BAND_ROWS and len(held[key]) > 1:
                    held[key] = [_cut(pa.concat_tables(held[key]).combine_chunks(), k)]
                    # a skyband that stays large is looked at again when it has doubled
                    rows[key] = held[key][0].num_rows // 2
            if sum(rows.values()) >= 16 * BAND_ROWS:
                for key in list(held):
                    yield from _cut(pa.concat_tables(held.pop(key)).combine_chunks(), k).to_batches()
                rows.clear()
        for tables in held.values():
            yield from _cut(pa.concat_tables(tables).combine_chunks(), k).to_batches()

    return run


def terms(kept: DataFrame, totals: DataFrame, top: int = TOP) -> DataFrame:
    """(lang, source, item, value, rank): the ``top`` terms of each group that it has more often than its language."""
    kind = "lang string, source string, term string, n long, lang_n long"
    band = kept.select("lang", "source", "term", "n", "lang_n").mapInArrow(_bands(top), kind)
    band = band.repartition("lang", "source").mapInArrow(_bands(top), kind)
    p, q = F.col("p"), F.col("q")
    valued = band.join(totals, ["lang", "source"]).withColumns({
        "p": share(F.col("n"), F.col("total"), F.col("v")), "q": share(F.col("lang_n"), F.col("lang_total"), F.col("v")),
    }).where(p > q).select("lang", "source", F.col("term").alias("item"),
                           F.call_function("div", (p - q) * (p - q), q).alias("value"))
    return _ranked(valued).where(F.col("rank") <= top)


def _ranked(rows: DataFrame) -> DataFrame:
    return rows.withColumn("rank", F.row_number().over(
        Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")))


# ---- pairs of groups ---------------------------------------------------------------------------------


def _sums(key: tuple, table: pa.Table) -> pa.Table:
    """Sums over the terms of a bucket for all pairs of sources of two blocks (of one, where they are the same).

    A row without a term has the share of a source in a term that it lacks.
    """
    lang, block_a, block_b, _ = (x.as_py() for x in key)
    blank = table.column("term").is_null().to_numpy(zero_copy_only=False)
    zero = table.filter(pa.array(blank))
    names, block = zero.column("source").to_pylist(), zero.column("block").to_numpy()
    lack, v = zero.column("p").to_numpy(), zero.column("v").to_numpy()
    place = {name: i for i, name in enumerate(names)}
    rows = table.filter(pa.array(~blank))
    source = np.array([place[s] for s in rows.column("source").to_pylist()], np.int64)
    codes = rows.column("term").combine_chunks().dictionary_encode() if rows.num_rows else None
    term = codes.indices.to_numpy().astype(np.int64) if codes is not None else np.zeros(0, np.int64)
    seen = len(codes.dictionary) if codes is not None else 0
    order = np.argsort(term, kind="stable")
    source, term, p = source[order], term[order], rows.column("p").to_numpy()[order]
    total = np.zeros((len(names), len(names)), np.int64)
    for begin in range(0, seen, SLICE):
        end = min(seen, begin + SLICE)
        lo, hi = np.searchsorted(term, (begin, end))
        shares = np.repeat(lack[:, None], end - begin, axis=1)
        shares[source[lo:hi], term[lo:hi] - begin] = p[lo:hi]
        for i in range(len(names)):
            off = shares[i] - shares
            total[i] += (off * off // shares).sum(1)
    wanted = block[:, None] != block[None, :] if block_a != block_b else ~np.eye(len(names), dtype=bool)
    i, j = np.nonzero(wanted)
    off = lack[i] - lack[j]
    names = np.array(names, dtype=object)
    return pa.table({
        "lang": pa.repeat(pa.scalar(lang, pa.string()), len(i)), "source": pa.array(names[i], pa.string()),
        "item": pa.array(names[j], pa.string()), "part": total[i, j], "seen": np.full(len(i), seen, np.int64),
        "rest": off * off // lack[j], "v": v[i],
    })


def pairs(kept: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, source, item, value, rank): the divergence of each group from every other group of its language."""
    sizes = totals.groupBy("lang").agg(F.count("*").alias("sources"), F.max("v").alias("v")).agg(F.max("sources")).first()
    blocks = -(-(sizes[0] or 1) // BLOCK)
    buckets = max(1, -(-kept.count() // BUCKET_ROWS))
    block = F.pmod(F.xxhash64("source"), F.lit(blocks)).cast("int")
    shares = kept.join(totals, ["lang", "source"]).select(
        "lang", "source", "term", share(F.col("n"), F.col("total"), F.col("v")).alias("p"), "v",
        F.pmod(F.xxhash64("term"), F.lit(buckets)).alias("bucket"))
    lacking = totals.select(
        "lang", "source", F.lit(None).cast("string").alias("term"), share(F.lit(0), F.col("total"), F.col("v")).alias("p"),
        "v", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(buckets - 1).cast("long"))).alias("bucket"))
    dealt = shares.unionByName(lacking).withColumns({
        "block": block, "other": F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))})
    keyed = dealt.withColumns({"a": F.least("block", "other"), "b": F.greatest("block", "other")}).drop("other")
    sums = keyed.groupBy("lang", "a", "b", "bucket").applyInArrow(_sums, _SUMS)
    # terms that none of the two blocks has are in no bucket of theirs
    value = F.sum("part") + (F.max("v") - F.sum("seen")) * F.max("rest")
    return _ranked(sums.groupBy("lang", "source", "item").agg(value.alias("value")))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank): ``pairs`` and ``terms`` of all groups of the documents."""
    kept = common.stored(kept_terms(docs, min_docs), "audit-terms")
    totals = common.stored(group_totals(docs, kept), "audit-groups")
    parts = [rows.withColumn("part", F.lit(name)) for name, rows in
             (("pair", pairs(kept, totals)), ("term", terms(kept, totals, top)))]
    return parts[0].unionByName(parts[1]).select(
        "lang", "source", "part", "item", "value", F.col("rank").cast("int").alias("rank"))


def op13_divergence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(common.table(spark, sf_dir, "documents"))


SQL = {"op13_divergence_audit": r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
c AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT r) AS docs FROM w GROUP BY lang, source, term),
k AS (SELECT lang, term, sum(n) AS n FROM c GROUP BY lang, term HAVING sum(docs) >= 3),
v AS (SELECT lang, count(*) AS v, sum(n) AS total FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
gc AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.n AS lang_n FROM g JOIN k ON g.lang = k.lang
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
s AS (SELECT lang, source, sum(n) AS total FROM gc GROUP BY lang, source),
p AS (SELECT gc.lang, gc.source, gc.term, gc.n,
    1 + (1000000000::HUGEINT * (gc.n + 1)) // (s.total + v.v)::HUGEINT AS p,
    1 + (1000000000::HUGEINT * (gc.lang_n + 1)) // (v.total + v.v)::HUGEINT AS q
  FROM gc JOIN s ON s.lang = gc.lang AND s.source = gc.source JOIN v ON v.lang = gc.lang),
f AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
x AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM p WHERE n > 0 AND p > q),
y AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM x)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM y WHERE part = 'pair' OR rank <= 200
"""}
