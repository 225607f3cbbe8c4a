"""Benchmark decontamination by the q-gram lemma.

A passage of m characters that occurs with at most k edits shares at least m + 1 - q - k * q of its
q-grams with the text, at as many places of it, all on k + 1 neighbouring diagonals (place in the text minus place in the
passage). So the text's places whose q-gram the passage has are counted in bands of 2 * (k + 1) diagonals, every k + 1 diagonals
another: any k + 1 neighbours lie in one band. A q-gram that a passage repeats at short distances counts once for each band it
reaches, by the two ends of its stretch of diagonals, so repetitive passages and texts cost no more than others. Neighbouring bands
that reach the bound are one region, verified by an alignment restricted to its diagonals.

Texts and passages are compared lower-cased in A-Z and the capitals U+00C0 to U+00DE, with every run of other ASCII characters than letters
and digits as one space; characters beyond ASCII count by their bytes. k is ``BUDGET`` of the passage's length, or
less where the bound would be under one. A passage shorter than q characters is looked for as it is, between borders of words; one
of a single word names a thing and is no passage, it is never looked for.

The benchmark is the query set. It is taken in blocks of bounded size; each block's q-grams are broadcast
and all rows are scanned for them.

Results for special rows: a NULL or empty text, or a NULL or empty passage, has no finding; a NULL id is an id; repeated rows
are rows of their own, repeated passages too; an empty table on either side gives no findings. ``clean`` passes all
columns through as they are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm import common

Q = 10
BUDGET = 0.08
#: characters of passages in one broadcast block, about
BLOCK_CHARS = 1 << 22
FILTER_BITS = 22
#: diagonals of a region that are aligned at once
REGION = 1 << 15

_PLAIN = np.full(256, 0x20, np.uint8)
_PLAIN[0x30:0x3A] = np.arange(0x30, 0x3A)
_PLAIN[0x41:0x5B] = np.arange(0x61, 0x7B)
_PLAIN[0x61:0x7B] = np.arange(0x61, 0x7B)
_PLAIN[0x80:] = np.arange(0x80, 0x100)


def plain(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Normalised bytes of all texts, the place of each in the original, and the new offsets."""
    mapped = _PLAIN[data]
    if len(data) > 1:
        second = mapped[1:]
        second[(data[:-1] == 0xC3) & (data[1:] <= 0x9E) & (data[1:] != 0x97)] += 0x20
    keep = mapped != 0x20
    if len(keep):
        keep[1:] |= mapped[:-1] != 0x20
    kept = np.flatnonzero(keep)
    return mapped[kept], kept, np.searchsorted(kept, offsets)


@dataclass
class Passages:
    """A block of passages with an index of their q-grams."""

    ids: list
    texts: list[np.ndarray]
    edits: np.ndarray
    bound: np.ndarray
    hashes: np.ndarray  # sorted, with repeats
    item: np.ndarray
    first: np.ndarray  # a stretch of places of the q-gram in the passage, neighbours at most k + 1 apart
    last: np.ndarray
    filter: np.ndarray
    short: dict[int, tuple[np.ndarray, np.ndarray]]  # length -> sorted hashes of passages, and which


def gram_hashes(data: np.ndarray) -> np.ndarray:
    begins = np.arange(max(0, len(data) - Q + 1))
    return common.span_hashes(data, begins, begins + Q)


def index(rows: list[tuple]) -> Passages:
    """Index of (item_id, text) rows."""
    ids, texts = [], []
    for item_id, text in rows:
        raw = np.frombuffer((text or "").encode(), np.uint8)
        data = plain(raw, np.array([0, len(raw)]))[0]
        data = np.frombuffer(data.tobytes().strip(), np.uint8)
        if len(data) >= Q or 0x20 in data:
            ids.append(item_id)
            texts.append(data)
    lengths = np.array([len(t) for t in texts], np.int64)
    edits = np.maximum(0, np.minimum((lengths * BUDGET).astype(np.int64), (lengths - Q) // Q))
    hashes, item, first, last = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    short: dict[int, list[tuple[int, int]]] = {}
    for i, data in enumerate(texts):
        if len(data) < Q:
            h = common.span_hashes(data, np.array([0]), np.array([len(data)]))[0]
            short.setdefault(len(data), []).append((int(h), i))
            continue
        grams = gram_hashes(data)
        place = np.argsort(grams, kind="stable")
        grams = grams[place]
        new = np.ones(len(grams), bool)
        new[1:] = (grams[1:] != grams[:-1]) | (place[1:] - place[:-1] > edits[i] + 1)
        begins = np.flatnonzero(new)
        hashes.append(grams[begins])
        item.append(np.full(len(begins), i))
        first.append(place[begins])
        last.append(place[np.append(begins[1:], len(grams)) - 1])
    all_hashes = np.concatenate(hashes)
    order = np.argsort(all_hashes, kind="stable")
    seen = np.zeros(1 << FILTER_BITS, bool)
    seen[all_hashes >> np.uint64(64 - FILTER_BITS)] = True
    by_length = {n: (np.array([h for h, _ in sorted(some)], np.uint64), np.array([i for _, i in sorted(some)]))
                 for n, some in short.items()}
    return Passages(ids, texts, edits, lengths + 1 - Q - edits * Q, all_hashes[order], np.concatenate(item)[order],
                    np.concatenate(first)[order], np.concatenate(last)[order], seen, by_length)


def align(passage: np.ndarray, text: np.ndarray, first: int, last: int, edits: int):
    """Best occurrence of a passage whose diagonals lie from first to last: (edits, begin, end) or None.

    Row i holds, for every diagonal x, the fewest edits of the passage's first i characters ending at text place
    i + first + x, with the diagonal the occurrence began on; an occurrence may begin on any.
    """
    width, m = last - first + 1, len(passage)
    padded = np.full(m + width, 999, np.int64)
    a, b = max(0, first), min(len(text), first + m + width)
    if a < b:
        padded[a - first:b - first] = text[a:b]
    big = np.int64(1 << 32)
    x = np.arange(width, dtype=np.int64)
    costs = x.copy()  # no edits, began on x
    beyond = np.array([np.iinfo(np.int64).max // 4])
    for i in range(m):
        step = costs + big * (padded[i:i + width] != passage[i])
        left_out = np.concatenate([costs[1:], beyond]) + big
        costs = np.minimum(step, left_out)
        costs = np.minimum.accumulate(costs - big * x) + big * x  # characters of the text too many
    best = int(costs.argmin())
    used, began = divmod(int(costs[best]), int(big))
    if used > edits:
        return None
    return used, max(0, first + began), min(len(text), first + best + m)


def regions(passages: Passages, text: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """(row, passage, first, last diagonal) of neighbouring bands that reach the passage's bound, in this order."""
    hashes = gram_hashes(text)
    hits = np.flatnonzero(passages.filter[hashes >> np.uint64(64 - FILTER_BITS)])
    low = np.searchsorted(passages.hashes, hashes[hits], side="left")
    many = np.searchsorted(passages.hashes, hashes[hits], side="right") - low
    hits, low, many = hits[many > 0], low[many > 0], many[many > 0]
    if not len(hits):
        return
    row = np.searchsorted(at, hits, side="right") - 1
    whole = hits + Q <= at[row + 1]  # q-grams that don't cross into the next text
    hits, low, many, row = hits[whole], low[whole], many[whole], row[whole]
    # every stretch of a q-gram in the passages
    each = np.repeat(np.arange(len(hits)), many)
    if not len(each):
        return
    entry = np.arange(len(each)) - np.repeat(np.cumsum(many) - many, many) + low[each]
    item = passages.item[entry]
    place = hits[each] - at[row[each]]
    width = passages.edits[item] + 1
    # one more for the bands from the first to the last that the stretch reaches
    begin = (place - passages.last[entry]) // width - 1
    end = (place - passages.first[entry]) // width + 1
    pair, group = np.unique(row[each] * len(passages.ids) + item, return_inverse=True)
    offset = int(begin.min())
    span = int(end.max()) - offset + 1
    keys = np.concatenate([group * span + begin - offset, group * span + end - offset])
    steps = np.ones(len(keys), np.int64)
    steps[len(group):] = -1
    order = np.argsort(keys, kind="stable")
    keys, steps = keys[order], np.cumsum(steps[order])
    final = np.append(keys[1:] != keys[:-1], True)
    keys, counts = keys[final], steps[final]  # bands from a key up to the next one have this count
    owner = pair[keys // span]
    enough = counts >= passages.bound[owner % len(passages.ids)]
    # stretches of keys of one pair that all reach the bound; the key after them is where they end
    edge = np.diff(np.concatenate([[0], enough.astype(np.int8), [0]]))
    for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True):
        r, p = divmod(int(owner[a]), len(passages.ids))
        k = int(passages.edits[p])
        yield r, p, (int(keys[a] % span) + offset) * (k + 1), (int(keys[b] % span) + offset + 1) * (k + 1) - 1


def best_in(passage: np.ndarray, text: np.ndarray, first: int, last: int, edits: int):
    """Best occurrence in a region of any width: stretches that share 2 k diagonals, until one has no edit."""
    best = None
    first, last = max(first, -edits), min(last, len(text) - len(passage) + edits)
    while first <= last:
        found = align(passage, text, first, min(last, first + REGION + 2 * edits), edits)
        if found and (best is None or found < best):
            best = found
        if best and not best[0]:
            break  # whatever comes later begins later
        first += REGION
    return best


def short_ones(passages: Passages, text: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """(row, passage, begin, end) of the first place of passages shorter than q, between borders of words."""
    if not passages.short or not len(text):
        return
    space = text == 0x20
    starts = np.zeros(len(text) + 1, bool)
    starts[at] = True
    ends = np.append(space, True) | starts
    starts[1:] |= space
    starts = np.flatnonzero(starts[:-1] & ~space)
    row = np.searchsorted(at, starts, side="right") - 1
    for length, (known, items) in passages.short.items():
        fits = starts + length <= at[row + 1]
        begin, mine = starts[fits], row[fits]
        whole = ends[begin + length]
        begin, mine = begin[whole], mine[whole]
        hashes = common.span_hashes(text, begin, begin + length)
        low = np.searchsorted(known, hashes, side="left")
        many = np.searchsorted(known, hashes, side="right") - low
        seen = set()
        for h in np.flatnonzero(many).tolist():
            own = text[begin[h]:begin[h] + length].tobytes()
            for p in items[low[h]:low[h] + many[h]].tolist():
                if (mine[h], p) not in seen and passages.texts[p].tobytes() == own:
                    seen.add((mine[h], p))
                    a = int(begin[h] - at[mine[h]])
                    yield int(mine[h]), p, a, a + length


def search(passages: Passages, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """(row, passage, edits, begin, end) of the best occurrence of each passage in each text; bytes of the original."""
    text, origin, at = plain(data, offsets)
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    for r, p, first, last in regions(passages, text, at):
        k = int(passages.edits[p])
        if best.get((r, p), (1,))[0] == 0:
            continue  # regions come in order of their diagonals
        found = best_in(passages.texts[p], text[at[r]:at[r + 1]], first, last, k)
        if found and found < best.get((r, p), (k + 1,)):
            best[r, p] = found
    for r, p, a, b in short_ones(passages, text, at):
        best[r, p] = (0, a, b)
    out = []
    for (r, p), (used, a, b) in sorted(best.items()):
        begin = origin[at[r] + a] - offsets[r]
        out.append((r, p, used, int(begin), int(origin[at[r] + b - 1] + 1 - offsets[r])))
    return out


def _blocks(benchmark: DataFrame) -> Iterator[Passages]:
    """The benchmark in blocks of about BLOCK_CHARS characters, one at a time in the driver."""
    rows = benchmark.where("text IS NOT NULL").select("item_id", "text")
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, math.ceil(chars / BLOCK_CHARS))
    for block in range(n):
        part = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == block)
        yield index(sorted(map(tuple, part.collect()), key=repr))


_FOUND = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("edits", pa.int64()),
                    ("begin", pa.int64()), ("end", pa.int64())])


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, edits, begin, end (code points of the text) of the best occurrence of every passage found."""
    spark = docs.sparkSession
    common.small_batches(spark)
    out = None
    for passages in _blocks(benchmark):
        sent = spark.sparkContext.broadcast(passages)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            known = sent.value
            for batch in batches:
                for piece in common.pieces(batch, "text"):
                    data, offsets = common.text_bytes(piece.column(1))
                    rows = []
                    for r, p, used, a, b in search(known, data, offsets):
                        own = data[offsets[r]:offsets[r] + b]
                        heads = np.cumsum((own & 0xC0) != 0x80)
                        rows.append((piece.column(0)[r].as_py(), known.ids[p], used,
                                     int(heads[a]) - 1, int(heads[-1])))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([x[i] for x in rows], f.type) for i, f in enumerate(_FOUND)], schema=_FOUND)

        part = docs.select("doc_id", "text").mapInArrow(
            run, "doc_id long, item_id long, edits long, begin long, end long")
        out = part if out is None else out.union(part)
    return out


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows without any passage of the benchmark, all columns as they are."""
    spark = docs.sparkSession
    common.small_batches(spark)
    at = docs.columns.index("text")
    for passages in _blocks(benchmark):
        sent = spark.sparkContext.broadcast(passages)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for piece in common.pieces(batch, "text"):
                    found = search(sent.value, *common.text_bytes(piece.column(at)))
                    keep = np.ones(piece.num_rows, bool)
                    keep[[x[0] for x in found]] = False
                    yield piece.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))
