"""Periodic run detection: stretches of words that repeat with a period, found by seeds and extension.

Words are ``[^\\x20\\x09-\\x0D]+``, numbered from 0. A run is a stretch of at least ``min_words`` words and of at
least three periods that no neighbouring word extends keeping its smallest period.

On the diagonal of its period (its lag) a run of period q is a match of max(min_words - q, 2 q) positions or more.
So each power of two g has the lags from g to 2 g: a match of 2 g - 1 positions covers a whole block of g words that
begins at a multiple of g, and the g-gram of that block stands again at the lag. The least gram (8 words for 24) has
all lags below 16. For each block that is a seed, all places of its gram within reach are looked up in the sorted
index of grams of the same document: at most as many pairs a gram length as there are words, whatever the text,
though a text of one word repeated has a pair of places for any two of its words.

Seeds are taken lag by lag in the order of their places. The furthest covered place of the lag tells whether a seed
goes on with the match before it; only the first and the last seed of a match are extended, by less than g words
each. Grams are numbered by doubling (a gram of 2 g words is a pair of numbers of g words), so equal numbers mean
equal words, and extension walks down the same numbers: no hash decides anything. A match whose lag is a multiple
of the smallest period covers the same words as that of the smallest period and is left out.

NULL text has no words. Repeated rows, NULL ids and ties each keep a row of their own, an empty table gives none,
further columns are not read. Work on a text grows as n log n with its words; a text larger than a piece is read in
slices, the index takes about 60 bytes a word, and 4 more a word for each doubling that still has repeated grams.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import compress, count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm import common

MIN_WORDS = 24
PERIODS = 3
TEXT_SLICE = 1 << 20

_ROWS = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_BREAK = re.compile(rb"[\x20\x09-\x0D]|\Z")


# ---- grams -------------------------------------------------------------------------------------------


def least_gram(min_words: int) -> int:
    """The largest power of two g such that every run's match on its diagonal covers an aligned block of g."""
    overlap = min(max(min_words - q, (PERIODS - 1) * q) for q in range(1, min_words + 1))
    return 1 << (((overlap + 1) // 2).bit_length() - 1)


def repeats(words: np.ndarray, doc: np.ndarray, gram: int) -> np.ndarray:
    """Documents in which some gram may stand twice; by hashes, so that one too many does no harm."""
    if len(words) < gram:
        return np.zeros(0, np.int64)
    code = common.mix(words.astype(np.uint64))
    hashes = code[:len(code) - gram + 1].copy()
    for k in range(1, gram):
        hashes = hashes * np.uint64(0x9E3779B97F4A7C15) + code[k:len(code) - gram + 1 + k]
    begin = doc[:len(hashes)]
    inside = begin == doc[gram - 1:]
    hashes = common.mix(hashes ^ common.mix(begin.astype(np.uint64), 5))[inside]
    order = np.argsort(hashes)
    same = hashes[order][1:] == hashes[order][:-1]
    return np.unique(begin[inside][order[1:][same]])


def _numbered(keys: np.ndarray) -> tuple[np.ndarray, int]:
    known, numbers = np.unique(keys, return_inverse=True)
    return numbers.astype(np.int32), len(known)


def _seeds(names: np.ndarray, gram: int, lags: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """(lag, place) of aligned blocks whose gram stands again at a lag in the range, by lag and place."""
    n = len(names)
    order = np.argsort(names, kind="stable")
    index = names[order].astype(np.int64) * n + order
    blocks = np.arange(0, n, gram)
    blocks = blocks[np.bincount(names)[names[blocks]] > 1]
    base = names[blocks].astype(np.int64) * n
    begin = np.searchsorted(index, base + np.minimum(blocks + lags[0], n))
    sizes = np.searchsorted(index, base + np.minimum(blocks + lags[1], n)) - begin
    place = np.repeat(blocks, sizes)
    nth = np.arange(len(place)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    lag = order[np.repeat(begin, sizes) + nth] - place
    by = np.lexsort((place, lag))
    return lag[by], place[by]


def _extended(levels: list[np.ndarray], n: int, gram: int, lag: np.ndarray, place: np.ndarray):
    """Begin, end and lag of the matches that the seeds belong to; end counts the first of the two places."""
    covered = np.concatenate([[-1], place[:-1] + gram])  # furthest covered place of the lag, before each seed
    first = np.concatenate([[True], (lag[1:] != lag[:-1]) | (place[1:] != covered[1:])])
    last = np.concatenate([first[1:], [True]])
    begin, end, lag = place[first].copy(), place[last] + gram, lag[first]
    for step, names in reversed([(1 << k, names) for k, names in enumerate(levels) if 1 << k < gram]):
        at = begin - step
        ok = np.flatnonzero(at >= 0)
        same = names[at[ok]] == names[at[ok] + lag[ok]]
        begin[ok[same]] -= step
        ok = np.flatnonzero(end + lag + step <= n)
        same = names[end[ok]] == names[end[ok] + lag[ok]]
        end[ok[same]] += step
    return begin, end, lag


def find(words: np.ndarray, doc: np.ndarray, min_words: int = MIN_WORDS) -> np.ndarray:
    """Runs (begin, length, period) in the words of documents one after the other, by begin and period.

    ``words`` are numbers, equal for equal words; ``doc`` is the rising number of each word's document.
    """
    least = least_gram(min_words)
    if not len(words):
        return np.zeros((0, 3), np.int64)
    # a word of another document is another word, so no gram crosses a border and stands twice
    names, known = _numbered(doc.astype(np.int64) * (int(words.max()) + 1) + words)
    levels, gram, found = [], 1, []
    while True:
        if gram >= least:
            lag, place = _seeds(names, gram, (1 if gram == least else gram, 2 * gram))
            if len(lag):
                found.append(_extended(levels, len(words), gram, lag, place))
        levels.append(names)
        if known == len(names) or len(names) <= gram:
            break
        names, known = _numbered(names[:-gram].astype(np.int64) * known + names[gram:])
        gram *= 2
    if not found:
        return np.zeros((0, 3), np.int64)
    begin, end, period = (np.concatenate(x) for x in zip(*found))
    length = end - begin + period
    fits = length >= np.maximum(min_words, PERIODS * period)
    begin, length, period = begin[fits], length[fits], period[fits]
    by = np.lexsort((period, length, begin))
    begin, length, period = begin[by], length[by], period[by]
    smallest = np.ones(len(by), bool)
    smallest[1:] = (begin[1:] != begin[:-1]) | (length[1:] != length[:-1])
    runs = np.stack([begin, length, period], axis=1)[smallest]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


# ---- documents ---------------------------------------------------------------------------------------


def _slices(text: bytes) -> Iterator[bytes]:
    """A text in parts of about ``TEXT_SLICE`` bytes that don't cut a word."""
    begin = 0
    while begin < len(text):
        end = _BREAK.search(text, min(len(text), begin + TEXT_SLICE)).start()
        yield text[begin:end]
        begin = end


def _numbers(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the words of all texts, and how many words each has."""
    known: defaultdict = defaultdict(count().__next__)
    parts, sizes = [np.zeros(0, np.int64)], []
    for text in texts:
        size = 0
        for part in _slices(text):
            found = part.split()
            parts.append(np.fromiter(map(known.__getitem__, found), np.int64, len(found)))
            size += len(found)
        sizes.append(size)
    return np.concatenate(parts), np.array(sizes, np.int64)


def _collapsed(text: bytes, keep: np.ndarray | None) -> bytes:
    """The kept words (all without ``keep``), joined by one space."""
    out, at = [], 0
    for part in _slices(text):
        found = part.split()
        kept = found if keep is None else compress(found, keep[at:at + len(found)].tolist())
        at += len(found)
        part = b" ".join(kept)
        if part:
            out.append(part)
    return b" ".join(out)


def _piece(piece: pa.RecordBatch, min_words: int) -> pa.RecordBatch:
    data, offsets = common.text_bytes(piece.column("text"))
    whole = data.tobytes()
    texts = [whole[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
    words, sizes = _numbers(texts)
    starts = np.cumsum(sizes) - sizes
    doc = np.repeat(np.arange(len(texts)), sizes)
    some = np.isin(doc, repeats(words, doc, least_gram(min_words)))
    places = np.flatnonzero(some)
    runs = find(words[some], doc[some], min_words)
    owner = doc[places[runs[:, 0]]]
    begin = places[runs[:, 0]]
    # words of any run after its first period go
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, begin + runs[:, 2], 1)
    np.add.at(change, begin + runs[:, 1], -1)
    keep = np.cumsum(change[:-1]) == 0
    hit = set(owner.tolist())
    collapsed = [_collapsed(text, keep[starts[i]:starts[i] + sizes[i]] if i in hit else None)
                 for i, text in enumerate(texts)]
    rows = pa.StructArray.from_arrays(
        [pa.array(begin - starts[owner]), pa.array(runs[:, 1]), pa.array(runs[:, 2])], fields=list(_RUN))
    cuts = np.searchsorted(owner, np.arange(len(texts) + 1)).astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [piece.column("doc_id"), pa.array(sizes), pa.ListArray.from_arrays(pa.array(cuts), rows),
         pa.array(collapsed, pa.binary()).cast(pa.string())],
        names=["doc_id", "n_words", "runs", "collapsed"])


def detect(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of each row: its runs by start and period, and its words, joined by one
    space, without those that a run repeats after its first period."""
    common.small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in common.pieces(batch, "text"):
                yield _piece(piece, min_words)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")) \
        .mapInArrow(run, _ROWS)


# ---- the query ---------------------------------------------------------------------------------------


def edited(text: Column, doc_id: Column) -> Column:
    """The text with periods put in, for ids whose crc32 h is divisible by 10: with g = h / 10, every word i from
    a = g % n on becomes word a + (i - a) % p, p = 1 + floor((n - a) / (3 + g % 8)). Other texts stay."""
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)

    def put(words: Column) -> Column:
        n = F.size(words)
        a = (g % F.greatest(n, F.lit(1))).cast("int")
        p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")
        times = F.ceil((n - a) / p).cast("int")
        tail = F.slice(F.flatten(F.array_repeat(F.slice(words, a + 1, p), times)), F.lit(1), n - a)
        return F.array_join(F.concat(F.slice(words, F.lit(1), a), tail), " ")

    words = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    return F.when(h % 10 == 0, F.transform(F.array(words), put)[0]).otherwise(text)


def digests(found: DataFrame) -> DataFrame:
    """The runs of each row as counts and digests, and the one that repeats most often."""
    def oftener(x: Column, y: Column) -> Column:
        more = y["length"] * x["period"] - x["length"] * y["period"]
        order = F.when(more != 0, more).when(x["start"] != y["start"], x["start"] - y["start"]) \
            .otherwise(x["period"] - y["period"])
        return F.signum(order).cast("int")

    best = F.get(F.array_sort("runs", oftener), F.lit(0))
    lines = F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
                        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
                        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256")).select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period",
        F.call_function("div", F.col("best.length") * 1000, F.col("best.period")).alias("exponent_milli"),
        "runs_sha256", "collapsed_sha256")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    return digests(detect(docs.withColumn("text", edited(F.col("text"), F.col("doc_id")))))


SQL = {"op11_periodic_runs": r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
    xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::UBIGINT)),
      lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]),
        lambda x, y: xor(x >> 1, 3988292384::UBIGINT * (x & 1)))), 4294967295::UBIGINT)::BIGINT AS h
  FROM documents),
a AS (SELECT *, len(words) AS n, h // 10 AS g FROM d),
b AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n ELSE n END AS a FROM a),
c AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM b),
w AS (SELECT r, n, i, words[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END] AS word
  FROM (SELECT *, unnest(range(n)) AS i FROM c)),
l AS (SELECT r, n, list(word ORDER BY i) AS words FROM w GROUP BY r, n),
grams AS (SELECT r, n, i, array_to_string(words[i + 1:i + 16], ' ') AS gram
  FROM (SELECT r, n, words, unnest(range(n - 15)) AS i FROM l WHERE n >= 24)),
often AS (SELECT r, n, gram, list(i ORDER BY i) AS places FROM grams GROUP BY r, n, gram HAVING count(*) > 1),
lags AS (SELECT DISTINCT r, n, y - x AS q FROM
  (SELECT r, n, x, unnest(places) AS y FROM (SELECT r, n, places, unnest(places) AS x FROM often))
  WHERE y > x AND 3 * (y - x) <= n),
eq AS (SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island
  FROM (SELECT lags.r, q, words, unnest(range(lags.n - q)) AS i FROM lags JOIN l USING (r))
  WHERE words[i + 1] = words[i + q + 1]),
m AS (SELECT r, q, min(i) AS start, count(*) + q AS length FROM eq GROUP BY r, q, island),
runs AS (SELECT r, start, length, min(q) AS period FROM m WHERE length >= greatest(24, 3 * q) GROUP BY r, start, length),
best AS (SELECT r, start, length, period FROM runs QUALIFY row_number() OVER (
  PARTITION BY r ORDER BY length::DECIMAL(38, 0) * 1000000000000 // period DESC, start, period) = 1),
digest AS (SELECT r, count(*) AS n_runs,
  sha256(string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period)) AS runs_sha256 FROM runs GROUP BY r),
dropped AS (SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (SELECT w.r, sha256(string_agg(word, ' ' ORDER BY w.i)) AS collapsed_sha256 FROM w
  WHERE NOT EXISTS (SELECT 1 FROM dropped x WHERE x.r = w.r AND x.i = w.i) GROUP BY w.r)
SELECT d.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, best.start::BIGINT AS start, best.length::BIGINT AS length,
  best.period::BIGINT AS period, (1000 * best.length // best.period)::BIGINT AS exponent_milli,
  coalesce(runs_sha256, sha256('')) AS runs_sha256, coalesce(collapsed_sha256, sha256('')) AS collapsed_sha256
FROM d LEFT JOIN best ON best.r = d.r LEFT JOIN digest ON digest.r = d.r LEFT JOIN kept ON kept.r = d.r
"""}
