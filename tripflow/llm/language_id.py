"""Language identification by cross-parsing.

For each language a suffix automaton of labelled text is built. A text is parsed against it from left to right into the
longest phrases that occur in the labelled text; the language that needs the fewest phrases per letter wins. The
automaton is a table state x symbol -> state in which a failing step already leads to the state after the
symbol from the start, with a mark that a new phrase began there; so a text takes one look-up per symbol and language, and
many pieces of text advance in step in numpy.

Text is lower-cased and reduced to letters; anything else is a gap, runs of gaps are one. Every language has
an alphabet of its own, which holds all letters of its labelled text, whatever their script. A letter is one symbol; in
languages of many letters (Han, Hangul) those beyond the most frequent are two. A letter that a language's labelled text
doesn't have is a phrase by itself.

Fitted on a bounded sample: at most ``docs_per_language`` labelled rows (those with the smallest hash)
and ``chars_per_language`` of their symbols. Results for special rows: a text that is NULL or has no letter is ``und``
with score 0; ties go to the language first in order; a NULL id is an id (not held out or held out by its
empty text); repeated rows are rows of their own; an empty table, or one without labels, gives only ``und``.
Other columns are not looked at.
"""

from __future__ import annotations

import functools
import sys
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripflow.llm import common

UNKNOWN = "und"
#: symbols of a language (gap and strange letters included) up to which every letter is one symbol
SYMBOLS = 64
DOCS_PER_LANGUAGE = 64
CHARS_PER_LANGUAGE = 40_000
#: a row goes where another language than its label's is so far ahead, in a text of so many letters
SURE_SCORE = 0.25
SURE_LETTERS = 50
#: symbols that one stream parses; a text longer than this is parsed in so long stretches
STRETCH = 2048
NEW = np.int32(1 << 30)


def letters(text: str) -> str:
    """Lower case, with every run of other characters a single space."""
    return "".join(c if c.isalpha() else " " for c in text.lower())


def suffix_automaton(symbols: list[int], size: int) -> np.ndarray:
    """Transitions (states x size, -1 where there is none) of the automaton of all substrings."""
    following: list[list[int]] = [[-1] * size]
    link, length, last = [-1], [0], 0
    for c in symbols:
        now = len(following)
        following.append([-1] * size)
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p != -1 and following[p][c] == -1:
            following[p][c] = now
            p = link[p]
        if p != -1:
            q = following[p][c]
            if length[p] + 1 != length[q]:
                clone = len(following)
                following.append(following[q][:])
                link.append(link[q])
                length.append(length[p] + 1)
                while p != -1 and following[p][c] == q:
                    following[p][c] = clone
                    p = link[p]
                link[q] = clone
                q = clone
            link[now] = q
        last = now
    return np.array(following, np.int32)


def parse_table(symbols: list[int], size: int) -> np.ndarray:
    """The automaton as one flat table for parsing: entry state * size + symbol is the next state * size,
    plus NEW where the symbol begins a phrase. From the start every symbol begins one."""
    states = suffix_automaton(symbols, size)
    fresh = np.where(states[0] >= 0, states[0], 0)
    table = np.where(states >= 0, states, fresh | NEW)
    table[0] |= NEW
    base = table & ~NEW
    return (base * size | (table & NEW)).astype(np.int32).ravel()


@functools.cache
def _is_letter() -> np.ndarray:
    """Of every code point: 1 for letters, 0 for others."""
    return np.fromiter((chr(p).isalpha() for p in range(sys.maxunicode + 1)), np.int32, sys.maxunicode + 1)


@dataclass
class Alphabet:
    """Symbols of a language by letter number: 0 the gap, 1 a strange letter, 2.. its own; ``second`` is 0 for letters of one symbol."""

    first: np.ndarray
    second: np.ndarray
    size: int

    def spelt(self, numbers: np.ndarray) -> list[int]:
        both = np.stack([self.first[numbers], self.second[numbers]], axis=1).ravel()
        keep = both > 0
        keep[::2] = True
        return both[keep].tolist()


def alphabet(counts: Counter, count: int, size: int) -> Alphabet:
    """Alphabet of the letter numbers in ``counts``, out of ``count``: the most frequent have one symbol, and if
    there are more than fit, the others two, the second ones being symbols that stand nowhere else."""
    ranked = [k for k, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))]
    first, second = np.ones(count, np.int32), np.zeros(count, np.int32)
    first[0] = 0
    single, others = ranked[:size - 2], ranked[size - 2:]
    first[single] = np.arange(2, 2 + len(single))
    side = int(np.ceil(np.sqrt(len(others))))
    at, rank = 2 + len(single), np.arange(len(others))
    if others:
        first[others], second[others] = at + rank // side, at + side + rank % side
    return Alphabet(first, second, at + 2 * side)


@dataclass
class Model:
    languages: list[str]
    codes: np.ndarray  # code point -> number of a letter
    tables: list[np.ndarray]
    size: int
    alphabets: list[Alphabet] = field(default_factory=list)

    def symbols(self, text: str) -> np.ndarray:
        """Letters of a text by number: 0 a gap, 1 a letter that no language has, 2.. the letters of the labelled text."""
        out = self.codes[np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)]
        if len(out):
            keep = out > 0
            keep[1:] |= out[:-1] > 0
            out = out[keep]
        return out

    def phrases(self, streams: list[np.ndarray]) -> np.ndarray:
        """Phrases of every stream under every language (languages x streams)."""
        lengths = np.array([len(s) for s in streams])
        order = np.argsort(-lengths, kind="stable")
        longest = int(lengths.max(initial=0))
        block = np.zeros((longest, len(streams)), np.int32)
        for column, k in enumerate(order):
            block[:lengths[k], column] = streams[k]
        active = np.searchsorted(-lengths[order], -np.arange(longest), side="left")
        out = np.zeros((len(self.tables), len(streams)), np.int64)
        for row, table in enumerate(self.tables):
            own = self.alphabets[row] if self.alphabets else None
            first = block if own is None else own.first[block]
            second = own.second[block] if own is not None and own.second.any() else None
            state = np.zeros(len(streams), np.int32)
            count = np.zeros(len(streams), np.int32)
            for t in range(longest):
                n = active[t]
                step = table[state[:n] + first[t, :n]]
                count[:n] += step >> 30
                state[:n] = step & ~NEW
                if second is not None and len(more := np.flatnonzero(second[t, :n])):
                    step = table[state[more] + second[t, more]]
                    count[more] += step >> 30
                    state[more] = step & ~NEW
            out[row, order] = count
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        streams, owner, letters_of = [], [], np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            symbols = self.symbols(text or "")
            letters_of[i] = np.count_nonzero(symbols)
            if letters_of[i]:
                for at in range(0, len(symbols), STRETCH):
                    streams.append(symbols[at:at + STRETCH])
                    owner.append(i)
        names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        if not streams or not self.tables:
            return names, scores
        totals = np.zeros((len(self.tables), len(texts)), np.int64)
        found = self.phrases(streams)
        for row in range(len(self.tables)):
            np.add.at(totals[row], owner, found[row])
        rate = totals / np.maximum(letters_of, 1)
        best = rate.argmin(axis=0)
        others = np.sort(rate, axis=0)
        for i in np.flatnonzero(letters_of):
            names[i] = self.languages[best[i]]
            # how much fewer phrases than the runner-up needs
            second = others[1, i] if len(self.tables) > 1 else 1.0
            scores[i] = float(max(0.0, 1.0 - others[0, i] / second)) if second else 0.0
        return names, scores


def build(samples: list[tuple[str, str]], size: int = SYMBOLS,
          chars: int = CHARS_PER_LANGUAGE) -> Model:
    """Model of (language, text) pairs. A language's texts give equal parts of its symbols."""
    by: dict[str, list[str]] = {}
    for language, text in sorted(samples):
        cleaned = " ".join(letters(text).split())
        if cleaned:
            by.setdefault(language, []).append(cleaned)
    parts = {language: [t[:max(1, chars // len(texts))] for t in texts] for language, texts in by.items()}
    every = sorted({c for texts in parts.values() for t in texts for c in t if c != " "})
    codes = _is_letter().copy()
    codes[[ord(c) for c in every]] = np.arange(2, 2 + len(every))
    model = Model(sorted(by), codes, [], size)
    for language in model.languages:
        numbers = [model.symbols(t) for t in parts[language]]
        own = alphabet(Counter(k for n in numbers for k in n.tolist() if k > 1), 2 + len(every), size)
        model.alphabets.append(own)
        model.tables.append(parse_table([s for n in numbers for s in [0, *own.spelt(n)]], own.size))
    return model


def sample(docs: DataFrame, per_language: int = DOCS_PER_LANGUAGE,
           chars: int = CHARS_PER_LANGUAGE) -> list[tuple[str, str]]:
    """The labelled rows to fit on: for each language those with the smallest hash, at most so many.

    The group limit is applied in every task before the shuffle.
    """
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id", F.length("text")), "doc_id")
    rows = docs.where("lang IS NOT NULL AND text IS NOT NULL").select(
        "lang", "doc_id", F.substring("text", 1, chars).alias("text"))
    top = rows.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= per_language)
    return [(r.lang, r.text) for r in top.select("lang", "text").collect()]


_MODELS: dict[int, Model] = {}


def _model(samples, version: int) -> Model:
    """Built once for each worker process, from the broadcast sample."""
    if version not in _MODELS:
        _MODELS.clear()
        _MODELS[version] = build(samples.value)
    return _MODELS[version]


_SCHEMA = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()),
                     ("score", pa.float64())])


def identify(docs: DataFrame, samples: list[tuple[str, str]], held_out=None) -> DataFrame:
    """doc_id, held_out, lang_pred, score (how far the winner is ahead, 0 to 1) for every row."""
    spark = docs.sparkSession
    common.small_batches(spark)
    sent = spark.sparkContext.broadcast(samples)
    version = hash(tuple(samples))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(sent, version)
        for batch in batches:
            for piece in common.pieces(batch, "text"):
                names, scores = model.predict(piece.column(2).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), piece.column(1), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                    schema=_SCHEMA)

    flag = F.lit(False) if held_out is None else held_out
    return docs.select("doc_id", flag.alias("held_out"), "text").mapInArrow(
        run, "doc_id long, held_out boolean, lang_pred string, score double")


def rejected(text: str | None, label: str | None, name: str, score: float, learnt) -> bool:
    """Whether a row goes: its text has no language, or clearly another one than its label says.

    Clearly: the label is a language that was learnt, the text has ``SURE_LETTERS`` letters or more, and another language is
    ``SURE_SCORE`` or more ahead. A row without a label, or with one that wasn't learnt, stays; so does a
    row of the sample, whose text its own label's automaton has.
    """
    if name == UNKNOWN:
        return True
    return (label is not None and label != name and label in learnt and score >= SURE_SCORE
            and sum(map(str.isalpha, text or "")) >= SURE_LETTERS)


def keep_identified(docs: DataFrame, samples: list[tuple[str, str]]) -> DataFrame:
    """The rows that aren't :func:`rejected`, all columns as they are; without any label, the rows that have a letter."""
    spark, at, said = docs.sparkSession, docs.columns.index("text"), docs.columns.index("lang")
    common.small_batches(spark)
    sent, version = spark.sparkContext.broadcast(samples), hash(tuple(samples))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(sent, version)
        learnt = {lang for lang, _ in sent.value}
        for batch in batches:
            for piece in common.pieces(batch, "text"):
                texts, labels = piece.column(at).to_pylist(), piece.column(said).to_pylist()
                if learnt:
                    keep = [not rejected(*row, learnt) for row in zip(texts, labels, *model.predict(texts), strict=True)]
                else:
                    keep = [bool(model.symbols(text or "").any()) for text in texts]
                yield piece.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    held_out = common.crc_part(F.col("doc_id"), 3) == 1
    return identify(docs, sample(docs.where(~held_out)), held_out)
