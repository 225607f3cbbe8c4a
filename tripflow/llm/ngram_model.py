"""Interpolated modified Kneser-Ney model of word pairs, counted in Spark.

Counting: tasks emit words and word pairs with counts, already summed over some million tokens; Spark deals
them out by hash and sorts them, and each task sums equal neighbours and writes one sorted array
file for each range of hashes. From the pairs come the types before and after each word, dealt out and
summed in the same way and written as a second set of arrays. Workers map these files into memory and look hashes up by binary search.

Probability of word w after v, with c the pair's count and D1, D2, D3+ the discounts from the numbers of pairs
that occur one to four times:

    p(w | v) = max(c(v, w) - D, 0) / c(v) + gamma(v) * p(w)
    p(w) = max(N(w) - D', 0) / N + gamma' / (V + 1)

N(w) is the number of different words before w, N their sum, D' the discounts of the N(w). After a word never seen as
a context p(w) alone counts. Together with one unknown word everything sums to 1.

Words are 64-bit hashes, and so are pairs; a pair's hash and its first word give its second word back, so that the types
of every word are its own in a vocabulary of any size. A text is lower-cased in A-Z and split at white space; its end is a token.

Results for special rows: a NULL or empty text is just the end token; a NULL id counts as the empty text
for the split; repeated rows count as often as they occur; without any training row all words are unknown: base_score and
score follow from N = V = 0; an empty table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

import math
import uuid
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm import common

#: hash of the token at a text's end and of the context at its beginning (no word's, but for chance)
END = np.uint64(0xE4D0000000000001)
BEGIN = np.uint64(0xBE61000000000002)
#: tokens whose pairs a task sums before it hands them on
HELD_TOKENS = 1 << 22
#: words or pairs that a writer of arrays sums at once
HELD_KEYS = 1 << 19
#: bytes of text for one array file, about
SHARD_BYTES = 1 << 25
#: in an array of 32-bit counts: the count is among the model's large ones (at most one for each 2 ** 32 tokens)
LARGE = 0xFFFFFFFF
#: array files that a worker keeps mapped
OPEN_FILES = 128
_INVERSE_1 = np.uint64(pow(0xBF58476D1CE4E5B9, -1, 1 << 64))
_INVERSE_2 = np.uint64(pow(0x94D049BB133111EB, -1, 1 << 64))
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def unmix(x: np.ndarray) -> np.ndarray:
    """What ``common.mix`` with seed 0 was given."""
    x = x ^ (x >> np.uint64(31)) ^ (x >> np.uint64(62))
    x = x * _INVERSE_2
    x = x ^ (x >> np.uint64(27)) ^ (x >> np.uint64(54))
    x = x * _INVERSE_1
    x = x ^ (x >> np.uint64(30)) ^ (x >> np.uint64(60))
    return x - _GOLDEN


def tokens(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every token of all texts, ends included, and the first token of each (n + 1 places)."""
    hashes, first = common.words(array)
    n = len(first) - 1
    out = np.empty(len(hashes) + n, np.uint64)
    at = first + np.arange(n + 1)
    ends = at[1:] - 1
    is_word = np.ones(len(out), bool)
    is_word[ends] = False
    out[is_word], out[ends] = hashes, END
    return out, at


def pair_keys(words: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of every token, the key of its pair and its predecessor."""
    before = np.empty_like(words)
    before[1:] = words[:-1]
    before[at[:-1]] = BEGIN
    return common.mix(common.mix(before, 1) + words), before


def second_words(keys: np.ndarray, before: np.ndarray) -> np.ndarray:
    """The second words of pairs."""
    return unmix(keys) - common.mix(before, 1)


def _shard(key, bits: int):
    """Column: the highest bits of a hash."""
    return F.shiftrightunsigned(key, 64 - bits).cast("int")


def pair_shards(before: np.ndarray, words: np.ndarray, bits: int) -> np.ndarray:
    """Array file of each pair: the highest bits of its two words' hashes, one xor the other."""
    return ((before ^ words) >> np.uint64(64 - bits)).astype(np.int64)


def shard_bits(text_bytes: int) -> int:
    """Array files are 2 ** bits for each kind; at least two."""
    return max(1, math.ceil(math.log2(max(1, text_bytes / SHARD_BYTES))))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of words (no ``before``) and of pairs of a part of the texts, held back until there are HELD_TOKENS."""
    words, pairs, befores = [], [], []
    size = 0

    def flush() -> Iterator[pa.RecordBatch]:
        keys, counts = np.unique(np.concatenate(words), return_counts=True)
        words.clear()
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(len(keys), pa.int64()), pa.array(common.signed(keys)), pa.array(counts)], ["before", "word", "n"])
        keys, first, counts = np.unique(np.concatenate(pairs), return_index=True, return_counts=True)
        pairs.clear()
        before = np.concatenate(befores)[first]
        befores.clear()
        # two words, not the pair's hash, and equal predecessors side by side: both repeat, so they take little space
        second = second_words(keys, before)
        order = np.argsort(before)
        yield pa.RecordBatch.from_arrays(
            [pa.array(common.signed(before[order])), pa.array(common.signed(second[order])), pa.array(counts[order])],
            ["before", "word", "n"])

    for batch in batches:
        for piece in common.pieces(batch, "text"):
            found, at = tokens(piece.column(0))
            # the beginning isn't a token, but a context whose count is that of the texts
            words.append(np.concatenate([found, np.full(piece.num_rows, BEGIN)]))
            keys, before = pair_keys(found, at)
            pairs.append(keys)
            befores.append(before)
            size += len(found)
            if size >= HELD_TOKENS:
                yield from flush()
                size = 0
    if words:
        yield from flush()


class _Shards:
    """Writes sorted arrays, one file for each run of equal shards (else of keys with equal highest bits)."""

    def __init__(self, folder: str, bits: int, name: str):
        self.folder, self.bits, self.name = folder, bits, name
        self.now, self.held, self.done = None, [], []

    def add(self, keys: np.ndarray, columns: list[np.ndarray], shard: np.ndarray | None = None) -> None:
        """Keys are sorted within a shard and distinct, here and from call to call."""
        if shard is None:
            shard = (keys >> np.uint64(64 - self.bits)).astype(np.int64)
        cuts = [0, *(np.flatnonzero(np.diff(shard)) + 1).tolist(), len(keys)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if a == b:
                continue
            if shard[a] != self.now:
                self.close()
                self.now = int(shard[a])
            self.held.append([x[a:b] for x in (keys, *columns)])

    def close(self) -> None:
        if self.held:
            # a name of its own for every attempt: a repeated task never touches another's file
            path = f"{self.folder}/{self.name}-{self.now}-{uuid.uuid4().hex}"
            store, local = common.opened(path)
            store.create_dir(local.rpartition("/")[0], recursive=True)
            arrays = [np.concatenate(x) for x in zip(*self.held, strict=True)]
            with store.open_output_stream(local) as out:
                for array in arrays:
                    out.write(np.ascontiguousarray(array))
            self.done.append((self.now, path, len(arrays[0])))
        self.held = []


_PARTS = "kind string, id long, n long, n1 long, n2 long, n3 long, types long, path string"
_PART_FIELDS = pa.schema([("kind", pa.string())] + [(c, pa.int64()) for c in ("id", "n", "n1", "n2", "n3", "types")]
                         + [("path", pa.string())])


def _parts(kind: str, **columns) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays(
        [pa.array([kind] * n, pa.string())] + [
            pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type)
            for f in list(_PART_FIELDS)[1:]], schema=_PART_FIELDS)


def _summed(keys: np.ndarray, counts: np.ndarray, *others: np.ndarray) -> list[np.ndarray]:
    """Sums of equal neighbours; the other columns are equal where the keys are."""
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    at = np.flatnonzero(new)
    return [keys[at], np.add.reduceat(counts, at) if len(at) else counts[:0], *(x[at] for x in others)]


def _write_counts(folder: str, bits: int):
    """(before, word, n) in order, pairs before words -> array files of pairs; rows: those files, words with counts, and for each
    word the pairs it begins by count (n1, n2, n3) and the pairs it ends (types), as far as this task has them.

    The pairs of a task, which are those of one array file, are held until they are put in the order of their hashes.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = _Shards(folder, bits, "pairs")
        often = np.zeros(5, np.int64)
        now, held, pairs = False, [], []

        def flush(all_of_it: bool) -> Iterator[pa.RecordBatch]:
            """Sum what is held; the last key may go on in the next batch."""
            if not held:
                return
            columns = _summed(*(np.concatenate(x) for x in zip(*held, strict=True)))
            upto = len(columns[0]) - (0 if all_of_it else 1)
            held[:] = [] if all_of_it else [[x[upto:] for x in columns]]
            if now:
                yield _parts("word", id=common.signed(columns[0][:upto]), n=columns[1][:upto])
            else:
                pairs.append([x[:upto] for x in columns])

        def close() -> Iterator[pa.RecordBatch]:
            """The pairs in the order of shard and hash."""
            if not pairs:
                return
            keys, counts, before = (np.concatenate(x) for x in zip(*pairs, strict=True))
            pairs.clear()
            second = second_words(keys, before)
            shard = pair_shards(before, second, bits)
            often[:] += np.bincount(np.minimum(counts, 5), minlength=6)[1:]
            ids, place = np.unique(np.concatenate([before, second]), return_inverse=True)
            first, second = place[:len(keys)], place[len(keys):]
            found = [np.bincount(first[mask], minlength=len(ids)) for mask in (counts == 1, counts == 2, counts > 2)]
            yield _parts("type", id=common.signed(ids), n1=found[0], n2=found[1], n3=found[2],
                         types=np.bincount(second, minlength=len(ids)))
            order = np.lexsort((keys, shard))
            files.add(keys[order], [np.minimum(counts, LARGE).astype(np.uint32)[order]], shard[order])
            if len(many := np.flatnonzero(counts >= LARGE)):
                yield _parts("large", id=common.signed(keys[many]), n=counts[many])

        for batch in batches:
            is_word = batch.column(0).is_null().to_numpy(zero_copy_only=False)
            before = batch.column(0).fill_null(0).to_numpy().view(np.uint64)
            words, counts = batch.column(1).to_numpy().view(np.uint64), batch.column(2).to_numpy()
            for kind in (False, True):
                mine = is_word == kind
                if mine.any():
                    if kind != now:
                        yield from flush(True)
                        yield from close()
                        now = kind
                    keys = words[mine] if kind else common.mix(common.mix(before[mine], 1) + words[mine])
                    held.append([keys, counts[mine], before[mine]])
            if sum(len(x[0]) for x in held) >= HELD_KEYS:
                yield from flush(False)
        yield from flush(True)
        yield from close()
        files.close()
        yield _parts("pairs", id=[s for s, _, _ in files.done], n=[n for _, _, n in files.done],
                     path=[p for _, p, _ in files.done])
        yield _parts("often", id=np.arange(1, 6), n=often)
    return run


# columns of the words' arrays, all of 64 bits; a word's count is also its count as a context
_WORD = ("n", "n1", "n2", "n3", "types")


def _write_words(folder: str, bits: int):
    """Rows of words in order -> array files of words; rows: those files, and how many words have 1, 2, .. types."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards = _Shards(folder, bits, "words")
        often = np.zeros(5, np.int64)
        counted = total = words = 0
        for batch in batches:
            keys = batch.column(0).to_numpy().view(np.uint64)
            columns = [c.to_numpy() for c in batch.columns[1:]]
            shards.add(keys, columns)
            token = keys != BEGIN
            types = columns[4][token]
            often += np.bincount(np.minimum(types, 5), minlength=6)[1:]
            counted, total, words = counted + int(columns[0][token].sum()), total + int(types.sum()), words + len(types)
        shards.close()
        yield _parts("words", id=[s for s, _, _ in shards.done], n=[n for _, _, n in shards.done],
                     path=[p for _, p, _ in shards.done])
        yield _parts("often", id=np.arange(1, 6), n=often)
        yield _parts("sum", n=[counted], types=[total], id=[words])
    return run


def discounts(often: dict[int, int]) -> tuple[float, float, float]:
    """D1, D2, D3+ from the numbers of things that occur once, twice, three and four times.

    Where too few things occur for the estimate, halves of its upper bounds.
    """
    n1, n2, n3, n4 = (often.get(k, 0) for k in (1, 2, 3, 4))
    if not (n1 and n2 and n3 and n4):
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    found = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return tuple(min(max(d, 0.01), top) for d, top in zip(found, (1.0, 2.0, 3.0), strict=True))


@dataclass
class Model:
    """Where the arrays are, and the few numbers that hold for all of them."""

    bits: int
    pairs: dict[int, tuple[str, int]]
    words: dict[int, tuple[str, int]]
    train_tokens: int
    vocabulary: int
    pair_discounts: tuple[float, float, float]
    type_discounts: tuple[float, float, float]
    types: int
    type_often: dict[int, int]
    large: dict[int, int] = field(default_factory=dict)
    _open: OrderedDict = field(default_factory=OrderedDict)

    def __getstate__(self):
        return {**self.__dict__, "_open": OrderedDict()}

    def arrays(self, kind: str, shard: int):
        """Keys and columns of a shard, views of one map; None where there is no file.

        The maps used last stay open, so that a model of any size needs few of them.
        """
        got = self._open.get((kind, shard))
        if got is not None:
            self._open.move_to_end((kind, shard))
        elif shard in (files := getattr(self, kind)):
            path, n = files[shard]
            store, local = common.opened(path)
            if isinstance(store, fs.LocalFileSystem):
                data = np.memmap(local, np.uint8, "r")
            else:
                # a store that can't be mapped: read when it is needed
                with store.open_input_stream(local) as stream:
                    data = np.frombuffer(stream.read(), np.uint8)
            keys, rest = data[:8 * n].view(np.uint64), data[8 * n:]
            if kind == "pairs":
                columns = [rest.view(np.uint32)]
            else:
                columns = list(rest.view(np.int64).reshape(len(_WORD), n))
            got = self._open[kind, shard] = (keys, columns)
            if len(self._open) > OPEN_FILES:
                self._open.popitem(last=False)
        return got

    def find(self, kind: str, sought: np.ndarray, columns: tuple[int, ...], shard: np.ndarray | None = None) -> np.ndarray:
        """Columns x sought: values of sorted keys, 0 where a key isn't there."""
        if shard is not None:
            order = np.lexsort((sought, shard))
            out = np.empty((len(columns), len(sought)), np.int64)
            out[:, order] = self._find(kind, sought[order], columns, shard[order])
            return out
        return self._find(kind, sought, columns, (sought >> np.uint64(64 - self.bits)).astype(np.int64))

    def _find(self, kind: str, sought: np.ndarray, columns: tuple[int, ...], shard: np.ndarray) -> np.ndarray:
        """The same for keys in the order of shard and key."""
        out = np.zeros((len(columns), len(sought)), np.int64)
        cuts = np.flatnonzero(np.diff(shard, prepend=-1, append=-1))
        for a, b in zip(cuts, cuts[1:], strict=False):
            if (got := self.arrays(kind, int(shard[a]))) is None:
                continue
            keys, values = got
            at = np.minimum(np.searchsorted(keys, sought[a:b]), len(keys) - 1)
            hit = keys[at] == sought[a:b]
            for k, column in enumerate(columns):
                out[k, a:b][hit] = values[column][at[hit]]
        if kind == "pairs" and self.large:
            for place in np.flatnonzero(out[0] == LARGE):
                out[0, place] = self.large[int(sought[place])]
        return out

    def lower(self, types: np.ndarray) -> np.ndarray:
        """p(w) from the number of different words before w."""
        if not self.types:
            return np.full(len(types), 1.0 / (self.vocabulary + 1))
        d = np.array([0.0, *self.type_discounts])[np.minimum(types, 3)]
        m = [self.type_often.get(k, 0) for k in (1, 2)]
        rest = self.vocabulary - m[0] - m[1]
        left = sum(a * b for a, b in zip(self.type_discounts, (*m, rest), strict=True)) / self.types
        return np.maximum(types - d, 0) / self.types + left / (self.vocabulary + 1)

    def score(self, array: pa.Array) -> list[np.ndarray]:
        """n_tokens, n_known, base_score, score of every text."""
        words, at = tokens(array)
        keys, before = pair_keys(words, at)
        own, own_at = np.unique(words, return_inverse=True)
        found = self.find("words", own, (0, 4))
        count, types = found[0][own_at], found[1]
        base = np.log10((found[0] + 0.5) / (self.train_tokens + 0.5 * (self.vocabulary + 1)))[own_at]
        pairs, pair_first, pair_at = np.unique(keys, return_index=True, return_inverse=True)
        ids, id_at = np.unique(before[pair_first], return_inverse=True)
        context, n1, n2, n3 = self.find("words", ids, (0, 1, 2, 3))
        c = self.find("pairs", pairs, (0,), pair_shards(before[pair_first], words[pair_first], self.bits))[0]
        d = np.array([0.0, *self.pair_discounts])[np.minimum(c, 3)]
        low = self.lower(types)[own_at[pair_first]]
        d1, d2, d3 = self.pair_discounts
        known = context > 0
        left = np.where(known, (d1 * n1 + d2 * n2 + d3 * n3) / np.maximum(context, 1), 1.0)
        total = np.maximum(context, 1)[id_at]
        p = np.where(known[id_at], np.maximum(c - d, 0) / total, 0.0) + left[id_at] * low
        logs = np.log10(p)[pair_at]
        return [np.diff(at), np.add.reduceat((count > 0).astype(np.int64), at[:-1]),
                np.add.reduceat(base, at[:-1]), np.add.reduceat(logs, at[:-1])]


def train(docs: DataFrame) -> Model:
    """Count the texts of all rows and write the arrays to the shared folder."""
    spark = docs.sparkSession
    common.small_batches(spark)
    folder = common.shared_folder(spark, "ngrams")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = shard_bits(size)
    shards = 1 << bits
    counted = docs.select("text").mapInArrow(_count, "before long, word long, n long")
    shard = _shard(F.coalesce("before", F.lit(0).cast("long")).bitwiseXOR(F.col("word")), bits)
    with common.shuffles_released(spark):
        parts = common.stored(
            counted.repartitionById(shards, shard).sortWithinPartitions(F.col("before").isNull(), "before", "word").mapInArrow(
                _write_counts(folder, bits), _PARTS), "ngram-parts")
    rows = parts.where("kind IN ('word', 'type')").groupBy(F.col("id").alias("word")).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in _WORD])
    made = common.stored(
        rows.repartitionById(shards, _shard(F.col("word"), bits)).sortWithinPartitions("word").mapInArrow(
            _write_words(folder, bits), _PARTS), "ngram-words")
    return _model(bits, parts, made)


def _model(bits: int, parts: DataFrame, made: DataFrame) -> Model:
    """The array files' names (two for each shard) and the sums come to the driver; nothing that grows faster."""
    def often(df: DataFrame) -> dict[int, int]:
        rows = df.where("kind = 'often'").groupBy("id").agg(F.sum("n").alias("n")).collect()
        return {r.id: r.n for r in rows}

    def files(df: DataFrame, kind: str) -> dict[int, tuple[str, int]]:
        return {r.id: (r.path, r.n) for r in df.where(F.col("kind") == kind).select("id", "path", "n").collect()}

    sums = made.where("kind = 'sum'").agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", "types", "id")]).first()
    type_often = often(made)
    large = {r.id % (1 << 64): r.n for r in parts.where("kind = 'large'").select("id", "n").collect()}
    return Model(bits, files(parts, "pairs"), files(made, "words"), sums.n, sums.id, discounts(often(parts)),
                 discounts(type_often), sums.types, type_often, large)


_SCORES = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                     ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()),
                     ("perplexity", pa.float64())])


def score(docs: DataFrame, model: Model, held_out=None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity for every row.

    base_score is the log10 probability under smoothed single words, score the one under the model,
    perplexity 10 ** (-score / n_tokens).
    """
    spark = docs.sparkSession
    common.small_batches(spark)
    sent = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            for piece in common.pieces(batch, "text", 2 * common.PIECE_BYTES):
                n_tokens, n_known, base, own = known.score(piece.column(2))
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), piece.column(1), pa.array(n_tokens), pa.array(n_known),
                     pa.array(np.full(piece.num_rows, known.train_tokens)), pa.array(base), pa.array(own),
                     pa.array(10.0 ** np.minimum(300, -own / n_tokens))], schema=_SCORES)

    flag = F.lit(False) if held_out is None else held_out
    return docs.select("doc_id", flag.alias("held_out"), "text").mapInArrow(
        run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
        "score double, perplexity double")


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    held_out = common.crc_part(F.col("doc_id"), 5) == 1
    return score(docs, train(docs.where(~held_out)), held_out)
