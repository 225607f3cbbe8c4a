"""Near duplicates by fast similarity sketching.

Sketch: rounds of hashed bin placement. In round i every shingle is thrown into a random bin with a value in
[i, i + 1); a bin keeps its smallest value. Rounds go on until every bin is filled; after t rounds the
bins are filled one by one with the smallest value of a round each, so that every coordinate is filled
whatever the size of the set. Coordinates of two sets agree with probability equal to their similarity.

Banding: groups of coordinates are hashed to buckets; the number of bands follows from the wanted
probability of missing a pair at the threshold (``MISS``).

Verification, on full shingle sets, never on sketches:

* Rows with equal sets (128 bits of set hash and size) are one node; what follows sees each node once.
* Buckets of at most ``SMALL`` nodes give pairs; those whose sketches lie six deviations below the threshold go, the
  others are compared.
* Larger buckets are compared in blocks: the bucket's smallest node names a cluster, the cluster's members
  are dealt into blocks of about ``BLOCK`` members, and each pair of blocks is a group that counts shared
  shingles by a product of incidence matrices. It returns a spanning forest of its links, so the output is
  linear in the members though every pair of a bucket is compared.

Components of the links are found by alternating large and small stars.

Results for special rows: a NULL or empty text, or one without words, has an empty set and is linked with
nothing (its component_id is its own id); a text with fewer words than a shingle is one shingle, its whole
sequence; a NULL id is an id without order: it is a component_id only where no row of the component has
another; repeated rows are rows of their own, and each that bears the component's id counts as kept; an empty
table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm import common

#: coordinates in a band
ROWS = 6
#: wanted probability that a pair just at the threshold shares no bucket
MISS = 1e-8
#: representatives in a bucket that are compared pair by pair
SMALL = 24
#: members of a block in a large bucket's cluster
BLOCK = 256
#: shingles of one product of incidence matrices
COLUMNS = 8192
MAX_STAR_ROUNDS = 60


def bands(threshold: float) -> int:
    """Bands for the threshold: (1 - threshold ** ROWS) ** bands is at most MISS."""
    return math.ceil(math.log(MISS) / math.log(1 - threshold ** ROWS))


def shingles(array: pa.Array, width: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the word shingles of every text."""
    hashes, first = common.words(array)
    n = len(hashes)
    joined = common.mix(hashes, 1)
    for k in range(1, width):
        shifted = np.zeros(n, np.uint64)
        shifted[:n - k] = hashes[k:] if n > k else 0
        joined = common.mix(joined ^ common.mix(shifted, k + 1), 7)
    out = []
    for i in range(len(first) - 1):
        a, b = first[i], first[i + 1]
        if b - a >= width:
            out.append(np.unique(joined[a:b - width + 1]))
        elif b > a:
            whole = np.uint64(b - a)
            for h in hashes[a:b]:
                whole = common.mix(np.array([whole ^ h], np.uint64), 5)[0]
            out.append(np.array([whole], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def sketches(sets: list[np.ndarray], t: int) -> np.ndarray:
    """Fast similarity sketches (sets x t). Sets must not be empty."""
    m = len(sets)
    if not m:
        return np.zeros((0, t), np.uint64)
    out = np.full(m * t, np.iinfo(np.uint64).max, np.uint64)
    sizes = np.array([len(s) for s in sets])
    items = np.concatenate(sets)
    owner = np.repeat(np.arange(m), sizes)
    for i in range(2 * t):
        if not len(items):
            break
        h = common.mix(items, 100 + i)
        value = (h >> np.uint64(32)) | np.uint64(i) << np.uint64(32)
        place = ((h & np.uint64(0xFFFFFFFF)) * np.uint64(t) >> np.uint64(32)).astype(np.int64) if i < t else i - t
        np.minimum.at(out, owner * t + place, value)
        filled = (out.reshape(m, t) < np.iinfo(np.uint64).max).all(axis=1)
        if filled.any():
            open_ = ~filled[owner]
            items, owner = items[open_], owner[open_]
    return out.reshape(m, t)


def node_ids(sets: list[np.ndarray]) -> np.ndarray:
    """64 bits that stand for a set, whatever its order."""
    high = np.array([common.mix(s, 21).sum(dtype=np.uint64) for s in sets], np.uint64)
    low = np.array([common.mix(s, 22).sum(dtype=np.uint64) for s in sets], np.uint64)
    sizes = np.array([len(s) for s in sets], np.uint64)
    return common.signed(common.mix(high ^ common.mix(low ^ common.mix(sizes, 23), 24), 25))


def _sketched(width: int, n_bands: int):
    """doc_id, text_hash, n_shingles, node (NULL for the empty set), a byte of each coordinate, the hash of each band."""
    t = n_bands * ROWS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in common.pieces(batch, "text", common.PIECE_BYTES // 2):
                sets = shingles(piece.column(1), width)
                sizes = np.array([len(s) for s in sets], np.int64)
                full = np.flatnonzero(sizes)
                sketch = sketches([sets[i] for i in full], t)
                keys = np.zeros((len(full), n_bands), np.uint64)
                for r in range(ROWS):
                    keys = common.mix(keys ^ sketch[:, r::ROWS], r)
                keys = common.mix(keys ^ np.arange(n_bands, dtype=np.uint64), 77)
                byte = (common.mix(sketch) & np.uint64(255)).astype(np.uint8)
                sketch_of = [None] * len(sets)
                keys_of = [None] * len(sets)
                for k, i in enumerate(full):
                    sketch_of[i], keys_of[i] = byte[k].tobytes(), common.signed(keys[k])
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), piece.column(2), pa.array(sizes), pa.array(node_ids(sets), mask=sizes == 0),
                     pa.array(sketch_of, pa.binary()), pa.array(keys_of, pa.list_(pa.int64()))],
                    ["doc_id", "text_hash", "n_shingles", "node", "sketch", "keys"])
    return run


def _confirmed(width: int):
    """Rows of (node, text) whose text has the node's set: ids may repeat with other texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in common.pieces(batch, "text"):
                same = node_ids(shingles(piece.column(1), width)) == piece.column(0).to_numpy()
                yield piece.filter(pa.array(same))
    return run


def _verify(width: int, threshold_100: int):
    """Pairs with both texts -> the pairs that are links."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in common.pieces(batch, "text_a"):
                left, right = shingles(piece.column(2), width), shingles(piece.column(3), width)
                keep = []
                for x, y in zip(left, right, strict=True):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(100 * both >= threshold_100 * (len(x) + len(y) - both) and both > 0)
                kept = piece.filter(pa.array(keep, pa.bool_()))
                yield pa.RecordBatch.from_arrays([kept.column(0), kept.column(1)], ["a", "b"])
    return run


def _forest(links: np.ndarray) -> np.ndarray:
    """Of links (k x 2) a subset that joins what they join."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    keep = []
    for k, (a, b) in enumerate(links):
        ra, rb = find(int(a)), find(int(b))
        if ra != rb:
            root[max(ra, rb)] = min(ra, rb)
            keep.append(k)
    return links[keep]


def linked(left: list[np.ndarray], right: list[np.ndarray], threshold_100: int) -> np.ndarray:
    """left x right: whether two sets reach the threshold. Shared shingles are counted by products of incidence
    matrices, a stretch of the shingles at a time."""
    shared = np.zeros((len(left), len(right)), np.float32)
    sizes = [np.array([len(s) for s in side], np.int64) for side in (left, right)]
    a, b = np.concatenate(left), np.concatenate(right)
    both = np.intersect1d(a, b)
    spots = []
    for side, items, size in ((left, a, sizes[0]), (right, b, sizes[1])):
        at = np.searchsorted(both, items)
        hit = at < len(both)
        hit[hit] = both[at[hit]] == items[hit]
        spots.append((np.repeat(np.arange(len(side)), size)[hit], at[hit]))
    for begin in range(0, len(both), COLUMNS):
        parts = []
        for (row, column), side in zip(spots, (left, right), strict=True):
            here = (column >= begin) & (column < begin + COLUMNS)
            m = np.zeros((len(side), min(COLUMNS, len(both) - begin)), np.float32)
            m[row[here], column[here] - begin] = 1
            parts.append(m)
        shared += parts[0] @ parts[1].T
    union = sizes[0][:, None] + sizes[1][None, :] - shared
    return (100 * shared >= threshold_100 * union) & (shared > 0)


def _blocks(width: int, threshold_100: int):
    """The texts of two blocks of a cluster -> links between them, as a forest."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        sides = []
        first, second = group["block_a"].iloc[0], group["block_b"].iloc[0]
        for block in (first, second):
            part = group[group["block"] == block].sort_values("node")
            sides.append((part["node"].to_numpy(), shingles(pa.array(part["text"]), width)))
        (left, left_sets), (right, right_sets) = sides
        if not len(left) or not len(right):
            return pd.DataFrame({"a": pd.Series(dtype="int64"), "b": pd.Series(dtype="int64")})
        x, y = np.nonzero(linked(left_sets, right_sets, threshold_100))
        links = np.stack([left[x], right[y]], axis=1)
        links = _forest(links[links[:, 0] != links[:, 1]])
        return pd.DataFrame({"a": links[:, 0], "b": links[:, 1]})
    return run


def links(docs: DataFrame, sketched: DataFrame, width: int, threshold: float) -> DataFrame:
    """Links (a, b) between nodes; they join what all links of the threshold join."""
    threshold_100, n_bands = round(threshold * 100), bands(threshold)
    rows = sketched.select("node", F.explode("keys").alias("key")).distinct()
    rows = common.stored(rows, "bands")
    buckets = rows.groupBy("key").agg(F.count("*").alias("members"), F.min("node").alias("leader"))
    shared = common.stored(rows.join(buckets.where("members > 1"), "key"), "buckets")
    small = shared.where(F.col("members") <= SMALL)
    pairs = small.select("key", F.col("node").alias("a")).join(
        small.select("key", F.col("node").alias("b")), "key").where("a < b").select("a", "b").distinct()
    t = n_bands * ROWS
    least = t * (threshold - 6 * math.sqrt(threshold * (1 - threshold) / t))
    nodes = common.stored(sketched.where("node IS NOT NULL").groupBy("node").agg(
        F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch")), "nodes")
    side = nodes.select("node", "n", "sketch")
    pairs = pairs.join(side.toDF("a", "n_a", "sketch_a"), "a").join(side.toDF("b", "n_b", "sketch_b"), "b").where(
        F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * threshold_100)
    pairs = common.stored(pairs.mapInArrow(_alike(least), "a long, b long"), "pairs")
    members = common.stored(
        shared.where(F.col("members") > SMALL).select("leader", "node").distinct(), "members")
    needed = pairs.select("a").union(pairs.select("b")).union(members.select("node")).toDF("node").distinct()
    needed = needed.join(nodes.select("node", "rep"), "node")
    texts = docs.select("doc_id", "text").join(needed, F.expr("doc_id <=> rep")).select("node", "text").mapInArrow(
        _confirmed(width), "node long, text string")
    texts = common.stored(texts.dropDuplicates(["node"]), "texts")
    near = pairs.join(texts.toDF("a", "text_a"), "a").join(texts.toDF("b", "text_b"), "b").select(
        "a", "b", "text_a", "text_b").mapInArrow(_verify(width, threshold_100), "a long, b long")
    # large buckets: clusters by leader, cut into blocks
    sizes = members.groupBy("leader").agg(F.count("*").alias("size"))
    members = members.join(sizes, "leader").withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int"))
    members = members.withColumn("block", F.pmod(F.hash("node"), F.col("blocks"))).join(texts, "node")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = members.select("leader", "node", "text", "block", other.alias("other")).select(
        "leader", "node", "text", "block", F.least("block", "other").alias("block_a"),
        F.greatest("block", "other").alias("block_b"))
    far = dealt.groupBy("leader", "block_a", "block_b").applyInPandas(
        _blocks(width, threshold_100), "a long, b long")
    return common.stored(near.union(far), "links")


def _alike(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            a, b = (np.frombuffer(b"".join(batch.column(batch.schema.get_field_index(c)).to_pylist()), np.uint8)
                    .reshape(n, -1) for c in ("sketch_a", "sketch_b"))
            keep = pa.array((a == b).sum(axis=1) >= least)
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(c)).filter(keep)
                                              for c in ("a", "b")], ["a", "b"])
    return run


def components(edges: DataFrame) -> DataFrame:
    """node, component (smallest node reachable) for every node of the edges (a, b)."""
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = common.stored(edges, "edges")
    before = None
    for _ in range(MAX_STAR_ROUNDS):
        # large star: every larger neighbour moves to the smallest one around
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: a node and its smaller neighbours move to the smallest of these
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = common.stored(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        now = edges.agg(F.count("*"), F.sum(F.hash("u", "v"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components didn't settle in {MAX_STAR_ROUNDS} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select("v", "v").distinct())


def near_duplicates(docs: DataFrame, width: int = 5, threshold: float = 0.8) -> DataFrame:
    """doc_id, text_hash, n_shingles, class_id (smallest id with the same set), component_id (smallest id that can be
    reached by links), kept (its id is the component's) for every row."""
    common.small_batches(docs.sparkSession)
    sketched = common.stored(docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).mapInArrow(
        _sketched(width, bands(threshold)),
        "doc_id long, text_hash long, n_shingles long, node long, sketch binary, keys array<long>"), "sketches")
    classes = sketched.where("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("class_id"))
    found = components(links(docs, sketched, width, threshold))
    classes = classes.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = classes.groupBy("component").agg(F.min("class_id").alias("component_id"))
    classes = classes.join(least, "component").drop("component")
    own = F.col("node").isNull()
    joined = sketched.select("doc_id", "text_hash", "n_shingles", "node").join(classes.withColumnRenamed("node", "of"),
                                                                 F.expr("node = of"), "left")
    return joined.select(
        "doc_id", "text_hash", "n_shingles", F.when(own, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(own, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")).withColumn(
            "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one(docs: DataFrame, width: int = 5, threshold: float = 0.8) -> DataFrame:
    """The rows with their component's smallest id (of those that repeat id and text one), all columns as they are."""
    stay = near_duplicates(docs, width, threshold).where("kept").select("doc_id", F.col("text_hash").alias("digest"))
    return common.keep_rows(docs, stay, F.xxhash64("text"))


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(common.table(spark, sf_dir, "documents"), width=3, threshold=0.85).drop(
        "class_id", "text_hash")


SQL = {"op9_near_dedup": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE [array_to_string(w[i:i + 2], ' ') FOR i IN range(1, len(w) - 1)] END) AS shingle FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
-- a link's sets differ in few shingles, so it shares one of the rarest ones of its smaller set
ranked AS (
  SELECT s.doc_id, s.shingle, z.n, row_number() OVER (PARTITION BY s.doc_id ORDER BY f.c, s.shingle) AS k
  FROM sets s JOIN sizes z USING (doc_id) JOIN (SELECT shingle, count(*) AS c FROM sets GROUP BY 1) f USING (shingle)),
prefix AS (SELECT * FROM ranked WHERE k <= n - ceil(0.85 * n) + 1),
candidates AS (
  SELECT DISTINCT a.doc_id AS x, b.doc_id AS y FROM prefix a JOIN prefix b ON a.shingle = b.shingle AND a.doc_id < b.doc_id),
links AS (
  SELECT x, y FROM (
    SELECT c.x, c.y, count(*) AS common FROM candidates c JOIN sets a ON a.doc_id = c.x JOIN sets b ON b.doc_id = c.y AND b.shingle = a.shingle
    GROUP BY c.x, c.y) p JOIN sizes i ON i.doc_id = p.x JOIN sizes j ON j.doc_id = p.y
  WHERE 100 * common >= 85 * (i.n + j.n - common)),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, e.y FROM reach r JOIN edges e ON e.x = r.y),
low AS (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x)
SELECT d.doc_id, coalesce(z.n, 0) AS n_shingles, l.component_id, d.doc_id = l.component_id AS kept
FROM documents d LEFT JOIN sizes z USING (doc_id) JOIN low l USING (doc_id)"""}
