"""Mixing sources to target weights by a low-discrepancy schedule.

A source of some words is cut into blocks of ``BLOCK_WORDS`` words, a small one into ``LEAST_BLOCKS`` blocks (of one word
at least), and gets as many of the n slots as uses of its blocks make up its target; at least one, and no more
than ``cap`` passes over it. Slot i of the mix lies at the golden-ratio point frac(i * a / n), where a is a number near
n / phi without a common divisor with n: the n points are then n different n-ths, so that mapped through the
cumulative numbers of slots every source is named exactly as often as it has slots, evenly spread. The slots of a
source are ranked, and rank r takes block r (modulo the number of blocks) of that source's documents, which
are shuffled by hash and cut into blocks of equal tokens. A source's documents form one stream of words, so a block may begin and end
inside a document.

Everything is DataFrame functions. A source of any size is cut: documents by hash into buckets and slots by
number into chunks, whose sums give the places by a window over the sums; no window holds a whole source.

Results for special rows: a NULL text has size 0 and takes nothing; NULL is a source like any other, last
in order; a NULL id is an id; repeated rows are documents of their own (they take their own places in
the stream, in any order among themselves); an empty table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripflow.functions.once import compute_once
from tripflow.llm import common

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2.0
BLOCK_WORDS = 32
#: blocks of a source that has too few words for blocks of full size
LEAST_BLOCKS = 40
#: documents of a source in one window, about
BUCKET_ROWS = 2_000
#: consecutive slots in one window at most, as a power of two
CHUNK_BITS = 15
#: slots made from one row
TASK_SLOTS = 1 << 19
#: fraction of the golden ratio (a fixed value)
GOLDEN = 0.6180339887498949
#: numbers on either side of n / phi that are tried; among so many some have no common divisor with n below 2 ** 62
NEIGHBOURS = 200


def size(text: Column) -> Column:
    """Number of words of a text."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """source, n_docs, source_size, target: shares by weight, none above ``cap`` times its source.

    A source is at its cap exactly when the words per weight of those below it would give it more. With
    sources in order of size / weight, the first k are capped for the smallest k at which the rest gets no more than
    its caps; running sums over the sources (a row each) give every k at once.
    """
    per = sizes.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    nth = F.row_number().over(by_name) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (nth % len(weights) + 1).cast("int"))
    per = per.withColumn("nth", nth).withColumn("weight", weight)
    per = per.withColumn("most", cap * F.col("source_size"))
    full = Window.partitionBy()
    order = Window.orderBy(F.col("most") / F.col("weight"), "nth")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest_words = (share * F.sum("source_size").over(full)
                  - F.coalesce(F.sum("most").over(before), F.lit(0.0)))
    rest_weight = F.sum("weight").over(full) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    # words per weight if exactly the sources before this one are capped
    per = per.withColumn("level", rest_words / rest_weight)
    per = per.withColumn("below", F.col("most") >= F.col("level") * F.col("weight"))
    level = F.min(F.when(F.col("below"), F.struct(F.col("most") / F.col("weight"), "nth", "level"))).over(full)
    per = per.withColumn("final", level)
    return per.select("source", "nth", "n_docs", "source_size", F.least(
        F.col("most"), F.coalesce(F.col("final.level") * F.col("weight"), F.col("most"))).alias("target"))


def place_documents(sizes: DataFrame, sources: DataFrame) -> DataFrame:
    """nth, row columns, size, begin: where each document begins in its source's shuffled stream of words."""
    digest = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    key = F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")
    docs = sizes.join(sources, F.expr("source <=> source_name")).drop("source_name")
    docs = docs.withColumn("hash", key).withColumn(
        "bucket", F.pmod(F.shiftright("hash", 20), F.ceil(F.col("n_docs") / BUCKET_ROWS)))
    sums = docs.groupBy("nth", "bucket").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("nth").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("nth").alias("at_nth"), F.col("bucket").alias("at_bucket"),
                       F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy("nth", "bucket").orderBy("hash", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, -1)
    docs = docs.withColumn("inner", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    return docs.join(sums, F.expr("nth = at_nth AND bucket = at_bucket")).withColumn(
        "begin", F.col("base") + F.col("inner")).drop("at_nth", "at_bucket", "base", "inner", "hash", "bucket")


def stride(n: int) -> int:
    """A number near n / phi without a common divisor with n: the one whose quotients of the Euclidean algorithm have
    the least sum, which bounds how far any run of points a * i / n is from even."""
    near = int(n * GOLDEN)
    best = None
    for a in range(max(1, near - NEIGHBOURS), min(n, near + NEIGHBOURS) + 1):
        x, y, quotients = n, a, 0
        while y:
            quotients += x // y
            x, y = y, x % y
        if x == 1:
            best = min(best or (quotients, abs(a - near), a), (quotients, abs(a - near), a))
    return best[2]


def times_modulo(x: Column, c: int, n: int) -> Column:
    """x * c modulo n of whole numbers 0 <= x, c < n; no product leaves its type."""
    if n <= 1 << 31:
        return x * c % n
    if n <= 1 << 40:
        high, low = F.shiftright(x, 20), x.bitwiseAND(F.lit((1 << 20) - 1))
        return (high * c % n * (1 << 20) + low * c) % n
    wide = "decimal(19,0)"
    return (x.cast(wide) * F.lit(c).cast(wide) % F.lit(n).cast(wide)).cast("long")


def block_words(source_size: Column, block: int = BLOCK_WORDS) -> Column:
    """Words of a block of a source."""
    return F.least(F.lit(block), F.greatest(F.lit(1), F.floor(source_size / LEAST_BLOCKS))).cast("long")


def schedule(spark: SparkSession, sources: DataFrame, block: int = BLOCK_WORDS) -> DataFrame:
    """slot, nth, rank: the source of every slot, and its rank among the slots of that source.

    ``sources`` has nth and slots, or nth and target (words, of which a slot takes ``block``). Sources lie one after another on the
    n places; place p is the point of slot p * (1 / a) modulo n. So every source makes its own slots, in rows of ``TASK_SLOTS``
    places that are dealt over all tasks: no slot looks for its source, however many sources there are.
    """
    if "slots" not in sources.columns:
        sources = sources.withColumn("slots", F.round(F.col("target") / block).cast("long"))
    steps = Window.orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    places = sources.where("slots > 0").select("nth", "slots", (F.sum("slots").over(steps) - F.col("slots")).alias("from"))
    n = places.agg(F.sum("slots")).first()[0] or 1
    tasks = max(spark.sparkContext.defaultParallelism, -(-n // TASK_SLOTS))
    parts = places.select("nth", "slots", "from", F.explode(F.sequence(
        F.lit(0), F.floor((F.col("slots") - 1) / TASK_SLOTS))).alias("part")).repartition(tasks, "nth", "part")
    first = F.col("part") * TASK_SLOTS
    last = F.least(F.col("slots"), first + TASK_SLOTS) - 1
    points = parts.select("nth", F.explode(F.sequence(F.col("from") + first, F.col("from") + last)).alias("place"))
    inverse = pow(stride(n), -1, n) if n > 1 else 0
    points = compute_once(points, {"slot": times_modulo(F.col("place"), inverse, n)})
    # the slots once for their counts and their ranks
    points = common.stored(points.select(F.shiftright("slot", CHUNK_BITS).alias("chunk"), "slot", "nth"), "slots")
    counts = points.groupBy("nth", "chunk").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("nth").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(F.col("nth").alias("at_nth"), F.col("chunk").alias("at_chunk"),
                           F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    inside = F.row_number().over(Window.partitionBy("nth", "chunk").orderBy("slot")) - 1
    return points.withColumn("inner", inside).join(
        counts, F.expr("nth = at_nth AND chunk = at_chunk")).select(
            "slot", "nth", (F.col("base") + F.col("inner")).alias("rank"))


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP,
        block: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, source, size, source_size, target, taken for every row: words the mix takes of it, repeats counted."""
    spark = docs.sparkSession
    sizes = common.stored(docs.select("doc_id", "source", size(F.col("text")).alias("size")), "sizes")
    sources = common.stored(targets(sizes, weights, share, cap), "targets")
    placed = place_documents(sizes, sources.select(
        F.col("source").alias("source_name"), "nth", "n_docs", "source_size", "target"))
    placed = common.stored(placed.withColumn("row", F.monotonically_increasing_id()), "placed")
    step = block_words(F.col("source_size"), block)
    blocks = F.ceil(F.col("source_size") / step)
    uses = F.round(F.col("target") * blocks / F.col("source_size"))
    wanted = F.when(F.col("target") > 0, F.least(F.greatest(uses, F.lit(1.0)), F.floor(blocks * cap))).cast("long")
    per = sources.where("source_size > 0").select("nth", blocks.alias("blocks"), wanted.alias("slots"))
    slots = schedule(spark, per.select("nth", "slots"), block).join(per.select("nth", "blocks"), "nth")
    uses = slots.groupBy("nth", (F.col("rank") % F.col("blocks")).alias("block")).agg(F.count("*").alias("uses"))
    parts = placed.where("size > 0").withColumn("step", step).select(
        "row", "nth", "begin", "size", "step", F.explode(F.sequence(
            F.floor(F.col("begin") / F.col("step")),
            F.floor((F.col("begin") + F.col("size") - 1) / F.col("step")))).alias("block"))
    words = F.least(F.col("begin") + F.col("size"), (F.col("block") + 1) * F.col("step")) - F.greatest(
        F.col("begin"), F.col("block") * F.col("step"))
    # merged, not broadcast: a long document has far more parts than its row's size tells
    taken = parts.join(uses.hint("merge"), ["nth", "block"]).groupBy("row").agg(F.sum(words * F.col("uses")).alias("taken"))
    return placed.join(taken, "row", "left").select(
        "doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(common.table(spark, sf_dir, "documents")).drop("source")


SQL = {"op4_mixing": f"""
WITH RECURSIVE sizes AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size FROM documents),
per AS (
  SELECT source, n_docs, source_size, nth, CAST([3, 1, 2][nth % 3 + 1] AS DOUBLE) AS weight,
         2.0::DOUBLE * source_size AS most
  FROM (SELECT source, count(*) AS n_docs, sum(size)::BIGINT AS source_size,
               row_number() OVER (ORDER BY source IS NULL, source) - 1 AS nth FROM sizes GROUP BY source)),
-- give by weight, fix the sources above their cap there, reshare the rest
rounds AS (
  SELECT 0 AS round, nth, CAST(NULL AS DOUBLE) AS capped FROM per
  UNION ALL
  SELECT round + 1, nth, CASE WHEN capped IS NULL AND most < level * weight THEN most ELSE capped END
  FROM (SELECT r.round, r.nth, r.capped, p.most, p.weight,
               (1.5::DOUBLE * sum(p.source_size) OVER () - sum(coalesce(r.capped, 0.0)) OVER ())
               / sum(CASE WHEN r.capped IS NULL THEN p.weight ELSE 0.0 END) OVER () AS level
        FROM rounds r JOIN per p ON p.nth = r.nth)
  WHERE round <= (SELECT count(*) FROM per)),
last AS (SELECT nth, capped FROM rounds WHERE round = (SELECT max(round) FROM rounds)),
targets AS (
  SELECT p.*, coalesce(l.capped, p.weight * (1.5::DOUBLE * sum(source_size) OVER () - sum(coalesce(capped, 0.0)) OVER ())
                       / sum(CASE WHEN capped IS NULL THEN weight ELSE 0.0 END) OVER ()) AS target
  FROM per p JOIN last l ON l.nth = p.nth),
docs AS (
  SELECT s.doc_id, s.size, t.nth, t.source_size, t.target, t.n_docs,
         CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 15) AS BIGINT) AS hash
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
placed AS (
  SELECT *, row_number() OVER () AS row, coalesce(sum(size) OVER (
    PARTITION BY nth ORDER BY (hash >> 20) % CAST(ceil(n_docs / {BUCKET_ROWS}.0) AS BIGINT), hash, doc_id, size
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM docs),
steps AS (
  SELECT nth, source_size, target, greatest(1, least({BLOCK_WORDS}, source_size // {LEAST_BLOCKS})) AS step
  FROM targets WHERE source_size > 0),
cut AS (
  SELECT nth, step, blocks, least(greatest(round(target * blocks / source_size), 1), 2 * blocks)::BIGINT AS slots
  FROM (SELECT *, CAST(ceil(source_size / step) AS BIGINT) AS blocks FROM steps)),
bounds AS (SELECT nth, blocks, sum(slots) OVER (ORDER BY nth) AS upto FROM cut),
n AS (SELECT coalesce(sum(slots), 1)::BIGINT AS n, CAST(floor(coalesce(sum(slots), 1)::BIGINT * {GOLDEN}::DOUBLE) AS BIGINT) AS near FROM cut),
euclid AS (
  SELECT n, near, k, n AS x, k AS y, 0::BIGINT AS quotients
  FROM (SELECT *, unnest(range(greatest(1, near - {NEIGHBOURS}), least(n, near + {NEIGHBOURS}) + 1)) AS k FROM n)
  UNION ALL SELECT n, near, k, y, x % y, quotients + x // y FROM euclid WHERE y > 0),
stride AS (SELECT n, k FROM euclid WHERE y = 0 AND x = 1 ORDER BY quotients, abs(k - near), k LIMIT 1),
slots AS (SELECT slot, (CAST(slot AS HUGEINT) * k) % n AS place FROM stride, range(n) r(slot)),
ranked AS (
  SELECT b.nth, b.blocks, row_number() OVER (PARTITION BY b.nth ORDER BY slot) - 1 AS rank
  FROM slots ASOF JOIN bounds b ON slots.place < b.upto),
uses AS (SELECT nth, rank % blocks AS block, count(*) AS uses FROM ranked GROUP BY ALL),
taken AS (
  SELECT row, sum((least(start + size, (u.block + 1) * step) - greatest(start, u.block * step)) * uses) AS taken
  FROM (SELECT p.*, c.step, unnest(range(start // c.step, (start + size - 1) // c.step + 1)) AS block
        FROM placed p JOIN cut c ON c.nth = p.nth WHERE size > 0) p
  JOIN uses u ON u.nth = p.nth AND u.block = p.block GROUP BY row)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, CAST(coalesce(taken, 0) AS BIGINT) AS taken
FROM placed LEFT JOIN taken USING (row)"""}
