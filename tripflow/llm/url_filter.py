"""URL filters: rules by host and path, and for pages without a rule what the link graph says of their host.

The host of a URL is what stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; the
path goes on from there to ``?``, ``#`` or the end. A rule (host, path, verdict) fits its host and every subdomain,
for paths that begin with its path. The longest rule (host and path together) wins, then the one of the longer host;
two verdicts for one host and path count as block.

For all other pages:

* An edge goes from the host of a page to each other host that its ``<a href>`` links name with ``//`` (a ``<`` or ``>``
  in another attribute before it ends the tag); links that occur often count once.
* Trust starts at hosts in proportion to their allowed pages, distrust in proportion to their blocked ones. A host
  without pages of its own starts with the rule for all its paths, if one fits.
* Trust is the personalised PageRank along the edges: a host gets (1 - DAMPING) of its start, and of each host that
  links to it DAMPING of its score, in equal parts to all it links to. Distrust goes the other way: from a host to
  those that link to it.
* A host is blocked when its distrust is above its trust by at least ``THRESHOLD`` of what a host gets whose own pages
  are all blocked. Hosts of which nothing is known are allowed, and so are pages without a host.

Scores are whole numbers of 1 / ``UNIT``, rounded down at each edge, so runs agree to the last digit; they hold up to
10^9 hosts. Each round is a join of edges with scores and a sum, which combines in its tasks: a host that everyone
links to sends one row a task. Scores are written to the shared folder every ``WRITE_EVERY`` rounds. The rules that
fit a host go along with each of its pages, so many rules for one host make its rows large.

A NULL URL, or one without ``://``, has empty host and path, NULL html no links. Repeated rows, ties and NULL ids keep
a row each, an empty table gives none, further columns are not read. Rules without host or path count as ''.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm import common

ROUNDS = 10
DAMPING = 85  # of 100
THRESHOLD = 50  # of 100
UNIT = 100_000_000
WRITE_EVERY = 5

# The rules of the query
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_BLANK = r"\x20\x09\x0A\x0C\x0D"
_LINK = (rf"<[Aa][{_BLANK}](?:[^<>]*?[{_BLANK}\x22\x27])?[Hh][Rr][Ee][Ff][{_BLANK}]*=[{_BLANK}]*[\x22\x27]?"
         rf"(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#\x22\x27>{_BLANK}]+)")


def _div(x: Column, y: Column) -> Column:
    return F.call_function("div", x, y)


# ---- rules -------------------------------------------------------------------------------------------


def with_host(pages: DataFrame) -> DataFrame:
    """``host`` and ``path`` of the URL."""
    url = F.coalesce("url", F.lit(""))
    return pages.withColumns({"host": F.translate(F.regexp_extract(url, _URL, 1), _UPPER, _LOWER),
                              "path": F.regexp_extract(url, _URL, 2)})


def fitting(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, fits): for each host that a rule fits, those rules, the first to win first.

    A host is cut to its last 1, 2, ... labels, as many as the longest host of a rule has.
    """
    rules = rules.select(F.translate(F.coalesce("host", F.lit("")), _UPPER, _LOWER).alias("ending"),
                         F.coalesce("path", F.lit("")).alias("path"), "verdict") \
        .groupBy("ending", "path").agg(F.max("verdict").alias("verdict"))
    labels = rules.agg(F.max(F.size(F.split("ending", r"\.")))).first()[0] or 1
    endings = hosts.select("host", F.explode(F.array_distinct(F.array(
        *[F.substring_index("host", ".", -k) for k in range(1, labels + 1)]))).alias("ending"))
    found = endings.join(rules, "ending")
    one = F.struct((-F.length("ending") - F.length("path")).alias("order"), (-F.length("ending")).alias("then"), "path",
                   F.concat("ending", "path").alias("rule"), "verdict")
    return found.groupBy("host").agg(F.sort_array(F.collect_list(one)).alias("fits"))


def judged(pages: DataFrame, fits: DataFrame) -> DataFrame:
    """Pages with the rule that wins and its verdict, NULL where none fits."""
    winner = F.get(F.filter("fits", lambda r: F.startswith(F.col("path"), r["path"])), F.lit(0))
    return pages.join(fits, "host", "left").withColumn("_won", winner).select(
        *pages.columns, F.col("_won.rule").alias("rule"), F.col("_won.verdict").alias("verdict"))


# ---- the link graph ----------------------------------------------------------------------------------


def edges(pages: DataFrame) -> DataFrame:
    """(host, to): links between different hosts, each once."""
    found = with_host(pages).where(F.col("host") != "").select(
        "host", F.explode(F.array_distinct(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(_LINK), F.lit(1)))).alias("to"))
    found = found.select("host", F.translate("to", _UPPER, _LOWER).alias("to"))
    return found.where(F.col("host") != F.col("to")).distinct()


def both_ways(links: DataFrame) -> DataFrame:
    """(kind, host, to, degree): edges as trust takes them, and turned round as distrust does."""
    ways = links.select(F.lit("trust").alias("kind"), "host", "to").unionByName(
        links.select(F.lit("distrust").alias("kind"), F.col("to").alias("host"), F.col("host").alias("to")))
    degrees = ways.groupBy("kind", "host").agg(F.count("*").alias("degree"))
    return ways.join(degrees, ["kind", "host"])


def starts(told: DataFrame, linked: DataFrame, fits: DataFrame) -> DataFrame:
    """(kind, host, score): where trust and distrust start; hosts with neither have no row."""
    def share(verdict: str) -> Column:
        return _div(F.count_if(F.col("verdict") == verdict) * UNIT, F.count("*"))

    own = told.where(F.col("host") != "").groupBy("host").agg(share("allow").alias("trust"), share("block").alias("distrust"))
    whole = F.get(F.filter("fits", lambda r: r["path"].isin("", "/")), F.lit(0))["verdict"]
    others = linked.join(own, "host", "left_anti").join(fits, "host").withColumn("whole", whole).select(
        "host", F.when(F.col("whole") == "allow", UNIT).otherwise(0).cast("long").alias("trust"),
        F.when(F.col("whole") == "block", UNIT).otherwise(0).cast("long").alias("distrust"))
    return own.unionByName(others).unpivot("host", ["trust", "distrust"], "kind", "score") \
        .where(F.col("score") > 0).select("kind", "host", "score")


def propagated(ways: DataFrame, first: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(kind, host, score) after the rounds."""
    kept = first.select("kind", "host", _div(F.col("score") * (100 - DAMPING), F.lit(100)).alias("score"))
    scores = kept
    for done in range(1, rounds + 1):
        passed = ways.join(scores, ["kind", "host"]).select(
            "kind", F.col("to").alias("host"), _div(F.col("score") * DAMPING, F.col("degree") * 100).alias("score"))
        scores = kept.unionByName(passed).groupBy("kind", "host").agg(F.sum("score").alias("score"))
        if done % WRITE_EVERY == 0 and done < rounds:
            scores = common.stored(scores, "url-scores")
    return scores


def blocked(scores: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Hosts whose distrust is above their trust by the threshold."""
    balance = F.sum(F.when(F.col("kind") == "distrust", F.col("score")).otherwise(-F.col("score")))
    least = UNIT * (100 - DAMPING) // 100 * threshold // 100
    return scores.groupBy("host").agg(balance.alias("balance")).where(F.col("balance") >= least).select("host")


def judge(pages: DataFrame, rules: DataFrame, rounds: int = ROUNDS, threshold: int = THRESHOLD) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every page."""
    links = common.stored(edges(pages), "url-links")
    own = with_host(pages.select("page_id", "url")).select("page_id", "host", "path")
    linked = links.select("host").union(links.select("to")).distinct()
    fits = common.stored(fitting(own.select("host").union(linked).distinct(), rules), "url-rules")
    told = common.stored(judged(own, fits), "url-pages")
    ways = common.stored(both_ways(links), "url-ways")
    bad = blocked(propagated(ways, common.stored(starts(told, linked, fits), "url-starts"), rounds), threshold)
    return told.join(bad.withColumn("bad", F.lit(True)), "host", "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("verdict", F.when(F.col("bad"), "block").otherwise("allow")).alias("verdict"))


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return judge(common.table(spark, sf_dir, "pages"), rules)


def _sql() -> str:
    """The same over the fixed rules: a pair of tables for each round."""
    rules = ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in RULES)
    link = _LINK.replace("'", "''")
    steps, last = [], "s0"
    for n in range(1, ROUNDS + 1):
        steps.append(f"""s{n} AS MATERIALIZED (SELECT kind, host, sum(score)::BIGINT AS score FROM (
  SELECT * FROM s0 UNION ALL
  SELECT ways.kind, ways.dst, x.score * {DAMPING} // (ways.degree * 100) FROM ways JOIN {last} x ON x.kind = ways.kind AND x.host = ways.host)
  GROUP BY kind, host)""")
        last = f"s{n}"
    return rf"""
WITH rules(host, path, verdict) AS (VALUES {rules}),
pages_ AS (SELECT row_number() OVER () AS r, page_id, coalesce(html, '') AS html,
  translate(regexp_extract(coalesce(url, ''), '{_URL}', 1), '{_UPPER}', '{_LOWER}') AS host,
  regexp_extract(coalesce(url, ''), '{_URL}', 2) AS path FROM pages),
links AS (SELECT DISTINCT host, dst FROM (
  SELECT host, translate(unnest(regexp_extract_all(html, '{link}', 1)), '{_UPPER}', '{_LOWER}') AS dst FROM pages_ WHERE host <> '')
  WHERE host <> dst),
fit AS (SELECT p.r, r.host || r.path AS rule, r.verdict, row_number() OVER (
    PARTITION BY p.r ORDER BY length(r.host) + length(r.path) DESC, length(r.host) DESC, r.verdict DESC) AS n
  FROM pages_ p JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)),
told AS (SELECT p.*, f.rule, f.verdict FROM pages_ p LEFT JOIN fit f ON f.r = p.r AND f.n = 1),
own AS (SELECT host, {UNIT}::BIGINT * count(*) FILTER (verdict = 'allow') // count(*) AS trust,
  {UNIT}::BIGINT * count(*) FILTER (verdict = 'block') // count(*) AS distrust FROM told WHERE host <> '' GROUP BY host),
others AS (SELECT h.host, r.verdict, row_number() OVER (
    PARTITION BY h.host ORDER BY length(r.host) + length(r.path) DESC, length(r.host) DESC, r.verdict DESC) AS n
  FROM (SELECT host FROM links UNION SELECT dst FROM links) h
  JOIN rules r ON (h.host = r.host OR ends_with(h.host, '.' || r.host)) AND r.path IN ('', '/')
  WHERE h.host NOT IN (SELECT host FROM own)),
first AS (SELECT 'trust' AS kind, host, trust AS score FROM own UNION ALL SELECT 'distrust', host, distrust FROM own UNION ALL
  SELECT CASE verdict WHEN 'allow' THEN 'trust' ELSE 'distrust' END, host, {UNIT}::BIGINT FROM others WHERE n = 1),
s0 AS (SELECT kind, host, score * {100 - DAMPING} // 100 AS score FROM first WHERE score > 0),
turned AS (SELECT 'trust' AS kind, host, dst FROM links UNION ALL SELECT 'distrust', dst, host FROM links),
ways AS (SELECT *, count(*) OVER (PARTITION BY kind, host) AS degree FROM turned),
{", ".join(steps)},
bad AS (SELECT host FROM {last} GROUP BY host
  HAVING sum(CASE kind WHEN 'distrust' THEN score ELSE -score END) >= {UNIT * (100 - DAMPING) // 100 * THRESHOLD // 100})
SELECT page_id, host, path, rule,
  coalesce(verdict, CASE WHEN host IN (SELECT host FROM bad) THEN 'block' ELSE 'allow' END) AS verdict FROM told"""


SQL = {"op12_url_filter": _sql()}
