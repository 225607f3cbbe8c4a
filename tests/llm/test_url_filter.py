"""Rules and propagation against plain Python, and the query's SQL over pages with links."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest

from tripflow.llm import url_filter as U

PAGES = "page_id long, url string, html string"


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match("[^/?#]*", rest).group()
    path = re.match("[^?#]*", rest[len(host):], re.S).group()
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def winner(host, path, rules):
    fits = [(len(h) + len(p), len(h), v, h + p) for h, p, v in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[3:1:-1] if fits else (None, None)


def expected(pages, rules, rounds=U.ROUNDS):
    hosts = [split(url) for _, url, _ in pages]
    told = [winner(*x, rules) for x in hosts]
    links = {(host, to.lower()) for (host, _), (_, _, html) in zip(hosts, pages) if host
             for to in re.findall(r"<a href=\"(?:https?:)?//([^/\"]+)", html or "") if to.lower() != host}
    total, start = Counter(h for h, _ in hosts if h), {"trust": Counter(), "distrust": Counter()}
    for kind, verdict in (("trust", "allow"), ("distrust", "block")):
        for host, n in Counter(h for (h, _), (_, v) in zip(hosts, told) if h and v == verdict).items():
            start[kind][host] = U.UNIT * n // total[host]
    for host in {h for link in links for h in link} - set(total):
        verdict = winner(host, "/", [r for r in rules if r[1] in ("", "/")])[1]
        if verdict:
            start["trust" if verdict == "allow" else "distrust"][host] = U.UNIT
    score = {}
    for kind, ways in (("trust", links), ("distrust", {(b, a) for a, b in links})):
        kept = {h: s * 15 // 100 for h, s in start[kind].items()}
        degree, now = Counter(a for a, _ in ways), dict(kept)
        for _ in range(rounds):
            after = defaultdict(int, kept)
            for a, b in ways:
                after[b] += now.get(a, 0) * 85 // (degree[a] * 100)
            now = after
        score[kind] = now
    bad = {h for h in score["distrust"] if score["distrust"][h] - score["trust"].get(h, 0) >= U.UNIT * 15 // 100 // 2}
    return sorted(((p, h, path, rule, verdict or ("block" if h in bad else "allow"))
                   for (p, _, _), (h, path), (rule, verdict) in zip(pages, hosts, told)), key=repr)


def web(n, seed):
    """Pages of some hosts; one host is linked by everyone, spam links to spam."""
    chance = random.Random(seed)
    hosts = [f"{s}{chance.choice(['a.', 'www.', ''])}h{i}.{end}" for i in range(25) for s, end in
             [(chance.choice(["", "m."]), chance.choice(["com", "net", "org", "example.com", "spam.io"]))]]
    for i in range(n):
        links = [chance.choice(hosts) for _ in range(chance.randrange(4))] + ["Hub.org"] * (i % 3) + ["bad.spam.io"] * (i % 7 == 0)
        html = "".join(f'<p><a href="{chance.choice(["https:", "http:", ""])}//{h}/x">y</a>' for h in links)
        yield i, f"http://{chance.choice(hosts)}/{chance.choice(['en', 'es', 'fr', 'de'])}/{i}?q=1", html + '<a href="/own">z</a>'


RULES = [*U.RULES, ("spam.io", "/", "block"), ("hub.org", "", "allow"), ("h3.org", "/en/", "block"), ("h3.org", "/en/", "allow")]


@pytest.mark.parametrize("seed", [1, 2])
def test_brute_force(spark, seed):
    pages = list(web(300, seed))
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    got = U.judge(spark.createDataFrame(pages, PAGES), rules)
    found = sorted((tuple(r) for r in got.collect()), key=repr)
    assert found == expected(pages, RULES)
    assert seed == 2 or {v for _, _, _, rule, v in found if rule is None} == {"allow", "block"}


def test_sql_over_links(spark):
    pages = [*web(200, 3), *ODD]
    rules = spark.createDataFrame(U.RULES, "host string, path string, verdict string")
    found = sorted((tuple(r) for r in U.judge(spark.createDataFrame(pages, PAGES), rules).collect()), key=repr)
    other = duckdb.connect()
    other.execute("CREATE TABLE pages(page_id BIGINT, url VARCHAR, html VARCHAR)")
    other.executemany("INSERT INTO pages VALUES (?, ?, ?)", pages)
    assert found == sorted(other.execute(U.SQL["op12_url_filter"]).fetchall(), key=repr)


ODD = [
    (None, None, None), (1, "", ""), (1, "", ""), (2, "no scheme", "<a href='//x.com/'>"), (3, "a://", None),
    (4, "http://COM/", ""), (5, "http://com", ""), (6, "x://y://com/", ""), (7, "http://xcom/", ""),
    (8, "http://WWW.example.com/en/a?b/c#d", "<A class=x HREF = '//A.net/'>"), (9, "http://sub.www.example.com/en/", ""),
    (10, "http://example.com/en", ""), (11, "http://www.example.com/EN/", ""), (12, "http://a.net/es/\nx", ""),
    (13, "http://a.net?x=/es/", ""), (14, "http://a.net/es", ""), (15, "http://u@a.net:80/fr/", ""), (16, "http://Ä.COM/ä", ""),
    (17, "http://" + "a." * 20_000 + "com/" + "x" * 50_000, "<a " * 5_000), (18, "http://.com/", ""), (19, "http:///en/", ""),
]


def test_odd_rows(spark):
    wide = spark.createDataFrame([(*p, "x", "y", "z") for p in ODD], PAGES + ", host string, verdict string, `rule` string")
    rules = spark.createDataFrame(U.RULES, "host string, path string, verdict string")
    found = sorted((tuple(r) for r in U.judge(wide, rules).collect()), key=repr)
    plain = [(p, u, h if p == 2 else "") for p, u, h in ODD]
    assert found == expected(plain, U.RULES)
    assert U.judge(wide.limit(0), rules).collect() == []
    none = U.judge(wide, rules.limit(0)).collect()
    assert len(none) == len(ODD) and {(r.rule, r.verdict) for r in none} == {(None, "allow")}


def test_links(spark):
    html = """<a href="https://B.org/x">1</a><a title="t" href='//c.org?'>2</a><a class=k href=http://d.org>3</a>
        <a href="/own"> <a href="http://a.org/self"> <link href="//no.org"> <a data-href="//no.net"> <a\thref\n=\n"//e.org#x">"""
    pages = spark.createDataFrame([(1, "http://a.org/", html), (2, "http://a.org/", html), (3, None, html)], PAGES)
    assert sorted((r.host, r.to) for r in U.edges(pages).collect()) == [
        ("a.org", f"{x}.org") for x in "bcde"]


def test_trust_outweighs_distrust(spark):
    """A host that links to spam is blocked, unless trusted hosts link to it enough."""
    rules = [("spam.io", "/", "block"), ("good.org", "/", "allow")]
    link = '<a href="http://{}/">'
    pages = [(1, "http://spam.io/x", ""), (2, "http://friend.net/1", link.format("spam.io")),
             (3, "http://known.net/1", link.format("spam.io")), (4, "http://other.net/1", ""),
             *[(10 + i, f"http://g{i}.good.org/", link.format("known.net")) for i in range(3)]]
    got = U.judge(spark.createDataFrame(pages, PAGES), spark.createDataFrame(rules, "host string, path string, verdict string"),
                  threshold=40)
    assert {r.page_id: r.verdict for r in got.collect() if r.page_id < 10} == {1: "block", 2: "block", 3: "allow", 4: "allow"}
    assert sorted((tuple(r) for r in got.collect()), key=repr) != []
