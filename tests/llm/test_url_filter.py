from __future__ import annotations

import random

import duckdb

from agora.llm import url_filter
from agora.llm.common import written
from agora.llm.components import components
from agora.llm.queries import URL_RULES


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)]
    edges += [(1000, k) for k in range(1001, 1300)]          # a hub
    edges += [(k, k + 1) for k in range(2000, 2100)]         # a chain
    edges += [(5, 5), (None, 7), edges[0]]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for a, b in edges:
        if a is not None and a != b:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    got = components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert {(r.node, r.root) for r in got} == {(x, find(x)) for x in parent}
    assert len(got) == len(parent)
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_plans_of_a_round_stay_small(spark, monkeypatch, capsys):
    plans = []

    def seen(df):
        df.explain()
        plans.append(capsys.readouterr().out)
        return written(df)
    monkeypatch.setattr("agora.llm.components.written", seen)
    components(spark.createDataFrame([(k, k + 1) for k in range(9)], "u long, v long"))
    # the edges' table is read for the edges and for their least ends; 16 times when unions repeated it
    assert [p.count("FileScan") for p in plans] == [0] + [2] * (len(plans) - 1)
    assert len(plans) > 2


LINK = '<link rel="canonical" href="{}">'
REFRESH = '<meta http-equiv="refresh" content="0; url={}">'
PAGES = [
    (1, "https://a.example.org/es/x", ""),                                  # blocked by rule
    (2, "http://other.net/alias", LINK.format("http://a.example.org/es/x")),  # its alias
    (3, "http://third.net/p", REFRESH.format("http://other.net/alias#top")),  # and the next
    (4, "http://x.com/fr/ok", LINK.format("http://a.example.org/es/x")),    # allowed by rule
    (5, "http://y.net/", '<link href="/self" rel="canonical"/>'),
    (6, "http://plain.net/a?utm_source=f&b=1#x", "<p>nothing</p>"),
    (7, "http://w.net/q", LINK.format("https://z.com/de/not-a-page")),      # blocked target
    (8, "https://W.net/q/", None),                                          # same node as 7
    (9, None, None), (10, "no scheme", ""), (11, "http://org", ""), (12, "HTTP://EXAMPLE.ORG/en/15", ""),
    (13, "http://notexample.org/es/", ""), (None, "http://x.com/de/", ""), (1, "https://a.example.org/es/x", ""),
    (14, "http://com/fr/?q#f", ""), (15, "http://v.net/1/2", LINK.format("3")),
    (16, "http://u.net/", REFRESH.format("http://x.com/de/b")),
    # links as a browser reads them
    (20, "http://example.org/es/1", LINK.format("http://c.net/?a=1&amp;b=2")),
    (21, "http://c.net/?b=2&a=1", ""),
    (22, "http://x.com/de/d/2", LINK.format("../../t")), (23, "http://x.com/t", ""),
    (24, "http://k.net/page", LINK.format("?v=1")), (25, "http://k.net/page?v=1", LINK.format("http://x.com/de/z")),
    (26, "http://j.net/a/./b/../c", LINK.format("#top")), (27, "http://j.net/a/c", LINK.format("http://x.com/de/y")),
    (28, "http://h.net/x", LINK.format("../../../../up")), (29, "http://h.net/up", LINK.format("http://x.com/de/w")),
]
# 2, 3 and 4 share a component with 1: 4's explicit allow takes precedence for 2 and 3
WANT = {1: "block", 2: "allow", 3: "allow", 4: "allow", 5: "allow", 6: "allow", 7: "block",
        8: "block", 9: "allow", 10: "allow", 11: "allow", 12: "block", 13: "allow", None: "block",
        14: "allow", 15: "allow", 16: "block",
        20: "block", 21: "block", 22: "block", 23: "block", 24: "block", 25: "block", 26: "block",
        27: "block", 28: "block", 29: "block"}


def test_judge(spark):
    df = spark.createDataFrame([(i, u, h, "x") for i, u, h in PAGES],
                               "page_id long, url string, html string, node string")
    got = url_filter.judge(df, URL_RULES)
    rows = got.collect()
    assert len(rows) == len(PAGES)
    assert {r.page_id: r.verdict for r in rows} == WANT
    assert {r.page_id: r.rule for r in rows if r.rule}[13] == "org/"
    con = duckdb.connect()
    con.execute("CREATE TABLE pages(page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", PAGES)
    want = con.execute(f"SELECT page_id, host, path, rule, verdict FROM ({url_filter.sql(URL_RULES)})").fetchall()
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in rows)
    without = url_filter.judge(df.filter("page_id IN (1, 2, 3)"), URL_RULES).collect()
    assert {r.verdict for r in without} == {"block"}
    assert url_filter.judge(df.limit(0), URL_RULES).count() == 0


def test_thousands_of_links_and_one_giant_component(spark):
    rng = random.Random(5)
    pages, parent = [], {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for i in range(3000):                                   # a chain with a hub, and small groups
        to = i // 2 if i < 2000 else (i - 1 if i % 4 else None)
        html = LINK.format(f"http://h{to}.net/p{to}") if to is not None else ""
        pages.append((i, f"http://h{i}.net/p{i}", html))
        if to is not None:
            a, b = sorted((find(i), find(to)))
            parent[b] = a
    pages += [(3000, "http://a.com/de/1", LINK.format("http://h1999.net/p1999")),
              (3001, "http://b.com/de/2", LINK.format("http://h2401.net/p2401")),
              (3002, "http://b.com/fr/3", LINK.format("http://h2402.net/p2402"))]
    rng.shuffle(pages)
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(6)
    got = {r.page_id: r.verdict for r in url_filter.judge(df, URL_RULES).collect()}
    assert len(got) == 3003
    giant, mixed = find(1999), find(2401)                   # 2401 and 2402 are one group
    for i in range(3000):
        assert got[i] == ("block" if find(i) == giant else "allow"), i
    assert mixed == find(2402) and got[3000] == "block" and got[3002] == "allow"
