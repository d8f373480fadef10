import re

import pytest
from pyspark.sql import functions as F

from windrose.llm import url_filter

SCHEMA = "page_id long, url string, html string, host string, verdict string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA)


def judged(spark, rows, **how):
    found = url_filter.judged_urls(pages(spark, rows), how=url_filter.Propagation(**how))
    return {r.page_id: r for r in found.collect()}


def parsed(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host, path = re.match(r"([^/?#]*)([^?#]*)", rest, re.S).groups()
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


URLS = [
    "http://EXAMPLE.net/en/1", "https://a.example.net/en", "http://a.example.net/EN/", "http://net/", "net/",
    "http://xnet/", "http://example.com/de/x?y#z", "http://w.example.com/de", "http://b.org/fr/?a", "http://org/fr/",
    "http://b.org?/fr/", "http://b.net", None, "", "://", "x://ÄB.net/", "http://a\n.net/\n?x", "http://h.net/a://b.org/fr/",
]


def rule_for(host, path):
    best = None
    for action, rule in url_filter.RULES:
        name, rest = rule.split("/", 1)
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest):
            best = max(best or ("", ""), (rule, action), key=lambda r: len(r[0]))
    return best or (None, None)


def test_rules(spark):
    found = judged(spark, [(i, u, None) for i, u in enumerate(URLS)])
    for i, url in enumerate(URLS):
        host, path = parsed(url)
        assert (found[i].host, found[i].path) == (host, path)
        rule, action = rule_for(host, path)
        assert found[i].rule == rule
        if action:
            assert found[i].verdict == action


def scores(edges, allowed, blocked, damping=0.85):
    hosts = {h for e in edges for h in e[:2]} | set(allowed) | set(blocked)
    trust, distrust = dict.fromkeys(hosts, 0.0), dict.fromkeys(hosts, 0.0)
    for _ in range(200):
        new_t = {h: allowed.get(h, 0) for h in hosts}
        new_d = {h: blocked.get(h, 0) for h in hosts}
        for a, b, w in edges:
            new_t[b] += damping * w * trust[a]
            new_d[a] += damping * w * distrust[b]
        trust, distrust = new_t, new_d
    return trust, distrust


def link(*hosts):
    return "".join(f"<a class=x href='http://{h}/p'>t</a>" for h in hosts)


def test_propagation_against_brute_force(spark):
    rows = [
        (0, "http://good.org/fr/", link("friend.info", "other.info")),
        (1, "http://bad.net/x", link("bad2.net", "BAD.NET")),
        (2, "http://liker.info/", link("bad.net", "bad.net", "bad.net") + '<a href="/own">o</a>'),
        (3, "http://fan.info/", link("liker.info")),
        (4, "http://half.info/", link("bad.net", "good.org")),
        (5, "http://friend.info/", link("friend.info")),
        (6, "http://alone.info/", None),
        (7, "http://Liker.info/b", "<A HREF=//bad.net/x>x</a>"),
    ]
    found = judged(spark, rows)
    edges = [
        ("good.org", "friend.info", 0.5), ("good.org", "other.info", 0.5), ("bad.net", "bad2.net", 1.0),
        ("liker.info", "bad.net", 1.0), ("fan.info", "liker.info", 1.0), ("half.info", "bad.net", 0.5),
        ("half.info", "good.org", 0.5),
    ]
    trust, distrust = scores(edges, {"good.org": 1}, {"bad.net": 1})
    for r in found.values():
        assert r.trust == pytest.approx(trust[r.host], abs=1e-3) if r.host in trust else r.trust == 0
        assert r.distrust == pytest.approx(distrust.get(r.host, 0), abs=1e-3)
    verdicts = {i: r.verdict for i, r in found.items()}
    assert verdicts == {0: "allow", 1: "block", 2: "block", 3: "block", 4: "allow", 5: "allow", 6: "allow", 7: "block"}


def test_no_rows_and_repeated_rows(spark):
    assert judged(spark, []) == {}
    df = url_filter.judged_urls(pages(spark, [(1, "http://a.net/", "")] * 3))
    assert [r.verdict for r in df.collect()] == ["block"] * 3


def test_query_judges_all_pages(spark):
    folder = "/root/testdata/sf0.001"
    found = url_filter.op2_url_filter(spark, folder)
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    rows = found.collect()
    assert sorted(r.page_id for r in rows) == sorted(urls)
    for r in rows:
        assert (r.host, r.path) == parsed(urls[r.page_id])
        assert r.rule == rule_for(r.host, r.path)[0]
    assert "Python" not in found._jdf.queryExecution().toString()


def test_link_pattern(spark):
    html = """<a href="https://A.com:80/x"><a\nid=1 href = 'ftp://b.org?x'><abbr href='http://no.com'><a href=/x><a href='//c.d'>"""
    df = spark.createDataFrame([("s", html)], "host string, html string")
    edges = url_filter.host_edges(df).orderBy("dst").collect()
    assert [(e.dst, round(e.weight, 3)) for e in edges] == [("a.com:80", 0.333), ("b.org", 0.333), ("c.d", 0.333)]
    assert url_filter.host_edges(df.where(F.lit(False))).collect() == []
