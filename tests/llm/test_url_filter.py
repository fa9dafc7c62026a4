from __future__ import annotations

import re

from tests.llm import brute
from trialguard.llm import url_filter as u
from trialguard.llm.queries import URL_RULES

RULES = "host string, path string, verdict string"
URLS = [
    None, "", "nothing", "/path", "http://", "http://com", "http://com/", "HTTP://WWW.EXAMPLE.COM/en/1?x#y", "https://a.example.com/en/",
    "https://example.com/EN/", "http://b.net/es/2#t", "http://net/fr/", "ftp://x.net?/es/", "http://exampl\u00c9.com/en/", "a://b://c.com/",
    "http://c.org/q?utm_source=z", "http://user@d.com:80/", "http://d.com.:8/es/", "http://notexample.com/en/", "http://x.net/es", "http://.com/",
]


def _parts(url):
    rest = (url or "").partition("://")[2]
    host = re.split("[/?#]", rest)[0]
    return brute.lower_ascii(host), re.split("[?#]", rest[len(host) :])[0]


def test_longest_rule_wins(spark):
    df = spark.createDataFrame([(k, x, None, "v") for k, x in enumerate([*URLS, URLS[7]])], "page_id long, url string, html string, verdict string")
    rows = {r.page_id: r for r in u.judge(df, spark.createDataFrame(URL_RULES, RULES)).collect()}
    assert len(rows) == len(URLS) + 1
    for k, url in enumerate(URLS):
        host, path = _parts(url)
        fits = [(len(h + p), h + p, v) for h, p, v in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits) if fits else (0, None, "allow")
        assert (rows[k].host, rows[k].path, rows[k].rule, rows[k].verdict) == (host, path, *best[1:]), url


def test_aliases_take_decisions_and_an_allow_goes_first(spark):
    pages = [
        (1, "https://a.org/x", "<LINK href='https://b.net/es/1' rel=\"alternate canonical\">"), (2, "http://b.net/es/1", None),
        (3, "https://c.org/q", '<meta http-equiv="Refresh" content="0; URL=/r?utm_x=1">'),
        (4, "http://c.org/r#k", "<link rel=canonical href=//d.com/ok><link rel=canonical href='http://b.net/fr/9'>"),
        (5, "http://e.org/1/2", '<link rel="canonical" href="3"><link rel="stylesheet" href="http://d.com/s.css">'),
        (6, "http://e.org/1/3", "<meta http-equiv=refresh content='5;url=http://b.net/es/1?a=1&amp;b=2'>"),
        (7, "http://b.net/es/1?a=1&b=2", ""), (8, "https://m.e.org/1/3/", "<title>rel=canonical</title>"), (9, "http://f.org/", "<p>"),
    ]
    df = spark.createDataFrame([*pages, *((100 + k, f"http://hub.org/{k}", "<link rel='canonical' href='/hub'>") for k in range(300))], "page_id long, url string, html string")
    redirects = spark.createDataFrame([("http://hub.org/hub", "http://z.net/fr/"), (None, "http://f.org/")], "source string, target string")
    rows = {r.page_id: r for r in u.judge(df, spark.createDataFrame(URL_RULES, RULES), redirects=redirects).collect()}
    told = {k: (rows[k].verdict, rows[k].by_alias) for k in range(1, 10)}
    assert told == {
        1: ("block", True), 2: ("block", False), 3: ("allow", True), 4: ("allow", True), 5: ("block", True), 6: ("block", True),
        7: ("block", False), 8: ("block", True), 9: ("allow", False),
    }
    assert all(rows[100 + k].verdict == "block" and rows[100 + k].by_alias for k in range(300))


def test_sql_gives_the_same_verdicts(spark):
    """The registered SQL over pages with every kind of link, against the operator."""
    import duckdb

    pages = [(k, x, None) for k, x in enumerate(URLS)] + [
        (101, "https://a.org/x", "<LINK href='https://b.net/es/1' rel=\"alternate canonical\">"), (102, "http://www.b.net/es/1/", None),
        (103, "https://c.org/q?utm_a=1&k=2", '<meta http-equiv="Refresh" content="0; URL=/r?utm_x=1">'),
        (104, "http://c.org/r#k", "<link rel=canonical href=//d.com/ok><link rel=canonical href='http://b.net/fr/9'>"),
        (105, "http://e.org/1/2", '<link rel="canonical" href="3">'), (106, "http://e.org/1/3", "<meta http-equiv=refresh content='5;url=http://b.net/es/1?a=1&amp;b=2'>"),
        (107, "http://m.e.org/1/3/", "<link rel='canonical' href='?z=1'>"), (108, "http://www.com/", None), (109, "http://f.org/1/3", "<link rel=canonical href=#top>"),
    ]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", pages)
    columns = ["page_id", "host", "path", "rule", "verdict", "by_alias"]
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({u.sql(URL_RULES)})").fetchall()
    got = [tuple(r) for r in u.judge(df, spark.createDataFrame(URL_RULES, RULES)).select(*columns).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_empty_tables(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert u.judge(pages, spark.createDataFrame(URL_RULES, RULES)).collect() == []
    one = spark.createDataFrame([(1, "http://a.com/", None)], pages.schema)
    assert u.judge(one, spark.createDataFrame([], RULES)).first().verdict == "allow"
