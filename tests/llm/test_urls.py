import random

import duckdb
import pytest

from lumiflux.llm import urls

RULES = [
    ("com", "/", "allow"),
    ("Example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("example.com", "/en/a", "allow"),
    ("example.com", "/en/a", "block"),
    ("a.b", "", "block"),
    ("", "/private/x", "block"),
    ("com", "/a/b/c/d/e/f/", "allow"),
    ("b", "/p", "allow"),
    ("b", "/p/q", "block"),
    ("b", "/", "allow"),
    (None, "/null", "block"),
    ("é.com", "/ß/", "block"),
]


def plain(url, rules, default):
    """Every rule tried on every url."""
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        for c in "?#":
            rest = rest.split(c, 1)[0]
        host, slash, tail = rest.partition("/")
        host, path = "".join(c.lower() if "A" <= c <= "Z" else c for c in host), slash + tail
    best = None
    for h, p, action in rules:
        h, p = (h or "").lower(), p or ""
        if (h == "" or host == h or host.endswith("." + h)) and path.startswith(p):
            mine = (len(h) + len(p), len(h), action == "block", h + p, action)
            best = mine if best is None or mine > best else best
    return (host, path, best[3], best[4]) if best else (host, path, None, default)


def some_urls(n=1500):
    rng = random.Random(11)
    hosts = ["com", "example.com", "WWW.Example.com", "x.www.example.com", "a.b", "x.a.b", "ab", "b", "é.com", "", ".com", "com.", "example.com:80", "u@b"]
    pieces = ["/", "/en/", "en", "/e", "a", "/p", "/p/q", "?q=/en/", "#/en/", "/private/x1", "//", "/a/b/c/d/e/f/", "ß/", "/ß/", "\n"]
    out = [f"{rng.choice(['http', 'ftp', ''])}://{rng.choice(hosts)}" + "".join(rng.choice(pieces) for _ in range(rng.randint(0, 4))) for _ in range(n)]
    return [None, "", "no scheme", "//x.com/", "a://b://c/p/q", "https://com/" + "x" * 100_000, "https://" + "y." * 3000 + "b/p", *out, *out[:20]]


def test_every_rule_tried_gives_the_same_both_ways(spark):
    rows = [(i if i % 7 else None, u, "clash", "x") for i, u in enumerate(some_urls())]
    pages = spark.createDataFrame(rows, "page_id long, url string, verdict string, key string").repartition(3)
    table = urls.rule_table(spark, RULES + RULES[:3])
    want = sorted([(k, *plain(u, RULES, "block")) for k, u, *_ in rows], key=str)
    for limit in (urls.BROADCAST, 0):
        got = urls.filter_urls(pages, table, default="block", limit=limit)
        assert got.columns == ["page_id", "host", "path", "rule", "verdict"]
        assert sorted(map(tuple, got.collect()), key=str) == want, limit


@pytest.mark.parametrize("url, rule, verdict", [("http://a.example.com/en/1", "example.com/en/", "block"), ("HTTP://WWW.EXAMPLE.COM/en/1", "www.example.com/en/", "allow"), ("http://notexample.com/en/", "com/", "allow"), ("http://x.net/es/?a", "net/es/", "block"), ("http://x.net/es", None, "allow"), ("http://x.com", None, "allow"), ("http://m.www.example.com/en/#a", "www.example.com/en/", "allow")])
def test_the_contracts_rules(spark, url, rule, verdict):
    row = urls.report(spark.createDataFrame([(1, url)], "page_id long, url string")).first()
    assert (row.rule, row.verdict) == (rule, verdict)


def test_sql_agrees(spark):
    rows = list(enumerate(some_urls(400)))
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?)", rows)
    got = urls.report(spark.createDataFrame(rows, "page_id long, url string"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(con.sql(urls.SQL).fetchall(), key=str)


def test_empty_tables_and_odd_actions(spark):
    none = spark.createDataFrame([], "page_id string, url string")
    assert urls.report(none).count() == 0 and urls.report(none).schema["page_id"].dataType.simpleString() == "string"
    pages = spark.createDataFrame([("a", "http://x.com/")], "page_id string, url string")
    assert [tuple(r) for r in urls.filter_urls(pages, urls.rule_table(spark, [])).collect()] == [("a", "x.com", "/", None, "allow")]
    for odd in ("deny", None):
        with pytest.raises(ValueError):
            urls.filter_urls(pages, urls.rule_table(spark, [("com", "/", odd)]))
