import re

from llm_brute import SF1, rows

from tabrisk.llm import urlfilter
from tabrisk.llm.queries import ORACLE, QUERIES

PAGE = "page_id long, url string"


def brute(url, rules):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "", re.S)
    host, path = (re.sub("[A-Z]", lambda x: x[0].lower(), m[1]), m[2]) if m else ("", "")
    fit = [r for r in rules if r[0] and ("." + host).endswith("." + r[0]) and path.startswith(r[1]) and r[1].startswith("/")]
    best = max(fit, key=lambda r: (len(r[0] + r[1]), r[2] == "block"), default=None)
    return host, path, best and best[0] + best[1], best[2] if best else "allow"


def test_query_equals_brute_force_and_sql(spark):
    got = sorted(map(tuple, QUERIES["op9_url_rules"](spark, SF1).collect()))
    pages = rows(SF1, "select page_id, url from pages")
    assert got == sorted((i, *brute(u, urlfilter.RULES)) for i, u in pages)
    assert got == sorted(rows(SF1, ORACLE["op9_url_rules"]))


URLS = [
    None, "", "no scheme/en/", "http://", "http://example.com", "http://example.com/", "http://EXAMPLE.com/en/x?y#z", "https://www.example.com/en/", "http://a.b.www.Example.com/en/q", "http://xexample.com/en/", "http://com/", "http://com",
    "http://net/fr/", "http://x.net/frx/", "http://x.net/FR/", "http://x.net/fr/?a://b.com/", "ftp://x.net//es/", "a://b://c.com/en/", "http://x.net?/es/", "http://x.net#/es/", "http://É.net/es/é", "http://.com/", "http://a..com/x", "http://u:p@h.net:80/es/",
    "http://" + "a." * 3000 + "net/es/" + "x/" * 20000, "http://x.net/es/\nline", "http://deep.org/a/b/c", "http://deep.org/a/b/cd", "http://deep.org/a/bc",
]


def test_edges_and_other_rules(spark):
    pages = [*enumerate(URLS), (None, URLS[7]), (3, URLS[7]), (3, URLS[7])]
    df = spark.createDataFrame(pages, PAGE).selectExpr("*", "'x' as host", "'y' as rule", "1 as digest")
    more = [("deep.org", "/a/b/c", "block"), ("deep.org", "/a/", "allow"), ("x.net", "/fr", "allow"), ("net", "/es/", "allow"), ("", "/", "block"), (None, "/", "block"), ("org", "no-slash", "block"), ("Example.COM", "/en/x", "block")]
    for rules in (urlfilter.RULES, urlfilter.RULES + more, []):
        lower = [(r[0].lower() if r[0] else r[0], *r[1:]) for r in rules]
        table = spark.createDataFrame(rules, "host string, path string, verdict string")
        got = sorted(map(tuple, urlfilter.filter_pages(df, table).collect()), key=str)
        assert got == sorted(((i, *brute(u, lower)) for i, u in pages), key=str)
    assert urlfilter.filter_pages(spark.createDataFrame([], PAGE), urlfilter.rules_table(spark)).count() == 0
