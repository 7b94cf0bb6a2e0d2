import pytest

from assaylake.llm.url_filters import RULES, judge
from assaylake.llm.queries import QUERIES
from tests.llm.cases import FOLDER
from tests.oracle import connect, difference

URLS = [
    "http://Example.ORG/es/1?x#y", "https://a.b.example.org/en/12", "https://example.org/en/2", "http://com/fr/", "http://xcom/fr/",
    "http://m.com/de/?q", "http://m.com/DE/", "no scheme.org/es/", None, "", "http://", "ftp://u@x.org:80/es/", "http://x.org", "x://org/",
    "http://a.example.org/es", "http://..org//", "http://a/b://c.org/fr/", "http://" + "a." * 3000 + "com/fr/" + "x" * 5000, "http://x.com/fr/\nq",
]


def plain(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:].split("?")[0].split("#")[0]
    best = None
    for verdict, h, p in rules:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[0])):
            best = (h + p, verdict)
    return (host, path, best[0] if best else None, best[1] if best else "allow")


@pytest.mark.parametrize("broadcast", [1000, 0])
def test_against_brute_force(spark, broadcast):
    rows = [(i, u, "extra", "x") for i, u in enumerate(URLS)] + [(3, URLS[3], "extra", "x"), (None, URLS[0], None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, digest string")
    rules = spark.createDataFrame(RULES, "verdict string, host string, path string")
    got = sorted(map(tuple, judge(pages, rules, broadcast_rules=broadcast).collect()), key=str)
    assert got == sorted(((i, *plain(u, RULES)) for i, u, *_ in rows), key=str)


def test_empty_tables(spark):
    rules = spark.createDataFrame([], "verdict string, host string, path string")
    pages = spark.createDataFrame([(1, "http://a.org/x")], "page_id long, url string")
    assert [tuple(r) for r in judge(pages, rules).collect()] == [(1, "a.org", "/x", None, "allow")]
    assert judge(pages.limit(0), rules).count() == 0


@pytest.mark.parametrize("name", [n for n, (_, sql) in QUERIES.items() if sql])
def test_sql_forms(spark, name):
    query, sql = QUERIES[name]
    assert difference(connect(FOLDER), query(spark, FOLDER), sql) is None
