import duckdb
import pytest

from parcelwise.llm import hosts
from parcelwise.llm.queries import QUERIES, SQL

COLUMNS = "page_id, host, path, rule, verdict"


def by_sql(pages):
    return sorted(duckdb.sql(f"SELECT {COLUMNS} FROM ({SQL['op6_host_trust']})").fetchall(), key=str)


def test_query_equals_sql(spark):
    folder = "/root/testdata/sf0.01"
    got = QUERIES["op6_host_trust"](spark, folder).select(*COLUMNS.split(", ")).collect()
    assert sorted(map(tuple, got), key=str) == by_sql(duckdb.read_parquet(f"{folder}/pages.parquet"))


@pytest.mark.parametrize(
    "url,host,path,rule",
    [
        ("HTTP://WWW.Example.NET/en/x?q#f", "www.example.net", "/en/x", "example.net/en/"),
        ("http://example.net/EN/", "example.net", "/EN/", "net/"),
        ("http://a.net", "a.net", "", None),
        ("http://badexample.com/de/", "badexample.com", "/de/", None),
        ("http://x.example.com/de/?a=://b", "x.example.com", "/de/", "example.com/de/"),
        ("http://w.org/fr/a/b#://c", "w.org", "/fr/a/b", "org/fr/"),
        ("://h.net/p", "h.net", "/p", "net/"),
        ("http://h\n.net/a\nb", "h\n.net", "/a\nb", "net/"),
        ("no scheme", "", "", None),
        (None, "", "", None),
    ],
)
def test_rules(spark, url, host, path, rule):
    pages = spark.createDataFrame([(1, url, None)], "page_id long, url string, html string")
    (r,) = hosts.judge(pages).collect()
    assert (r.host, r.path, r.rule) == (host, path, rule)
    if rule is None and not host:
        assert r.verdict == "allow"


def test_links_carry_trust_and_distrust(spark):
    link = "<a href='http://{}/x'>".format
    rows = [
        (1, "http://bad.net/a", None),
        (2, "http://farm.io/a", link("BAD.net") * 3),
        (3, "http://good.org/fr/a", link("friend.io")),
        (4, "http://friend.io/a", '<a href="/local"> ' + link("farm.io")),
        (5, "http://friend.io/a", ""),
        (5, "http://friend.io/a", ""),
        (6, "http://plain.io/a", link("plain.io")),
    ] + [(7 + n, "http://bad.net/b", None) for n in range(20)]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, rule int")
    got = {r.page_id: r.verdict for r in hosts.judge(pages).collect()}
    # Distrust runs against links: farm.io links to the blocked host.
    assert got[1] == got[2] == "block" and got[6] == "allow"
    plain = duckdb.sql("SELECT * FROM (VALUES " + ", ".join(
        f"({i}, '{u}', " + ("NULL" if h is None else "'" + h.replace("'", "''") + "'") + ")" for i, u, h in rows
    ) + ") t(page_id, url, html)")
    mine = sorted(map(tuple, hosts.judge(pages).select(*COLUMNS.split(", ")).collect()), key=str)
    assert mine == by_sql(plain)
    assert hosts.judge(pages.limit(0)).count() == 0
