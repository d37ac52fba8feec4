import pytest
from pyspark.sql import functions as F

from tallyhawk.llm.urls import filter_urls, reputation

PAGES = "page_id long, url string, host string, verdict int"
CASES = {
    "http://WWW.Example.COM/en/x?y#z": ("www.example.com", "/en/x", "www.example.com/en/"),
    "https://a.example.com/en/": ("a.example.com", "/en/", "example.com/en/"),
    "https://example.com/en": ("example.com", "/en", "com/"),
    "https://notexample.com/en/": ("notexample.com", "/en/", "com/"),
    "ftp://x.net/es/": ("x.net", "/es/", "net/es/"), "x://net/fr/a://b": ("net", "/fr/a://b", "net/fr/"),
    "https://example.com": ("example.com", "", None), "https://x.net?/es/": ("x.net", "", None),
    "https://\u00c4b.org:80/p": ("\u00c4b.org:80", "/p", None), "no scheme": ("", "", None), "": ("", "", None), None: ("", "", None),
    "://": ("", "", None), "a://b\nc.net/es/\nd": ("b\nc.net", "/es/\nd", "net/es/"),
}


def test_hosts_and_rules(spark):
    pages = spark.createDataFrame([(i, u, "x", 1) for i, u in enumerate(CASES)] + [(None, "http://a.com/", "", 0)] * 2, PAGES)
    labels = spark.createDataFrame([(0, 1), (0, None), (None, 1), (99, 0), (1, 1), (1, 0)], "page_id long, good int")
    got = {r["page_id"]: r for r in filter_urls(pages, labels).collect()}
    assert filter_urls(pages, labels).count() == len(CASES) + 2
    for i, (host, path, rule) in enumerate(CASES.values()):
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule)
        if rule:
            assert got[i]["verdict"] == ("block" if rule in ("example.com/en/", "net/es/", "net/fr/") else "allow")
    empty = spark.createDataFrame([], PAGES)
    assert filter_urls(empty, labels).count() == 0
    assert filter_urls(pages, labels.limit(0)).count() == len(CASES) + 2


def test_shrinkage(spark):
    rows = [("good.a.com", i % 20 > 0) for i in range(400)] + [("bad.b.org", i % 10 == 0) for i in range(400)]
    rows += [("other.b.org", False), ("new.b.org", None), ("new.a.com", None)]
    got = {r["host"]: r for r in reputation(spark.createDataFrame(
        [(h, None if g is None else int(g)) for h, g in rows], "host string, good int")).collect()}
    assert got["bad.b.org"]["upper"] < 0.3 < 0.85 < got["good.a.com"]["lower"]
    assert got["new.b.org"]["mean"] < got["new.a.com"]["mean"]  # hosts without labels rest on their domain
    assert got["other.b.org"]["mean"] > 0 and got["new.b.org"]["n"] == 0
    for r in got.values():
        assert 0 <= r["lower"] <= r["mean"] <= r["upper"] <= 1
    assert got["good.a.com"]["mean"] == pytest.approx(0.95, abs=0.02)


def test_bad_hosts_are_blocked(spark):
    pages = spark.createDataFrame([(i, f"http://{'spam' if i % 2 else 'fine'}.org/{i}") for i in range(400)], "page_id long, url string")
    labels = pages.select("page_id", (F.col("page_id") % 2 == 0).cast("int").alias("good")).where("page_id < 300")
    got = filter_urls(pages, labels).groupBy("host").agg(F.collect_set("verdict").alias("v")).collect()
    assert {r["host"]: r["v"] for r in got} == {"spam.org": ["block"], "fine.org": ["allow"]}
