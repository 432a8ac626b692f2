import pytest

from corvid.llm import url_filter as uf
from corvid.llm.queries import URL_RULES

URLS = [
    (1, None), (2, ""), (3, "no scheme/x"), (4, "http://A.Example.NET/en/x?q#f"), (5, "https://example.net/en"),
    (6, "https://x.net"), (7, "https://x.net/"), (8, "http://example.com/de/"), (9, "http://badexample.com/de/"),
    (10, "http://w.example.com/de/a"), (11, "http://b.org/fr/?x"), (12, "http://org/fr/"), (13, "http://b.org/f"),
    (14, "http://bad.example.com/x"), (15, "http://sub.bad.example.com"), (16, "http://notbad.example.com/"),
    (17, "ftp://h?x://y/z"), (18, "http://bad.example.com/x"), (19, "http:///p"), (20, "x://É.com/Ü#"),
]


@pytest.fixture
def pages(spark):
    return spark.createDataFrame(
        [(i, u, "h", "k", "l") for i, u in URLS], "page_id long, url string, host string, key string, listed string"
    )


def judge(spark, pages, listed, **more):
    keys = spark.createDataFrame([(k,) for k in listed], "key string")
    return {r["page_id"]: r for r in uf.filter_urls(pages, keys, URL_RULES, **more).collect()}


def test_parts_rules_and_verdicts(spark, pages):
    got = judge(spark, pages, ["bad.example.com", "", None])
    parts = {i: (r["host"], r["path"]) for i, r in got.items()}
    assert parts[1] == parts[2] == parts[3] == ("", "") and parts[4] == ("a.example.net", "/en/x")
    assert parts[6] == ("x.net", "") and parts[17] == ("h", "") and parts[19] == ("", "/p")
    assert parts[20] == ("É.com", "/Ü")
    rules = {i: r["rule"] for i, r in got.items() if r["rule"]}
    assert rules == {
        4: "example.net/en/", 5: "net/", 7: "net/", 8: "example.com/de/", 10: "example.com/de/", 11: "org/fr/",
        12: "org/fr/",
    }
    blocked = {i for i, r in got.items() if r["verdict"] == "block"}
    assert blocked == {5, 7, 8, 10, 14, 15, 18}


@pytest.mark.parametrize("bits", [1, 2, 10])
def test_cascade_is_exact_at_any_filter_size(spark, bits):
    universe = spark.range(3000).selectExpr("concat('h', id) AS key")
    listed = universe.filter("hash(key) % 5 = 0")
    levels = uf.build_cascade(universe, listed, bits_per_key=bits)
    assert len(levels) > 1
    got = uf.with_filters(universe, levels).select("key", uf.is_listed(levels, universe["key"]).alias("in"))
    assert got.filter("in <> (hash(key) % 5 = 0)").count() == 0


def test_empty_list_empty_table_and_size_bound(spark, pages):
    assert {r["listed"] for r in judge(spark, pages, []).values()} == {False}
    assert judge(spark, pages.limit(0), ["bad.example.com"]) == {}
    with pytest.raises(ValueError, match="max_bits"):
        judge(spark, pages, ["a.com", "b.com"], max_bits=8)
