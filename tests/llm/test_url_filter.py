import pytest

from postlens.llm import url_filter
from postlens.llm.url_filter import judge_urls

PAGES = "page_id long, url string, host string, verdict string, block int"


def judged(spark, urls, listed=(), **more):
    pages = spark.createDataFrame([(i, u, "x", None, 1) for i, u in enumerate(urls)], PAGES)
    lists = spark.createDataFrame([(u,) for u in listed], "url string")
    return {r["page_id"]: tuple(r)[1:] for r in judge_urls(pages, lists, **more).collect()}


def test_rules(spark):
    got = judged(
        spark,
        ["http://A.Example.org/es/x", "http://example.org/en/12?q", "http://x.org", "http://x.org/", "https://u.com/fr/1#a", "http://u.com/de/", "http://notexample.org/es/",
         "http://com/fr/", "mailto:a@b", None, "", "x://://y/z", "http://example.org/en/2", "HTTP://EXAMPLE.ORG/ES/", "http://dcom/de/1", "http://h.com?/de/"],
    )
    assert got[0] == ("a.example.org", "/es/x", "example.org/es/", "block")
    assert got[1] == ("example.org", "/en/12", "example.org/en/1", "block")
    assert got[2] == ("x.org", "", None, "allow")
    assert got[3] == ("x.org", "/", "org/", "allow")
    assert got[4] == ("u.com", "/fr/1", "com/fr/", "allow")
    assert got[5] == ("u.com", "/de/", "com/de/", "block")
    assert got[6] == ("notexample.org", "/es/", "org/", "allow")
    assert got[7] == ("com", "/fr/", "com/fr/", "allow")
    assert got[8] == got[9] == got[10] == ("", "", None, "allow")
    assert got[11] == (":", "//y/z", None, "allow")
    assert got[12][2:] == ("org/", "allow")
    assert got[13] == ("example.org", "/ES/", "org/", "allow")
    assert got[14] == ("dcom", "/de/1", None, "allow")
    assert got[15] == ("h.com", "", None, "allow")


@pytest.mark.parametrize("blocks", [1, 64, url_filter.BLOCKS])
def test_listed_urls_are_found_and_no_others(spark, blocks):
    urls = [f"http://www.h{i % 7}.net/p/{i}/?x" for i in range(3000)]
    listed = [f"h{i % 7}.net/p/{i}" for i in range(0, 3000, 3)] * 2 + [None]
    got = judged(spark, urls, listed, blocks=blocks)
    assert [got[i][3] for i in range(3000)] == ["block" if i % 3 == 0 else "allow" for i in range(3000)]


def test_a_rule_beats_the_list(spark):
    got = judged(spark, ["http://x.org/a", "http://u.com/de/a"], ["x.org/a", "u.com/de/a"])
    assert [g[3] for g in got.values()] == ["allow", "block"]


def test_empty_tables(spark):
    assert judged(spark, []) == {}
    pages = spark.createDataFrame([(1, "http://a.net/"), (1, "http://a.net/"), (None, None)], "page_id long, url string")
    lists = spark.createDataFrame([], "url string")
    assert sorted(r["verdict"] for r in judge_urls(pages, lists).collect()) == ["allow"] * 3


def test_the_filter_lets_few_others_through(spark):
    listed = spark.range(2000).selectExpr("concat('u', id) as url")
    other = spark.range(20000).selectExpr("concat('v', id) as url")
    bloom = url_filter.bloom_filter(listed, "url")
    assert url_filter.possible_hits(listed, "url", bloom).count() == 2000
    assert url_filter.possible_hits(other, "url", bloom).count() < 200
