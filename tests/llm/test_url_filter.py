import pytest
from pyspark.sql import functions as F

from daymill.llm import queries, url_filter

LISTED = "host string, path string, verdict string"
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


@pytest.fixture(scope="module")
def judged(spark):
    def run(urls, listed=RULES):
        pages = spark.createDataFrame([(i, u, "mine", "x") for i, u in enumerate(urls)], "page_id long, url string, host string, `a.b` string")
        rows = url_filter.judge(pages, spark.createDataFrame(listed, LISTED)).orderBy("page_id").collect()
        return [(r.host, r.path, r.rule, r.verdict) for r in rows]

    return run


def brute(url, listed, otherwise="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, path = "".join(c.lower() if c.isascii() else c for c in rest[:end]), rest[end:].split("?")[0].split("#")[0]
    fits = [(len(h) + len(p), len(h), h + p, v) for h, p, v in listed if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[2:] if fits else (None, otherwise)))


def test_every_kind_of_address(judged):
    urls = [
        None, "", "no scheme", "http://", "://x.net/es/", "http://Example.COM/en/1", "http://www.example.com/en/1", "http://a.www.example.com/en/", "http://notexample.com/en/",
        "http://example.com/en", "http://example.com", "http://example.com?q=/en/", "http://example.com/#/en/", "http://x.net/fr/?a://b", "http://net/es/#", "http://x.net/de/", "ftp://É.com/É",
        "http://a..com/", "http://com./x", "x://com:80/", "http://x.net/es/\n2", "http://x.org/" + "a/" * 50_000, "http://" + "a." * 500 + "net/es/",
    ]
    assert judged(urls) == [brute(u, RULES) for u in urls]


def test_query_against_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    rows = queries.QUERIES["op12_url_filter"](spark, folder).collect()
    assert len(rows) == len(pages)
    assert all((r.host, r.path, r.rule, r.verdict) == brute(pages[r.page_id], RULES) for r in rows)


def test_a_long_list(judged):
    listed = [(f"h{i}.org", f"/p{i % 7}/", "block") for i in range(3000)] + [("org", "/", "allow"), ("", "/", "block"), (None, "/", "block"), ("x.org", None, "block"), ("x.org", "", "allow")]
    urls = [f"http://s.h{i}.org/p{i % 5}/q" for i in range(0, 4000, 3)] + ["http://x.org", "http://y.x.org/z"] * 3
    kept = [(h, p or "", v) for h, p, v in listed if h]
    assert judged(urls, listed) == [brute(u, kept) for u in urls]
    assert judged(urls[:3], []) == [brute(u, []) for u in urls[:3]]


def test_filter_passes_all_listed_and_few_others(spark):
    listed = url_filter.canonical(spark.range(20_000).select(F.concat(F.lit("h"), "id").alias("host"), F.lit("/a").alias("path"), F.lit("block").alias("verdict")))
    blocks = url_filter.blocks_for(20_000)
    assert url_filter.possible(listed.select("host", "path"), listed, blocks).count() == 20_000
    others = spark.range(20_000).select(F.concat(F.lit("other"), "id").alias("host"), F.lit("/a").alias("path"))
    assert url_filter.possible(others, listed, blocks).count() < 200
    assert url_filter.blocks_for(0) == 1 and url_filter.blocks_for(1 << 40) == url_filter.MOST_BLOCKS
    # A filter too small for its list passes more, never less.
    assert url_filter.possible(listed.select("host", "path"), listed, 50).count() == 20_000


def test_empty_pages(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.judge(pages, spark.createDataFrame(RULES, LISTED)).count() == 0


def test_no_python_in_the_plan(spark):
    df = queries.QUERIES["op12_url_filter"](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InPandas" not in plan and "InArrow" not in plan and "CartesianProduct" not in plan
