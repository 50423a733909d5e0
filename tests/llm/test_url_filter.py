"""URL rules against a plain version, and the filter's part in it."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.llm import url_filter
from tessera.llm.rowwise import ROW

RULES = "host string, path string, verdict string"
PAGES = "page_id long, url string"


def plain(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fit = [
        (len(h + (p or "")), len(h), h + (p or ""), v)
        for h, p, v in rules
        if h and (host == h or host.endswith("." + h)) and path.startswith(p or "")
    ]
    return (host, path, *(max(fit)[2:] if fit else (None, default)))


def check(spark, urls, rules, **options):
    pages = spark.createDataFrame(list(enumerate(urls)), PAGES).repartition(3)
    got = url_filter.judge(pages, spark.createDataFrame(rules, RULES), **options)
    rows = sorted(got.select(f"{ROW}.page_id", "host", "path", "rule", "verdict").collect())
    assert [tuple(r) for r in rows] == [(i, *plain(u, rules)) for i, u in enumerate(urls)]


ODD = [
    None, "", "no scheme", "://", "http://", "http://net", "http://NET/", "http://a.Net/x?y=/fr/", "https://x.org/fr/1#/en/",
    "http://example.com/de", "http://example.com/de/", "http://myexample.com/de/", "http://.example.com/de/", "http://a..net/",
    "ftp://a.b.c.example.net/en/1", "http://example.net?en/", "http://example.net#x://org/fr/", "http://u@example.net:80/en/",
    "http://É.net/", "http://a.net/\nx", "x" * 5000 + "://deep." * 2 + "example.com/de/" + "y" * 200_000, "http://a.net/", "http://a.net/",
]
BOOK = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def test_odd_urls(spark):
    check(spark, ODD, BOOK)


def test_rules_without_host_path_or_agreement(spark):
    rules = [*BOOK, (None, "/x", "block"), ("", "/y", "block"), ("b.org", None, "block"), ("net", "/", "allow"), ("EXAMPLE.org", "", "block")]
    want = [("net", "/", "block") if r[:2] == ("net", "/") else (r[0].lower(), *r[1:]) for r in rules if r[0]]
    pages = spark.createDataFrame(list(enumerate([*ODD, "http://a.b.org", "http://example.org/fr/"])), PAGES)
    got = url_filter.judge(pages, spark.createDataFrame(rules, RULES)).select(f"{ROW}.*", "rule", "verdict").collect()
    assert {r["page_id"]: (r["rule"], r["verdict"]) for r in got} == {
        i: plain(u, want)[2:] for i, u in enumerate([*ODD, "http://a.b.org", "http://example.org/fr/"])
    }


@pytest.mark.parametrize("blocks", [1, 1 << 18])
def test_random_lists_and_a_full_filter(spark, blocks):
    """A filter of one word passes everything; the join then settles all."""
    rng = random.Random(blocks)
    host = lambda: ".".join(rng.choice("abc") for _ in range(rng.randint(1, 4)))
    path = lambda: "".join(rng.choice("/xy") for _ in range(rng.randint(0, 4)))
    rules = list({(h, "/" + p if p else ""): (h, "/" + p if p else "", rng.choice(["allow", "block"])) for h, p in ((host(), path()) for _ in range(60))}.values())
    urls = [f"http://{host()}/{path()}" for _ in range(400)]
    check(spark, urls, rules, max_blocks=blocks)


def test_empty_tables_and_clashing_names(spark):
    rules = spark.createDataFrame(BOOK, RULES)
    none = spark.createDataFrame([], PAGES)
    assert url_filter.judge(none, rules).isEmpty()
    pages = spark.createDataFrame([(1, "http://a.net/")], PAGES).withColumns({c: F.lit("q") for c in ("host", "rule", "maybe", "_row", "key")})
    row = url_filter.judge(pages, rules).first()
    assert (row["rule"], row["verdict"], row[ROW]["rule"], row[ROW]["_row"]) == ("net/", "block", "q", "q")
    row = url_filter.judge(pages, rules.where("false"), default="block").first()
    assert (row["rule"], row["verdict"]) == (None, "block")


def test_few_false_positives_and_no_python(spark):
    """Unlisted URLs are finished in the scan: hardly any reach the join."""
    listed = spark.range(20_000).selectExpr("concat('h', id, '.com/') as key")
    bloom = url_filter.BlockedBloom(listed, 20_000)
    assert listed.where(bloom.may_hold(F.col("key"))).count() == 20_000
    others = spark.range(20_000).selectExpr("concat('g', id, '.com/') as key")
    assert others.where(bloom.may_hold(F.col("key"))).count() < 800
    pages = spark.createDataFrame([(1, "http://a.net/")], PAGES)
    plan = url_filter.judge(pages, spark.createDataFrame(BOOK, RULES))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "array<bigint>" not in plan
