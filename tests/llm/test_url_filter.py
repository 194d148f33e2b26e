from __future__ import annotations

import re

import duckdb
import pytest
from pyspark.sql import functions as F

from conftest import TESTDATA
from starloom.llm import queries, url_filter
from starloom.llm.url_filter import BLOCKED, HOST_RULES, Globs, HostRule, judge_urls

SCHEMA = "page_id long, url string, html string"


def plain(url, rules=HOST_RULES, blocked=BLOCKED):
    """The decision restated with string methods and regular expressions."""
    found = re.match(r"^.*?://([^/?#]*)([^?#]*)", url or "", re.S)
    host, path = found.groups() if found else ("", "")
    host = host.translate(str.maketrans(url_filter.UPPER, url_filter.LOWER))
    fits = [
        r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    if fits:
        best = max(fits, key=lambda r: len(r.name))
        return host, path, best.name, best.action, None
    for glob in blocked:
        if re.fullmatch(queries._regex(glob), host + path):
            return host, path, None, "block", glob
    return host, path, None, "allow", None


URLS = [
    None,
    "",
    "no scheme",
    "http://",
    "https://EXAMPLE.net/en/1?x=/fr/#y",
    "https://example.net/en",
    "https://example.net/de/2",
    "http://example.net",
    "http://net/",
    "http://.net/",
    "http://sub.EXAMPLE.com/de/a.html#top",
    "http://notexample.com/de/",
    "http://a.org/fr/",
    "http://a.org/fr?/fr/",
    "http://x.io/y.net/z",
    "http://x.io/http://example.net/en/",
    "ftp://ads.site.io/banner/1.GIF",
    "http://site.io/a/b/login.php",
    "http://site.io/ünïcode/ads/1",
    "http://site.io/" + "a" * 5000 + ".exe",
    "http://İ.NET/x",
    "x://y\nz/cart/\n",
]


def test_awkward_urls_like_plain_matching(spark):
    rows = [(i, url, None) for i, url in enumerate(URLS)] + [(None, URLS[4], "x"), (4, URLS[4], None)]
    pages = spark.createDataFrame(rows, SCHEMA).withColumn("verdict", F.lit(1))
    got = judge_urls(pages).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(repr((i, *plain(url))) for i, url, _ in rows)


def test_no_rows(spark):
    assert judge_urls(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("glob", ["", "*", "**", "a*b", "**a**", "*.x/**", "a***b", "a**/*c", "ab", "*a"])
def test_one_glob_like_its_regular_expression(glob):
    texts = ["", "a", "b", "ab", "aab", "a/b", "axxb", "q.x/", "q/r.x/", "a//c", "a/b/c", "b/a", "/"]
    expected = [bool(re.fullmatch(queries._regex(glob), t)) for t in texts]
    assert Globs([glob]).match([t.encode() for t in texts])[:, 0].tolist() == expected


def test_many_globs_share_words():
    globs = [f"{'x' * i}*y{i}**" for i in range(1, 90)]
    texts = [f"{'x' * i}qq/y{j}z" for i in (1, 3, 50) for j in (2, 40)] + ["x" * 30 + "y7"]
    got = Globs(globs).match([t.encode() for t in texts])
    for i, text in enumerate(texts):
        assert got[i].tolist() == [bool(re.fullmatch(queries._regex(g), text)) for g in globs]


def test_later_of_equally_long_rules_wins(spark):
    rules = [HostRule("block", "a.io", "/"), HostRule("allow", "a.io", "/")]
    got = judge_urls(spark.createDataFrame([(1, "http://a.io/", None)], SCHEMA), rules).head()
    assert (got.rule, got.verdict) == ("a.io/", "allow")


def test_registered_query_like_its_sql(spark):
    folder = TESTDATA / "sf0.01"
    duck = duckdb.connect()
    duck.execute(f"create view pages as select * from read_parquet('{folder}/pages.parquet')")
    expected = duck.execute(queries.ORACLE["op1_url_filter"])
    names = [c[0] for c in expected.description]
    got = queries.QUERIES["op1_url_filter"](spark, str(folder)).select(*names).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, expected.fetchall()))
