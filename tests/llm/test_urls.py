"""Operator 13 against a plain scan of all entries, and what the Bloom filter lets through."""

from __future__ import annotations

import random
import re

import pytest

from sensorloom.llm import urls

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
LISTED = [("bad.example.com", "/", "block"), ("example.org", "/x", "block"), ("b.c", "", "block"), ("net", "/en/", "block")]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1]).groups()
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def plain(url, rules=RULES, listed=LISTED):
    host, path = parts(url)
    for entries, are_rules in ((rules, True), (listed, False)):
        fits = [e for e in entries if ("." + host).endswith("." + e[0]) and path.startswith(e[1])]
        if fits:
            best = max(fits, key=lambda e: (len(e[0] + e[1]), len(e[0]), e[2] == "block"))
            return host, path, best[0] + best[1] if are_rules else None, best[2]
    return host, path, None, "allow"


def judged(spark, given, rules=RULES, listed=LISTED):
    pages = spark.createDataFrame([(n, url) for n, url in enumerate(given)], "page_id int, url string")
    return urls.judge(pages, urls.entries(spark, rules), urls.entries(spark, listed))


def test_all_urls_equal_a_plain_scan(spark):
    rng = random.Random(13)
    hosts = ["net", "a.net", "example.net", "X.Example.NET", "notexample.net", "example.com", "de.example.com", "bad.example.com", "a.org", "org", "b.c", "a.b.c", "x.net:80", "", "é.net"]
    paths = ["", "/", "/en/", "/en", "/de/1", "/fr/2", "/x", "/xy/z", "/EN/", "/é/"]
    ends = ["", "?a=/en/", "#/de/", "?", "/://net/"]
    given = [f"{rng.choice(['http', 'https', ''])}://{h}{p}{e}" for h in hosts for p in paths for e in ends]
    given += [None, "", "no scheme", "net/", "://", "http:/net/", "x" * 50_000, "http://" + "a." * 20_000 + "net/", "http://net/" + "y" * 50_000, given[7], given[7]]
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judged(spark, given).collect()}
    assert found == {n: plain(url) for n, url in enumerate(given)}
    assert {v[2] for v in found.values()} == {None, "net/", "example.net/en/", "example.com/de/", "org/fr/"}


def test_equal_and_broken_entries(spark):
    rules = [("a.b", "/", "allow"), ("a.b", "/", "block"), ("A.B", "/q", "allow"), ("", "/", "block"), ("c", "/", "perhaps"), (None, "/", "block")]
    found = [(r.rule, r.verdict) for r in judged(spark, ["http://a.b/", "http://a.b/q", "http://c/", "http:///"], rules, []).orderBy("page_id").collect()]
    assert found == [("a.b/", "block"), ("a.b/q", "allow"), (None, "allow"), (None, "allow")]
    assert [r.verdict for r in judged(spark, ["http://a.b/"], [], []).collect()] == ["allow"]


@pytest.mark.parametrize("most", [1, 1 << 16])
def test_a_full_filter_passes_more_but_changes_nothing(spark, monkeypatch, most):
    monkeypatch.setattr(urls, "MOST_BLOCKS", most)
    rng = random.Random(1)
    listed = [(f"h{n}.com", f"/p{n % 7}", "block") for n in range(600)]
    given = [f"http://h{rng.randrange(1200)}.com/p{rng.randrange(10)}" for _ in range(1000)]
    found = judged(spark, given, [], listed)
    assert {r.page_id: r.verdict for r in found.collect()} == {n: plain(u, [], listed)[3] for n, u in enumerate(given)}
    table = urls.keyed(urls.entries(spark, []), urls.entries(spark, listed)).persist()
    rows = spark.createDataFrame([(n, *parts(u)) for n, u in enumerate(given)], "page_id int, host string, path string")
    hits = [r.page_id for r in urls.possible_hits(rows.withColumnRenamed("page_id", "n"), table, [(2, 3)]).join(rows, ["host", "path"]).collect()]
    true = {n for n, u in enumerate(given) if plain(u, [], listed)[3] == "block"}
    assert true <= set(hits)
    wrong = len(set(hits) - true) / (len(given) - len(true))
    assert wrong > 0.5 if most == 1 else wrong < 0.2


def test_plan_is_native_and_hashed(spark):
    plan = judged(spark, ["http://net/"])._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "BroadcastHashJoin" in plan
    judge_plan = plan.split("Scan ExistingRDD")[0]
    assert "Python" not in judge_plan and "Arrow" not in judge_plan and "CartesianProduct" not in plan


def test_other_columns_empty_tables_and_repeats(spark):
    schema = "page_id int, url string, host int, path int, rule int, verdict int, rank int, key int, page string, block int, w0 int"
    row = (1, "http://a.net/en/", 1, 1, 1, 1, 2, 3, "p", 4, 5)
    rules, listed = urls.entries(spark, RULES), urls.entries(spark, LISTED)
    found = urls.judge(spark.createDataFrame([row, row], schema), rules, listed)
    assert found.columns == ["page_id", "url", "rank", "key", "page", "block", "w0", "host", "path", "rule", "verdict"]
    assert [tuple(r) for r in found.collect()] == [(1, row[1], 2, 3, "p", 4, 5, "a.net", "/en/", "net/", "block")] * 2
    assert urls.judge(spark.createDataFrame([], schema), rules, listed).collect() == []
