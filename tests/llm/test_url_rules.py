"""URL rules against a plain reading of the rules, and on odd rows."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from txrisk.llm import oracle, url_rules
from txrisk.llm import queries as registered
from txrisk.llm.queries import HOST_RULES
from verification.compare import database, differences

ODD = [
    None, "", "no scheme", "http:/one", "://", "http://", "HTTP://WWW.Example.COM/en/", "http://example.com", "http://example.com/",
    "http://example.com?x=/en/", "http://example.com/en?/en/", "http://example.com/en/#a", "http://www.example.com/en/a",
    "http://a.www.example.com/en/", "http://notexample.com/en/", "http://example.com/EN/", "http://com/x", "http://a.net/es/", "http://net/fr/x",
    "http://a.net/fr", "http://ÉXAMPLE.com/é\n/x", "x://http://a.com/", "http://a.com:80/en/", "http://a.org/en/://b.com/", "http://u@b.com/",
    "http://a.org/" + "en/" * 50_000, "http://" + "a." * 20_000 + "net/es/",
]


def plain(url, rules=HOST_RULES):
    """Host, path, rule and verdict of the longest rule that fits."""
    _, found, rest = (url or "").partition("://")
    host = "".join(c.lower() if c.isascii() else c for c in re.match("[^/?#]*", rest)[0]) if found else ""
    path = re.match("[^?#]*", rest[len(host) :])[0] if found else ""
    fits = [r for r in rules if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
    best = max(fits, key=lambda r: len(r[1] + r[2]), default=None)
    return host, path, best and best[1] + best[2], best and best[0]


@pytest.mark.parametrize("hot_rows", [url_rules.HOT_ROWS, 2])
def test_host_rules_equal_the_plain_reading(spark, hot_rows):
    rng = random.Random(5)
    hosts = ["com", "example.com", "www.example.com", "xexample.com", "net", "a.net", "b.a.net", "org"]
    urls = ODD + [f"http://{rng.choice(hosts)}{rng.choice(['', '/', '/en/', '/es/', '/fr/x', '/en', '?q=/en/'])}" for _ in range(300)]
    pages = spark.createDataFrame([(u, i) for i, u in enumerate(urls)], "url string, verdict int")
    rules = url_rules.rule_table(spark, url_rules.host_rules(HOST_RULES))
    found = {r["row"]["verdict"]: r for r in url_rules.judge(pages, rules, "default", hot_rows=hot_rows).collect()}
    assert len(found) == len(urls)
    for i, url in enumerate(urls):
        host, path, rule, verdict = plain(url)
        assert tuple(found[i])[1:4] == (host, path, rule) and found[i]["verdict"] == (verdict or "default"), url


def test_patterns(spark):
    patterns = ["||ads.", "|http", "^track^", "/a*b/", ".zip|", "*", "||x.com/p(1)+", "|exact.org/|", "||good.com^", "en*", "Ad/Big"]
    rules = url_rules.rule_table(spark, [(p, p, "block") for p in patterns])
    urls = {
        "http://ads.a.com/": {"||ads."}, "http://b.ads.com/": {"||ads."}, "http://bads.com/": set(), "x://http.com/": {"|http"},
        "http://a.org/track?x": {"^track^"}, "http://a.org/track": {"^track^"}, "http://a.org/tracks": set(), "http://a.org/a-1/b/": {"/a*b/"},
        "http://a.org/x.zip": {".zip|"}, "http://a.org/x.zip?y": set(), "http://x.com/p(1)+": {"||x.com/p(1)+"}, "http://x.com/p11": set(),
        "http://exact.org/": {"|exact.org/|"}, "http://exact.org/a": set(), "http://good.com:8/": {"||good.com^"}, "http://good.com.a/": set(),
        "http://a.org/hen": {"en*"}, "http://a.org/Ad/Big": {"Ad/Big"}, "http://a.org/ad/big": set(),
    }
    pages = spark.createDataFrame([(u,) for u in urls], "url string")
    judged = [url_rules.judge(pages, rules.filter(F.col("pattern") == p)) for p in patterns]
    found = {u: set() for u in urls}
    for one in judged:
        for r in one.filter("rule IS NOT NULL").collect():
            found[r["row"]["url"]].add(r["rule"])
    assert found == {u: fits | {"*"} for u, fits in urls.items()}


def test_only_rules_of_the_rarest_token_are_run(spark):
    pages = spark.createDataFrame([(f"http://h{i % 50}.com/news/{i}",) for i in range(1000)], "url string")
    rules = url_rules.compiled(url_rules.rule_table(spark, [(str(i), f"||h{i}.com/news/", "block") for i in range(60)]))
    urls = pages.select("url", url_rules.parts(F.col("url"))[2].alias("subject"))
    index = url_rules.rarest(urls, rules)
    assert {(r.rule, r.token, r.places) for r in index.collect()} == {(str(i), f"h{i}", 20 if i < 50 else 0) for i in range(60)}
    assert url_rules.candidates(urls, index).count() == 1000  # not 60000


def test_ties_tiers_empty_tables_and_limits(spark):
    pages = spark.createDataFrame([("http://a.com/",)] * 3 + [(None,)], "url string")
    same = [("b", "||a.com/", "allow"), ("a", "||a.com/", "allow"), ("c", "||a.com/", "block"), ("a", "||a.com/", "allow")]
    judged = url_rules.judge(pages, url_rules.rule_table(spark, same, [("long", "||a.com/*", "allow")])).collect()
    assert sorted((r.rule or "", r.verdict) for r in judged) == [("", "allow")] + [("c", "block")] * 3
    assert url_rules.judge(pages, url_rules.rule_table(spark, []), "block").filter("verdict = 'block' AND rule IS NULL").count() == 4
    assert url_rules.judge(pages.filter("false"), url_rules.rule_table(spark, same)).count() == 0
    with pytest.raises(ValueError):
        url_rules.judge(pages, url_rules.rule_table(spark, [(str(i), f"a{i}", "block") for i in range(url_rules.TOKENLESS + 1)]))
    with pytest.raises(ValueError):
        url_rules.host_rules([("block", "a.com", "")])


def test_query_on_planted_pages(spark, tmp_path):
    urls = ODD + [f"http://x.{h}{p}" for h in ("spam-farm.org", "a-casino.net", "b.org") for p in ("/wp-login.php", "/cart/", "/a?sessionid=1", "/a.zip")]
    pages = spark.createDataFrame([(i, u, "<p>") for i, u in enumerate(urls)], "page_id long, url string, html string")
    pages.coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    duck = database("/root/testdata/sf0.001")
    duck.execute(f"CREATE OR REPLACE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    found = registered.op12_url_rules(spark, str(tmp_path))
    _, problems = differences(found, duck, oracle.oracle_sql()["op12_url_rules"])
    assert not problems and found.filter("pattern IS NOT NULL").count() >= 12
