from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_helpers import SMALL, collected, workers_find_the_package  # noqa: F401
from millrace.llm import urls
from millrace.llm.queries import URL_RULES, op13_url_filter
from millrace.llm.urls import ALLOW, BLOCK, DigestArray, Rule, allowed_pages, digest_array, url_verdicts

URLS = ["http://a.com/x", "https://EXAMPLE.com/en/1?q=/de/", "https://www.example.com/en/1#top", "http://sub.www.example.com/en/",
        "http://notexample.com/en/", "https://example.com/EN/1", "http://x.net/es/1", "http://net/fr/", "http://internet/es/", None, "",
        "no scheme", "http://", "http:///es/", "http://x.net", "http://x.net?/es/", "http://x.net#/es/", "a://b://x.net/es/",
        "http://x.net./es/", "http://\u00c4.net/es/\u00e9", "http://user@x.net/fr/a", "http://x.net:80/fr/", "http://x.net/fr/\n/b",
        "http://x.net/es/" + "p" * 100_000, "http://" + "a." * 20_000 + "net/es/"]


def plain(url: str | None, rules) -> tuple:
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([at for at in map(rest.find, "/?#") if at >= 0], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[:min([at for at in map(path.find, "?#") if at >= 0], default=len(path))]
    fits = [rule for rule in rules if (host == rule.host or not rule.host or host.endswith("." + rule.host))
            and path.startswith(rule.path)]
    best = max(fits, key=lambda rule: (len(rule.text), len(rule.host)), default=None)
    return host, path, best and best.text, best.verdict if best else ALLOW


def pages(spark, texts: list) -> list:
    rows = spark.createDataFrame(list(enumerate(texts)), "page_id long, url string").repartition(3)
    return rows.withColumns({name: F.lit(name) for name in ("host", "path", "rule", "verdict", "rest")})


def test_verdicts_equal_a_plain_version(spark):
    found = [tuple(row) for row in url_verdicts(pages(spark, URLS), URL_RULES).orderBy("page_id").collect()]
    assert found == [(number, *plain(url, URL_RULES)) for number, url in enumerate(URLS)]


def test_rules_of_other_shapes(spark):
    rules = [Rule(BLOCK, "", ""), Rule(ALLOW, "b.c", "/x"), Rule(BLOCK, "a.b.c", ""), Rule(ALLOW, "C", "/\u00e9"),
             Rule(ALLOW, "d.c", ""), Rule(BLOCK, "d.c", "")]
    texts = ["http://a.b.c/x", "http://b.c/x", "http://c/\u00e9a", "http://d.c/", "nothing", None]
    lowered = [Rule(rule.verdict, rule.host.lower(), rule.path) for rule in rules if rule.text != "d.c" or rule.verdict == BLOCK]
    found = [tuple(row) for row in url_verdicts(pages(spark, texts), rules).orderBy("page_id").collect()]
    assert found == [(number, *plain(url, lowered)) for number, url in enumerate(texts)]
    with pytest.raises(ValueError):
        Rule("maybe", "a")


def test_equal_digests_are_told_apart_by_their_strings(monkeypatch):
    monkeypatch.setattr(urls.xxhash, "xxh64_intdigest", lambda text: len(text) % 2)
    rules = [Rule(BLOCK, f"h{i}.org", "/a/") for i in range(50)] + [Rule(ALLOW, f"k{i}.org", "/") for i in range(50)]
    array = DigestArray(np.frombuffer(digest_array(rules), np.uint8))
    best = array.best(["h7.org", "x.k8.org", "h50.org", "h9.org"], ["/a/b", "/", "/a/", "/b"])
    assert [number if number < 0 else array.text(number) for number in best] == [b"h7.org/a/", b"k8.org/", -1, -1]


def test_a_long_list_is_searched_through_the_mapped_file(spark):
    rules = [Rule(BLOCK if i % 2 else ALLOW, f"site{i}.example", "/p/") for i in range(20_000)]
    texts = [f"http://www.site{i}.example/p/{i}" for i in range(0, 30_000, 97)]
    found = [tuple(row) for row in url_verdicts(pages(spark, texts), rules, default=BLOCK).orderBy("page_id").collect()]
    for (number, _, _, rule, verdict), i in zip(found, range(0, 30_000, 97)):
        assert (rule, verdict) == ((f"site{i}.example/p/", BLOCK if i % 2 else ALLOW) if i < 20_000 else (None, BLOCK))


def test_no_rules_no_pages_and_a_list_that_is_too_long(spark, monkeypatch):
    assert {row["verdict"] for row in url_verdicts(pages(spark, URLS), []).collect()} == {ALLOW}
    assert url_verdicts(pages(spark, URLS).limit(0), URL_RULES).count() == 0
    monkeypatch.setattr(urls, "MAX_LIST_BYTES", 10)
    with pytest.raises(ValueError):
        digest_array(URL_RULES)


def test_allowed_pages_keep_their_columns_and_repeated_rows(spark):
    table = pages(spark, URLS + URLS[:2])
    kept = allowed_pages(table, URL_RULES)
    assert kept.columns == table.columns
    texts = URLS + URLS[:2]
    assert sorted(row["page_id"] for row in kept.collect()) == \
        [i for i, url in enumerate(texts) if plain(url, URL_RULES)[3] == ALLOW]


def test_the_query_does_not_shuffle(spark):
    query = op13_url_filter(spark, SMALL)
    assert "Exchange" not in query._jdf.queryExecution().toString()
    assert len(collected(query)) == spark.read.parquet(f"{SMALL}/pages.parquet").count()
