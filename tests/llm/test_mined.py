"""Mined URL rules against a brute-force search over all sets of tokens."""

import collections
import itertools

from sitrep.llm import urls

SF = "/root/testdata/sf0.01"


def brute(baskets, min_support, min_pages, min_confidence, min_lift):
    n = len(baskets)
    least = max(min_support, min_pages / n)
    count, bad = collections.Counter(), collections.Counter()
    for items in baskets:
        blocked = urls.BLOCKED in items
        tokens = sorted(set(items) - {urls.BLOCKED})
        for size in range(1, len(tokens) + 1):
            for found in itertools.combinations(tokens, size):
                count[found] += 1
                bad[found] += blocked
    share = sum(urls.BLOCKED in b for b in baskets) / n
    rules = {
        s: bad[s] / count[s]
        for s in count
        if bad[s] >= least * n and bad[s] / count[s] >= min_confidence and bad[s] / count[s] / share >= min_lift
    }
    shorter = lambda s: [tuple(x for x in s if x != y) for y in s]
    return {(s, round(c, 9), round(bad[s] / n, 9)) for s, c in rules.items() if not any(rules.get(t, 0) >= c for t in shorter(s))}


def test_rules_of_the_given_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    labelled = urls.ruled_labels(pages)
    baskets = [(*r.tokens, *([urls.BLOCKED] if r.bad else [])) for r in labelled.select(urls.tokens_of(labelled["url"]).alias("tokens"), "bad").collect()]
    for settings in ({}, {"min_pages": 3, "min_confidence": 0.6, "min_lift": 1.2}):
        found = {(tuple(r.antecedent), round(r.confidence, 9), round(r.support, 9)) for r in urls.mined_rules(labelled, **settings).collect()}
        wanted = brute(baskets, 0.005, settings.get("min_pages", 5), settings.get("min_confidence", 0.8), settings.get("min_lift", 1.5))
        assert found == wanted
    assert found


def test_matched_urls_by_brute_force(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    rules = urls.mined_rules(urls.ruled_labels(pages), min_pages=5)
    sets = [set(r.antecedent) for r in rules.collect()]
    tokens = pages.select("url", urls.tokens_of(pages["url"]).alias("t")).collect()
    wanted = {r.url for r in tokens if any(s <= set(r.t) for s in sets)}
    assert sets and {r.url for r in urls.matched(pages, rules).collect()} == wanted
    blocked = {r.page_id for r in urls.judged(pages, min_pages=5).where("rule IS NULL AND verdict = 'block'").collect()}
    undecided = {r.page_id for r in urls.judged(pages, min_pages=5).where("rule IS NULL").collect()}
    assert blocked == {r.page_id for r in pages.collect() if r.url in wanted} & undecided


def test_conflicting_and_empty_labels(spark):
    pages = spark.createDataFrame([(1, "http://a.net/x"), (1, "http://b.net/x"), (2, None), (3, "http://c.net/y")], "page_id long, url string")
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (3, None, None), (3, 1, None), (2, 0, 1)], "doc_id long, quality int, toxic int")
    found = sorted((r.url, r.bad) for r in urls.page_labels(pages, labels).collect())
    assert found == [("http://a.net/x", True), ("http://b.net/x", True)]
    assert urls.mined_rules(urls.page_labels(pages, labels)).count() == 0
    assert urls.judged(pages.limit(0)).count() == 0
