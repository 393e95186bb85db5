import itertools
import math
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tierline.llm.queries import URL_RULES
from tierline.llm.url_rules import KINDS, Rule, RuleIndex, judge_urls, listed, mine_rules, most_combinations, prune, url_host, \
    url_path, url_tokens

PAGES = StructType([StructField("page_id", LongType()), StructField("url", StringType())])


def some_url(rng):
    host = ".".join(rng.choice(p) for p in (["m", "blog", "www"], ["ads-x", "shop", "news"], ["example", "other"],
                                            ["com", "net", "org"]))
    return (f"{rng.choice(['http', 'https', 'HTTP'])}://{host.split('.', rng.randrange(2))[-1]}"
            f"/{rng.choice(['en', 'de', 'fr'])}/{rng.choice(['12', '7.html', 'a/b', ''])}"
            + rng.choice(["", "?b=1&a=2", "?ref=x", "#top", "?x#y"]))


def combos(tokens):
    return [c for n in range(1, len(tokens) + 1) for c in itertools.combinations(sorted(tokens), n)]


def brute_rules(rows, support, confidence):
    """(tokens, label) -> (confidence, support), by counting every combination of every row."""
    every, with_label = {}, {}
    for tokens, label in rows:
        for c in combos(tokens):
            every[c] = every.get(c, 0) + 1
            with_label[c, label] = with_label.get((c, label), 0) + 1
    least = math.ceil(support * len(rows))
    return {k: (n / every[k[0]], n / len(rows)) for k, n in with_label.items()
            if n >= least and n / every[k[0]] >= confidence}


@pytest.fixture(scope="module")
def urls(spark):
    rng = random.Random(2)
    return spark.createDataFrame([(i, some_url(rng)) for i in range(400)], PAGES)


def test_mined_rules_equal_counting(spark, urls):
    labelled = urls.select("url", F.when(F.contains("url", F.lit("ads-x")), "block").when(
        F.contains("url", F.lit("/en/")), "allow").when(F.col("page_id") % 3 == 0, "block").alias("label"))
    rows = [(r.t, r.label) for r in labelled.where("label IS NOT NULL").select(url_tokens(F.col("url")).alias("t"), "label").collect()]
    for support, confidence in ((0.05, 0.8), (0.2, 0.5)):
        want = brute_rules(rows, support, confidence)
        got = mine_rules(spark, labelled, support=support, confidence=confidence)
        assert [r.rank() for r in got] == sorted(r.rank() for r in got)
        assert {(r.tokens, r.label): (r.confidence, r.support) for r in got}.items() <= want.items()
        gone = set(want) - {(r.tokens, r.label) for r in got}
        kept = {(r.tokens, r.label): r.confidence for r in got}
        for tokens, label in gone:      # a kept rule says the same with fewer tokens
            assert any(kept.get((c, label), -1) >= want[tokens, label][0] for c in combos(tokens) if len(c) < len(tokens))
        for tokens, label in kept:
            assert not any((c, label) in want and want[c, label][0] >= kept[tokens, label]
                           for c in combos(tokens) if len(c) < len(tokens))
        # pruning changes no verdict: the first of all rules that fit is among the kept ones
        everything = sorted((Rule(k[0], k[1], *v) for k, v in want.items()), key=Rule.rank)
        index = RuleIndex(got)
        for tokens, _ in rows:
            assert index.first_match(tokens) == next((r for r in everything if set(r.tokens) <= set(tokens)), None)


def test_verdicts_of_whole_table(spark, urls):
    pages = [tuple(r) for r in urls.collect()]
    got = {r.page_id: r for r in judge_urls(spark, urls, URL_RULES, support=0.02).collect()}
    assert len(got) == len(pages)
    for page_id, url in pages:
        rest = url.split("://", 1)[1]
        host = rest.split("#")[0].split("?")[0].split("/")[0].lower()
        path = rest.split("#")[0].split("?")[0][len(host):]
        fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        best = max(fits, key=lambda r: len(r.text), default=None)
        r = got[page_id]
        assert (r.host, r.path, r.rule) == (host, path, best and best.text)
        assert r.verdict == (best.verdict if best else r.verdict) and r.verdict in ("allow", "block")
        assert best is None or r.evidence is None


def test_hosts_paths_and_tokens(spark):
    rows = [(1, "HTTP://WWW.Shop.Example.COM/EN/page12.HTML?b=1&a#x"), (2, None), (3, "no scheme/x"), (4, "http://"),
            (5, "x://a?b=http://c/d"), (6, "https://[::1]/"), (7, "http://h.net"), (8, "http://net/x"), (9, "://.net//"),
            (10, "http://É.org/fr/\n?é"), (11, ""), (None, "http://a.b.c.d.e/en/")]
    df = spark.createDataFrame(rows, PAGES)
    got = {r.page_id: r for r in df.select("page_id", url_host(F.col("url")).alias("h"), url_path(F.col("url")).alias("p"),
                                           url_tokens(F.col("url")).alias("t")).collect()}
    assert {k: (r.h, r.p) for k, r in got.items()} == {
        1: ("www.shop.example.com", "/EN/page12.HTML"), 2: ("", ""), 3: ("", ""), 4: ("", ""), 5: ("a", ""),
        6: ("[::1]", "/"), 7: ("h.net", ""), 8: ("net", "/x"), 9: (".net", "//"), 10: ("É.org", "/fr/\n"), 11: ("", ""),
        None: ("a.b.c.d.e", "/en/")}
    assert got[1].t == ["scheme:http", "tld:com", "site:example.com", "name:shop", "sub:www", "dir:EN", "page:page#.HTML",
                        "ext:HTML", "keys:a,b", "frag:yes"]
    assert not got[2].t and got[3].t == [] and got[4].t == ["scheme:http"]
    assert all(len({t.split(":")[0] for t in r.t or []}) == len(r.t or []) <= len(KINDS) for r in got.values())
    judged = {r.page_id: r for r in judge_urls(spark, df, URL_RULES).collect()}
    assert len(judged) == len(rows)
    assert {k: r.rule for k, r in judged.items() if r.rule} == {8: "net/", 9: "net/", 10: "org/fr/"}
    assert judged[2].verdict == judged[3].verdict == judged[11].verdict == "allow"


def test_edges(spark, urls):
    empty = spark.createDataFrame([], PAGES)
    assert judge_urls(spark, empty, URL_RULES).collect() == []
    long = "http://x.net/" + "a" * 300_000
    rows = [(1, long), (1, long), (None, long), (2, "http://q.com/" + "s/" * 5000)]
    got = judge_urls(spark, spark.createDataFrame(rows, PAGES), URL_RULES).collect()
    assert sorted((r.page_id or 0, r.verdict) for r in got) == [(0, "block"), (1, "block"), (1, "block"), (2, "block")]
    clashing = urls.withColumns({c: F.lit("x") for c in ("host", "path", "rule", "verdict", "tokens", "label", "items")})
    plain = {tuple(r) for r in judge_urls(spark, urls, URL_RULES).collect()}
    assert {tuple(r) for r in judge_urls(spark, clashing, URL_RULES).collect()} == plain
    nobody = urls.select("url", F.lit(None).cast("string").alias("label"))
    assert {r.verdict for r in judge_urls(spark, urls, [], nobody, default="block").collect()} == {"block"}


def test_bound_of_the_rules_and_pruning():
    assert most_combinations(0.01) == (2 ** len(KINDS) - 1) * 100
    rules = [Rule(("a",), "block", 0.9, 0.5), Rule(("a", "b"), "block", 0.9, 0.4), Rule(("a", "c"), "block", 1.0, 0.1),
             Rule(("a", "b"), "allow", 0.95, 0.1)]
    assert prune(rules) == [rules[0], rules[2], rules[3]]


def test_longest_listed_rule_wins(spark):
    rows = spark.createDataFrame([("m.example.net", "/en/1"), ("example.net", "/en"), ("badexample.net", "/en/"),
                                  ("x.example.com", "/de/"), ("example.org", "/fr/1"), ("network", "/")], "h string, p string")
    text, verdict = listed(F.col("h"), F.col("p"), URL_RULES)
    assert [tuple(r) for r in rows.select(text, verdict).collect()] == [
        ("example.net/en/", "allow"), ("net/", "block"), ("net/", "block"), ("example.com/de/", "block"),
        ("org/fr/", "allow"), (None, None)]
