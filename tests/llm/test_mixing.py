import hashlib
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tierline.llm.mixing import mix_sources

SCHEMA = StructType([StructField("doc_id", LongType()), StructField("text", StringType()),
                     StructField("lang", StringType()), StructField("source", StringType())])
LEVELS = ["domain", "lang", "source"]


def levels():
    return {"domain": F.substring("source", 1, 1), "lang": F.col("lang"), "source": F.col("source")}


def fill(target, children):
    """Budgets by repeated sharing: children = {name: (weight, capacity)}."""
    got = {n: None for n in children}
    while True:
        free = [n for n in children if got[n] is None and children[n][0] > 0]
        left = target - sum(v for v in got.values() if v is not None)
        total = sum(children[n][0] for n in free)
        full = [n for n in free if children[n][1] * total <= left * children[n][0]]
        if not full:
            return {n: got[n] if got[n] is not None else
                    max(0, left * children[n][0] // total) if n in free else 0 for n in children}
        for n in full:
            got[n] = children[n][1]


def brute(rows, weights, share, epochs, seed):
    leaf = {}
    for i, text, lang, source in rows:
        path = (source[0] if source else "(none)", lang or "(none)", source or "(none)")
        leaf.setdefault(path, []).append((i, len((text or "").split())))
    total = int(Fraction(share).limit_denominator(1000) * sum(t for d in leaf.values() for _, t in d))

    def down(prefix, target):
        depth = len(prefix)
        if depth == 3:
            return {prefix: target}
        kids = {}
        for path, docs in leaf.items():
            if path[:depth] == prefix:
                kids[path[depth]] = kids.get(path[depth], 0) + epochs * sum(t for _, t in docs)
        shares = fill(target, {k: (weights.get(LEVELS[depth], {}).get(k, 1), c) for k, c in kids.items()})
        out = {}
        for k, t in shares.items():
            out |= down((*prefix, k), t)
        return out

    chosen = []
    for path, target in down((), total).items():
        docs = leaf[path]
        size = sum(t for _, t in docs)
        if not size:
            continue
        whole, rest = divmod(target, size)
        chosen += [(i, e) for i, _ in docs for e in range(whole)]
        run = 0
        for i, t in sorted(docs, key=lambda d: hashlib.md5(f"{seed}-{whole}-{d[0]}".encode()).hexdigest()):
            run += t
            if rest and run <= rest:
                chosen.append((i, whole))
    return sorted(chosen)


def rows_of(seed, n):
    rng = random.Random(seed)
    return [(i, " ".join(["w"] * rng.randrange(1, 40)), rng.choice(["en", "en", "de", None]),
             "a0" if rng.random() < 0.4 else rng.choice(["a1", "b1", "b2", "c9", None])) for i in range(n)]


def check(spark, rows, weights, share, epochs):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = mix_sources(spark, df, levels(), weights, share, epochs, seed=5).collect()
    assert sorted((r.doc_id, r.mix_epoch) for r in got) == brute(rows, weights, share, epochs, 5)
    return got


def test_budgets_and_prefixes(spark):
    rows = rows_of(1, 600)
    check(spark, rows, {"domain": {"a": 1, "b": 3, "c": 2}, "lang": {"de": 4}}, 0.5, 1)


def test_shortage_goes_to_siblings_before_ancestors(spark):
    """c gives all it has in three epochs; the rest of its share goes to a and b."""
    rows = rows_of(2, 300)
    got = check(spark, rows, {"domain": {"c": 50, "(none)": 0}, "source": {"b1": 9}}, 0.7, 3)
    c = [(r.doc_id, r.mix_epoch) for r in got if r.mix_domain == "c"]
    assert len(c) == 3 * sum(r[3] == "c9" for r in rows)
    assert not [r for r in got if r.mix_source == "(none)"]


def test_everything_when_the_budget_is_all(spark):
    rows = rows_of(3, 80)
    got = check(spark, rows, {}, 1.0, 1)
    assert len(got) == len(rows)


def test_edges(spark, with_clashes):
    rows = [(1, None, None, None), (2, "", "en", "a"), (3, "one two", "en", "a"), (3, "one two", "en", "a"),
            (4, "w " * 100_000, "en", "a"), (None, "x y z", "en", "b"), (5, "p q", None, "b")]
    df = with_clashes(spark.createDataFrame(rows, SCHEMA))
    out = mix_sources(spark, df, levels(), {}, 1.0, 1)
    got = out.collect()
    assert sorted((r.doc_id for r in got), key=repr) == sorted([2, 3, 3, 4, None, 5], key=repr)   # 1 has no tokens
    assert {r.whole for r in got} == {"x"} and out.columns.count("mix_domain") == 1
    assert {r.mix_domain for r in got} == {"a", "b"}
    assert mix_sources(spark, spark.createDataFrame([], SCHEMA), levels(), {}, 0.5).collect() == []


def test_the_reachable_share_keeps_the_ratio_asked_for(spark):
    from tierline.llm.mixing import reachable_share
    level, weights = F.col("source"), {"a": 1, "b": 3}

    def share(sizes, **more):
        rows = [(i, " ".join(["w"] * n), s) for i, (s, n) in enumerate(sizes)]
        df = spark.createDataFrame(rows, "doc_id long, text string, source string")
        return reachable_share(df, level, weights, **more)

    assert share([("a", 10), ("b", 60)]) == pytest.approx(40 / 70)
    assert share([("a", 50), ("b", 30), ("b", 30)]) == pytest.approx(80 / 110)
    assert share([("a", 10), ("b", 30)]) == 1.0
    assert share([("a", 10), ("b", 60)], epochs=2) == pytest.approx(80 / 70)
    # values that are not listed don't limit the budget, and give their own share at most
    assert share([("a", 10), ("b", 60), (None, 1), ("c", 90)]) == pytest.approx((40 + 1 + 10) / 161)
    assert share([("a", 0), ("b", 5)]) == 1.0 and share([]) == 1.0 and share([(None, 4)]) == 1.0
