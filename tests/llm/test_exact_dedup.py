import hashlib
import random

import pytest

from tierline.llm.exact_dedup import exact_dedup


def brute(rows, keep):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    best = {t: (max if keep == "max" else min)((i for i in ids if i is not None), default=None)
            for t, ids in groups.items()}
    return sorted(((i, best[t or ""], len(groups[t or ""]), hashlib.sha256((t or "").encode()).hexdigest())
                   for i, t in rows), key=repr)


def check(out, rows, keep="max"):
    got = [(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in out]
    assert sorted(got, key=repr) == brute(rows, keep)
    kept = [r for r in out if r.kept]
    assert len(kept) == len({t or "" for _, t in rows})
    assert all(r.doc_id == r.keep_id for r in kept)


@pytest.mark.parametrize("keep", ["max", "min"])
def test_random_groups_and_one_hot_text(spark, docs_of, keep):
    rng = random.Random(4)
    texts = ["hot text"] * 500 + [f"t{rng.randrange(40)}" for _ in range(300)] + ["a" * 40 + str(i % 7) for i in range(60)]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    check(exact_dedup(spark, docs_of(rows), keep=keep).collect(), rows, keep)


def test_edges(spark, docs_of, with_clashes):
    rows = [(1, None), (2, ""), (None, ""), (3, "x"), (3, "x"), (None, "y"), (None, "y"), (5, "z" * 300_000),
            (6, "z" * 300_000), (7, "z" * 299_999 + "y"), (8, " x"), (9, "X"), (10, "é"), (11, "é")]
    check(exact_dedup(spark, with_clashes(docs_of(rows))).collect(), rows)


def test_empty_table(spark, docs_of):
    assert exact_dedup(spark, docs_of([])).collect() == []


def test_hot_text_is_split_over_ranges(spark, docs_of):
    rows = [(i, "same") for i in range(4000)]
    out = exact_dedup(spark, docs_of(rows))
    assert {(r.keep_id, r.group_size) for r in out.collect()} == {(3999, 4000)}
