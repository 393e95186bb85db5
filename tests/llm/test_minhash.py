import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tierline.llm import words as W
from tierline.llm.components import connected_components
from tierline.llm.minhash import near_duplicates


def flat(texts):
    return np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0] + [len(t) for t in texts])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.binary(max_size=30).map(lambda b: bytes(b" \tabAB\n\x0b\xc3"[x % 9] for x in b)), min_size=1, max_size=8),
       st.booleans())
def test_word_fingerprints_name_the_words(texts, lower):
    values, first = W.word_hashes(*flat(texts), lower)
    by_word, by_value = {}, {}
    for i, t in enumerate(texts):
        words = (t.lower() if lower else t).split()
        assert first[i + 1] - first[i] == len(words)
        for w, v in zip(words, values[first[i]:first[i + 1]].tolist()):
            assert by_word.setdefault(w, v) == v and by_value.setdefault(v, w) == w


def test_words_longer_than_a_block(monkeypatch):
    texts = [b"short " + b"x" * 5000 + b" tail", b"y" * 3000, b""]
    whole = W.word_hashes(*flat(texts), False)
    monkeypatch.setattr(W, "BLOCK", 64)
    W._powers.cache_clear()
    cut = W.word_hashes(*flat(texts), False)
    W._powers.cache_clear()
    assert (whole[0] == cut[0]).all() and (whole[1] == cut[1]).all()


def shingles(text, n=5):
    w = (text or "").encode().lower().split()
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)])


def brute(rows, percent):
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                ra, rb = sorted((find(a), find(b)))
                root[rb] = ra
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def check(spark, df, rows, percent):
    out = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(spark, df, percent).collect()}
    assert out == brute(rows, percent)


def edited(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"e{rng.randrange(10 ** 6)}"
    return out


def test_clusters_around_the_threshold(spark, docs_of):
    """Copies of a few bases with 0 to 6 edited words: similarities from 0.6 to 1."""
    rng = random.Random(8)
    rows, bases = [], [[f"w{rng.randrange(3000)}" for _ in range(rng.choice([60, 120, 200]))] for _ in range(6)]
    for i in range(260):
        rows.append((i, " ".join(edited(rng, rng.choice(bases), rng.randrange(7)))))
    for percent in (80, 85):
        check(spark, docs_of(rows), rows, percent)


def test_chain_of_links(spark, docs_of):
    """Neighbours are linked, ends are not: only a component joins them."""
    words = [f"w{i}" for i in range(140)]
    rows = [(100 - i, " ".join(words[3 * i:3 * i + 100])) for i in range(14)]
    check(spark, docs_of(rows), rows, 85)


def test_edges(spark, docs_of, with_clashes):
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one two"), (5, "ONE  two"), (6, "two one"), (7, "a b c d e"),
            (8, "A B\nc\td E"), (9, "cafÉ b c d e"), (10, "café b c d e"), (11, "w " * 60_000), (12, "w " * 70_000),
            (13, "a b c d e f"), (14, "x" * 200_000)]
    check(spark, with_clashes(docs_of(rows)), rows, 85)


def test_repeated_rows_and_null_ids(spark, docs_of):
    text = " ".join(f"w{i}" for i in range(30))
    out = near_duplicates(spark, docs_of([(5, text), (5, text), (3, text), (None, text), (None, "")])).collect()
    assert sorted([(r.doc_id, r.component_id, r.kept) for r in out], key=repr) == sorted(
        [(5, 3, False), (5, 3, False), (3, 3, True), (None, None, True), (None, None, True)], key=repr)


def test_empty_table(spark, docs_of):
    assert near_duplicates(spark, docs_of([])).collect() == []


def test_components_of_paths_stars_and_loops(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 60)] + [(200, 200 + i) for i in range(1, 40)] + [(500, 500)]
    edges += [(rng.randrange(1000, 1080), rng.randrange(1000, 1080)) for _ in range(70)]
    rng.shuffle(edges)
    root = {}

    def find(i):
        while root.setdefault(i, i) != i:
            i = root[i]
        return i

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    got = {r.node: r.component for r in connected_components(spark, spark.createDataFrame(edges, "u long, v long")).collect()}
    want = {i: find(i) for a, b in edges if a != b for i in (a, b)}
    assert got == want


def test_texts_of_one_template_never_meet_in_pairs(spark, docs_of, monkeypatch):
    """Texts that share nine tenths of their shingles stay below the threshold; the rows
    compared in prefix buckets must not grow with the square of their number."""
    import tierline.llm.minhash as M
    from pyspark.sql import functions as F
    real, counted = M._links, []

    def links(members, pivots, *rest):
        meet = (F.col("bucket") == F.col("of")) & (F.col("component") != F.col("pivot_component"))
        counted.append(members.join(pivots, meet).count())
        return real(members, pivots, *rest)

    monkeypatch.setattr(M, "_links", links)
    rng, rows = random.Random(2), {}
    template = [f"w{i}" for i in range(400)]
    for n in (40, 80):
        counted.clear()
        docs = [(i, " ".join(template + [f"own{i}x{j}" for j in range(rng.randrange(40, 60))])) for i in range(n)]
        got = near_duplicates(spark, docs_of(docs), percent=85).collect()
        assert all(r.component_id == r.doc_id for r in got)
        rows[n] = sum(counted[1:])      # the first call is over band buckets
    assert rows[80] <= 3 * rows[40] + 80
