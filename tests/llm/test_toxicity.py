import math
import random

import pytest
from pyspark.sql import functions as F

from tierline.llm.queries import op10_toxicity
from tierline.llm.toxicity import ToxicityModel, chance, density, fold, keep_clean, learn, lexicon, matches, phrases_of, score

MODEL = ToxicityModel({" idiot ": 5.0, " vequ": 4.0, " trash ": 4.0}, ("trash can",), 2.0, -4.0)


@pytest.mark.parametrize("text,want", [
    ("You IDIOT!", " you idiot "), ("1d10t", " idiot "), ("id!ot", " idiot "), ("іdіоt", " idiot "), ("ｉｄｉｏｔ", " idiot "),
    ("in 2024 at 10", " in 2024 at 10 "), ("", " "), (" \n", " "), ("a_b--c", " a b c ")])
def test_folding(text, want):
    assert fold(text) == want


def test_matching_with_exceptions_and_beginnings():
    key = MODEL.key()
    assert matches(fold("idiot, an 1diot; idiots"), key) == (10.0, 2)
    assert matches(fold("vequju vequ équ vvequ"), key) == (8.0, 2)
    assert matches(fold("the trash can and trash"), key) == (4.0, 1)
    assert matches(fold(""), key) == (0.0, 0)
    assert matches(fold("idiot"), ToxicityModel().key()) == (0.0, 0)


def test_lexicon_prefers_the_common_beginning_or_the_whole_word():
    counts = [(" vequ", 90, 0), (" vequa", 30, 0), (" vequa ", 30, 0), (" veq", 90, 0), (" idi", 50, 0), (" idio", 50, 0),
              (" idiot", 50, 0), (" idiot ", 49, 0), (" the ", 95, 500)]
    assert set(lexicon(counts, 100, 1000)) == {" vequ", " idiot "}


def test_learning_and_held_out_accuracy(spark, sf_small):
    sf = sf_small.replace("0.001", "0.01")
    out = op10_toxicity(spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    rows = out.join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 50
    assert sum(r.predicted == r.toxic for r in rows) / len(rows) >= 0.95
    assert out.count() == spark.read.parquet(f"{sf}/documents.parquet").count()


def test_labels_of_held_out_rows_change_nothing(spark, docs_of):
    rng = random.Random(1)
    rows = [(i, " ".join(["w%d" % rng.randrange(50) for _ in range(30)] + (["badword"] if i % 4 == 0 else [])))
            for i in range(200)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(200)], "doc_id long, toxic int")
    train = F.col("doc_id") % 5 != 0
    flipped = labels.withColumn("toxic", F.when(train, F.col("toxic")).otherwise(1 - F.col("toxic")))
    a, b = (learn(spark, docs_of(rows), x, train) for x in (labels, flipped))
    assert a == b and " badword " in a.weights


def test_edges(spark, docs_of, with_clashes):
    rows = [(1, None), (2, ""), (None, "idiot idiot"), (3, "idiot"), (3, "idiot"), (4, "fine words " * 30_000), (5, "\x00 �")]
    out = score(with_clashes(docs_of(rows)), MODEL).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    assert {r.doc_id for r in out if r.score >= 0.5} == {3, None}
    df = with_clashes(docs_of(rows))
    kept = keep_clean(df, MODEL)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2, 4, 5]
    assert score(docs_of([]), MODEL).collect() == []


def test_without_labels_of_both_classes_all_is_clean(spark, docs_of):
    labels = spark.createDataFrame([(1, 0), (2, None)], "doc_id long, toxic int")
    model = learn(spark, docs_of([(1, "a"), (2, "b")]), labels, F.lit(True))
    assert all(r.score < 0.01 for r in score(docs_of([(1, "a"), (2, None)]), model).collect())


def _naive(text, model):
    """Every pattern tried at every place of the folded text."""
    s, hits, covered = fold(text), {}, set()
    for at in range(len(s)):
        for p, w in model.weights.items():
            if s.startswith(p, at):
                hits[at] = max(hits.get(at, 0.0), w)
        for p in model.exceptions:
            if s.startswith(f" {p} ", at):
                covered.update(range(at, at + len(p) + 1))
    return sum(w for at, w in hits.items() if at not in covered), sum(at not in covered for at in hits)


def test_scores_equal_a_naive_scan(spark, docs_of):
    rng = random.Random(7)
    words = ["ab", "abc", "abcd", "bcd", "trash", "can", "c4n", "tr@sh", "vequju", "veq", "été", "аb", "x"]
    model = ToxicityModel({" ab": 3.0, " abc ": 4.5, " trash ": 3.5, " vequ": 4.0, " bcd ": 3.2},
                          ("trash can", "ab x", "x abc", "can"), 2.0, -3.0)
    rows = [(i, rng.choice(["", " ", "-", "\n"]).join(rng.choice(words) + rng.choice([" ", "", "!", "_"])
                                                    for _ in range(rng.randrange(60)))) for i in range(300)]
    got = {r.doc_id: r for r in score(docs_of(rows), model).collect()}
    for i, text in rows:
        weight, n = _naive(text, model)
        assert matches(fold(text), model.key()) == pytest.approx((weight, n)) and got[i].n_matches == n
        z = model.slope * density(weight, len(fold(text).split())) + model.intercept
        assert got[i].score == pytest.approx(1 / (1 + math.exp(-z)))
        assert got[i].score == chance(model.key(), model.slope, model.intercept, text)[0]


def test_phrases_around_matches():
    key = MODEL.key()
    assert phrases_of(fold("an idiot here"), key) == {"an idiot", "idiot here"}
    assert phrases_of(fold("idiot"), key) == set() and phrases_of(fold("fine"), key) == set()
    assert phrases_of(fold("trash can"), key) == set()      # an exception is no match


def test_harmless_phrases_are_learnt(spark, docs_of):
    """A word of toxic texts that clean ones have in one fixed phrase only, in any language."""
    rng = random.Random(3)
    fill = lambda: " ".join(f"w{rng.randrange(50)}" for _ in range(20))
    rows = [(i, fill() + (" schrott haufen " if i % 12 == 0 else " schrott " if i % 3 == 1 else " ") + fill())
            for i in range(600)]
    labels = spark.createDataFrame([(i, int(i % 3 == 1)) for i in range(600)], "doc_id long, toxic int")
    model = learn(spark, docs_of(rows), labels, F.lit(True), exceptions=())
    assert "schrott haufen" in model.exceptions and any(" schrott".startswith(p.rstrip()) for p in model.weights)
    clean = [(1, "schrott haufen w1 w2"), (2, "w1 schrott w2")]
    got = {r.doc_id: r.n_matches for r in score(docs_of(clean), model).collect()}
    assert got == {1: 0, 2: 1}
