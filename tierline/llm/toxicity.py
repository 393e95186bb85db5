"""Toxicity by a weighted lexicon, matched with Aho-Corasick after folding.

Folding lower-cases, applies compatibility forms, replaces Cyrillic and Greek look-alikes
by Latin letters, and digits and signs inside words by the letters they stand for.  A
pattern is a whole word or the beginning of one.  Patterns and their weights (log odds)
are learnt from a bounded sample of the labelled training rows; phrases that carry a
pattern harmlessly are exceptions: some are given, others learnt from the same sample (a
matched word with its neighbour that clean texts have far oftener).  A text's weighted matches
outside exceptions, divided by its length, go through a logistic curve fitted on the same
sample.  Scoring covers every whole text, one automaton per Python worker.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.llm.common import ship_package, slices, stage, text_bytes, tidied

SAMPLE = 4000          # training rows per class at most: the bound of everything learnt
MOST_PATTERNS = 20_000  # of which the fit looks at this many at most, strongest first
LEAST_WEIGHT = 3.0     # log odds of a lexicon entry
SUPPORT = 0.002        # least share of the toxic sample that has it
BEGINNINGS = range(3, 9)
#: Letters that look like Latin ones, and what stands for letters in words.
HOMOGLYPHS = str.maketrans("авекмнорстухіјѕԁαβεικνορτυχ", "abekmhopctyxijsdabeikvoptux")
STAND_INS = str.maketrans("0134578@$!", "oieastbasi")
EXCEPTIONS = ("trash can", "trash bin", "trash bag", "rodeo clown", "clown fish")

_OTHER_SCRIPT = re.compile("[Ͱ-ԯ]")
#: Runs of stand-ins before, between and behind letters of a word.
_STAND_IN = re.compile(r"(?<![^\W_])[0134578]+(?=[^\W\d_])|(?<=[^\W\d_])[0134578@$!]+(?=[^\W_])"
                       r"|(?<=[^\W\d_])[0134578]+(?![^\W_])")
_BREAKS = re.compile(r"[\W_]+")


def fold(text: str) -> str:
    """Folded words, each with a space before and after it (" " for no words)."""
    s = unicodedata.normalize("NFKC", text).lower()
    if _OTHER_SCRIPT.search(s):
        s = s.translate(HOMOGLYPHS)
    s = _STAND_IN.sub(lambda m: m[0].translate(STAND_INS), s)
    s = _BREAKS.sub(" ", s).strip()
    return f" {s} " if s else " "


def patterns_of(folded: str) -> set[str]:
    """Beginnings and whole words of a folded text, as patterns."""
    out = set()
    for w in set(folded.split()):
        out.add(f" {w} ")
        out.update(f" {w[:k]}" for k in BEGINNINGS if k <= len(w))
    return out


@dataclass(frozen=True)
class ToxicityModel:
    weights: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = ()
    slope: float = 0.0
    intercept: float = 0.0

    def key(self) -> tuple:
        return tuple(sorted(self.weights.items())), tuple(sorted(self.exceptions))


@lru_cache(maxsize=4)
def _automaton(key: tuple):
    import ahocorasick

    weights, exceptions = key
    a = ahocorasick.Automaton()
    for p, w in weights:
        a.add_word(p, (len(p), w))
    for p in exceptions:
        a.add_word(f" {p} ", (len(p) + 2, None))
    if len(a):
        a.make_automaton()
    return a


def matches(folded: str, key: tuple) -> tuple[float, int]:
    """(total weight, number) of matches that no exception phrase covers.  Of patterns
    that begin at one place only the strongest counts."""
    hits = _hits(folded, key)
    return sum(hits.values()), len(hits)


def _hits(folded: str, key: tuple) -> dict[int, float]:
    """Place -> weight of the matches that count."""
    a = _automaton(key)
    hits: dict[int, float] = {}
    if not len(a):
        return hits
    covered = []
    for end, (n, w) in a.iter(folded):
        start = end - n + 1
        if w is None:
            covered.append((start, end))
        elif w > hits.get(start, 0.0):
            hits[start] = w
    for s, e in covered:
        for at in [at for at in hits if s <= at < e]:
            del hits[at]
    return hits


def chance(model_key: tuple, slope: float, intercept: float, text: str) -> tuple[float, int, int]:
    """(score, matches, words) of one text."""
    s = fold(text)
    weight, n = matches(s, model_key)
    words = s.count(" ") - 1
    z = slope * density(weight, words) + intercept
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z)))), n, words


def density(weight: float, words: int) -> float:
    """Length-normalised feature: weight per word, damped for short texts, on a log scale."""
    return math.log1p(100.0 * weight / (words + 20.0))


def _curve(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of a weighted, lightly damped logistic fit (Newton steps)."""
    m, beta = np.stack([x, np.ones_like(x)], 1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(m @ beta, -30, 30)))
        grad = m.T @ (w * (p - y)) + 0.05 * beta
        hess = (m * (w * p * (1 - p))[:, None]).T @ m + 0.05 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        beta -= step
        if np.abs(step).max() < 1e-6:
            break
    return float(beta[0]), float(beta[1])


def _count_patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            seen = (Counter(), Counter())
            for text, label in zip(part.column("text").to_pylist(), part.column("label").to_pylist()):
                seen[label].update(patterns_of(fold(text.decode("utf-8", "replace"))))
            names = list(seen[0].keys() | seen[1].keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array([seen[1][p] for p in names], pa.int64()),
                 pa.array([seen[0][p] for p in names], pa.int64())], names=["pattern", "toxic", "clean"])


def phrases_of(folded: str, key: tuple) -> set[str]:
    """Each matched word with the word before it, and with the word behind it."""
    out = set()
    for at in _hits(folded, key):
        end = folded.index(" ", at + 1)
        before, behind = folded.rfind(" ", 0, at), folded.find(" ", end + 1)
        if before >= 0:
            out.add(folded[before + 1:end])
        if behind >= 0:
            out.add(folded[at + 1:behind])
    return out


def _count_phrases(key: tuple):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for batch in batches for p in slices(batch, "text")):
            seen = (Counter(), Counter())
            for text, label in zip(part.column("text").to_pylist(), part.column("label").to_pylist()):
                seen[label].update(phrases_of(fold(text.decode("utf-8", "replace")), key))
            names = list(seen[0].keys() | seen[1].keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array([seen[1][p] for p in names], pa.int64()),
                 pa.array([seen[0][p] for p in names], pa.int64())], names=["pattern", "toxic", "clean"])

    return tidied(run)


COUNTS = "pattern string, toxic long, clean long"


def learnt_exceptions(texts: DataFrame, key: tuple, toxic_rows: int, clean_rows: int) -> list[str]:
    """Phrases around matches that enough clean texts of the sample have, and toxic ones at
    less than a quarter of their rate; the most common ones first, ``MOST_PATTERNS`` at most."""
    counted = (texts.select("text", "label").mapInArrow(_count_phrases(key), COUNTS)
               .groupBy("pattern").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
               .where(F.col("clean") >= max(3, math.ceil(SUPPORT * clean_rows)))
               .where(4 * (F.col("toxic") + 0.5) / toxic_rows < (F.col("clean") + 0.5) / clean_rows)
               .orderBy(F.col("clean").desc(), "pattern").limit(MOST_PATTERNS))
    return [r.pattern for r in counted.collect()]


def lexicon(counts: list[tuple[str, int, int]], toxic_rows: int, clean_rows: int,
            least_weight: float = LEAST_WEIGHT) -> dict[str, float]:
    """Weights of the patterns to keep.  A beginning gives way to the longer pattern that
    has nearly all of its toxic texts, and else stands for everything that begins so."""
    def odds(n: int, of: int) -> float:
        return math.log((n + 0.5) / (of - n + 0.5))

    toxic = {p: t for p, t, _ in counts}
    weight = {p: odds(t, toxic_rows) - odds(c, clean_rows) for p, t, c in counts}
    longer: dict[str, int] = {}
    for p in toxic:
        if len(p) > 2:
            longer[p[:-1]] = max(longer.get(p[:-1], 0), toxic[p])
    kept: dict[str, float] = {}
    for p in sorted(weight, key=lambda p: (len(p), p)):
        if weight[p] < least_weight or any(p[:k] in kept for k in range(2, len(p))):
            continue
        if longer.get(p, 0) < 0.9 * toxic[p]:
            kept[p] = weight[p]
    return kept


def training_sample(docs: DataFrame, labels: DataFrame, train: Column, sample: int) -> DataFrame:
    """Texts and labels of at most ``sample`` training rows per class, chosen by a hash of
    the id.  The broadcast side has 2 x sample rows at most."""
    rows = labels.where(train & F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("label"))
    order = F.xxhash64("doc_id", F.lit("toxicity"))
    chosen = rows.where("label = 1").orderBy(order, "doc_id").limit(sample).union(
        rows.where("label = 0").orderBy(order, "doc_id").limit(sample))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("text"))
    return texts.join(F.broadcast(chosen), "doc_id").select("label", "text")


def learn(spark: SparkSession, docs: DataFrame, labels: DataFrame, train: Column, sample: int = SAMPLE,
          exceptions: tuple[str, ...] = EXCEPTIONS) -> ToxicityModel:
    """Fit on at most ``sample`` training rows per class.  ``exceptions`` are given ones;
    learnt ones come beside them.  Without rows of both classes
    the model scores everything 0.  The logistic weights restore the class shares."""
    ship_package(spark)
    texts = stage(spark, training_sample(docs, labels, train, sample), "op10-sample")
    rows = {r.label: r["count"] for r in texts.groupBy("label").count().collect()}   # two rows
    if not rows.get(0) or not rows.get(1):
        return ToxicityModel(intercept=-30.0)
    support = max(3, math.ceil(SUPPORT * rows[1]))
    weight = (F.log((F.col("toxic") + 0.5) / (rows[1] - F.col("toxic") + 0.5))
              - F.log((F.col("clean") + 0.5) / (rows[0] - F.col("clean") + 0.5)))
    counted = (texts.select("text", "label").mapInArrow(tidied(_count_patterns), COUNTS)
               .groupBy("pattern").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
               .where(F.col("toxic") >= support)
               .where((F.col("toxic") + 0.5) / rows[1] > 4 * (F.col("clean") + 0.5) / rows[0])
               .orderBy(weight.desc(), F.col("toxic").desc(), "pattern").limit(MOST_PATTERNS))
    weights = lexicon([(r.pattern, r.toxic, r.clean) for r in counted.collect()], rows[1], rows[0])
    if not weights:
        return ToxicityModel(intercept=-30.0)
    learnt = learnt_exceptions(texts, ToxicityModel(weights, tuple(exceptions)).key(), rows[1], rows[0])
    model = ToxicityModel(weights, tuple(dict.fromkeys([*exceptions, *learnt])))
    points = texts.mapInArrow(_points(model.key()), "label int, x double").collect()   # 2 x sample rows at most
    x, y = np.array([r.x for r in points]), np.array([float(r.label) for r in points])
    share = labels.where(train).agg(F.avg(F.col("toxic").cast("double"))).first()[0]
    w = np.where(y > 0, share * len(y) / rows[1], (1 - share) * len(y) / rows[0])
    slope, intercept = _curve(x, y, w)
    return ToxicityModel(weights, model.exceptions, slope, intercept)


def _points(key: tuple):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = []
            for text in batch.column("text"):
                s = fold(text.as_py().decode("utf-8", "replace"))
                x.append(density(matches(s, key)[0], s.count(" ") - 1))
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(x, pa.float64())], names=["label", "x"])

    return tidied(run)


def _score(model: ToxicityModel):
    key = model.key()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = [chance(key, model.slope, model.intercept, t.as_py().decode("utf-8", "replace"))
                         for t in part.column("text")]
                score, hits, words = (list(x) for x in zip(*found))
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in part.schema.names if c != "text"]
                    + [pa.array(score, pa.float64()), pa.array(hits, pa.int64()), pa.array(words, pa.int64())],
                    names=[c for c in part.schema.names if c != "text"] + ["score", "n_matches", "n_words"])

    return tidied(run)


def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score, n_matches, n_words`` per row; NULL text counts as empty and scores
    as a text without matches does.  Ids may be NULL or repeat."""
    ship_package(docs.sparkSession)
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_bytes(text_col).alias("text"))
    return base.mapInArrow(_score(model), "doc_id long, score double, n_matches long, n_words long")


def keep_clean(docs: DataFrame, model: ToxicityModel, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` that score below ``least``, with all their columns."""
    ship_package(docs.sparkSession)
    key = model.key()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for batch in batches for p in slices(batch, text_col)):
            good = [chance(key, model.slope, model.intercept, t.as_py() or "")[0] < least for t in part.column(text_col)]
            yield part.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(tidied(run), docs.schema)
