"""URL filters by association rules.

A URL becomes a set of tokens, at most one of each kind (``KINDS``): scheme, parts of the
host, first path segments, extension, query names, fragment.  FP-growth mines which token
combinations go with which label among labelled URLs; combinations that reach the support
and the confidence become rules, and a rule goes when a shorter one says the same at least
as surely.  A URL is matched through an inverted index from token to rules: a rule fits
when as many of its tokens were met as it has.

One token of a kind bounds everything mined: a URL supports fewer than 2^11 combinations,
so at most 2^11 / support of them are frequent however many URLs there are.  That bounds
the rules that reach the driver and the tasks.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import combinations
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.llm.common import ship_package, stage, tidied

SUPPORT = 0.01
CONFIDENCE = 0.9
KINDS = ("scheme", "tld", "site", "name", "sub", "hyphen", "dir", "page", "ext", "keys", "frag")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LABEL = "label:"


class ListedRule(NamedTuple):
    """An entry of a block or allow list, ``host/path``: for that host and its subdomains,
    where the path begins so."""
    verdict: str
    text: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return self.text[len(self.host):]


class Rule(NamedTuple):
    tokens: tuple[str, ...]
    label: str
    confidence: float
    support: float

    def rank(self) -> tuple:
        """Order in which rules win: surest, best supported, shortest, then by text."""
        return -self.confidence, -self.support, len(self.tokens), self.tokens, self.label


def _lowered(c: Column) -> Column:
    return F.translate(c, _UPPER, _LOWER)


def _part(url: Column, pattern: str, group: int = 1) -> Column:
    return F.coalesce(F.regexp_extract(url, pattern, group), F.lit(""))


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return _lowered(_part(url, r"(?s)^.*?://([^/?#]*)"))


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return _part(url, r"(?s)^.*?://[^/?#]*([^?#]*)")


def url_tokens(url: Column) -> Column:
    """The URL's tokens, ``kind:value``, in the order of ``KINDS``; no ``://``: none."""
    host, path = url_host(url), url_path(url)
    labels = F.split(host, r"\.", -1)
    n = F.size(labels)
    pieces = F.split(path, "/", -1)
    query = _part(url, r"(?s)^.*?://[^?#]*\?([^#]*)")
    names = F.array_sort(F.array_distinct(F.transform(F.split(query, "&", -1), lambda p: F.split_part(p, F.lit("="), F.lit(1)))))

    def label(from_right: int) -> Column:
        return F.when(n >= from_right, F.try_element_at(labels, F.lit(-from_right)))

    def segment(i: int) -> Column:
        return F.when(F.size(pieces) > i, F.try_element_at(pieces, F.lit(i + 1)))

    values = {
        "scheme": _lowered(_part(url, r"(?s)^(.*?)://")),
        "tld": label(1),
        "site": F.when(n >= 2, F.concat(label(2), F.lit("."), label(1))),
        "name": label(3),
        "sub": F.when(n >= 4, F.array_join(F.slice(labels, F.lit(1), F.greatest(n - 3, F.lit(0))), ".")),
        "hyphen": F.when(F.contains(host, F.lit("-")), F.lit("yes")),
        "dir": segment(1),
        "page": F.regexp_replace(segment(2), "[0-9]+", "#"),
        "ext": _part(path, r"\.([A-Za-z0-9]{1,5})\z"),
        "keys": F.array_join(names, ","),
        "frag": F.when(F.contains(_part(url, r"(?s)^.*?://(.*)\z"), F.lit("#")), F.lit("yes")),
    }
    made = F.array(*[F.when(v != "", F.concat(F.lit(f"{k}:"), v)) for k, v in values.items()])
    return F.when(F.contains(url, F.lit("://")), F.array_compact(made)).otherwise(F.array().cast("array<string>"))


def listed(host: Column, path: Column, rules: Sequence[ListedRule]) -> tuple[Column, Column]:
    """(text, verdict) of the longest listed rule that fits, else NULL.  The list is part of
    the plan, so it is meant for a list kept by hand."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == r.host) | F.endswith(host, F.lit(f".{r.host}"))) & F.startswith(path, F.lit(r.path))
        text, verdict = F.when(fits, F.lit(r.text)).otherwise(text), F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return text, verdict


def prune(rules: list[Rule]) -> list[Rule]:
    """Without rules of which a shorter one has the label and at least the confidence."""
    best = {(r.tokens, r.label): r.confidence for r in rules}
    return [r for r in rules if not any(
        best.get((part, r.label), -1.0) >= r.confidence
        for size in range(len(r.tokens)) for part in combinations(r.tokens, size))]


def mine_rules(spark: SparkSession, urls: DataFrame, url_col: str = "url", label_col: str = "label",
               support: float = SUPPORT, confidence: float = CONFIDENCE) -> list[Rule]:
    """Rules from labelled URLs, in the order in which they win.  ``support`` is the least
    share of the labelled URLs with the tokens and the label, ``confidence`` the least
    share of the URLs with the tokens that have the label.  Rows with a NULL label or URL
    take no part; without any there are no rules."""
    from pyspark.ml.fpm import FPGrowth

    if not 0 < support <= 1:
        raise ValueError("support must be above 0 and at most 1")
    marked = urls.where(F.col(label_col).isNotNull() & F.col(url_col).isNotNull()).select(
        F.array_append(url_tokens(F.col(url_col)), F.concat(F.lit(_LABEL), F.col(label_col).cast("string"))).alias("items"))
    marked = stage(spark, marked, "op12-labelled")
    if marked.isEmpty():
        return []
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence).fit(marked)
    found = model.associationRules.where(F.startswith(F.col("consequent")[0], F.lit(_LABEL))).where(
        ~F.exists("antecedent", lambda t: F.startswith(t, F.lit(_LABEL))))
    found = stage(spark, found.select("antecedent", "consequent", "confidence", "support"), "op12-rules")
    rules = [Rule(tuple(sorted(r.antecedent)), r.consequent[0][len(_LABEL):], r.confidence, r.support)
             for r in found.collect()]       # at most 2^11 / support rows, see above
    return sorted(prune(rules), key=Rule.rank)


class RuleIndex:
    """Inverted index: token -> the rules that have it, by their place in the order."""

    def __init__(self, rules: Sequence[Rule]) -> None:
        self.rules, self._with = list(rules), defaultdict(list)
        for at, r in enumerate(self.rules):
            for t in r.tokens:
                self._with[t].append(at)

    def first_match(self, tokens: Sequence[str]) -> Rule | None:
        """The first rule all of whose tokens are there."""
        met: dict[int, int] = defaultdict(int)
        for t in set(tokens):
            for at in self._with.get(t, ()):
                met[at] += 1
        fits = [at for at, n in met.items() if n == len(self.rules[at].tokens)]
        return self.rules[min(fits)] if fits else None


@lru_cache(maxsize=2)
def _index(rules: tuple[Rule, ...]) -> RuleIndex:
    return RuleIndex(rules)


def _judge(rules: tuple[Rule, ...], default: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = lru_cache(maxsize=10_000)(_index(rules).first_match)
        for batch in batches:
            verdict, evidence, sure = [], [], []
            for listed_, tokens in zip(batch.column("verdict").to_pylist(), batch.column("tokens").to_pylist()):
                hit = None if listed_ is not None else first(tuple(tokens))
                verdict.append(listed_ if listed_ is not None else hit.label if hit else default)
                evidence.append(" ".join(hit.tokens) if hit else None)
                sure.append(hit.confidence if hit else None)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("page_id", "host", "path", "rule")), pa.array(verdict, pa.string()),
                 pa.array(evidence, pa.string()), pa.array(sure, pa.float64())],
                names=["page_id", "host", "path", "rule", "verdict", "evidence", "confidence"])

    return tidied(run)


def judge_urls(spark: SparkSession, pages: DataFrame, rules: Sequence[ListedRule], labelled: DataFrame | None = None,
               default: str = "allow", id_col: str = "page_id", url_col: str = "url", support: float = SUPPORT,
               confidence: float = CONFIDENCE) -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict, evidence, confidence``.

    The longest listed rule that fits decides; elsewhere the first association rule that
    fits does (its tokens are the ``evidence``), and where none fits, ``default``.  The
    association rules are mined from ``labelled`` (url, label), or, where none is given,
    from the pages that a listed rule decides, labelled by it.  A NULL URL or one without
    ``://`` has an empty host and path and no tokens.  Ids may be NULL or repeat; other
    columns are ignored.
    """
    ship_package(spark)
    url = F.col(url_col).cast("string")
    host, path = url_host(url), url_path(url)
    text, verdict = listed(host, path, rules)
    if labelled is None:
        labelled = pages.select(url.alias("url"), verdict.alias("label"))
    found = tuple(mine_rules(spark, labelled, support=support, confidence=confidence))
    base = pages.select(F.col(id_col).cast("long").alias("page_id"), host.alias("host"), path.alias("path"),
                        text.alias("rule"), verdict.alias("verdict"),
                        F.when(verdict.isNull() & url.isNotNull(), url_tokens(url)).otherwise(
                            F.array().cast("array<string>")).alias("tokens"))
    return base.mapInArrow(_judge(found, default), "page_id long, host string, path string, rule string, "
                           "verdict string, evidence string, confidence double")


def most_combinations(support: float = SUPPORT) -> int:
    """Upper bound of the frequent token combinations, whatever the data's size."""
    return math.floor((2 ** len(KINDS) - 1) / support)
