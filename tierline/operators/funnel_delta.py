"""The funnel's sums kept up to date row by row.

``funnel.campaign_rollup`` adds conversions to clicks, clicks to impressions and
impressions to ads.  Here each event row is kept with the sums of what hangs below it
(its *weighed* row).  When rows change, each gives its parent what it gives now minus
what it gave before; the parents so touched change in turn, one level up.  All sums are
whole numbers or decimals, so adding and taking away is exact and the result is that of a
rebuild.  A sum that SQL makes NULL (no value but NULLs below) is told by its count ``_n``.

A weighed row: ``id``, its own part (``_at`` event time, ``_up`` the parent it names,
``_live`` false for an orphan or an id known only by its children, ``_amount``) and ``SUMS``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.operators.funnel import LINKS

#: Event tables of the funnel, leaf first, and the amount that each adds up.
AMOUNTS = {"conversions": "value_usd", "clicks": "cost_usd", "impressions": "cost_usd"}
OWN = ["_at", "_up", "_live", "_amount"]
_COUNTS = ["_rows", "_imps", "_clicks", "_conv", "_icost_n", "_ccost_n", "_value_n"]
_MONEY = {"_icost": "impressions", "_ccost": "clicks", "_value": "conversions"}
SUMS = [*_COUNTS, *_MONEY]


def sum_types(silver: dict[str, DataFrame]) -> dict[str, str]:
    """The type of each of ``SUMS``, by the silver tables' own scales."""
    return {c: "bigint" for c in _COUNTS} | {
        c: f"decimal(38,{silver[e].schema[AMOUNTS[e]].dataType.scale})" for c, e in _MONEY.items()}


def own_part(silver: DataFrame, entity: str, event_time: str) -> DataFrame:
    """A silver event table (or some rows of it) as ``id`` and the own part of weighed rows."""
    link = LINKS[entity]
    live = F.coalesce(~F.col(link.flag), F.lit(False)) if link.flag in silver.columns else F.lit(True)
    return silver.select("id", F.col(event_time).alias("_at"), F.col(link.child_columns[0]).alias("_up"),
                         live.alias("_live"), F.col(AMOUNTS[entity]).alias("_amount"))


def no_sums(rows: DataFrame, types: dict[str, str]) -> DataFrame:
    return rows.withColumns({c: F.lit(0).cast(types[c]) for c in SUMS})


def gives(rows: DataFrame, entity: str, types: dict[str, str], sign: int = 1) -> DataFrame:
    """What weighed rows add to the sums of the parents they name (``id``), times ``sign``."""
    one, zero = F.lit(1), F.lit(0)
    weight = F.greatest(one, F.col("_rows"))
    named = F.when(F.col("id").isNotNull(), weight).otherwise(zero)
    amount, present = F.col("_amount"), F.col("_amount").isNotNull().cast("bigint")
    own: dict[str, Column] = {
        "conversions": {"_rows": one, "_conv": named, "_value": amount, "_value_n": present},
        "clicks": {"_rows": weight, "_clicks": named, "_ccost": amount * weight, "_ccost_n": present},
        "impressions": {"_rows": weight, "_imps": named, "_icost": amount * weight, "_icost_n": present},
    }[entity]
    given = {c: F.coalesce(own.get(c, F.col(c)), zero).cast(types[c]) for c in SUMS}
    return rows.where(F.col("_live") & F.col("_up").isNotNull()).select(
        F.col("_up").alias("id"), *[(v * F.lit(sign)).cast(types[c]).alias(c) for c, v in given.items()])


def added(parts: list[DataFrame], types: dict[str, str]) -> DataFrame:
    """The sums per id over all parts (one shuffle, added up before it)."""
    return reduce(DataFrame.unionByName, parts).groupBy("id").agg(*[F.sum(c).cast(types[c]).alias(c) for c in SUMS])


def weighed(own: DataFrame, below: DataFrame | None, types: dict[str, str]) -> DataFrame:
    """Weighed rows of a whole level: own parts of the rows with an id, sums from below."""
    own = own.where(F.col("id").isNotNull())
    if below is None:
        return no_sums(own, types)
    joined = own.join(below, "id", "left")
    return joined.select("id", *OWN, *[F.coalesce(c, F.lit(0)).cast(types[c]).alias(c) for c in SUMS])


def reweighed(old: DataFrame, changed: DataFrame, below: DataFrame | None, types: dict[str, str]) -> DataFrame:
    """The weighed rows of all ids in ``old`` (as they were), ``changed`` (own parts that came;
    one an id) or ``below`` (changes of their sums)."""
    kind = {c: changed.schema[c].dataType for c in OWN}

    def part(rows: DataFrame, tag: str | None) -> DataFrame:
        """The own parts as they were (``_was``) or are now (``_now``), field by field, so that
        the grouping below adds up by hash (the greatest of structs would sort)."""
        own = {f"{t}{c}": F.col(c).cast(k) if t == tag else F.lit(None).cast(k)
               for t in ("_was", "_now") for c, k in kind.items()}
        return rows.select("id", F.lit(tag == "_now").alias("_came"), *[v.alias(n) for n, v in own.items()], *SUMS)

    parts = [part(old, "_was"), part(no_sums(changed, types), "_now")]
    if below is not None:
        parts.append(part(below, None))
    rows = reduce(DataFrame.unionByName, parts).groupBy("id").agg(
        F.max("_came").alias("_came"), *[F.max(f"{t}{c}").alias(f"{t}{c}") for t in ("_was", "_now") for c in OWN],
        *[F.sum(c).cast(types[c]).alias(c) for c in SUMS])
    own = {c: F.when(F.col("_came"), F.col(f"_now{c}")).otherwise(F.col(f"_was{c}")) for c in OWN}
    own["_live"] = F.coalesce(own["_live"], F.lit(False))
    return rows.select("id", *[v.alias(c) for c, v in own.items()], *SUMS)


def as_ad_level(by_ad: DataFrame) -> DataFrame:
    """The sums per ad as ``funnel.campaigns_from_ads`` and ``advertisers_from_ads`` take them."""
    money = [F.when(F.col(f"{c}_n") > 0, F.col(c)).alias(c) for c in _MONEY]
    return by_ad.select(F.col("id").alias("_k0"), "_rows", "_imps", "_clicks", "_conv", *money)
