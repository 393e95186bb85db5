"""Silver build of one entity: dedup -> FK flags -> casts -> named transforms -> trim.

The order is part of the contract: dedup and FK checks see raw values (so ``" a"``
and ``"a"`` are different keys, and a bigint FK is compared with the parent's int
key), the URL fix sees untrimmed text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from tierline.functions.columns import apply_casts, apply_named, trim_strings
from tierline.operators.quality import dedup, flag_orphans
from tierline.rules import REGISTRY, EntityRule, build_order, get_rule


def build_silver(raw: DataFrame, rule: EntityRule, parents: dict[str, DataFrame] | None = None,
                 try_cast: bool = False, fk_options: dict | None = None) -> DataFrame:
    """``fk_options`` go to every ``flag_orphans`` call (explicit hot-key splitting:
    ``{"split_hot_keys": True}``)."""
    parents = parents or {}
    df = dedup(raw, rule.dedup_keys, rule.tiebreaker)
    for fk in rule.fk_checks:
        if fk.parent not in parents:
            raise ValueError(f"{rule.name}: parent {fk.parent!r} must be built first")
        df = flag_orphans(df, parents[fk.parent], fk.parent_keys, fk.child_columns, fk.flag,
                          **(fk_options or {}))
    return clean_columns(df, rule, try_cast)


def clean_columns(df: DataFrame, rule: EntityRule, try_cast: bool = False) -> DataFrame:
    """The steps that go by row: casts, named transforms, trim."""
    return trim_strings(apply_named(apply_casts(df, rule.casts, try_cast), rule.transforms))


def ancestors(names, registry: dict[str, EntityRule] | None = None) -> set[str]:
    """``names`` plus every entity they check foreign keys against, transitively."""
    registry = REGISTRY if registry is None else registry
    todo, seen = list(names), set()
    while todo:
        n = todo.pop()
        if n not in seen:
            seen.add(n)
            todo.extend(fk.parent for fk in get_rule(n, registry).fk_checks)
    return seen


def build_silver_all(raw: dict[str, DataFrame], registry: dict[str, EntityRule] | None = None,
                     try_cast: bool = False,
                     stage: Callable[[DataFrame, str], DataFrame] | None = None,
                     only=None) -> dict[str, DataFrame]:
    """Silver for every entity of ``raw`` (or just ``only`` and their FK ancestors),
    parents first.  With ``stage``, every entity another one checks its keys against
    is materialised (e.g. written and re-read) before its children use it, so the
    children and later gold plans read it instead of recomputing it; entities read
    once stay inline.  Without ``stage``: one lazy plan per entity."""
    registry = REGISTRY if registry is None else registry
    wanted = ancestors(only, registry) if only is not None else set(raw)
    parents = {fk.parent for n in wanted for fk in get_rule(n, registry).fk_checks}
    out: dict[str, DataFrame] = {}
    for name in build_order(registry):
        if name in raw and name in wanted:
            df = build_silver(raw[name], get_rule(name, registry), out, try_cast)
            out[name] = stage(df, name) if stage and name in parents else df
    return out
