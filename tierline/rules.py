"""Entity registry: the cleaning rules of each entity and the order to build them in."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class FkCheck:
    """``child_column`` must name an existing ``parent_key`` of ``parent`` (silver).  A key
    of several columns, e.g. an id that restarts each day and the day, is a tuple."""

    parent: str
    parent_key: str | tuple[str, ...]
    child_column: str | tuple[str, ...]

    @property
    def parent_keys(self) -> tuple[str, ...]:
        return (self.parent_key,) if isinstance(self.parent_key, str) else tuple(self.parent_key)

    @property
    def child_columns(self) -> tuple[str, ...]:
        return (self.child_column,) if isinstance(self.child_column, str) else tuple(self.child_column)

    @property
    def flag(self) -> str:
        return f"is_orphan_{'_'.join(self.child_columns)}"


@dataclass(frozen=True)
class EntityRule:
    name: str
    is_event: bool
    primary_key: tuple[str, ...] = ("id",)
    dedup_keys: tuple[str, ...] = ("id",)
    tiebreaker: tuple[str, ...] = ("id",)
    casts: dict[str, str] = field(default_factory=dict)
    transforms: tuple[str, ...] = ()
    fk_checks: tuple[FkCheck, ...] = ()
    event_time: str | None = None


# The six entities, in registry order, with the rules the pipeline
# must apply (keys, casts, named transforms, foreign-key checks).
REGISTRY: dict[str, EntityRule] = {
    "advertisers": EntityRule(
        name="advertisers", is_event=False,
        casts={"id": "int"},
        transforms=("fix_website_protocol",),
    ),
    "campaigns": EntityRule(
        name="campaigns", is_event=False,
        casts={"id": "int", "advertiser_id": "int", "daily_budget_usd": "decimal(10,2)"},
        transforms=("flag_zero_budget",),
    ),
    "ads": EntityRule(
        name="ads", is_event=False,
        casts={"id": "int", "campaign_id": "int"},
        transforms=("flag_missing_creative",),
    ),
    "impressions": EntityRule(
        name="impressions", is_event=True,
        casts={"id": "int", "ad_id": "int", "cost_usd": "decimal(10,6)", "timestamp": "timestamp"},
        transforms=("flag_zero_cost",),
        event_time="timestamp",
    ),
    "clicks": EntityRule(
        name="clicks", is_event=True,
        casts={"id": "int", "impression_id": "int", "cost_usd": "decimal(10,4)", "timestamp": "timestamp"},
        fk_checks=(FkCheck("impressions", "id", "impression_id"),),
        event_time="timestamp",
    ),
    "conversions": EntityRule(
        name="conversions", is_event=True,
        casts={"id": "int", "click_id": "int", "value_usd": "decimal(10,2)", "timestamp": "timestamp"},
        fk_checks=(FkCheck("clicks", "id", "click_id"),),
        event_time="timestamp",
    ),
}


def get_rule(name: str, registry: dict[str, EntityRule] | None = None) -> EntityRule:
    """Look an entity up; an unknown name fails before any Spark job starts."""
    registry = REGISTRY if registry is None else registry
    if name not in registry:
        raise ValueError(f"unknown entity {name!r}; valid entities: {list(registry)}")
    return registry[name]


def build_order(registry: dict[str, EntityRule] | None = None) -> list[str]:
    """Entities ordered so every FK parent comes before its children; ties keep
    registry order.  Raises on a cycle or on a parent missing from the registry."""
    registry = REGISTRY if registry is None else registry
    names = list(registry)
    done: list[str] = []
    pending = list(names)
    while pending:
        for name in pending:
            parents = [fk.parent for fk in registry[name].fk_checks]
            for p in parents:
                if p not in registry:
                    raise ValueError(f"{name}: FK parent {p!r} is not a registered entity")
            if all(p in done for p in parents if p != name):
                done.append(name)
                pending.remove(name)
                break
        else:
            raise ValueError(f"FK checks form a cycle among {pending}")
    return done
