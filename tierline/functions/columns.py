"""Column-level cleaning helpers.  Each returns a new DataFrame built from one
projection of built-in expressions, so it stays inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# The protocol test and the prefix added when it fails.
PROTOCOL_PATTERN = "^https?://"
PROTOCOL_PREFIX = "https://"


def apply_casts(df: DataFrame, casts: dict[str, str], try_cast: bool = False) -> DataFrame:
    """Cast every ``{column: type}`` in one projection.  Under ANSI mode a bad value
    raises; ``try_cast=True`` turns it into NULL instead."""
    if not casts:
        return df
    missing = [c for c in casts if c not in df.columns]
    if missing:
        raise ValueError(f"cast rule names missing columns {missing}; have {df.columns}")
    return df.withColumns({
        c: (F.col(c).try_cast(t) if try_cast else F.col(c).cast(t)) for c, t in casts.items()
    })


def string_columns(df: DataFrame) -> list[str]:
    """Top-level columns of plain string type (nested strings are left alone)."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def trim_strings(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Strip leading and trailing spaces from every top-level string column."""
    cols = string_columns(df) if columns is None else list(columns)
    if not cols:
        return df
    return df.withColumns({c: F.trim(F.col(c)) for c in cols})


def with_protocol(c: Column) -> Column:
    """Prefix ``https://`` unless the value already starts with http:// or https://
    (case-sensitive).  NULL stays NULL."""
    return F.when(~c.rlike(PROTOCOL_PATTERN), F.concat(F.lit(PROTOCOL_PREFIX), c)).otherwise(c)


def fix_protocol(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, with_protocol(F.col(column)))


def flag_zero(df: DataFrame, column: str, flag: str) -> DataFrame:
    """``flag`` = (column == 0); NULL input gives a NULL flag."""
    return df.withColumn(flag, F.col(column) == 0)


def flag_present(df: DataFrame, column: str, flag: str) -> DataFrame:
    """``flag`` = column is not NULL (true means present)."""
    return df.withColumn(flag, F.col(column).isNotNull())


# Named transforms, selected by the registry.  Users may register more.
TRANSFORMS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "fix_website_protocol": lambda df: fix_protocol(df, "website"),
    "flag_zero_budget": lambda df: flag_zero(df, "daily_budget_usd", "has_zero_budget"),
    "flag_missing_creative": lambda df: flag_present(df, "creative_url", "has_creative_url"),
    "flag_zero_cost": lambda df: flag_zero(df, "cost_usd", "is_zero_cost_impression"),
}


def register_transform(name: str, fn: Callable[[DataFrame], DataFrame]) -> None:
    TRANSFORMS[name] = fn


def apply_named(df: DataFrame, names: Iterable[str],
                transforms: dict[str, Callable[[DataFrame], DataFrame]] | None = None) -> DataFrame:
    """Apply transforms by name, in order; an unknown name raises ``ValueError``."""
    table = TRANSFORMS if transforms is None else transforms
    for name in names:
        if name not in table:
            raise ValueError(f"unknown transform {name!r}; known: {sorted(table)}")
        df = df.transform(table[name])
    return df
