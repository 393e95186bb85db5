"""Six raw ad entities derived from the driver's TPC-H-like tables.

These play the part of the bronze layer in tests and registered queries: untyped
ids, padded names, and the defects the cleaning rules exist for (missing URL
protocol, zero budget, missing creative, zero cost, exact duplicate impressions,
orphan clicks and conversions, NULL foreign keys).  Every row of the source tables
is used, every event type included: views and errors are impressions, clicks are clicks,
purchases and signups are conversions.  The modulo tests only choose which rows carry a
defect; planted orphan keys are negative, so no event id ever equals them.

A click points at the same user's latest earlier impression, a conversion at the latest
earlier click (``running_max``, skew-safe per user).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.operators.asof import running_max

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

# The event types of each entity.
IMPRESSION_TYPES = ["view", "error"]
CLICK_TYPES = ["click"]
CONVERSION_TYPES = ["purchase", "signup"]

# The planted orphan keys.
ORPHAN_IMPRESSION_ID = -9999999
ORPHAN_CLICK_ID = -8888888


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _mod(c: str, n: int):
    return F.col(c) % F.lit(n)


def advertisers(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = read_table(spark, sf_dir, "customer")
    nation = read_table(spark, sf_dir, "nation")
    key = F.col("c_custkey").cast("string")
    return cust.join(nation, F.col("n_nationkey") == F.col("c_nationkey")).select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("advertiser_name"),
        F.col("c_mktsegment").alias("industry"),
        F.when(_mod("c_custkey", 50) == 0, F.concat(F.lit("site"), key, F.lit(".example.com")))
         .otherwise(F.concat(F.lit("https://site"), key, F.lit(".example.com"))).alias("website"),
        F.col("n_name").alias("country"),
    )


def campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("advertiser_id"),
        F.concat(F.lit("  campaign "), F.col("o_orderkey").cast("string"), F.lit(" ")).alias("campaign_name"),
        F.col("o_orderpriority").alias("channel"),
        F.col("o_orderstatus").alias("objective"),
        F.when(_mod("o_orderkey", 100) == 0, F.lit(0.0)).otherwise(F.col("o_totalprice"))
         .alias("daily_budget_usd"),
    )


def ads(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.col("l_orderkey").alias("campaign_id"),
        F.col("l_returnflag").alias("format"),
        F.when((F.col("l_orderkey") + F.col("l_linenumber")) % 100 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("https://cdn.example.com/"), F.col("l_partkey").cast("string"),
                             F.lit(".png"))).alias("creative_url"),
    )


def events_with_links(spark: SparkSession, sf_dir: str, block: int = 1 << 16) -> DataFrame:
    """events + last_view / last_click: the user's latest impression / click id so far."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return running_max(ev, "user_id", "event_id", {
        "last_view": F.when(F.col("event_type").isin(IMPRESSION_TYPES), F.col("event_id")),
        "last_click": F.when(F.col("event_type").isin(CLICK_TYPES), F.col("event_id")),
    }, block=block)


def _impressions_from(ev: DataFrame) -> DataFrame:
    views = ev.where(F.col("event_type").isin(IMPRESSION_TYPES)).select(
        F.col("event_id").alias("id"),
        ((F.col("user_id") * 100 + _mod("event_id", 100)) * 10 + 1 + _mod("event_id", 7)).alias("ad_id"),
        F.col("ts").alias("timestamp"),
        F.lit("US").alias("country"),
        F.when(_mod("event_id", 100) == 0, F.lit(0.0)).otherwise(F.col("value") / 1000).alias("cost_usd"),
    )
    return views.unionByName(views.where(_mod("id", 200) < 10))


def _clicks_from(ev: DataFrame) -> DataFrame:
    return ev.where(F.col("event_type").isin(CLICK_TYPES)).select(
        F.col("event_id").alias("id"),
        F.when(_mod("event_id", 200) == 1, F.lit(ORPHAN_IMPRESSION_ID).cast("bigint"))
         .otherwise(F.col("last_view")).alias("impression_id"),
        F.col("ts").alias("timestamp"),
        F.col("value").alias("cost_usd"),
    )


def _conversions_from(ev: DataFrame) -> DataFrame:
    return ev.where(F.col("event_type").isin(CONVERSION_TYPES)).select(
        F.col("event_id").alias("id"),
        F.when(_mod("event_id", 100) == 1, F.lit(ORPHAN_CLICK_ID).cast("bigint"))
         .otherwise(F.col("last_click")).alias("click_id"),
        F.col("ts").alias("timestamp"),
        F.col("value").alias("value_usd"),
    )


class RawEntities(Mapping):
    """The six raw entities by name, each built when it is first asked for.  The linked
    events feed three of them; ``stage`` (e.g. write-and-reread) computes that step once,
    and only if one of the three is used."""

    def __init__(self, spark: SparkSession, sf_dir: str, block: int, stage) -> None:
        self._built: dict[str, DataFrame] = {}

        def events() -> DataFrame:
            ev = events_with_links(spark, sf_dir, block)
            return stage(ev, "events_linked") if stage else ev

        self._makers = {
            "events": events,
            "advertisers": lambda: advertisers(spark, sf_dir),
            "campaigns": lambda: campaigns(spark, sf_dir),
            "ads": lambda: ads(spark, sf_dir),
            "impressions": lambda: _impressions_from(self._get("events")),
            "clicks": lambda: _clicks_from(self._get("events")),
            "conversions": lambda: _conversions_from(self._get("events")),
        }

    def _get(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._makers[name]()
        return self._built[name]

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self:
            raise KeyError(name)
        return self._get(name)

    def __iter__(self):
        return (n for n in self._makers if n != "events")

    def __contains__(self, name) -> bool:   # without building it
        return name in self._makers and name != "events"

    def __len__(self) -> int:
        return len(self._makers) - 1


def raw_entities(spark: SparkSession, sf_dir: str, block: int = 1 << 16,
                 stage: Callable[[DataFrame, str], DataFrame] | None = None) -> Mapping[str, DataFrame]:
    """The six raw entities, built on first use."""
    return RawEntities(spark, sf_dir, block, stage)
