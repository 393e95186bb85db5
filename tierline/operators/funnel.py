"""Gold operators: the impression -> click -> conversion funnel and its two business
tables (campaign performance ranked in channel, advertiser revenue with industry
share), plus the country x industry pivot.

The contract is that of a LEFT JOIN chain grouped per campaign: an impression with k
clicks counts k times and its cost k times, and a click once per conversion.
``campaign_rollup`` gets the same numbers leaf first.  A click row carries weight
max(1, conversions), an impression row max(1, sum of its click weights); counts and costs
are sums of weights and cost x weight.  Every join meets an already-aggregated side, so no
joined row set is ever materialised.  The oracle SQL states the joined form.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.operators.ranking import pivot_sum, rank_in_group, share_of_group
from tierline.rules import FkCheck

CAMPAIGN_KEYS = ["campaign_id", "campaign_name", "channel", "objective"]

#: How each level of the funnel refers to the next one.  Where ids restart, e.g. each day, a
#: caller gives links over several columns: ``FkCheck("impressions", ("id", "day"),
#: ("impression_id", "impression_day"))`` for clicks.
LINKS = {
    "conversions": FkCheck("clicks", "id", "click_id"),
    "clicks": FkCheck("impressions", "id", "impression_id"),
    "impressions": FkCheck("ads", "id", "ad_id"),
    "ads": FkCheck("campaigns", "id", "campaign_id"),
    "campaigns": FkCheck("advertisers", "id", "advertiser_id"),
}


def drop_orphans(silver: dict[str, DataFrame], links: dict[str, FkCheck] = LINKS) -> dict[str, DataFrame]:
    """Silver tables as the funnel uses them: orphan clicks and conversions removed."""
    out = dict(silver)
    for name in ("clicks", "conversions"):
        out[name] = silver[name].filter(~F.col(links[name].flag))
    return out


def _by_parent(child: DataFrame, link: FkCheck):
    """Child rows grouped by the parent they name, as ``_k0``, ``_k1``, ...; a key with a
    NULL in it names none."""
    named = child
    for c in link.child_columns:
        named = named.where(F.col(c).isNotNull())
    return named.groupBy(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(link.child_columns)])


def _of_parent(link: FkCheck):
    """Join condition of a parent's rows with what ``_by_parent`` made of its children."""
    cond = F.lit(True)
    for i, c in enumerate(link.parent_keys):
        cond = cond & (F.col(c) == F.col(f"_k{i}"))
    return cond


def _metrics(df: DataFrame) -> DataFrame:
    """ctr, cvr (0.0 when the denominator is 0) and cost per conversion (NULL when
    there is no conversion or either cost sum is NULL)."""
    return df.withColumns({
        "ctr": F.when(F.col("impressions_count") > 0,
                      F.col("clicks_count") / F.col("impressions_count")).otherwise(F.lit(0.0)),
        "cvr": F.when(F.col("clicks_count") > 0,
                      F.col("conversions_count") / F.col("clicks_count")).otherwise(F.lit(0.0)),
        "cost_per_conversion_usd": F.when(
            F.col("conversions_count") > 0,
            (F.col("total_impression_cost_usd") + F.col("total_click_cost_usd"))
            / F.col("conversions_count")),
    })


def _sum_type(like: DataFrame, name: str) -> str:
    """The decimal type a plain SUM of the column gives (precision + 10)."""
    dtype = like.schema[name].dataType
    return f"decimal({min(38, dtype.precision + 10)},{dtype.scale})"


def _sum_as(c, like: DataFrame, name: str):
    return F.sum(c).cast(_sum_type(like, name))


def _as_sum_type(c, like: DataFrame, name: str):
    return F.col(c).cast(_sum_type(like, name))


def campaign_rollup(silver: dict[str, DataFrame], links: dict[str, FkCheck] = LINKS) -> DataFrame:
    """Campaign aggregates with the fan-out described above, plus ``funnel_rows`` (rows the
    joined chain would have for the campaign).  Relies on the silver contract of one row
    per campaign key; ``links`` names the key columns of each level."""
    s, up = drop_orphans(silver, links), {n: link.child_columns for n, link in links.items()}
    imp, clk, conv = s["impressions"], s["clicks"], s["conversions"]
    one, zero = F.lit(1), F.lit(0)

    conv_by_click = (_by_parent(conv, links["conversions"])
                     .agg(F.count(one).alias("_rows"), F.count("id").alias("_conv"),
                          F.sum("value_usd").alias("_value")))
    clk_w = (clk.join(conv_by_click, _of_parent(links["conversions"]), "left")
                .select(*up["clicks"], "id", "cost_usd", "_conv", "_value",
                        F.greatest(one, F.coalesce("_rows", zero)).alias("_w")))
    click_by_imp = (_by_parent(clk_w, links["clicks"])
                    .agg(F.sum("_w").alias("_rows"),
                         F.sum(F.when(F.col("id").isNotNull(), F.col("_w")).otherwise(zero)).alias("_clicks"),
                         _sum_as(F.col("cost_usd") * F.col("_w"), clk, "cost_usd").alias("_ccost"),
                         F.sum("_conv").alias("_conv"), F.sum("_value").alias("_value")))
    imp_w = (imp.join(click_by_imp, _of_parent(links["clicks"]), "left")
                .select(*up["impressions"], "id", "cost_usd", "_clicks", "_ccost", "_conv", "_value",
                        F.greatest(one, F.coalesce("_rows", zero)).alias("_w")))
    imp_by_ad = (_by_parent(imp_w, links["impressions"])
                 .agg(F.sum("_w").alias("_rows"),
                      F.sum(F.when(F.col("id").isNotNull(), F.col("_w")).otherwise(zero)).alias("_imps"),
                      _sum_as(F.col("cost_usd") * F.col("_w"), imp, "cost_usd").alias("_icost"),
                      F.sum("_clicks").alias("_clicks"), F.sum("_ccost").alias("_ccost"),
                      F.sum("_conv").alias("_conv"), F.sum("_value").alias("_value")))
    return campaigns_from_ads(silver, imp_by_ad, links)


def campaigns_from_ads(silver: dict[str, DataFrame], imp_by_ad: DataFrame,
                       links: dict[str, FkCheck] = LINKS) -> DataFrame:
    """The dimension end of ``campaign_rollup``: what reaches each ad (one row per ad key
    ``_k0``, ...), summed per campaign.  Of the event tables only the types are used."""
    camp, ads, up = silver["campaigns"], silver["ads"], links["impressions"].child_columns
    imp, clk, conv = silver["impressions"], silver["clicks"], silver["conversions"]
    one, zero = F.lit(1), F.lit(0)
    ads_w = (ads.join(imp_by_ad, _of_parent(links["impressions"]), "left")
             .withColumn("_rows", F.greatest(one, F.coalesce("_rows", zero)))
             .drop(*[f"_k{i}" for i, _ in enumerate(up)]))
    ad_by_campaign = (_by_parent(ads_w, links["ads"])
                      .agg(*[F.sum(c).alias(c) for c in
                             ["_rows", "_imps", "_icost", "_clicks", "_ccost", "_conv", "_value"]]))
    # Silver holds one row per campaign id, so the join yields one row per campaign
    # and no regrouping (another shuffle) is needed.
    joined = camp.join(ad_by_campaign, _of_parent(links["ads"]), "left")
    agg = joined.select(
        F.col("id").alias("campaign_id"), "campaign_name", "channel", "objective",
        F.greatest(one, F.coalesce("_rows", zero)).cast("bigint").alias("funnel_rows"),
        F.coalesce("_imps", zero).cast("bigint").alias("impressions_count"),
        F.coalesce("_clicks", zero).cast("bigint").alias("clicks_count"),
        F.coalesce("_conv", zero).cast("bigint").alias("conversions_count"),
        _as_sum_type("_icost", imp, "cost_usd").alias("total_impression_cost_usd"),
        _as_sum_type("_ccost", clk, "cost_usd").alias("total_click_cost_usd"),
        _as_sum_type("_value", conv, "value_usd").alias("total_conversion_value_usd"),
    )
    return _metrics(agg)


def campaign_performance(silver: dict[str, DataFrame], stage=None) -> DataFrame:
    """Gold table campaign_performance_by_channel: funnel aggregates, ctr/cvr/cost per
    conversion, and ``rank_in_channel`` by conversion value, descending.

    The rank reads its input twice (value counts, then rows); ``stage`` (e.g.
    write-and-reread) materialises the per-campaign aggregate first so the funnel
    over the event tables runs once."""
    return campaign_performance_from(campaign_rollup(silver), stage)


def campaign_performance_from(rollup: DataFrame, stage=None) -> DataFrame:
    """Ranks added to a campaign rollup (``stage``: as in campaign_performance)."""
    agg = rollup.drop("funnel_rows")
    if stage is not None:
        agg = stage(agg, "campaign_agg")
    return rank_in_group(agg, "channel", "total_conversion_value_usd", "rank_in_channel")


def funnel_rows(silver: dict[str, DataFrame]) -> DataFrame:
    """Rows of the five-table joined funnel per campaign (the fan-out made visible),
    counted from the rollup weights without joining the rows out."""
    return campaign_rollup(silver).select("campaign_id", "funnel_rows")


def revenue_by_advertiser(silver: dict[str, DataFrame], links: dict[str, FkCheck] = LINKS) -> DataFrame:
    """Per advertiser: total conversion value (0.0 when none, a double) and the number
    of conversions that reach it through campaign, ad, impression and click.

    Conversions are the leaves, so no weights are needed: climb the chain with inner
    joins, aggregating on every level's key.  Each parent row a conversion reaches counts
    it once."""
    s = drop_orphans(silver, links)
    level = (_by_parent(s["conversions"], links["conversions"])
             .agg(F.sum("value_usd").alias("_value"), F.count("id").alias("_conv")))
    level = _climb(s, level, ["conversions", "clicks", "impressions"], links)
    return advertisers_from_ads(silver, level, links)


def _climb(s: dict[str, DataFrame], level: DataFrame, tables: list[str], links: dict[str, FkCheck]) -> DataFrame:
    """Carry sums keyed by what the first table names up to what the last one names."""
    below = links[tables[0]]
    for table in tables[1:]:
        columns = dict.fromkeys([*below.parent_keys, *links[table].child_columns])
        reached = s[table].select(*columns).join(level, _of_parent(below)).select(
            *links[table].child_columns, "_value", "_conv")
        level = _by_parent(reached, links[table]).agg(F.sum("_value").alias("_value"), F.sum("_conv").alias("_conv"))
        below = links[table]
    return level


def advertisers_from_ads(silver: dict[str, DataFrame], level: DataFrame,
                         links: dict[str, FkCheck] = LINKS) -> DataFrame:
    """The dimension end of ``revenue_by_advertiser``: value and conversions that reach each
    ad (one row per ad key ``_k0``, ...), summed per advertiser."""
    s, below = silver, links["campaigns"]
    level = _climb(s, level.select(*[f"_k{i}" for i, _ in enumerate(links["impressions"].child_columns)],
                                   "_value", "_conv"), ["impressions", "ads", "campaigns"], links)
    agg = (s["advertisers"].join(level, _of_parent(below), "left")
           .groupBy(F.col("id").alias("advertiser_id"), "advertiser_name", "industry", "country")
           .agg(_sum_as("_value", s["conversions"], "value_usd").alias("total_revenue_usd"),
                F.coalesce(F.sum("_conv"), F.lit(0)).cast("bigint").alias("conversions_count")))
    return agg.withColumn("total_revenue_usd", F.coalesce(F.col("total_revenue_usd"), F.lit(0.0)))


def advertiser_revenue_from(revenue: DataFrame) -> DataFrame:
    """Industry total and share added to a per-advertiser revenue table."""
    return share_of_group(revenue, "industry", "total_revenue_usd",
                          "industry_total_revenue_usd", "revenue_share_in_industry")


def advertiser_revenue(silver: dict[str, DataFrame], stage=None) -> DataFrame:
    """Gold table advertiser_revenue_by_industry (``stage``: as in campaign_performance)."""
    revenue = revenue_by_advertiser(silver)
    if stage is not None:
        revenue = stage(revenue, "advertiser_revenue")
    return advertiser_revenue_from(revenue)


def revenue_pivot(revenue: DataFrame, industries=None) -> DataFrame:
    """Gold table revenue_by_country_industry_pivot: country x industry revenue."""
    return pivot_sum(revenue, "country", "industry", "total_revenue_usd", industries)
