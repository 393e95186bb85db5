"""Independent SQL (DuckDB dialect) for every registered query.

The SQL restates each operator's contract directly -- the testbed entities, the
silver rules, the joined funnel -- so it checks the Spark plans (which use other
forms, e.g. the leaf-first rollup) rather than mirroring them.
"""

from __future__ import annotations

# Raw six-entity testbed over the driver's tables (same rows as tierline.testbed).
TESTBED = """
t_advertisers AS (
  SELECT c_custkey AS id, c_name AS advertiser_name, c_mktsegment AS industry,
         CASE WHEN c_custkey % 50 = 0 THEN concat('site', CAST(c_custkey AS VARCHAR), '.example.com')
              ELSE concat('https://site', CAST(c_custkey AS VARCHAR), '.example.com') END AS website,
         n_name AS country
  FROM customer JOIN nation ON n_nationkey = c_nationkey),
t_campaigns AS (
  SELECT o_orderkey AS id, o_custkey AS advertiser_id,
         concat('  campaign ', CAST(o_orderkey AS VARCHAR), ' ') AS campaign_name,
         o_orderpriority AS channel, o_orderstatus AS objective,
         CASE WHEN o_orderkey % 100 = 0 THEN 0.0E0 ELSE o_totalprice END AS daily_budget_usd
  FROM orders),
t_ads AS (
  SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS campaign_id, l_returnflag AS format,
         CASE WHEN (l_orderkey + l_linenumber) % 100 = 0 THEN NULL
              ELSE concat('https://cdn.example.com/', CAST(l_partkey AS VARCHAR), '.png') END AS creative_url
  FROM lineitem),
t_events AS (
  SELECT event_id, ts, user_id, event_type, value,
         max(CASE WHEN event_type IN ('view', 'error') THEN event_id END) OVER w AS last_view,
         max(CASE WHEN event_type = 'click' THEN event_id END) OVER w AS last_click
  FROM events
  WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
t_views AS (
  SELECT event_id AS id, (user_id * 100 + event_id % 100) * 10 + 1 + event_id % 7 AS ad_id,
         ts AS "timestamp", 'US' AS country,
         CASE WHEN event_id % 100 = 0 THEN 0.0E0 ELSE value / 1000 END AS cost_usd
  FROM t_events WHERE event_type IN ('view', 'error')),
t_impressions AS (
  SELECT * FROM t_views UNION ALL SELECT * FROM t_views WHERE id % 200 < 10),
t_clicks AS (
  SELECT event_id AS id, CASE WHEN event_id % 200 = 1 THEN -9999999 ELSE last_view END AS impression_id,
         ts AS "timestamp", value AS cost_usd
  FROM t_events WHERE event_type = 'click'),
t_conversions AS (
  SELECT event_id AS id, CASE WHEN event_id % 100 = 1 THEN -8888888 ELSE last_click END AS click_id,
         ts AS "timestamp", value AS value_usd
  FROM t_events WHERE event_type IN ('purchase', 'signup'))
"""

# Silver rules restated: keep-first by the full row order, FK flags by NOT EXISTS,
# then casts, transforms and trim.
SILVER = """
d_advertisers AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY id NULLS FIRST,
      advertiser_name NULLS FIRST, industry NULLS FIRST, website NULLS FIRST, country NULLS FIRST) AS rn
    FROM t_advertisers) WHERE rn = 1),
s_advertisers AS (
  SELECT CAST(id AS INTEGER) AS id, trim(advertiser_name) AS advertiser_name, trim(industry) AS industry,
         trim(CASE WHEN NOT regexp_matches(website, '^https?://') THEN concat('https://', website)
                   ELSE website END) AS website,
         trim(country) AS country
  FROM d_advertisers),
d_campaigns AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY id NULLS FIRST,
      advertiser_id NULLS FIRST, campaign_name NULLS FIRST, channel NULLS FIRST, objective NULLS FIRST,
      daily_budget_usd NULLS FIRST) AS rn
    FROM t_campaigns) WHERE rn = 1),
s_campaigns AS (
  SELECT CAST(id AS INTEGER) AS id, CAST(advertiser_id AS INTEGER) AS advertiser_id,
         trim(campaign_name) AS campaign_name, trim(channel) AS channel, trim(objective) AS objective,
         CAST(daily_budget_usd AS DECIMAL(10,2)) AS daily_budget_usd,
         CAST(daily_budget_usd AS DECIMAL(10,2)) = 0 AS has_zero_budget
  FROM d_campaigns),
d_ads AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY id NULLS FIRST,
      campaign_id NULLS FIRST, format NULLS FIRST, creative_url NULLS FIRST) AS rn
    FROM t_ads) WHERE rn = 1),
s_ads AS (
  SELECT CAST(id AS INTEGER) AS id, CAST(campaign_id AS INTEGER) AS campaign_id, trim(format) AS format,
         trim(creative_url) AS creative_url, creative_url IS NOT NULL AS has_creative_url
  FROM d_ads),
d_impressions AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY id NULLS FIRST,
      ad_id NULLS FIRST, "timestamp" NULLS FIRST, country NULLS FIRST, cost_usd NULLS FIRST) AS rn
    FROM t_impressions) WHERE rn = 1),
s_impressions AS (
  SELECT CAST(id AS INTEGER) AS id, CAST(ad_id AS INTEGER) AS ad_id, CAST("timestamp" AS TIMESTAMP) AS "timestamp",
         trim(country) AS country, CAST(cost_usd AS DECIMAL(10,6)) AS cost_usd,
         CAST(cost_usd AS DECIMAL(10,6)) = 0 AS is_zero_cost_impression
  FROM d_impressions),
d_clicks AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY id NULLS FIRST,
      impression_id NULLS FIRST, "timestamp" NULLS FIRST, cost_usd NULLS FIRST) AS rn
    FROM t_clicks) WHERE rn = 1),
s_clicks AS (
  SELECT CAST(id AS INTEGER) AS id, CAST(impression_id AS INTEGER) AS impression_id,
         CAST("timestamp" AS TIMESTAMP) AS "timestamp", CAST(cost_usd AS DECIMAL(10,4)) AS cost_usd,
         NOT EXISTS (SELECT 1 FROM s_impressions p WHERE p.id = d.impression_id) AS is_orphan_impression_id
  FROM d_clicks d),
d_conversions AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY id NULLS FIRST,
      click_id NULLS FIRST, "timestamp" NULLS FIRST, value_usd NULLS FIRST) AS rn
    FROM t_conversions) WHERE rn = 1),
s_conversions AS (
  SELECT CAST(id AS INTEGER) AS id, CAST(click_id AS INTEGER) AS click_id,
         CAST("timestamp" AS TIMESTAMP) AS "timestamp", CAST(value_usd AS DECIMAL(10,2)) AS value_usd,
         NOT EXISTS (SELECT 1 FROM s_clicks p WHERE p.id = d.click_id) AS is_orphan_click_id
  FROM d_conversions d)
"""

FUNNEL_FROM = """
FROM s_campaigns c
LEFT JOIN s_ads a ON a.campaign_id = c.id
LEFT JOIN s_impressions i ON i.ad_id = a.id
LEFT JOIN (SELECT * FROM s_clicks WHERE NOT is_orphan_impression_id) cl ON cl.impression_id = i.id
LEFT JOIN (SELECT * FROM s_conversions WHERE NOT is_orphan_click_id) co ON co.click_id = cl.id
"""

CAMPAIGN_AGG = f"""
camp_agg AS (
  SELECT c.id AS campaign_id, c.campaign_name, c.channel, c.objective,
         count(i.id) AS impressions_count, count(cl.id) AS clicks_count, count(co.id) AS conversions_count,
         sum(i.cost_usd) AS total_impression_cost_usd, sum(cl.cost_usd) AS total_click_cost_usd,
         sum(co.value_usd) AS total_conversion_value_usd
  {FUNNEL_FROM}
  GROUP BY c.id, c.campaign_name, c.channel, c.objective)
"""

ADVERTISER_AGG = """
adv_agg AS (
  SELECT adv.id AS advertiser_id, adv.advertiser_name, adv.industry, adv.country,
         coalesce(CAST(sum(co.value_usd) AS DOUBLE), 0.0) AS total_revenue_usd,
         count(co.id) AS conversions_count
  FROM s_advertisers adv
  LEFT JOIN s_campaigns c ON c.advertiser_id = adv.id
  LEFT JOIN s_ads a ON a.campaign_id = c.id
  LEFT JOIN s_impressions i ON i.ad_id = a.id
  LEFT JOIN (SELECT * FROM s_clicks WHERE NOT is_orphan_impression_id) cl ON cl.impression_id = i.id
  LEFT JOIN (SELECT * FROM s_conversions WHERE NOT is_orphan_click_id) co ON co.click_id = cl.id
  GROUP BY adv.id, adv.advertiser_name, adv.industry, adv.country)
"""


def with_ctes(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n" + body


def exact_quotient(num: str, den: str, num_scale: int = 6, scale: int = 21) -> str:
    """Spark's decimal division rendered as a double: the quotient of a non-negative
    decimal (``num_scale`` places) by a positive integer, rounded half-up to ``scale``
    places, then parsed as the nearest double."""
    shift = 10 ** (scale - num_scale)
    n = f"CAST(({num}) * {10 ** num_scale} AS HUGEINT) * CAST({shift} AS HUGEINT)"
    return (f"CAST(CAST(({n} * 2 + ({den})) // (2 * ({den})) AS VARCHAR) || 'e-{scale}' AS DOUBLE)")


GOLD_CAMPAIGN_PERFORMANCE = with_ctes(TESTBED, SILVER, CAMPAIGN_AGG, body=f"""
SELECT campaign_id, campaign_name, channel, objective,
       impressions_count, clicks_count, conversions_count,
       CAST(total_impression_cost_usd AS DOUBLE) AS total_impression_cost_usd,
       CAST(total_click_cost_usd AS DOUBLE) AS total_click_cost_usd,
       CAST(total_conversion_value_usd AS DOUBLE) AS total_conversion_value_usd,
       CASE WHEN impressions_count > 0 THEN clicks_count / impressions_count ELSE 0.0 END AS ctr,
       CASE WHEN clicks_count > 0 THEN conversions_count / clicks_count ELSE 0.0 END AS cvr,
       CASE WHEN conversions_count > 0
            THEN {exact_quotient("total_impression_cost_usd + total_click_cost_usd", "conversions_count")}
       END AS cost_per_conversion_usd,
       CAST(rank() OVER (PARTITION BY channel ORDER BY total_conversion_value_usd DESC NULLS LAST) AS INTEGER)
         AS rank_in_channel
FROM camp_agg
""")


def _silver_select(entity: str, cols: str) -> str:
    return with_ctes(TESTBED, SILVER, body=f"SELECT {cols} FROM s_{entity}")


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def _pivot_cells(column: str, value: str) -> str:
    return ", ".join(f"round(sum(CASE WHEN {column} = '{s}' THEN {value} END), 6) AS \"{s}\""
                     for s in SEGMENTS)


LINEITEM_ORDER = ", ".join(f"{c} NULLS FIRST" for c in [
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"])

PAGES_DEFECTIVE = """
pages_d AS (
  SELECT page_id,
         CASE WHEN page_id % 50 = 0 THEN regexp_replace(url, '^https?://', '')
              WHEN page_id % 50 = 25 THEN upper(url)
              WHEN page_id % 50 = 10 THEN concat(' ', url)
              ELSE url END AS url
  FROM pages)
"""

UPSERT = with_ctes("""
target AS (SELECT * FROM orders WHERE o_orderkey % 10 < 8)""", """
source AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1.0 AS o_totalprice, o_orderdate,
                  o_orderpriority
           FROM orders WHERE o_orderkey % 2 = 0 OR o_orderkey % 10 = 9)""", body="""
SELECT * FROM source
UNION ALL
SELECT * FROM target t WHERE NOT EXISTS (SELECT 1 FROM source s WHERE s.o_orderkey = t.o_orderkey)""")

UPSERT_NEW_COLUMN = with_ctes("""
target AS (SELECT * FROM orders WHERE o_orderkey % 10 < 8)""", """
source AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1.0 AS o_totalprice, o_orderdate,
                  o_orderpriority, o_orderkey % 7 AS key_class
           FROM orders WHERE o_orderkey % 2 = 0 OR o_orderkey % 10 = 9)""", body="""
SELECT * FROM source
UNION ALL
SELECT *, NULL FROM target t WHERE NOT EXISTS (SELECT 1 FROM source s WHERE s.o_orderkey = t.o_orderkey)""")

UPSERT_WIDENED = """
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(CASE WHEN o_orderkey % 2 = 0 OR o_orderkey % 10 = 9
  THEN o_totalprice + 1.0 ELSE floor(o_totalprice) END AS DOUBLE) AS o_totalprice, o_orderdate, o_orderpriority FROM orders"""

MERGE_EVENTS = with_ctes("""
source AS (SELECT event_id, ts + INTERVAL 1 DAY AS ts, user_id, event_type, value + 1.0 AS value, props
           FROM events WHERE event_id % 3 = 0)""", body="""
SELECT * FROM source UNION ALL SELECT * FROM events WHERE event_id % 3 <> 0""")

_SUMMARY_STEPS = [("bronze", e, f"(SELECT count(*) FROM t_{e})", "NULL", "NULL") for e in
                  ["advertisers", "campaigns", "ads", "impressions", "clicks", "conversions"]] + [
    ("silver", e, f"(SELECT count(*) FROM s_{e})",
     f"(SELECT count(*) FROM t_{e}) - (SELECT count(*) FROM d_{e})",
     {"clicks": "(SELECT count(*) FROM s_clicks WHERE is_orphan_impression_id)",
      "conversions": "(SELECT count(*) FROM s_conversions WHERE is_orphan_click_id)"}.get(e, "0"))
    for e in ["advertisers", "campaigns", "ads", "impressions", "clicks", "conversions"]] + [
    ("gold", "campaign_performance_by_channel", "(SELECT count(*) FROM s_campaigns)", "NULL", "NULL"),
    ("gold", "advertiser_revenue_by_industry", "(SELECT count(*) FROM s_advertisers)", "NULL", "NULL"),
    ("gold", "revenue_by_country_industry_pivot", "(SELECT count(DISTINCT country) FROM s_advertisers)", "NULL", "NULL"),
]

RUN_SUMMARY = with_ctes(TESTBED, SILVER, body="\nUNION ALL ".join(
    f"SELECT {n + 1} AS step, '{layer}' AS layer, '{entity}' AS entity, 'OK' AS status, "
    f"CAST({rows} AS BIGINT) AS rows, CAST({dups} AS BIGINT) AS duplicates_removed, "
    f"CAST({orphans} AS BIGINT) AS orphans, CAST(NULL AS VARCHAR) AS error, true AS in_catalog"
    for n, (layer, entity, rows, dups, orphans) in enumerate(_SUMMARY_STEPS)))

ORACLE: dict[str, str] = {
    "gold_campaign_performance": GOLD_CAMPAIGN_PERFORMANCE,
    "gold_daily_updates": GOLD_CAMPAIGN_PERFORMANCE,
    "funnel_rows": with_ctes(TESTBED, SILVER, body=f"""
SELECT c.id AS campaign_id, count(*) AS funnel_rows {FUNNEL_FROM} GROUP BY c.id"""),
    "gold_advertiser_revenue": with_ctes(TESTBED, SILVER, ADVERTISER_AGG, body="""
SELECT advertiser_id, advertiser_name, industry, country, total_revenue_usd, conversions_count,
       round(sum(total_revenue_usd) OVER w, 6) AS industry_total_revenue_usd,
       round(CASE WHEN sum(total_revenue_usd) OVER w <> 0 THEN total_revenue_usd / sum(total_revenue_usd) OVER w
                  ELSE 0.0 END, 9) AS revenue_share_in_industry
FROM adv_agg WINDOW w AS (PARTITION BY industry)"""),
    "gold_revenue_pivot": with_ctes(TESTBED, SILVER, ADVERTISER_AGG, body=f"""
SELECT country, {_pivot_cells("industry", "total_revenue_usd")} FROM adv_agg GROUP BY country"""),
    "rank_in_channel": """
SELECT o_orderkey, o_orderpriority AS channel, o_totalprice,
       CAST(rank() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC NULLS LAST) AS INTEGER)
         AS rank_in_channel
FROM orders""",
    "industry_share": """
SELECT c_custkey, c_mktsegment, c_acctbal,
       round(sum(c_acctbal) OVER w, 6) AS segment_total_acctbal,
       round(CASE WHEN sum(c_acctbal) OVER w <> 0 THEN c_acctbal / sum(c_acctbal) OVER w ELSE 0.0 END, 9)
         AS acctbal_share
FROM customer WINDOW w AS (PARTITION BY c_mktsegment)""",
    "pivot_country_industry": f"""
SELECT n_name AS country, {_pivot_cells("c_mktsegment", "c_acctbal")}
FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""",
    "dedup_lineitem": f"""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
       l_returnflag, l_linestatus, l_shipdate
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINEITEM_ORDER}) AS rn
      FROM lineitem) WHERE rn = 1""",
    "dedup_metrics": """
SELECT CAST(sum(n) AS BIGINT) AS rows_before, count(*) AS rows_after,
       CAST(sum(n) - count(*) AS BIGINT) AS duplicates_removed
FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)""",
    "fk_flag_events_supplier": """
SELECT e.*, NOT EXISTS (SELECT 1 FROM supplier s WHERE s.s_suppkey = e.user_id) AS is_orphan_user_id
FROM events e""",
    "fk_flag_clicks": with_ctes(TESTBED, body="""
SELECT id, impression_id,
       NOT EXISTS (SELECT 1 FROM t_impressions p WHERE p.id = c.impression_id) AS is_orphan_impression_id
FROM t_clicks c"""),
    "fk_orphan_count": with_ctes(TESTBED, body="""
SELECT 'events.user_id -> supplier.s_suppkey' AS fk_check, count(*) AS rows,
       count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM supplier s WHERE s.s_suppkey = e.user_id)) AS orphans
FROM events e
UNION ALL
SELECT 'clicks.impression_id -> impressions.id', count(*),
       count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM t_impressions p WHERE p.id = c.impression_id))
FROM t_clicks c"""),
    "cast_orders": """
SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey, o_orderstatus,
       CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) AS o_totalprice,
       CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority
FROM orders""",
    "trim_customer": """
SELECT c_custkey, trim(concat('  ', c_name, ' ')) AS c_name, c_nationkey, c_acctbal,
       trim(concat(' ', c_mktsegment)) AS c_mktsegment
FROM customer""",
    "fix_protocol_pages": with_ctes(PAGES_DEFECTIVE, body="""
SELECT page_id, trim(CASE WHEN NOT regexp_matches(url, '^https?://') THEN concat('https://', url)
                          ELSE url END) AS url
FROM pages_d"""),
    "flag_zero_discount": """
SELECT l_orderkey, l_linenumber, l_discount, l_discount = 0 AS is_zero_discount FROM lineitem""",
    "flag_present_creative": with_ctes(TESTBED, body="""
SELECT id, creative_url, creative_url IS NOT NULL AS has_creative_url FROM t_ads"""),
    "silver_advertisers": _silver_select("advertisers", "*"),
    "silver_campaigns": _silver_select(
        "campaigns", "id, advertiser_id, campaign_name, channel, objective, "
                     "CAST(daily_budget_usd AS DOUBLE) AS daily_budget_usd, has_zero_budget"),
    "silver_ads": _silver_select("ads", "*"),
    "silver_impressions": _silver_select(
        "impressions", "id, ad_id, \"timestamp\", country, CAST(cost_usd AS DOUBLE) AS cost_usd, "
                       "is_zero_cost_impression"),
    "silver_clicks": _silver_select(
        "clicks", "id, impression_id, \"timestamp\", CAST(cost_usd AS DOUBLE) AS cost_usd, "
                  "is_orphan_impression_id"),
    "silver_conversions": _silver_select(
        "conversions", "id, click_id, \"timestamp\", CAST(value_usd AS DOUBLE) AS value_usd, "
                       "is_orphan_click_id"),
    "dq_profile": with_ctes(TESTBED, """
checks AS (
  SELECT 'advertisers' AS entity, 'website_without_protocol' AS dq_check, count(*) AS rows,
         count(*) FILTER (WHERE NOT regexp_matches(website, '^https?://')) AS defects FROM t_advertisers
  UNION ALL SELECT 'campaigns', 'zero_budget', count(*), count(*) FILTER (WHERE daily_budget_usd = 0)
    FROM t_campaigns
  UNION ALL SELECT 'ads', 'missing_creative', count(*), count(*) FILTER (WHERE creative_url IS NULL) FROM t_ads
  UNION ALL SELECT 'impressions', 'zero_cost', count(*), count(*) FILTER (WHERE cost_usd = 0) FROM t_impressions
  UNION ALL SELECT 'clicks', 'orphan_impression_id', count(*),
    count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM t_impressions p WHERE p.id = c.impression_id))
    FROM t_clicks c
  UNION ALL SELECT 'conversions', 'orphan_click_id', count(*),
    count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM t_clicks p WHERE p.id = v.click_id))
    FROM t_conversions v
  UNION ALL SELECT 'impressions', 'exact_duplicate', CAST(sum(n) AS BIGINT), CAST(sum(n - 1) AS BIGINT)
    FROM (SELECT count(*) AS n FROM t_impressions GROUP BY id, ad_id, "timestamp", country, cost_usd))
""", body="""
SELECT entity, dq_check, CAST(rows AS BIGINT) AS rows, CAST(defects AS BIGINT) AS defects,
       CASE WHEN rows > 0 THEN defects / rows ELSE 0.0 END AS rate
FROM checks"""),
    "merge_first_run": "SELECT * FROM orders",
    "merge_upsert": UPSERT,
    "merge_rerun_idempotent": UPSERT,
    "merge_changed_partitions": UPSERT,
    "merge_key_width": UPSERT,
    "merge_null_day": MERGE_EVENTS,
    "merge_growing": "SELECT *, true AS partitions_bounded FROM orders",
    "upsert_new_column_plain": UPSERT_NEW_COLUMN,
    "upsert_widened_value": UPSERT_WIDENED,
    "overwrite_roundtrip": "SELECT * FROM nation",
    "overwrite_new_column": "SELECT *, o_orderkey % 7 AS key_class FROM orders",
    "ingest_type_widening": """
SELECT event_id, CASE WHEN later THEN value ELSE CAST(floor(value) AS DOUBLE) END AS value,
  CASE WHEN later THEN concat('u', user_id) ELSE CAST(user_id AS VARCHAR) END AS user_id,
  CASE WHEN later THEN event_type END AS detail_type, CASE WHEN later THEN length(props) END AS detail_size
FROM (SELECT *, ts >= TIMESTAMP '2024-01-16 00:00:00' AS later FROM events)""",
    "ingest_rejects": """
SELECT event_id, CASE WHEN outcome = 'loaded' THEN user_id END AS user_id, CASE WHEN outcome = 'loaded' THEN value END AS value,
  outcome
FROM (SELECT *, CASE WHEN ts >= TIMESTAMP '2024-01-16 00:00:00' THEN 'loaded'
    WHEN event_id % 7 = 0 THEN 'not JSON, or a name twice in an object'
    WHEN event_id % 11 = 0 THEN 'not an object' ELSE 'loaded' END AS outcome FROM events)""",
    "fk_flag_composite": """
SELECT event_id, user_id, NOT EXISTS (SELECT 1 FROM events v WHERE v.event_type = 'view' AND v.user_id = e.user_id
    AND CAST(v.ts AS DATE) = CAST(e.ts AS DATE)) AS no_view_that_day FROM events e""",
    "funnel_composite": with_ctes(TESTBED, SILVER, """
i2 AS (SELECT id // 7 AS id, id % 7 AS day, ad_id, cost_usd FROM s_impressions),
c2 AS (SELECT id // 7 AS id, id % 7 AS day, impression_id // 7 AS impression_id, impression_id % 7 AS impression_day, cost_usd
       FROM s_clicks),
v2 AS (SELECT id // 7 AS id, id % 7 AS day, click_id // 7 AS click_id, click_id % 7 AS click_day, value_usd FROM s_conversions),
k2 AS (SELECT * FROM c2 WHERE EXISTS (SELECT 1 FROM i2 WHERE i2.id = c2.impression_id AND i2.day = c2.impression_day)),
w2 AS (SELECT * FROM v2 WHERE EXISTS (SELECT 1 FROM c2 WHERE c2.id = v2.click_id AND c2.day = v2.click_day))
""", body="""
SELECT c.id AS campaign_id, count(*) AS funnel_rows, count(i.id) AS impressions_count, count(cl.id) AS clicks_count,
       count(co.id) AS conversions_count, CAST(sum(i.cost_usd) AS DOUBLE) AS total_impression_cost_usd,
       CAST(sum(cl.cost_usd) AS DOUBLE) AS total_click_cost_usd, CAST(sum(co.value_usd) AS DOUBLE) AS total_conversion_value_usd
FROM s_campaigns c LEFT JOIN s_ads a ON a.campaign_id = c.id LEFT JOIN i2 i ON i.ad_id = a.id
LEFT JOIN k2 cl ON cl.impression_id = i.id AND cl.impression_day = i.day
LEFT JOIN w2 co ON co.click_id = cl.id AND co.click_day = cl.day GROUP BY c.id"""),
    "silver_daily_loads": _silver_select(
        "clicks", "id, impression_id, \"timestamp\", CAST(cost_usd AS DOUBLE) AS cost_usd, "
                  "is_orphan_impression_id"),
    "silver_children_first": with_ctes(TESTBED, SILVER, body="""
SELECT 'clicks' AS entity, id, is_orphan_impression_id AS orphan FROM s_clicks
UNION ALL SELECT 'conversions', id, is_orphan_click_id FROM s_conversions"""),
    "ingest_incremental": "SELECT * FROM events",
    "ingest_schema_evolution": """
SELECT *, CASE WHEN ts >= TIMESTAMP '2024-01-16 00:00:00' THEN length(props) END AS props_len FROM events""",
    "bronze_catalog": """
SELECT *, CASE WHEN ts >= TIMESTAMP '2024-01-16 00:00:00' THEN length(props) END AS props_len FROM events""",
    "run_summary": RUN_SUMMARY,
    "event_window": """
SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-10 00:00:00' AND ts < TIMESTAMP '2024-01-13 00:00:00'""",
}
