"""Registered queries of web events, ad platforms and campaign marts."""

from __future__ import annotations

from ..plans import pipeline
from ..plans.checks import unmapped_utm_pairs, unreconciled_spend
from ..sources.starschema import TIKTOK_BASE, raw_tables
from .present import Query, day, query, seed_values, ts
from .store import STAMP

EVENTS = """
    SELECT *, cast(json_extract_string(props, '$.k') AS bigint) AS k,
           event_type = 'purchase' AS bought, event_type IN ('view', 'purchase') AS landed,
           'user.' || user_id AS pseudo, epoch_us(ts) AS us
    FROM events
"""
PAGE = (
    "'https://shop.example.com/p/' || k || '?fbclid=F' || event_id || '&_kx=a%20b+c&GBRAID='"
    " || event_type || '#frag'"
)
EVENT_ID = f"md5(pseudo || '-' || us || '-' || event_type || '-' || {PAGE})"

ITEM_COUNT = "CASE event_type WHEN 'purchase' THEN 2 WHEN 'view' THEN 1 ELSE 0 END"


def money(expr: str, precision: int = 12) -> str:
    return f"cast(cast({expr} AS decimal({precision},2)) AS double)"


META_STATS = """
    SELECT cast(event_id AS varchar) AS ad_id, cast(user_id AS varchar) AS campaign_id,
           cast(ts AS date) AS date_day, k * 100 AS impressions, k * 50 AS reach, k * 3 AS clicks,
           k * 2 AS link_clicks, cast(value + 0.005 AS decimal(14,2)) AS spend,
           CASE WHEN bought THEN k + 0.5 ELSE 0 END AS platform_conversions,
           CASE WHEN bought THEN k + 0.25 ELSE 0 END AS platform_conversion_value,
           user_id, ts
    FROM ({events})
"""
META_STATS = META_STATS.format(events=EVENTS)

GOOGLE_STATS = """
    SELECT l_suppkey AS campaign_id, l_suppkey * 3 AS account_id, cast(l_shipdate AS date) AS date_day,
           l_returnflag AS ad_network_type, l_linestatus AS device, l_orderkey AS impressions,
           cast(l_quantity AS bigint) AS clicks,
           cast((cast(round(l_extendedprice * 100) AS bigint) * 10000
                 + cast(l_quantity AS bigint) * 1000) / 1000000.0 AS decimal(14,2)) AS spend,
           2::bigint AS video_views, l_quantity AS platform_conversions,
           cast(l_extendedprice AS decimal(14,2)) AS platform_conversion_value,
           1::bigint AS view_through_conversions,
           l_shipdate + to_milliseconds(l_orderkey * 1000 + l_linenumber * 100)
             AS _airbyte_extracted_at
    FROM lineitem
"""

TIKTOK_STATS = f"""
    SELECT {TIKTOK_BASE} + user_id AS campaign_id, user_id AS account_id,
           cast(ts AS date) AS date_day, k * 9 AS impressions, k AS clicks, k * 5 AS reach,
           cast(value AS decimal(14,2)) AS spend, cast(k AS double) AS platform_conversions,
           k + 0.75 AS platform_conversion_value, ts
    FROM ({EVENTS})
"""

LINKEDIN_ID = "CASE {k} WHEN 1 THEN 388013719 WHEN 2 THEN 396428322 ELSE {k} END"

LINKEDIN_STATS = f"""
    SELECT {LINKEDIN_ID.format(k="o_custkey")} AS campaign_id, cast(o_orderdate AS date) AS date_day,
           o_orderkey AS impressions, o_custkey AS clicks, p AS landing_page_clicks,
           cast(o_totalprice AS decimal(14,2)) AS spend, 0::bigint AS video_views,
           p AS platform_conversions,
           cast(o_totalprice / 8 AS decimal(14,2)) AS platform_conversion_value, o_orderdate
    FROM (SELECT *, cast(substr(o_orderpriority, 1, 1) AS bigint) AS p FROM orders)
"""

# The latest row per campaign, found by comparing instead of ranking.
GOOGLE_LATEST = """
    SELECT DISTINCT l.l_suppkey, l.l_orderkey, l.l_linenumber, l.l_shipdate
    FROM lineitem l
    JOIN (SELECT l_suppkey, max((l_shipdate, l_orderkey, l_linenumber)) AS newest
          FROM lineitem GROUP BY 1) m
      ON l.l_suppkey = m.l_suppkey AND (l.l_shipdate, l.l_orderkey, l.l_linenumber) = m.newest
"""
GOOGLE_CAMPAIGNS = f"""
    SELECT l_suppkey AS campaign_id,
           'Search | ' || l_orderkey || ' | ' || l_linenumber AS campaign_name,
           l_suppkey * 3 AS account_id,
           CASE l_linenumber WHEN 1 THEN 'REMOVED' WHEN 2 THEN 'PAUSED' ELSE 'ENABLED' END
             AS campaign_status,
           'SERVING' AS serving_status, 'SEARCH' AS advertising_channel_type,
           cast(NULL AS varchar) AS advertising_channel_sub_type, 'MAX' AS bidding_strategy_type,
           l_orderkey AS campaign_budget_id, '2024-01-31' AS start_date,
           CASE WHEN l_linenumber >= 4 THEN '2025-06-30' END AS end_date,
           l_shipdate + to_milliseconds(l_orderkey * 1000 + l_linenumber * 100)
             AS _airbyte_extracted_at
    FROM ({GOOGLE_LATEST})
"""

META_STATUS = (
    "CASE c_mktsegment WHEN 'MACHINERY' THEN 'PAUSED' WHEN 'BUILDING' THEN 'ARCHIVED'"
    " WHEN 'HOUSEHOLD' THEN 'IN_PROCESS' WHEN 'FURNITURE' THEN NULL ELSE 'active' END"
)

CAMPAIGNS = f"""
    SELECT md5(platform || '-' || campaign_id) AS campaign_key, platform, campaign_id,
           campaign_name, account_id,
           CASE lower(coalesce(s, '')) WHEN 'active' THEN 'active' WHEN 'enabled' THEN 'active'
             WHEN 'enable' THEN 'active' WHEN 'paused' THEN 'paused' WHEN 'disable' THEN 'paused'
             WHEN 'removed' THEN 'removed' WHEN 'archived' THEN 'removed' ELSE 'other' END
             AS campaign_status,
           s AS platform_campaign_status
    FROM (
      SELECT 'Meta' AS platform, cast(c_custkey AS varchar) AS campaign_id,
             'PROS | ' || c_name AS campaign_name, 'act' || c_nationkey AS account_id,
             {META_STATUS} AS s FROM customer
      UNION ALL
      SELECT 'Google Ads', cast(campaign_id AS varchar), campaign_name,
             cast(account_id AS varchar), campaign_status FROM ({GOOGLE_CAMPAIGNS})
      UNION ALL
      SELECT 'TikTok', cast({TIKTOK_BASE} + c_custkey AS varchar), 'TT | ' || c_name,
             cast(c_nationkey AS varchar),
             CASE WHEN c_mktsegment = 'MACHINERY' THEN 'DISABLE' ELSE 'ENABLE' END FROM customer
      UNION ALL
      SELECT 'LinkedIn', cast({LINKEDIN_ID.format(k="c_custkey")} AS varchar), 'LI | ' || c_name,
             cast(c_nationkey AS varchar),
             CASE WHEN c_mktsegment = 'MACHINERY' THEN 'paused' ELSE 'ACTIVE' END FROM customer)
"""

PERFORMANCE = f"""
    SELECT md5(platform || '-' || campaign_id) AS campaign_key, * FROM (
      SELECT 'Meta' AS platform, campaign_id, date_day, sum(spend) AS spend,
             cast(sum(impressions) AS bigint) AS impressions,
             cast(sum(link_clicks) AS bigint) AS clicks,
             cast(sum(platform_conversions) AS double) AS platform_conversions,
             cast(sum(platform_conversion_value) AS double) AS platform_conversion_value
      FROM ({META_STATS}) GROUP BY ALL
      UNION ALL
      SELECT 'Google Ads', cast(campaign_id AS varchar), date_day, sum(spend),
             cast(sum(impressions) AS bigint), cast(sum(clicks) AS bigint),
             sum(platform_conversions), cast(sum(platform_conversion_value) AS double)
      FROM ({GOOGLE_STATS}) GROUP BY ALL
      UNION ALL
      SELECT 'TikTok', cast(campaign_id AS varchar), date_day, spend, impressions, clicks,
             platform_conversions, cast(platform_conversion_value AS double) FROM ({TIKTOK_STATS})
      UNION ALL
      SELECT 'LinkedIn', cast(campaign_id AS varchar), date_day, spend, impressions,
             landing_page_clicks, cast(platform_conversions AS double),
             cast(platform_conversion_value AS double) FROM ({LINKEDIN_STATS}))
"""

DIM = f"""
    SELECT c.*, a.channel, a.campaign_tactic, a.initiative_name,
           a.initiative_name = 'Always-on' AS is_always_on
    FROM ({CAMPAIGNS}) c LEFT JOIN (
      SELECT platform, campaign_id, channel, campaign_tactic, initiative_name
      FROM {seed_values("campaign_attributes")}) a USING (platform, campaign_id)
"""

FACT = f"""
    SELECT f.date_day, f.campaign_key, f.platform, d.channel, f.campaign_id, d.campaign_name,
           d.campaign_tactic, d.initiative_name, d.is_always_on, f.spend, f.impressions, f.clicks,
           f.platform_conversions, f.platform_conversion_value
    FROM ({PERFORMANCE}) f LEFT JOIN ({DIM}) d USING (campaign_key)
"""

SQL = {
    "ga4_events": f"""
        SELECT {EVENT_ID} AS event_id, md5(pseudo || '-' || (user_id * 100 + k)) AS session_key,
               pseudo AS user_pseudo_id, user_id * 100 + k AS ga_session_id,
               k AS ga_session_number, CASE WHEN event_type <> 'signup' THEN user_id END
                 AS customer_id,
               CASE WHEN bought THEN event_id END AS order_id, event_type AS event_name,
               {day("ts")} AS event_date, {ts("ts")} AS event_at,
               {ts("ts - to_microseconds(1000001)")} AS user_first_touch_at,
               {PAGE} AS page_location, 'https://shop.example.com/p/' || k AS page_url,
               'Title ' || k AS page_title, cast(NULL AS varchar) AS page_referrer,
               CASE WHEN landed THEN 'google' END AS utm_source,
               CASE WHEN landed THEN 'cpc' END AS utm_medium,
               CASE WHEN landed THEN 'camp ' || user_id END AS utm_campaign,
               CASE WHEN landed THEN cast(user_id AS varchar) END AS utm_id,
               cast(NULL AS varchar) AS utm_content, cast(NULL AS varchar) AS utm_term,
               cast(NULL AS varchar) AS gclid, event_type AS gbraid, 'F' || event_id AS fbclid,
               cast(NULL AS varchar) AS ttclid, cast(NULL AS varchar) AS li_fat_id,
               'a b+c' AS klaviyo_kx, CASE WHEN event_type = 'click' THEN 'S' END AS srsltid,
               'Paid' AS ga4_last_click_channel_group, 'google' AS ga4_last_click_source,
               'cpc' AS ga4_last_click_medium, cast(k AS varchar) AS ga4_last_click_campaign_id,
               'n' AS ga4_last_click_campaign_name, 'g' AS ga4_last_click_google_ad_group_id,
               CASE WHEN event_type <> 'error' THEN 'direct' END AS first_user_source,
               CASE WHEN event_type <> 'error' THEN '(none)' END AS first_user_medium,
               CASE WHEN event_type <> 'error' THEN '(direct)' END AS first_user_campaign,
               CASE WHEN landed THEN 'USD' END AS currency,
               CASE WHEN landed THEN {money("value")} END AS event_value,
               CASE WHEN bought THEN {money("value")} END AS purchase_revenue,
               CASE WHEN bought THEN {money("4.995::double")} END AS shipping_value,
               CASE WHEN bought THEN {money("value / 8")} END AS tax_value,
               CASE WHEN bought THEN 3::bigint END AS total_item_quantity,
               CASE WHEN bought THEN 2::bigint END AS unique_items,
               'mobile' AS device_category, 'Android' AS operating_system,
               '14' AS operating_system_version, 'Browser ' || k AS browser,
               'Brand' AS mobile_brand_name, 'en-us' AS language, 'US' AS geo_country,
               'NY' AS geo_region, 'C' || user_id AS geo_city, cast(NULL AS varchar) AS geo_metro,
               'Yes' AS ads_storage_consent, k > 50 AS is_active_user
        FROM ({EVENTS})""",
    "ga4_event_items": f"""
        SELECT {EVENT_ID} AS event_id, n AS item_index, event_type AS event_name,
               {day("ts")} AS event_date, {ts("ts")} AS event_at, pseudo AS user_pseudo_id,
               CASE WHEN bought THEN event_id END AS order_id,
               'shopify_US_' || user_id || '_' || (k + n) AS item_id, user_id AS product_id,
               k + n AS variant_id, 'Item ' || n AS item_name,
               CASE WHEN n <> 2 THEN 'Red' END AS item_variant, 'cat' AS item_category,
               'brand' AS item_brand, n AS quantity, {money("value + 0.005")} AS unit_price,
               CASE WHEN bought THEN {money("value * n")} END AS item_revenue
        FROM (SELECT *, unnest(range(1, 1 + {ITEM_COUNT})) AS n FROM ({EVENTS}))""",
    "meta_ad_stats_daily": f"""
        SELECT ad_id, 'set' || user_id AS adset_id, campaign_id, 'act1' AS account_id,
               {day("date_day")} AS date_day, impressions, reach, clicks, link_clicks,
               spend::double AS spend, platform_conversions::double AS platform_conversions,
               platform_conversion_value::double AS platform_conversion_value,
               {ts("ts")} AS _airbyte_extracted_at
        FROM ({META_STATS})""",
    "meta_campaigns": f"""
        SELECT c_custkey AS campaign_id, 'PROS | ' || c_name AS campaign_name,
               'act' || c_nationkey AS account_id, c_mktsegment AS objective,
               {META_STATUS} AS campaign_status, 'ACTIVE' AS effective_status,
               'LOWEST_COST' AS bid_strategy, 'x' AS smart_promotion_type,
               CASE WHEN c_acctbal >= 0 THEN c_custkey / 100 END AS daily_budget,
               {ts(STAMP)} AS started_at, cast(NULL AS varchar) AS stopped_at,
               {ts(STAMP)} AS created_at, {ts(STAMP)} AS updated_at,
               {ts(STAMP)} AS _airbyte_extracted_at
        FROM customer""",
    "google_campaigns": f"""
        SELECT * REPLACE ({ts("_airbyte_extracted_at")} AS _airbyte_extracted_at)
        FROM ({GOOGLE_CAMPAIGNS})""",
    "google_campaign_stats_daily": f"""
        SELECT * REPLACE ({day("date_day")} AS date_day, spend::double AS spend,
                 platform_conversion_value::double AS platform_conversion_value,
                 {ts("_airbyte_extracted_at")} AS _airbyte_extracted_at)
        FROM ({GOOGLE_STATS})""",
    "linkedin_campaigns": f"""
        SELECT {LINKEDIN_ID.format(k="c_custkey")} AS campaign_id, 'LI | ' || c_name AS campaign_name,
               cast(c_nationkey AS bigint) AS account_id,
               cast(c_nationkey AS bigint) AS campaign_group_id, c_mktsegment AS objective,
               CASE WHEN c_mktsegment = 'MACHINERY' THEN 'paused' ELSE 'ACTIVE' END
                 AS campaign_status,
               'SPONSORED_UPDATES' AS campaign_type, 'CPM' AS cost_type, 'STANDARD' AS ad_format,
               'NONE' AS optimization_target_type,
               CASE WHEN c_acctbal >= 0 THEN c_custkey + 0.5 END::double AS daily_budget,
               CASE WHEN c_acctbal >= 0 THEN 'USD' END AS daily_budget_currency,
               true AS is_offsite_delivery_enabled, false AS is_audience_expansion_enabled,
               {ts("make_timestamp((1700000000123 + c_custkey) * 1000)")} AS started_at,
               cast(NULL AS varchar) AS stopped_at, {ts(STAMP)} AS created_at,
               {ts(STAMP)} AS updated_at, {ts(STAMP)} AS _airbyte_extracted_at
        FROM customer""",
    "linkedin_campaign_groups": f"""
        SELECT cast(n_nationkey AS bigint) AS campaign_group_id, n_name AS campaign_group_name,
               cast(n_regionkey AS bigint) AS account_id, 'ACTIVE' AS campaign_group_status,
               cast(NULL AS bigint) AS total_budget, n_regionkey = 0 AS is_test,
               {ts("make_timestamp(1700000000000000)")} AS started_at,
               {ts("make_timestamp(1700000000000000 + n_nationkey * 1000000::bigint)")}
                 AS stopped_at,
               {ts(STAMP)} AS created_at, {ts(STAMP)} AS updated_at,
               {ts(STAMP)} AS _airbyte_extracted_at
        FROM nation""",
    "linkedin_campaign_stats_daily": f"""
        SELECT * EXCLUDE (o_orderdate) REPLACE ({day("date_day")} AS date_day,
                 spend::double AS spend,
                 platform_conversion_value::double AS platform_conversion_value),
               {ts("o_orderdate")} AS _airbyte_extracted_at
        FROM ({LINKEDIN_STATS})""",
    "tiktok_campaigns": f"""
        SELECT {TIKTOK_BASE} + c_custkey AS campaign_id, 'TT | ' || c_name AS campaign_name,
               cast(c_nationkey AS bigint) AS account_id, c_mktsegment AS objective,
               'REGULAR' AS campaign_type,
               CASE WHEN c_mktsegment = 'MACHINERY' THEN 'DISABLE' ELSE 'ENABLE' END
                 AS campaign_status,
               's' AS secondary_status, 'DAY' AS budget_mode, c_acctbal AS budget,
               true AS is_smart_performance_campaign, false AS is_search_campaign,
               {ts(STAMP)} AS created_at, {ts(STAMP)} AS updated_at,
               {ts(STAMP)} AS _airbyte_extracted_at
        FROM customer""",
    "tiktok_campaign_stats_daily": f"""
        SELECT * EXCLUDE (ts) REPLACE ({day("date_day")} AS date_day, spend::double AS spend,
                 platform_conversion_value::double AS platform_conversion_value),
               {ts("ts")} AS _airbyte_extracted_at
        FROM ({TIKTOK_STATS})""",
    "campaigns_unioned": CAMPAIGNS,
    "campaign_performance_daily": f"""
        SELECT * REPLACE ({day("date_day")} AS date_day, spend::double AS spend)
        FROM ({PERFORMANCE})""",
    "dim_campaigns": DIM,
    "fct_campaign_performance_daily": f"""
        SELECT * REPLACE ({day("date_day")} AS date_day, spend::double AS spend) FROM ({FACT})""",
}


def _table(name: str):
    return lambda spark, sf: pipeline.Tables(raw_tables(spark, sf))[name]


def _unmapped(spark, sf):
    t = pipeline.Tables(raw_tables(spark, sf))
    return unmapped_utm_pairs(
        t["shopify_orders"], t["shopify_customer_journeys"], t["channel_mapping"]
    )


def _unreconciled(spark, sf):
    raw = raw_tables(spark, sf)
    gaps = unreconciled_spend(pipeline.Tables(raw)["fct_campaign_performance_daily"], raw)
    return gaps.withColumn("source_spend", gaps.source_spend.cast("decimal(38,2)"))


QUERIES: dict[str, Query] = {name: query(_table(name), sql) for name, sql in SQL.items()}

# Orders of priority 2 and 1 carry mapped pairs, the others none or a broken one.
QUERIES["unmapped_utm_pairs"] = query(
    _unmapped,
    f"""
    SELECT utm_source, utm_medium FROM (
      SELECT DISTINCT CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'google' WHEN '2' THEN 'fb'
                        WHEN '5' THEN '100%zza' END AS utm_source,
                      CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'cpc'
                        WHEN '2' THEN 'paid social' END AS utm_medium
      FROM orders) seen
    WHERE utm_source IS NOT NULL AND NOT EXISTS (
      SELECT 1 FROM {seed_values("channel_mapping")}
      WHERE channel_mapping.utm_source = seen.utm_source
        AND channel_mapping.utm_medium = seen.utm_medium)""",
)
QUERIES["unreconciled_spend"] = query(
    _unreconciled,
    f"""
    SELECT platform, cast(cast(source AS decimal(38,2)) AS double) AS source_spend,
           cast(fact AS double) AS fact_spend
    FROM (SELECT platform, sum(spend) AS fact FROM ({PERFORMANCE}) GROUP BY 1)
    JOIN (SELECT 'Meta' AS platform, sum(value + 0.005) AS source FROM events
          UNION ALL SELECT 'Google Ads', sum(cast(round(l_extendedprice * 100) AS bigint) * 10000
                             + cast(l_quantity AS bigint) * 1000) / 1000000.0 FROM lineitem
          UNION ALL SELECT 'TikTok', sum(value) FROM events
          UNION ALL SELECT 'LinkedIn', sum(o_totalprice) FROM orders) USING (platform)
    WHERE abs(source - fact) > 0.01""",
)
