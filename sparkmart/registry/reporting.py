"""Registered queries of the reporting plans."""

from __future__ import annotations

from ..plans import pipeline, reporting
from ..sources.starschema import raw_tables
from . import marketing, store
from .present import Query, day, query, seed_values


def _ratios(spark, sf):
    return reporting.campaign_ratios(pipeline.Tables(raw_tables(spark, sf))["fct_campaign_performance_daily"])


def _channels(spark, sf):
    tables = pipeline.Tables(raw_tables(spark, sf))
    return reporting.order_channels(tables["shopify_orders"], tables["channel_mapping"])


def _calendar(plan):
    return lambda spark, sf: plan(raw_tables(spark, sf)("manual", "marketing_calendar"))


# Entries by day: their ranges with both ends, nothing for reversed ones.
CALENDAR = """SELECT unnest(generate_series(start_date, coalesce(end_date, start_date), INTERVAL 1 DAY))::DATE AS date_day, *
    FROM (SELECT CASE p_partkey % 4 WHEN 0 THEN 'promotion' WHEN 1 THEN 'event' WHEN 2 THEN 'media_change' ELSE 'media_flight' END AS entry_type,
            p_name AS name, CASE WHEN p_size <> 11 THEN DATE '2024-01-01' + (p_partkey % 90)::INT END AS start_date,
            CASE WHEN p_size <> 7 THEN DATE '2024-01-01' + (p_partkey % 90 + p_size % 9 - 2)::INT END AS end_date,
            CASE WHEN p_partkey % 4 = 0 THEN p_size::DOUBLE END AS discount_pct, CASE WHEN p_partkey % 4 = 0 THEN p_brand END AS discount_code,
            CASE WHEN p_partkey % 4 = 0 THEN 'all' ELSE 'youtube' END AS channels FROM part)
    WHERE start_date IS NOT NULL AND (end_date IS NULL OR end_date >= start_date)"""

_SUMS = """sum(spend)::DECIMAL(38,2) AS spend, sum(impressions)::BIGINT AS impressions, sum(clicks)::BIGINT AS clicks,
        sum(platform_conversions::DECIMAL(38,6))::DOUBLE AS platform_conversions,
        sum(platform_conversion_value)::DECIMAL(38,2) AS platform_conversion_value"""

QUERIES: dict[str, Query] = {
    "campaign_ratios": query(
        _ratios,
        f"""WITH f AS (SELECT * REPLACE (spend::DECIMAL(38,2) AS spend, platform_conversion_value::DECIMAL(38,2) AS platform_conversion_value)
                       FROM ({marketing.SQL["fct_campaign_performance_daily"]})),
            levels AS (
              SELECT 'campaign' AS level, platform, campaign_key, {_SUMS} FROM f GROUP BY platform, campaign_key
              UNION ALL SELECT 'platform', platform, NULL, {_SUMS} FROM f GROUP BY platform
              UNION ALL SELECT 'total', NULL, NULL, {_SUMS} FROM f)
            SELECT level, platform, campaign_key, spend::DOUBLE AS spend, impressions, clicks, platform_conversions,
              platform_conversion_value::DOUBLE AS platform_conversion_value,
              clicks::DOUBLE / nullif(impressions::DOUBLE, 0) AS ctr, spend::DOUBLE / nullif(clicks::DOUBLE, 0) AS cpc,
              spend::DOUBLE / nullif(impressions::DOUBLE, 0) * 1000 AS cpm,
              platform_conversion_value::DOUBLE / nullif(spend::DOUBLE, 0) AS platform_roas
            FROM levels""",
    ),
    "order_channels": query(
        _channels,
        f"""SELECT order_id, created_at, o.utm_source, o.utm_medium, coalesce(m.channel, 'Direct / Unattributed') AS channel,
              m.platform, coalesce(m.is_paid = 'true', false) AS is_paid
            FROM ({store.SQL["shopify_orders"]}) o LEFT JOIN (SELECT * FROM {seed_values("channel_mapping")}) m
              ON m.utm_source IS NOT DISTINCT FROM o.utm_source AND m.utm_medium IS NOT DISTINCT FROM o.utm_medium""",
    ),
    "calendar_days": query(
        _calendar(reporting.calendar_days),
        f"""SELECT {day("date_day")} AS date_day, entry_type, name, {day("start_date")} AS start_date, {day("end_date")} AS end_date,
              discount_pct, discount_code, channels FROM ({CALENDAR})""",
    ),
    "calendar_by_day": query(
        _calendar(reporting.calendar_by_day),
        f"""SELECT {day("date_day")} AS date_day, count(*) FILTER (entry_type = 'promotion') AS promotions,
              count(*) FILTER (entry_type = 'event') AS events, count(*) FILTER (entry_type = 'media_change') AS media_changes,
              count(*) FILTER (entry_type = 'media_flight') AS media_flights,
              array_to_string(list_sort(list_distinct(list(name))), '; ') AS entry_names, max(discount_pct) AS discount_pct,
              first(discount_code ORDER BY discount_pct DESC NULLS LAST, discount_code) AS discount_code
            FROM ({CALENDAR}) GROUP BY 1""",
    ),
}
