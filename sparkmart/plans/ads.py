"""Staging plans for the four ad platforms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import functions as fn
from ..operators.latest import latest_per_key

# Fixed values. Purchases are listed under several action types with the same
# totals; only this one is counted.
PURCHASE_ACTION = "omni_purchase"
NO_END_DATE = "2037-12-30"

_ACTION = "action_type:string,value:string"
_SCHEDULE = "start:string,end:string"


def _is_purchase(action):
    return action["action_type"] == PURCHASE_ACTION


def meta_ad_stats_daily(raw: DataFrame) -> DataFrame:
    """One row per ad and day."""
    c = F.col
    return raw.select(
        "ad_id",
        "adset_id",
        "campaign_id",
        "account_id",
        c("date_start").alias("date_day"),
        "impressions",
        "reach",
        "clicks",
        c("inline_link_clicks").alias("link_clicks"),
        fn.money_from_double(c("spend"), 14).alias("spend"),
        fn.sum_items(
            fn.parse_objects(c("actions"), _ACTION),
            lambda a: a["value"].cast("double"),
            "double",
            where=_is_purchase,
        ).alias("platform_conversions"),
        fn.sum_items(
            fn.parse_objects(c("action_values"), _ACTION),
            lambda a: fn.money(a["value"], 14),
            "decimal(38,2)",
            where=_is_purchase,
        ).alias("platform_conversion_value"),
        "_airbyte_extracted_at",
    )


def meta_campaigns(raw: DataFrame) -> DataFrame:
    """One row per campaign; the budget is stored in cents."""
    return raw.select(
        F.col("id").alias("campaign_id"),
        F.col("name").alias("campaign_name"),
        "account_id",
        "objective",
        F.col("status").alias("campaign_status"),
        "effective_status",
        "bid_strategy",
        "smart_promotion_type",
        fn.from_cents(F.col("daily_budget")).alias("daily_budget"),
        F.col("start_time").alias("started_at"),
        F.col("stop_time").alias("stopped_at"),
        F.col("created_time").alias("created_at"),
        F.col("updated_time").alias("updated_at"),
        "_airbyte_extracted_at",
    )


def google_campaigns(raw: DataFrame) -> DataFrame:
    """One row per campaign: attributes of its latest report row."""
    c = F.col
    attributes = raw.select(
        "campaign_id",
        "campaign_name",
        c("customer_id").alias("account_id"),
        "campaign_status",
        c("campaign_serving_status").alias("serving_status"),
        c("campaign_advertising_channel_type").alias("advertising_channel_type"),
        c("campaign_advertising_channel_sub_type").alias("advertising_channel_sub_type"),
        c("campaign_bidding_strategy_type").alias("bidding_strategy_type"),
        "campaign_budget_id",
        "campaign_start_date",
        "campaign_end_date",
        "segments_date",
        "_airbyte_extracted_at",
    )
    latest = latest_per_key(
        attributes, ["campaign_id"], [c("segments_date").desc(), c("_airbyte_extracted_at").desc()]
    )
    return latest.select(
        *[name for name in attributes.columns if name not in
          ("campaign_start_date", "campaign_end_date", "segments_date", "_airbyte_extracted_at")],
        c("campaign_start_date").cast("date").alias("start_date"),
        F.nullif(c("campaign_end_date"), F.lit(NO_END_DATE)).cast("date").alias("end_date"),
        "_airbyte_extracted_at",
    )


def google_campaign_stats_daily(raw: DataFrame) -> DataFrame:
    """One row per campaign, day, network and device; cost is in micros."""
    c = F.col
    return raw.select(
        "campaign_id",
        c("customer_id").alias("account_id"),
        c("segments_date").alias("date_day"),
        c("segments_ad_network_type").alias("ad_network_type"),
        c("segments_device").alias("device"),
        c("metrics_impressions").alias("impressions"),
        c("metrics_clicks").alias("clicks"),
        fn.money_from_double(fn.from_micros(c("metrics_cost_micros")), 14).alias("spend"),
        c("metrics_video_views").alias("video_views"),
        c("metrics_conversions").alias("platform_conversions"),
        fn.money_from_double(c("metrics_conversions_value"), 14).alias(
            "platform_conversion_value"
        ),
        c("metrics_view_through_conversions").alias("view_through_conversions"),
        "_airbyte_extracted_at",
    )


def linkedin_campaigns(raw: DataFrame) -> DataFrame:
    """One row per campaign; ids are URNs and the schedule is epoch millis."""
    c = F.col
    parsed = raw.withColumns(
        {
            "_budget": fn.parse_object(c("dailyBudget"), "amount:string,currencyCode:string"),
            "_schedule": fn.parse_object(c("runSchedule"), _SCHEDULE),
        }
    )
    return parsed.select(
        c("id").alias("campaign_id"),
        c("name").alias("campaign_name"),
        fn.urn_id(c("account")).alias("account_id"),
        fn.urn_id(c("campaignGroup")).alias("campaign_group_id"),
        c("objectiveType").alias("objective"),
        c("status").alias("campaign_status"),
        c("type").alias("campaign_type"),
        c("costType").alias("cost_type"),
        c("format").alias("ad_format"),
        c("optimizationTargetType").alias("optimization_target_type"),
        fn.money(c("_budget.amount")).alias("daily_budget"),
        c("_budget.currencyCode").alias("daily_budget_currency"),
        c("offsiteDeliveryEnabled").alias("is_offsite_delivery_enabled"),
        c("audienceExpansionEnabled").alias("is_audience_expansion_enabled"),
        fn.from_epoch_millis(c("_schedule.start")).alias("started_at"),
        fn.from_epoch_millis(c("_schedule.end")).alias("stopped_at"),
        c("created").alias("created_at"),
        c("lastModified").alias("updated_at"),
        "_airbyte_extracted_at",
    )


def linkedin_campaign_groups(raw: DataFrame) -> DataFrame:
    """One row per campaign group."""
    c = F.col
    parsed = raw.withColumn("_schedule", fn.parse_object(c("runSchedule"), _SCHEDULE))
    return parsed.select(
        c("id").alias("campaign_group_id"),
        c("name").alias("campaign_group_name"),
        fn.urn_id(c("account")).alias("account_id"),
        c("status").alias("campaign_group_status"),
        c("totalBudget").alias("total_budget"),
        c("test").alias("is_test"),
        fn.from_epoch_millis(c("_schedule.start")).alias("started_at"),
        fn.from_epoch_millis(c("_schedule.end")).alias("stopped_at"),
        c("created").alias("created_at"),
        c("lastModified").alias("updated_at"),
        "_airbyte_extracted_at",
    )


def linkedin_campaign_stats_daily(raw: DataFrame) -> DataFrame:
    """One row per campaign and day."""
    c = F.col
    return raw.select(
        fn.urn_id(c("sponsoredCampaign")).alias("campaign_id"),
        c("start_date").alias("date_day"),
        "impressions",
        "clicks",
        c("landingPageClicks").alias("landing_page_clicks"),
        fn.money_from_double(c("costInUsd"), 14).alias("spend"),
        c("videoViews").alias("video_views"),
        c("externalWebsiteConversions").alias("platform_conversions"),
        fn.money_from_double(c("conversionValueInLocalCurrency"), 14).alias(
            "platform_conversion_value"
        ),
        "_airbyte_extracted_at",
    )


def tiktok_campaigns(raw: DataFrame) -> DataFrame:
    """One row per campaign."""
    return raw.select(
        "campaign_id",
        "campaign_name",
        F.col("advertiser_id").alias("account_id"),
        F.col("objective_type").alias("objective"),
        "campaign_type",
        F.col("operation_status").alias("campaign_status"),
        "secondary_status",
        "budget_mode",
        "budget",
        "is_smart_performance_campaign",
        "is_search_campaign",
        F.col("create_time").alias("created_at"),
        F.col("modify_time").alias("updated_at"),
        "_airbyte_extracted_at",
    )


def tiktok_campaign_stats_daily(raw: DataFrame) -> DataFrame:
    """One row per campaign and day.

    The day is the account's local day, held as text in the dimensions; the
    timestamp column is the same midnight in UTC and could shift the date.
    """
    c = F.col
    metrics = ("impressions", "clicks", "reach", "spend", "complete_payment",
               "total_complete_payment_rate")
    parsed = raw.withColumns(
        {
            "_dim": fn.parse_object(c("dimensions"), "stat_time_day:string"),
            "_m": fn.parse_object(c("metrics"), ",".join(f"{m}:string" for m in metrics)),
        }
    )
    return parsed.select(
        "campaign_id",
        c("advertiser_id").alias("account_id"),
        c("_dim.stat_time_day").cast("date").alias("date_day"),
        *[c(f"_m.{m}").cast("bigint").alias(m) for m in ("impressions", "clicks", "reach")],
        fn.money(c("_m.spend"), 14).alias("spend"),
        c("_m.complete_payment").cast("double").alias("platform_conversions"),
        fn.money(c("_m.total_complete_payment_rate"), 14).alias("platform_conversion_value"),
        "_airbyte_extracted_at",
    )
