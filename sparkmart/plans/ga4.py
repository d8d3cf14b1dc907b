"""Staging plans for web analytics events. No shuffle in any of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import functions as fn

# Event parameters kept, as output column -> (key, slot).
EVENT_PARAMS = {
    "ga_session_id": ("ga_session_id", "int"),
    "ga_session_number": ("ga_session_number", "int"),
    "page_location": ("page_location", "string"),
    "page_title": ("page_title", "string"),
    "page_referrer": ("page_referrer", "string"),
    "utm_source": ("source", "string"),
    "utm_medium": ("medium", "string"),
    "utm_campaign": ("campaign", "string"),
    "utm_id": ("campaign_id", "string"),
    "utm_content": ("content", "string"),
    "utm_term": ("term", "string"),
    "gclid": ("gclid", "string"),
    "currency": ("currency", "string"),
    "value": ("value", "double"),
}
# Click ids read from the page URL.
CLICK_IDS = {
    "gbraid": "gbraid",
    "fbclid": "fbclid",
    "ttclid": "ttclid",
    "li_fat_id": "li_fat_id",
    "klaviyo_kx": "_kx",
}


def _event_id(page_location: Column) -> Column:
    return fn.surrogate_key(
        F.col("user_pseudo_id"), F.col("event_timestamp"), F.col("event_name"), page_location
    )


def events(raw: DataFrame) -> DataFrame:
    """One row per event, parameters pivoted into typed columns."""
    c = F.col
    pivoted = raw.withColumns(
        {f"_{k}": v for k, v in fn.pivot_params("event_params", EVENT_PARAMS).items()}
    )
    click, google = (
        f"session_traffic_source_last_click.{part}"
        for part in ("cross_channel_campaign", "google_ads_campaign")
    )
    return pivoted.select(
        _event_id(c("_page_location")).alias("event_id"),
        fn.surrogate_key(c("user_pseudo_id"), c("_ga_session_id")).alias("session_key"),
        "user_pseudo_id",
        c("_ga_session_id").alias("ga_session_id"),
        c("_ga_session_number").alias("ga_session_number"),
        c("user_id").cast("bigint").alias("customer_id"),
        c("ecommerce.transaction_id").cast("bigint").alias("order_id"),
        "event_name",
        fn.day_from_text(c("event_date")).alias("event_date"),
        fn.from_epoch_micros(c("event_timestamp")).alias("event_at"),
        fn.from_epoch_micros(c("user_first_touch_timestamp")).alias("user_first_touch_at"),
        c("_page_location").alias("page_location"),
        fn.without_query_and_fragment(c("_page_location")).alias("page_url"),
        c("_page_title").alias("page_title"),
        c("_page_referrer").alias("page_referrer"),
        F.lower(c("_utm_source")).alias("utm_source"),
        F.lower(c("_utm_medium")).alias("utm_medium"),
        *[
            c(f"_{name}").alias(name)
            for name in ("utm_campaign", "utm_id", "utm_content", "utm_term", "gclid")
        ],
        *[value.alias(name) for name, value in fn.url_params(c("_page_location"), CLICK_IDS).items()],
        c("collected_traffic_source.srsltid").alias("srsltid"),
        c(f"{click}.default_channel_group").alias("ga4_last_click_channel_group"),
        F.lower(c(f"{click}.source")).alias("ga4_last_click_source"),
        F.lower(c(f"{click}.medium")).alias("ga4_last_click_medium"),
        c(f"{click}.campaign_id").alias("ga4_last_click_campaign_id"),
        c(f"{click}.campaign_name").alias("ga4_last_click_campaign_name"),
        c(f"{google}.ad_group_id").alias("ga4_last_click_google_ad_group_id"),
        F.lower(c("traffic_source.source")).alias("first_user_source"),
        F.lower(c("traffic_source.medium")).alias("first_user_medium"),
        c("traffic_source.name").alias("first_user_campaign"),
        c("_currency").alias("currency"),
        fn.money_from_double(c("_value")).alias("event_value"),
        *[
            fn.money_from_double(c(f"ecommerce.{name}")).alias(name)
            for name in ("purchase_revenue", "shipping_value", "tax_value")
        ],
        c("ecommerce.total_item_quantity").alias("total_item_quantity"),
        c("ecommerce.unique_items").alias("unique_items"),
        c("device.category").alias("device_category"),
        c("device.operating_system").alias("operating_system"),
        c("device.operating_system_version").alias("operating_system_version"),
        c("device.web_info.browser").alias("browser"),
        c("device.mobile_brand_name").alias("mobile_brand_name"),
        c("device.language").alias("language"),
        *[c(f"geo.{part}").alias(f"geo_{part}") for part in ("country", "region", "city", "metro")],
        c("privacy_info.ads_storage").alias("ads_storage_consent"),
        "is_active_user",
    )


def event_items(raw: DataFrame) -> DataFrame:
    """One row per item of an event, with its 1-based position."""
    c = F.col
    exploded = raw.select(
        _event_id(fn.param_value("event_params", "page_location")).alias("event_id"),
        "event_name",
        fn.day_from_text(c("event_date")).alias("event_date"),
        fn.from_epoch_micros(c("event_timestamp")).alias("event_at"),
        "user_pseudo_id",
        c("ecommerce.transaction_id").cast("bigint").alias("order_id"),
        F.posexplode("items").alias("position", "item"),
    )
    return exploded.select(
        "event_id",
        (c("position") + 1).cast("bigint").alias("item_index"),
        "event_name",
        "event_date",
        "event_at",
        "user_pseudo_id",
        "order_id",
        c("item.item_id").alias("item_id"),
        fn.id_part(c("item.item_id"), 3).alias("product_id"),
        fn.id_part(c("item.item_id"), 4).alias("variant_id"),
        *[
            c(f"item.{name}").alias(name)
            for name in ("item_name", "item_variant", "item_category", "item_brand", "quantity")
        ],
        fn.money_from_double(c("item.price")).alias("unit_price"),
        fn.money_from_double(c("item.item_revenue")).alias("item_revenue"),
    )
