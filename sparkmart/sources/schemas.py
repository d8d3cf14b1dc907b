"""Declared raw schemas: the columns the jobs read, by system and table.

JSON columns are text here and are parsed by the staging plans. Instants are
timestamps. Columns no plan reads are left out, so no scan fetches them.
"""

from __future__ import annotations

from pyspark.sql.types import StructType

# Names and types of the raw columns.
_PARAM_VALUE = "struct<string_value:string,int_value:bigint,float_value:double,double_value:double>"
_PARAMS = f"array<struct<key:string,value:{_PARAM_VALUE}>>"
_ITEM = (
    "struct<item_id:string,item_name:string,item_variant:string,item_category:string,"
    "item_brand:string,quantity:bigint,price:double,item_revenue:double>"
)
_ECOMMERCE = (
    "struct<transaction_id:string,purchase_revenue:double,shipping_value:double,"
    "tax_value:double,total_item_quantity:bigint,unique_items:bigint>"
)
_DEVICE = (
    "struct<category:string,operating_system:string,operating_system_version:string,"
    "mobile_brand_name:string,language:string,web_info:struct<browser:string>>"
)
_LAST_CLICK = (
    "struct<cross_channel_campaign:struct<default_channel_group:string,source:string,"
    "medium:string,campaign_id:string,campaign_name:string>,"
    "google_ads_campaign:struct<ad_group_id:string>>"
)

RAW_DDL: dict[str, dict[str, str]] = {
    "shopify": {
        "orders": """
            id bigint, name string, order_number bigint, customer string, checkout_id bigint,
            created_at timestamp, processed_at timestamp, updated_at timestamp,
            closed_at timestamp, cancelled_at timestamp, financial_status string,
            fulfillment_status string, cancel_reason string, tags string, test boolean,
            total_line_items_price string, total_discounts string, subtotal_price string,
            total_shipping_price_set string, total_tax string, total_price string,
            current_subtotal_price string, current_total_discounts string,
            current_total_tax string, current_total_price string, total_outstanding string,
            currency string, discount_codes string, discount_applications string,
            landing_site string, referring_site string, client_details string,
            buyer_accepts_marketing boolean, customer_locale string,
            payment_gateway_names string, shipping_lines string, shipping_address string,
            total_weight bigint, line_items string, shop_url string,
            _airbyte_extracted_at timestamp""",
        "order_refunds": """
            id bigint, order_id bigint, created_at timestamp, processed_at timestamp,
            note string, restock boolean, refund_line_items string, transactions string,
            shop_url string, _airbyte_extracted_at timestamp""",
        "customers": """
            id bigint, email string, first_name string, last_name string,
            accepts_marketing boolean, accepts_marketing_updated_at timestamp,
            marketing_opt_in_level string, email_marketing_consent string,
            created_at timestamp, updated_at timestamp, orders_count bigint, state string,
            total_spent string, last_order_id bigint, last_order_name string,
            verified_email boolean, tax_exempt boolean, tags string, currency string,
            addresses string, default_address string, shop_url string,
            _airbyte_extracted_at timestamp""",
        "customer_journey_summary": """
            order_id bigint, created_at timestamp, customer_journey_summary string,
            _airbyte_extracted_at timestamp""",
        "discount_codes": """
            id bigint, price_rule_id bigint, code string, usage_count bigint,
            created_at timestamp, updated_at timestamp, shop_url string,
            _airbyte_extracted_at timestamp""",
        "price_rules": """
            id bigint, title string, value_type string, value string, target_type string,
            target_selection string, allocation_method string, customer_selection string,
            once_per_customer boolean, usage_limit int, starts_at timestamp, ends_at int,
            created_at timestamp, updated_at timestamp, shop_url string,
            _airbyte_extracted_at timestamp""",
        "products": """
            id bigint, handle string, title string, vendor string, product_type string,
            tags string, status string, published_scope string, image string,
            created_at timestamp, published_at timestamp, updated_at timestamp,
            shop_url string, _airbyte_extracted_at timestamp""",
        "product_variants": """
            id bigint, product_id bigint, sku string, barcode string,
            inventory_item_id bigint, title string, option1 string, option2 string,
            position bigint, price string, compare_at_price int, taxable boolean,
            inventory_management string, inventory_policy string, inventory_quantity bigint,
            requires_shipping boolean, grams bigint, weight double, weight_unit string,
            created_at timestamp, updated_at timestamp, shop_url string,
            _airbyte_extracted_at timestamp""",
    },
    "ga4": {
        "events": f"""
            event_date string, event_timestamp bigint, event_name string,
            event_params {_PARAMS}, user_id string, user_pseudo_id string,
            privacy_info struct<ads_storage:string>, user_first_touch_timestamp bigint,
            device {_DEVICE},
            geo struct<country:string,region:string,city:string,metro:string>,
            traffic_source struct<source:string,medium:string,name:string>,
            ecommerce {_ECOMMERCE}, items array<{_ITEM}>,
            collected_traffic_source struct<srsltid:string>, is_active_user boolean,
            session_traffic_source_last_click {_LAST_CLICK}""",
    },
    "facebook_marketing": {
        "ads_insights": """
            ad_id string, adset_id string, campaign_id string, account_id string,
            date_start date, impressions bigint, reach bigint, clicks bigint,
            inline_link_clicks bigint, spend double, actions string, action_values string,
            _airbyte_extracted_at timestamp""",
        "campaigns": """
            id bigint, name string, account_id string, objective string, status string,
            effective_status string, bid_strategy string, daily_budget double,
            smart_promotion_type string, created_time timestamp, start_time timestamp,
            stop_time timestamp, updated_time timestamp, _airbyte_extracted_at timestamp""",
    },
    "google_ads": {
        "campaign": """
            campaign_id bigint, segments_date date, segments_ad_network_type string,
            segments_device string, metrics_impressions bigint, metrics_clicks bigint,
            metrics_conversions double, metrics_conversions_value double,
            metrics_view_through_conversions bigint, metrics_video_views bigint,
            metrics_cost_micros bigint, campaign_name string, customer_id bigint,
            campaign_status string, campaign_serving_status string,
            campaign_advertising_channel_type string,
            campaign_advertising_channel_sub_type string,
            campaign_bidding_strategy_type string, campaign_budget_id bigint,
            campaign_start_date string, campaign_end_date string,
            _airbyte_extracted_at timestamp""",
    },
    "linkedin_ads": {
        "ad_campaign_analytics": """
            start_date date, sponsoredCampaign string, impressions bigint, clicks bigint,
            landingPageClicks bigint, costInUsd double, videoViews bigint,
            externalWebsiteConversions bigint, conversionValueInLocalCurrency double,
            _airbyte_extracted_at timestamp""",
        "campaign_groups": """
            id bigint, name string, account string, status string, totalBudget int,
            runSchedule string, test boolean, created timestamp, lastModified timestamp,
            _airbyte_extracted_at timestamp""",
        "campaigns": """
            id bigint, name string, account string, campaignGroup string, status string,
            type string, costType string, objectiveType string, format string,
            dailyBudget string, optimizationTargetType string,
            offsiteDeliveryEnabled boolean, audienceExpansionEnabled boolean,
            runSchedule string, created timestamp, lastModified timestamp,
            _airbyte_extracted_at timestamp""",
    },
    "tiktok_marketing": {
        "campaigns": """
            campaign_id bigint, campaign_name string, advertiser_id bigint,
            objective_type string, campaign_type string, budget_mode string, budget double,
            operation_status string, secondary_status string,
            is_smart_performance_campaign boolean, is_search_campaign boolean,
            create_time timestamp, modify_time timestamp, _airbyte_extracted_at timestamp""",
        "campaigns_reports_daily": """
            advertiser_id bigint, campaign_id bigint, stat_time_day string,
            dimensions string, metrics string,
            _airbyte_extracted_at timestamp""",
    },
    "manual": {
        "marketing_calendar": (
            "entry_type string, name string, start_date date, end_date date, discount_pct double, "
            "discount_code string, channels string, notes string"
        ),
    },
}

SEED_DDL: dict[str, str] = {
    "channel_mapping": (
        "utm_source string, utm_medium string, channel string, platform string, is_paid boolean"
    ),
    "campaign_attributes": (
        "platform string, campaign_id string, campaign_name string, channel string, "
        "campaign_tactic string, initiative_name string"
    ),
    "discount_code_types": "discount_code string, code_type string",
}


def raw_schema(system: str, table: str) -> StructType:
    return StructType.fromDDL(RAW_DDL[system][table])
