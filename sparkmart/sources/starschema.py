"""Raw tables of the declared shape, projected from a TPC-H-like star schema.

Used to run every plan on whole tables at any scale. Each raw table is a row by
row projection of one star-schema table (JSON is built from the row's own
columns), so it grows with that table and needs no shuffle. The order priority
(1 to 5) and status pick the edge cases: missing JSON keys, empty arrays, broken
escapes, tags, refunds.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scan import RawTables

TIKTOK_BASE = 1730000000000000000

_P = "cast(substr(o_orderpriority, 1, 1) as int)"
_PRICE = "cast(o_totalprice as decimal(12,2))"
_DISCOUNT = "cast(cast(o_custkey as decimal(12,2)) / 100 as decimal(12,2))"


def star(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shopify_orders(orders: DataFrame) -> DataFrame:
    base = orders.selectExpr(
        "*",
        f"{_P} as p",
        f"{_PRICE} as price",
        f"{_DISCOUNT} as discount",
        "cast(o_orderdate as timestamp) as at",
    )
    return base.selectExpr(
        "o_orderkey as id",
        "concat('#', o_orderkey) as name",
        "o_orderkey + 1000 as order_number",
        "to_json(named_struct('id', o_custkey, 'note', 'x')) as customer",
        "o_orderkey * 10 + p as checkout_id",
        "at as created_at",
        "at + interval 5 minutes as processed_at",
        "at + interval 1 day as updated_at",
        "case when o_orderstatus = 'F' then at + interval 2 days end as closed_at",
        "case when p = 5 and o_orderstatus = 'P' then at + interval 3 hours end as cancelled_at",
        "case o_orderstatus when 'F' then 'paid' when 'O' then 'pending' else 'refunded' end"
        " as financial_status",
        "case when o_orderstatus = 'F' then 'fulfilled' end as fulfillment_status",
        "case when p = 5 and o_orderstatus = 'P' then 'customer' end as cancel_reason",
        "case p when 1 then 'vip, test' when 2 then 'wholesale-team-order' when 3 then 'contest'"
        " when 5 then ' test ,x' end as tags",
        "case when o_orderstatus = 'O' then p = 2 when o_orderstatus = 'F' then false end as test",
        "cast(price as string) as total_line_items_price",
        "cast(discount as string) as total_discounts",
        "cast(price - discount as string) as subtotal_price",
        "to_json(named_struct('shop_money', named_struct('amount', concat(p, '.50'))))"
        " as total_shipping_price_set",
        "concat(o_custkey, '.07') as total_tax",
        "cast(price as string) as total_price",
        "cast(price - discount as string) as current_subtotal_price",
        "cast(discount as string) as current_total_discounts",
        "concat(o_custkey, '.07') as current_total_tax",
        "cast(price as string) as current_total_price",
        "'0.00' as total_outstanding",
        "'USD' as currency",
        "case p when 1 then '[{\"code\":\"WELCOME10\",\"amount\":\"1.0\"}]'"
        " when 3 then '[{\"code\":\"BFCM30\"}]'"
        " when 5 then concat('[{\"code\":\"CODE', o_custkey, '\"}]') when 2 then '[]' end"
        " as discount_codes",
        "case when p in (1, 3, 5) then '[{\"type\":\"discount_code\",\"value\":\"1\"}]'"
        " when p = 2 then '[{\"type\":\"automatic\",\"title\":\"x\"}]' else '[]' end"
        " as discount_applications",
        "case p when 1 then concat('/products/', o_orderkey,"
        " '?utm_source=Google&utm_medium=CPC&utm_campaign=Spring%20Sale+', o_orderstatus,"
        " '&utm_id=', o_custkey, '&gclid=g', o_orderkey, '#top')"
        " when 2 then concat('/?UTM_SOURCE=fb&utm_medium=paid%20social&fbclid=f', o_orderkey,"
        " '&utm_term=&utm_content=a%2Bb')"
        " when 3 then '/collections/all'"
        " when 5 then concat('/x?ttclid=t', o_orderkey, '&gbraid=b&li_fat_id=l&_kx=k&srsltid=s',"
        " '&utm_source=100%zz%41') end as landing_site",
        "case p when 1 then 'https://www.google.com/search?q=1' when 2 then 'http://l.facebook.com'"
        " when 3 then 'android-app://x' end as referring_site",
        "case p when 1 then '{\"user_agent\":\"Mozilla (iPad; Mobile)\"}'"
        " when 2 then '{\"user_agent\":\"Android 14 Mobile Tablet\"}'"
        " when 3 then '{\"user_agent\":\"iPhone MOBILE\",\"w\":1}'"
        " when 4 then '{\"user_agent\":null}'"
        " else '{\"user_agent\":\"Windows NT\"}' end as client_details",
        "o_orderstatus = 'F' as buyer_accepts_marketing",
        "'en-US' as customer_locale",
        "case when p < 4 then '[\"card\",\"gift\"]' else '[]' end as payment_gateway_names",
        "case when p < 3 then '[{\"code\":\"Standard\"}]' else '[]' end as shipping_lines",
        "case when p <> 4 then to_json(named_struct('city', concat('City ', o_custkey),"
        " 'province_code', o_orderstatus, 'country_code', 'US', 'zip',"
        " lpad(cast(o_custkey as string), 7, '0'))) end as shipping_address",
        "o_custkey * 10 as total_weight",
        "to_json(transform(slice(array(1, 2, 3, 4), 1, p - 1), n -> named_struct("
        "'id', o_orderkey * 10 + n, 'product_id', o_custkey + n, 'variant_id', o_custkey,"
        " 'sku', concat('SKU-', n), 'title', concat('Title ', o_custkey), 'variant_title', null,"
        " 'vendor', 'v', 'quantity', n, 'price', concat(o_custkey, '.25'),"
        " 'gift_card', n = 4, 'requires_shipping', n <> 4,"
        " 'fulfillment_status', if(o_orderstatus = 'F', 'fulfilled', null),"
        " 'discount_allocations', if(n in (1, 3),"
        "   array(named_struct('amount', '1.10'), named_struct('amount', concat('0.', n, '5'))),"
        "   array()),"
        " 'tax_lines', array(named_struct('price', concat(n, '.05')))))) as line_items",
        "'shop' as shop_url",
        "at + interval 2 days as _airbyte_extracted_at",
    )


def shopify_order_refunds(orders: DataFrame) -> DataFrame:
    """Refunds of the orders with status P: one, or two for priorities 4 and 5."""
    base = orders.where("o_orderstatus = 'P'").selectExpr(
        "*",
        f"{_P} as p",
        "cast(o_orderdate as timestamp) as at",
        f"explode(sequence(1, if({_P} >= 4, 2, 1))) as k",
    )
    return base.selectExpr(
        "o_orderkey * 10 + k as id",
        "o_orderkey as order_id",
        "at + make_interval(0, 0, 0, 5 * k, 23) as created_at",
        "at + make_interval(0, 0, 0, 5 * k, 24) as processed_at",
        "case p when 1 then null when 2 then 'Return - ' when 3 then 'Return-Too small'"
        " when 4 then 'Damaged, Return - no' else concat('Return -  Reason ', k) end as note",
        "k = 1 as restock",
        "to_json(transform(slice(array(1, 2, 3, 4), 1, if(k = 1, p - 1, 1)), n -> named_struct("
        "'id', (o_orderkey * 10 + k) * 10 + n, 'line_item_id', o_orderkey * 10 + n,"
        " 'quantity', if(p <= 3, n, 1), 'subtotal', concat(n, '.15'), 'total_tax', '0.35',"
        " 'restock_type', if(k = 1, 'return', null), 'location_id', o_custkey)))"
        " as refund_line_items",
        "case when p = 1 then '[]' else concat("
        "'[{\"kind\":\"refund\",\"status\":\"success\",\"amount\":\"', o_custkey, '.40\",',"
        " '\"gateway\":\"card\"},',"
        " '{\"kind\":\"refund\",\"status\":\"failure\",\"amount\":\"9.99\"},',"
        " '{\"kind\":\"sale\",\"status\":\"success\",\"amount\":\"5.00\"},',"
        " '{\"kind\":\"refund\",\"status\":\"success\",\"amount\":\"0.05\"}]') end"
        " as transactions",
        "'shop' as shop_url",
        "at + make_interval(0, 0, 0, 5 * k + 1) as _airbyte_extracted_at",
    )


def shopify_customers(customer: DataFrame) -> DataFrame:
    address = (
        "'address1', concat(c_custkey, ' Main'), 'city', concat('City ', c_nationkey),"
        " 'province', null, 'province_code', 'PC', 'country', 'Land', 'country_code', 'LL',"
        " 'zip', concat('0', c_custkey)"
    )
    stamp = "timestamp'2024-05-01 10:00:00'"
    return customer.selectExpr(
        "c_custkey as id",
        "concat('c', c_custkey, '@example.com') as email",
        "split_part(c_name, '#', 1) as first_name",
        "if(c_mktsegment = 'FURNITURE', null, split_part(c_name, '#', 2)) as last_name",
        "c_mktsegment = 'MACHINERY' as accepts_marketing",
        f"if(c_mktsegment = 'MACHINERY', {stamp}, null) as accepts_marketing_updated_at",
        "'single_opt_in' as marketing_opt_in_level",
        "case c_mktsegment when 'HOUSEHOLD' then null"
        " when 'MACHINERY' then '{\"state\":\"subscribed\",\"opt_in_level\":\"single_opt_in\","
        "\"consent_updated_at\":\"2024-02-29T23:30:00-05:00\"}'"
        " when 'FURNITURE' then '{\"opt_in_level\":null}'"
        " else '{\"state\":\"unsubscribed\"}' end as email_marketing_consent",
        f"{stamp} as created_at",
        f"{stamp} + interval 1 day as updated_at",
        "c_custkey as orders_count",
        "'enabled' as state",
        "cast(cast(c_acctbal as decimal(12,2)) as string) as total_spent",
        "c_custkey * 2 as last_order_id",
        "concat('#', c_custkey * 2) as last_order_name",
        "true as verified_email",
        "false as tax_exempt",
        "lower(c_mktsegment) as tags",
        "'USD' as currency",
        "case when c_mktsegment = 'BUILDING' then null when c_mktsegment = 'HOUSEHOLD' then '[]'"
        " else to_json(transform(if(c_mktsegment = 'AUTOMOBILE', array(1), array(1, 2)), n ->"
        f" named_struct('id', c_custkey * 10 + n, {address}, 'default', n = 1))) end as addresses",
        "case when c_mktsegment not in ('BUILDING', 'HOUSEHOLD') then"
        f" to_json(named_struct('id', c_custkey * 10 + 1, {address}, 'default', true)) end"
        " as default_address",
        "'shop' as shop_url",
        f"{stamp} as _airbyte_extracted_at",
    )


def shopify_journeys(orders: DataFrame) -> DataFrame:
    visit = (
        "named_struct('occurredAt', '2024-03-10T01:30:00Z', 'source', 'direct',"
        " 'sourceType', null, 'landingPage', concat('https://shop.example.com/', o_orderkey),"
        " 'referrerUrl', '', 'utmParameters', if({p} = 1, named_struct('source', 'Google',"
        " 'medium', 'CPC', 'campaign', concat('c', o_custkey), 'content', null, 'term', 'T'),"
        " null))"
    )
    return orders.selectExpr(
        "o_orderkey as order_id",
        "cast(o_orderdate as timestamp) as created_at",
        f"if({_P} = 5, 'null', to_json(named_struct('customerOrderIndex', {_P},"
        " 'daysToConversion', o_custkey, 'momentsCount', cast(o_custkey as string),"
        f" 'firstVisit', if({_P} = 4, null, {visit.format(p=_P)}),"
        f" 'lastVisit', {visit.format(p=_P)}))) as customer_journey_summary",
        "cast(o_orderdate as timestamp) as _airbyte_extracted_at",
    )


def shopify_discount_codes(part: DataFrame) -> DataFrame:
    stamp = "timestamp'2024-05-01 10:00:00'"
    return part.selectExpr(
        "p_partkey as id",
        "if(p_size = 50, -1, p_partkey) as price_rule_id",
        "case p_partkey when 1 then 'WELCOME10' when 3 then 'BFCM30'"
        " else concat('CODE', p_partkey) end as code",
        "cast(p_size as bigint) as usage_count",
        f"{stamp} as created_at",
        f"{stamp} as updated_at",
        "'shop' as shop_url",
        f"{stamp} as _airbyte_extracted_at",
    )


def shopify_price_rules(part: DataFrame) -> DataFrame:
    stamp = "timestamp'2024-05-01 10:00:00'"
    return part.selectExpr(
        "p_partkey as id",
        "p_name as title",
        "if(p_type in ('PROMO', 'SMALL'), 'fixed_amount', 'percentage') as value_type",
        "concat('-', p_size, '.5') as value",
        "'line_item' as target_type",
        "'all' as target_selection",
        "'across' as allocation_method",
        "'all' as customer_selection",
        "p_size > 25 as once_per_customer",
        "p_size as usage_limit",
        f"{stamp} as starts_at",
        "cast(null as int) as ends_at",
        f"{stamp} as created_at",
        f"{stamp} as updated_at",
        "'shop' as shop_url",
        f"{stamp} as _airbyte_extracted_at",
    )


def shopify_products(part: DataFrame) -> DataFrame:
    stamp = "timestamp'2024-05-01 10:00:00'"
    return part.selectExpr(
        "p_partkey as id",
        "concat('handle-', p_partkey) as handle",
        "p_name as title",
        "p_brand as vendor",
        "case p_type when 'PROMO' then 'Gift Card' when 'SMALL' then null else p_type end"
        " as product_type",
        "case p_type when 'PROMO' then 'Gift Card' when 'SMALL' then null"
        " else concat(p_type, ', ', split_part(p_name, ' ', 1), ', core ') end as tags",
        "'active' as status",
        "'web' as published_scope",
        "case when p_type <> 'PROMO' then concat('{\"src\":\"https://cdn.example.com/', p_partkey,"
        " '.png\"}') end as image",
        f"{stamp} as created_at",
        f"{stamp} as published_at",
        f"{stamp} as updated_at",
        "'shop' as shop_url",
        f"{stamp} as _airbyte_extracted_at",
    )


def shopify_variants(part: DataFrame) -> DataFrame:
    stamp = "timestamp'2024-05-01 10:00:00'"
    return part.selectExpr(
        "p_partkey as id",
        "p_partkey as product_id",
        "concat('SKU-', p_partkey) as sku",
        "cast(null as string) as barcode",
        "p_partkey * 7 as inventory_item_id",
        "p_name as title",
        "if(p_type = 'PROMO', 'Default', split_part(p_name, ' ', 1)) as option1",
        "cast(p_size as string) as option2",
        "1L as position",
        "cast(cast(p_retailprice as decimal(12,2)) as string) as price",
        "if(p_size > 40, p_size, null) as compare_at_price",
        "true as taxable",
        "if(p_size > 25, 'shopify', null) as inventory_management",
        "'deny' as inventory_policy",
        "cast(p_size as bigint) as inventory_quantity",
        "p_type <> 'PROMO' as requires_shipping",
        "cast(p_size as bigint) * 100 as grams",
        "cast(p_size as double) / 4 as weight",
        "'kg' as weight_unit",
        f"{stamp} as created_at",
        f"{stamp} as updated_at",
        "'shop' as shop_url",
        f"{stamp} as _airbyte_extracted_at",
    )


_EVENT_K = "cast(get_json_object(props, '$.k') as bigint)"


def ga4_events(events: DataFrame) -> DataFrame:
    def text(key: str, value: str) -> str:
        return (
            f"named_struct('key', '{key}', 'value', named_struct('string_value', {value},"
            " 'int_value', cast(null as bigint), 'float_value', cast(null as double),"
            " 'double_value', cast(null as double)))"
        )

    def number(key: str, value: str) -> str:
        return (
            f"named_struct('key', '{key}', 'value', named_struct('string_value',"
            f" cast(null as string), 'int_value', {value}, 'float_value', cast(null as double),"
            " 'double_value', cast(null as double)))"
        )

    value = (
        "named_struct('key', 'value', 'value', named_struct('string_value', cast(null as string),"
        " 'int_value', cast(null as bigint), 'float_value', cast(null as double),"
        " 'double_value', value))"
    )
    page = (
        "concat('https://shop.example.com/p/', k, '?fbclid=F', event_id, '&_kx=a%20b+c',"
        " '&GBRAID=', event_type, '#frag')"
    )
    always = ", ".join(
        [
            text("page_location", page),
            number("ga_session_id", "user_id * 100 + k"),
            number("ga_session_number", "k"),
            text("page_title", "concat('Title ', k)"),
            text("page_title", "'second entry, ignored'"),
        ]
    )
    landing = ", ".join(
        [
            text("source", "'Google'"),
            text("medium", "'CPC'"),
            text("campaign", "concat('camp ', user_id)"),
            text("campaign_id", "cast(user_id as string)"),
            text("currency", "'USD'"),
            value,
        ]
    )
    base = events.selectExpr("*", f"{_EVENT_K} as k", "cast(ts as timestamp) as at")
    item = (
        "named_struct('item_id', concat('shopify_US_', user_id, '_', k + n), 'item_name',"
        " concat('Item ', n), 'item_variant', if(n = 2, null, 'Red'), 'item_category', 'cat',"
        " 'item_brand', 'brand', 'quantity', cast(n as bigint), 'price', value + 0.005,"
        " 'item_revenue', if(event_type = 'purchase', value * n, null))"
    )
    return base.selectExpr(
        "date_format(at, 'yyyyMMdd') as event_date",
        "unix_micros(at) as event_timestamp",
        "event_type as event_name",
        f"if(event_type in ('view', 'purchase'), array({always}, {landing}), array({always}))"
        " as event_params",
        "if(event_type = 'signup', null, cast(user_id as string)) as user_id",
        "concat('user.', user_id) as user_pseudo_id",
        "named_struct('ads_storage', 'Yes') as privacy_info",
        "unix_micros(at) - 1000001 as user_first_touch_timestamp",
        "named_struct('category', 'mobile', 'operating_system', 'Android',"
        " 'operating_system_version', '14', 'mobile_brand_name', 'Brand', 'language', 'en-us',"
        " 'web_info', named_struct('browser', concat('Browser ', k))) as device",
        "named_struct('country', 'US', 'region', 'NY', 'city', concat('C', user_id),"
        " 'metro', cast(null as string)) as geo",
        "if(event_type = 'error', null, named_struct('source', 'Direct', 'medium', '(NONE)',"
        " 'name', '(direct)')) as traffic_source",
        "if(event_type = 'purchase', named_struct('transaction_id', cast(event_id as string),"
        " 'purchase_revenue', value, 'shipping_value', 4.995D, 'tax_value', value / 8,"
        " 'total_item_quantity', 3L, 'unique_items', 2L), null) as ecommerce",
        f"case when event_type = 'purchase' then transform(array(1, 2), n -> {item})"
        f" when event_type = 'view' then transform(array(1), n -> {item})"
        " when event_type = 'click' then array() end as items",
        "named_struct('srsltid', if(event_type = 'click', 'S', null)) as collected_traffic_source",
        "k > 50 as is_active_user",
        "named_struct('cross_channel_campaign', named_struct('default_channel_group', 'Paid',"
        " 'source', 'GOOGLE', 'medium', 'Cpc', 'campaign_id', cast(k as string),"
        " 'campaign_name', 'n'), 'google_ads_campaign', named_struct('ad_group_id', 'g'))"
        " as session_traffic_source_last_click",
    )


def meta_ads_insights(events: DataFrame) -> DataFrame:
    return events.selectExpr(
        "*", f"{_EVENT_K} as k", "cast(ts as timestamp) as at"
    ).selectExpr(
        "cast(event_id as string) as ad_id",
        "concat('set', user_id) as adset_id",
        "cast(user_id as string) as campaign_id",
        "'act1' as account_id",
        "cast(at as date) as date_start",
        "k * 100 as impressions",
        "k * 50 as reach",
        "k * 3 as clicks",
        "k * 2 as inline_link_clicks",
        "value + 0.005 as spend",
        "case event_type when 'purchase' then concat('[{\"action_type\":\"purchase\",\"value\":\"',"
        " k, '\"},{\"action_type\":\"omni_purchase\",\"value\":\"', k,"
        " '\",\"7d_click\":\"1\"},{\"action_type\":\"omni_purchase\",\"value\":\"0.5\"}]')"
        " when 'view' then '[]' end as actions",
        "case event_type when 'purchase' then concat('[{\"action_type\":\"omni_purchase\",',"
        " '\"value\":', k, '.25}]') end as action_values",
        "at as _airbyte_extracted_at",
    )


def meta_campaigns(customer: DataFrame) -> DataFrame:
    stamp = "timestamp'2024-05-01 10:00:00'"
    return customer.selectExpr(
        "c_custkey as id",
        "concat('PROS | ', c_name) as name",
        "concat('act', c_nationkey) as account_id",
        "c_mktsegment as objective",
        "case c_mktsegment when 'MACHINERY' then 'PAUSED' when 'BUILDING' then 'ARCHIVED'"
        " when 'HOUSEHOLD' then 'IN_PROCESS' when 'FURNITURE' then null else 'active' end as status",
        "'ACTIVE' as effective_status",
        "'LOWEST_COST' as bid_strategy",
        "if(c_acctbal < 0, null, cast(c_custkey as double)) as daily_budget",
        "'x' as smart_promotion_type",
        f"{stamp} as created_time",
        f"{stamp} as start_time",
        "cast(null as timestamp) as stop_time",
        f"{stamp} as updated_time",
        f"{stamp} as _airbyte_extracted_at",
    )


def google_report(lineitem: DataFrame) -> DataFrame:
    return lineitem.selectExpr(
        "l_suppkey as campaign_id",
        "cast(l_shipdate as date) as segments_date",
        "l_returnflag as segments_ad_network_type",
        "l_linestatus as segments_device",
        "l_orderkey as metrics_impressions",
        "cast(l_quantity as bigint) as metrics_clicks",
        "l_quantity as metrics_conversions",
        "l_extendedprice as metrics_conversions_value",
        "1L as metrics_view_through_conversions",
        "2L as metrics_video_views",
        "cast(round(l_extendedprice * 100) as bigint) * 10000 + cast(l_quantity as bigint) * 1000"
        " as metrics_cost_micros",
        "concat('Search | ', l_orderkey, ' | ', l_linenumber) as campaign_name",
        "l_suppkey * 3 as customer_id",
        "case l_linenumber when 1 then 'REMOVED' when 2 then 'PAUSED' else 'ENABLED' end"
        " as campaign_status",
        "'SERVING' as campaign_serving_status",
        "'SEARCH' as campaign_advertising_channel_type",
        "cast(null as string) as campaign_advertising_channel_sub_type",
        "'MAX' as campaign_bidding_strategy_type",
        "l_orderkey as campaign_budget_id",
        "'2024-01-31' as campaign_start_date",
        "if(l_linenumber < 4, '2037-12-30', '2025-06-30') as campaign_end_date",
        # Equal stamps only for rows equal in every attribute above.
        "cast(l_shipdate as timestamp)"
        " + make_dt_interval(0, 0, 0, l_orderkey + cast(l_linenumber as decimal(6,3)) / 10)"
        " as _airbyte_extracted_at",
    )


# Two rows take the ids of campaigns in the seed, so its join also finds partners.
_LINKEDIN_ID = "case {k} when 1 then 388013719 when 2 then 396428322 else {k} end"


def linkedin_campaigns(customer: DataFrame) -> DataFrame:
    stamp = "timestamp'2024-05-01 10:00:00'"
    return customer.selectExpr(
        f"{_LINKEDIN_ID.format(k='c_custkey')} as id",
        "concat('LI | ', c_name) as name",
        "concat('urn:li:sponsoredAccount:', c_nationkey) as account",
        "concat('urn:li:sponsoredCampaignGroup:', c_nationkey) as campaignGroup",
        "if(c_mktsegment = 'MACHINERY', 'paused', 'ACTIVE') as status",
        "'SPONSORED_UPDATES' as type",
        "'CPM' as costType",
        "c_mktsegment as objectiveType",
        "'STANDARD' as format",
        "case when c_acctbal < 0 then '{}' else concat('{\"amount\":\"', c_custkey,"
        " '.5\",\"currencyCode\":\"USD\"}') end as dailyBudget",
        "'NONE' as optimizationTargetType",
        "true as offsiteDeliveryEnabled",
        "false as audienceExpansionEnabled",
        "concat('{\"start\":', 1700000000123 + c_custkey, '}') as runSchedule",
        f"{stamp} as created",
        f"{stamp} as lastModified",
        f"{stamp} as _airbyte_extracted_at",
    )


def linkedin_groups(nation: DataFrame) -> DataFrame:
    stamp = "timestamp'2024-05-01 10:00:00'"
    return nation.selectExpr(
        "cast(n_nationkey as bigint) as id",
        "n_name as name",
        "concat('urn:li:sponsoredAccount:', n_regionkey) as account",
        "'ACTIVE' as status",
        "cast(null as int) as totalBudget",
        "concat('{\"start\":1700000000000,\"end\":\"', 1700000000000 + n_nationkey * 1000, '\"}')"
        " as runSchedule",
        "n_regionkey = 0 as test",
        f"{stamp} as created",
        f"{stamp} as lastModified",
        f"{stamp} as _airbyte_extracted_at",
    )


def linkedin_analytics(orders: DataFrame) -> DataFrame:
    return orders.selectExpr(
        "cast(o_orderdate as date) as start_date",
        f"concat('urn:li:sponsoredCampaign:', {_LINKEDIN_ID.format(k='o_custkey')})"
        " as sponsoredCampaign",
        "o_orderkey as impressions",
        "o_custkey as clicks",
        f"cast({_P} as bigint) as landingPageClicks",
        "o_totalprice as costInUsd",
        "0L as videoViews",
        f"cast({_P} as bigint) as externalWebsiteConversions",
        "o_totalprice / 8 as conversionValueInLocalCurrency",
        "cast(o_orderdate as timestamp) as _airbyte_extracted_at",
    )


def tiktok_campaigns(customer: DataFrame) -> DataFrame:
    stamp = "timestamp'2024-05-01 10:00:00'"
    return customer.selectExpr(
        f"{TIKTOK_BASE} + c_custkey as campaign_id",
        "concat('TT | ', c_name) as campaign_name",
        "cast(c_nationkey as bigint) as advertiser_id",
        "c_mktsegment as objective_type",
        "'REGULAR' as campaign_type",
        "'DAY' as budget_mode",
        "c_acctbal as budget",
        "if(c_mktsegment = 'MACHINERY', 'DISABLE', 'ENABLE') as operation_status",
        "'s' as secondary_status",
        "true as is_smart_performance_campaign",
        "false as is_search_campaign",
        f"{stamp} as create_time",
        f"{stamp} as modify_time",
        f"{stamp} as _airbyte_extracted_at",
    )


def tiktok_reports(events: DataFrame) -> DataFrame:
    return events.selectExpr(
        "*", f"{_EVENT_K} as k", "cast(ts as timestamp) as at"
    ).selectExpr(
        "user_id as advertiser_id",
        f"{TIKTOK_BASE} + user_id as campaign_id",
        "date_format(at, 'yyyy-MM-dd 00:00:00') as stat_time_day",
        "to_json(named_struct('stat_time_day', date_format(at, 'yyyy-MM-dd 00:00:00')))"
        " as dimensions",
        "to_json(named_struct('impressions', cast(k * 9 as string), 'clicks', cast(k as string),"
        " 'reach', cast(k * 5 as string), 'spend', cast(cast(value as decimal(14,2)) as string),"
        " 'complete_payment', cast(k as string),"
        " 'total_complete_payment_rate', concat(k, '.75'))) as metrics",
        "at as _airbyte_extracted_at",
    )


def marketing_calendar(parts: DataFrame) -> DataFrame:
    """Ranges of some days; some are one day, open or reversed."""
    base = parts.selectExpr("*", "date_add(date'2024-01-01', cast(p_partkey % 90 as int)) as day", "cast(p_partkey % 4 as int) as kind")
    return base.selectExpr(
        "case kind when 0 then 'promotion' when 1 then 'event' when 2 then 'media_change' else 'media_flight' end as entry_type",
        "p_name as name",
        "case when p_size <> 11 then day end as start_date",
        "case when p_size <> 7 then date_add(day, p_size % 9 - 2) end as end_date",
        "case when kind = 0 then cast(p_size as double) end as discount_pct",
        "case when kind = 0 then p_brand end as discount_code",
        "case when kind = 0 then 'all' else 'youtube' end as channels",
        "cast(null as string) as notes",
    )


# (system, raw table) -> (star-schema table, projection)
PROJECTIONS = {
    ("shopify", "orders"): ("orders", shopify_orders),
    ("shopify", "order_refunds"): ("orders", shopify_order_refunds),
    ("shopify", "customers"): ("customer", shopify_customers),
    ("shopify", "customer_journey_summary"): ("orders", shopify_journeys),
    ("shopify", "discount_codes"): ("part", shopify_discount_codes),
    ("shopify", "price_rules"): ("part", shopify_price_rules),
    ("shopify", "products"): ("part", shopify_products),
    ("shopify", "product_variants"): ("part", shopify_variants),
    ("ga4", "events"): ("events", ga4_events),
    ("facebook_marketing", "ads_insights"): ("events", meta_ads_insights),
    ("facebook_marketing", "campaigns"): ("customer", meta_campaigns),
    ("google_ads", "campaign"): ("lineitem", google_report),
    ("linkedin_ads", "ad_campaign_analytics"): ("orders", linkedin_analytics),
    ("linkedin_ads", "campaign_groups"): ("nation", linkedin_groups),
    ("linkedin_ads", "campaigns"): ("customer", linkedin_campaigns),
    ("tiktok_marketing", "campaigns"): ("customer", tiktok_campaigns),
    ("tiktok_marketing", "campaigns_reports_daily"): ("events", tiktok_reports),
    ("manual", "marketing_calendar"): ("part", marketing_calendar),
}


# Raw tables with much work a row, and the star columns by which their rows can be dealt before it.
SPREAD = {
    ("shopify", "orders"): ("o_orderkey", "o_custkey", "o_orderdate"),
    ("shopify", "order_refunds"): ("o_orderkey", "o_custkey", "o_orderdate"),
    ("ga4", "events"): ("event_id", "user_id", "ts"),
}
# Star columns by which rows of the other raw tables are dealt, if the files leave tasks idle.
SPREAD_UNEVEN = {
    "customer": ("c_custkey", "c_name"),
    "events": ("event_id", "user_id", "ts"),
    "lineitem": ("l_orderkey", "l_suppkey", "l_shipdate"),
    "orders": ("o_orderkey", "o_custkey", "o_orderdate"),
}


def uneven(df: DataFrame) -> bool:
    """Whether one task would read more than twice its share of a file scan. Only row counts are read."""
    tasks = df.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"))
    most, total = tasks.agg(F.max("n"), F.sum("n")).first()
    return (most or 0) * df.sparkSession.sparkContext.defaultParallelism > 2 * (total or 0)


def raw_tables(spark: SparkSession, sf_dir: str, spread: bool = False) -> RawTables:
    """All raw tables as projections of the star schema in ``sf_dir``.

    ``spread`` deals the rows of some over all tasks first, for jobs that read the star tables from
    few files: one task reads a row group, and a file can be a single one. Rows with little work are
    only dealt where that is so."""

    @cache
    def rows(table: str) -> DataFrame:
        return star(spark, sf_dir, table)

    @cache
    def even(table: str) -> DataFrame:
        df = rows(table)
        if table not in SPREAD_UNEVEN or not uneven(df):
            return df
        # a fixed number of tasks: merged by their few bytes, the parts of a union would be one again
        return df.repartition(spark.sparkContext.defaultParallelism, *SPREAD_UNEVEN[table])

    def frame(key: tuple[str, str], table: str, project: Callable[[DataFrame], DataFrame]) -> Callable[[], DataFrame]:
        if spread and key in SPREAD:
            return lambda: project(rows(table).repartition(*SPREAD[key]))
        return lambda: project(even(table) if spread else rows(table))

    return RawTables(
        spark, frames={key: frame(key, table, project) for key, (table, project) in PROJECTIONS.items()}
    )
