"""Registered queries of the store tables.

The reference SQL never parses JSON or URLs: it computes the expected values
straight from the star-schema columns the raw tables were projected from.
"""

from __future__ import annotations

from ..plans import intermediate, pipeline
from ..sources.starschema import raw_tables
from .present import Query, query, seed_values, ts

STAMP = "TIMESTAMP '2024-05-01 10:00:00'"

ORDERS = """
    SELECT *, cast(substr(o_orderpriority, 1, 1) AS int) AS p,
           cast(o_totalprice AS decimal(12,2)) AS price,
           cast(o_custkey / 100 AS decimal(12,2)) AS discount
    FROM orders
"""

ORDER_ROWS = f"""
    SELECT o_orderkey AS order_id, '#' || o_orderkey AS order_name,
           o_orderkey + 1000 AS order_number, o_custkey AS customer_id,
           o_orderkey * 10 + p AS checkout_id, o_orderdate AS created_at,
           o_orderdate + INTERVAL 5 MINUTE AS processed_at,
           o_orderdate + INTERVAL 1 DAY AS updated_at,
           CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 2 DAY END AS closed_at,
           CASE WHEN late THEN o_orderdate + INTERVAL 3 HOUR END AS cancelled_at,
           CASE o_orderstatus WHEN 'F' THEN 'paid' WHEN 'O' THEN 'pending' ELSE 'refunded' END
             AS financial_status,
           CASE WHEN o_orderstatus = 'F' THEN 'fulfilled' END AS fulfillment_status,
           CASE WHEN late THEN 'customer' END AS cancel_reason,
           [NULL, 'vip, test', 'wholesale-team-order', 'contest', NULL, ' test ,x'][p + 1] AS tags,
           p IN (1, 5) OR (o_orderstatus = 'O' AND p = 2) AS is_test,
           p = 2 AS is_wholesale, late AS is_cancelled,
           price AS gross_sales, discount AS total_discounts, price - discount AS subtotal_price,
           p + 0.5 AS shipping_price, o_custkey + 0.07 AS total_tax, price AS total_price,
           price - discount AS current_subtotal_price, discount AS current_total_discounts,
           o_custkey + 0.07 AS current_total_tax, price AS current_total_price,
           0.0 AS total_outstanding, 'USD' AS currency,
           CASE p WHEN 1 THEN 'WELCOME10' WHEN 3 THEN 'BFCM30' WHEN 5 THEN 'CODE' || o_custkey END
             AS discount_code,
           CASE WHEN p IN (1, 3, 5) THEN 'discount_code' WHEN p = 2 THEN 'automatic' END
             AS discount_type,
           CASE p
             WHEN 1 THEN '/products/' || o_orderkey || '?utm_source=Google&utm_medium=CPC'
               || '&utm_campaign=Spring%20Sale+' || o_orderstatus || '&utm_id=' || o_custkey
               || '&gclid=g' || o_orderkey || '#top'
             WHEN 2 THEN '/?UTM_SOURCE=fb&utm_medium=paid%20social&fbclid=f' || o_orderkey
               || '&utm_term=&utm_content=a%2Bb'
             WHEN 3 THEN '/collections/all'
             WHEN 5 THEN '/x?ttclid=t' || o_orderkey || '&gbraid=b&li_fat_id=l&_kx=k&srsltid=s'
               || '&utm_source=100%zz%41' END AS landing_site,
           CASE p WHEN 1 THEN '/products/' || o_orderkey WHEN 2 THEN '/'
             WHEN 3 THEN '/collections/all' WHEN 5 THEN '/x' END AS landing_path,
           CASE p WHEN 1 THEN 'google' WHEN 2 THEN 'fb' WHEN 5 THEN '100%zza' END AS utm_source,
           CASE p WHEN 1 THEN 'cpc' WHEN 2 THEN 'paid social' END AS utm_medium,
           CASE WHEN p = 1 THEN 'Spring Sale+' || o_orderstatus END AS utm_campaign,
           CASE WHEN p = 1 THEN cast(o_custkey AS varchar) END AS utm_id,
           CASE WHEN p = 2 THEN 'a+b' END AS utm_content,
           cast(NULL AS varchar) AS utm_term,
           CASE WHEN p = 1 THEN 'g' || o_orderkey END AS gclid,
           CASE WHEN p = 5 THEN 'b' END AS gbraid,
           CASE WHEN p = 2 THEN 'f' || o_orderkey END AS fbclid,
           CASE WHEN p = 5 THEN 't' || o_orderkey END AS ttclid,
           CASE WHEN p = 5 THEN 'l' END AS li_fat_id,
           CASE WHEN p = 5 THEN 'k' END AS klaviyo_kx,
           CASE WHEN p = 5 THEN 's' END AS srsltid,
           CASE p WHEN 1 THEN 'https://www.google.com/search?q=1'
             WHEN 2 THEN 'http://l.facebook.com' WHEN 3 THEN 'android-app://x' END AS referring_site,
           CASE p WHEN 1 THEN 'www.google.com' WHEN 2 THEN 'l.facebook.com' END AS referrer_domain,
           CASE p WHEN 1 THEN 'tablet' WHEN 2 THEN 'tablet' WHEN 3 THEN 'mobile'
             WHEN 5 THEN 'desktop' END AS device_type,
           o_orderstatus = 'F' AS buyer_accepts_marketing, 'en-US' AS customer_locale,
           CASE WHEN p < 4 THEN 'card' END AS payment_gateway,
           CASE WHEN p < 3 THEN 'Standard' END AS shipping_method,
           CASE WHEN p <> 4 THEN 'City ' || o_custkey END AS shipping_city,
           CASE WHEN p <> 4 THEN o_orderstatus END AS shipping_province_code,
           CASE WHEN p <> 4 THEN 'US' END AS shipping_country_code,
           CASE WHEN p <> 4 THEN lpad(cast(o_custkey AS varchar), 7, '0') END AS shipping_zip,
           o_custkey * 10 AS total_weight_grams, 'shop' AS shop_url,
           o_orderdate + INTERVAL 2 DAY AS _airbyte_extracted_at
    FROM (SELECT *, p = 5 AND o_orderstatus = 'P' AS late FROM ({ORDERS}))
"""

LINE_ROWS = f"""
    SELECT o_orderkey * 10 + n AS order_line_id, o_orderkey AS order_id,
           o_custkey + n AS product_id, o_custkey AS variant_id, 'SKU-' || n AS sku,
           'Title ' || o_custkey AS product_title, cast(NULL AS varchar) AS variant_title,
           'v' AS vendor, n AS quantity, o_custkey + 0.25 AS unit_price,
           (o_custkey + 0.25) * n AS gross_amount,
           CASE n WHEN 1 THEN 1.25 WHEN 3 THEN 1.45 ELSE 0 END AS discount_amount,
           n + 0.05 AS tax_amount, n = 4 AS is_gift_card, n <> 4 AS requires_shipping,
           CASE WHEN o_orderstatus = 'F' THEN 'fulfilled' END AS fulfillment_status,
           o_orderdate AS order_created_at
    FROM (SELECT *, unnest(range(1, p)) AS n FROM ({ORDERS}))
"""

REFUNDS = f"""
    SELECT *, CASE WHEN k = 1 THEN p - 1 ELSE 1 END AS m,
           o_orderdate + to_days(cast(5 * k AS int)) + INTERVAL 23 HOUR AS refunded_at
    FROM (SELECT *, unnest(range(1, CASE WHEN p >= 4 THEN 3 ELSE 2 END)) AS k
          FROM ({ORDERS}) WHERE o_orderstatus = 'P')
"""

REFUND_ROWS = f"""
    SELECT o_orderkey * 10 + k AS refund_id, o_orderkey AS order_id, refunded_at,
           refunded_at + INTERVAL 1 HOUR AS processed_at,
           CASE p WHEN 2 THEN 'Return - ' WHEN 3 THEN 'Return-Too small'
             WHEN 4 THEN 'Damaged, Return - no' WHEN 5 THEN 'Return -  Reason ' || k END
             AS refund_note,
           CASE p WHEN 3 THEN 'Too small' WHEN 4 THEN 'Damaged, Return - no'
             WHEN 5 THEN 'Reason ' || k END AS return_reason,
           k = 1 AS is_restocked,
           CASE WHEN p <= 3 THEN m * (m + 1) // 2 ELSE m END AS refunded_quantity,
           m * (m + 1) // 2 + 0.15 * m AS refunded_subtotal, 0.35 * m AS refunded_tax,
           CASE WHEN p = 1 THEN 0 ELSE o_custkey + 0.45 END AS refunded_amount,
           CASE WHEN p > 1 THEN 'card' END AS refund_gateway, 'shop' AS shop_url,
           o_orderdate + to_days(cast(5 * k + 1 AS int)) AS _airbyte_extracted_at
    FROM ({REFUNDS})
"""

REFUND_LINE_ROWS = f"""
    SELECT (o_orderkey * 10 + k) * 10 + n AS refund_line_id, o_orderkey * 10 + k AS refund_id,
           o_orderkey AS order_id, o_orderkey * 10 + n AS order_line_id,
           CASE WHEN p <= 3 THEN n ELSE 1 END AS quantity, n + 0.15 AS subtotal_amount,
           0.35 AS tax_amount, CASE WHEN k = 1 THEN 'return' END AS restock_type,
           o_custkey AS location_id, refunded_at
    FROM (SELECT *, unnest(range(1, m + 1)) AS n FROM ({REFUNDS}))
"""


def shown(
    rows: str,
    dates: tuple[str, ...] = (),
    money: tuple[str, ...] = (),
    whole: tuple[str, ...] = (),
) -> str:
    """Select everything in plain types: instants as text, money as double."""
    changes = [f"{ts(c)} AS {c}" for c in dates]
    changes += [f"cast({c} AS double) AS {c}" for c in money]
    changes += [f"cast({c} AS bigint) AS {c}" for c in whole]
    return f"SELECT * REPLACE ({', '.join(changes)}) FROM ({rows})"


ORDER_MONEY = (
    "gross_sales", "total_discounts", "subtotal_price", "shipping_price", "total_tax",
    "total_price", "current_subtotal_price", "current_total_discounts", "current_total_tax",
    "current_total_price", "total_outstanding",
)
ORDER_DATES = (
    "created_at", "processed_at", "updated_at", "closed_at", "cancelled_at",
    "_airbyte_extracted_at",
)

ENRICHED_ROWS = f"""
    SELECT o.*, l.line_count, l.units_ordered, l.gift_card_sales,
           coalesce(r.refund_count, 0) AS refund_count, r.first_refunded_at, r.last_refunded_at,
           date_diff('day', o.created_at, r.first_refunded_at) AS days_to_first_refund,
           coalesce(r.units, 0) AS units_refunded,
           coalesce(d.line_ids, 0) AS refunded_line_count,
           coalesce(d.products, 0) AS refunded_product_count,
           coalesce(r.subtotal, 0) AS refunded_subtotal, coalesce(r.tax, 0) AS refunded_tax,
           coalesce(r.amount, 0) AS refunded_amount, r.return_reasons,
           o.subtotal_price - coalesce(r.subtotal, 0) AS net_sales,
           o.total_price - coalesce(r.amount, 0) AS net_total_price,
           r.order_id IS NOT NULL AS has_refund,
           CASE WHEN coalesce(r.units, 0) = 0 THEN false ELSE r.units >= l.units_ordered END
             AS is_fully_refunded,
           CASE WHEN coalesce(r.units, 0) = 0 THEN false ELSE r.units < l.units_ordered END
             AS is_partially_refunded,
           NOT (o.is_test OR o.is_cancelled OR o.is_wholesale) AS is_marketing_eligible
    FROM ({ORDER_ROWS}) o
    LEFT JOIN (SELECT order_id, count(*) AS line_count, sum(quantity) AS units_ordered,
                      sum(CASE WHEN is_gift_card THEN gross_amount - discount_amount ELSE 0 END)
                        AS gift_card_sales
               FROM ({LINE_ROWS}) GROUP BY 1) l USING (order_id)
    LEFT JOIN (SELECT order_id, count(*) AS refund_count, min(refunded_at) AS first_refunded_at,
                      max(refunded_at) AS last_refunded_at, sum(refunded_quantity) AS units,
                      sum(refunded_subtotal) AS subtotal, sum(refunded_tax) AS tax,
                      sum(refunded_amount) AS amount,
                      array_to_string(list_sort(list_distinct(
                        list(return_reason) FILTER (return_reason IS NOT NULL))), ', ')
                        AS return_reasons
               FROM ({REFUND_ROWS}) GROUP BY 1) r USING (order_id)
    LEFT JOIN (SELECT x.order_id, count(DISTINCT x.order_line_id) AS line_ids,
                      count(DISTINCT y.product_id) AS products
               FROM ({REFUND_LINE_ROWS}) x LEFT JOIN ({LINE_ROWS}) y USING (order_line_id)
               GROUP BY 1) d USING (order_id)
"""

ENRICHED_SQL = shown(
    ENRICHED_ROWS,
    dates=(*ORDER_DATES, "first_refunded_at", "last_refunded_at"),
    money=(
        *ORDER_MONEY, "gift_card_sales", "refunded_subtotal", "refunded_tax", "refunded_amount",
        "net_sales", "net_total_price",
    ),
    whole=("units_ordered", "units_refunded"),
)

CUSTOMER = """
    SELECT *, split_part(c_name, '#', 1) AS first_name,
           CASE WHEN c_mktsegment <> 'FURNITURE' THEN split_part(c_name, '#', 2) END AS last_name,
           c_mktsegment = 'MACHINERY' AS opted_in,
           c_mktsegment NOT IN ('BUILDING', 'HOUSEHOLD') AS has_address
    FROM customer
"""

CUSTOMER_COLUMNS = f"""
    c_custkey AS customer_id, 'c' || c_custkey || '@example.com' AS email, first_name, last_name,
    first_name || coalesce(' ' || last_name, '') AS full_name, opted_in AS accepts_marketing,
    CASE WHEN opted_in THEN {ts(STAMP)} END AS accepts_marketing_updated_at,
    'single_opt_in' AS marketing_opt_in_level, true AS verified_email, false AS tax_exempt,
    'enabled' AS customer_state, lower(c_mktsegment) AS tags, 'USD' AS currency,
    c_custkey AS orders_count, c_acctbal AS total_spent, c_custkey * 2 AS last_order_id,
    '#' || c_custkey * 2 AS last_order_name, {ts(STAMP)} AS created_at,
    {ts(f"{STAMP} + INTERVAL 1 DAY")} AS updated_at, 'shop' AS shop_url
"""

ADDRESS_COLUMNS = """
    c_custkey || ' Main' AS address1, 'City ' || c_nationkey AS city,
    cast(NULL AS varchar) AS province, 'PC' AS province_code, 'Land' AS country,
    'LL' AS country_code, '0' || c_custkey AS zip
"""

# Fixed value: the consent time of the fixture, 23:30 at UTC-5, in UTC.
CONSENT_AT = "TIMESTAMP '2024-03-01 04:30:00'"

CUSTOMERS_ENRICHED_SQL = f"""
    SELECT * EXCLUDE (has_address, c_custkey, c_nationkey, c_mktsegment, opted_in),
           CASE WHEN opted_in THEN 'subscribed'
             WHEN c_mktsegment NOT IN ('HOUSEHOLD', 'FURNITURE') THEN 'unsubscribed' END
             AS email_consent_state,
           CASE WHEN opted_in THEN 'single_opt_in' END AS email_opt_in_level,
           CASE WHEN opted_in THEN {ts(CONSENT_AT)} END AS email_consent_updated_at,
           opted_in AS is_email_subscribed,
           CASE WHEN has_address THEN c_custkey * 10 + 1 END AS default_address_id,
           CASE WHEN has_address THEN 'City ' || c_nationkey END AS address_city,
           cast(NULL AS varchar) AS address_province,
           CASE WHEN has_address THEN 'PC' END AS address_province_code,
           CASE WHEN has_address THEN 'Land' END AS address_country,
           CASE WHEN has_address THEN 'LL' END AS address_country_code,
           CASE WHEN has_address THEN '0' || c_custkey END AS address_zip,
           cast(CASE WHEN NOT has_address THEN 0 WHEN c_mktsegment = 'AUTOMOBILE' THEN 1
                ELSE 2 END AS bigint) AS address_count
    FROM (SELECT {CUSTOMER_COLUMNS}, has_address, c_custkey, c_nationkey, c_mktsegment, opted_in
          FROM ({CUSTOMER}))
"""

PRODUCT = "SELECT *, split_part(p_name, ' ', 1) AS word FROM part"

CODES_SQL = f"""
    SELECT p_partkey AS discount_code_id, code AS discount_code, code_type,
           CASE WHEN p_size = 50 THEN -1 ELSE p_partkey END AS price_rule_id,
           CASE WHEN p_size = 50 THEN NULL WHEN fixed THEN 'fixed_amount' ELSE 'percentage' END
             AS value_type,
           CASE WHEN p_size <> 50 THEN p_size + 0.5 END::double AS discount_value,
           CASE WHEN p_size <> 50 AND NOT fixed THEN p_size + 0.5 END::double AS discount_pct,
           CASE WHEN p_size <> 50 THEN p_size > 25 END AS is_once_per_customer,
           CASE WHEN p_size <> 50 THEN cast(p_size AS bigint) END AS usage_limit,
           CASE WHEN p_size <> 50 THEN {ts(STAMP)} END AS starts_at,
           cast(NULL AS varchar) AS ends_at, cast(p_size AS bigint) AS usage_count,
           coalesce(n, 0) AS order_count, coalesce(total, 0)::double AS total_discount_amount,
           coalesce(net, 0)::double AS net_sales, {ts("first_at")} AS first_used_at,
           {ts("last_at")} AS last_used_at, {ts(STAMP)} AS created_at
    FROM (SELECT *, p_type IN ('PROMO', 'SMALL') AS fixed,
                 CASE p_partkey WHEN 1 THEN 'WELCOME10' WHEN 3 THEN 'BFCM30'
                   ELSE 'CODE' || p_partkey END AS code FROM part)
    LEFT JOIN {seed_values("discount_code_types")} ON code = discount_code_types.discount_code
    LEFT JOIN (SELECT discount_code, count(*) AS n, sum(total_discounts) AS total,
                      sum(net_sales) AS net, min(created_at) AS first_at,
                      max(created_at) AS last_at
               FROM ({ENRICHED_ROWS}) GROUP BY 1) used ON used.discount_code = code
"""

JOURNEY_TRACKED = {"first": "p < 4", "last": "p < 5"}


def _visit_sql(which: str) -> str:
    seen = JOURNEY_TRACKED[which]
    parts = {
        "at": "'2024-03-10 01:30:00.000000'",
        "source": "'direct'",
        "source_type": "cast(NULL AS varchar)",
        "landing_page": "'https://shop.example.com/' || o_orderkey",
        "referrer_url": "''",
    }
    first_only = {
        "utm_source": "'google'",
        "utm_medium": "'cpc'",
        "utm_campaign": "'c' || o_custkey",
        "utm_content": "cast(NULL AS varchar)",
        "utm_term": "'T'",
    }
    out = [f"CASE WHEN {seen} THEN {e} END AS {which}_visit_{c}" for c, e in parts.items()]
    out += [f"CASE WHEN p = 1 THEN {e} END AS {which}_visit_{c}" for c, e in first_only.items()]
    return ", ".join(out)


SQL = {
    "shopify_orders": shown(ORDER_ROWS, dates=ORDER_DATES, money=ORDER_MONEY),
    "shopify_order_lines": shown(
        LINE_ROWS,
        dates=("order_created_at",),
        money=("unit_price", "gross_amount", "discount_amount", "tax_amount"),
        whole=("quantity",),
    ),
    "shopify_order_refunds": shown(
        REFUND_ROWS,
        dates=("refunded_at", "processed_at", "_airbyte_extracted_at"),
        money=("refunded_subtotal", "refunded_tax", "refunded_amount"),
        whole=("refunded_quantity",),
    ),
    "shopify_order_refund_lines": shown(
        REFUND_LINE_ROWS,
        dates=("refunded_at",),
        money=("subtotal_amount", "tax_amount"),
        whole=("quantity",),
    ),
    "shopify_customers": f"""
        SELECT {CUSTOMER_COLUMNS}, {ts(STAMP)} AS _airbyte_extracted_at FROM ({CUSTOMER})""",
    "shopify_customer_addresses": f"""
        SELECT c_custkey AS customer_id, c_custkey * 10 + n AS address_id, {ADDRESS_COLUMNS},
               n = 1 AS is_default, {ts(STAMP)} AS _airbyte_extracted_at
        FROM (SELECT *, unnest(range(1, CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 2 ELSE 3 END))
                AS n FROM ({CUSTOMER}) WHERE has_address)""",
    "shopify_customer_default_addresses": f"""
        SELECT c_custkey AS customer_id, c_custkey * 10 + 1 AS address_id, {ADDRESS_COLUMNS},
               {ts(STAMP)} AS _airbyte_extracted_at
        FROM ({CUSTOMER}) WHERE has_address""",
    "shopify_customer_email_consents": f"""
        SELECT c_custkey AS customer_id, state AS consent_state,
               CASE WHEN opted_in THEN 'single_opt_in' END AS opt_in_level,
               CASE WHEN opted_in THEN {ts(CONSENT_AT)} END AS consent_updated_at,
               state = 'subscribed' AS is_subscribed, {ts(STAMP)} AS _airbyte_extracted_at
        FROM (SELECT *, CASE WHEN opted_in THEN 'subscribed'
                          WHEN c_mktsegment <> 'FURNITURE' THEN 'unsubscribed' END AS state
              FROM ({CUSTOMER}) WHERE c_mktsegment <> 'HOUSEHOLD')""",
    "shopify_customer_journeys": f"""
        SELECT o_orderkey AS order_id, {ts("o_orderdate")} AS order_created_at,
               CASE WHEN p < 5 THEN cast(p AS bigint) END AS customer_order_index,
               CASE WHEN p < 5 THEN o_custkey END AS days_to_conversion,
               CASE WHEN p < 5 THEN o_custkey END AS moments_count, p < 4 AS has_journey,
               {_visit_sql("first")}, {_visit_sql("last")},
               {ts("o_orderdate")} AS _airbyte_extracted_at
        FROM ({ORDERS})""",
    "shopify_discount_codes": f"""
        SELECT p_partkey AS discount_code_id,
               CASE WHEN p_size = 50 THEN -1 ELSE p_partkey END AS price_rule_id,
               CASE p_partkey WHEN 1 THEN 'WELCOME10' WHEN 3 THEN 'BFCM30'
                 ELSE 'CODE' || p_partkey END AS discount_code,
               cast(p_size AS bigint) AS usage_count, {ts(STAMP)} AS created_at,
               {ts(STAMP)} AS updated_at, 'shop' AS shop_url, {ts(STAMP)} AS _airbyte_extracted_at
        FROM part""",
    "shopify_price_rules": f"""
        SELECT p_partkey AS price_rule_id, p_name AS price_rule_title,
               CASE WHEN p_type IN ('PROMO', 'SMALL') THEN 'fixed_amount' ELSE 'percentage' END
                 AS value_type,
               p_size + 0.5::double AS discount_value, 'line_item' AS target_type,
               'all' AS target_selection, 'across' AS allocation_method,
               'all' AS customer_selection, p_size > 25 AS is_once_per_customer,
               cast(p_size AS bigint) AS usage_limit, {ts(STAMP)} AS starts_at,
               cast(NULL AS varchar) AS ends_at, {ts(STAMP)} AS created_at,
               {ts(STAMP)} AS updated_at, 'shop' AS shop_url, {ts(STAMP)} AS _airbyte_extracted_at
        FROM part""",
    "shopify_products": f"""
        SELECT p_partkey AS product_id, 'handle-' || p_partkey AS handle, p_name AS product_title,
               p_brand AS vendor, kind AS product_type, kind = 'Gift Card' AS is_gift_card,
               CASE WHEN p_type NOT IN ('PROMO', 'SMALL') THEN word END AS gender,
               CASE WHEN p_type NOT IN ('PROMO', 'SMALL') THEN 'core' END AS season,
               CASE p_type WHEN 'PROMO' THEN 'Gift Card' WHEN 'SMALL' THEN NULL
                 ELSE p_type || ', ' || word || ', core ' END AS tags,
               'active' AS product_status, 'web' AS published_scope,
               CASE WHEN p_type <> 'PROMO' THEN 'https://cdn.example.com/' || p_partkey || '.png'
                 END AS image_url,
               {ts(STAMP)} AS created_at, {ts(STAMP)} AS published_at, {ts(STAMP)} AS updated_at,
               'shop' AS shop_url, {ts(STAMP)} AS _airbyte_extracted_at
        FROM (SELECT *, CASE p_type WHEN 'PROMO' THEN 'Gift Card' WHEN 'SMALL' THEN NULL
                          ELSE p_type END AS kind FROM ({PRODUCT}))""",
    "shopify_product_variants": f"""
        SELECT p_partkey AS variant_id, p_partkey AS product_id, 'SKU-' || p_partkey AS sku,
               cast(NULL AS varchar) AS barcode, p_partkey * 7 AS inventory_item_id,
               p_name AS variant_title, CASE WHEN p_type <> 'PROMO' THEN word END AS color,
               cast(p_size AS varchar) AS size, 1::bigint AS variant_position,
               p_retailprice AS price,
               CASE WHEN p_size > 40 THEN p_size END::double AS compare_at_price,
               true AS is_taxable,
               CASE WHEN p_size > 25 THEN 'shopify' END AS inventory_management,
               p_size > 25 AS is_inventory_tracked, 'deny' AS inventory_policy,
               cast(p_size AS bigint) AS inventory_quantity,
               p_type <> 'PROMO' AS requires_shipping, cast(p_size * 100 AS bigint) AS grams,
               p_size / 4 AS weight, 'kg' AS weight_unit, {ts(STAMP)} AS created_at,
               {ts(STAMP)} AS updated_at, 'shop' AS shop_url, {ts(STAMP)} AS _airbyte_extracted_at
        FROM ({PRODUCT})""",
    "orders_enriched": ENRICHED_SQL,
    "customers_enriched": CUSTOMERS_ENRICHED_SQL,
    "discount_codes_enriched": CODES_SQL,
}


def _table(name: str):
    return lambda spark, sf: pipeline.Tables(raw_tables(spark, sf))[name]


def _customers_by_joins(spark, sf):
    t = pipeline.Tables(raw_tables(spark, sf))
    return intermediate.customers_enriched(
        t["shopify_customers"],
        t["shopify_customer_default_addresses"],
        t["shopify_customer_email_consents"],
        t["shopify_customer_addresses"],
    )


QUERIES: dict[str, Query] = {name: query(_table(name), sql) for name, sql in SQL.items()}
QUERIES["customers_enriched_by_joins"] = query(_customers_by_joins, CUSTOMERS_ENRICHED_SQL)
