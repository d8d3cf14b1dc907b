"""Cross-source plans: enriched orders, customers and codes; conformed campaigns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import functions as fn
from ..operators.conform import conform_union
from ..operators.enrich import left_enrich
from . import shopify

MONEY_SUM = "decimal(38,2)"


# Columns of the order lines that each use below reads.
LINE_TOTALS = ("order_id", "quantity", "is_gift_card", "gross_amount", "discount_amount")
LINE_PRODUCTS = ("order_line_id", "product_id")
# What an order's lines add up to.
TOTALS = ("line_count", "units_ordered", "gift_card_sales")
# Columns of the enriched orders that the use of a code is summed from.
CODE_USE = ("discount_code", "total_discounts", "net_sales", "created_at")


def _line_totals(order_lines: DataFrame) -> DataFrame:
    return order_lines.groupBy("order_id").agg(
        F.count("*").alias("line_count"),
        F.sum("quantity").alias("units_ordered"),
        F.sum(
            F.when(F.col("is_gift_card"), F.col("gross_amount") - F.col("discount_amount"))
            .otherwise(0)
            .cast(MONEY_SUM)
        ).alias("gift_card_sales"),
    )


def orders_enriched(
    orders: DataFrame,
    order_lines: DataFrame,
    refunds: DataFrame,
    refund_lines: DataFrame,
    line_products: DataFrame | None = None,
) -> DataFrame:
    """One row per order with line counts and refunds attributed back to it.

    ``line_products`` is the order lines again, narrowed to ``LINE_PRODUCTS``;
    without it they are taken from ``order_lines``. Orders that carry ``TOTALS``,
    made inside their rows, keep them, and ``order_lines`` is only read for products.

    Each detail table is reduced to one row per order before its join, so an
    order with any number of lines costs one row per map task in the shuffle, and
    all three joins share the partitioning on ``order_id``.
    """
    zero = F.lit(0).cast(MONEY_SUM)
    reasons = F.collect_set("return_reason")
    refund_totals = refunds.groupBy("order_id").agg(
        F.count("*").alias("refund_count"),
        F.min("refunded_at").alias("first_refunded_at"),
        F.max("refunded_at").alias("last_refunded_at"),
        F.sum("refunded_quantity").alias("units_refunded"),
        F.sum("refunded_subtotal").cast(MONEY_SUM).alias("refunded_subtotal"),
        F.sum("refunded_tax").cast(MONEY_SUM).alias("refunded_tax"),
        F.sum("refunded_amount").cast(MONEY_SUM).alias("refunded_amount"),
        F.when(F.size(reasons) > 0, F.array_join(F.sort_array(reasons), ", ")).alias(
            "return_reasons"
        ),
    )
    # Distinct pairs first: a line refunded many times meets the line table once, and refunds
    # without a line, which count nothing, don't meet in one task.
    refunded_counts = (
        left_enrich(
            refund_lines.select("order_id", "order_line_id").where("order_line_id is not null").distinct(),
            (order_lines if line_products is None else line_products).select(*LINE_PRODUCTS),
            ["order_line_id"],
        )
        .groupBy("order_id")
        .agg(
            # Sets of one order's refunded lines: two distinct counts would double every row.
            F.size(F.collect_set("order_line_id")).cast("bigint").alias("refunded_line_count"),
            F.size(F.collect_set("product_id")).cast("bigint").alias("refunded_product_count"),
        )
    )
    sides = [refund_totals, refunded_counts]
    if not set(TOTALS) <= set(orders.columns):
        sides.insert(0, _line_totals(order_lines))
    joined = orders
    for side in sides:
        joined = left_enrich(joined, side, ["order_id"])

    c = F.col
    refunded_units = F.coalesce(c("units_refunded"), F.lit(0))
    joined = joined.select(
        *[name for name in orders.columns if name not in TOTALS],
        *TOTALS,
        F.coalesce(c("refund_count"), F.lit(0)).alias("refund_count"),
        "first_refunded_at",
        "last_refunded_at",
        fn.midnights_between(c("created_at"), c("first_refunded_at")).alias(
            "days_to_first_refund"
        ),
        refunded_units.alias("units_refunded"),
        F.coalesce(c("refunded_line_count"), F.lit(0)).alias("refunded_line_count"),
        F.coalesce(c("refunded_product_count"), F.lit(0)).alias("refunded_product_count"),
        F.coalesce(c("refunded_subtotal"), zero).alias("refunded_subtotal"),
        F.coalesce(c("refunded_tax"), zero).alias("refunded_tax"),
        F.coalesce(c("refunded_amount"), zero).alias("refunded_amount"),
        "return_reasons",
    )
    any_returned = c("units_refunded") > 0
    return joined.select(
        "*",
        (c("subtotal_price") - c("refunded_subtotal")).alias("net_sales"),
        (c("total_price") - c("refunded_amount")).alias("net_total_price"),
        (c("refund_count") > 0).alias("has_refund"),
        (any_returned & (c("units_refunded") >= c("units_ordered"))).alias("is_fully_refunded"),
        (any_returned & (c("units_refunded") < c("units_ordered"))).alias("is_partially_refunded"),
        (~c("is_test") & ~c("is_cancelled") & ~c("is_wholesale")).alias("is_marketing_eligible"),
    )


# Output columns of the enriched customer, in order.
_CUSTOMER_HEAD = (
    "customer_id", "email", "first_name", "last_name", "full_name", "customer_state", "tags",
    "currency", "verified_email", "tax_exempt", "accepts_marketing",
    "accepts_marketing_updated_at", "marketing_opt_in_level",
)
_CUSTOMER_TAIL = (
    "orders_count", "total_spent", "last_order_id", "last_order_name", "created_at",
    "updated_at", "shop_url",
)
_ADDRESS_PARTS = ("city", "province", "province_code", "country", "country_code", "zip")


def _customer_row(joined: DataFrame) -> DataFrame:
    return joined.select(
        *_CUSTOMER_HEAD,
        F.col("consent_state").alias("email_consent_state"),
        F.col("opt_in_level").alias("email_opt_in_level"),
        F.col("consent_updated_at").alias("email_consent_updated_at"),
        F.coalesce(F.col("is_subscribed"), F.lit(False)).alias("is_email_subscribed"),
        F.col("address_id").alias("default_address_id"),
        *[F.col(part).alias(f"address_{part}") for part in _ADDRESS_PARTS],
        F.coalesce(F.col("address_count"), F.lit(0)).cast("bigint").alias("address_count"),
        *_CUSTOMER_TAIL,
    )


def customers_enriched(
    customers: DataFrame,
    default_addresses: DataFrame,
    email_consents: DataFrame,
    addresses: DataFrame,
) -> DataFrame:
    """One row per customer: default address, consent and address count."""
    counts = addresses.groupBy("customer_id").agg(F.count("*").alias("address_count"))
    stamp = "_airbyte_extracted_at"
    joined = customers
    for side in (default_addresses.drop(stamp), email_consents.drop(stamp), counts):
        joined = left_enrich(joined, side, ["customer_id"])
    return _customer_row(joined)


def customers_enriched_in_one_scan(raw_customers: DataFrame) -> DataFrame:
    """The same result straight from the raw table, without any shuffle.

    All four inputs of ``customers_enriched`` come from the same raw row, and
    the raw id is declared unique, so each join pairs a row with itself. The two
    parsed objects and the array length are computed in place instead.
    """
    c = F.col
    address = (
        "id:string,city:string,province:string,province_code:string,country:string,"
        "country_code:string,zip:string"
    )
    parsed = raw_customers.withColumns(
        {
            "_address": fn.parse_object(c("default_address"), address),
            "_consent": fn.parse_object(
                c("email_marketing_consent"),
                "state:string,opt_in_level:string,consent_updated_at:string",
            ),
            "_count": F.size(F.coalesce(
                fn.parse_array(c("addresses"), "string"), F.array().cast("array<string>"))),
        }
    )
    row = parsed.select(
        *shopify.customer_columns(),
        c("_address.id").cast("bigint").alias("address_id"),
        *[c(f"_address.{part}").alias(part) for part in _ADDRESS_PARTS],
        c("_consent.state").alias("consent_state"),
        c("_consent.opt_in_level").alias("opt_in_level"),
        c("_consent.consent_updated_at").cast("timestamp").alias("consent_updated_at"),
        (c("_consent.state") == "subscribed").alias("is_subscribed"),
        c("_count").alias("address_count"),
    )
    return _customer_row(row)


def discount_codes_enriched(
    discount_codes: DataFrame,
    price_rules: DataFrame,
    code_types: DataFrame,
    orders_with_sales: DataFrame,
) -> DataFrame:
    """One row per code: its rule, business type and use in orders.

    A code used by a large share of all orders is summed before the shuffle.
    """
    usage = (
        orders_with_sales.where(F.col("discount_code").isNotNull())
        .groupBy("discount_code")
        .agg(
            F.count("*").alias("order_count"),
            F.sum("total_discounts").cast(MONEY_SUM).alias("total_discount_amount"),
            F.sum("net_sales").cast(MONEY_SUM).alias("net_sales"),
            F.min("created_at").alias("first_used_at"),
            F.max("created_at").alias("last_used_at"),
        )
    )
    rules = price_rules.select(
        "price_rule_id",
        "value_type",
        "discount_value",
        "is_once_per_customer",
        "usage_limit",
        "starts_at",
        "ends_at",
    )
    joined = left_enrich(discount_codes, rules, ["price_rule_id"])
    joined = left_enrich(joined, code_types, ["discount_code"], guard=True)
    joined = left_enrich(joined, usage, ["discount_code"])
    c = F.col
    zero = F.lit(0).cast(MONEY_SUM)
    return joined.select(
        "discount_code_id",
        "discount_code",
        "code_type",
        "price_rule_id",
        "value_type",
        "discount_value",
        F.when(c("value_type") == "percentage", c("discount_value")).alias("discount_pct"),
        "is_once_per_customer",
        "usage_limit",
        "starts_at",
        "ends_at",
        "usage_count",
        F.coalesce(c("order_count"), F.lit(0)).alias("order_count"),
        F.coalesce(c("total_discount_amount"), zero).alias("total_discount_amount"),
        F.coalesce(c("net_sales"), zero).alias("net_sales"),
        "first_used_at",
        "last_used_at",
        "created_at",
    )


def campaigns_unioned(by_platform: Mapping[str, DataFrame]) -> DataFrame:
    """One row per platform and campaign, status conformed."""
    unioned = conform_union(
        by_platform,
        {
            "campaign_id": "string",
            "campaign_name": "string",
            "account_id": "string",
            "campaign_status": "string",
        },
    )
    c = F.col
    return unioned.select(
        campaign_key(),
        "platform",
        "campaign_id",
        "campaign_name",
        "account_id",
        fn.campaign_status(c("campaign_status")).alias("campaign_status"),
        c("campaign_status").alias("platform_campaign_status"),
    )


def campaign_key() -> Column:
    return fn.surrogate_key(F.col("platform"), F.col("campaign_id")).alias("campaign_key")


# Additive measures kept per campaign and day, with their types.
MEASURES = {
    "spend": MONEY_SUM,
    "impressions": "bigint",
    "clicks": "bigint",
    "platform_conversions": "double",
    "platform_conversion_value": MONEY_SUM,
}


def campaign_performance_daily(
    meta: DataFrame, google: DataFrame, tiktok: DataFrame, linkedin: DataFrame
) -> DataFrame:
    """One row per campaign and day with the same measures for every platform.

    Meta (per ad) and Google (per network and device) are summed up to the
    campaign; the other two arrive at that grain. Clicks are website clicks.
    """
    grain = ("campaign_id", "date_day")

    def summed(df: DataFrame) -> DataFrame:
        return df.groupBy(*grain).agg(*[F.sum(m).alias(m) for m in MEASURES])

    def website_clicks(df: DataFrame, source: str) -> DataFrame:
        return df.withColumn("clicks", F.col(source)).select(*grain, *MEASURES)

    unioned = conform_union(
        {
            "Meta": summed(website_clicks(meta, "link_clicks")),
            "Google Ads": summed(google),
            "TikTok": tiktok,
            "LinkedIn": website_clicks(linkedin, "landing_page_clicks"),
        },
        {"campaign_id": "string", "date_day": "date", **MEASURES},
    )
    return unioned.select(
        campaign_key(),
        "platform",
        *grain,
        *MEASURES,
    )
