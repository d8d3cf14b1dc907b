"""What must hold for every table, and the two cross-table assertions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import functions as fn
from ..operators.conform import union_all
from ..operators.enrich import unmatched
from ..operators.quality import Checks, report
from ..sources.scan import RawTables

# Accepted values of the conformed columns.
PLATFORMS = ("Meta", "Google Ads", "TikTok", "LinkedIn")
STATUSES = ("active", "paused", "removed")
PAID_CHANNELS = ("Paid Search", "Paid Social", "Paid Video")
CHANNELS = (*PAID_CHANNELS, "Organic Social", "Email")
TACTICS = (
    "prospecting",
    "retargeting",
    "brand_search",
    "nonbrand_search",
    "performance_max",
    "awareness",
)
CODE_TYPES = ("welcome", "seasonal_promo", "creator", "internal")
EVENT_NAMES = (
    "session_start",
    "first_visit",
    "page_view",
    "view_item",
    "add_to_cart",
    "begin_checkout",
    "purchase",
)

# The checks of the raw tables.
RAW_SUITE: dict[str, Checks] = {
    "shopify.orders": Checks(not_null=["id"], unique=["id"]),
    "shopify.order_refunds": Checks(not_null=["id"], unique=["id"]),
    "shopify.customers": Checks(not_null=["id"], unique=["id"]),
    "shopify.customer_journey_summary": Checks(not_null=["order_id"], unique=["order_id"]),
    "shopify.discount_codes": Checks(not_null=["id"], unique=["id"]),
    "shopify.price_rules": Checks(not_null=["id"], unique=["id"]),
    "shopify.products": Checks(not_null=["id"], unique=["id"]),
    "shopify.product_variants": Checks(not_null=["id"], unique=["id"]),
    "ga4.events": Checks(not_null=["event_timestamp", "event_name", "user_pseudo_id"]),
    "facebook_marketing.ads_insights": Checks(not_null=["ad_id", "date_start"]),
    "facebook_marketing.campaigns": Checks(not_null=["id"], unique=["id"]),
    "google_ads.campaign": Checks(
        not_null=["campaign_id", "segments_date", "segments_ad_network_type", "segments_device"]
    ),
    "linkedin_ads.ad_campaign_analytics": Checks(not_null=["start_date", "sponsoredCampaign"]),
    "linkedin_ads.campaign_groups": Checks(not_null=["id"], unique=["id"]),
    "linkedin_ads.campaigns": Checks(not_null=["id"], unique=["id"]),
    "tiktok_marketing.campaigns": Checks(not_null=["campaign_id"], unique=["campaign_id"]),
    "tiktok_marketing.campaigns_reports_daily": Checks(not_null=["campaign_id", "stat_time_day"]),
}

# The checks of the seeds, staging tables and marts.
SUITE: dict[str, Checks] = {
    "channel_mapping": Checks(
        not_null=["utm_source", "utm_medium", "channel", "platform", "is_paid"],
        unique_together=[["utm_source", "utm_medium"]],
        accepted={"channel": CHANNELS},
    ),
    "campaign_attributes": Checks(
        not_null=["platform", "campaign_id", "channel", "campaign_tactic", "initiative_name"],
        unique_together=[["platform", "campaign_id"]],
        accepted={"channel": PAID_CHANNELS, "campaign_tactic": TACTICS},
    ),
    "discount_code_types": Checks(
        not_null=["discount_code", "code_type"],
        unique=["discount_code"],
        accepted={"code_type": CODE_TYPES},
    ),
    "shopify_customers": Checks(not_null=["customer_id"], unique=["customer_id"]),
    "shopify_customer_default_addresses": Checks(
        not_null=["customer_id"],
        unique=["customer_id"],
        refers_to={"customer_id": ("shopify_customers", "customer_id")},
    ),
    "shopify_customer_addresses": Checks(
        not_null=["address_id", "customer_id"],
        unique=["address_id"],
        refers_to={"customer_id": ("shopify_customers", "customer_id")},
    ),
    "shopify_customer_email_consents": Checks(
        not_null=["customer_id"],
        unique=["customer_id"],
        accepted={"consent_state": ("subscribed", "not_subscribed", "unsubscribed", "pending")},
        refers_to={"customer_id": ("shopify_customers", "customer_id")},
    ),
    "shopify_orders": Checks(
        not_null=["order_id", "customer_id", "subtotal_price"],
        unique=["order_id"],
        accepted={
            "financial_status": (
                "paid",
                "partially_refunded",
                "refunded",
                "voided",
                "pending",
                "authorized",
            )
        },
        refers_to={"customer_id": ("shopify_customers", "customer_id")},
    ),
    "shopify_order_lines": Checks(
        not_null=["order_line_id", "order_id", "product_id", "variant_id", "quantity"],
        unique=["order_line_id"],
        refers_to={
            "order_id": ("shopify_orders", "order_id"),
            "product_id": ("shopify_products", "product_id"),
            "variant_id": ("shopify_product_variants", "variant_id"),
        },
    ),
    "shopify_products": Checks(
        not_null=["product_id", "handle", "product_type"],
        unique=["product_id", "handle"],
        accepted={"gender": ("women", "men", "unisex", "kids"), "season": ("core", "fall")},
    ),
    "shopify_product_variants": Checks(
        not_null=["variant_id", "product_id", "price"],
        unique=["variant_id"],
        refers_to={"product_id": ("shopify_products", "product_id")},
    ),
    "shopify_discount_codes": Checks(
        not_null=["discount_code_id", "discount_code", "price_rule_id"],
        unique=["discount_code_id", "discount_code"],
        refers_to={
            "discount_code": ("discount_code_types", "discount_code"),
            "price_rule_id": ("shopify_price_rules", "price_rule_id"),
        },
    ),
    "shopify_price_rules": Checks(
        not_null=["price_rule_id", "discount_value"],
        unique=["price_rule_id"],
        accepted={"value_type": ("percentage", "fixed_amount")},
    ),
    "shopify_customer_journeys": Checks(
        not_null=["order_id"],
        unique=["order_id"],
        refers_to={"order_id": ("shopify_orders", "order_id")},
    ),
    "shopify_order_refunds": Checks(
        not_null=["refund_id", "order_id", "refunded_at"],
        unique=["refund_id"],
        refers_to={"order_id": ("shopify_orders", "order_id")},
    ),
    "shopify_order_refund_lines": Checks(
        not_null=["refund_line_id", "refund_id", "order_line_id", "quantity"],
        unique=["refund_line_id"],
        refers_to={
            "refund_id": ("shopify_order_refunds", "refund_id"),
            "order_line_id": ("shopify_order_lines", "order_line_id"),
        },
    ),
    "ga4_events": Checks(
        not_null=[
            "event_id",
            "session_key",
            "user_pseudo_id",
            "ga_session_id",
            "event_name",
            "event_date",
            "event_at",
        ],
        unique=["event_id"],
        accepted={"event_name": EVENT_NAMES, "currency": ("USD",)},
        refers_to={
            "customer_id": ("shopify_customers", "customer_id"),
            "order_id": ("shopify_orders", "order_id"),
        },
    ),
    "ga4_event_items": Checks(
        not_null=["event_id", "variant_id"],
        unique_together=[["event_id", "item_index"]],
        refers_to={
            "event_id": ("ga4_events", "event_id"),
            "variant_id": ("shopify_product_variants", "variant_id"),
        },
    ),
    "meta_campaigns": Checks(not_null=["campaign_id"], unique=["campaign_id"]),
    "meta_ad_stats_daily": Checks(
        not_null=["campaign_id", "date_day"],
        unique_together=[["ad_id", "date_day"]],
        refers_to={"campaign_id": ("meta_campaigns", "campaign_id")},
    ),
    "google_campaigns": Checks(not_null=["campaign_id"], unique=["campaign_id"]),
    "google_campaign_stats_daily": Checks(
        not_null=["campaign_id"],
        unique_together=[["campaign_id", "date_day", "ad_network_type", "device"]],
        refers_to={"campaign_id": ("google_campaigns", "campaign_id")},
    ),
    "linkedin_campaigns": Checks(
        not_null=["campaign_id", "campaign_group_id"],
        unique=["campaign_id"],
        refers_to={"campaign_group_id": ("linkedin_campaign_groups", "campaign_group_id")},
    ),
    "linkedin_campaign_stats_daily": Checks(
        not_null=["campaign_id"],
        unique_together=[["campaign_id", "date_day"]],
        refers_to={"campaign_id": ("linkedin_campaigns", "campaign_id")},
    ),
    "linkedin_campaign_groups": Checks(
        not_null=["campaign_group_id"], unique=["campaign_group_id"]
    ),
    "tiktok_campaigns": Checks(not_null=["campaign_id"], unique=["campaign_id"]),
    "tiktok_campaign_stats_daily": Checks(
        not_null=["campaign_id", "date_day"],
        unique_together=[["campaign_id", "date_day"]],
        refers_to={"campaign_id": ("tiktok_campaigns", "campaign_id")},
    ),
    "customers_enriched": Checks(
        not_null=["customer_id", "is_email_subscribed"], unique=["customer_id"]
    ),
    "discount_codes_enriched": Checks(
        not_null=["discount_code_id", "discount_code", "code_type", "discount_value"],
        unique=["discount_code_id", "discount_code"],
    ),
    "orders_enriched": Checks(
        not_null=[
            "order_id",
            "units_ordered",
            "refunded_subtotal",
            "net_sales",
            "refunded_line_count",
            "refunded_product_count",
            "is_marketing_eligible",
        ],
        unique=["order_id"],
    ),
    "campaigns_unioned": Checks(
        not_null=[
            "campaign_key",
            "platform",
            "campaign_id",
            "campaign_name",
            "account_id",
            "campaign_status",
        ],
        unique=["campaign_key"],
        unique_together=[["platform", "campaign_id"]],
        accepted={"platform": PLATFORMS, "campaign_status": STATUSES},
    ),
    "campaign_performance_daily": Checks(
        not_null=["campaign_key", "date_day"],
        unique_together=[["campaign_key", "date_day"]],
        refers_to={"campaign_key": ("campaigns_unioned", "campaign_key")},
    ),
    "dim_campaigns": Checks(
        not_null=[
            "campaign_key",
            "platform",
            "campaign_id",
            "campaign_name",
            "channel",
            "campaign_tactic",
            "initiative_name",
        ],
        unique=["campaign_key"],
        accepted={"campaign_status": STATUSES},
    ),
    "fct_campaign_performance_daily": Checks(
        not_null=["date_day", "campaign_key", "channel", "spend"],
        unique_together=[["campaign_key", "date_day"]],
        minimum={"spend": 0},
        refers_to={"campaign_key": ("dim_campaigns", "campaign_key")},
    ),
}


def unmapped_utm_pairs(
    orders: DataFrame, journeys: DataFrame, channel_mapping: DataFrame
) -> DataFrame:
    """UTM pairs seen in orders or journeys that the mapping lacks.

    Pairs without any value are expected to be missing. Each input is reduced to
    its distinct pairs before the union, so only pairs are shuffled.
    """
    pair = ("utm_source", "utm_medium")
    pairs = [
        df.select(*[F.col(f"{prefix}{c}").alias(c) for c in pair]).distinct()
        for df, prefix in ((orders, ""), (journeys, "first_visit_"), (journeys, "last_visit_"))
    ]
    seen = union_all(pairs).distinct()
    named = seen.where(F.col("utm_source").isNotNull() | F.col("utm_medium").isNotNull())
    return unmatched(named, channel_mapping.where(F.col("channel").isNotNull()), pair)


def unreconciled_spend(fact: DataFrame, raw: RawTables, tolerance: float = 0.01) -> DataFrame:
    """Platforms whose total spend in the fact differs from the raw reports."""
    metrics = fn.parse_object(F.col("metrics"), "spend:string")
    totals = {
        "Meta": raw("facebook_marketing", "ads_insights").agg(F.sum("spend").alias("total")),
        "Google Ads": raw("google_ads", "campaign").agg(
            fn.from_micros(F.sum("metrics_cost_micros")).alias("total")
        ),
        "TikTok": raw("tiktok_marketing", "campaigns_reports_daily").agg(
            F.sum(metrics["spend"].cast("double")).alias("total")
        ),
        "LinkedIn": raw("linkedin_ads", "ad_campaign_analytics").agg(
            F.sum("costInUsd").alias("total")
        ),
    }
    sources = union_all(
        [
            df.select(F.lit(platform).alias("platform"), F.col("total").alias("source_spend"))
            for platform, df in totals.items()
        ]
    )
    facts = fact.groupBy("platform").agg(F.sum("spend").alias("fact_spend"))
    zero = F.lit(0.0)
    gap = F.coalesce(F.col("source_spend"), zero) - F.coalesce(
        F.col("fact_spend").cast("double"), zero
    )
    return (
        sources.join(facts, "platform", "full")
        .where(F.abs(gap) > F.lit(tolerance))
        .select("platform", "source_spend", "fact_spend")
    )


class ChecksFailed(Exception):
    """The failed checks of a run, all of them: (table, check, column, failures)."""

    def __init__(self, failures: list[tuple[str, str, str, int]]):
        super().__init__("; ".join(f"{t}: {check} of {column} failed {n} times" for t, check, column, n in failures))
        self.failures = failures


def stop_on(failures: DataFrame) -> None:
    """Raise with every check that has failures. A report has one row per check."""
    found = failures.where("failures > 0").collect()
    if found:
        raise ChecksFailed([tuple(r) for r in found])


def check_raw(raw: RawTables, suite: Mapping[str, Checks] | None = None) -> None:
    """Stop on raw tables that can't be loaded safely."""
    suite = RAW_SUITE if suite is None else suite
    stop_on(report({name: raw(*name.split(".")) for name in suite}, suite))


def check_tables(
    tables: Mapping[str, DataFrame],
    raw: RawTables,
    tolerance: float,
    suite: Mapping[str, Checks] | None = None,
    known: Mapping[str, Mapping[tuple[str, str], int]] | None = None,
) -> None:
    """Stop on the checks of the tables, unmapped UTM pairs and spend that doesn't reconcile.

    ``known`` holds the row checks that were counted while tables were written."""
    suite = SUITE if suite is None else suite
    pairs = unmapped_utm_pairs(
        tables["shopify_orders"], tables["shopify_customer_journeys"], tables["channel_mapping"]
    )
    spend = unreconciled_spend(tables["fct_campaign_performance_daily"], raw, tolerance)
    across = [
        df.agg(F.count("*").alias("failures")).select(
            F.lit(table).alias("table_name"),
            F.lit(check).alias("check_name"),
            F.lit(column).alias("column_name"),
            "failures",
        )
        for table, check, column, df in (
            ("channel_mapping", "all_utm_pairs_mapped", "utm_source, utm_medium", pairs),
            ("fct_campaign_performance_daily", "spend_reconciles", "spend", spend),
        )
    ]
    stop_on(union_all([report(tables, suite, known), *across]))
