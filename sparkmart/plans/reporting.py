"""Reporting plans over the marts: ratios, the channel of an order, the marketing calendar by day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.enrich import guard_unique
from .intermediate import MEASURES

# The channel of orders that no UTM pair assigns to another one, kinds of calendar entries.
UNATTRIBUTED = "Direct / Unattributed"
ENTRY_TYPES = ("promotion", "event", "media_change", "media_flight")


def ratio(part: Column, whole: Column) -> Column:
    """A quotient as a double; null where there is nothing to divide by."""
    return part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))


def campaign_ratios(fact: DataFrame) -> DataFrame:
    """CTR, CPC, CPM and platform ROAS of each campaign, each platform and in total.

    Ratios don't add up, so each level divides its own sums. Days are summed to campaigns first: the
    grouping sets copy one row a campaign instead of one a day. Doubles are summed as decimals, so
    that the order of rows doesn't show.
    """
    exact = {m: F.col(m).cast("decimal(38,6)") if kind == "double" else F.col(m) for m, kind in MEASURES.items()}
    campaigns = fact.groupBy("platform", "campaign_key").agg(*[F.sum(c).alias(m) for m, c in exact.items()])
    p, k = F.col("platform"), F.col("campaign_key")
    levels = campaigns.groupingSets([[p, k], [p], []], p, k).agg(
        F.grouping_id().alias("_level"), *[F.sum(m).alias(m) for m in MEASURES]
    )
    name = F.when(F.col("_level") == 0, "campaign").when(F.col("_level") == 1, "platform").otherwise("total")
    c = F.col
    return levels.select(
        name.alias("level"),
        "platform",
        "campaign_key",
        *[c(m).cast("double").alias(m) if kind == "double" else c(m) for m, kind in MEASURES.items()],
        ratio(c("clicks"), c("impressions")).alias("ctr"),
        ratio(c("spend"), c("clicks")).alias("cpc"),
        (ratio(c("spend"), c("impressions")) * 1000).alias("cpm"),
        ratio(c("platform_conversion_value"), c("spend")).alias("platform_roas"),
    )


def order_channels(orders: DataFrame, channel_mapping: DataFrame) -> DataFrame:
    """One row per order with the channel of its UTM pair.

    A missing source or medium is a value of the pair like any other, so the lookup is null-safe.
    Orders whose pair isn't listed are direct or unattributed and not paid. The lookup is a seed of
    known size, which Spark broadcasts by itself; a pair listed twice stops the run.
    """
    pair = ["utm_source", "utm_medium"]
    lookup = guard_unique(channel_mapping.select(*pair, "channel", "platform", "is_paid"), pair)
    lookup = lookup.withColumnsRenamed({"utm_source": "_source", "utm_medium": "_medium"})
    same = F.col("utm_source").eqNullSafe(F.col("_source")) & F.col("utm_medium").eqNullSafe(F.col("_medium"))
    return orders.select("order_id", "created_at", *pair).join(lookup, same, "left").select(
        "order_id",
        "created_at",
        *pair,
        F.coalesce("channel", F.lit(UNATTRIBUTED)).alias("channel"),
        "platform",
        F.coalesce("is_paid", F.lit(False)).alias("is_paid"),
    )


def calendar_days(calendar: DataFrame) -> DataFrame:
    """One row per calendar entry and day, first and last day included, without a shuffle.

    An entry without an end is one day, one without a start or that ends before it starts is none.
    """
    start, end = F.col("start_date"), F.coalesce("end_date", "start_date")
    days = F.when(end >= start, F.sequence(start, end))
    return calendar.select(
        F.explode(days).alias("date_day"),
        "entry_type",
        "name",
        "start_date",
        "end_date",
        "discount_pct",
        "discount_code",
        "channels",
    )


def calendar_by_day(calendar: DataFrame) -> DataFrame:
    """One row per day that has entries, to join to daily tables: how many entries of each kind
    overlap there, their names, and the deepest discount with its code (ties: the first by code).

    Counts are partial before the shuffle, so a day in very many entries is one row a task; names
    and codes are the distinct ones.
    """
    days = calendar_days(calendar).groupBy("date_day", "discount_pct", "discount_code", "entry_type", "name").agg(
        F.count("*").alias("_n")
    )
    count = lambda kind: F.sum(F.when(F.col("entry_type") == kind, F.col("_n")).otherwise(0))
    best = F.min(F.when(F.col("discount_pct").isNotNull(), F.struct((-F.col("discount_pct")).alias("rank"), "discount_code")))
    return days.groupBy("date_day").agg(
        *[count(kind).alias(f"{kind}s") for kind in ENTRY_TYPES],
        F.array_join(F.array_sort(F.collect_set("name")), "; ").alias("entry_names"),
        F.max("discount_pct").alias("discount_pct"),
        best["discount_code"].alias("discount_code"),
    )
