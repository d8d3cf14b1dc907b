"""Mart plans: the campaign dimension and the daily performance fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.enrich import left_enrich
from .intermediate import MEASURES

# Fixed value: initiative of campaigns that run all year.
ALWAYS_ON = "Always-on"


def dim_campaigns(campaigns: DataFrame, attributes: DataFrame) -> DataFrame:
    """One row per campaign with its business classification."""
    joined = left_enrich(
        campaigns, attributes.drop("campaign_name"), ["platform", "campaign_id"], guard=True
    )
    return joined.select(
        "campaign_key",
        "platform",
        "campaign_id",
        "campaign_name",
        "account_id",
        "channel",
        "campaign_tactic",
        "initiative_name",
        (F.col("initiative_name") == ALWAYS_ON).alias("is_always_on"),
        "campaign_status",
        "platform_campaign_status",
    )


def fct_campaign_performance_daily(performance: DataFrame, campaigns: DataFrame) -> DataFrame:
    """One row per campaign and day, with the campaign's attributes copied in."""
    attributes = (
        "channel",
        "campaign_name",
        "campaign_tactic",
        "initiative_name",
        "is_always_on",
    )
    joined = left_enrich(
        performance, campaigns.select("campaign_key", *attributes), ["campaign_key"]
    )
    return joined.select(
        "date_day",
        "campaign_key",
        "platform",
        "channel",
        "campaign_id",
        "campaign_name",
        "campaign_tactic",
        "initiative_name",
        "is_always_on",
        *MEASURES,
    )
