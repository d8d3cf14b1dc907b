"""Text columns: tags, ids inside text, classifications, surrogate keys."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: text hashed in place of a null key part.
NULL_KEY_PART = "_dbt_utils_surrogate_key_null_"

# Platform statuses per conformed status.
CAMPAIGN_STATUSES = {
    "active": ("ACTIVE", "ENABLED", "ENABLE"),
    "paused": ("PAUSED", "DISABLE"),
    "removed": ("REMOVED", "DELETED", "ARCHIVED"),
}

# User-agent words per device type; the first match wins.
DEVICE_WORDS = {
    "tablet": ("ipad", "tablet"),
    "mobile": ("mobile", "android"),
}

# Java's \s also holds the vertical tab; name the five characters instead.
_SPACE = r"[\t\n\f\r ]"


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def tidy(text: Column) -> Column:
    """Trim spaces; empty becomes null."""
    return blank_to_null(F.trim(text))


def full_name(*parts: Column) -> Column:
    """Join the non-null parts with a space."""
    return tidy(F.concat_ws(" ", *parts))


def has_tag(tags: Column, tag: str) -> Column:
    """Whether a comma list holds ``tag``; a missing list holds nothing."""
    # Fixed value: a tag stands between commas, with any white space around it.
    pattern = rf"(^|,){_SPACE}*{re.escape(tag)}{_SPACE}*(,|\z)"
    return F.rlike(F.coalesce(tags, F.lit("")), F.lit(pattern))


def strip_prefix(text: Column, word: str) -> Column:
    """Remove a leading ``<word> - ``."""
    # Fixed value: the separator is a hyphen with any white space around it.
    return F.regexp_replace(text, rf"^{re.escape(word)}{_SPACE}*-{_SPACE}*", "")


def list_part(text: Column, position: int, delimiter: str = ",") -> Column:
    """The 1-based part of a delimited list, tidied."""
    return tidy(F.split_part(text, F.lit(delimiter), F.lit(position)))


def id_part(text: Column, position: int, delimiter: str = "_") -> Column:
    """A numeric part of a composite id."""
    return F.split_part(text, F.lit(delimiter), F.lit(position)).cast("bigint")


def urn_id(urn: Column) -> Column:
    r"""Digits at the end of a URN. ``\z``: Java's ``$`` also matches before a newline."""
    return F.regexp_extract(urn, r"(\d+)\z", 1).cast("bigint")


def device_type(user_agent: Column) -> Column:
    """Tablet, mobile or desktop by words in the user agent; null stays null."""
    lowered = F.lower(user_agent)
    result = F.when(user_agent.isNull(), None)
    for device, words in DEVICE_WORDS.items():
        hit = F.lit(False)
        for word in words:
            hit = hit | F.contains(lowered, F.lit(word))
        result = result.when(hit, device)
    return result.otherwise("desktop")


def campaign_status(status: Column) -> Column:
    """Conform a platform's status; unknown values become ``other``."""
    upper = F.upper(status)
    result = None
    for conformed, names in CAMPAIGN_STATUSES.items():
        hit = upper.isin(*names)
        result = F.when(hit, conformed) if result is None else result.when(hit, conformed)
    return result.otherwise("other")


def surrogate_key(*parts: Column) -> Column:
    """MD5 over the parts as text. Never pass a double: its text form varies."""
    texts = [F.coalesce(p.cast("string"), F.lit(NULL_KEY_PART)) for p in parts]
    return F.md5(F.concat_ws("-", *texts))
