"""URL columns: query parameters, path, referrer domain."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import blank_to_null

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def percent_decode(text: Column) -> Column:
    """Decode ``%XX`` escapes; ``+`` and malformed escapes stay as they are.

    The built-in decoder also turns ``+`` into a space and rejects a bad escape,
    so both are escaped first. Values without ``%`` skip the decoder.
    """
    plus_kept = F.replace(text, F.lit("+"), F.lit("%2B"))
    bad_kept = F.regexp_replace(plus_kept, "%(?![0-9A-Fa-f]{2})", "%25")
    return F.when(F.contains(text, F.lit("%")), F.url_decode(bad_kept)).otherwise(text)


def url_param(url: Column, name: str) -> Column:
    """One query parameter, name matched in any case, decoded, null when absent or empty.

    Most URLs lack most parameters; the plain text test spares them the pattern.
    """
    # Fixed value: a parameter ends at the next & or #.
    raw = F.regexp_extract(url, f"(?i)[?&]{re.escape(name)}=([^&#]*)", 1)
    maybe = F.contains(F.lower(url), F.lit(f"{name.lower()}="))
    return F.when(maybe, blank_to_null(percent_decode(raw)))


def url_params(url: Column, wanted: Mapping[str, str]) -> dict[str, Column]:
    """Many parameters of one URL: ``{column: parameter}``, each as ``url_param`` gives it.

    The URL is split once into parallel arrays of names and values, which every
    column then looks up. A value is only looked at, not consumed, so that a
    ``?`` in it begins a name too.
    """
    # Fixed value: a parameter starts after ? or & and ends at the next & or #.
    pattern = F.lit("[?&]([^=?&]*)=(?=([^&#]*))")
    names = F.regexp_extract_all(F.translate(url, _UPPER, _UPPER.lower()), pattern, F.lit(1))
    values = F.regexp_extract_all(url, pattern, F.lit(2))

    def value(name: str) -> Column:
        position = F.array_position(names, name.lower())
        return blank_to_null(percent_decode(F.get(values, (position - 1).cast("int"))))

    return {column: value(name) for column, name in wanted.items()}


def before_query(url: Column) -> Column:
    """The part before ``?``."""
    return F.split_part(url, F.lit("?"), F.lit(1))


def without_query_and_fragment(url: Column) -> Column:
    """The part before ``?`` and before ``#``."""
    return F.split_part(before_query(url), F.lit("#"), F.lit(1))


def referrer_domain(url: Column) -> Column:
    """Host (and port) of an http(s) URL, else null."""
    # Fixed value: what counts as the host of a referrer.
    return blank_to_null(F.regexp_extract(url, "^https?://([^/]+)", 1))
