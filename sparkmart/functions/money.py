"""Fixed-point money from text, doubles and minor units."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def money(text: Column, precision: int = 12) -> Column:
    """Text (or an exact number) to two decimals."""
    return text.cast(f"decimal({precision},2)")


def money_from_double(amount: Column, precision: int = 12) -> Column:
    """A double to two decimals, rounding the binary product ``amount * 100``.

    A plain cast rounds the shortest decimal text instead, which differs on
    half cents: 1.005 is stored below the half and must give 1.00.
    """
    cents = F.round(amount * F.lit(100.0)).cast(f"decimal({precision},0)")
    return (cents * F.lit("0.01").cast("decimal(2,2)")).cast(f"decimal({precision},2)")


def from_cents(cents: Column) -> Column:
    return cents.cast("double") / F.lit(100.0)


def from_micros(micros: Column) -> Column:
    """Micros as a double: decimal division would round differently later."""
    return micros.cast("double") / F.lit(1000000.0)


def whole(text: Column, kind: str) -> Column:
    """A whole number from text, which may carry decimals: they are rounded."""
    return F.round(text.cast("decimal(38,6)")).cast(kind)
