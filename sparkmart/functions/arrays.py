"""Key/value lists (``array<struct<key, value:struct<...>>>``) as columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def param_value(params: str, key: str, slot: str = "string") -> Column:
    """Value of the first entry named ``key``; ``slot`` picks string, int, float or double.

    Reads the list as two parallel arrays (keys, values of one slot). That stays
    inside generated code and lets the scan skip the slots nobody asks for.
    """
    position = F.array_position(F.col(f"{params}.key"), key)
    return F.get(F.col(f"{params}.value.{slot}_value"), (position - 1).cast("int"))


def pivot_params(params: str, wanted: Mapping[str, tuple[str, str]]) -> dict[str, Column]:
    """Columns for ``{name: (key, slot)}``."""
    return {name: param_value(params, key, slot) for name, (key, slot) in wanted.items()}
