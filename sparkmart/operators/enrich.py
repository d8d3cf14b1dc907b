"""Left joins that must not multiply rows, and their checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def guard_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Same rows, but the job fails when a key occurs twice.

    Costs one aggregation on the key, so it is meant for lookups. Large tables
    get the ``unique`` quality check instead.
    """
    rest = [c for c in df.columns if c not in keys]
    grouped = df.groupBy(*keys).agg(
        F.count("*").alias("_n"), F.any_value(F.struct(*rest)).alias("_row")
    )
    message = F.concat(
        F.lit("duplicate lookup key: "), F.concat_ws(", ", *[F.col(k).cast("string") for k in keys])
    )
    checked = F.when(F.col("_n") > 1, F.raise_error(message)).otherwise(F.col("_row"))
    # Filtering on the checked value keeps the guard even if no column is used.
    return (
        grouped.withColumn("_row", checked)
        .where(F.col("_row").isNotNull())
        .select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])
    )


def left_enrich(
    left: DataFrame, right: DataFrame, on: Sequence[str], guard: bool = False
) -> DataFrame:
    """Add the columns of ``right``, which has at most one row per key.

    No broadcast hint: Spark broadcasts a side only when its known size is under
    the threshold, and otherwise sorts and merges; adaptive execution splits a hot
    key on the left, which is allowed because the right key is unique.
    """
    side = guard_unique(right, on) if guard else right
    return left.join(side, list(on), "left")


def unmatched(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``left`` without a partner. Null keys never match, so they stay."""
    return left.join(right.select(*on), list(on), "left_anti")
