"""Union of per-platform tables in one schema."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by column name, in halves: a long chain is slow to analyse."""
    if len(frames) == 1:
        return frames[0]
    middle = len(frames) // 2
    return union_all(frames[:middle]).unionByName(union_all(frames[middle:]))


def conform_union(
    branches: Mapping[str, DataFrame], columns: Mapping[str, str], label: str = "platform"
) -> DataFrame:
    """UNION ALL of the branches with a label column.

    Every branch is cast before the union: left to itself the union of a text id
    and a numeric id becomes numeric.
    """

    def cast(name: str, df: DataFrame) -> DataFrame:
        typed = [F.col(c).cast(kind).alias(c) for c, kind in columns.items()]
        return df.select(F.lit(name).alias(label), *typed)

    return union_all([cast(name, df) for name, df in branches.items()])

