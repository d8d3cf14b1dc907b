"""Weighted rendezvous hashing of stable keys, with a dense slot for every row of a shard.

Every (key, shard) pair gets a uniform number u from their hash; the row goes to the shard with the
largest -weight / ln(u). Key and shards alone decide, each shard gets its weight's share, and a new
shard takes rows only into itself: the numbers of the old shards don't change.

Defined results: null keys hash like one key. A null text has 0 bytes and the checksum of none.
Rows of equal key and text are ordered by their place in the written table. An empty table gives an
empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .work import Work


def shard_of(weights: Sequence[float], *key: Column) -> Column:
    """The shard, 0 to len(weights) - 1, of each key."""

    def score(shard: int, weight: float) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(*key, F.lit(shard)), 11)
        return F.lit(float(weight)) / -F.log((bits + 0.5) / float(2**53))

    scores = [F.struct(score(s, w).alias("score"), F.lit(s).alias("shard")) for s, w in enumerate(weights)]
    return (F.greatest(*scores) if len(scores) > 1 else scores[0])["shard"]


def with_slots(spark: SparkSession, rows: DataFrame, shard: str, order: Sequence[str]) -> DataFrame:
    """rows with slot: their places 0, 1, ... in their shard by the order columns.

    Rows are dealt by ranges of (shard, order, row number), so neither a large shard nor a repeated
    key meets in one task, and written. A row's slot is its place in its partition plus the rows
    that earlier partitions hold of its shard; those counts are bounded by the partitions.
    """
    work = Work(spark)
    rows = work.stored(rows.withColumn("_row", F.monotonically_increasing_id()), "rows")
    keys = [shard, *order, "_row"]
    ordered = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    ordered = work.stored(ordered.withColumn("_row", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("_row", 33).alias("_part")
    counts = ordered.groupBy(shard, part).agg(F.count("*").alias("_n"), F.min("_row").alias("_first"))
    before = Window.partitionBy(shard).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    slot = F.col("_before") + F.col("_row") - F.col("_first")
    joined = ordered.withColumn("_part", part).join(F.broadcast(counts), [shard, "_part"])
    return joined.select(*[c for c in rows.columns if c != "_row"], slot.cast("long").alias("slot"))


def shard_documents(spark: SparkSession, docs: DataFrame, weights: Sequence[float], new_weight: float = 1.0) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and the shard when one more is there."""
    text = F.coalesce(docs["text"], F.lit(""))
    rows = docs.select(
        docs["doc_id"].alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("key").alias("law"),
        shard_of(weights, docs["doc_id"]).alias("shard"),
        shard_of([*weights, new_weight], docs["doc_id"]).alias("grown_shard"),
    )
    return with_slots(spark, rows, "shard", ["doc_id", "text_crc32", "size"])
