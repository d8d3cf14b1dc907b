"""Labelled documents for learning: which rows may be used, and a bounded sample of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .work import Work


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from: crc32 of the doc_id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def sample(work: Work, docs: DataFrame, labels: DataFrame, label: str, per_class: dict[int, int]) -> tuple[DataFrame, dict[int, float]]:
    """doc_id, label and text of at most per_class rows of each class, and what one row stands for.

    Rows are picked by the hash of their doc_id. A document with different labels isn't used. The
    picked ids (bounded by per_class) are broadcast to the documents, whose texts aren't shuffled;
    the sample is written, so the documents are read once.
    """
    known = labels.select(labels["doc_id"].alias("doc_id"), labels[label].alias("label"))
    known = known.where(~held_out(F.col("doc_id")) & F.col("label").isin(list(per_class)))
    known = known.groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("other"))
    known = known.where("doc_id is not null and label = other").select("doc_id", "label")
    totals = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    picked = None
    for value, n in per_class.items():
        rows = known.where(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
        picked = rows if picked is None else picked.unionByName(rows)
    texts = docs.select(docs["doc_id"].alias("doc_id"), F.coalesce(docs["text"], F.lit("")).alias("text"))
    weights = {value: max(1.0, totals.get(value, 0) / n) for value, n in per_class.items()}
    return work.stored(texts.join(F.broadcast(picked), "doc_id"), "sample"), weights


def sigmoid(x):
    import numpy as np

    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))
