"""From raw documents to token ids: five stages, each on all that the one before kept.

A document leaves when the quality classifier rejects it, when it is a near copy of a document that
stays, or when benchmark passages make up a twentieth of its words or more. Passages that repeat
across the kept documents are cut out of their texts. The last stage encodes what is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sparkmart.llm import bpe, decontaminate, neardup, quality, substrings
from sparkmart.llm.queries import tokenizer_path
from sparkmart.llm.work import Work, reachable, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score at least 0.5; the labels of the corpus's documents are learned from."""
    model = quality.learn(reachable(spark), docs, table(spark, sf_dir, "labels"))
    return quality.keep_good(spark, docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the one with the smallest doc_id."""
    return neardup.keep_one(reachable(spark), docs)


def repeated_substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without strings of 200 bytes that start anywhere else as well; n_chars is counted anew."""
    return substrings.without_repeats(reachable(spark), docs, n_chars="n_chars")


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that benchmark items don't contaminate."""
    return decontaminate.drop_contaminated(reachable(spark), docs, table(spark, sf_dir, "benchmark"))


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and token_ids."""
    return bpe.encode_documents(reachable(spark), docs, tokenizer_path("byte_bpe_50k.json"), with_ids=True)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("near_duplicates", near_duplicates),
    ("repeated_substrings", repeated_substrings),
    ("benchmark_decontamination", benchmark_decontamination),
    ("bpe_encoding", bpe_encoding),
]

#: SQL can express neither a trained classifier nor byte-pair merges; tests/llm compares every stage
#: with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's rows are written and read again by the next."""
    work, docs = Work(reachable(spark)), table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = work.stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
