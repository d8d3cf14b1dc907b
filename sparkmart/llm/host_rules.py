"""Quality rules per document and per host, in DataFrame functions only.

Base rules judge a document by its own words. Then the failures are counted per host, each host's
failure rate is shrunk to the rate of all hosts by a beta prior fitted to the hosts, and documents
of hosts whose shrunk rate is too high go as well. One good page of a bad host is not trusted; a
host with few documents is not condemned for one of them.

Defined results: null text has no words and fails. Documents without a host are judged by the base
rules alone. Repeated rows are counted and returned as often as they come. An empty table gives an
empty result. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .work import Work

#: Fixed by the contract of the base rules.
SPACE = r"\x20\x09-\x0D"
SYMBOL = r"[#*$%&|<>]"
MIN_WORDS, WINDOW, MAX_REPEATED_PERCENT = 10, 5, 20

#: Words that lie in a window of WINDOW words which the text has twice or more. `let` binds a value:
#: transform(array(value), name -> ...)[0] evaluates the value once.
_REPEATED = f"""
transform(array(transform(sequence(0, size(words) - {WINDOW}), i -> xxhash64({", ".join(f"words[i + {j}]" for j in range(WINDOW))}))), grams ->
  if(size(array_distinct(grams)) = size(grams), 0L,
    transform(array(sort_array(transform(grams, (g, i) -> struct(g as g, i as i)))), s ->
      transform(array(sort_array(transform(
          filter(s, (e, j) -> e.g = get(s, j - 1).g or e.g = get(s, j + 1).g), e -> e.i))), p ->
        aggregate(transform(p, (x, j) -> least({WINDOW}, coalesce(get(p, j + 1), x + {WINDOW}) - x)),
                  0L, (a, b) -> a + b))[0])[0]))[0]
"""


@dataclass(frozen=True)
class HostRules:
    """max_rate: hosts whose shrunk failure rate is higher are rejected. least_spread: lower bound
    of the variance between hosts, as a share of the largest possible variance."""

    max_rate: float = 0.5
    least_spread: float = 0.001


def base_measures(docs: DataFrame, host: str = "source") -> DataFrame:
    """Word, symbol and repetition counts of every document, and whether the base rules fail."""
    text = F.coalesce(docs["text"], F.lit(""))
    split = docs.select(
        docs["doc_id"].alias("doc_id"),
        docs[host].alias("host"),
        text.alias("text"),
        F.array_remove(F.split(text, f"[{SPACE}]+"), "").alias("words"),
    )
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(f"[^{SPACE}]"))
    measured = split.select(
        "doc_id",
        "host",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOL)).cast("long").alias("n_symbols"),
        F.transform(F.array(lines), lambda x: F.size(x) - F.size(F.array_distinct(x)))[0].cast("long").alias("n_dup_lines"),
        F.when(F.size("words") > WINDOW, F.expr(_REPEATED)).otherwise(0).cast("long").alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    return measured.withColumn("base_failed", failed)


def host_rates(measures: DataFrame, rules: HostRules = HostRules()) -> DataFrame:
    """Documents, failures and shrunk failure rate of every host.

    The prior has the mean m of all documents and the strength k = m (1 - m) / spread - 1, where
    spread is the variance of the rates between hosts less what chance gives. The driver sees the
    three sums of the prior only.
    """
    hosts = (
        measures.where("host is not null")
        .groupBy("host")
        .agg(F.count("*").alias("n"), F.sum(F.col("base_failed").cast("long")).alias("failed"))
    )
    sums = hosts.agg(
        F.sum("n").alias("n"),
        F.sum("failed").alias("failed"),
        F.count("*").alias("hosts"),
        F.sum(F.col("failed") * F.col("failed") / F.col("n")).alias("squares"),
    ).first()
    n = sums["n"] or 1
    mean = (sums["failed"] or 0) / n
    most = mean * (1 - mean)
    spread = max((sums["squares"] or 0.0) / n - mean * mean - most * sums["hosts"] / n, most * rules.least_spread)
    strength = max(most / spread - 1, 0.0) if spread > 0 else 0.0
    rate = (F.col("failed") + mean * strength) / (F.col("n") + strength)
    return hosts.withColumn("rate", rate)


def judge(spark: SparkSession, docs: DataFrame, host: str = "source", rules: HostRules = HostRules()) -> DataFrame:
    """doc_id, host, the base measures, base_failed and kept.

    The texts are read once: their measures (a few numbers a row) are written, then counted per
    host and joined with the rejected hosts. Counting is partial before the shuffle, so a host with
    a third of all rows is one row a task.
    """
    work = Work(spark)
    measures = work.stored(base_measures(docs, host), "measures")
    rejected = host_rates(measures, rules).where(F.col("rate") > rules.max_rate).select("host", F.lit(True).alias("rejected"))
    joined = measures.join(rejected, "host", "left")
    kept = ~F.col("base_failed") & F.col("rejected").isNull()
    return joined.select(*measures.columns, kept.alias("kept"))
