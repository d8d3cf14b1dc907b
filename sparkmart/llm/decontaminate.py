"""Benchmark decontamination by winnowed fingerprints.

A window is 13 consecutive words of a benchmark item; a shorter item is one window. Of every run of
WINDOW - K + 1 consecutive K-word hashes the smallest is kept (all places with the smallest value).
A shared window holds the same run on both sides, so it has at least one kept fingerprint in
common: no shared window is missed. Matching fingerprints are extended: every window of the
document around one is compared with the benchmark's windows. Items of fewer than K words are
compared at every place instead, which is the same with K = their length.

The benchmark's fingerprints are broadcast up to MAX_BROADCAST of them (8 bytes each); documents
are then read once and never shuffled. Beyond that, document fingerprints and windows are joined
with the benchmark's by Spark.

Defined results: null and empty texts have no words, no hits and no items; words are compared with
A-Z in lower case. Repeated document rows are judged one by one; repeated items count once. Null
item ids are left out of the items. An empty benchmark hits nothing. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import spans
from .work import Work

#: Words of a window, fixed by the contract, and of a fingerprint.
WINDOW, K = 13, 7
#: Windows of the benchmark that are broadcast at most: at 64 bytes a window with its items, 128 MB.
MAX_BROADCAST = 2_000_000

WINDOWS = "item_id long, length int, hash long"
VERDICT = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


def item_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every window of every item: its words and its hash."""
    for batch in spans.sliced(batches):
        words, offsets = spans.word_hashes(batch.column("text"), spans.LETTERS)
        counts = np.diff(offsets)
        out = []
        for n in np.unique(np.minimum(counts, WINDOW)):
            if n:
                of = np.flatnonzero(np.minimum(counts, WINDOW) == n)
                starts = spans.ragged(offsets[of], counts[of] - n + 1)
                item = np.repeat(of, counts[of] - n + 1)
                out.append((item, np.full(len(item), n), spans.gram_hashes(words, n)[starts]))
        if out:
            item, length, key = (np.concatenate(x) for x in zip(*out))
            columns = [batch.column("item_id").take(pa.array(item)), pa.array(length, pa.int32()), pa.array(key.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["item_id", "length", "hash"])


def item_fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Kept K-word hashes of the items that have a whole window."""
    for batch in spans.sliced(batches):
        words, offsets = spans.word_hashes(batch.column("text"), spans.LETTERS)
        _, key = winnow(words, offsets)
        yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64))], ["hash"])


def winnow(words: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of the hashes that are smallest in a run of WINDOW - K + 1 of one text."""
    grams = spans.gram_hashes(words, K)
    run = WINDOW - K + 1
    if len(grams) < run:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    least = np.lib.stride_tricks.sliding_window_view(grams, run).min(axis=1)
    counts = np.diff(offsets)
    full = np.flatnonzero(counts >= WINDOW)
    starts = spans.ragged(offsets[full], counts[full] - WINDOW + 1)  # runs inside one text
    kept = np.zeros(len(grams), bool)
    for j in range(run):
        kept[starts[grams[starts + j] == least[starts]] + j] = True
    places = np.flatnonzero(kept)
    return places, grams[places]


def _member(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return table[at] == values


def candidate_windows(words: np.ndarray, offsets: np.ndarray, prints: np.ndarray | None, lengths: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places, lengths and hashes of the document windows to compare: those around a place where a
    fingerprint of the benchmark matched (around every one if prints is None), and every window of
    the given lengths below WINDOW."""
    counts = np.diff(offsets)
    places, values = winnow(words, offsets)
    if prints is not None:
        places = places[_member(values, prints)]
    last = np.zeros(len(words) + 1, np.int64)  # first word after the text of each word
    last[:-1] = np.repeat(offsets[1:], counts)
    first = np.repeat(offsets[:-1], counts)
    low = np.maximum(places - (WINDOW - K), first[places])
    high = np.minimum(places, last[places] - WINDOW)
    inside = high >= low
    near = np.zeros(len(words) + 1, np.int64)
    np.add.at(near, low[inside], 1)
    np.add.at(near, high[inside] + 1, -1)
    starts = np.flatnonzero(np.cumsum(near[:-1]) > 0)
    out = [(starts, np.full(len(starts), WINDOW), spans.gram_hashes(words, WINDOW)[starts])]
    for n in lengths:
        if n < WINDOW:
            full = np.flatnonzero(counts >= n)
            starts = spans.ragged(offsets[full], counts[full] - n + 1)
            out.append((starts, np.full(len(starts), n), spans.gram_hashes(words, n)[starts]))
    return tuple(np.concatenate(x) for x in zip(*out))


def covered(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """Whether each of n words lies in one of the windows."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + lengths, -1)
    return np.cumsum(change[:-1]) > 0


def _digest(items) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


NO_ITEMS = _digest([])


def _judged(doc_ids: pa.Array, counts: np.ndarray, hits: np.ndarray, items: list[set[str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            doc_ids.cast(pa.int64()),
            pa.array(counts.astype(np.int64)),
            pa.array(hits.astype(np.int64)),
            pa.array([len(x) for x in items], pa.int64()),
            pa.array([_digest(x) if x else NO_ITEMS for x in items]),
            pa.array((hits > 0) & (20 * hits >= counts)),
        ],
        [x.split()[0] for x in VERDICT.split(", ")],
    )


class Matcher:
    """Judges whole batches of documents against a broadcast benchmark."""

    def __init__(self, prints: np.ndarray, keys: np.ndarray, lengths: np.ndarray, items: np.ndarray):
        order = np.lexsort((lengths, keys))
        self.prints = np.unique(prints)
        self.keys, self.lengths, self.items = keys[order], lengths[order], items[order]
        self.short = sorted({int(n) for n in lengths if n < WINDOW})

    def judge(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, list[set[str]]]:
        words, offsets = spans.word_hashes(batch.column("text"), spans.LETTERS)
        items: list[set[str]] = [set()] * batch.num_rows
        starts, lengths, keys = candidate_windows(words, offsets, self.prints, self.short)
        # the hash covers the length, so equal hashes mean equal windows
        low, high = np.searchsorted(self.keys, keys, "left"), np.searchsorted(self.keys, keys, "right")
        found = high > low
        starts, lengths, low, high = starts[found], lengths[found], low[found], high[found]
        hit = covered(starts, lengths, len(words))
        sums = np.concatenate([[0], np.cumsum(hit)])
        doc = np.searchsorted(offsets, starts, "right") - 1
        pairs = np.unique(np.stack([doc, low, high]), axis=1) if len(doc) else np.zeros((3, 0), int)
        for d, a, b in pairs.T.tolist():
            items[d] = items[d] | set(self.items[a:b].tolist())
        return np.diff(offsets), sums[offsets[1:]] - sums[offsets[:-1]], items


def _benchmark(spark: SparkSession, benchmark: DataFrame, work: Work) -> tuple[DataFrame, DataFrame]:
    items = benchmark.select(benchmark["item_id"].alias("item_id"), benchmark["text"].alias("text"))
    windows = work.stored(items.mapInArrow(item_windows, WINDOWS).distinct(), "windows")
    prints = work.stored(items.mapInArrow(item_fingerprints, "hash long").distinct(), "fingerprints")
    return windows, prints


def matcher(windows: DataFrame, prints: DataFrame) -> Matcher:
    table = windows.toArrow()
    keys = table["hash"].to_numpy().view(np.uint64)
    items = np.array(["" if x is None else str(x) for x in table["item_id"].to_pylist()], object)
    return Matcher(prints.toArrow()["hash"].to_numpy().view(np.uint64), keys, table["length"].to_numpy(), items)


def judge(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """VERDICT columns of every document."""
    work = Work(spark)
    windows, prints = _benchmark(spark, benchmark.where("item_id is not null"), work)
    docs = docs.select(docs["doc_id"].alias("doc_id"), docs["text"].alias("text"))
    if windows.count() > max_broadcast:
        return _judge_joined(work, docs, windows, prints)
    shared = spark.sparkContext.broadcast(matcher(windows, prints))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in spans.sliced(batches):
            yield _judged(batch.column("doc_id"), *shared.value.judge(batch))

    return docs.mapInArrow(run, VERDICT)


def drop_contaminated(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs, all columns, that are not contaminated."""
    work = Work(spark)
    windows, prints = _benchmark(spark, benchmark.where("item_id is not null"), work)
    if windows.count() > MAX_BROADCAST:
        numbered = work.stored(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered")
        verdict = _judge_joined(work, numbered.select(F.col("_row").alias("doc_id"), "text"), windows, prints)
        return numbered.join(verdict.where("contaminated").select(F.col("doc_id").alias("_row")), "_row", "left_anti").drop("_row")
    shared = spark.sparkContext.broadcast(matcher(windows, prints))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in spans.sliced(batches):
            counts, hits, _ = shared.value.judge(batch)
            yield batch.filter(pa.array((hits == 0) | (20 * hits < counts)))

    return docs.mapInArrow(run, docs.schema)


def _judge_joined(work: Work, docs: DataFrame, windows: DataFrame, prints: DataFrame) -> DataFrame:
    """The same by shuffled joins, for a benchmark of any size: fingerprints of the documents meet
    those of the benchmark, then the windows around the matches meet its windows."""
    lengths = sorted(r[0] for r in windows.where(F.col("length") < WINDOW).select("length").distinct().collect())
    docs = work.stored(docs.withColumn("_row", F.monotonically_increasing_id()), "documents")

    def fingerprints(batches):
        for batch in spans.sliced(batches):
            words, offsets = spans.word_hashes(batch.column("text"), spans.LETTERS)
            places, values = winnow(words, offsets)
            rows = batch.column("_row").take(pa.array(np.searchsorted(offsets, places, "right") - 1))
            yield pa.RecordBatch.from_arrays([rows, pa.array(values.view(np.int64))], ["_row", "hash"])

    def all_windows(batches):
        for batch in spans.sliced(batches):
            words, offsets = spans.word_hashes(batch.column("text"), spans.LETTERS)
            starts, length, keys = candidate_windows(words, offsets, None, lengths)
            doc = np.searchsorted(offsets, starts, "right") - 1
            columns = [batch.column("_row").take(pa.array(doc)), pa.array(starts - offsets[doc]), pa.array(length, pa.int32()), pa.array(keys.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["_row", "start", "length", "hash"])

    def count(batches):
        for batch in spans.sliced(batches):
            _, offsets = spans.word_hashes(batch.column("text"), spans.LETTERS)
            yield pa.RecordBatch.from_arrays([batch.column("_row"), batch.column("doc_id").cast(pa.int64()), pa.array(np.diff(offsets))], ["_row", "doc_id", "n_words"])

    near = docs.mapInArrow(fingerprints, "_row long, hash long").join(prints, "hash", "left_semi").select("_row").distinct()
    near = docs if lengths else docs.join(near, "_row", "left_semi")
    places = near.mapInArrow(all_windows, "_row long, start long, length int, hash long")
    found = work.stored(places.join(windows.select("hash").distinct(), "hash", "left_semi"), "found")
    # a document's own hits: each window once, so rows are bounded by its words
    reach = F.max(F.col("start") + F.col("length"))
    per_start = found.groupBy("_row", "start").agg(reach.alias("stop"))
    before = Window.partitionBy("_row").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    new = F.greatest(F.lit(0), F.col("stop") - F.greatest("start", F.coalesce(F.max("stop").over(before), F.lit(0))))
    hits = per_start.withColumn("new", new).groupBy("_row").agg(F.sum("new").alias("n_hit"))
    items = found.select("_row", "hash").distinct().join(windows.select("hash", "item_id"), "hash").select("_row", "item_id").distinct()
    items = items.groupBy("_row").agg(F.array_sort(F.collect_list(F.col("item_id").cast("string"))).alias("items"))
    counts = docs.mapInArrow(count, "_row long, doc_id long, n_words long")
    n_hit, ids = F.coalesce("n_hit", F.lit(0)), F.coalesce("items", F.array().cast("array<string>"))
    return counts.join(hits, "_row", "left").join(items, "_row", "left").select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
    )
