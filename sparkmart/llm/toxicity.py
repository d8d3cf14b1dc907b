"""Toxicity by subword bags.

A word is the mean of the vectors of its letter sequences (3 to 6 bytes of `<word>`, and the whole);
a window of WINDOW words is the mean of its different words' vectors, and a linear softmax over
that mean says how toxic the window is. Vectors and softmax are trained together in numpy on
documents: a document is as toxic as its worst windows, which a soft maximum weighs. A misspelt word
shares most of its sequences with the word that was learned.

Only sequences whose share of toxic and other training documents differs by MIN_Z standard
deviations get a vector; all others stay zero, so rare sequences can't memorise their documents.
Spark counts the sequences; the driver gets the kept ones and the windows that hold any.

Defined results: words are letters and digits with A-Z in lower case; null and empty texts get the
score of a window without vectors. Without labels of both classes every score is the share of
label 1 (0 without labels). Repeated rows get equal scores. An empty table gives an empty result.
Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import spans
from .labelled import held_out, sample, sigmoid
from .work import Work

#: Labelled rows of each class that are learned from at most.
SAMPLE = {1: 2_000, 0: 4_000}
WINDOW, SIZES, BUCKET_BITS, DIMENSIONS = 24, (3, 4, 5, 6), 20, 4
MIN_Z, MIN_DOCUMENTS, EPOCHS, RATE = 5.0, 4, 300, 0.2
THRESHOLD = 0.7


def different_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes `<word>` of each different word with their offsets, the word of each place, the
    window of each place and the n + 1 window offsets of the texts (a text has one at least)."""
    data, offsets = spans.text_bytes(column)
    data = spans.LOWER[data]
    starts, ends, words = spans.word_spans(data, offsets, spans.LETTERS)
    keys = spans.range_hash(spans.prefix_sums(data), starts, ends)
    _, first, code = np.unique(keys, return_index=True, return_inverse=True)
    lengths = (ends - starts)[first]
    marked = np.zeros(len(first) + 1, np.int64)
    np.cumsum(lengths + 2, out=marked[1:])
    text = np.full(marked[-1], ord("<"), np.uint8)
    text[marked[1:] - 1] = ord(">")
    text[spans.ragged(marked[:-1] + 1, lengths)] = data[spans.ragged(starts[first], lengths)]
    counts = np.diff(words)
    windows = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(np.maximum(1, -(-counts // WINDOW)), out=windows[1:])
    owner = spans.owner(words)
    place = (np.arange(len(code)) - words[owner]) // WINDOW + windows[owner]
    return text, marked, code, place, windows


def sequences(text: np.ndarray, marked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The word and the bucket of every sequence."""
    sums, lengths = spans.prefix_sums(text), np.diff(marked)
    words, buckets = [np.arange(len(lengths))], [spans.range_hash(sums, marked[:-1], marked[1:])]
    for n in SIZES:
        counts = np.maximum(0, lengths - n + 1)
        counts[lengths == n] = 0  # that is the whole word
        starts = spans.ragged(marked[:-1], counts)
        words.append(np.repeat(np.arange(len(lengths)), counts))
        buckets.append(spans.range_hash(sums, starts, starts + n))
    keys = np.concatenate(buckets) >> np.uint64(64 - BUCKET_BITS)
    return np.concatenate(words), keys.astype(np.int64)


def _document_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The different buckets of each document."""
    for batch in spans.sliced(batches, limit=spans.SLICE_BYTES // 4):
        text, marked, code, place, windows = different_words(batch.column("text"))
        word, bucket = sequences(text, marked)
        order = np.argsort(word, kind="stable")
        bucket, sizes = bucket[order], np.bincount(word, minlength=len(marked) - 1)
        doc = np.searchsorted(windows, place, "right") - 1
        pairs = np.unique((doc << 32) | code) if len(code) else np.zeros(0, np.int64)
        doc, code = pairs >> 32, pairs & 0xFFFFFFFF
        starts = np.cumsum(sizes) - sizes
        pairs = np.unique((np.repeat(doc, sizes[code]) << 32) | bucket[spans.ragged(starts[code], sizes[code])]) if len(code) else pairs
        labels = batch.column("label").take(pa.array(pairs >> 32))
        yield pa.RecordBatch.from_arrays([labels, pa.array(pairs & 0xFFFFFFFF)], ["label", "bucket"])


@dataclass
class Model:
    """bias and what each bucket adds to the toxic logit, before the means."""

    bias: float
    buckets: np.ndarray

    def scores(self, column: pa.Array) -> np.ndarray:
        text, marked, code, place, windows = different_words(column)
        word, bucket = sequences(text, marked)
        n = len(marked) - 1
        value = np.bincount(word, self.buckets[bucket], n) / np.maximum(np.bincount(word, minlength=n), 1)
        pairs = np.unique((place << 32) | code) if len(code) else np.zeros(0, np.int64)
        logit = np.bincount(pairs >> 32, value[pairs & 0xFFFFFFFF], windows[-1]) / WINDOW
        if not len(windows) - 1:
            return np.zeros(0)
        return sigmoid(self.bias + np.maximum.reduceat(logit, windows[:-1]))


def train(label: np.ndarray, weight: np.ndarray, doc: np.ndarray, bags: tuple, words: tuple, features: int) -> tuple[float, np.ndarray]:
    """Softmax weights and sequence vectors by gradient descent with adaptive steps.

    doc: the document of each window. bags: window and word of each word in a window; words: word,
    feature and share of each sequence of a word. Windows are means of words, words of sequences.
    Returns the bias and each feature's addition to the toxic logit.
    """
    rng = np.random.default_rng(1)
    window, word = bags
    of, feature, share = words
    n_words = int(of.max()) + 1 if len(of) else 0
    vectors = rng.normal(0, 0.01, (features, DIMENSIONS))
    softmax = np.stack([-np.ones(DIMENSIONS), np.ones(DIMENSIONS)], axis=1) / 2 + rng.normal(0, 0.01, (DIMENSIONS, 2))
    toxic = (weight * label).sum() / weight.sum()
    bias = np.array([0.0, np.log(toxic / (1 - toxic))])
    parameters = [vectors, softmax, bias]
    means, squares = [np.zeros_like(p) for p in parameters], [np.zeros_like(p) for p in parameters]
    norm = weight.sum()

    def gathered(index: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
        return np.stack([np.bincount(index, rows[:, j], n) for j in range(rows.shape[1])], axis=1)

    for epoch in range(1, EPOCHS + 1):
        meaning = gathered(of, vectors[feature] * share[:, None], n_words)
        mean = gathered(window, meaning[word], len(doc)) / WINDOW
        logits = mean @ softmax + bias
        logit = logits[:, 1] - logits[:, 0]
        top = np.full(len(label), -np.inf)
        np.maximum.at(top, doc, logit)
        soft = np.exp(logit - top[doc])
        soft /= np.bincount(doc, soft, len(label))[doc]
        total = np.bincount(doc, soft * logit, len(label))
        slope = ((sigmoid(total) - label) * weight / norm)[doc] * soft
        both = np.stack([-slope, slope], axis=1)
        back = gathered(word, (both @ softmax.T / WINDOW)[window], n_words)
        gradients = [gathered(feature, back[of] * share[:, None], features), mean.T @ both, both.sum(0)]
        for p_, g, m, s in zip(parameters, gradients, means, squares):
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            p_ -= RATE * (m / (1 - 0.9**epoch)) / (np.sqrt(s / (1 - 0.99**epoch)) + 1e-9)
    return float(bias[1] - bias[0]), vectors @ (softmax[:, 1] - softmax[:, 0])


def learn(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> Model:
    rows, weights = sample(Work(spark), docs, labels, "toxic", SAMPLE)
    rows = rows.select(F.col("label").cast("int").alias("label"), "text")
    n = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    table = np.zeros(1 << BUCKET_BITS)
    if not n.get(0) or not n.get(1):
        share = np.clip(1.0 if n.get(1) else 0.0, 1e-3, 1 - 1e-3)
        return Model(float(np.log(share / (1 - share))), table)
    counts = rows.mapInArrow(_document_buckets, "label int, bucket long").groupBy("bucket").agg(F.sum("label").alias("bad"), F.count("*").alias("n"))
    both = F.col("n") / (n[0] + n[1])
    z = (F.col("bad") / n[1] - (F.col("n") - F.col("bad")) / n[0]) / F.sqrt(both * (1 - both) * (1 / n[0] + 1 / n[1]))
    kept = counts.where((F.col("n") >= MIN_DOCUMENTS) & (both < 1) & (F.abs(z) >= MIN_Z)).select("bucket").orderBy("bucket")
    kept = np.array([r["bucket"] for r in kept.collect()], np.int64)  # at most 2**BUCKET_BITS
    place_of = np.full(1 << BUCKET_BITS, -1, np.int32)
    place_of[kept] = np.arange(len(kept))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each document its label; the window and the word (by hash) of its different words in
        each window that hold a kept sequence; and word, feature and share of those sequences."""
        for batch in spans.sliced(batches, limit=spans.SLICE_BYTES // 4):
            text, marked, code, place, windows = different_words(batch.column("text"))
            names = spans.range_hash(spans.prefix_sums(text), marked[:-1], marked[1:]).view(np.int64)
            word, bucket = sequences(text, marked)
            sizes = np.bincount(word, minlength=len(names))
            order = np.argsort(word, kind="stable")
            word, at = word[order], place_of[bucket[order]]
            word, at = word[at >= 0], at[at >= 0]
            held = np.bincount(word, minlength=len(names))
            starts = np.cumsum(held) - held
            some = held[code] > 0
            pairs = np.unique((place[some] << 32) | code[some])
            window, code = pairs >> 32, pairs & 0xFFFFFFFF
            doc = np.searchsorted(windows, window, "right") - 1
            own = np.unique((doc << 32) | code)  # the different words of each document
            of, own = own >> 32, own & 0xFFFFFFFF
            parts = held[own]
            entry = spans.ragged(starts[own], parts)
            cuts = [np.searchsorted(x, np.arange(batch.num_rows + 1)) for x in (doc, np.repeat(of, parts))]
            values = ((0, window - windows[doc]), (0, names[code]), (1, np.repeat(names[own], parts)), (1, at[entry]), (1, np.repeat(1 / sizes[own], parts)))
            lists = [pa.ListArray.from_arrays(pa.array(cuts[k], pa.int32()), pa.array(x)) for k, x in values]
            yield pa.RecordBatch.from_arrays([batch.column("label"), *lists], ["label", "window", "word", "of", "feature", "share"])

    kinds = "label int, window array<long>, word array<long>, of array<long>, feature array<int>, share array<double>"
    got = rows.mapInArrow(features, kinds).toArrow()
    label = got["label"].to_numpy().astype(np.float64)
    flat = {k: pa.concat_arrays([c.flatten() for c in got[k].chunks]).to_numpy() for k in got.column_names[1:]}
    sizes = pa.compute.list_value_length(got["window"]).to_numpy()
    owner = np.repeat(np.arange(len(label)), sizes)
    # windows without kept sequences are all the same: one of them stands for those of a document
    pairs, window = np.unique((owner << 32) | flat["window"], return_inverse=True)
    doc = np.concatenate([pairs >> 32, np.arange(len(label))])
    entries = np.unique(np.stack([flat["of"], flat["feature"].astype(np.int64), flat["share"].view(np.int64)]), axis=1)
    names, of = np.unique(entries[0], return_inverse=True)
    word = np.searchsorted(names, flat["word"])
    # between the corpus's share of toxic documents and a half: missing one costs more than its share
    weight = np.where(label == 1, np.sqrt(weights[1] / n[1]), np.sqrt(weights[0] / n[0]))
    bias, added = train(label, weight, doc, (window, word), (of, entries[1], entries[2].view(np.float64)), max(1, len(kept)))
    table[kept] = added[: len(kept)]
    return Model(bias, table)


def score(spark: SparkSession, docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in spans.sliced(batches):
            found = shared.value.scores(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found)], ["doc_id", "score"])

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    scored = rows.mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
