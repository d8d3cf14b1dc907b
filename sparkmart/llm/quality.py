"""Quality classifier by compression.

Two zstandard dictionaries are trained, on blocks of good and of bad labelled texts. A text's
blocks are compressed with either; text like the good ones gets smaller with the good dictionary.
Two numbers describe a text: the difference of the two sizes over their sum, and their mean per
byte (text that repeats itself nearly vanishes with either). A logistic curve over both, fitted to
labelled rows that the dictionaries haven't seen, turns them into a score.

Blocks are short, so that the dictionary and not the text's own past decides, and memory doesn't
follow the text's length. Learning takes at most SAMPLE rows of each class.

Defined results: null and empty texts have size 0 and get the score of that point. Without labels
of both classes every score is the share of label 1 (0.5 without labels). Repeated rows get equal
scores. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import spans
from .labelled import held_out, sample, sigmoid
from .work import Work

#: Labelled rows of each class that are learned from at most.
SAMPLE = 8_000
#: Blocks of each class that its dictionary is trained on at most, bytes of a block and a dictionary.
TRAINING_BLOCKS, BLOCK_BYTES, DICTIONARY_BYTES = 16_000, 512, 112 << 10
LEVEL = 3
#: Cells a side of the grid on which the curve is fitted.
CELLS = 400


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    data = zstandard.ZstdCompressionDict(dictionary)
    data.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(dict_data=data, level=LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False)


def train_dictionary(blocks: list[bytes]) -> bytes:
    """A zstandard dictionary; the blocks themselves where they are too few to train one."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, blocks).as_bytes()
    except zstandard.ZstdError:
        return b"".join(blocks)[-DICTIONARY_BYTES:] or b"\n" * 8


@dataclass
class Model:
    """good, bad: dictionaries. curve: weights of 1, the size difference and the size per byte."""

    good: bytes
    bad: bytes
    curve: tuple[float, float, float]

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if not k.startswith("_")}

    def measure(self, text: bytes) -> tuple[float, float]:
        if not hasattr(self, "_good"):
            self._good, self._bad = _compressor(self.good), _compressor(self.bad)
        good = bad = 0
        for at in range(0, len(text), BLOCK_BYTES):
            block = text[at : at + BLOCK_BYTES]
            good += len(self._good.compress(block))
            bad += len(self._bad.compress(block))
        return (bad - good) / (bad + good + 8), (bad + good) / 2 / (len(text) + 8)

    def measures(self, column: pa.Array) -> np.ndarray:
        data, offsets = spans.text_bytes(column)
        data, cuts = data.tobytes(), offsets.tolist()
        return np.array([self.measure(data[a:b]) for a, b in zip(cuts, cuts[1:])], np.float64).reshape(-1, 2)

    def scores(self, column: pa.Array) -> np.ndarray:
        found = self.measures(column)
        return sigmoid(self.curve[0] + found @ np.array(self.curve[1:]))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in spans.sliced(batches):
        data, offsets = spans.text_bytes(batch.column("text"))
        data, cuts, labels = data.tobytes(), offsets.tolist(), batch.column("label").to_pylist()
        found = [(y, data[i : min(i + BLOCK_BYTES, b)]) for y, a, b in zip(labels, cuts, cuts[1:]) for i in range(a, b, BLOCK_BYTES)]
        yield pa.RecordBatch.from_arrays([pa.array([y for y, _ in found], pa.int32()), pa.array([x for _, x in found], pa.binary())], ["label", "block"])


def fit_curve(points: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression by Newton's method with a small ridge, on standardised points."""
    total = weight.sum()
    if total == 0 or not 0 < (weight * label).sum() < total:
        share = np.clip((weight * label).sum() / total if total else 0.5, 1e-3, 1 - 1e-3)
        return float(np.log(share / (1 - share))), 0.0, 0.0
    mean = (weight[:, None] * points).sum(0) / total
    spread = np.sqrt((weight[:, None] * (points - mean) ** 2).sum(0) / total) + 1e-9
    x = np.concatenate([np.ones((len(points), 1)), (points - mean) / spread], axis=1)
    beta = np.zeros(3)
    ridge = np.diag([1e-9, 1.0, 1.0])

    def loss(b: np.ndarray) -> float:
        z = x @ b
        return float((weight * (np.logaddexp(0, z) - label * z)).sum() + b @ ridge @ b / 2)

    for _ in range(60):
        p = sigmoid(x @ beta)
        slope = x.T @ (weight * (label - p)) - ridge @ beta
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge + 1e-9 * np.eye(3), slope)
        size = 1.0
        while size > 1e-6 and loss(beta + size * step) > loss(beta):
            size /= 2
        beta = beta + size * step
        if np.abs(size * step).max() < 1e-9:
            break
    slopes = beta[1:] / spread
    return float(beta[0] - slopes @ mean), float(slopes[0]), float(slopes[1])


def learn(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> Model:
    """Half of the sample trains the dictionaries, the other half fits the curve."""
    rows, weights = sample(Work(spark), docs, labels, "quality", {0: SAMPLE, 1: SAMPLE})
    first = F.xxhash64(F.lit("half"), "doc_id") % 2 == 0
    blocks = rows.where(first).select("label", "text").mapInArrow(_blocks, "label int, block binary")
    dictionaries = []
    for label in (1, 0):
        picked = blocks.where(F.col("label") == label).orderBy(F.xxhash64("block"), "block").limit(TRAINING_BLOCKS)
        dictionaries.append(train_dictionary([bytes(r["block"]) for r in picked.collect()]))
    model = Model(*dictionaries, (0.0, 0.0, 0.0))

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in spans.sliced(batches):
            found = model.measures(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(found[:, 0]), pa.array(found[:, 1])], ["label", "x", "y"])

    points = rows.where(~first).select(F.col("label").cast("int"), "text").mapInArrow(measured, "label int, x double, y double")
    cells = points.groupBy("label", F.floor(F.col("x") * CELLS).alias("i"), F.floor(F.col("y") * CELLS).alias("j"))
    grid = cells.agg(F.count("*").alias("n"), F.avg("x").alias("x"), F.avg("y").alias("y")).collect()  # at most some 10^5 cells
    label = np.array([r["label"] for r in grid], np.float64)
    weight = np.array([r["n"] * weights[r["label"]] for r in grid], np.float64)
    model.curve = fit_curve(np.array([(r["x"], r["y"]) for r in grid], np.float64).reshape(-1, 2), label, weight)
    return model


def score(spark: SparkSession, docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in spans.sliced(batches):
            found = shared.value.scores(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found)], ["doc_id", "score"])

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    scored = rows.mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(spark: SparkSession, docs: DataFrame, model: Model) -> DataFrame:
    """The rows of docs, all columns, that score at least 0.5."""
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in spans.sliced(batches):
            yield batch.filter(pa.array(shared.value.scores(batch.column("text")) >= 0.5))

    return docs.mapInArrow(run, docs.schema)
