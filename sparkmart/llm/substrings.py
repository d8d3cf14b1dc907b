"""Removal of repeated substrings, by fingerprints at the positions of a difference cover.

Every byte that lies in a string of LENGTH bytes which also starts anywhere else goes. Sorting all
suffixes at once would shuffle a key for every byte. No suffix order is built here and no rank in one
is computed, since only equality is asked; what is called a rank is a hash. Instead:

1. Only the suffixes at positions of a difference cover modulo V (12 of 133) are compared first. Any
   two equal strings have an offset below V at which both are in the cover, and there at least
   LENGTH - V + 1 bytes are equal still. So the cover suffixes are dealt to buckets by the hash of
   that many bytes and equal hashes are grouped, each bucket on its own. A suffix that is alone rules out all
   strings around it but those of its other cover positions.
2. In the same pass, long ties are resolved by a rank: the hash of the whole context, V - 1 bytes
   before and LENGTH bytes from the position. Where that is repeated, all strings that reach the
   position from before are repeated, and no longer key of theirs is ever sorted. In long copies
   that settles all but the edges.
3. Strings around cover suffixes that aren't alone and whose rank is, and one representative of
   each repeated rank among the same suffixes, are dealt to buckets by the hash of all LENGTH bytes
   and grouped the same way, one bucket at a time.

Only equality matters here, so buckets are ranges of a hash, not of bytes: no text can make them
uneven but its own repeats, and those are counted once a block. Texts are written once as blocks in
a table bucketed by the task that wrote them; later passes read it without a shuffle, and the
answers (a few bits a key, packed by bucket) come back to it. Keys are 64-bit hashes (rank and
suffix together 87 bits and more, a string 63), and bytes aren't compared: different strings with an
equal key would be taken for a repeat.

Defined results: null and empty texts have nothing to remove; texts shorter than LENGTH neither.
Repeated rows are copies of each other and are removed whole if long enough. An empty table gives
an empty result. Other columns are carried through.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import shuffles_dropped
from . import spans
from .work import Work

LENGTH = 200
#: Perfect difference sets. Every residue but 0 is a difference of two of them once.
COVERS = {
    7: (0, 1, 3),
    13: (0, 1, 3, 9),
    31: (0, 1, 3, 8, 12, 18),
    57: (0, 1, 3, 13, 32, 36, 43, 52),
    73: (0, 1, 3, 7, 15, 31, 36, 54, 63),
    133: (0, 1, 3, 15, 46, 71, 75, 84, 94, 101, 112, 128),
}
#: Keys of a bucket, on average; what one task holds and sorts at a time.
BUCKET_KEYS = 2_000_000
BLOCK_BYTES = 2 << 20
#: Parquet looks at sizes after 100 rows, which here are 200 MB that a writer and a reader would hold.
FEW_BLOCKS = {"compression": "zstd", "parquet.block.row.count.limit": "4", "parquet.page.row.count.limit": "1", "parquet.enable.dictionary": "false"}

ALONE, SETTLED, SETTLED_AND_SHOWN, OPEN = 0, 1, 2, 3
BLOCKS = "part int, seq int, n_bytes long, rows binary"
KEYS = "bucket int, part int, seq int, keys binary"
ANSWERS = "bucket int, part int, seq int, answers binary"


class Cover:
    """Cover positions and keys of the texts of one block."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, length: int):
        self.length, self.offsets, self.n = length, offsets, len(data)
        self.v = max(v for v in COVERS if v <= max(7, 2 * length // 3))
        self.sums = spans.prefix_sums(data)
        sizes = np.diff(offsets)
        long = np.flatnonzero(sizes >= length)
        self.text = long
        least = length - self.v + 1
        at, owner = [], []
        for residue in COVERS[self.v]:
            counts = np.maximum(0, (sizes[long] - least - residue) // self.v + 1)
            owner.append(np.repeat(long, counts))
            at.append((spans.ragged(np.zeros(len(long), np.int64), counts)) * self.v + residue + offsets[owner[-1]])
        self.at, owner = np.concatenate(at), np.concatenate(owner)
        self.low = np.maximum(self.at - self.v + 1, offsets[owner])  # first string that reaches the position
        self.high = np.minimum(self.at, offsets[owner + 1] - length)  # and the last
        suffix = spans.range_hash(self.sums, self.at, self.at + least)
        context = spans.range_hash(self.sums, self.low, self.high + length)
        shape = (self.at - self.low).astype(np.uint64) * np.uint64(1 << 20) + (self.high + length - self.at).astype(np.uint64)
        rank = spans.mix(context + spans.mix(shape))
        order = np.lexsort((rank, suffix))
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(suffix[order]) != 0) | (np.diff(rank[order]) != 0)
        self.first = order[new]  # a position of each different pair
        self.pair = np.empty(len(order), np.int64)
        self.pair[order] = np.cumsum(new) - 1
        self.twice = np.bincount(self.pair, minlength=len(self.first)) > 1
        self.suffix, self.rank = suffix[self.first], rank[self.first]

    def keys(self) -> np.ndarray:
        """40 bits of the suffix, 47 of the rank and whether the pair is there twice, 11 bytes each."""
        packed = np.zeros((len(self.first), 11), np.uint8)
        packed[:, :5] = self.suffix.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]
        tail = (self.rank >> np.uint64(17) << np.uint64(1)) | self.twice.astype(np.uint64)
        packed[:, 5:] = tail.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
        return packed

    def strings(self, answers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether the string at each byte is settled as repeated, and whether its key is needed."""
        code = answers[self.pair]
        settled = _marked(self.low, self.high, code > 0, self.n, (code == SETTLED) | (code == SETTLED_AND_SHOWN))
        shown = code == OPEN
        shown[self.first[answers == SETTLED_AND_SHOWN]] = True
        return settled, _marked(self.low, self.high, code > 0, self.n, shown)


def _marked(low: np.ndarray, high: np.ndarray, ok: np.ndarray, n: int, which: np.ndarray) -> np.ndarray:
    which = which & ok & (high >= low)
    return _covered(low[which], high[which] + 1, n)


def _covered(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Which of n bytes lie in any of the ranges."""
    change = np.bincount(starts, minlength=n + 1)
    change -= np.bincount(ends, minlength=n + 1)
    return np.cumsum(change, out=change)[:n] > 0


def judge_suffixes(parts: list[np.ndarray]) -> list[np.ndarray]:
    """One bucket of cover suffixes: an answer for each key of each block."""
    packed = np.concatenate(parts)
    suffix, tail = np.zeros((len(packed), 8), np.uint8), np.zeros((len(packed), 8), np.uint8)
    suffix[:, :5], tail[:, :6] = packed[:, :5], packed[:, 5:]
    suffix, tail = suffix.view("<u8").reshape(-1), tail.view("<u8").reshape(-1)
    del packed  # two of these run beside the JVM: each array goes as soon as it can
    order = np.lexsort((tail, suffix))
    suffix, tail = suffix[order], tail[order]
    new_suffix = np.ones(len(order), bool)
    new_suffix[1:] = suffix[1:] != suffix[:-1]
    del suffix
    twice = (tail & np.uint64(1)).astype(bool)
    tail >>= np.uint64(1)
    new_rank = new_suffix.copy()
    new_rank[1:] |= tail[1:] != tail[:-1]
    del tail
    starts = np.flatnonzero(new_rank)
    times = np.diff(np.append(starts, len(order)))
    repeated = (times > 1) | np.logical_or.reduceat(twice, starts)
    of_suffix = np.cumsum(new_suffix[starts]) - 1  # of each rank
    ranks = np.bincount(of_suffix)
    lone = np.bincount(of_suffix, ~repeated)
    still_open = (ranks > 1) & (lone > 0)
    code = np.where(ranks > 1, np.uint8(OPEN), np.uint8(ALONE))[of_suffix]
    code[repeated] = SETTLED
    answer = np.repeat(code, times)
    answer[starts[repeated & still_open[of_suffix]]] = SETTLED_AND_SHOWN
    out = np.empty(len(order), np.uint8)
    out[order] = answer
    return np.split(out, np.cumsum([len(x) for x in parts])[:-1])


def judge_strings(parts: list[np.ndarray]) -> list[np.ndarray]:
    """One bucket of whole strings: whether each key is there more than once."""
    packed = np.concatenate(parts)
    times, key = 1 + (packed & np.uint64(1)).astype(np.int64), packed >> np.uint64(1)
    _, place = np.unique(key, return_inverse=True)
    out = (np.bincount(place, times) > 1)[place].astype(np.uint8)
    return np.split(out, np.cumsum([len(x) for x in parts])[:-1])


def bucket_of(key: np.ndarray, buckets: int) -> np.ndarray:
    """The range of its top 24 bits; ascending keys have ascending buckets."""
    return ((key >> np.uint64(40)) * np.uint64(buckets) >> np.uint64(24)).astype(np.int64)


def string_keys(cover: Cover, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different keys of the strings at the places in ascending order, whether each is there twice
    (in the lowest bit), and the key of each place."""
    keys = spans.range_hash(cover.sums, at, at + cover.length) & ~np.uint64(1)
    different, place, counts = np.unique(keys, return_inverse=True, return_counts=True)
    return different | (counts > 1).astype(np.uint64), different, place


def _texts(rows: bytes, text: str) -> tuple[pa.RecordBatch, np.ndarray, np.ndarray]:
    batch = pa.ipc.open_stream(rows).read_next_batch()
    return batch, *spans.text_bytes(batch.column(text))


def _gathered(answers: list, buckets: np.ndarray, n: int) -> np.ndarray:
    """The answers for one block's ascending keys; a bucket that sent none has only zeros."""
    out = np.zeros(n, np.uint8)
    for x in answers or ():
        low = np.searchsorted(buckets, x["bucket"])
        found = np.frombuffer(zlib.decompress(x["answers"]), np.uint8)
        out[low : low + len(found)] = found
    return out


class Substrings:
    """The passes over one table of documents. text: the column to clean."""

    def __init__(self, spark: SparkSession, docs: DataFrame, text: str = "text", length: int = LENGTH):
        self.spark, self.work, self.text, self.length = spark, Work(spark), text, length
        self.blocks = self._blocks(docs)
        total = self.blocks.agg(F.sum("n_bytes").alias("n")).first()["n"] or 0
        self.suffix_buckets = min(1 << 20, 1 + total // (10 * BUCKET_KEYS))  # a tenth of all positions or less
        suffixes = self._answers(self.blocks, self._suffix_keys(), judge_suffixes, self.suffix_buckets, np.uint8, 11)
        self.first = self._with(suffixes, "first")
        self.string_buckets = min(1 << 20, 1 + total // (4 * BUCKET_KEYS))
        strings = self._answers(self.first, self._string_keys(), judge_strings, self.string_buckets, np.uint64, 0)
        self.second = self._with(strings, "second", self.first)

    def _blocks(self, docs: DataFrame) -> DataFrame:
        """Blocks of whole rows, bucketed by the task that wrote them."""
        text = self.text

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            part = TaskContext.get().partitionId()
            for seq, batch in enumerate(spans.sliced(batches, text, BLOCK_BYTES)):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, batch.schema) as stream:
                    stream.write_batch(batch)
                size = int(spans.text_bytes(batch.column(text))[1][-1])
                columns = [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([size], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in BLOCKS.split(", ")])

        name, self.homes = f"llm_blocks_{uuid.uuid4().hex}", int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        writer = docs.mapInArrow(run, BLOCKS).write.format("parquet").options(**FEW_BLOCKS)
        writer.option("path", f"{self.work.dir}/blocks").bucketBy(self.homes, "part").saveAsTable(name)
        blocks = self.spark.table(name)
        self.spark.sql(f"DROP TABLE {name}")  # the name only: the files stay, and the plan has what it needs
        return blocks

    def _answers(self, rows: DataFrame, keys: Callable, judge: Callable, buckets: int, kind: type, width: int) -> DataFrame:
        """Deal the blocks' keys to buckets, judge each bucket, and write what isn't zero."""

        def run(table: pa.Table) -> pa.Table:
            raw = [np.frombuffer(x.as_buffer(), kind) for x in table["keys"]]
            found = judge([x.reshape(-1, width) for x in raw] if width else raw)
            some = [i for i, x in enumerate(found) if x.any()]
            table = table.select(["bucket", "part", "seq"]).take(pa.array(some, pa.int64()))
            return table.append_column("answers", pa.array([zlib.compress(found[i].tobytes(), 1) for i in some], pa.binary()))

        with shuffles_dropped(self.spark):  # the keys of one pass are gone before those of the next are shuffled
            return self.work.stored(rows.mapInArrow(keys, KEYS).groupBy("bucket").applyInArrow(run, ANSWERS), "answers")

    def _with(self, answers: DataFrame, name: str, rows: DataFrame | None = None) -> DataFrame:
        """The blocks with the answers to each: only the answers are shuffled, to where their task's
        blocks lie. A block gets its own alone; as a range, seq isn't a key that would shuffle blocks."""
        rows = self.blocks if rows is None else rows
        dealt = answers.withColumnsRenamed({"part": "home", "seq": "of"}).repartition(self.homes, "home")
        listed = dealt.groupBy("home", "of").agg(F.collect_list(F.struct("bucket", "answers")).alias(name))
        own = (F.col("part") == F.col("home")) & F.col("seq").between(F.col("of"), F.col("of"))
        return rows.join(listed.hint("shuffle_hash"), own, "left").drop("home", "of")

    def _suffix_keys(self) -> Callable:
        text, length, buckets = self.text, self.length, self.suffix_buckets

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part, seq, rows in _each(batches, "part", "seq", "rows"):
                _, data, offsets = _texts(rows, text)
                cover = Cover(data, offsets, length)
                yield _dealt(part, seq, bucket_of(cover.suffix, buckets), cover.keys())

        return run

    def _string_keys(self) -> Callable:
        text, length, suffix_buckets, buckets = self.text, self.length, self.suffix_buckets, self.string_buckets

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part, seq, rows, first in _each(batches, "part", "seq", "rows", "first"):
                _, data, offsets = _texts(rows, text)
                cover = Cover(data, offsets, length)
                answers = _gathered(first, bucket_of(cover.suffix, suffix_buckets), len(cover.suffix))
                _, shown = cover.strings(answers)
                marked, keys, _ = string_keys(cover, np.flatnonzero(shown))
                yield _dealt(part, seq, bucket_of(keys, buckets), marked.reshape(-1, 1).view(np.uint8))

        return run

    def repeated(self) -> Callable:
        """Of a row of `second`: its batch, bytes, offsets and whether each byte is removed."""
        text, length, suffix_buckets, buckets = self.text, self.length, self.suffix_buckets, self.string_buckets

        def judge(rows: bytes, first: list, second: list) -> tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]:
            batch, data, offsets = _texts(rows, text)
            cover = Cover(data, offsets, length)
            answers = _gathered(first, bucket_of(cover.suffix, suffix_buckets), len(cover.suffix))
            strings, shown = cover.strings(answers)
            at = np.flatnonzero(shown)
            _, keys, place = string_keys(cover, at)
            found = _gathered(second, bucket_of(keys, buckets), len(keys)).astype(bool)
            strings[at[found[place]]] = True
            at = np.flatnonzero(strings)
            return batch, data, offsets, _covered(at, at + length, len(data))

        return judge


def _each(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield tuple(batch.column(n)[i].as_py() for n in names)


def _dealt(part: int, seq: int, buckets: np.ndarray, keys: np.ndarray) -> pa.RecordBatch:
    """A row for each bucket with the block's keys for it."""
    found, starts = np.unique(buckets, return_index=True)
    cuts = [*starts.tolist(), len(buckets)]
    packed = [keys[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]
    n = len(found)
    columns = [pa.array(found, pa.int32()), pa.array([part] * n, pa.int32()), pa.array([seq] * n, pa.int32()), pa.array(packed, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in KEYS.split(", ")])


REMOVED = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def removed_bytes(spark: SparkSession, docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row."""
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    found = Substrings(spark, rows, length=length)
    judge = found.repeated()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _each(batches, "rows", "first", "second"):
            batch, data, offsets, gone = judge(*row)
            edge = np.zeros(len(gone) + 1, bool)
            edge[1:-1] = gone[:-1]
            edge[offsets[:-1]] = False  # a run doesn't go on into the next text
            sums = [np.concatenate([[0], np.cumsum(x)]) for x in (gone, gone & ~edge[:-1])]
            n_removed, n_spans = (x[offsets[1:]] - x[offsets[:-1]] for x in sums)
            kept, cuts = data[~gone].tobytes(), (offsets - sums[0][offsets]).tolist()
            hashes = [hashlib.sha256(kept[a:b]).hexdigest() for a, b in zip(cuts, cuts[1:])]
            columns = [batch.column("doc_id"), *(pa.array(x) for x in (np.diff(offsets), n_removed, n_spans)), pa.array(hashes, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in REMOVED.split(", ")])

    return found.second.mapInArrow(run, REMOVED)


def without_repeats(spark: SparkSession, docs: DataFrame, text: str = "text", length: int = LENGTH, n_chars: str | None = None) -> DataFrame:
    """The rows of docs, all columns, with the remaining bytes as text (a character that lost some of
    its bytes goes whole); n_chars names a column that counts them anew."""
    found = Substrings(spark, docs, text, length)
    judge, schema = found.repeated(), docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _each(batches, "rows", "first", "second"):
            batch, data, offsets, gone = judge(*row)
            kept, lost = data[~gone].tobytes(), np.concatenate([[0], np.cumsum(gone)])
            cuts, old = (offsets - lost[offsets]).tolist(), batch.column(text)
            texts = [None if old[i].as_py() is None else kept[a:b].decode("utf-8", "ignore") for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]
            at = batch.schema.get_field_index(text)
            batch = batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))
            if n_chars:
                at = batch.schema.get_field_index(n_chars)
                counts = [None if t is None else len(t) for t in texts]
                batch = batch.set_column(at, batch.schema.field(at), pa.array(counts, batch.schema.field(at).type))
            yield batch

    return found.second.mapInArrow(run, schema)
