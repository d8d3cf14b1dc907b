"""Token ids of documents in packed files, and reading them back.

A file holds the ids of consecutive documents in ascending doc_id order. Every id takes the least
number of bits that the vocabulary needs. 64 ids are one group of `bits` 64-bit words, so packing
and unpacking are a few vector operations, and a block is a fixed number of groups:

    header   8 int64: magic, bits, ids, documents, documents without doc_id, block ids, blocks, end id
    doc ids  int64 for each document, those without one first (as 0)
    starts   int64 for each document and one more: its first id in the file
    offsets  int64 for each block and one more: its first byte after this table
    blocks   packed ids; the last block is filled up with zeros to a whole group

Files are stored as rows of a Parquet table: Spark's commit protocol then guards them against lost
tasks, and any file system that Spark reaches can hold them. `read_ids` opens only the blocks that
a range of ids touches.

Defined results: null and empty texts are the end id alone. Rows without doc_id come first. Rows
of equal doc_id are ordered by the hash of their text. An empty table gives no file and an empty
result. Other columns are ignored.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import spans
from .work import Work

MAGIC, BLOCK_IDS = 0x314B4F54, 1 << 16
#: A file is closed once it holds so many ids.
FILE_IDS = 1 << 20
#: Words whose ids a worker remembers at most (about 200 bytes each).
MAX_WORDS = 600_000
#: Frequent words that are encoded beforehand at most, texts that they are counted in, and bytes of one.
LEXICON, SAMPLE, LONGEST = 400_000, 20_000, 64
#: ASCII characters that are neither space nor letter nor digit, and letters and digits.
IS_MARK, IS_ALNUM = (np.array([b < 127 and b > 32 and chr(b).isalnum() == wanted for b in range(256)]) for wanted in (False, True))

FILES = "part int, start long, n_ids long, n_docs long, payload binary"


def bits_for(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> np.ndarray:
    """ids in groups of 64, each of `bits` words."""
    groups = -(-len(ids) // 64)
    full = np.zeros(groups * 64, np.uint64)
    full[: len(ids)] = ids
    full, out = full.reshape(groups, 64), np.zeros((groups, bits), np.uint64)
    for j in range(64):
        word, shift = divmod(j * bits, 64)
        out[:, word] |= full[:, j] << np.uint64(shift)
        if shift + bits > 64:
            out[:, word + 1] |= full[:, j] >> np.uint64(64 - shift)
    return out.reshape(-1)


def unpack(words: np.ndarray, bits: int) -> np.ndarray:
    words = words.reshape(-1, bits)
    out, mask = np.zeros((len(words), 64), np.uint64), np.uint64((1 << bits) - 1)
    for j in range(64):
        word, shift = divmod(j * bits, 64)
        value = words[:, word] >> np.uint64(shift)
        if shift + bits > 64:
            value = value | (words[:, word + 1] << np.uint64(64 - shift))
        out[:, j] = value & mask
    return out.reshape(-1).astype(np.uint32)


def write_file(doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray, bits: int, end_id: int) -> bytes:
    starts = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=starts[1:])
    blocks = -(-len(ids) // BLOCK_IDS)
    packed = pack(ids, bits)
    offsets = np.minimum(np.arange(blocks + 1) * (BLOCK_IDS // 64 * bits * 8), len(packed) * 8)
    missing = sum(x is None for x in doc_ids)
    header = [MAGIC, bits, len(ids), len(doc_ids), missing, BLOCK_IDS, blocks, end_id]
    parts = (header, [x or 0 for x in doc_ids], starts, offsets)
    return b"".join([*(np.asarray(x, "<i8").tobytes() for x in parts), packed.astype("<u8").tobytes()])


class TokenFile:
    """A written file: its documents, and the ids of any range."""

    def __init__(self, payload: bytes):
        self.payload = payload
        header = np.frombuffer(payload, "<i8", 8)
        if header[0] != MAGIC:
            raise ValueError("not a token file")
        _, self.bits, self.n_ids, n, self.missing, self.block_ids, blocks, self.end_id = (int(x) for x in header)
        self.doc_ids = np.frombuffer(payload, "<i8", n, 64)
        self.starts = np.frombuffer(payload, "<i8", n + 1, 64 + 8 * n)
        self.offsets = np.frombuffer(payload, "<i8", blocks + 1, 72 + 16 * n)
        self.data = 80 + 16 * n + 8 * blocks

    def read_ids(self, start: int, stop: int) -> np.ndarray:
        first, last = start // self.block_ids, -(-stop // self.block_ids)
        if stop <= start:
            return np.zeros(0, np.uint32)
        low, high = int(self.offsets[first]), int(self.offsets[last])
        ids = unpack(np.frombuffer(self.payload, "<u8", (high - low) // 8, self.data + low), self.bits)
        return ids[start - first * self.block_ids : stop - first * self.block_ids]

    def document(self, place: int) -> np.ndarray:
        return self.read_ids(int(self.starts[place]), int(self.starts[place + 1]))


def pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Starts, ends and kinds of what is encoded by itself, and its n + 1 offsets in the texts.

    The tokenizer drops white space and then splits (as word_bpe_49k does), so a word is encoded by
    itself, and the punctuation after its last ASCII letter or digit too, since the tokenizer's
    pattern splits there. Its normalizer writes lower case, so ASCII capitals are the same word. Only
    words with an added token (kind true) are case-sensitive; they stay whole.
    """
    starts, ends, words = spans.word_spans(data, offsets, spans.NOT_SPACE)
    exact = np.zeros(len(starts), bool)
    marks = np.flatnonzero((data[:-1] == 60) & (data[1:] == 124))  # <|
    if len(marks):
        of = np.searchsorted(starts, marks, side="right") - 1
        exact[of[(of >= 0) & (marks < ends[of])]] = True
    last = np.maximum.accumulate(np.where(IS_MARK[data], -1, np.arange(len(data))))
    core = last[ends - 1] + 1 if len(ends) else ends
    core = np.where(core > starts, core, ends)
    split = (core < ends) & IS_ALNUM[data[core - 1]] & ~exact
    after = np.concatenate([[0], np.cumsum(1 + split)])
    first, tails = np.repeat(starts, 1 + split), after[1:][split] - 1
    final = np.repeat(ends, 1 + split)
    first[tails], final[tails - 1] = core[split], core[split]
    return first, final, np.repeat(exact, 1 + split), after[words]


class Lexicon:
    """The ids of frequent pieces, found by hash and confirmed on their bytes."""

    def __init__(self, words: list[bytes], ids: list[bytes]):
        def places(parts: list[bytes], width: int) -> np.ndarray:
            return np.concatenate([[0], np.cumsum([len(x) // width for x in parts], dtype=np.int64)]).astype(np.int64)

        self.bytes, self.at = np.frombuffer(b"".join(words), np.uint8), places(words, 1)
        self.ids, self.id_at = np.frombuffer(b"".join(ids), "<u4"), places(ids, 4)
        self.hashes = spans.range_hash(spans.prefix_sums(self.bytes), self.at[:-1], self.at[1:])
        self.bits = max(4, (4 * len(words)).bit_length())
        self.slots = np.full(1 << self.bits, -1, np.int32)
        todo, step = np.arange(len(words), dtype=np.int32), 0
        while len(todo):  # each round takes the free slots; of several that want one, the last gets it
            slot = self._slot(self.hashes[todo], step)
            free = self.slots[slot] < 0
            self.slots[slot[free]] = todo[free]
            todo, step = todo[self.slots[slot] != todo], step + 1
        self.steps = step

    def _slot(self, hashes: np.ndarray, step: int) -> np.ndarray:
        return ((hashes >> np.uint64(64 - self.bits)).astype(np.int64) + step) & ((1 << self.bits) - 1)

    def find(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The entry of each piece, -1 for none."""
        found = np.full(len(starts), -1, np.int32)
        if not len(self.hashes):
            return found
        hashes, todo = spans.range_hash(spans.prefix_sums(data), starts, ends), np.arange(len(starts))
        for step in range(self.steps):
            entry = self.slots[self._slot(hashes[todo], step)]
            hit = (entry >= 0) & (self.hashes[entry] == hashes[todo])
            found[todo[hit]] = entry[hit]
            todo = todo[(entry >= 0) & ~hit]
            if not len(todo):
                break
        some = np.flatnonzero(found >= 0)
        length = ends[some] - starts[some]
        other = self.at[found[some] + 1] - self.at[found[some]] != length
        found[some[other]] = -1
        some, length = some[~other], length[~other]
        same = data[spans.ragged(starts[some], length)] == self.bytes[spans.ragged(self.at[found[some]], length)]
        if not same.all():  # an equal hash of other bytes
            found[some[np.repeat(np.arange(len(some)), length)[~same]]] = -1
        return found


class WordEncoder:
    """Ids of texts, piece by piece: frequent pieces come from the lexicon, others from the library
    and, up to MAX_WORDS of them, from memory."""

    def __init__(self, tokenizer_json: str, lexicon: Lexicon | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks have the cores already
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.lexicon = lexicon or Lexicon([], [])
        self.words: dict[bytes, bytes] = {}

    def encode_pieces(self, words: list[bytes]) -> list[bytes]:
        """The ids of each as little-endian unsigned 32-bit integers, from the library."""
        out: list[bytes] = []
        for at in range(0, len(words), 5_000):
            part = [x.decode() for x in words[at : at + 5_000]]
            out += [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)]
        return out

    def _rest(self, words: list[bytes]) -> list[bytes]:
        known = self.words
        new = list({w for w in words if w not in known})
        if len(known) + len(new) > MAX_WORDS:
            known.clear()
            new = list(set(words))
        known.update(zip(new, self.encode_pieces(new)))
        return [known[w] for w in words]

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts and their n + 1 offsets."""
        raw, offsets = spans.text_bytes(column)
        starts, ends, exact, texts = pieces(raw, offsets)
        data = spans.LOWER[raw]
        entry = self.lexicon.find(data, starts, ends)
        entry[exact] = -1
        missing = np.flatnonzero(entry < 0)
        bounds = zip(starts[missing].tolist(), ends[missing].tolist(), exact[missing].tolist())
        lower, given = data.tobytes(), raw.tobytes()
        rest = self._rest([(given if x else lower)[a:b] for a, b, x in bounds])
        # pool: the lexicon's ids, then those of the other pieces
        pool = np.concatenate([self.lexicon.ids, np.frombuffer(b"".join(rest), "<u4")])
        first, count = self.lexicon.id_at[entry], self.lexicon.id_at[entry + 1] - self.lexicon.id_at[entry]
        lengths = np.array([len(x) // 4 for x in rest], np.int64)
        first[missing], count[missing] = len(self.lexicon.ids) + np.cumsum(lengths) - lengths, lengths
        return pool[spans.ragged(first, count)], np.concatenate([[0], np.cumsum(count)])[texts]


_encoders: dict[str, WordEncoder] = {}


def _encoder(tokenizer_json: str, lexicon: Lexicon | None = None) -> WordEncoder:
    """A worker's encoder; its memory of words outlives its tasks."""
    found = _encoders.get(tokenizer_json)
    if found is None or lexicon is not None and found.lexicon is not lexicon:
        _encoders.clear()
        found = _encoders[tokenizer_json] = WordEncoder(tokenizer_json, lexicon)
    return found


def frequent_pieces(texts: DataFrame, tokenizer_json: str) -> Lexicon:
    """A lexicon of the pieces that are frequent in a sample of SAMPLE texts.

    It only saves time: other pieces are encoded when they occur, with equal results.
    """
    rows = texts.count()
    if not rows:
        return Lexicon([], [])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in spans.sliced(batches):
            raw, offsets = spans.text_bytes(batch.column("text"))
            starts, ends, exact, _ = pieces(raw, offsets)
            lower = spans.LOWER[raw].tobytes()
            seen.update(lower[a:b] for a, b in zip(starts[~exact].tolist(), ends[~exact].tolist()) if b - a <= LONGEST)
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], ["piece", "n"])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = _encoder(tokenizer_json).encode_pieces(batch.column("piece").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("piece"), pa.array(ids, pa.binary())], ["piece", "ids"])

    sample = texts.sample(min(1.0, SAMPLE / rows), seed=7).repartition(32)
    counts = sample.mapInArrow(count, "piece binary, n long").groupBy("piece").agg(F.sum("n").alias("n"))
    best = counts.where("n > 1").orderBy(F.col("n").desc(), "piece").limit(LEXICON)
    table = best.select("piece").repartition(32, "piece").mapInArrow(encode, "piece binary, ids binary").toArrow()
    return Lexicon(table.column("piece").to_pylist(), table.column("ids").to_pylist())


def write_tokens(spark: SparkSession, docs: DataFrame, tokenizer_path: str, end_id: int, work: Work) -> DataFrame:
    """The written table of files: part and start order them; part is a range of doc_ids."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path)
    bits = bits_for(max(tokenizer.get_vocab_size(), end_id + 1))
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    shared = spark.sparkContext.broadcast((tokenizer.to_str(), frequent_pieces(rows.select("text"), tokenizer.to_str())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, start = _encoder(*shared.value), TaskContext.get().partitionId(), 0
        doc_ids: list[int | None] = []
        encoded: list[np.ndarray] = []
        end = np.array([end_id], "<u4")
        held = 0

        def file() -> pa.RecordBatch:
            lengths = np.array([len(x) + 1 for x in encoded], np.int64)
            ids = np.concatenate([x for ids in encoded for x in (ids, end)])
            payload = write_file(doc_ids, lengths, ids, bits, end_id)
            values = ([part], [start], [held], [len(doc_ids)], [payload])
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], [x.split()[0] for x in FILES.split(", ")])

        for batch in spans.sliced(batches):
            ids, cuts = encoder.encode(batch.column("text"))
            for doc_id, a, b in zip(batch.column("doc_id").to_pylist(), cuts.tolist(), cuts[1:].tolist()):
                doc_ids.append(doc_id)
                encoded.append(ids[a:b])
                held += b - a + 1
                if held >= FILE_IDS:
                    yield file()
                    start, held = start + held, 0
                    doc_ids.clear()
                    encoded.clear()
        if doc_ids:
            yield file()

    rows = rows.withColumn("_tie", F.xxhash64("text")).withColumn("_row", F.monotonically_increasing_id())
    keys = ["doc_id", "_tie", "_row"]
    ordered = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", "text")
    return work.stored(ordered.mapInArrow(run, FILES), "files")


DOCUMENTS = "doc_id long, start long, n_tokens long, ids_crc32 long"


def read_documents(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files."""
    totals = files.groupBy("part").agg(F.sum("n_ids").alias("ids"))  # one row a part, so bounded by the partitions
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("before"))
    placed = files.join(F.broadcast(totals), "part").select((F.col("before") + F.col("start")).alias("first"), "payload")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, payload in zip(batch.column("first").to_pylist(), batch.column("payload")):
                file = TokenFile(payload.as_py())
                ids, cuts = file.read_ids(0, file.n_ids).astype("<u4").tobytes(), (4 * file.starts).tolist()
                doc_ids = [None] * file.missing + file.doc_ids[file.missing :].tolist()
                sums = [zlib.crc32(ids[a:b]) for a, b in zip(cuts, cuts[1:])]
                columns = (doc_ids, first + file.starts[:-1], np.diff(file.starts), sums)
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], [x.split()[0] for x in DOCUMENTS.split(", ")])

    return placed.mapInArrow(run, DOCUMENTS)
