"""Byte-level BPE: a minimal acyclic transducer for frequent words, exact merges for all others.

The corpus's most frequent words are counted by Spark and compiled on the driver into a minimal
acyclic automaton that shares prefixes and suffixes. Every arc carries the number of words that it
skips, so a walk ends with the word's rank, which points at its ids. The automaton is one file in
the shared folder; each worker maps it into memory. Words that it doesn't know are merged pair by
pair, the lowest rank first, many words at once. Decoding joins the bytes of the ids.

Defined results: null and empty texts have no ids. Added tokens in a text (such as the end of text
mark) become their own id. Repeated rows are encoded one by one. An empty table gives an empty
result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import shared_dir
from . import spans
from .work import Work

#: Fixed value: how the tokenizer splits a text into words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words of the automaton.
LEXICON_WORDS = 50_000
#: Text bytes that are encoded together; a longer text alone.
SLICE_BYTES = 6 << 20
#: Longer words are merged one by one with a heap, shorter ones together in a matrix.
MATRIX_BYTES = 48

_NONE = np.int32(2**31 - 1)


def byte_characters() -> dict[str, int]:
    """The character that stands for each byte in the vocabulary file: printable Latin-1 characters
    stand for themselves, the others follow from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """Tables of a byte-level BPE file: ids of bytes, merges by pair, bytes of ids, added tokens."""

    def __init__(self, text: str):
        spec = json.loads(text)
        byte_of, vocab = byte_characters(), spec["model"]["vocab"]
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        pieces = {i: t.encode() for t, i in self.added.items()}
        pieces |= {i: bytes(byte_of[c] for c in t) for t, i in vocab.items() if t not in self.added}
        self.byte_id = np.zeros(256, np.int32)
        for c, b in byte_of.items():
            self.byte_id[b] = vocab[c]
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        pairs = np.array([(vocab[a] << 32) | vocab[b] for a, b in merges], np.int64)
        order = np.argsort(pairs)
        self.pairs, self.ranks = pairs[order], order.astype(np.int32)
        self.merged = np.array([vocab[a + b] for a, b in merges], np.int32)
        self.by_pair = dict(zip(pairs.tolist(), range(len(pairs))))
        lengths = np.array([len(pieces.get(i, b"")) for i in range(max(pieces) + 1)], np.int64)
        self.piece_starts = np.concatenate([[0], np.cumsum(lengths)])
        self.piece_bytes = np.frombuffer(b"".join(pieces.get(i, b"") for i in range(max(pieces) + 1)), np.uint8)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left.astype(np.int64) << 32) | right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.ranks[at], _NONE)

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All bytes of the ids, and the number of bytes before each id and after the last."""
        lengths = self.piece_starts[ids + 1] - self.piece_starts[ids]
        return self.piece_bytes[spans.ragged(self.piece_starts[ids], lengths)], np.concatenate([[0], np.cumsum(lengths)])


def merge_long(word: bytes, vocab: Vocabulary) -> list[int]:
    """Merge one word with a heap of pairs: near linear in its length."""
    ids = vocab.byte_id[np.frombuffer(word, np.uint8)].tolist()
    n = len(ids)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    find = vocab.by_pair.get
    heap = []

    def offer(i: int) -> None:
        j = after[i]
        if j < n and (r := find((ids[i] << 32) | ids[j])) is not None:
            heap.append((r, i, ids[i], ids[j]))

    for i in range(n - 1):
        offer(i)
    heapq.heapify(heap)
    while heap:
        r, i, a, b = heapq.heappop(heap)
        j = after[i] if ids[i] == a else n
        if j >= n or ids[j] != b:
            continue  # one of the two has been merged meanwhile
        ids[i], ids[j] = int(vocab.merged[r]), -1
        after[i] = after[j]
        if after[j] < n:
            before[after[j]] = i
        for k in (before[i], i):
            if k >= 0 and after[k] < n and (r := find((ids[k] << 32) | ids[after[k]])) is not None:
                heapq.heappush(heap, (r, k, ids[k], ids[after[k]]))
    return [x for x in ids if x >= 0]


def _merge_matrix(ids: np.ndarray, vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Merge words of one length, a row each: every round merges each row's leftmost lowest pair."""
    n, width = ids.shape
    lengths = np.full(n, width)
    out, rows = ids.copy(), np.arange(n)
    ranks = vocab.rank(ids[:, :-1], ids[:, 1:]) if width > 1 else np.full((n, 1), _NONE)
    places = np.arange(width)
    while width > 1 and len(rows):
        at = ranks.argmin(axis=1)
        here = np.arange(len(rows))
        best = ranks[here, at]
        live = best < _NONE
        if not live.all():
            gone = rows[~live]
            out[gone, :width], lengths[gone] = ids[~live], width
            rows, ids, ranks, at, best = rows[live], ids[live], ranks[live], at[live], best[live]
            here = np.arange(len(rows))
            if not len(rows):
                break
        ids[here, at] = vocab.merged[best]
        # every live row gets one place shorter: columns after the merged pair move left
        width -= 1
        moved = places[:width] + (places[:width] > at[:, None])
        ids = np.take_along_axis(ids, moved, axis=1)
        if width > 1:
            moved = places[: width - 1] + (places[: width - 1] >= at[:, None])
            ranks = np.take_along_axis(ranks, np.minimum(moved, width - 1), axis=1)
            for side in (at - 1, at):
                ok = np.flatnonzero((side >= 0) & (side < width - 1))
                ranks[ok, side[ok]] = vocab.rank(ids[ok, side[ok]], ids[ok, side[ok] + 1])
        else:
            ranks = np.full((len(rows), 1), _NONE)
        if width == 1:
            out[rows, 0], lengths[rows] = ids[:, 0], 1
            rows = rows[:0]
    return out, lengths


def merge(words: list[bytes], vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words, one word after the other, and their numbers of ids."""
    sizes = np.array([len(w) for w in words], np.int64)
    counts = np.zeros(len(words), np.int64)
    found: list[tuple[np.ndarray, np.ndarray]] = []  # word of each id, ids
    for size in np.unique(sizes):
        of = np.flatnonzero(sizes == size)
        if size == 0:
            continue
        if size > MATRIX_BYTES:
            for i in of:
                ids = np.array(merge_long(words[i], vocab), np.int32)
                counts[i] = len(ids)
                found.append((np.full(len(ids), i), ids))
            continue
        for part in np.array_split(of, -(-len(of) // 20_000)):
            data = np.frombuffer(b"".join(words[i] for i in part), np.uint8).reshape(len(part), size)
            ids, lengths = _merge_matrix(vocab.byte_id[data], vocab)
            counts[part] = lengths
            found.append((np.repeat(part, lengths), ids[np.arange(ids.shape[1]) < lengths[:, None]]))
    if not found:
        return np.zeros(0, np.int32), counts
    of, ids = np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])
    return ids[np.argsort(of, kind="stable")], counts


def compile_lexicon(words: list[bytes]) -> dict[str, np.ndarray]:
    """The minimal acyclic automaton of the sorted words: states with the same endings are one.

    arcs: state * 256 + byte in ascending order; next: the state behind each arc; skip: the words
    in order before those behind the arc; final: whether a word ends in the state.
    """
    # a state under construction is [final, {byte: child}]; words come sorted, so only the path of
    # the last word can still grow and all else is already shared
    registry: dict[tuple, int] = {}
    finals: list[bool] = []
    children: list[tuple[tuple[int, int], ...]] = []

    def settle(state: list) -> int:
        key = (state[0], tuple(state[1].items()))
        if key not in registry:
            registry[key] = len(finals)
            finals.append(state[0])
            children.append(key[1])
        return registry[key]

    path, last = [[False, {}]], b""
    for word in words:
        shared = 0
        while shared < min(len(word), len(last)) and word[shared] == last[shared]:
            shared += 1
        for depth in range(len(last), shared, -1):
            path[depth - 1][1][last[depth - 1]] = settle(path[depth])
        del path[shared + 1 :]
        path += [[False, {}] for _ in range(len(word) - shared)]
        path[-1][0] = True
        last = word
    for depth in range(len(last), 0, -1):
        path[depth - 1][1][last[depth - 1]] = settle(path[depth])
    root = settle(path[0])
    reach: list[int] = []  # a child is settled before its parent
    for final, arcs in zip(finals, children):
        reach.append(final + sum(reach[child] for _, child in arcs))
    keys, following, skips = [], [], []
    for state, arcs in enumerate(children):
        skip = int(finals[state])
        for byte, child in arcs:
            keys.append(state * 256 + byte)
            following.append(child)
            skips.append(skip)
            skip += reach[child]
    order = np.argsort(np.array(keys, np.int64), kind="stable")
    return {
        "arcs": np.array(keys, np.int64)[order],
        "next": np.array(following, np.int64)[order],
        "skip": np.array(skips, np.int64)[order],
        "final": np.array(finals, bool),
        "root": np.array([root], np.int64),
    }


def to_file(arrays: dict[str, np.ndarray]) -> bytes:
    """Arrays one after the other behind a JSON header, each at a multiple of 64 bytes."""
    at, index = 0, {}
    for name, x in arrays.items():
        index[name] = [x.dtype.str, len(x), at]
        at += -(-x.nbytes // 64) * 64
    head = json.dumps(index).encode()
    head += b" " * (-(len(head) + 8) % 64)
    body = b"".join(x.tobytes() + bytes(-x.nbytes % 64) for x in arrays.values())
    return len(head).to_bytes(8, "little") + head + body


def map_file(path: str) -> dict[str, np.ndarray]:
    data = np.memmap(path, np.uint8, "r")
    size = int.from_bytes(data[:8].tobytes(), "little")
    index = json.loads(data[8 : 8 + size].tobytes())
    return {n: np.frombuffer(data, kind, count, 8 + size + at) for n, (kind, count, at) in index.items()}


class Encoder:
    def __init__(self, vocab: Vocabulary, lexicon: dict[str, np.ndarray]):
        self.vocab, self.lexicon = vocab, lexicon
        self.split = regex.compile(PATTERN).findall
        added = sorted(vocab.added, key=len, reverse=True)
        self.added = regex.compile("(" + "|".join(map(regex.escape, added)) + ")") if added else None

    def look_up(self, words: list[bytes]) -> np.ndarray:
        """The rank of each word in the automaton, -1 for unseen words; all words walk at once."""
        x = self.lexicon
        data = np.frombuffer(b"".join(words), np.uint8)
        sizes = np.array([len(w) for w in words], np.int64)
        starts = np.cumsum(sizes) - sizes
        rank = np.full(len(words), -1, np.int64)
        if not len(x["arcs"]):
            return rank
        at, state, skipped = np.arange(len(words)), np.full(len(words), x["root"][0]), np.zeros(len(words), np.int64)
        depth = 0
        while len(at):
            done = sizes[at] == depth
            ends = done & x["final"][state]
            rank[at[ends]] = skipped[ends]
            at, state, skipped = at[~done], state[~done], skipped[~done]
            key = state * 256 + data[starts[at] + depth]
            arc = np.minimum(np.searchsorted(x["arcs"], key), len(x["arcs"]) - 1)
            ok = x["arcs"][arc] == key
            at, arc = at[ok], arc[ok]
            state, skipped = x["next"][arc], skipped[ok] + x["skip"][arc]
            depth += 1
        return rank

    def words(self, text: str) -> list[str | int]:
        """The words of a text; an added token is its id."""
        if self.added is None or not self.added.search(text):
            return self.split(text)
        out: list[str | int] = []
        for k, part in enumerate(self.added.split(text)):
            out += [self.vocab.added[part]] if k % 2 else self.split(part)
        return out

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one text after the other, and the number of ids before each."""
        split = [self.words(t) for t in texts]
        sizes = np.array([len(x) for x in split], np.int64)
        flat = [w for x in split for w in x]
        different = list(dict.fromkeys(flat))
        place = dict(zip(different, range(len(different))))
        code = np.fromiter(map(place.__getitem__, flat), np.int64, len(flat))
        del flat, split, place
        # ids of each different word: from the automaton, else merged
        raw = [w.encode() if isinstance(w, str) else b"" for w in different]
        rank = self.look_up(raw) if raw else np.zeros(0, np.int64)
        unseen = np.flatnonzero(rank < 0)
        merged, merged_counts = merge([raw[i] for i in unseen], self.vocab)
        id_starts = self.lexicon["id_starts"]
        table = np.concatenate([self.lexicon["ids"], merged, np.array([w for w in different if not isinstance(w, str)], np.int32)])
        counts, starts = np.zeros(len(raw), np.int64), np.zeros(len(raw), np.int64)
        seen = np.flatnonzero(rank >= 0)
        starts[seen] = id_starts[rank[seen]]
        counts[seen] = id_starts[rank[seen] + 1] - starts[seen]
        counts[unseen] = merged_counts
        starts[unseen] = len(self.lexicon["ids"]) + np.cumsum(merged_counts) - merged_counts
        special = [i for i, w in enumerate(different) if not isinstance(w, str)]
        counts[special] = 1
        starts[special] = len(table) - len(special) + np.arange(len(special))
        ids = table[spans.ragged(starts[code], counts[code])]
        before = np.concatenate([[0], np.cumsum(counts[code])])
        return ids, before[np.concatenate([[0], np.cumsum(sizes)])]


def frequent_words(work: Work, docs: DataFrame, n: int) -> list[str]:
    """The most frequent letter words of all texts, with the space before them: at most n.

    Words are counted over all texts; sixteenths of powers of two of the counts then say from which
    count on there are no more than n words, so the driver gets those only.
    """
    words = F.explode(F.regexp_extract_all(docs["text"], F.lit(r" ?\p{L}+"), F.lit(0))).alias("word")
    counts = docs.select(words).groupBy("word").agg(F.count("*").alias("n")).where("n > 1")
    counts = work.stored(counts.withColumn("level", F.floor(16 * F.log2("n"))), "words")
    least, total = None, 0
    for r in sorted(counts.groupBy("level").agg(F.count("*").alias("words")).collect(), reverse=True):
        total += r["words"]
        if total > n:
            break
        least = r["level"]
    return [] if least is None else [r["word"] for r in counts.where(F.col("level") >= least).collect()]


def build_lexicon(words: list[str], vocab: Vocabulary) -> bytes:
    raw = sorted({w.encode() for w in words})
    ids, counts = merge(raw, vocab)
    arrays = compile_lexicon(raw) | {"ids": ids, "id_starts": np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)}
    return to_file(arrays)


def _publish(spark: SparkSession, data: bytes) -> str:
    """Write a file to the shared folder and have every executor fetch it."""
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    path = f"{shared_dir(spark)}/{name}"
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = where.getFileSystem(spark._jsc.hadoopConfiguration()).create(where, True)
    try:
        stream.write(bytearray(data))
    finally:
        stream.close()
    spark.sparkContext.addFile(path)
    return name


_encoders: dict[str, Encoder] = {}
COUNTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def encode_documents(spark: SparkSession, docs: DataFrame, vocabulary_path: str, lexicon_words: int = LEXICON_WORDS, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256; with_ids adds token_ids."""
    with open(vocabulary_path, encoding="utf-8") as file:
        text = file.read()
    docs = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    name = _publish(spark, build_lexicon(frequent_words(Work(spark), docs, lexicon_words), Vocabulary(text)))
    shared = spark.sparkContext.broadcast(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _encoders:
            _encoders.clear()
            _encoders[name] = Encoder(Vocabulary(shared.value), map_file(SparkFiles.get(name)))
        encoder = _encoders[name]
        for batch in spans.sliced(batches, limit=SLICE_BYTES):
            ids, starts = encoder.encode([x or "" for x in batch.column("text").to_pylist()])
            data, before = encoder.vocab.decode(ids)
            data, cuts = data.tobytes(), before[starts].tolist()
            raw, places = ids.astype("<u4").tobytes(), starts.tolist()
            id_hashes = [hashlib.sha256(raw[4 * a : 4 * b]).hexdigest() for a, b in zip(places, places[1:])]
            texts = [hashlib.sha256(data[a:b].decode("utf-8", "replace").encode()).hexdigest() for a, b in zip(cuts, cuts[1:])]
            columns = [batch.column("doc_id"), pa.array(np.diff(starts)), pa.array(id_hashes, pa.string()), pa.array(texts, pa.string())]
            names = [x.split()[0] for x in COUNTS.split(", ")]
            if with_ids:
                columns.append(pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(ids, pa.int32())))
                names.append("token_ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(run, COUNTS + (", token_ids array<int>" if with_ids else ""))
