"""Words of many texts at once: numpy over the bytes of an Arrow column, no Python object per word.

A hash is a polynomial over random byte values modulo 2**64, then mixed. Different strings of a
corpus get equal 64-bit hashes with a chance near n * n / 2**65 for n strings.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_rng = np.random.default_rng(20240229)
_VALUE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_powers = {"base": np.ones(1, np.uint64), "inverse": np.ones(1, np.uint64)}

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Word bytes of `[^\x20\x09-\x0D]+`.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
#: Word bytes of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`, once A-Z are lower case.
LETTERS = np.zeros(256, bool)
LETTERS[0x30:0x3A] = LETTERS[0x61:0x7B] = LETTERS[0x80:] = True


def _power(kind: str, n: int) -> np.ndarray:
    known = _powers[kind]
    if len(known) < n:
        step = _BASE if kind == "base" else _U(pow(int(_BASE), -1, 2**64))
        known = np.full(max(n, SLICE_BYTES + 1), step, np.uint64)
        known[0] = 1
        np.multiply.accumulate(known, out=known)
        if n <= 4 * SLICE_BYTES:  # a longer text than that is rare: its table isn't kept
            _powers[kind] = known
    return known[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit over all others (the finalizer of splitmix64)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums that give the hash of any byte range by one subtraction."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUE[data] * _power("base", len(data)), out=out[1:])
    return out


def range_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mix((sums[end] - sums[start]) * _power("inverse", len(sums))[start])


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and their n + 1 offsets; null is empty."""
    if column.null_count:
        column = column.fill_null("")
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    if offsets is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(offsets, width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def sliced(batches: Iterable[pa.RecordBatch], text: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches of at most so many text bytes, or of one row: memory follows the slice, not the batch."""
    for batch in batches:
        at = batch.schema.get_field_index(text)
        _, offsets = text_bytes(batch.column(at))
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
            end = min(max(end, start + 1), batch.num_rows)
            yield batch.slice(start, end - start)
            start = end


def word_spans(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the n + 1 word offsets of the texts."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = is_word[data]
    first, last = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    first[cuts] = inside[1:-1][cuts]
    last[cuts - 1] = inside[1:-1][cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(column: pa.Array, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word with A-Z in lower case, and the n + 1 word offsets of the texts."""
    data, offsets = text_bytes(column)
    data = LOWER[data]
    starts, ends, words = word_spans(data, offsets, is_word)
    return range_hash(prefix_sums(data), starts, ends), words


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive words, also across texts; the caller leaves those out."""
    n = max(0, len(words) - k + 1)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = out * _BASE + words[j : j + n]
    return mix(out ^ _U(k))


def owner(offsets: np.ndarray) -> np.ndarray:
    """The text of each item."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... of all ranges, one range after the other."""
    total = int(lengths.sum())
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)
