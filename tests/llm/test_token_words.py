"""The word encoder of token files against the library, with and without a lexicon."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from sparkmart.llm import spans, token_files

ALPHABET = [*"abcXYZ019 .,!?'\"-_<|>#\t\n\r\x0b\x0c\x00\x1c\x7f\x85\xa0éßİſ日😀́", "<|endoftext|>", "'s", "'LL", "Don't", "the", "WORD.", " "]


def texts() -> list[str | None]:
    rng = random.Random(3)
    made = ["".join(rng.choices(ALPHABET, k=rng.randrange(40))) for _ in range(5000)]
    return [None, "", " ", *made, "word. " * 5000, *(f"a{chr(c)}b A{chr(c)}. 1{chr(c)}" for c in range(0x500))]


def lexicon(encoder, column) -> token_files.Lexicon:
    raw, offsets = spans.text_bytes(column)
    starts, ends, exact, _ = token_files.pieces(raw, offsets)
    lower = spans.LOWER[raw].tobytes()
    words = sorted({lower[a:b] for a, b in zip(starts[~exact].tolist(), ends[~exact].tolist())})[::2]
    return token_files.Lexicon(words, encoder.encode_pieces(words))


@pytest.mark.parametrize("known", [True, False])
def test_ids_are_the_library_s(known):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    column = pa.array(texts())
    encoder = token_files.WordEncoder(tokenizer.to_str())
    if known:
        encoder = token_files.WordEncoder(tokenizer.to_str(), lexicon(encoder, column))
    want = [e.ids for e in tokenizer.encode_batch([t or "" for t in texts()], add_special_tokens=False)]
    for _ in range(2):  # from the library, then from memory
        ids, cuts = encoder.encode(column)
        assert [ids[a:b].tolist() for a, b in zip(cuts, cuts[1:])] == want
    assert len(encoder.encode(pa.array([], pa.string()))[0]) == 0


def test_a_lexicon_confirms_bytes(monkeypatch):
    lex = token_files.Lexicon([b"one", b"two", b"three"], [b"\1\0\0\0", b"", b"\2\0\0\0\3\0\0\0"])
    data = np.frombuffer(b"two threeoneonx", np.uint8)
    starts, ends = np.array([0, 4, 9, 12]), np.array([3, 9, 12, 15])
    assert lex.find(data, starts, ends).tolist() == [1, 2, 0, -1]
    lex.bytes = np.frombuffer(b"onetw0three", np.uint8)  # as if another word had the hash of "two"
    assert lex.find(data, starts, ends).tolist() == [-1, 2, 0, -1]
