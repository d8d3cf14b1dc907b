"""Tables that every operator must survive, and slow versions of what they compute."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

from pyspark.sql import functions as F

#: Names that operators use themselves.
CLASHES = "score kept predicted held_out n_words words bands node part seq shard slot label block key id host _row file".split()

LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
COPY = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen " * 4


def edge_rows() -> list[tuple]:
    texts = [
        None, "", " \t\n ", "word", "Two words", COPY, COPY, COPY.upper(), COPY + "and a little more", LONG,
        "é́ ß İ 日本 😀 \x00 \x85", "a" * 5000, "\n\n\nx\ny\nx\n", "it's <|endoftext|> #*$%&|<> end.", "1 2 3 4 5 6 7 8 9 10",
    ]
    rows = [(i, t, "src", "en", len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[5], rows[5]]  # repeated rows
    rows += [(5, "another text of the same id with words enough to count", None, None, None)]
    return rows + [(None, COPY, None, "en", 1), (None, None, None, None, None)]


def edge_docs(spark, rows: list[tuple] | None = None):
    rows = edge_rows() if rows is None else rows
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long")
    return docs.withColumns({c: F.lit("clash") for c in CLASHES}).repartition(3)


def empty_docs(spark):
    return edge_docs(spark, [])


def lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def letters(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))


def shingles(text: str | None) -> set:
    w = words(lower(text or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def near_groups(rows: list[tuple]) -> dict:
    """doc_id: smallest linked doc_id, by comparing everything with everything."""
    sets: dict = {}
    for doc_id, text in rows:
        if doc_id is not None:
            sets.setdefault(doc_id, []).append(shingles(text))
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i in ids:
        for j in ids:
            if j < i and any(x and y and 100 * len(x & y) >= 75 * len(x | y) for x in sets[i] for y in sets[j]):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def removed(texts: list[str | None], length: int = 200) -> list[tuple]:
    """(bytes, removed, spans, sha256 of the rest) of each text."""
    raw = [(t or "").encode() for t in texts]
    count = Counter(t[i : i + length] for t in raw for i in range(len(t) - length + 1))
    out = []
    for t in raw:
        gone = [False] * len(t)
        for i in range(len(t) - length + 1):
            if count[t[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest(), kept))
    return out


def contamination(docs: list[tuple], items: list[tuple]) -> list[tuple]:
    """(doc_id, words, hit words, items, sha256, contaminated) of each row."""
    windows: dict[tuple, set] = {}
    for item_id, text in items:
        w = letters(text)
        n = min(13, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(str(item_id))
    sizes = {len(x) for x in windows}
    out = []
    for doc_id, text in docs:
        w, hit, found = letters(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if ids := windows.get(tuple(w[i : i + n])):
                    hit |= set(range(i, i + n))
                    found |= ids
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return out


def bag(rows) -> Counter:
    return Counter(tuple(r) for r in rows)
