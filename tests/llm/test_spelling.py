"""Spelling variants against comparing every word with every other."""

import random
import re
import zlib
from collections import Counter

import pytest
from cases import edge_docs, edge_rows, empty_docs, lower

from sparkmart.llm import spelling
from sparkmart.llm.work import Work


def near(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def counted(rows) -> dict[str, int]:
    found: Counter = Counter()
    for doc_id, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                found[run] += 1
    return {w: n for w, n in found.items() if n >= 2}


def expected(n: dict[str, int]) -> list[tuple]:
    mates = {w: [v for v in n if abs(len(v) - len(w)) < 2 and near(v, w)] for w in n}
    best = {w: min(m, key=lambda v: (-n[v], v)) for w, m in mates.items() if m}
    form = {w: v for w, v in best.items() if n[v] >= 10 * n[w]}
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(mates[w]), n[form[w]] if w in form else None))
    return out


def some_words() -> list[tuple]:
    """Words of few letters, so that many are near, some in chains of rising counts."""
    rng = random.Random(5)
    words = ["".join(rng.choice("aéÿ") for _ in range(rng.choice([7, 7, 8]))) for _ in range(400)]
    chain = [("kkkkkkk", 2), ("kkkkkkkk", 30), ("kkkkkkkz", 400), ("zkkkkkkkz", 5000), ("tiewords", 3), ("tiewordsa", 40), ("tiewordsb", 40)]
    texts = [" ".join(rng.choices(words, k=40)) for _ in range(90)] + [f"{w} " * n for w, n in chain]
    long = "x" * 3000
    return [(i, t) for i, t in enumerate(texts)] + [(900, f"{long} {long}y {long} {long}y ABCDEFGÀ×÷ abcdefgÀ×÷ ŒabcdefgÀ×÷")]


@pytest.mark.parametrize("tile", [spelling.TILE, 5])
def test_equals_brute_force(llm, tile):
    rows = some_words() + [(r[0], r[1]) for r in edge_rows()]
    docs = edge_docs(llm, [(i, t, "s", "en", 1) for i, t in rows])
    got = [tuple(r) for r in spelling.group_variants(llm, docs, tile).collect()]
    want = expected(counted(rows))
    assert sorted(got) == sorted(want, key=lambda r: r[0])
    assert any(r[1] and r[1] != r[2] for r in got) and max(r[4] for r in got) > 4


def test_index_equals_comparing():
    rng = random.Random(8)
    words = sorted({"".join(rng.choice("abc") for _ in range(rng.choice([6, 7, 8]))) for _ in range(400)})
    index = spelling.PositionIndex(words, 0)
    for w in words:
        found = index.replaced_or_longer(w) | index.shorter(w)
        assert [v for i, v in enumerate(words) if found >> i & 1] == [v for v in words if near(v, w)]


def test_empty_tables_and_rows_without_words(llm):
    assert spelling.group_variants(llm, empty_docs(llm)).count() == 0
    none = edge_docs(llm, [(1, None, None, None, None), (2, "", None, None, 0), (3, "short words only", None, None, 1)])
    assert spelling.group_variants(llm, none).count() == 0


def test_roots_over_several_rounds(llm):
    forms = llm.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(6)], "word string, form string")
    got = dict(map(tuple, spelling.follow(Work(llm), forms).collect()))
    assert got == {f"w{i}": "w6" for i in range(5)}
