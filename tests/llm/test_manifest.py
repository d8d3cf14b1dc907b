"""Merkle manifest: edge rows, open subtrees, and appends against a whole tree."""

import hashlib
import zlib

import pytest
from cases import edge_docs, edge_rows, empty_docs
from pyspark.sql import functions as F

from sparkmart.llm import manifest
from sparkmart.llm.manifest import Forest, OpenSubtrees, fold, height_of, joined, steps
from sparkmart.llm.work import Work


def tree(leaves: list[str]) -> tuple[str, list[list[str]]]:
    """Root and the siblings of every leaf, level by level, from whole levels."""
    paths, level, at = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(level) > 1:
        for i, place in enumerate(at):
            if (place ^ 1) < len(level):
                paths[i].append(level[place ^ 1])
        level = [hashlib.sha256("".join(level[i : i + 2]).encode()).hexdigest() for i in range(0, len(level), 2)]
        at = [place // 2 for place in at]
    return level[0], paths


@pytest.mark.parametrize("n", [*range(1, 20), 31, 32, 33, 100])
def test_open_subtrees_give_root_and_witnesses(n):
    leaves = [hashlib.sha256(str(i).encode()).digest() for i in range(n)]
    appended = OpenSubtrees()
    for leaf in leaves:
        appended.append(leaf)
    assert len(appended.open) == bin(n).count("1")
    root, witnesses = appended.close(height_of(n))
    want, paths = tree([x.hex() for x in leaves])
    assert root.hex() == want and [[d.hex() for _, d in steps(w) if d] for w in witnesses] == paths
    assert all(fold(leaf, w) == root for leaf, w in zip(leaves, witnesses))
    assert n == 1 or fold(joined(leaves[0]), witnesses[0]) != root


def digest(*values) -> str:
    parts = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values]
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def expected(rows: list[tuple]) -> list[tuple]:
    """Rows are doc_id, text, source, lang, n_chars."""
    groups: dict = {}
    for doc_id, text, source, lang, n_chars in rows:
        other = digest(doc_id, source, lang, n_chars if n_chars is None else n_chars + 1, text)
        leaf = digest(doc_id, source, lang, n_chars, text)
        hit = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0
        groups.setdefault(lang, []).append((doc_id, leaf, other if hit else leaf))
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    for lang in langs:
        groups[lang].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    below = {lang: tree([x[1] for x in groups[lang]]) for lang in langs}
    root, above = tree([below[lang][0] for lang in langs])
    out = []
    for lang, path in zip(langs, above):
        for (doc_id, leaf, given), own in zip(groups[lang], below[lang][1]):
            proof = hashlib.sha256("".join(own + path).encode()).hexdigest()
            out.append((doc_id, leaf, below[lang][0], root, proof, given == leaf))
    return out


def test_edge_rows(llm):
    rows = edge_rows() + [(100 + i, f"t{i}", "s", f"l{i % 37}", None if i % 5 == 0 else 2**63 - 1 if i % 5 == 1 else i) for i in range(300)]
    got = manifest.manifest(llm, edge_docs(llm, rows)).collect()
    shown = [(r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.verified) for r in got]
    assert sorted(shown, key=str) == sorted(expected(rows), key=str)
    assert all(r.verified == (r.folded_root == r.root) for r in got) and {r.verified for r in got} == {True, False}


def test_empty_table_and_one_row(llm):
    assert manifest.manifest(llm, empty_docs(llm)).count() == 0
    (row,) = manifest.manifest(llm, edge_docs(llm, [(1, None, None, None, None)])).collect()
    assert row.leaf == row.subroot == row.root == row.folded_root and row.proof_sha256 == hashlib.sha256(b"").hexdigest()


def nodes(llm, sizes: dict, since: dict | None = None):
    rows = [(g, r, n, hashlib.sha256(f"{g}{r}".encode()).digest()) for g, n in sizes.items() for r in range((since or {}).get(g, 0), n)]
    return llm.createDataFrame(rows, "grp string, rank long, total long, digest binary")


def shown(rows) -> list:
    return sorted(((r.grp, r["rank"], r.witness, r.subroot) for r in rows.collect()), key=str)


@pytest.mark.parametrize("after", [{"a": 9, "b": 4, "c": 70, None: 3}, {"a": 17, "b": 4, "c": 64}, {"a": 257, "c": 65, "d": 1}])
def test_appended_layers_equal_a_whole_tree(llm, after):
    """Blocks of four nodes; groups that are open, full, new or left alone."""
    forest = Forest(Work(llm), bits=2)
    before = {"a": 5, "b": 4, "c": 64}
    old = forest.grow(nodes(llm, before))
    grows = {g: n for g, n in after.items() if n > before.get(g, 0)}
    more = nodes(llm, grows, {g: n // 4 * 4 for g, n in before.items()})
    layers = forest.grown(old, more)
    assert shown(forest.witnesses(layers)) == shown(forest.witnesses(forest.grow(nodes(llm, before | after))))


def test_complete_blocks_are_not_appended_again(llm):
    forest = Forest(Work(llm), bits=2)
    old = forest.grow(nodes(llm, {"a": 10}))
    appended = forest.grown(old, nodes(llm, {"a": 11}, {"a": 8}))
    kept = lambda layers: sorted(map(tuple, layers[0].where("rank < 8").select("rank", "partial", "root").collect()))
    assert kept(old) == kept(appended)


def test_ranks_of_many_groups_and_ties(llm):
    rows = llm.range(500).select((F.col("id") % 7).cast("string").alias("grp"), (F.col("id") % 3).alias("k"))
    rows = rows.withColumn("grp", F.when(F.col("grp") != "0", F.col("grp"))).repartition(5)
    got = manifest.with_ranks(Work(llm), rows, ["k"]).collect()
    groups: dict = {}
    for r in got:
        groups.setdefault(r.grp, []).append((r["rank"], r.k, r.total))
    for members in groups.values():
        members.sort()
        assert [m[0] for m in members] == list(range(len(members))) and {m[2] for m in members} == {len(members)}
        assert [m[1] for m in members] == sorted(m[1] for m in members)
