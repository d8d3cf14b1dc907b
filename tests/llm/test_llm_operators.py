"""Every operator on edge rows and against a slow version."""

import hashlib
import random
import re
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from cases import COPY, bag, contamination, edge_docs, edge_rows, empty_docs, near_groups, removed, shingles, words
from tokenizers import Tokenizer

from sparkmart.llm import bpe, decontaminate, host_rules, html_text, neardup, quality, shards, spans, substrings, token_files, toxicity
from sparkmart.llm.work import Work

BYTE_BPE, WORD_BPE = (public_tokenizers.path(f"{n}.json") for n in ("byte_bpe_50k", "word_bpe_49k"))


@pytest.fixture(scope="module")
def small(llm, sf_dir):
    """A few hundred rows of the test documents: id, text."""
    return [(r.doc_id, r.text) for r in llm.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()]


def pairs(rows):
    return [(r[0], r[1]) for r in rows]


# words and hashes


def test_word_hashes_follow_the_pattern():
    texts = [t for _, t in pairs(edge_rows())]
    keys, offsets = spans.word_hashes(pa.array(texts), spans.NOT_SPACE)
    assert np.diff(offsets).tolist() == [len(words(t)) for t in texts]
    again, _ = spans.word_hashes(pa.array(["Two WORDS two"]), spans.NOT_SPACE)
    assert again[0] == again[2] != again[1]


def test_slices_keep_all_rows_and_nulls():
    batch = pa.RecordBatch.from_arrays([pa.array(["ab", None, "c" * 50, "", "d"])], ["text"])
    got = [x for part in spans.sliced([batch.slice(1, 4)], limit=10) for x in part.column("text").to_pylist()]
    assert got == [None, "c" * 50, "", "d"]


# 1 quality classifier


def labelled(llm, n=400):
    rng = random.Random(3)
    good = [" ".join(rng.choice(["river", "stone", "quiet", "harbour", "letter", "window"]) for _ in range(60)) for _ in range(n)]
    bad = [" ".join(rng.choice(["$$$", "BUY!!", "click|", "win###", "%%%"]) for _ in range(60)) for _ in range(n)]
    texts = [t for pair in zip(good, bad) for t in pair]
    docs = edge_docs(llm, [(i, t, "s", "en", 1) for i, t in enumerate(texts)] + [(2 * n, None, "s", "en", 1), (2 * n + 1, "", "s", "en", 1)])
    labels = llm.createDataFrame([(i, 1 - i % 2, i % 2) for i in range(2 * n)] + [(None, 1, 0)], "doc_id long, quality int, toxic int")
    return docs, labels


def test_quality_separates_held_out_rows(llm):
    docs, labels = labelled(llm)
    rows = quality.score(llm, docs, quality.learn(llm, docs, labels)).collect()
    assert len(rows) == 802 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    held = [r for r in rows if r.doc_id < 800 and zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert {r.doc_id for r in held} == {r.doc_id for r in rows if r.held_out and r.doc_id < 800}
    assert sum(r.predicted == 1 - r.doc_id % 2 for r in held) / len(held) > 0.98
    kept = quality.keep_good(llm, docs, quality.learn(llm, docs, labels))
    assert kept.columns == docs.columns


def test_quality_without_labels_and_rows(llm):
    docs, labels = edge_docs(llm), labelled(llm, 2)[1].where("false")
    rows = quality.score(llm, docs, quality.learn(llm, docs, labels)).collect()
    assert len(rows) == len(edge_rows()) and {r.score for r in rows} == {0.5}
    assert quality.score(llm, empty_docs(llm), quality.learn(llm, empty_docs(llm), labels)).count() == 0


def test_quality_on_the_test_documents(llm):
    sf = "/root/testdata/sf0.1"
    docs, labels = llm.read.parquet(f"{sf}/documents.parquet"), llm.read.parquet(f"{sf}/labels.parquet")
    scored = quality.score(llm, docs, quality.learn(llm, docs, labels)).where("held_out").join(labels, "doc_id")
    assert scored.where("predicted = quality").count() / scored.count() > 0.97


# 9 toxicity


def test_toxicity_on_the_test_documents(llm):
    sf = "/root/testdata/sf0.1"
    docs, labels = llm.read.parquet(f"{sf}/documents.parquet"), llm.read.parquet(f"{sf}/labels.parquet")
    scored = toxicity.score(llm, docs, toxicity.learn(llm, docs, labels)).where("held_out").join(labels, "doc_id")
    n = {(r.toxic, r.predicted): r["count"] for r in scored.groupBy("toxic", "predicted").count().collect()}
    assert n[1, 1] / (n[1, 1] + n[1, 0]) > 0.8 and n.get((0, 1), 0) / n[0, 0] < 0.01


def test_toxicity_sees_misspelt_words(llm):
    rng = random.Random(5)
    plain = [f"{rng.choice('bdfgklmnprst')}{rng.choice('aeiou')}{rng.choice('bdfgklmnprst')}{i}" for i in range(300)]
    rows = []
    for i in range(600):
        text = [rng.choice(plain) for _ in range(30)]
        if i % 2:
            text[rng.randrange(30)] = rng.choice(["blunderhead", "muddlewit"])
        rows.append((i, " ".join(text), "s", "en", 1))
    docs = edge_docs(llm, rows)
    labels = llm.createDataFrame([(i, i % 2) for i in range(600)], "doc_id long, toxic int")
    model = toxicity.learn(llm, docs, labels)
    score = model.scores(pa.array(["you blunderheed there", "blunderhead", "quiet harbour", None, "", " ".join(plain)]))
    assert min(score[:2]) > 0.7 and max(score[2:]) < 0.5


def test_toxicity_on_edge_rows(llm):
    labels = llm.createDataFrame([], "doc_id long, toxic int")
    rows = toxicity.score(llm, edge_docs(llm), toxicity.learn(llm, edge_docs(llm), labels)).collect()
    assert len(rows) == len(edge_rows()) and all(r.predicted == 0 for r in rows)
    assert toxicity.score(llm, empty_docs(llm), toxicity.learn(llm, empty_docs(llm), labels)).count() == 0


# 2 text of pages

PAGE = """<!doctype html><html><head><title>T</title><style>p{}</style></head><body><h1>A  b</h1><p>One<p>Two <b>x</b><br>y
<ul><li>a<li>b<ul><li>c</ul><li>d</ul><ol><li>x<li value=7>y</ol><table><tr><th>Name<th>N<tr><td>long name<td>3<tr>
<td>z<td>44</table><p hidden>no<div style="x:y; display : none">no</div><pre> a
   b </pre><script>var t="</p>"</script>tail &amp; &lt;x"""
TEXT = """A b

One

Two x
y

- a
- b
  - c
- d

1. x
7. y

Name       N
long name  3
z          44

 a
   b

tail & <x"""


def test_page_layout():
    assert html_text.render(PAGE) == TEXT
    assert html_text.render(None) == html_text.render("") == html_text.render("<p hidden>x") == ""
    assert html_text.render("a < b <1") == "a < b <1"
    assert html_text.render("<div>" * 5000 + "deep") == "deep"
    nested = "<table><tr><td>a<table><tr><td>b<td>c</table><td>d<tr><td colspan=2>wide</table>"
    assert html_text.render(nested) == "a     d\n\nb  c\nwide"
    assert html_text.render("<div style='visibility:hidden'>x</div><template>y</template>z<input type=hidden value=v>") == "z"


def test_misplaced_content_of_tables_is_kept():
    for page, text in (
        ("<table><tr><form><td>Name<td>N</form></tr></table>", "Name  N"),
        ("<table><tr><center><td>Name</center><td>N</tr></table>", "Name  N"),
        ("<table><tbody><form><tr><td>a<td>b</tr><tr><td>c</tr></form></table>", "a  b\nc"),
        ("<table><tr>loose text</tr><tr><td>a</table>", "loose text\na"),
        ("<table><tbody><p>x</p><tr><td>a</tbody></table>", "x\na"),
        ("<table><tr><p>x</p><p hidden>y</p><td>a</tr></table>", "x\na"),
        ("<table><colgroup>x</colgroup><tr><td>a</table>", "x\na"),
        ("<table><tr><form><table><tr><td>in</table></form><td>a</table>", "in\na"),
    ):
        assert html_text.render(page) == text, page


def test_cells_that_span():
    assert html_text.render("<table><tr><td rowspan=2>ab<td>c<td>d<tr><td>e<td>f<tr><td>g</table>") == "ab  c  d\n    e  f\ng"
    assert html_text.render("<table><tr><td>a<td rowspan=3 colspan=2>b<td>c<tr><td>d<td>e</table>") == "a  b   c\nd      e"
    grouped = "<table><tbody><tr><td rowspan=0>a<td>b<tr><td>c</tbody><tbody><tr><td>d<td>e</table>"
    assert html_text.render(grouped) == "a  b\n   c\nd  e"
    wide = "<table><tr><td colspan=999>a<td>x<tr>" + "<td>b" * 999 + "<td>y</table>"
    assert [x.index(c) for x, c in zip(html_text.render(wide).split("\n"), "xy")] == [2997, 2997]


def test_blocks_inside_cells():
    for page, text in (
        ("<table><tr><td><h1>Title</h1><p>Para one.</p><ul><li>a</ul></td>", "Title\n\nPara one.\n\n- a"),
        ("<table><tr><td><p>a<p>b<td>c<tr><td>long one<td>d</table>", "a         c\n\nb\nlong one  d"),
        ("<table><tr><td>a<td><pre>x\n y</pre><tr><td>b<td>z</table>", "a  x\n    y\nb  z"),
        ("<table><tr><td>\u6f22\u5b57<td>a<tr><td>abcd<td>b<tr><td>e\u0301<td>c", "\u6f22\u5b57  a\nabcd  b\ne\u0301     c"),
    ):
        assert html_text.render(page) == text, page


def test_what_is_seen():
    for page, text in (
        ("<p style='visibility:hidden'>a<b style='visibility: visible'>B</b>c</p>", "B"),
        ("<table style='visibility:hidden'><tr>x<td>a<td style='visibility:visible'>b</table>", "  b"),
        ("<p style='display:none'>a<b style='visibility:visible'>B</b>c</p>d", "d"),
        ("<script>a</script x>b", "b"),
        ("<SCRIPT>'</scripts>'</SCRIPT\n>b", "b"),
        ("<xmp><b>x</b></xmp>y", "<b>x</b>\n\ny"),
        ("<xmp>open <i>", "open <i>"),
        ("a<plaintext><b>x</b></plaintext>", "a\n\n<b>x</b></plaintext>"),
        ("x<!-- c --!>d<!-->e<!--->f<!-- -- > -->g<!-- open", "xdefg"),
        ("<dialog>x</dialog><dialog open>y</dialog>", "y"),
        ("<object>f</object> <canvas>g</canvas>", "f g"),
    ):
        assert html_text.render(page) == text, page


def test_list_numbers():
    assert html_text.render("<ol start=5><li>a<li>b</ol>") == "5. a\n6. b"
    assert html_text.render("<ol reversed><li>a<li hidden>x<li value=9>b<li>c</ol>") == "3. a\n9. b\n8. c"
    assert html_text.render("<ol reversed start=0><li>a<li>b</ol>") == "0. a\n-1. b"
    assert html_text.render("<ol start=x><li>a<li value=y>b</ol>") == "1. a\n2. b"
    assert html_text.render("<ul><li><li>a<ul><li></ul>b</ul>") == "- a\n  b"


def test_padding_is_linear_in_the_page():
    rows, items = "<tr><td>a<td>b" * 3_000, "<ul><li>x" * 3_000
    for page in (
        f"<table><tr><td>{'w ' * 20_000}<td>y{rows}</table>",
        "<table><tr>" + "<td colspan=1000 rowspan=2>x" * 400 + "<tr><td>y" * 200,
        "<table><tr>" + "<td rowspan=0>x" * 2_000 + "<tr><td>y" * 2_000,
        items,
        "<table><tr><td>a<td>b<tr><td>c<td>" * 500,
    ):
        text = html_text.render(page)
        assert len(text) <= html_text.PADDING + (html_text.PADDING_PER_CHARACTER + 2) * len(page)
        words = re.sub("<[^>]*>", "", page)
        assert Counter(text.replace("-", "").replace(" ", "").replace("\n", "")) == Counter(words.replace(" ", ""))


def test_any_depth():
    for tag in ("div", "b", "font", "span"):
        deep = f"<{tag}>" * 20_000
        assert html_text.render(f"{deep}a<script>var x</script><style>p</style><p hidden>no</p><i style='display:none'>no</i>") == "a"
        assert html_text.render(f"{deep}<table><tr><td>a<td>b<tr><td>c</table>") == "a  b\nc"
        assert html_text.render(f"<section hidden>{deep}x{f'</{tag}>' * 20_000}y</section>z") == "z"
        assert html_text.render(f"<table><tr>{deep}<td>a</table>b") == "a\n\nb"
    assert html_text.render("<table><tr><td>" * 3000 + "a") == "a"
    assert html_text.render("<ul><li>" * 300 + "a") == "- " * 300 + "a"


def test_pages(llm):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (None, None, None), (2, None, "")]
    pages = llm.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' as text")
    got = html_text.extract(llm, pages)
    assert bag(got.collect()) == Counter([(1, "u", TEXT)] * 2 + [(None, None, ""), (2, None, "")])
    assert html_text.extract(llm, pages.where("false")).count() == 0


# 3 near duplicates


def test_near_groups_on_edge_rows(llm):
    rows = pairs(edge_rows())
    want = near_groups(rows)
    got = neardup.find_groups(llm, edge_docs(llm)).collect()
    expected = Counter((i, len(shingles(t)), want.get(i) if shingles(t) else i, i is None or (want[i] if shingles(t) else i) == i) for i, t in rows)
    assert bag(got) == expected
    assert neardup.find_groups(llm, empty_docs(llm)).count() == 0
    kept = neardup.keep_one(llm, edge_docs(llm))
    assert kept.columns == edge_docs(llm).columns
    assert bag(kept.select("doc_id", "text").collect()) == Counter((i, t) for i, t in rows if i is None or want[i] == i)


def test_near_groups_of_a_family(llm):
    """Many copies of one text with a few changed words each: links are decided by the full sets."""
    rng = random.Random(11)
    base = [f"w{rng.randrange(500)}" for _ in range(130)]
    rows = []
    for i in range(300):
        text = list(base)
        for _ in range(rng.randrange(7)):
            text[rng.randrange(130)] = f"x{rng.randrange(2000)}"
        rows.append((1000 - i, " ".join(text)))
    got = {r.doc_id: r.component_id for r in neardup.find_groups(llm, edge_docs(llm, [(i, t, "s", "en", 1) for i, t in rows])).collect()}
    assert got == near_groups(rows)


def test_siblings_in_a_templated_source(llm):
    """Texts of one template that is no link by itself (0.74); pairs of them share a few words more.
    They meet in buckets of hundreds only, where no centre links them."""
    template, rows = [f"t{i}" for i in range(343)], []
    for i in range(200):
        common = [f"s{i}x{k}" for k in range(7)]
        for j in range(2):
            rows.append((2 * i + j, " ".join([*template, *common, *(f"u{i}x{j}x{k}" for k in range(54))])))
    want = near_groups(rows)
    assert len(set(want.values())) == 200
    got = {r.doc_id: r.component_id for r in neardup.find_groups(llm, edge_docs(llm, [(i, t, "s", "en", 1) for i, t in rows])).collect()}
    assert got == want


def test_rare_pairs_cover_all_similar_sets(llm):
    """Sets of many sizes around the limit, in parts of many sizes."""
    rng = random.Random(29)
    base, sets = [rng.getrandbits(64) for _ in range(60)], {}
    for i in range(300):
        keep = rng.sample(base, rng.randrange(30, 61))
        sets[i] = sorted({*keep, *(rng.getrandbits(64) for _ in range(rng.randrange(20)))})
    part = {i: rng.choice([0, 0, 0, 1, 2, i]) for i in sets}
    want = {
        frozenset((i, j)) for i in sets for j in sets
        if part[i] != part[j] and 7 * len({*sets[i]} & {*sets[j]}) >= 3 * (len(sets[i]) + len(sets[j]))
    }
    stored = llm.createDataFrame([(i, np.array(x, np.uint64).tobytes()) for i, x in sets.items()], "node long, shingles binary")
    parts = llm.createDataFrame(list(part.items()), "id long, part long")
    got = {frozenset(r) for r in neardup.rare_pairs(Work(llm), stored, parts).collect()}
    assert len(want) > 500 and want <= got


def test_signatures_estimate_similarity():
    texts = [" ".join(f"t{i}" for i in range(a, a + 400)) for a in (0, 20, 40, 100)] + ["a b c d e f", "a b c d e f"]
    keys, offsets = neardup.shingle_sets(pa.array(texts))
    minima = neardup.signatures(keys, offsets)
    for j, similarity in ((1, 376 / 416), (2, 356 / 436), (3, 296 / 496)):
        assert abs((minima[0] == minima[j]).mean() - similarity) < 0.15
    assert (minima[4] == minima[5]).all()


# 4 token files


def test_packing_of_every_width():
    rng = np.random.default_rng(0)
    for bits in (1, 5, 16, 17, 31, 32):
        ids = rng.integers(0, 2**bits, 70_001).astype(np.uint64)
        assert (token_files.unpack(token_files.pack(ids, bits), bits)[: len(ids)] == ids).all()
    ids = rng.integers(0, 49_408, 200_001)
    file = token_files.TokenFile(token_files.write_file([None, 5, 9], np.array([0, 200_000, 1]), ids, 16, 2))
    assert (file.read_ids(65_530, 131_080) == ids[65_530:131_080]).all() and (file.document(1) == ids[:200_000]).all()
    assert token_files.bits_for(49_408) == 16 and token_files.bits_for(65_537) == 17 and file.missing == 1


@pytest.mark.parametrize("file_ids", [1 << 20, 50])
def test_token_files(llm, small, monkeypatch, file_ids):
    monkeypatch.setattr(token_files, "FILE_IDS", file_ids)
    tokenizer = Tokenizer.from_file(WORD_BPE)
    for docs, rows in ((edge_docs(llm), pairs(edge_rows())), (edge_docs(llm, [(i, t, "s", "e", 1) for i, t in small]), small)):
        ids = [(i, [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]) for i, t in rows]
        got = token_files.read_documents(token_files.write_tokens(llm, docs, WORD_BPE, 2, Work(llm))).collect()
        crc = lambda x: zlib.crc32(np.array(x, "<u4").tobytes())
        assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == Counter((i, len(x), crc(x)) for i, x in ids)
        got.sort(key=lambda r: r.start)
        assert [r.start for r in got] == np.cumsum([0, *(r.n_tokens for r in got)])[:-1].tolist()
        order = [(r.doc_id is not None, r.doc_id or 0) for r in got]
        assert order == sorted(order)
    assert token_files.read_documents(token_files.write_tokens(llm, empty_docs(llm), WORD_BPE, 2, Work(llm))).count() == 0


# 5 decontamination

ITEMS = [
    (1, "one two three four five six seven eight nine ten eleven twelve thirteen"),
    (2, "four five six seven"), (2, "four five six seven"), (3, None), (4, "!!!"), (10, "w1x1"), (11, COPY), (12, "seven, Eight; NINE ten ELEVEN twelve thirteen fourteen"),
]


@pytest.mark.parametrize("most", [1_000_000, 0])
def test_contamination(llm, small, most):
    items = [*ITEMS, *((100 + i, t[200:400]) for i, t in small[:20])]
    bench = llm.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' as hash", "1 as length")
    rows = [*edge_rows(), *((i + 1000, t, "s", "e", 1) for i, t in small)]
    got = decontaminate.judge(llm, edge_docs(llm, rows), bench, max_broadcast=most).collect()
    assert bag(got) == bag(contamination(pairs(rows), items))
    assert decontaminate.judge(llm, empty_docs(llm), bench, max_broadcast=most).count() == 0
    none = decontaminate.judge(llm, edge_docs(llm), bench.where("false"), max_broadcast=most)
    assert none.count() == len(edge_rows()) and none.where("contaminated or n_hit > 0").count() == 0


def test_contaminated_rows_go(llm, monkeypatch):
    bench = llm.createDataFrame(ITEMS, "item_id long, text string")
    want = Counter((i, t) for (i, t), r in zip(pairs(edge_rows()), contamination(pairs(edge_rows()), ITEMS)) if not r[-1])
    for most in (10, 0):
        monkeypatch.setattr(decontaminate, "MAX_BROADCAST", most * 1000)
        kept = decontaminate.drop_contaminated(llm, edge_docs(llm).drop("_row"), bench)
        assert bag(kept.select("doc_id", "text").collect()) == want


# 6 quality rules


def test_base_measures(llm):
    rows = {r.doc_id: r for r in host_rules.judge(llm, edge_docs(llm, [
        (1, "a b c d e a b c d e a b", "h", "", 1), (2, "x\ny\n \nx\n", "h", "", 1), (3, "é# $| z", "h", "", 1), (4, None, "h", "", 1),
        (5, " ".join(f"u{i}" for i in range(40)), "h", "", 1), (6, " ".join(f"u{i}" for i in range(40)), None, "", 1),
    ])).collect()}
    measures = lambda i: tuple(rows[i])[2:7]
    assert measures(1) == (12, 12, 0, 0, 12) and rows[1].base_failed
    assert measures(2) == (3, 3, 0, 1, 0) and measures(3) == (2, 6, 3, 0, 0) and measures(4) == (0, 0, 0, 0, 0)
    assert not rows[6].base_failed and rows[6].kept


def test_bad_hosts_lose_their_good_documents(llm):
    fine = " ".join(f"u{i}" for i in range(40))
    rows = [(i, "short", "bad", "", 1) for i in range(95)] + [(i, fine, "bad", "", 1) for i in range(95, 100)]
    rows += [(i, fine, f"h{i % 20}", "", 1) for i in range(100, 2000)] + [(2000, "short", "one", "", 1), (2001, fine, "one", "", 1)]
    kept = {r.doc_id for r in host_rules.judge(llm, edge_docs(llm, rows)).where("kept").collect()}
    assert kept == set(range(100, 2000)) | {2001}
    assert host_rules.judge(llm, edge_docs(llm)).count() == len(edge_rows())
    assert host_rules.judge(llm, empty_docs(llm)).count() == 0


# 7 repeated substrings


def test_covers_are_perfect():
    for v, cover in substrings.COVERS.items():
        assert sorted((a - b) % v for a in cover for b in cover if a != b) == list(range(1, v))


@pytest.mark.parametrize("length", [200, 21])
def test_removed_bytes(llm, small, monkeypatch, length):
    monkeypatch.setattr(substrings, "BUCKET_KEYS", 5000)
    monkeypatch.setattr(substrings, "BLOCK_BYTES", 50_000)
    rng = random.Random(length)
    runs = ["".join(rng.choice("ab ") for _ in range(n)) for n in (length - 1, length, length + 1, 3 * length)]
    rows = [r for r in edge_rows() if len(r[1] or "") < 10_000] + [(i + 1000, t, "s", "e", 1) for i, t in small[:80]]
    for i in range(60):
        text = "".join(rng.choice(runs)[rng.randrange(3) :] + chr(rng.randrange(97, 1000)) for _ in range(rng.randrange(1, 4)))
        rows.append((2000 + i, text, "s", "e", 1))
    want = Counter((i, *r[:4]) for (i, _), r in zip(pairs(rows), removed([t for _, t in pairs(rows)], length)))
    assert bag(substrings.removed_bytes(llm, edge_docs(llm, rows), length).collect()) == want
    assert substrings.removed_bytes(llm, empty_docs(llm), length).count() == 0


def test_texts_without_repeats(llm):
    rows = [(1, "é" * 99 + "x" + COPY, "s", "e", 0), (2, "y" + COPY + "z", "s", "e", 0), (3, None, "s", "e", None)]
    got = substrings.without_repeats(llm, edge_docs(llm, rows), n_chars="n_chars")
    want = [x[4].decode("utf-8", "ignore") for x in removed([t for _, t in pairs(rows)])]
    assert {r.doc_id: (r.text, r.n_chars) for r in got.collect()} == {1: (want[0], len(want[0])), 2: (want[1], len(want[1])), 3: (None, None)}
    assert got.columns == edge_docs(llm).columns


def test_a_block_gets_its_own_answers_and_few_blocks_a_row_group(llm, small, monkeypatch):
    monkeypatch.setattr(substrings, "BUCKET_KEYS", 5000)
    monkeypatch.setattr(substrings, "BLOCK_BYTES", 20_000)
    docs = edge_docs(llm, [(i, t, "s", "e", 1) for i, t in small]).coalesce(1)
    shuffles = llm.sparkContext._jsc.sc().env().mapOutputTracker().shuffleStatuses()
    before = shuffles.size()
    found = substrings.Substrings(llm, docs)
    assert shuffles.size() <= before + 2  # of the rows' own dealing and of the sum of bytes, none of keys
    rows = found.second.collect()
    assert len(rows) > 8 and len({r.part for r in rows}) == 1
    for name in ("first", "second"):
        buckets = [[x.bucket for x in r[name] or ()] for r in rows]
        assert any(buckets) and all(len(x) == len(set(x)) for x in buckets)
    files = [pq.ParquetFile(f).metadata for f in Path(found.work.dir.removeprefix("file:"), "blocks").glob("*.parquet")]
    assert sum(m.num_rows for m in files) == len(rows)
    assert max(m.row_group(i).num_rows for m in files for i in range(m.num_row_groups)) <= 4


# 8 sharding


def test_shards(llm, small):
    rows = [*edge_rows(), *((i + 1000, t, "s", "e", 1) for i, t in small)]
    got = shards.shard_documents(llm, edge_docs(llm, rows), [1.0] * 16).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in pairs(rows))
    assert all(r.grown_shard in (r.shard, 16) and 0 <= r.shard < 16 for r in got)
    for shard in range(16):
        mine = sorted((r for r in got if r.shard == shard), key=lambda r: r.slot)
        assert [r.slot for r in mine] == list(range(len(mine)))
        order = [(r.doc_id is not None, r.doc_id or 0) for r in mine]
        assert order == sorted(order)
    assert len({(r.doc_id, r.shard) for r in got}) == len({r.doc_id for r in got})
    assert shards.shard_documents(llm, empty_docs(llm), [1.0, 2.0]).count() == 0


def test_weights_and_growth(llm):
    keys = llm.range(40_000)
    got = keys.select(shards.shard_of([1.0, 3.0], keys["id"]).alias("a"), shards.shard_of([1.0, 3.0, 1.0], keys["id"]).alias("b")).collect()
    assert abs(sum(r.a == 1 for r in got) / 40_000 - 0.75) < 0.01
    assert all(r.b in (r.a, 2) for r in got) and abs(sum(r.b == 2 for r in got) / 40_000 - 0.2) < 0.01


# 10 byte-level BPE


def test_bpe_equals_the_library(llm, small):
    tokenizer = Tokenizer.from_file(BYTE_BPE)
    rows = [*pairs(edge_rows()), *((i + 1000, t) for i, t in small), (9999, "!?" * 3000 + " x  \n y<|endoftext|>I'll ")]
    docs = edge_docs(llm, [(i, t, "s", "e", 1) for i, t in rows])
    got = bpe.encode_documents(llm, docs, BYTE_BPE, lexicon_words=2000, with_ids=True).collect()
    want = []
    for i, t in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids
        text = tokenizer.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest(), tuple(ids)))
    assert Counter((*r[:4], tuple(r[4])) for r in got) == Counter(want)
    assert bpe.encode_documents(llm, empty_docs(llm), BYTE_BPE).count() == 0


def test_lexicon_is_minimal_and_exact():
    words = sorted(w.encode() for w in ["tap", "taps", "top", "tops", "a", "", "stop"])
    x = bpe.compile_lexicon(words)
    assert len(x["final"]) == 8  # tap and top, taps and tops end in the same states
    with open(BYTE_BPE, encoding="utf-8") as file:
        vocab = bpe.Vocabulary(file.read())
    encoder = bpe.Encoder(vocab, x)
    assert encoder.look_up([*words, b"to", b"tapsx", b"b"]).tolist() == [*range(len(words)), -1, -1, -1]
    rng = random.Random(1)
    for word in (bytes(rng.randrange(97, 105) for _ in range(n)) for n in (1, 2, 7, 40, 48) for _ in range(20)):
        assert bpe.merge([word], vocab)[0].tolist() == bpe.merge_long(word, vocab)
