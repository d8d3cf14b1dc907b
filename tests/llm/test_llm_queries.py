"""Registered queries of this subpackage against their SQL, and the pipeline stage by stage."""

import hashlib
from collections import Counter

import corpus_pipeline
import numpy as np
import pytest
from cases import bag, contamination, near_groups, removed
from compare import connect, differences
from tokenizers import Tokenizer

from sparkmart.llm import quality
from sparkmart.llm.queries import QUERIES, tokenizer_path
from sparkmart.llm.work import table


@pytest.mark.parametrize("name", sorted(n for n, q in QUERIES.items() if q.sql))
def test_query_equals_sql(llm, sf_dir, name):
    assert differences(QUERIES[name].run(llm, sf_dir), connect(sf_dir), QUERIES[name].sql) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"op12_spelling_variants"}))  # its rows are words
def test_query_returns_every_row(llm, sf_dir, name):
    rows = QUERIES[name].run(llm, sf_dir)
    assert rows.count() == table(llm, sf_dir, "pages" if name.startswith(("op2_", "op13_")) else "documents").count()
    assert len(rows.columns) == len(set(rows.columns))


def test_stages(llm, sf_dir, tmp_path):
    docs, kept = table(llm, sf_dir, "documents"), []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(llm, docs, sf_dir)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.schema.simpleString() == docs.schema.simpleString(), name
        out.write.parquet(f"{tmp_path}/{k}")
        kept.append((docs.collect(), (docs := llm.read.parquet(f"{tmp_path}/{k}")).collect()))
    (before, good), (_, one), (_, cut), (_, clean), (_, tokens) = kept

    model = quality.learn(llm, table(llm, sf_dir, "documents"), table(llm, sf_dir, "labels"))
    scores = quality.score(llm, table(llm, sf_dir, "documents"), model).collect()
    assert {r.doc_id for r in good} == {r.doc_id for r in scores if r.predicted} and 0 < len(good) < len(before)

    groups = near_groups([(r.doc_id, r.text) for r in good])
    assert bag(one) == bag(r for r in good if groups[r.doc_id] == r.doc_id) and len(one) < len(good)

    rest = [x[4].decode("utf-8", "ignore") for x in removed([r.text for r in one])]
    assert Counter((r.doc_id, r.text, r.n_chars, r.lang, r.source) for r in cut) == Counter((r.doc_id, t, len(t), r.lang, r.source) for r, t in zip(one, rest))
    assert sum(map(len, rest)) < sum(len(r.text) for r in one)

    items = [(r.item_id, r.text) for r in table(llm, sf_dir, "benchmark").collect()]
    verdict = contamination([(r.doc_id, r.text) for r in cut], items)
    assert bag(clean) == bag(r for r, v in zip(cut, verdict) if not v[-1])

    tokenizer = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    ids = {r.doc_id: tokenizer.encode(r.text, add_special_tokens=False).ids for r in clean}
    assert {r.doc_id: list(r.token_ids) for r in tokens} == ids
    assert all(r.ids_sha256 == hashlib.sha256(np.array(ids[r.doc_id], "<u4").tobytes()).hexdigest() for r in tokens)
    assert bag(corpus_pipeline.run(llm, sf_dir).select("doc_id", "n_tokens", "ids_sha256").collect()) == bag((r.doc_id, r.n_tokens, r.ids_sha256) for r in tokens)
