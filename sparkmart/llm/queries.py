"""The registered queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from . import bpe, decontaminate, host_rules, html_text, manifest, neardup, quality, shards, spelling, substrings, token_files, toxicity, warc
from .work import Work, reachable, table

SHARDS = 16


@dataclass(frozen=True)
class LlmQuery:
    query: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.query(reachable(spark), sf_dir)


def tokenizer_path(name: str) -> str:
    """The file of an installed public tokenizer."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(spark, docs, quality.learn(spark, docs, table(spark, sf_dir, "labels")))


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(spark, table(spark, sf_dir, "pages"))


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.find_groups(spark, table(spark, sf_dir, "documents"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    files = token_files.write_tokens(spark, docs, tokenizer_path("word_bpe_49k.json"), 2, Work(spark))
    return token_files.read_documents(files)


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.judge(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = host_rules.judge(spark, table(spark, sf_dir, "documents"))
    return judged.drop("host")


def op7_repeated_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.removed_bytes(spark, table(spark, sf_dir, "documents"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shard_documents(spark, table(spark, sf_dir, "documents"), [1.0] * SHARDS)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(spark, docs, toxicity.learn(spark, docs, table(spark, sf_dir, "labels")))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(spark, table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.manifest(spark, table(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(spark, table(spark, sf_dir, "documents"))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(spark, table(spark, sf_dir, "pages"))


SQL_3 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents
), sh AS (
  SELECT DISTINCT doc_id, list_slice(w, i + 1, i + 5) AS s
  FROM (SELECT doc_id, w, unnest(range(greatest(len(w) - 4, 1))) AS i FROM d WHERE len(w) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id
), common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM sh x JOIN sh y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2
), link AS (
  SELECT a, b FROM common JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 75 * (na.n + nb.n - c)
), e AS (SELECT a, b FROM link UNION SELECT b, a FROM link
), reach(a, b) AS (SELECT DISTINCT a, a FROM e UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a
), comp AS (SELECT a AS doc_id, min(b) AS c FROM reach GROUP BY a)
SELECT doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(comp.c, doc_id) AS component_id, doc_id = coalesce(comp.c, doc_id) AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN comp USING (doc_id)
"""

SQL_5 = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, list_slice(w, i + 1, i + least(len(w), 13)) AS win
  FROM (SELECT item_id, w, unnest(range(len(w) - least(len(w), 13) + 1)) AS i FROM b WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM bw
), dw AS (
  SELECT doc_id, n, i, list_slice(w, i + 1, i + n) AS win
  FROM (SELECT doc_id, w, n, unnest(range(len(w) - n + 1)) AS i FROM d, sizes WHERE len(w) >= n)
), hits AS (SELECT dw.doc_id, dw.i, dw.n, bw.item_id FROM dw JOIN bw USING (n, win)
), places AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id
), ids AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS s
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN places USING (doc_id) LEFT JOIN ids USING (doc_id)
"""

SQL_6 = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), wins AS (
  SELECT doc_id, i, list_slice(w, i + 1, i + 5) AS win FROM (SELECT doc_id, w, unnest(range(len(w) - 4)) AS i FROM d WHERE len(w) >= 5)
), twice AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS c FROM wins) WHERE c > 1
), rep AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM twice) GROUP BY doc_id
), lines AS (
  SELECT doc_id, count(*) - count(DISTINCT l) AS n
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM d) WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY doc_id
), m AS (
  SELECT doc_id, source, len(w)::BIGINT AS n_words, len(array_to_string(w, ''))::BIGINT AS word_chars,
    len(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    coalesce(lines.n, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN rep USING (doc_id) LEFT JOIN lines USING (doc_id)
), f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m
), hosts AS (SELECT source, count(*) AS n, count(*) FILTER (base_failed) AS x FROM f WHERE source IS NOT NULL GROUP BY source
), sums AS (SELECT sum(n) AS n, sum(x) / sum(n) AS mean, count(*) AS h, sum(x * x / n) AS sq FROM hosts
), prior AS (SELECT mean, mean * (1 - mean) AS most,
    greatest(sq / n - mean * mean - mean * (1 - mean) * h / n, mean * (1 - mean) * 0.001) AS spread FROM sums
), k AS (SELECT mean, CASE WHEN spread > 0 THEN greatest(most / spread - 1, 0) ELSE 0 END AS k FROM prior
), bad AS (SELECT source FROM hosts, k WHERE (x + mean * k) / (n + k) > 0.5)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND bad.source IS NULL AS kept
FROM f LEFT JOIN bad USING (source)
"""

SQL_7 = r"""
WITH d AS (
  SELECT doc_id, encode(coalesce(text, '')) AS b, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents
), wins AS (
  SELECT doc_id, i, md5(array_slice(b, i + 1, i + 200)) AS win FROM (SELECT doc_id, b, unnest(range(n - 199)) AS i FROM d WHERE n >= 200)
), twice AS (SELECT win FROM wins GROUP BY win HAVING count(*) > 1
), starts AS (SELECT doc_id, i FROM wins WHERE win IN (SELECT win FROM twice)
), marked AS (
  SELECT doc_id, i, CASE WHEN i <= lag(i) OVER w + 200 THEN 0 ELSE 1 END AS new FROM starts WINDOW w AS (PARTITION BY doc_id ORDER BY i)
), spans AS (
  SELECT doc_id, min(i) AS a, max(i) + 200 AS z
  FROM (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM marked) GROUP BY doc_id, g
), pieces AS (
  SELECT doc_id, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS a, a AS z FROM spans
  UNION ALL SELECT d.doc_id, coalesce(max(spans.z), 0), any_value(n) FROM d LEFT JOIN spans USING (doc_id) GROUP BY d.doc_id
), kept AS (
  SELECT doc_id, string_agg(substr(h, 2 * a + 1, 2 * (z - a)), '' ORDER BY a) AS h FROM pieces JOIN d USING (doc_id) GROUP BY doc_id
), sums AS (SELECT doc_id, sum(z - a) AS gone, count(*) AS spans FROM spans GROUP BY doc_id)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans,
  sha256(unhex(kept.h)) AS kept_sha256
FROM d JOIN kept USING (doc_id) LEFT JOIN sums USING (doc_id)
"""

#: The table of the CRC-32 checksum, one entry for each byte.
SQL_CRC = r"""crc AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM (SELECT unnest(range(256)) AS i))
)"""

SQL_11 = r"""
WITH RECURSIVE """ + SQL_CRC + r""", fields AS (
  SELECT doc_id, lang, n_chars, [doc_id::VARCHAR, source, lang, n_chars::VARCHAR, text] AS f,
    [doc_id::VARCHAR, source, lang, (n_chars + 1)::VARCHAR, text] AS g,
    xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda d: ascii(d))),
      lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) AS h
  FROM documents, crc
), leaves AS (
  SELECT *, sha256(array_to_string(list_transform(f, lambda v: coalesce(strlen(v) || ':' || v, '-')), '')) AS leaf,
    sha256(array_to_string(list_transform(g, lambda v: coalesce(strlen(v) || ':' || v, '-')), '')) AS other FROM fields
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM leaves
), nodes(lang, level, pos, n, d) AS (
  SELECT lang, 0, pos, n, leaf FROM placed
  UNION ALL
  SELECT lang, any_value(level) + 1, pos // 2, any_value((n + 1) // 2), sha256(string_agg(d, '' ORDER BY pos)) FROM nodes WHERE n > 1 GROUP BY lang, pos // 2
), subs AS (
  SELECT lang, d, level, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1
), tops(level, pos, n, d) AS (
  SELECT 0, pos, n, d FROM subs
  UNION ALL
  SELECT any_value(level) + 1, pos // 2, any_value((n + 1) // 2), sha256(string_agg(d, '' ORDER BY pos)) FROM tops WHERE n > 1 GROUP BY pos // 2
), walk(lang, leaf_pos, level, pos, height, cur, proof) AS (
  SELECT p.lang, p.pos, 0, p.pos, s.level, CASE WHEN h % 7 = 0 AND n_chars IS NOT NULL THEN other ELSE leaf END, ''
  FROM placed p JOIN subs s ON s.lang IS NOT DISTINCT FROM p.lang
  UNION ALL
  SELECT w.lang, leaf_pos, w.level + 1, w.pos // 2, height,
    sha256(CASE WHEN w.pos % 2 = 0 THEN cur || coalesce(o.d, '') ELSE coalesce(o.d, '') || cur END), proof || coalesce(o.d, '')
  FROM walk w LEFT JOIN nodes o ON o.lang IS NOT DISTINCT FROM w.lang AND o.level = w.level AND o.pos = xor(w.pos, 1) WHERE w.level < height
), up(lang, leaf_pos, level, pos, height, cur, proof) AS (
  SELECT w.lang, leaf_pos, 0, s.pos, (SELECT max(level) FROM tops), cur, proof FROM walk w JOIN subs s ON s.lang IS NOT DISTINCT FROM w.lang WHERE w.level = height
  UNION ALL
  SELECT u.lang, leaf_pos, u.level + 1, u.pos // 2, height,
    sha256(CASE WHEN u.pos % 2 = 0 THEN cur || coalesce(o.d, '') ELSE coalesce(o.d, '') || cur END), proof || coalesce(o.d, '')
  FROM up u LEFT JOIN tops o ON o.level = u.level AND o.pos = xor(u.pos, 1) WHERE u.level < height
)
SELECT doc_id, leaf, s.d AS subroot, (SELECT d FROM tops WHERE n = 1) AS root, sha256(proof) AS proof_sha256, cur AS folded_root,
  cur = (SELECT d FROM tops WHERE n = 1) AS verified
FROM placed p JOIN up u ON u.lang IS NOT DISTINCT FROM p.lang AND u.leaf_pos = p.pos JOIN subs s ON s.lang IS NOT DISTINCT FROM p.lang
WHERE u.level = height
"""

SQL_12 = r"""
WITH """ + SQL_CRC + r""", runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{C0}-\x{FF}]{7,}')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents
), found AS (SELECT doc_id, run, count(*) AS n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS h FROM runs GROUP BY doc_id, run
), bytes AS (
  SELECT run, n, list_transform(range(len(h) // 2), lambda i: 16 * (instr('0123456789ABCDEF', h[2 * i + 1]) - 1) + instr('0123456789ABCDEF', h[2 * i + 2]) - 1) AS b FROM found
), sums AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295, b), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) AS h FROM bytes, crc
), cut AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % len(run)) || substr(run, h % len(run) + 2) ELSE run END AS word, n FROM sums
), words AS (SELECT word, sum(n)::BIGINT AS n FROM cut WHERE len(word) >= 7 GROUP BY word HAVING sum(n) >= 2
), less AS (
  SELECT word, i, substr(word, 1, i) AS a, substr(word, i + 2) AS z FROM (SELECT word, unnest(range(len(word))) AS i FROM words)
), pairs AS (
  SELECT x.word AS v, y.word AS w FROM less x JOIN less y ON x.i = y.i AND x.a = y.a AND x.z = y.z AND x.word <> y.word
  UNION SELECT x.word, y.word FROM less x JOIN words y ON x.a || x.z = y.word
  UNION SELECT y.word, x.word FROM less x JOIN words y ON x.a || x.z = y.word
), best AS (
  SELECT v, count(*) AS n_near, first(w ORDER BY n DESC, w) AS near, max(n) AS near_n FROM pairs JOIN words ON word = w GROUP BY v
), forms AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 10 * n THEN near END AS form, CASE WHEN near_n >= 10 * n THEN near_n END AS form_n
  FROM words LEFT JOIN best ON v = word
), steps AS (
  WITH RECURSIVE s(word, root, turn) AS (
    SELECT word, word, 0 FROM words UNION ALL SELECT s.word, f.form, s.turn + 1 FROM s JOIN forms f ON f.word = s.root WHERE f.form IS NOT NULL)
  SELECT word, max_by(root, turn) AS root FROM s GROUP BY word
)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN steps USING (word)
"""

SQL_13 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages
), d AS (SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha256(html) AS payload_digest, min(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= 100 AND first IS DISTINCT FROM page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND first IS DISTINCT FROM page_id THEN first END AS refers_to FROM d
"""

QUERIES: dict[str, LlmQuery] = {
    "op1_quality_classifier": LlmQuery(op1_quality_classifier),
    "op2_html_text": LlmQuery(op2_html_text),
    "op3_near_duplicates": LlmQuery(op3_near_duplicates, SQL_3),
    "op4_token_files": LlmQuery(op4_token_files),
    "op5_benchmark_decontamination": LlmQuery(op5_benchmark_decontamination, SQL_5),
    "op6_quality_rules": LlmQuery(op6_quality_rules, SQL_6),
    "op7_repeated_substrings": LlmQuery(op7_repeated_substrings, SQL_7),
    "op8_sharding": LlmQuery(op8_sharding),
    "op9_toxicity": LlmQuery(op9_toxicity),
    "op10_bpe": LlmQuery(op10_bpe),
    "op11_merkle_manifest": LlmQuery(op11_merkle_manifest, SQL_11),
    "op12_spelling_variants": LlmQuery(op12_spelling_variants, SQL_12),
    "op13_warc": LlmQuery(op13_warc, SQL_13),
}
