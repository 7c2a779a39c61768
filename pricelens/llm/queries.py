"""Registered queries of the training-data operators, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from pricelens.session import ensure_checkpoint_dir

from . import ann, bins, chat, decontaminate, jaccard, language, packing, ranked, secrets, token_files, tries, urls, wrappers
from .common import table, tokenizer_path

WORD_BPE, BYTE_BPE = "word_bpe_49k.json", "byte_bpe_50k.json"


def op1_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"))


def op2_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_preferences(*chat.swapped_replies(table(spark, sf_dir, "conversations")))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path(WORD_BPE))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.predict(docs, language.train(language.learnable(docs)))


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.extract(table(spark, sf_dir, "pages"))


def op6_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(table(spark, sf_dir, "pages"), urls.default_model(spark))


def op7_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{ensure_checkpoint_dir(spark)}/token_files/{uuid.uuid4().hex}"
    token_files.write_tokens(table(spark, sf_dir, "documents"), path, tokenizer_path(BYTE_BPE))
    return token_files.read_tokens(spark, path)


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link_counts(table(spark, sf_dir, "documents")).drop("n_links")


def op9_jaccard_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link_counts(table(spark, sf_dir, "documents"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_digest(secrets.find_secrets(table(spark, sf_dir, "documents")))


def op11_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.search(ranked.build_index(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tries.trie_digest(tries.build_trie(table(spark, sf_dir, "conversations"), tries.fifth_heads))


def op13_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bins.pack_digest(bins.pack_whole(table(spark, sf_dir, "documents"), tokenizer_path(BYTE_BPE)))


QUERIES = {f.__name__: f for f in (op1_nearest, op2_preferences, op3_packing, op4_language, op5_main_text, op6_urls, op7_contamination,
                                   op8_token_files, op9_jaccard_join, op9_jaccard_links, op10_secrets, op11_ranked, op12_prefix_trie, op13_best_fit)}
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = f"coalesce(regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), [])"
_TERMS = f"coalesce(regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+'), [])"
_TOKENS = f"coalesce(regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+'), [])"

ORACLES: dict[str, str] = {
    "op7_contamination": f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark WHERE text IS NOT NULL),
win AS (SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS win
 FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
 FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT DISTINCT doc_id, dw.n AS n, i, item FROM dw JOIN win ON dw.win = win.win AND dw.n = win.n),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
its AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM hits GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
 sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos ON d.doc_id = pos.doc_id LEFT JOIN its ON d.doc_id = its.doc_id""",
    "op9_jaccard_join": f"""
WITH RECURSIVE d AS (SELECT doc_id, {_TOKENS} AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE
  list_distinct(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM d),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM items a JOIN items b ON a.g = b.g AND a.doc_id <> b.doc_id
 GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
reach(a, b) AS (SELECT doc_id, doc_id FROM d UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT sets.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, c.component_id
FROM sets JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) c ON sets.doc_id = c.a""",
    "op11_ranked": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS w FROM documents),
b AS (SELECT row_number() OVER () AS b, item_id, {_TERMS} AS w FROM benchmark),
size AS (SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM d WHERE len(w) > 0),
norm AS (SELECT r, doc_id, 25 + (75 * len(w) * n_docs) // n_terms AS m FROM d, size WHERE len(w) > 0),
asked AS (SELECT b, item_id, term, count(*) AS repeats FROM (SELECT b, item_id, unnest(w) AS term FROM b) GROUP BY b, item_id, term),
held AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d) WHERE term IN (SELECT term FROM asked) GROUP BY r, term),
weight AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
 FROM (SELECT term, count(*) AS df FROM held GROUP BY term), size),
scored AS (SELECT b, item_id, r, doc_id, CAST(sum(repeats * weight.w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
 FROM asked JOIN held USING (term) JOIN weight USING (term) JOIN norm USING (r) GROUP BY b, item_id, r, doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY b ORDER BY score DESC, doc_id NULLS FIRST) AS rank FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10""",
    "op12_prefix_trie": """
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list({'r': role, 't': text} ORDER BY turn NULLS FIRST, sha256(concat(sha256(role), sha256(text)))) AS turns FROM t GROUP BY conv_id),
heads AS (SELECT conv_id, turns, conv_id - conv_id % 5 AS base, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
  flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: [CAST(ascii(x) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))),
  lambda a, e: xor(xor(a, e) >> 1, (xor(a, e) & 1) * 3988292384)), CAST(4294967295 AS BIGINT)) % 9 AS h FROM own),
rebuilt AS (SELECT heads.conv_id, list_concat(coalesce(b.turns[1:h], []), heads.turns[h + 1:]) AS seq FROM heads LEFT JOIN own b ON heads.base = b.conv_id),
paths AS (SELECT conv_id, d, len(seq) = d AS is_end, seq[1:d] AS pre FROM (SELECT conv_id, seq, unnest(range(0, len(seq) + 1)) AS d FROM rebuilt)),
nodes AS (SELECT d, pre, min(conv_id) AS conv_id, count(*) AS n_convs,
  coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE is_end), '') AS ends FROM paths GROUP BY d, pre),
kids AS (SELECT d - 1 AS d, pre[1:d - 1] AS pre, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1, 2),
own_sums AS (SELECT n.d, n.pre, coalesce(k.n, 0) = 0 AS leaf, CASE WHEN n.d = 0 THEN 0 ELSE (n_convs - 1) * octet_length(encode(n.pre[n.d].t)) END AS saved
 FROM nodes n LEFT JOIN kids k ON n.d = k.d AND n.pre = k.pre),
up AS (SELECT a AS d, pre[1:a] AS pre, sum(CAST(leaf AS BIGINT)) AS n_leaves, sum(saved) AS saved
 FROM (SELECT pre, leaf, saved, unnest(range(0, d + 1)) AS a FROM own_sums) GROUP BY 1, 2)
SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, CAST(coalesce(k.n, 0) AS BIGINT) AS n_children,
 CAST(up.n_leaves AS BIGINT) AS n_leaves, CAST(up.saved AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM nodes n JOIN up ON n.d = up.d AND n.pre = up.pre LEFT JOIN kids k ON n.d = k.d AND n.pre = k.pre
LEFT JOIN nodes p ON p.d = n.d - 1 AND p.pre = n.pre[1:n.d - 1]""",
    "op9_jaccard_links": f"""
WITH RECURSIVE d AS (SELECT doc_id, {_TOKENS} AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE
  list_distinct(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM d),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM items a JOIN items b ON a.g = b.g AND a.doc_id <> b.doc_id
 GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
reach(a, b) AS (SELECT doc_id, doc_id FROM d UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT sets.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, c.component_id, CAST(coalesce(l.n, 0) AS BIGINT) AS n_links
FROM sets JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) c ON sets.doc_id = c.a
LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) l ON sets.doc_id = l.a""",
}
