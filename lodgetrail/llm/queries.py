"""Driver queries of this subpackage, and their SQL counterparts where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lodgetrail.llm import (
    ann, counts, fim, fst, kdtree, lm, orc_tokens, packing, quality, simhash, spelling, toxicity, urls,
)
from lodgetrail.llm.tables import table
from lodgetrail.sources import scratch

#: Host, path and verdict of the listed URLs.
RULES = [
    ("org", "/", urls.ALLOW),
    ("example.org", "/es/", urls.BLOCK),
    ("example.org", "/en/1", urls.BLOCK),
    ("com", "/fr/", urls.ALLOW),
    ("com", "/de/", urls.BLOCK),
]

BYTE_BPE, WORD_BPE, PIECES = "byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), lambda i: i % 50 == 0, 5)[0]


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fst.round_trips(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.component_table(table(spark, sf_dir, "documents"))


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(table(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch.fresh_path(spark, "token-files")
    orc_tokens.write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path(WORD_BPE))
    return orc_tokens.token_index(spark, path)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lengths = counts.encoded_lengths(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))
    return counts.limit_table(counts.histogram(lengths))


def op10_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kdtree.exact_top_k(table(spark, sf_dir, "embeddings"), lambda i: i % 20 == 0, 20)


def op11_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judged(table(spark, sf_dir, "pages"), urls.rule_table(spark, RULES))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digests(table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_toxicity, op2_nearest_neighbours, op3_sentencepiece, op4_simhash, op5_lm_scoring, op6_packing,
        op7_token_files, op8_quality, op9_token_counts, op10_exact_top_k,
        op11_url_filters, op12_fill_in_middle, op13_spelling_variants,
    )
}

ORACLES = {
    "op10_exact_top_k": """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 20 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored
QUALIFY rank <= 20
""",
    "op11_url_filters": """
WITH rules(rule_host, rule_path, listed) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
         ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), cut AS (
  SELECT page_id, coalesce(strpos(url, '://'), 0) AS mark, substr(url, strpos(url, '://') + 3) AS rest FROM pages
), sites AS (
  SELECT page_id,
    CASE WHEN mark > 0 THEN translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
    CASE WHEN mark > 0 THEN regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') ELSE '' END AS path
  FROM cut
), fitted AS (
  SELECT host, path, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
    arg_max(listed, length(rule_host || rule_path)) AS listed
  FROM (SELECT DISTINCT host, path FROM sites)
  JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY host, path
)
SELECT page_id, host, path, rule, coalesce(listed, 'allow') AS verdict FROM sites LEFT JOIN fitted USING (host, path)
""",
    "op12_fill_in_middle": r"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS drawn FROM documents
), units AS (
  SELECT *, regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS parts,
    CAST('0x' || drawn[1:8] AS BIGINT) AS h1, CAST('0x' || drawn[9:16] AS BIGINT) AS h2,
    CAST('0x' || drawn[17:24] AS BIGINT) AS h3, CAST('0x' || drawn[25:32] AS BIGINT) AS h4
  FROM texts
), cuts AS (
  SELECT *, least(h1 % (len(parts) + 1), h2 % (len(parts) + 1)) AS a, greatest(h1 % (len(parts) + 1), h2 % (len(parts) + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
         WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM units
), split AS (
  SELECT *, array_to_string(parts[1:a], '') AS prefix, array_to_string(parts[a + 1:b], '') AS middle,
    array_to_string(parts[b + 1:], '') AS suffix
  FROM cuts
)
SELECT doc_id, CAST(len(parts) AS BIGINT) AS n, form,
  CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
         ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM split
""",
}
