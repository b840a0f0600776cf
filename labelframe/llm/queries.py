"""One query per operator on the test tables, over whole tables and whole texts."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from labelframe.functions.checkpoints import materialize
from labelframe.llm import decontaminate, jaccard_join, license_scan, lm_score, packing, pii, prefix_trie, quality_classifier, quality_rules, token_counts, two_fit, warc, whitening

PIECES = "piece_bpe_32k.model"
TOKENIZER = "word_bpe_49k.json"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer() -> str:
    return Path(public_tokenizers.path(TOKENIZER)).read_text()


def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    pieces = token_counts.vocabulary(public_tokenizers.path(PIECES))
    return token_counts.token_counts(table(spark, folder, "documents"), pieces)


def op2_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.license_scan(table(spark, folder, "documents"))


def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return quality_rules.quality_rules(docs, quality_rules.fit(docs, table(spark, folder, "labels")))


def op4_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.jaccard_join(table(spark, folder, "documents")).drop("text_hash")


def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contained_items(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op6_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.find_personal_data(table(spark, folder, "documents"))


def op7_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    return lm_score.lm_score(table(spark, folder, "documents"))


def op8_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return quality_classifier.classify(docs, quality_classifier.fit(docs))


def op9_warc(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    archives = materialize(warc.archive_parts(warc.mark_revisits(pages)))
    read = warc.read_archives(archives, pages.schema["page_id"].dataType.simpleString())
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), tokenizer())


def op11_best_two_fit(spark: SparkSession, folder: str) -> DataFrame:
    return two_fit.pack_whole(table(spark, folder, "documents"), tokenizer())


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(table(spark, folder, "embeddings"))


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, folder, "conversations"))


QUERIES = (
    op1_token_counts,
    op2_license_scan,
    op3_quality_rules,
    op4_jaccard_join,
    op5_decontamination,
    op6_pii,
    op7_lm_score,
    op8_quality_classifier,
    op9_warc,
    op10_packing,
    op11_best_two_fit,
    op12_whitening,
    op13_prefix_trie,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    return {"op4_jaccard_join": OP4_SQL, "op5_decontamination": OP5_SQL, "op9_warc": OP9_SQL, "op13_prefix_trie": OP13_SQL}


WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

# a text of fewer than five words is one shingle of them all
SHINGLES = """SELECT DISTINCT {id}, array_to_string(w[k:k + 4], ' ') AS g FROM (
  SELECT {id}, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS k
  FROM (SELECT {id}, {words} AS w FROM {table}) WHERE len(w) > 0)"""

OP4_SQL = f"""
WITH RECURSIVE s AS MATERIALIZED ({SHINGLES.format(id="doc_id", words=WORDS, table="documents")}),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS MATERIALIZED (
  SELECT x, y FROM pairs JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y
  WHERE common >= 0.8 * (a.n + b.n - common) - 1e-9),
reached AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reached r JOIN links l ON r.y = l.x)
SELECT doc_id,
  least(doc_id, coalesce((SELECT min(y) FROM reached WHERE x = doc_id), doc_id)) AS class_id,
  (SELECT count(*) FROM links WHERE x = doc_id) AS n_links
FROM documents
"""

OP5_SQL = f"""
WITH d AS ({SHINGLES.format(id="doc_id", words=WORDS, table="documents")}),
i AS ({SHINGLES.format(id="item_id", words=WORDS, table="benchmark")}),
n AS (SELECT item_id, count(*) AS n_shingles FROM i GROUP BY 1),
shared AS (SELECT doc_id, item_id, count(*) AS n_shared FROM d JOIN i USING (g) GROUP BY 1, 2)
SELECT doc_id, item_id, n_shared, n_shingles, n_shared / n_shingles AS containment
FROM shared JOIN n USING (item_id) WHERE n_shared >= 0.8 * n_shingles - 1e-9
"""


OP9_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS size FROM pages
), g AS (
  SELECT *, max(page_id) OVER (PARTITION BY html) AS greatest FROM p
)
SELECT page_id, size AS payload_bytes, sha1(html) AS payload_digest,
  CASE WHEN size >= 1000 AND page_id <> greatest THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN size >= 1000 AND page_id <> greatest THEN greatest END AS refers_to
FROM g
"""

# CRC-32 of the decimal id, bit by bit; 3988292384 is its reflected polynomial
OP13_SQL = """
WITH own AS (
  SELECT conv_id AS c, list({'r': coalesce(role, ''), 'x': coalesce(text, '')} ORDER BY turn NULLS FIRST) AS q,
    xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT))),
      lambda a, b: list_reduce(list_concat([xor(a, b)], range(8)),
        lambda v, i: CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)), 4294967295) % 9 AS h
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), rebuilt AS (
  SELECT o.c, list_concat(coalesce(b.q[1:o.h], []), o.q[o.h + 1:]) AS q FROM own o LEFT JOIN own b ON b.c = o.c - o.c % 5
), prefix AS (
  SELECT c, q[1:d] AS p, d, len(q) = d AS ends FROM (SELECT c, q, unnest(range(0, len(q) + 1)) AS d FROM rebuilt)
), node AS MATERIALIZED (
  SELECT p, d, min(c) AS conv_id, count(*) AS n_convs, bool_and(ends) AS leaf,
    CASE WHEN d = 0 THEN 0 ELSE (count(*) - 1) * octet_length(encode(any_value(p[d].x))) END AS saved,
    sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE ends), '')) AS ends_sha256
  FROM prefix GROUP BY p, d
), below AS (
  SELECT p[1:a] AS p, sum(CAST(leaf AS BIGINT)) AS n_leaves, sum(saved) AS saved_tokens
  FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM node) GROUP BY 1
), children AS (
  SELECT p[1:d - 1] AS p, count(*) AS n FROM node WHERE d > 0 GROUP BY 1
)
SELECT n.conv_id, CAST(n.d AS INTEGER) AS depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n, 0) AS n_children,
  CAST(b.n_leaves AS BIGINT) AS n_leaves, CAST(b.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM node n JOIN below b ON b.p = n.p LEFT JOIN children k ON k.p = n.p LEFT JOIN node u ON n.d > 0 AND u.p = n.p[1:n.d - 1]
"""
