"""Queries and oracle SQL of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline

from .common import documents, tokenizer
from .decontam import containment_pairs
from .embeddings import near_vectors
from .langid import identify_languages
from .licenses import scan_licenses
from .linededup import deduplicate_lines
from .lm_scoring import score_documents
from .merkle import verify_manifest
from .minhash import near_duplicates
from .packing import pack
from .quality import quality_scores
from .sharding import shard_documents
from .spelling import spelling_variants
from .topk import top_k


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(documents(spark, sf_dir))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(documents(spark, sf_dir))


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), width=4)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), tokenizer())


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(documents(spark, sf_dir))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return containment_pairs(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op8_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicate_lines(documents(spark, sf_dir))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(documents(spark, sf_dir))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(documents(spark, sf_dir))


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verify_manifest(documents(spark, sf_dir))


def op13_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_sharding": op2_sharding,
    "op3_minhash": op3_minhash,
    "op4_packing": op4_packing,
    "op5_language": op5_language,
    "op6_quality": op6_quality,
    "op7_decontamination": op7_decontamination,
    "op8_embeddings": op8_embeddings,
    "op9_line_dedup": op9_line_dedup,
    "op10_licenses": op10_licenses,
    "op11_spelling": op11_spelling,
    "op12_manifest": op12_manifest,
    "op13_topk": op13_topk,
    "pipeline": corpus_pipeline.run,
}

LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
WORDS = r"regexp_extract_all(translate(coalesce(text, ''), {lower}), '[^\x20\x09-\x0D]+')".format(lower=LOWER)

OP7_SQL = f"""
WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
ds AS (SELECT doc_id, i - 1 AS place, array_to_string(w[i:i + 4], ' ') AS s
       FROM (SELECT doc_id, w, unnest(range(1, CAST(len(w) AS BIGINT) - 3)) AS i FROM d)),
b AS (SELECT item_id, {WORDS} AS w FROM benchmark),
bs AS (SELECT DISTINCT item_id, array_to_string(w[i:i + least(5, len(w)) - 1], ' ') AS s
       FROM (SELECT item_id, w, unnest(range(1, CAST(len(w) - least(5, len(w)) AS BIGINT) + 2)) AS i FROM b WHERE len(w) > 0)),
n AS (SELECT item_id, count(*) AS n_item FROM bs GROUP BY item_id)
SELECT doc_id, item_id, n_item, count(DISTINCT s) AS n_shared,
       CAST(count(DISTINCT s) AS DOUBLE) / n_item AS containment,
       min(place) AS first_word, max(place) + 4 AS last_word
FROM ds JOIN bs USING (s) JOIN n USING (item_id)
GROUP BY doc_id, item_id, n_item
HAVING 10 * count(DISTINCT s) >= 8 * n_item
"""


def crc32_sql(text: str) -> str:
    """The unsigned crc32 of an ASCII or UTF-8 text, bit by bit."""
    octets = f"encode({text})"
    bits = (
        f"flatten(list_transform(range(0, octet_length({octets})), lambda i: list_transform(range(0, 8), "
        f"lambda b: CAST(get_bit(CAST({octets} AS BIT), CAST(8 * i + 7 - b AS INTEGER)) AS BIGINT))))"
    )
    step = "xor(c >> 1, CASE WHEN xor(c, b) & 1 = 1 THEN 3988292384 ELSE 0 END)"
    return f"xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, {bits}), lambda c, b: {step}))"


OP11_SQL = rf"""
WITH RECURSIVE r AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), {LOWER}), '[a-z\x{{00C0}}-\x{{00FF}}]+')) AS run
  FROM documents),
d AS (SELECT run, count(*) AS n, {crc32_sql("doc_id || ':' || run")} AS h FROM r GROUP BY doc_id, run),
v AS (SELECT n, CASE WHEN h % 97 = 0 THEN left(run, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2)
                ELSE run END AS word FROM d),
w AS (SELECT word, CAST(sum(n) AS BIGINT) AS n, length(word) AS l FROM v WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
x AS (SELECT word, unnest(range(0, l)) AS i FROM w),
y AS (SELECT word, left(word, i) || '*' || substr(word, i + 2) AS hole, left(word, i) || substr(word, i + 2) AS shorter FROM x),
e AS (SELECT a.word, b.word AS near FROM y a JOIN y b USING (hole) WHERE a.word <> b.word
      UNION SELECT y.word, w.word FROM y JOIN w ON y.shorter = w.word
      UNION SELECT w.word, y.word FROM y JOIN w ON y.shorter = w.word),
p AS (SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM e JOIN w a USING (word) JOIN w b ON b.word = e.near),
f AS (SELECT word, n, count(*) AS n_near, max(near_n) AS best_n, arg_min(near, (-near_n, near)) AS best FROM p GROUP BY word, n),
k AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 2 * w.n THEN best END AS form,
             CASE WHEN best_n >= 2 * w.n THEN best_n END AS form_n FROM w LEFT JOIN f USING (word)),
t AS (SELECT word, word AS root, form AS onward FROM k
      UNION ALL SELECT t.word, k.word, k.form FROM t JOIN k ON k.word = t.onward)
SELECT word, form, root, n, n_near, form_n FROM k JOIN (SELECT word, root FROM t WHERE onward IS NULL) USING (word)
"""


def _field_sql(column: str) -> str:
    return f"coalesce(strlen(CAST({column} AS VARCHAR)) || ':' || {column}, '-')"


def _leaf_sql(n_chars: str) -> str:
    return "sha256(" + " || ".join(_field_sql(c) for c in ("doc_id", "source", "lang", n_chars, "text")) + ")"


OP12_SQL = f"""
WITH RECURSIVE leaf AS (
  SELECT doc_id, coalesce('=' || lang, '') AS tree, {_leaf_sql("n_chars")} AS leaf,
         CASE WHEN {crc32_sql("CAST(doc_id AS VARCHAR)")} % 7 = 0 THEN {_leaf_sql("(n_chars + 1)")} ELSE {_leaf_sql("n_chars")} END AS checked
  FROM documents),
placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id) - 1 AS idx, count(*) OVER (PARTITION BY tree) AS n FROM leaf),
node AS (SELECT tree, n, 0 AS level, idx, leaf AS h FROM placed
  UNION ALL
  SELECT tree, (n + 1) // 2, level + 1, idx // 2, sha256(string_agg(h, '' ORDER BY idx)) FROM node WHERE n > 1
  GROUP BY tree, n, level, idx // 2),
subroot AS (SELECT tree, h, row_number() OVER (ORDER BY tree) - 1 AS idx, count(*) OVER () AS n FROM node WHERE n = 1),
crown AS (SELECT n, 0 AS level, idx, h FROM subroot
  UNION ALL
  SELECT (n + 1) // 2, level + 1, idx // 2, sha256(string_agg(h, '' ORDER BY idx)) FROM crown WHERE n > 1
  GROUP BY n, level, idx // 2),
climb AS (SELECT doc_id, tree, leaf, checked AS h, idx, n, 0 AS level, '' AS proof FROM placed
  UNION ALL
  SELECT c.doc_id, c.tree, c.leaf,
         sha256(CASE WHEN c.idx % 2 = 1 THEN coalesce(s.h, '') || c.h ELSE c.h || coalesce(s.h, '') END),
         c.idx // 2, (c.n + 1) // 2, c.level + 1, c.proof || coalesce(s.h, '')
  FROM climb c LEFT JOIN node s ON s.tree = c.tree AND s.level = c.level AND s.idx = xor(c.idx, 1) WHERE c.n > 1),
above AS (SELECT c.doc_id, c.leaf, c.h, c.proof, r.h AS subroot, r.idx, r.n, 0 AS level FROM climb c JOIN subroot r ON r.tree = c.tree WHERE c.n = 1
  UNION ALL
  SELECT c.doc_id, c.leaf,
         sha256(CASE WHEN c.idx % 2 = 1 THEN coalesce(s.h, '') || c.h ELSE c.h || coalesce(s.h, '') END),
         c.proof || coalesce(s.h, ''), c.subroot, c.idx // 2, (c.n + 1) // 2, c.level + 1
  FROM above c LEFT JOIN crown s ON s.level = c.level AND s.idx = xor(c.idx, 1) WHERE c.n > 1)
SELECT a.doc_id, a.leaf, a.subroot, r.h AS root, sha256(a.proof) AS proof_sha256, a.h AS folded_root, a.h = r.h AS verified
FROM above a JOIN crown r ON r.n = 1 WHERE a.n = 1
"""

OP13_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS w FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.w, c.w) AS BIGINT) AS score
      FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM s
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY rank <= 5
"""

ORACLE_SQL: dict[str, str] = {
    "op7_decontamination": OP7_SQL,
    "op11_spelling": OP11_SQL,
    "op12_manifest": OP12_SQL,
    "op13_topk": OP13_SQL,
}
