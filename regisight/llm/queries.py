"""Registered queries of this package and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from regisight.llm import bpe, chat, covertree, decontaminate, html, jaccard, lexical, linededup, pii, quality, suffix, tokencount, topk
from regisight.llm.common import small_batches, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of every document."""
    return quality.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lines", "n_stop_words")


_STOP = ", ".join("'" + w + "'" for w in sorted({*quality.STOP_WORDS, *(w.capitalize() for w in quality.STOP_WORDS)}))
_RATIOS = {"mean_word_length": "word_chars / greatest(n_words, 1)::DOUBLE", "symbol_ratio": "n_symbols / greatest(n_words, 1)::DOUBLE",
           "stop_word_ratio": "n_stop_words / greatest(n_words, 1)::DOUBLE", "duplicate_line_ratio": "n_dup_lines / greatest(n_lines, 1)::DOUBLE"}
_HOLDS = " AND ".join(f"{_RATIOS[r.measure]} {sign} {limit}" for r in quality.RULES for sign, limit in ((">=", r.least), ("<=", r.most)) if limit is not None)

ORACLE["op9_quality_rules"] = rf"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM documents),
windows AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g FROM w, unnest(range(1, len(ws) - 1)) AS u(i)),
repeated AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM repeated, unnest([0, 1, 2]) AS t(k) GROUP BY 1),
m AS (
  SELECT doc_id, len(ws) AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
         coalesce(n, 0) AS n_repeat_words, len(ls) AS n_lines, len(list_filter(ws, lambda x: x IN ({_STOP}))) AS n_stop_words
  FROM w LEFT JOIN covered USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT *, NOT base_failed AND {_HOLDS} AS kept FROM b
"""


@query
def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document."""
    small_batches(spark)
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


ORACLE["op10_benchmark_decontamination"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
items AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
patterns AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS k, array_to_string(ws[i : i + 9], ' ') AS g FROM items, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS u(i) WHERE len(ws) > 0),
placed AS (
  SELECT doc_id, i, k, array_to_string(ws[i : i + k - 1], ' ') AS g
  FROM (SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM patterns))),
hits AS (SELECT doc_id, i, k, item_id FROM placed JOIN patterns USING (k, g)),
words AS (SELECT doc_id, count(DISTINCT i + j) AS n_hit FROM (SELECT doc_id, i, unnest(range(k)) AS j FROM hits) GROUP BY 1),
found AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256 FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY 1)
SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN found USING (doc_id)
"""


@query
def op3_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encoding and decoding of every document."""
    small_batches(spark)
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document."""
    small_batches(spark)
    return tokencount.count_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that repeat 100-byte strings, removed."""
    small_batches(spark)
    return suffix.remove_repeats(table(spark, sf_dir, "documents"), digest=True).withColumnRenamed("kept", "kept_sha256")


@query
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without multi-line chunks that an earlier one has."""
    small_batches(spark)
    return linededup.line_counts(table(spark, sf_dir, "documents"))


@query
def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingle counts and near-duplicate components of all documents."""
    small_batches(spark)
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    small_batches(spark)
    return html.extract_pages(table(spark, sf_dir, "pages"))


@query
def op5_pii_boosting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    found = pii.find_spans(table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("base", lambda b: b["kind"] == k)).cast("long").alias(f"n_{pii.KINDS[k]}")
    return found.select("doc_id", *(count(k) for k in range(4)), F.sha2(pii.joined(F.col("base")), 256).alias("base_sha256"),
                        pii.joined(F.sort_array(F.concat("base", "added"))).alias("spans"))


@query
def op11_ranked_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 documents that score highest for each benchmark item."""
    small_batches(spark)
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE["op11_ranked_lexical_search"] = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents),
counts AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY 1, 2),
lengths AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM counts GROUP BY 1),
corpus AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM lengths),
asked AS (
  SELECT item_id, term, count(*) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark) GROUP BY 1, 2),
weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM counts WHERE term IN (SELECT term FROM asked) GROUP BY 1), corpus),
scores AS (
  SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN counts USING (term) JOIN lengths USING (doc_id), corpus GROUP BY 1, 2),
ranked AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM scores WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 20
"""


@query
def op12_exact_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 vectors with the highest integer inner product for every vector whose id is divisible by 20."""
    small_batches(spark)
    return topk.top_inner_products(table(spark, sf_dir, "embeddings"), F.pmod("vid", F.lit(20)) == 0)


_KEPT = """kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)"""

ORACLE["op12_exact_topk_search"] = f"""
WITH {_KEPT.format(scale=64)},
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score FROM kept q JOIN kept c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
ranked AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM scores)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 20
"""


@query
def op13_vector_code_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code and error of every vector, and the digest of the codebooks."""
    small_batches(spark)
    coded, codebooks = covertree.compress(table(spark, sf_dir, "embeddings"))
    return coded.select("vec_id", "code", "error", "label_error", F.lit(covertree.digest(codebooks)).alias("codebooks_sha256"))


def _lloyd_sql(rounds: int) -> str:
    parts = """parts AS (
  SELECT vec_id, label, p, list_transform(v[4 * p + 1 : 4 * p + 4], lambda x: x::BIGINT) AS x FROM kept, range(16) r(p))"""
    start = """book0 AS (
  SELECT p, e, x FROM parts JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept ORDER BY vec_id LIMIT 64) USING (vec_id))"""
    steps = [f"WITH {_KEPT.format(scale=256)}", parts, start]
    for i in range(rounds + 1):
        steps.append(f"""near{i} AS (
  SELECT vec_id, any_value(label) AS label, p, any_value(a.x) AS x, arg_min(e, (list_distance(a.x::DOUBLE[], b.x::DOUBLE[]) ** 2).round()::BIGINT * 64 + e) AS e,
         min((list_distance(a.x::DOUBLE[], b.x::DOUBLE[]) ** 2).round()::BIGINT) AS d
  FROM parts a JOIN book{i} b USING (p) GROUP BY vec_id, p)""")
        if i < rounds:
            mean = ", ".join(f"floor(sum(x[{j}])::DOUBLE / count(*))::BIGINT" for j in range(1, 5))
            steps.append(f"""book{i + 1} AS (
  SELECT p, e, coalesce(m.x, b.x) AS x FROM book{i} b LEFT JOIN (SELECT p, e, [{mean}] AS x FROM near{i} GROUP BY p, e) m USING (p, e))""")
    return ",\n".join(steps) + f""",
codes AS (SELECT vec_id, any_value(label) AS label, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM near{rounds} GROUP BY vec_id)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) FROM book{rounds}) AS codebooks_sha256
FROM codes
"""


ORACLE["op13_vector_code_compression"] = _lloyd_sql(2)


@query
def op8_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All messages in reply order, without quotes."""
    return chat.reply_order(table(spark, sf_dir, "conversations"))


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    return corpus_pipeline.run(spark, sf_dir)
