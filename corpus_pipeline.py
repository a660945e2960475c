"""A training corpus from raw documents, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, written as Parquet and read again as the next
one's docs. Quality rules drop bad documents, line dedup removes repeated multi-line passages from the
texts and drops documents of which nothing remains (copies of what earlier ones hold),
the n-gram Jaccard join keeps the smallest id of each group of near duplicates, decontamination drops documents with
benchmark passages, and BPE turns the rest into token ids. Null and empty texts fail the quality rules; repeated rows
pass or fall together until the join, which keeps one of those with the same id and text; an empty table stays empty; columns beyond those of documents pass through.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regisight.llm import bpe, decontaminate, jaccard, linededup, quality
from regisight.llm.common import small_batches
from regisight.session import materialise


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.filter_documents(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated passages, without the documents that were repeats as a whole; n_chars follows the text."""
    small_batches(spark)
    out = linededup.remove_repeated_lines(docs, drop_whole=True)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return jaccard.keep_representatives(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and whether they decode to it again."""
    small_batches(spark)
    return bpe.encode_checked(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("bpe_encoding", bpe_encoding),
]

#: Not expressible in SQL: content-defined chunks, the similarity join's components and BPE.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
