"""Registry: one query per operator over its whole table, and the pipeline.

Each query takes ``(spark, sf_dir)``, applies its operator with production
parameters and derives the columns of its contract.
"""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontaminate, embedding_join, exact_dedup, html_extract, langid, lexical_search, ngram_join, pii, sharding, substring_dedup, warc, whitening
from .scratch import ship

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.deduplicate(_table(spark, sf_dir, "documents"), with_text=False)


def op2_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(_table(spark, sf_dir, "pages"))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(_table(spark, sf_dir, "documents"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op5_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(_table(spark, sf_dir, "documents"), n_shards=24)


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(_table(spark, sf_dir, "documents"))


def op7_embedding_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_join.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.encode(_table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN, with_ids=False)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.round_trip(_table(spark, sf_dir, "pages"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_table(spark, sf_dir, "documents"))


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicates(_table(spark, sf_dir, "documents"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whiten(_table(spark, sf_dir, "embeddings"))
    return found.withColumn("deviation", F.col("deviation").cast("bigint"))


def all_queries() -> dict[str, Query]:
    return {
        "op1_substring_dedup": op1_substring_dedup,
        "op2_html_extract": op2_html_extract,
        "op3_ngram_join": op3_ngram_join,
        "op4_decontaminate": op4_decontaminate,
        "op5_shard": op5_shard,
        "op6_pii": op6_pii,
        "op7_embedding_join": op7_embedding_join,
        "op8_bpe": op8_bpe,
        "op9_warc": op9_warc,
        "op10_langid": op10_langid,
        "op11_exact_dedup": op11_exact_dedup,
        "op12_lexical_search": op12_lexical_search,
        "op13_whitening": op13_whitening,
        "pipeline": corpus_pipeline.run,
    }
