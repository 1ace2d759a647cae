"""A corpus cleaning pipeline of five stages over ``documents``.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame. ``run`` writes each stage's result as Parquet to the shared
folder and rereads it as the next one's docs. All stages but the last return the
columns of documents.

1. language_id: documents without a language (no text or no letter) go.
2. near_duplicates: of each group of near duplicates the document with the
   smallest id stays.
3. decontaminate: documents that hold a window of a benchmark item go.
4. pii: personal data in the text is replaced by its kind, and n_chars set anew.
5. tokenize: token ids of every text, decoded again as a check.

Rows without an id are kept by the near-duplicate stage; rows with equal ids and
texts are one document there and stay once. Rows with equal ids and different
texts are documents of their own: each is decided by its text's group, and where
one group's smallest id has several texts, that with the smallest row key stays.
Of rows with equal ids and texts the one whose columns come first in order stays.
Columns of any other name are carried through unchanged.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.llm import bpe, decontaminate, langid, ngram_join, pii
from ebbtide.llm.scratch import ship, stored

#: SQL of run()'s rows: none, since language identification, masking and byte-level BPE have none.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents whose language was determined; learns as the operator's query does."""
    ship(spark)
    model = langid.fit(docs.filter(~langid.held_out("doc_id")))
    own = [f"c{i}" for i in range(len(docs.columns))]  # no name that the prediction adds
    told = langid.predict(docs.toDF(*own), model, own[docs.columns.index("text")])
    return told.filter(F.col("lang_pred") != langid.UNDETERMINED).select(*own).toDF(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group."""
    ship(spark)
    groups = stored(ngram_join.near_duplicates(docs, with_keys=True), "groups").filter("doc_id is not null")
    keys = groups.groupBy("doc_id", "row_key").agg(
        F.count(F.lit(1)).alias("n"), F.bool_or(F.expr("doc_id <> component_id or row_key <> component_key")).alias("gone"))
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), ngram_join.row_key().alias("key"))
    odd = keys.filter("gone or n > 1").select(F.col("doc_id").alias("id"), F.col("row_key").alias("key"), "gone")
    kept = rows.join(odd, ["id", "key"], "left").filter("gone is null or not gone")
    repeated = kept.filter("gone is not null").groupBy("id", "key", "row.text").agg(F.min("row").alias("row"))
    return kept.filter("gone is null").select("row.*").unionByName(repeated.select("row.*"))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that hold no window of a benchmark item."""
    ship(spark)
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data in the text; keeps all documents."""
    ship(spark)
    return pii.masked(docs).withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"])).select(*docs.columns)


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with their digests."""
    ship(spark)
    return bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminated),
    ("pii", without_pii),
    ("tokenize", tokenized),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
