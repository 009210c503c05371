"""From raw documents to training tokens, in five stages over the ``documents`` table.

``STAGES`` lists ``(name, function)``; each function takes ``(spark, docs, sf_dir)`` and returns
a table that is written and read again as the next one's ``docs``.  All but the last return
the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from quaymark.llm import byte_bpe, chosen_path, linked_secrets, nearest_centroid, temperature_mix
from quaymark.session import materialize

#: No SQL can express n-gram centroids or merges; tests compare the stages with brute force.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised, with that language in place of a missing label."""
    model = nearest_centroid.fit(docs)
    found = nearest_centroid.predict(docs, model).where("not rejected")
    return found.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five words, a similarity of 0.8."""
    return chosen_path.keep_one_of_each(docs, words=5, percent=80).select(*docs.columns)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by the name of their kind."""
    masked = linked_secrets.mask_secrets(docs)
    return masked.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long"))).select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn for one epoch's worth of tokens; a document may be drawn more than once."""
    return temperature_mix.mix(docs, epochs=1.0, max_repetition=1.2).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document."""
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    encoded = byte_bpe.encode(docs.select("doc_id", "lang", "source", "text"), ranks, public_tokenizers.PATTERN)
    return encoded.withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("secrets", secrets), ("mixing", mixing), ("tokens", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's table for the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
