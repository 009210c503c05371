"""The queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

import corpus_pipeline
from quaymark.llm import (
    audit_repair,
    bloom_lm,
    byte_bpe,
    chosen_path,
    licence_scan,
    linked_secrets,
    nearest_centroid,
    nn_descent,
    phrase_index,
    segment_search,
    stratified_search,
    temperature_mix,
    weak_pii,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {
    "op4_licence_scan": licence_scan.oracle(),
    "op11_stratified_search": stratified_search.oracle(),
    "op12_phrase_index": phrase_index.oracle(),
}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def _benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet")


def _remainder(parts: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % parts


@query
def op1_chosen_path_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near copies by 3-word shingles at a similarity of 0.85."""
    return chosen_path.near_duplicates(_documents(spark, sf_dir), words=3, percent=85)


@query
def op2_weak_supervision_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every text: counts, digest of the base spans, all spans."""
    return weak_pii.digest(weak_pii.personal_data(_documents(spark, sf_dir)))


@query
def op3_temperature_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One epoch's worth of tokens, as even over the sources as drawing none more than 1.2 times allows."""
    drawn = temperature_mix.mix(_documents(spark, sf_dir), epochs=1.0, max_repetition=1.2)
    return drawn.select("doc_id", "source", "epoch", "n_tokens", "place")


@query
def op4_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices in the lines of every text."""
    return licence_scan.scan(_documents(spark, sf_dir))


@query
def op5_segment_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 largest integer inner products for each query vector."""
    rows = _embeddings(spark, sf_dir)
    return segment_search.top_k(rows, rows.where(F.col("vec_id") % 20 == 0), k=20, scale=64)


@query
def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every text and what they decode to, as digests."""
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    encoded = byte_bpe.encode(_documents(spark, sf_dir).select("doc_id", "text"), ranks, public_tokenizers.PATTERN)
    decoded = byte_bpe.decode(encoded, ranks)
    ids = F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256)
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), ids.alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op7_linked_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every text: counts, digest of the base spans, all spans."""
    return linked_secrets.digest(linked_secrets.secrets(_documents(spark, sf_dir)))


@query
def op8_nn_descent_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near copies among the vectors of a label at a cosine of 0.93."""
    return nn_descent.near_duplicate_vectors(_embeddings(spark, sf_dir), threshold=0.93)


@query
def op9_nearest_centroid_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every text, learnt from two thirds of the documents."""
    docs = _documents(spark, sf_dir).withColumn("held_out", F.coalesce(_remainder(3) == 1, F.lit(False)))
    model = nearest_centroid.fit(docs.where(_remainder(3) != 1))
    found = nearest_centroid.predict(docs.select("doc_id", "text", "held_out"), model)
    return found.select("doc_id", "held_out", "lang_pred", "score", "rejected")


@query
def op10_bloom_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probabilities of every text under a model learnt from nine tenths of the documents."""
    docs = _documents(spark, sf_dir)
    model = bloom_lm.learn(docs.where(_remainder(10) != 0))
    scored = bloom_lm.score(docs, model, steady=True)
    return scored.withColumn("held_out", F.coalesce(_remainder(10) == 0, F.lit(False)))


@query
def op11_stratified_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents for each item of the benchmark."""
    return stratified_search.search(_documents(spark, sf_dir), _benchmark(spark, sf_dir), k=50)


@query
def op12_phrase_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in passages of ten words of the benchmark."""
    return phrase_index.digest(phrase_index.contamination(_documents(spark, sf_dir), _benchmark(spark, sf_dir), words=10))


@query
def op13_audit_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults of every damaged conversation, its cheapest audit, and a digest of the repaired rows."""
    rows = audit_repair.damage(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return audit_repair.digest(*audit_repair.repair(rows))


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the corpus pipeline, applied to the documents."""
    return corpus_pipeline.run(spark, sf_dir)


if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
