"""The operators of this package as queries over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratebook.llm import (
    bpe,
    chat,
    chosen_path,
    fertility,
    hilbert,
    merkle,
    packing,
    pivots,
    secret_scan,
    suffix_dedup,
    token_counts,
    toxicity,
    whitening,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def word_vocabulary() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


def piece_vocabulary() -> str:
    return public_tokenizers.path("piece_bpe_32k.model")


def byte_vocabulary() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


def query(make: Callable[[SparkSession, str], DataFrame]):
    QUERIES[make.__name__] = make
    return make


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def categories():
    """What `labels` says of a document, in the order of the chain."""
    return {"low_quality": F.lit(1) - F.col("quality"), "toxic": F.col("toxic")}


@query
def op1_hilbert_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert.search(table(spark, sf_dir, "embeddings"), every=20)


@query
def op2_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    chain = toxicity.train(docs, table(spark, sf_dir, "labels"), categories())
    return toxicity.scored(docs, chain)


@query
def op3_pivot_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivots.search(table(spark, sf_dir, "embeddings"), every=50)


@query
def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = packing.pieces(table(spark, sf_dir, "documents"), word_vocabulary(), keep_ids=False)
    return packing.pack(cut)


@query
def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digests(secret_scan.scan(table(spark, sf_dir, "documents")))


@query
def op6_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.perspectives(table(spark, sf_dir, "conversations"))


@query
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.count_tokens(table(spark, sf_dir, "documents"), byte_vocabulary())
    return counts.withColumn("over_limit", F.col("n_tokens") > 1024)


@query
def op8_bpe_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoded_digests(table(spark, sf_dir, "documents"), word_vocabulary())


@query
def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(table(spark, sf_dir, "documents"))


@query
def op10_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.digests(table(spark, sf_dir, "documents"))


@query
def op12_fertility_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fertility.judged(table(spark, sf_dir, "documents"), piece_vocabulary())


@query
def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whitening.whiten(table(spark, sf_dir, "embeddings"))
    # null where a long is too short; the operator's own column holds it exactly
    return rows.withColumn("deviation", F.col("deviation").try_cast("long"))


ORACLE["op3_pivot_search"] = pivots.SQL
ORACLE["op6_perspectives"] = chat.SQL
ORACLE["op11_merkle_manifest"] = merkle.SQL
