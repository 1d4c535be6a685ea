"""One query per operator over the whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sampleward.llm import (
    binary_output,
    byte_bpe,
    language,
    lexical,
    packing,
    quality,
    resampling,
    secret_scan,
    sharding,
    simhash,
    sketches,
    token_counts,
    topk,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op1_packing(spark, sf):
    return packing.pieces_digest(packing.pack(read(spark, sf, "documents"), WORD_BPE))


@query
def op2_bpe(spark, sf):
    return byte_bpe.round_trip_digest(read(spark, sf, "documents"), BYTE_BPE)


@query
def op6_binary_output(spark, sf):
    return binary_output.rows_digest(binary_output.pack_rows(read(spark, sf, "documents"), BYTE_BPE))


@query
def op10_token_counts(spark, sf):
    return token_counts.count_tokens(read(spark, sf, "documents"), BYTE_BPE)


@query
def op9_simhash(spark, sf):
    return simhash.near_duplicates(read(spark, sf, "documents"))


@query
def op3_secret_scan(spark, sf):
    return secret_scan.spans_digest(secret_scan.scan(read(spark, sf, "documents")))


@query
def op4_sharding(spark, sf):
    return sharding.shard(read(spark, sf, "documents"))


@query
def op7_fingerprints(spark, sf):
    return sketches.fingerprints_digest(sketches.edited_fingerprints(read(spark, sf, "documents")))


@query
def op8_top_k(spark, sf):
    return topk.top_k(read(spark, sf, "embeddings"))


@query
def op5_quality(spark, sf):
    docs = read(spark, sf, "documents")
    return quality.grade(docs, quality.train(docs, read(spark, sf, "labels")))


@query
def op11_language(spark, sf):
    docs = read(spark, sf, "documents")
    return language.identify(docs, language.train(docs))


@query
def op12_lexical(spark, sf):
    return lexical.search(read(spark, sf, "documents"), read(spark, sf, "benchmark"))


@query
def op13_resampling(spark, sf):
    return resampling.resample(read(spark, sf, "documents"), read(spark, sf, "benchmark"))
