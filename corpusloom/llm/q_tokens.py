"""Queries on token ids and token counts."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.bpe import bpe_encode
from corpusloom.llm.piece_bpe import piece_encode
from corpusloom.llm.prefix_counts import count_tokens
from corpusloom.llm.registry import query

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def token_digests(docs: DataFrame, ranks: str = RANKS) -> DataFrame:
    """Per document: number of tokens, digest of the decimal ids, digest of the bytes decoded from them."""
    coded = bpe_encode(docs.select("doc_id", "text"), ranks, public_tokenizers.PATTERN, ids="ids", decoded="decoded")
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op7_bpe_roundtrip")
def op7_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(spark.read.parquet(f"{sf_dir}/documents.parquet"))


TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


@query("op9_token_counts")
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    counted = count_tokens(docs, TOKENIZER, public_tokenizers.PATTERN, limit=512)
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit", "fit_chars")


PIECES = public_tokenizers.path("piece_bpe_32k.model")


@query("op11_piece_roundtrip")
def op11_piece_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    coded = piece_encode(docs, PIECES, ids="ids", decoded="decoded")
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
