"""Queries on near copies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import near_sql
from corpusloom.llm.cap_filters import near_vectors
from corpusloom.llm.ngram_join import ngram_join
from corpusloom.llm.registry import query
from corpusloom.llm.substrings import repeated_passages


@query("op3_ngram_join", near_sql.NGRAM_JOIN)
def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(spark.read.parquet(f"{sf_dir}/documents.parquet"))


@query("op8_substring_dedup", near_sql.SUBSTRINGS)
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_passages(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select(
        "doc_id", "n_words", "n_removed",
        F.coalesce(F.sha2(F.col("kept"), 256), F.col("words_sha256")).alias("kept_sha256"),
    )


@query("op5_cap_filters", near_sql.CAP_FILTERS)
def op5_cap_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
