"""Queries on document quality."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusloom.llm.pseudo_likelihood import pseudo_likelihood
from corpusloom.llm.quality import quality_scores
from corpusloom.llm.registry import query


@query("op1_quality")
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_scores(docs, labels).select("doc_id", "held_out", "score", "predicted")


@query("op2_pseudo_likelihood")
def op2_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudo_likelihood(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), carry=["doc_id"])
