"""Queries on embeddings as a whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusloom.llm.registry import query
from corpusloom.llm.whitening import whitened


@query("op12_whitening")
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id", "embedding", 8)
