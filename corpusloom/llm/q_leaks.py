"""Queries on benchmark passages in documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusloom.llm.decontaminate import contaminated
from corpusloom.llm.registry import query


@query("op4_benchmark_leaks")
def op4_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
