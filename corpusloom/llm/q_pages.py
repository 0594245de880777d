"""Queries on web pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusloom.llm.html_text import extract_text
from corpusloom.llm.registry import query
from corpusloom.llm.url_templates import judge_urls


@query("op6_html_text")
def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return extract_text(pages).select("page_id", "url", "text", "n_chars")


#: (host and start of path, allows)
RULES = [("org/", True), ("example.org/es/", False), ("example.org/en/1", False), ("com/fr/", True), ("com/de/", False)]


@query("op10_url_templates")
def op10_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judge_urls(pages, RULES).select("page_id", "host", "path", "rule", "verdict", "template", "purity")
