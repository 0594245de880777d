"""Clean a document table stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again as the docs of
the next. All but the last return the columns of ``documents``.

1. quality: documents that the quality classifier rejects go.
2. near_duplicates: of each group of documents linked by word 5-grams the one with the smallest id stays.
3. repeated_passages: words in passages of 13 words that an earlier document also has go; a document that loses
   words keeps the others joined by single blanks, and one that loses all goes.
4. decontamination: documents that hold a benchmark item go.
5. tokens: byte-level BPE ids of what is left, their number and digests.

Rows with whole texts go to Python in small batches (``small_batches``), which the stages set for the session.

Documents with a NULL id go through stages 1, 3 and 5 alone; stages 2 and 4 keep them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.decontaminate import contaminated
from corpusloom.llm.ngram_join import BROADCAST_IDS, ngram_join
from corpusloom.llm.q_tokens import token_digests
from corpusloom.llm.quality import quality_scores
from corpusloom.llm.substrings import repeated_passages
from corpusloom.llm.words import small_batches
from corpusloom.session import pin, shared_path, store

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` without the documents in ``ids`` (distinct doc_id), which are broadcast if they are few."""
    ids = pin(ids)
    return docs.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "doc_id", "left_anti")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    scored = quality_scores(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored.where("predicted = 1").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    joined = pin(ngram_join(docs))
    copies = joined.where("component_id <> doc_id").select("doc_id").distinct()
    left = without(docs.select(*COLUMNS), copies)
    again = pin(joined.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"))
    if again.isEmpty():
        return left
    # equal rows count once; only rows that share an id are shuffled for that
    return without(left, again).unionByName(left.join(again, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"]))


def repeated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = repeated_passages(docs.select(*COLUMNS), carry=["lang", "source"]).where("n_removed > 0")
    sha = F.unhex("text_sha256").alias("sha")
    changed = pin(found.select("doc_id", sha).distinct())
    few = changed.count() <= BROADCAST_IDS
    # only documents that lose words meet their new text; all others stay where they are unless too many lose words
    same = docs.select(*COLUMNS, F.unhex(F.sha2("text", 256)).alias("sha")).join(F.broadcast(changed) if few else changed, ["doc_id", "sha"], "left_anti")
    n_chars = F.length("kept").cast(docs.schema["n_chars"].dataType)
    cut = found.where("kept <> ''").select("doc_id", F.col("kept").alias("text"), "lang", "source", n_chars.alias("n_chars"))
    return same.select(*COLUMNS).unionByName(cut)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    found = contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return without(docs.select(*COLUMNS), found.select("doc_id").distinct())


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return token_digests(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated),
    ("decontamination", decontamination),
    ("tokens", tokens),
]

#: a fitted classifier and a latent space are beyond SQL; tests compare the stages with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = shared_path(spark, f"pipeline-{name}")
        docs = store(stage(spark, docs, sf_dir), path)
    return docs
