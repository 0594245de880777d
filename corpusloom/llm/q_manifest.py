"""Queries on dataset manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.merkle import fold, leaf_digest, merkle_manifest, proof_digest
from corpusloom.llm.registry import query

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def _leaf_sql(text: str) -> str:
    parts = [text if c == "text" else f"CAST({c} AS VARCHAR)" for c in COLUMNS]
    return "sha256(" + " || ".join(f"coalesce(strlen({p}) || ':' || {p}, '-')" for p in parts) + ")"


MANIFEST_SQL = f"""
WITH RECURSIVE leaves AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce('=' || source, '') AS g, {_leaf_sql('text')} AS leaf,
    {_leaf_sql(f"translate(text, '{UPPER}', '{LOWER}')")} AS other, CAST(doc_id AS VARCHAR) AS s FROM documents),
bits AS (SELECT *, list_transform(range(8 * len(s)), lambda i: CASE WHEN i % 8 = 0 THEN CAST(ascii(s[i // 8 + 1]) AS BIGINT) ELSE 0 END) AS b FROM leaves),
checked AS (SELECT *, xor(list_reduce([4294967295] || b, lambda c, e: xor(xor(c, e) // 2, (xor(c, e) & 1) * 3988292384)), 4294967295) AS crc FROM bits),
placed AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY g) AS n FROM checked),
low AS (
  SELECT g, 0 AS lvl, place, n, leaf AS h FROM placed
  UNION ALL SELECT g, lvl + 1, place // 16, max((n + 15) // 16), sha256(string_agg(h, '' ORDER BY place)) FROM low WHERE n > 1 GROUP BY g, lvl, place // 16),
tops AS (SELECT g, lvl, h, row_number() OVER (ORDER BY g) - 1 AS place, count(*) OVER () AS n FROM low WHERE n = 1),
high AS (
  SELECT 0 AS lvl, place, n, h FROM tops
  UNION ALL SELECT lvl + 1, place // 16, max((n + 15) // 16), sha256(string_agg(h, '' ORDER BY place)) FROM high WHERE n > 1 GROUP BY lvl, place // 16),
every AS (SELECT true AS below, g, lvl, place, h FROM low WHERE n > 1 UNION ALL SELECT false, '', lvl, place, h FROM high WHERE n > 1),
steps AS (
  SELECT below, g, lvl, place,
    coalesce(string_agg(h, '') OVER (PARTITION BY below, g, lvl, place // 16 ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(h, '') OVER (PARTITION BY below, g, lvl, place // 16 ORDER BY place ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM every),
walk AS (
  SELECT rid, true AS below, p.g, 0 AS lvl, p.place, t.lvl AS top, t.place AS next, CASE WHEN crc % 5 = 0 THEN other ELSE leaf END AS h, '' AS proof FROM placed p JOIN tops t USING (g)
  UNION ALL
  SELECT rid, below AND lvl < top, CASE WHEN below AND lvl < top THEN g ELSE '' END, CASE WHEN below AND lvl = top THEN 0 ELSE lvl + 1 END,
    CASE WHEN below AND lvl = top THEN next ELSE place // 16 END, top, next,
    CASE WHEN below AND lvl = top THEN h ELSE sha256(l || h || r) END, CASE WHEN below AND lvl = top THEN proof ELSE proof || l || r END
  FROM walk LEFT JOIN steps USING (below, g, lvl, place) WHERE (below AND lvl = top) OR l IS NOT NULL),
ends AS (SELECT rid, h, proof FROM walk WHERE NOT below AND lvl = (SELECT max(lvl) FROM high)),
root AS (SELECT h FROM high WHERE n = 1)
SELECT doc_id, leaf, t.h AS subroot, root.h AS root, sha256(e.proof) AS proof_sha256, e.h AS folded_root, e.h = root.h AS verified
FROM placed p JOIN tops t USING (g) JOIN ends e USING (rid), root"""


@query("op13_merkle_manifest", MANIFEST_SQL)
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    tampered = [F.translate("text", UPPER, LOWER) if c == "text" else F.col(c) for c in COLUMNS]
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    found = merkle_manifest(docs, COLUMNS, "source", "doc_id", F.when(hit, leaf_digest(tampered)))
    folded = found.select(
        "doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"),
        fold(F.coalesce("other_leaf", "leaf"), F.col("path")).alias("folded_root"))
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))
