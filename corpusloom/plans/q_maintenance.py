"""Queries over table maintenance and incremental work."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions.text import term_line_scan
from corpusloom.operators import maintenance, worklist
from corpusloom.plans import fixtures as fx
from corpusloom.plans.fixtures import table
from corpusloom.plans.registry import pct_sql, query
from corpusloom.session import shared_path
from corpusloom.sources import keyed
from corpusloom.streaming.enrich import incremental_enrich


@query("union_all", """SELECT doc_id, lang FROM documents WHERE n_chars >= 1000 UNION ALL SELECT doc_id, lang FROM documents WHERE n_chars < 3000
UNION ALL SELECT NULL, 'Total' """)
def union_all(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    total = spark.range(1).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "'Total' AS lang")
    both = docs.where("n_chars >= 1000").unionByName(docs.where("n_chars < 3000")).drop("n_chars")
    return both.unionByName(total)


@query("insert_if_absent", """
WITH target AS (SELECT p_partkey, p_name FROM part WHERE p_partkey % 3 = 0),
new AS (SELECT l_partkey AS p_partkey, min(concat('new ', l_suppkey)) AS p_name FROM lineitem GROUP BY 1)
SELECT * FROM target UNION ALL SELECT * FROM new WHERE p_partkey NOT IN (SELECT p_partkey FROM target)""")
def insert_if_absent(spark, sf):
    target = table(spark, sf, "part").where("p_partkey % 3 = 0").select("p_partkey", "p_name")
    new = table(spark, sf, "lineitem").selectExpr("l_partkey AS p_partkey", "concat('new ', l_suppkey) AS p_name")
    return maintenance.insert_if_absent(target, new, "p_partkey")


_UPDATED = """
SELECT doc_id, source, CASE WHEN labels.doc_id IS NOT NULL THEN nullif(quality, 0) ELSE CAST(n_chars AS INTEGER) END AS n_chars
FROM documents LEFT JOIN labels USING (doc_id)"""


def _updates(spark, sf):
    docs = table(spark, sf, "documents").selectExpr("doc_id", "source", "CAST(n_chars AS INT) AS n_chars")
    return docs, table(spark, sf, "labels").selectExpr("doc_id", "nullif(quality, 0) AS n_chars")


@query("update_by_key", _UPDATED)
def update_by_key(spark, sf):
    docs, updates = _updates(spark, sf)
    return maintenance.update_by_key(docs, updates, "doc_id", ["n_chars"])


@query("update_stored", _UPDATED)
def update_stored(spark, sf):
    docs, updates = _updates(spark, sf)
    path = shared_path(spark, "keyed")
    keyed.store_keyed(docs, path, "doc_id")
    return keyed.update_stored(updates, path, 1, "doc_id", ["n_chars"], docs.schema)


@query("reset_columns", "SELECT doc_id, lang, CAST(NULL AS VARCHAR) AS source, CAST(NULL AS BIGINT) AS n_chars FROM documents")
def reset_columns(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    return maintenance.reset_columns(docs, ["source", "n_chars"])


@query("add_column", "SELECT doc_id, lang, CAST(NULL AS INTEGER) AS token_count FROM documents")
def add_column(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    return maintenance.add_column(maintenance.add_column(docs, "token_count", "int"), "token_count", "string")


@query("reject_split", """
WITH raw AS (SELECT CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_orderkey AS VARCHAR) END AS k,
                    CASE WHEN l_partkey % 10 = 0 THEN concat('p', l_partkey) ELSE CAST(l_partkey AS VARCHAR) END AS p,
                    CAST(l_suppkey % 5 AS VARCHAR) AS s FROM lineitem),
j AS (SELECT *, CASE WHEN TRY_CAST(p AS INTEGER) IS NULL AND p IS NOT NULL THEN 'type:p' WHEN k IS NULL THEN 'null key' END AS reason FROM raw),
ok AS (SELECT CAST(k AS BIGINT) AS k, CAST(p AS INTEGER) AS p, CAST(s AS INTEGER) AS s FROM j WHERE reason IS NULL),
r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY p, s) AS rn FROM ok)
SELECT 'valid' AS outcome, CAST(k AS VARCHAR) AS k, CAST(p AS VARCHAR) AS p, CAST(s AS VARCHAR) AS s, NULL AS reason, 1 AS copies FROM r WHERE rn = 1
UNION ALL SELECT 'rejected', CAST(k AS VARCHAR), CAST(p AS VARCHAR), CAST(s AS VARCHAR), 'duplicate key', count(*) FROM r WHERE rn > 1 GROUP BY k, p, s
UNION ALL SELECT 'rejected', k, p, s, reason, count(*) FROM j WHERE reason IS NOT NULL GROUP BY k, p, s, reason""")
def reject_split(spark, sf):
    raw = table(spark, sf, "lineitem").selectExpr(
        "CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_orderkey AS STRING) END AS k",
        "CASE WHEN l_partkey % 10 = 0 THEN concat('p', l_partkey) ELSE CAST(l_partkey AS STRING) END AS p",
        "CAST(l_suppkey % 5 AS STRING) AS s",
    )
    valid, rejected = maintenance.reject_split(raw, {"k": "bigint", "p": "int", "s": "int"}, "k")
    kept = valid.selectExpr(
        "'valid' AS outcome", "CAST(k AS STRING) AS k", "CAST(p AS STRING) AS p", "CAST(s AS STRING) AS s",
        "CAST(NULL AS STRING) AS reason", "1L AS copies",
    )
    return kept.unionByName(rejected.withColumn("outcome", F.lit("rejected")))


@query("surrogate_key", "SELECT p_name, row_number() OVER (ORDER BY p_name) AS id FROM (SELECT DISTINCT concat(p_name, p_brand) AS p_name FROM part)")
def surrogate_key(spark, sf):
    names = table(spark, sf, "part").selectExpr("concat(p_name, p_brand) AS p_name").distinct()
    return maintenance.surrogate_key(names, "p_name")


_PENDING = """
pending AS (SELECT doc_id, lang, n_chars FROM documents LEFT JOIN labels l USING (doc_id)
            WHERE source IS NOT NULL AND quality IS NULL AND doc_id NOT IN (SELECT doc_id FROM documents WHERE source = 'src7'))"""


def _pending(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    state = docs.join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left")
    return worklist.worklist(state, "source", "quality", docs.where("source = 'src7'"), "doc_id").select("doc_id", "lang", "n_chars")


@query("worklist", f"WITH {_PENDING} SELECT * FROM pending")
def worklist_query(spark, sf):
    return _pending(spark, sf)


@query("work_batches", f"""WITH {_PENDING}
SELECT doc_id, (row_number() OVER (ORDER BY n_chars DESC, doc_id) - 1) // 60 AS batch_id FROM pending""")
def work_batches(spark, sf):
    return worklist.work_batches(_pending(spark, sf), ["-n_chars", "doc_id"], 60).select("doc_id", "batch_id")


@query("work_chunks", f"""WITH {_PENDING},
p AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i FROM pending),
t AS (SELECT least(count(*), 450) AS t FROM p), c AS (SELECT unnest(range(7)) AS chunk),
b AS (SELECT chunk, sum(t // 7 + CASE WHEN chunk < t % 7 THEN 1 ELSE 0 END) OVER (ORDER BY chunk) AS hi,
             t // 7 + CASE WHEN chunk < t % 7 THEN 1 ELSE 0 END AS size FROM c, t)
SELECT doc_id, chunk FROM p LEFT JOIN b ON i < hi AND i >= hi - size""")
def work_chunks(spark, sf):
    return worklist.work_chunks(_pending(spark, sf).select("doc_id"), ["doc_id"], 7, 450)


@query("progress_report", f"""
WITH t AS (SELECT count(*) FILTER (WHERE event_type <> 'signup') AS total, count(*) FILTER (WHERE event_type = 'purchase') AS done,
  (max(epoch_us(ts)) FILTER (WHERE event_type = 'purchase') - min(epoch_us(ts)) FILTER (WHERE event_type = 'purchase')) // 1000000 AS elapsed_sec FROM events)
SELECT total, done, elapsed_sec, total - done AS "left", {pct_sql('done', 'total')} AS pct, {pct_sql('done', 'elapsed_sec', 1, 3600)} AS per_hour,
  ((total - done) * elapsed_sec) // done AS eta_sec FROM t""")
def progress_report(spark, sf):
    kind = F.col("event_type")
    return worklist.progress_report(table(spark, sf, "events"), kind != "signup", kind == "purchase", "ts")


@query("stall_gaps", """
SELECT user_id, prev AS gap_start_us, us AS gap_end_us, (us - prev) // 1000000 AS gap_sec FROM (
  SELECT user_id, epoch_us(ts) AS us, lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts) AS prev FROM events)
WHERE us - prev > 36000000000""")
def stall_gaps(spark, sf):
    return worklist.stall_gaps(table(spark, sf, "events"), "user_id", "ts", 36_000)


@query("failure_list", """
WITH failed AS (SELECT doc_id FROM labels WHERE toxic = 1 UNION SELECT doc_id FROM documents WHERE source = 'src7')
SELECT doc_id, CASE WHEN failed.doc_id IS NOT NULL THEN 'Blacklisted' END AS converted_file FROM documents LEFT JOIN failed USING (doc_id)""")
def failure_list(spark, sf):
    docs = table(spark, sf, "documents")
    failed = worklist.failure_list(table(spark, sf, "labels").where("toxic = 1"), docs.where("source = 'src7'"), "doc_id")
    marked = failed.withColumn("converted_file", F.lit("Blacklisted"))
    state = maintenance.add_column(docs.select("doc_id"), "converted_file", "string")
    return maintenance.update_by_key(state, marked, "doc_id", ["converted_file"])


@query("incremental_enrich", f"WITH {fx.records_sql('en')} SELECT doc_id, abstract_num AS num, abstract_pos AS pos FROM recs")
def incremental_enrich_query(spark, sf):
    def enrich(df):
        return df.select("doc_id", F.inline(F.array(term_line_scan(F.col("text"), "en"))))

    run = shared_path(spark, "enrich")
    schema = table(spark, sf, "documents").schema
    # the table may be one file or a folder of files; a stream takes a single file only as a pattern
    return incremental_enrich(spark, f"{sf}/{{documents.parquet}}", f"{run}/out", f"{run}/progress", schema, enrich, "doc_id", "*")


@query("find_entry", """
SELECT doc_id, source FROM documents WHERE source || '.pdf' = 'src7.pdf'
UNION ALL SELECT doc_id, source FROM documents WHERE CAST(doc_id AS VARCHAR) || '.mmd' = '12.mmd'""")
def find_entry(spark, sf):
    files = table(spark, sf, "documents").selectExpr("doc_id", "source", "concat(source, '.pdf') AS path", "concat(doc_id, '.mmd') AS converted_file")
    found = maintenance.find_entry(files, "src7", "pdf").union(maintenance.find_entry(files, "12", "mmd"))
    return found.select("doc_id", "source")


@query("reset_check", """
SELECT 'converted' AS column_name, 0::BIGINT AS still_set, count(*) AS n_rows FROM documents
UNION ALL SELECT 'kept', count(lang), count(*) FROM documents""")
def reset_check(spark, sf):
    rows = table(spark, sf, "documents").selectExpr("doc_id", "source AS converted", "lang AS kept")
    return maintenance.reset_check(maintenance.reset_columns(rows, ["converted"]), ["converted", "kept"])
