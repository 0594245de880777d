"""Queries over the readers and writers."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions.marc import marc_flatten
from corpusloom.operators.taxonomy import nested_json_export
from corpusloom.plans import fixtures as fx
from corpusloom.plans.fixtures import table
from corpusloom.plans.registry import query
from corpusloom.session import shared_path
from corpusloom.sources import readers, writers

_MARC_COLS = ["idn", "year", "title", "title_author", "ddc", "author_person_id", "author_person_name", "urn",
              "url_resolving_system", "url_dnb_archive", "url_publisher"]
#: documents of one file
_FILE_DOCS = 500
#: ranges of ids of one upper folder
_FOLDER_BLOCKS = 64


@query("marc_xml_scan", f"WITH {fx.MARC_SQL} SELECT idn, year, title, title_author, ddc, urn, url_dnb_archive FROM marc")
def marc_xml_scan(spark, sf):
    path = shared_path(spark, "marc")
    fx.marc_xml(spark, sf).write.text(path)
    return marc_flatten(readers.marc_xml_scan(spark, path)).select(
        "idn", "year", "title", "title_author", "ddc", "urn", "url_dnb_archive"
    )


@query("record_table_scan", "SELECT o_orderkey, o_orderpriority, o_orderstatus FROM orders")
def record_table_scan(spark, sf):
    return readers.record_table_scan(spark, f"{sf}/orders.parquet", ["o_orderkey", "o_orderpriority", "o_orderstatus"])


@query("link_csv_scan", f"WITH {fx.LINKS_SQL} SELECT * FROM links")
def link_csv_scan(spark, sf):
    path = shared_path(spark, "links")
    fx.links(spark, sf).write.option("header", True).option("escape", '"').csv(path)
    return readers.link_csv_scan(spark, path)


@query("taxonomy_scan", f"WITH {fx.WHOLE_TAXONOMY_SQL} SELECT * FROM tax")
def taxonomy_scan(spark, sf):
    path = shared_path(spark, "taxonomy")
    writers.export_lines(nested_json_export(fx.taxonomy(spark, sf, whole=True), page_size=4), path)
    return readers.taxonomy_scan(spark, path, lines=True)


@query("nested_json_export", f"""WITH {fx.WHOLE_TAXONOMY_SQL}
SELECT concat('{{"', main, '":{{"name":"', min(main_name), '","sub":{{',
       string_agg(concat('"', sub_key, '":{{"name":"', sub_name, '"}}'), ',' ORDER BY sub_key), '}}}}}}') AS value
FROM (SELECT *, (row_number() OVER (PARTITION BY main ORDER BY sub_key) - 1) // 4 AS page FROM tax) GROUP BY main, page""")
def nested_json_export_query(spark, sf):
    path = shared_path(spark, "tree")
    writers.export_lines(nested_json_export(fx.taxonomy(spark, sf, whole=True), page_size=4), path)
    return spark.read.text(path)


def _bounded_files(spark, sf):
    """The corpus as files of documents of one source whose ids lie in one range of _FILE_DOCS, each ended by a newline.

    A source of any size spreads over tasks and files; the folders name the source and the range. Folders of _FOLDER_BLOCKS
    ranges stand above them: Spark lists every folder of a level that has many in a task of its own, and what lies below it there.
    """
    path = shared_path(spark, "corpus")
    block = F.floor(F.col("doc_id") / _FILE_DOCS).alias("block")
    folder = F.floor(F.col("doc_id") / (_FILE_DOCS * _FOLDER_BLOCKS)).alias("folder")
    docs = table(spark, sf, "documents").select(folder, "source", block, "doc_id", F.col("text").alias("value"))
    ordered = docs.repartition("source", "block").sortWithinPartitions("folder", "source", "block", "doc_id")
    ordered.drop("doc_id").write.partitionBy("folder", "source", "block").text(path)
    return path


def _folders():
    return [F.regexp_extract("path", "source=([^/]*)/", 1).alias("source"), F.regexp_extract("path", r"block=(\d+)/", 1).cast("long").alias("block")]


@query("text_corpus_scan", f"""SELECT source, doc_id // {_FILE_DOCS} AS block, 0 AS "offset", string_agg(text || chr(10), '' ORDER BY doc_id) AS content
FROM documents GROUP BY ALL""")
def text_corpus_scan(spark, sf):
    return readers.text_corpus_scan(spark, _bounded_files(spark, sf), "*.txt").select(*_folders(), "offset", "content")


@query("binary_doc_scan", f"""SELECT source, doc_id // {_FILE_DOCS} AS block, CAST(sum(strlen(text) + 1) AS BIGINT) AS file_size,
  substring(hex(encode(string_agg(text || chr(10), '' ORDER BY doc_id))), 1, 10) AS head FROM documents GROUP BY ALL""")
def binary_doc_scan(spark, sf):
    files = readers.binary_doc_scan(spark, _bounded_files(spark, sf), 5, "*.txt")
    return files.select(*_folders(), "file_size", F.hex(F.encode("head", "ISO-8859-1")).alias("head"))


@query("batch_insert", """SELECT o_orderkey, o_orderpriority FROM orders
UNION ALL SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderstatus = 'F'""")
def batch_insert(spark, sf):
    path = shared_path(spark, "insert")
    orders = table(spark, sf, "orders")
    for part in (orders, orders.where("o_orderstatus = 'F'")):
        writers.batch_insert(part.select("o_orderkey", "o_orderpriority"), path)
    return spark.read.schema("o_orderkey BIGINT, o_orderpriority STRING").parquet(path)


@query("snapshot_verify", "SELECT lang, count(*) AS n_source, count(*) AS n_copy, true AS same FROM documents GROUP BY lang")
def snapshot_verify(spark, sf):
    return writers.snapshot_verify(table(spark, sf, "documents"), shared_path(spark, "snapshot"), "lang")


@query("idempotent_replace", "SELECT doc_id, lang, n_chars FROM documents WHERE lang = 'de'")
def idempotent_replace(spark, sf):
    path = shared_path(spark, "replace")
    docs = table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    writers.idempotent_replace(docs, path)
    return writers.idempotent_replace(docs.where("lang = 'de'"), path)


@query("schema_report", """
SELECT 1 AS ordinal, 'doc_id' AS column_name, 'bigint' AS data_type, count(doc_id) AS non_null FROM documents
UNION ALL SELECT 2, 'text', 'string', count(text) FROM documents
UNION ALL SELECT 3, 'lang', 'string', count(lang) FROM documents
UNION ALL SELECT 4, 'source', 'string', count(source) FROM documents
UNION ALL SELECT 5, 'n_chars', 'bigint', count(n_chars) FROM documents""")
def schema_report(spark, sf):
    return writers.schema_report(table(spark, sf, "documents"))


@query("marc_flatten", f"WITH {fx.MARC_SQL} SELECT {', '.join(_MARC_COLS)} FROM marc")
def marc_flatten_query(spark, sf):
    return marc_flatten(readers.marc_xml_parse(fx.marc_xml(spark, sf), "xml")).select(*_MARC_COLS)
