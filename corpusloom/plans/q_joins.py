"""Queries over filters and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions.scalar import stratum_key
from corpusloom.operators import linkage, sampling, stats, worklist
from corpusloom.operators.ranking import random_rank_in_stratum
from corpusloom.operators.taxonomy import taxonomy_lookup
from corpusloom.plans import fixtures as fx
from corpusloom.plans.fixtures import table
from corpusloom.plans.registry import pct_sql, query


@query("base_filter", f"""WITH {fx.records_sql('en')}
SELECT doc_id, lang, num_pages, abstract_num FROM recs WHERE num_pages <= 3 AND abstract_num IS NOT NULL AND abstract_num <> 0""")
def base_filter(spark, sf):
    return sampling.base_filter(fx.scanned(spark, sf, "en"), max_pages=3).select("doc_id", "lang", "num_pages", "abstract_num")


@query("optional_limit_filter", f"""WITH {fx.records_sql()}
SELECT 'all' AS scope, doc_id, num_pages FROM recs WHERE abstract_num <> 0
UNION ALL SELECT 'short', doc_id, num_pages FROM recs WHERE abstract_num <> 0 AND num_pages <= 2""")
def optional_limit_filter(spark, sf):
    hits = fx.scanned(spark, sf).where("abstract_num <> 0")
    scoped = [
        stats.with_page_limit(hits, "num_pages", limit).select(F.lit(name).alias("scope"), "doc_id", "num_pages")
        for name, limit in (("all", None), ("short", 2))
    ]
    return scoped[0].unionByName(scoped[1])


@query("stratum_class_filter", """SELECT o_orderkey, o_orderpriority FROM orders
WHERE regexp_matches(substring(o_orderpriority, 1, 1), '^[03567]$')""")
def stratum_class_filter(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return orders.where(stratum_key(F.col("o_orderpriority")).isin("0", "3", "5", "6", "7"))


@query("like_filter", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE 's%' AND p_name LIKE '%bolt'")
def like_filter(spark, sf):
    name = F.col("p_name")
    return table(spark, sf, "part").where(name.startswith("s") & name.endswith("bolt")).select("p_partkey", "p_name")


@query("key_lookup", "SELECT doc_id, lang, source, n_chars FROM documents WHERE doc_id = 77")
def key_lookup(spark, sf):
    return table(spark, sf, "documents").where(F.col("doc_id") == 77).select("doc_id", "lang", "source", "n_chars")


@query("presence_filter", f"""WITH {fx.CATALOGUE_SQL}
SELECT id, ddc, path FROM cat WHERE path IS NOT NULL AND ddc IS NOT NULL AND ddc <> '' AND hits > 0""")
def presence_filter(spark, sf):
    return fx.catalogue(spark, sf).where("path IS NOT NULL AND ddc IS NOT NULL AND ddc <> '' AND hits > 0").select("id", "ddc", "path")


@query("semi_join_ids", "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)")
def semi_join_ids(spark, sf):
    ids = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return linkage.semi_join_ids(table(spark, sf, "orders").select("o_orderkey", "o_orderpriority"), ids, "o_orderkey")


@query("anti_join_exists", """SELECT o_orderkey, o_orderpriority FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""")
def anti_join_exists(spark, sf):
    ids = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return worklist.blacklist_anti(table(spark, sf, "orders").select("o_orderkey", "o_orderpriority"), ids, "o_orderkey")


@query("anti_join_not_in", """SELECT 'plain' AS list, o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
UNION ALL SELECT 'with null', o_orderkey FROM orders
  WHERE o_orderkey NOT IN (SELECT CASE WHEN l_linenumber < 7 THEN l_orderkey END FROM lineitem)""")
def anti_join_not_in(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey")
    items = table(spark, sf, "lineitem")
    plain = items.select(F.col("l_orderkey").alias("o_orderkey"))
    holed = items.selectExpr("CASE WHEN l_linenumber < 7 THEN l_orderkey END AS o_orderkey")
    parts = [
        worklist.anti_join_not_in(orders, ids, "o_orderkey").select(F.lit(name).alias("list"), "o_orderkey")
        for name, ids in (("plain", plain), ("with null", holed))
    ]
    return parts[0].unionByName(parts[1])


@query("blacklist_anti", "SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def blacklist_anti(spark, sf):
    failed = table(spark, sf, "labels").where("toxic = 1")
    return worklist.blacklist_anti(table(spark, sf, "documents").select("doc_id", "lang"), failed, "doc_id")


@query("link_join", f"WITH {fx.MAPPINGS_SQL} SELECT * FROM maps WHERE record_id % 7 <> 0 AND gnd_id % 13 <> 0")
def link_join(spark, sf):
    """Links to unknown documents and entities drop out: here those of every 7th and every 13th."""
    return fx.mappings(spark, sf, fx.link_records(spark, sf).where("id % 7 <> 0"), fx.entities(spark, sf).where("id % 13 <> 0"))


@query("quota_join", """
WITH q AS (SELECT lang, least(c, 30 + 10 * strpos('de en fr', lang)) AS quota FROM (SELECT lang, count(*) AS c FROM documents WHERE lang <> 'es' GROUP BY 1)),
r AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY md5(concat(doc_id, ':42')), doc_id) AS row_num FROM documents)
SELECT doc_id, lang, row_num FROM r JOIN q USING (lang) WHERE row_num <= quota""")
def quota_join(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    quota = (
        docs.where("lang <> 'es'").groupBy("lang").agg(F.count("*").alias("c"))
        .select("lang", F.expr("least(c, 30 + 10 * instr('de en fr', lang))").alias("quota"))
    )
    return sampling.quota_join(docs, quota, "lang", "doc_id")


@query("taxonomy_lookup", f"""WITH {fx.CATALOGUE_SQL}, {fx.TAXONOMY_SQL}, {fx.lookup_sql("(SELECT * FROM cat WHERE ddc <> '')", 'ddc')}
SELECT id, ddc, main, main_name, sub_label FROM looked""")
def taxonomy_lookup_query(spark, sf):
    coded = fx.catalogue(spark, sf).where("ddc <> ''").select("id", "ddc")
    return taxonomy_lookup(coded, "ddc", fx.dimension(spark, sf)).select("id", "ddc", "main", "main_name", "sub_label")


@query("label_lookup", f"""WITH {fx.CATALOGUE_SQL}, {fx.CLASS_LABELS_SQL}
SELECT id, stratum, coalesce(name, 'Unknown') AS name FROM cat LEFT JOIN names ON code = stratum""")
def label_lookup(spark, sf):
    return stats.label_lookup(fx.catalogue(spark, sf).select("id", "stratum"), "stratum", fx.class_labels(spark, sf))


@query("link_coverage", f"""
WITH d AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1),
t AS (SELECT (SELECT count(DISTINCT o_orderkey) FROM orders) AS total_records,
        (SELECT count(*) FROM (SELECT DISTINCT o_orderkey FROM orders) JOIN d ON l_orderkey = o_orderkey) AS linked_records,
        (SELECT CAST(sum(n) AS BIGINT) FROM d) AS total_links, (SELECT count(*) FROM d) AS docs)
SELECT total_records, linked_records, {pct_sql('linked_records', 'total_records')} AS pct, total_links,
       {pct_sql('total_links', 'docs', 2, 1)} AS avg_links FROM t""")
def link_coverage(spark, sf):
    records = table(spark, sf, "orders").select(F.col("o_orderkey").alias("doc"))
    return linkage.link_coverage(records, table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("doc")), "doc")


