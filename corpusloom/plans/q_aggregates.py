"""Queries over counts, rates, distributions and roll-ups."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions import text
from corpusloom.operators import linkage, stats, taxonomy
from corpusloom.plans import fixtures as fx
from corpusloom.plans.fixtures import table
from corpusloom.plans.q_scalar import (
    _SECTION_TERMS,
    _TOKEN_BOUNDS,
    _TOKEN_LABELS,
    _YEAR_BOUNDS,
    _YEAR_LABELS,
    SECTIONS_SQL,
    _bucket_sql,
)
from corpusloom.plans.registry import pct_sql, query

_DIGITS = [str(d) for d in range(10)]


@query("count_by_stratum", """
WITH o AS (SELECT nullif(substring(o_orderpriority, 1, 1), '3') AS stratum FROM orders)
SELECT 'seen' AS scope, stratum, count(*) AS n FROM o GROUP BY stratum
UNION ALL SELECT 'all digits', d.stratum, count(o.stratum) FROM (SELECT CAST(unnest(range(10)) AS VARCHAR) AS stratum) d
  LEFT JOIN o USING (stratum) GROUP BY d.stratum""")
def count_by_stratum(spark, sf):
    coded = table(spark, sf, "orders").selectExpr("nullif(substring(o_orderpriority, 1, 1), '3') AS stratum")
    seen = stats.count_by_stratum(coded, "stratum").withColumn("scope", F.lit("seen"))
    fixed = stats.count_by_stratum(coded, "stratum", _DIGITS).withColumn("scope", F.lit("all digits"))
    return seen.unionByName(fixed)


@query("conditional_rate", f"""
SELECT lang, count(*) AS total_count, count(*) FILTER (WHERE toxic <> 0) AS hit_count,
       {pct_sql('count(*) FILTER (WHERE toxic <> 0)', 'count(*)')} AS pct
FROM documents LEFT JOIN labels USING (doc_id) GROUP BY lang""")
def conditional_rate(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang").join(table(spark, sf, "labels"), "doc_id", "left")
    return stats.conditional_rate(docs, "lang", "toxic")


@query("overall_rate", f"""
SELECT count(*) FILTER (WHERE toxic <> 0) AS hit_count, count(toxic) AS processed_count,
       coalesce({pct_sql('count(*) FILTER (WHERE toxic <> 0)', 'count(toxic)')}, 0.0) AS pct
FROM documents LEFT JOIN labels USING (doc_id)""")
def overall_rate(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id").join(table(spark, sf, "labels"), "doc_id", "left")
    return stats.overall_rate(docs, "toxic")


@query("class_sum_rate", f"""WITH {fx.CATALOGUE_SQL}
SELECT count(*) AS total_count, count(*) FILTER (WHERE hits <> 0) AS hit_count,
       {pct_sql('count(*) FILTER (WHERE hits <> 0)', 'count(*)')} AS pct FROM cat WHERE stratum IN ('0','3','5','6','7')""")
def class_sum_rate(spark, sf):
    return stats.class_sum_rate(fx.catalogue(spark, sf), "stratum", [0, 3, 5, 6, 7], "hits")


@query("non_null_profile", f"""WITH {fx.CATALOGUE_SQL}
SELECT count(*) AS total_records, count(ddc) AS non_null_ddc, count(path) AS non_null_path, count(year) AS non_null_year FROM cat""")
def non_null_profile(spark, sf):
    return stats.non_null_profile(fx.catalogue(spark, sf), ["ddc", "path", "year"])


@query("sum_positive", """
SELECT count(*) AS total_records, CAST(sum(n_chars // 200) AS BIGINT) AS total_pages FROM documents WHERE n_chars // 200 > 0""")
def sum_positive(spark, sf):
    return stats.sum_positive(table(spark, sf, "documents").selectExpr("n_chars div 200 AS num_pages"), "num_pages")


@query("token_stats", f"""
SELECT count(*) AS total_files, CAST({pct_sql('CAST(sum(n_chars) AS BIGINT)', 'count(*)', 0, 1)} AS DOUBLE) AS avg_tokens,
       min(n_chars) AS min_tokens, max(n_chars) AS max_tokens, count(*) FILTER (WHERE source LIKE '%7') AS suffix_files
FROM documents WHERE n_chars IS NOT NULL""")
def token_stats(spark, sf):
    return stats.token_stats(table(spark, sf, "documents"), "n_chars", "source", "7")


@query("bucket_distribution", f"""
WITH b AS (SELECT {_bucket_sql('n_chars', _TOKEN_BOUNDS, _TOKEN_LABELS)} AS bucket, count(*) AS n FROM documents GROUP BY 1),
t AS (SELECT CAST(sum(n) AS BIGINT) AS total FROM b)
SELECT bucket, n, {pct_sql('n', '(SELECT total FROM t)', 1)} AS pct,
       list_position({list(_TOKEN_LABELS)!r}, bucket) AS ord FROM b
UNION ALL SELECT 'Total', total, 100.0, {len(_TOKEN_LABELS) + 1} FROM t""")
def bucket_distribution(spark, sf):
    return stats.bucket_distribution(table(spark, sf, "documents"), "n_chars", _TOKEN_BOUNDS, _TOKEN_LABELS)


@query("stratum_share_table", f"""WITH {fx.CATALOGUE_SQL}, {fx.CLASS_LABELS_SQL},
c AS (SELECT stratum, count(*) AS n FROM cat WHERE stratum IS NOT NULL GROUP BY 1),
t AS (SELECT CAST(sum(n) AS BIGINT) AS total FROM c)
SELECT stratum, coalesce(name, 'Unknown') AS name, n, {pct_sql('n', '(SELECT total FROM t)', 1)} AS pct
FROM c LEFT JOIN names ON code = stratum UNION ALL SELECT 'Total', '', total, 100.0 FROM t""")
def stratum_share_table(spark, sf):
    return stats.stratum_share_table(fx.catalogue(spark, sf), "stratum", fx.class_labels(spark, sf))


@query("stratum_year_count", f"""WITH {fx.CATALOGUE_SQL}
SELECT stratum, CAST(year AS INTEGER) AS year, count(*) AS n FROM cat WHERE regexp_matches(year, '^[0-9]+$') GROUP BY 1, 2""")
def stratum_year_count(spark, sf):
    return stats.stratum_year_count(fx.catalogue(spark, sf), "stratum", "year")


_CELLS = ", ".join(f"count(*) FILTER (WHERE bin = '{b}') AS \"{b}\"" for b in _YEAR_LABELS)


@query("stratum_bin_crosstab", f"""WITH {fx.CATALOGUE_SQL}, {fx.CLASS_LABELS_SQL},
b AS (SELECT stratum, {_bucket_sql('TRY_CAST(year AS INTEGER)', _YEAR_BOUNDS, _YEAR_LABELS)} AS bin FROM cat WHERE regexp_matches(year, '^[0-9]+$'))
SELECT stratum, coalesce(min(name), 'Unknown') AS name, {_CELLS} FROM b LEFT JOIN names ON code = stratum WHERE bin IS NOT NULL GROUP BY stratum
UNION ALL SELECT 'Total', '', {_CELLS} FROM b WHERE bin IS NOT NULL""")
def stratum_bin_crosstab(spark, sf):
    return stats.stratum_bin_crosstab(
        fx.catalogue(spark, sf), "stratum", "year", fx.class_labels(spark, sf), _YEAR_BOUNDS, _YEAR_LABELS
    )


_TREE_SQL = f"WITH {fx.CATALOGUE_SQL}, {fx.TAXONOMY_SQL}, {fx.lookup_sql('(SELECT ddc FROM cat WHERE ddc <> chr(0) AND length(ddc) > 0)', 'ddc')}"


@query("taxonomy_tree_count", f"""{_TREE_SQL}
SELECT main, main_name, sub_label, count(*) AS n,
       CASE WHEN regexp_matches(split_part(sub_label, ' ', 1), '^[0-9]+$') THEN split_part(sub_label, ' ', 1) ELSE '999' END AS sort_key
FROM looked GROUP BY 1, 2, 3
UNION ALL SELECT main, main_name, NULL, count(*), '' FROM looked GROUP BY 1, 2""")
def taxonomy_tree_count(spark, sf):
    return taxonomy.taxonomy_tree_count(fx.catalogue(spark, sf), "ddc", fx.dimension(spark, sf))


@query("treemap_table", f"""{_TREE_SQL}
SELECT sub_label AS name, main_name AS parent, count(*) AS value FROM looked GROUP BY 1, 2
UNION ALL SELECT main_name, '', count(*) FROM looked GROUP BY 1
UNION ALL SELECT 'Total', NULL, count(*) FROM looked""")
def treemap_table(spark, sf):
    return taxonomy.treemap_table(fx.catalogue(spark, sf), "ddc", fx.dimension(spark, sf))


@query("link_summary", f"""WITH {fx.MAPPINGS_SQL}, d AS (SELECT record_id, count(*) AS n FROM maps GROUP BY 1)
SELECT (SELECT count(*) FROM lrecs) AS total_records, (SELECT count(*) FROM ents) AS total_entities,
       CAST(sum(n) AS BIGINT) AS total_mappings, {pct_sql('CAST(sum(n) AS BIGINT)', 'count(*)', 2, 1)} AS avg_mappings, max(n) AS max_mappings FROM d""")
def link_summary(spark, sf):
    return linkage.link_summary(fx.link_records(spark, sf), fx.entities(spark, sf), fx.mappings(spark, sf))


_DEGREES = "d AS (SELECT l_orderkey, count(*) AS keyword_count FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem) GROUP BY 1)"
_SHARES = f"""SELECT keyword_count, count(*) AS document_count, {pct_sql('count(*)', '(SELECT count(*) FROM d)')} AS percentage
FROM d GROUP BY keyword_count"""


@query("degree_distribution", f"WITH {_DEGREES} {_SHARES} ORDER BY keyword_count LIMIT 5")
def degree_distribution(spark, sf):
    pairs = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey").distinct()
    return linkage.degree_distribution(pairs, "l_orderkey")


@query("share_of_total", f"WITH {_DEGREES} {_SHARES}")
def share_of_total(spark, sf):
    return linkage.degree_shares(table(spark, sf, "lineitem").select("l_orderkey", "l_partkey").distinct(), "l_orderkey")


@query("degree_min_max", f"""WITH d AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1)
SELECT min(n) AS min_links, max(n) AS max_links, {pct_sql('CAST(sum(n) AS BIGINT)', 'count(*)', 2, 1)} AS avg_links FROM d""")
def degree_min_max(spark, sf):
    return linkage.degree_min_max(table(spark, sf, "lineitem"), "l_orderkey")


@query("top_labels", f"""WITH {fx.MAPPINGS_SQL}
SELECT gnd_label, count(*) AS usage_count, {pct_sql('count(*)', '(SELECT count(*) FROM maps)')} AS percentage
FROM maps JOIN ents ON ents.id = gnd_id GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")
def top_labels(spark, sf):
    return linkage.top_labels(fx.mappings(spark, sf), fx.entities(spark, sf))


@query("keyword_agg", f"""WITH {fx.MAPPINGS_SQL}
SELECT doc_idn, page, string_agg(gnd_label, ' | ' ORDER BY gnd_label) AS gnd_keywords, count(*) AS keyword_count
FROM (SELECT lrecs.doc_idn, gnd_label, CAST((row_number() OVER (PARTITION BY record_id ORDER BY gnd_label, gnd_id) - 1) // 3 AS INTEGER) AS page
      FROM maps JOIN ents ON ents.id = gnd_id JOIN lrecs ON lrecs.id = record_id) GROUP BY 1, 2""")
def keyword_agg(spark, sf):
    return linkage.keyword_agg(fx.mappings(spark, sf), fx.entities(spark, sf), fx.link_records(spark, sf), page_size=3)


@query("links_by_doc", f"""WITH {fx.LINKS_SQL}, f AS (SELECT *, count(*) AS copies FROM links GROUP BY ALL)
SELECT doc_idn, page, string_agg(concat(gnd_idn, '=', gnd_label, '*', copies), ';' ORDER BY gnd_idn, gnd_label) AS links,
       CAST(sum(copies) AS BIGINT) AS n_links
FROM (SELECT *, CAST((row_number() OVER (PARTITION BY doc_idn ORDER BY gnd_idn, gnd_label) - 1) // 3 AS INTEGER) AS page FROM f) GROUP BY 1, 2""")
def links_by_doc(spark, sf):
    lists = linkage.links_by_doc(fx.links(spark, sf), page_size=3)
    shown = F.array_join(F.transform("links", lambda e: F.concat(e["gnd_idn"], F.lit("="), e["gnd_label"], F.lit("*"), e["copies"])), ";")
    return lists.select("doc_idn", "page", shown.alias("links"), "n_links")


@query("entity_dedup", f"WITH {fx.LINKS_SQL} SELECT gnd_idn, min(gnd_label) AS gnd_label FROM links GROUP BY 1")
def entity_dedup(spark, sf):
    return linkage.entity_dedup(fx.links(spark, sf))


@query("distinct_links", f"WITH {fx.LINKS_SQL} SELECT DISTINCT * FROM links")
def distinct_links(spark, sf):
    return linkage.distinct_links(fx.links(spark, sf))


@query("link_counts", f"""WITH {fx.LINKS_SQL}, u AS (SELECT DISTINCT * FROM links)
SELECT count(DISTINCT doc_idn) AS n_docs, count(DISTINCT (gnd_idn, gnd_label)) AS n_entities, count(*) AS n_mappings FROM u""")
def link_counts(spark, sf):
    return linkage.link_counts(fx.links(spark, sf))


@query("duplicate_report", """
WITH e AS (SELECT l_orderkey, l_partkey, l_suppkey, count(*) AS n FROM lineitem GROUP BY ALL),
k AS (SELECT l_orderkey, l_partkey, count(*) AS n FROM lineitem GROUP BY ALL)
SELECT CAST((SELECT sum(n - 1) FROM e) AS BIGINT) AS exact_duplicates, CAST((SELECT sum(n - 1) FROM k) AS BIGINT) AS key_duplicates""")
def duplicate_report(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey")
    return linkage.duplicate_report(rows, ["l_orderkey", "l_partkey"])


def _term_rows():
    cond = {t: "term = '" + t + "'" for t in _SECTION_TERMS} | {"any term": "term IS NOT NULL"}
    return " UNION ALL ".join(
        f"SELECT '{t}' AS term, count(*) FILTER (WHERE {c}) AS n, count(*) FILTER (WHERE {c} AND length(section) < 500) AS n_short, "
        f"{pct_sql(f'count(*) FILTER (WHERE {c})', 'count(*)')} AS pct FROM sec" for t, c in cond.items()
    )


@query("term_hit_rate", f"WITH {SECTIONS_SQL} {_term_rows()}")
def term_hit_rate(spark, sf):
    sections = fx.documents(spark, sf).select(F.inline(F.array(text.section_extract(F.col("text"), _SECTION_TERMS))))
    return stats.term_hit_rate(sections, _SECTION_TERMS, text.MIN_SECTION_CHARS)


@query("over_limit_share", f"""
SELECT count(*) FILTER (WHERE n > 1000) AS n_over, count(*) AS n_docs, {pct_sql('count(*) FILTER (WHERE n > 1000)', 'count(*)')} AS pct
FROM (SELECT len(regexp_extract_all(text, '\\p{{L}}+|\\p{{N}}+|[^\\s\\p{{L}}\\p{{N}}]')) AS n FROM documents)""")
def over_limit_share(spark, sf):
    return stats.over_limit_share(text.token_count(fx.documents(spark, sf), "text"), "token_count", 1000)


@query("over_limit_list", """
SELECT doc_id, n AS token_count FROM (SELECT doc_id, CAST(len(regexp_extract_all(text, '\\p{L}+|\\p{N}+|[^\\s\\p{L}\\p{N}]')) AS INTEGER) AS n FROM documents)
WHERE n > 1000""")
def over_limit_list(spark, sf):
    return stats.over_limit_list(text.token_count(fx.documents(spark, sf), "text"), "doc_id", "token_count", 1000)


@query("availability_rate", f"""WITH {fx.CATALOGUE_SQL}
SELECT count(*) AS total_records, count(path) AS available, {pct_sql('count(path)', 'count(*)')} AS pct FROM cat""")
def availability_rate(spark, sf):
    return stats.availability_rate(fx.catalogue(spark, sf), "path")
