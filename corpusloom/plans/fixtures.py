"""Views that give the driver tables the shape of the corpus tables, in Spark and as SQL.

Each ``*_SQL`` constant is a list of CTEs with the same content as the function of that name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.text import term_line_scan
from corpusloom.operators.linkage import link_join
from corpusloom.operators.taxonomy import MAIN_MISSING, SUB_MISSING, taxonomy_dimension
from corpusloom.session import pin, spread

SEED = 42


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents for CPU-bound text scans."""
    return spread(table(spark, sf_dir, "documents"), "doc_id")


# --- documents as records: stratum lang, pages of 2000 characters, hits of a term ----------


def records(spark: SparkSession, sf_dir: str, term: str = "license") -> DataFrame:
    docs = documents(spark, sf_dir)
    scan = term_line_scan(F.col("text"), term)
    return docs.select(
        "doc_id", "lang", "source", "n_chars",
        F.expr("CAST((n_chars + 1999) div 2000 AS INT)").alias("num_pages"),
        scan["num"].alias("abstract_num"),
        scan["pos"].alias("abstract_pos"),
    )


def scanned(spark: SparkSession, sf_dir: str, term: str = "license") -> DataFrame:
    """``records`` as a stored table: the texts are scanned once, filters run on the results."""
    return pin(records(spark, sf_dir, term))


def records_sql(term: str = "license") -> str:
    hit = f"lambda l: contains(lower(l), '{term}')"
    return f"""
recs AS (
  SELECT doc_id, lang, source, n_chars, CAST((n_chars + 1999) // 2000 AS INTEGER) AS num_pages,
         CAST(len(list_filter(lines, {hit})) AS INTEGER) AS abstract_num,
         CASE WHEN len(list_filter(lines, {hit})) = 0 THEN 0.0 ELSE
           CAST((2*list_position(list_transform(lines, {hit}), true)*10000 + len(lines)) // (2*len(lines)) AS DOUBLE) / 100
         END AS abstract_pos
  FROM (SELECT *, string_split(regexp_replace(text, '\\n+$', ''), chr(10)) AS lines FROM documents))"""


# --- orders as records: stratum, year string, code, path ----------------------------------


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS id",
        "substring(o_orderpriority, 1, 1) AS stratum",
        "CASE WHEN o_orderkey % 50 = 0 THEN 'n.d.' ELSE CAST(year(o_orderdate) AS STRING) END AS year",
        """CASE WHEN o_orderkey % 97 = 0 THEN '' WHEN o_orderkey % 89 = 0 THEN CAST(o_custkey % 10 AS STRING)
                WHEN o_orderkey % 83 = 0 THEN concat('x', o_custkey % 10) WHEN o_orderkey % 79 = 0 THEN NULL
                ELSE concat(lpad(CAST(o_custkey % 1000 AS STRING), 3, '0'), '.', o_orderkey % 7) END AS ddc""",
        """CASE WHEN o_orderkey % 11 = 0 THEN NULL
                ELSE concat('files/', o_orderkey, CASE WHEN o_orderstatus = 'P' THEN '.html' ELSE '.pdf' END) END AS path""",
        "CAST(o_totalprice AS BIGINT) % 4 AS hits",
    )


CATALOGUE_SQL = """
cat AS (
  SELECT o_orderkey AS id, substring(o_orderpriority, 1, 1) AS stratum,
         CASE WHEN o_orderkey % 50 = 0 THEN 'n.d.' ELSE CAST(year(o_orderdate) AS VARCHAR) END AS year,
         CASE WHEN o_orderkey % 97 = 0 THEN '' WHEN o_orderkey % 89 = 0 THEN CAST(o_custkey % 10 AS VARCHAR)
              WHEN o_orderkey % 83 = 0 THEN concat('x', o_custkey % 10) WHEN o_orderkey % 79 = 0 THEN NULL
              ELSE concat(lpad(CAST(o_custkey % 1000 AS VARCHAR), 3, '0'), '.', o_orderkey % 7) END AS ddc,
         CASE WHEN o_orderkey % 11 = 0 THEN NULL
              ELSE concat('files/', o_orderkey, CASE WHEN o_orderstatus = 'P' THEN '.html' ELSE '.pdf' END) END AS path,
         CAST(trunc(o_totalprice) AS BIGINT) % 4 AS hits
  FROM orders)"""


def class_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored names of the strata, one of them unknown."""
    return pin(
        table(spark, sf_dir, "orders")
        .where("o_orderpriority NOT LIKE '4%'")
        .groupBy(F.substring("o_orderpriority", 1, 1).alias("code"))
        .agg(F.min(F.substring_index("o_orderpriority", "-", -1)).alias("name"))
    )


CLASS_LABELS_SQL = """
names AS (SELECT substring(o_orderpriority, 1, 1) AS code, min(split_part(o_orderpriority, '-', -1)) AS name
          FROM orders WHERE o_orderpriority NOT LIKE '4%' GROUP BY 1)"""


# --- taxonomy from part keys: single decades and ranges, one class and one decade missing ----


def taxonomy(spark: SparkSession, sf_dir: str, whole: bool = False) -> DataFrame:
    """A taxonomy of all parts; unless ``whole`` a class and a decade are missing, for lookups that find nothing."""
    coded = table(spark, sf_dir, "part").selectExpr(
        "CAST((p_partkey % 1000) div 100 AS INT) AS m", "CAST((p_partkey % 1000) div 10 * 10 AS INT) AS d", "p_name", "p_type"
    )
    ranged = F.expr("m % 3 = 1 AND d % 100 >= 80")
    key = F.when(ranged, F.expr("concat(m, '80-', m, '90')")).otherwise(F.expr("lpad(CAST(d AS STRING), 3, '0')"))
    subs = (
        coded.where("true" if whole else "m <> 9 AND d <> 750")
        .withColumn("sub_key", key)
        .groupBy("m", "sub_key")
        .agg(F.min("p_name").alias("sub_name"), F.min("p_type").alias("t"))
    )
    mains = subs.groupBy("m").agg(F.concat(F.lit("Class "), F.min("t")).alias("main_name"))
    return subs.join(mains, "m").select(
        F.col("m").cast("string").alias("main"), "main_name", "sub_key",
        F.split_part("sub_key", F.lit("-"), F.lit(1)).cast("int").alias("lo"),
        F.substring_index("sub_key", "-", -1).cast("int").alias("hi"), "sub_name",
    )


TAXONOMY_SQL = """
coded AS (SELECT CAST((p_partkey % 1000) // 100 AS INTEGER) AS m, CAST((p_partkey % 1000) // 10 * 10 AS INTEGER) AS d, p_name, p_type FROM part),
subs AS (SELECT m, CASE WHEN m % 3 = 1 AND d % 100 >= 80 THEN concat(m, '80-', m, '90') ELSE lpad(CAST(d AS VARCHAR), 3, '0') END AS sub_key,
                min(p_name) AS sub_name, min(p_type) AS t FROM coded WHERE m <> 9 AND d <> 750 GROUP BY 1, 2),
mains AS (SELECT m, concat('Class ', min(t)) AS main_name FROM subs GROUP BY 1),
tax AS (SELECT CAST(m AS VARCHAR) AS main, main_name, sub_key, CAST(split_part(sub_key, '-', 1) AS INTEGER) AS lo,
               CAST(split_part(sub_key, '-', -1) AS INTEGER) AS hi, sub_name FROM subs JOIN mains USING (m))"""
WHOLE_TAXONOMY_SQL = TAXONOMY_SQL.replace(" WHERE m <> 9 AND d <> 750", "")


def dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taxonomy_dimension(taxonomy(spark, sf_dir))


def lookup_sql(source: str, code: str, name: str = "looked") -> str:
    """CTE adding main, main_name, sub_label to ``source``; needs TAXONOMY_SQL."""
    num = f"CASE WHEN regexp_matches(substring({code}, 1, 3), '^[0-9]+$') THEN TRY_CAST(substring({code}, 1, 3) AS INTEGER) // 10 * 10 END"
    return f"""
{name}_0 AS (SELECT *, {num} AS _d, substring({code}, 1, 1) AS _m FROM {source}),
{name} AS (
  SELECT s.* EXCLUDE (_d, _m),
         CASE WHEN m.main IS NULL OR _d IS NULL THEN '0' ELSE m.main END AS main,
         CASE WHEN m.main IS NULL OR _d IS NULL THEN '{MAIN_MISSING}' ELSE m.main_name END AS main_name,
         CASE WHEN m.main IS NULL OR _d IS NULL THEN '000 {SUB_MISSING}'
              WHEN t.sub_key IS NULL THEN lpad(CAST(_d AS VARCHAR), 3, '0') || ' {SUB_MISSING}'
              ELSE t.sub_key || ' ' || t.sub_name END AS sub_label
  FROM {name}_0 s LEFT JOIN (SELECT DISTINCT main, main_name FROM tax) m ON m.main = s._m
  LEFT JOIN tax t ON t.main = s._m AND s._d BETWEEN t.lo AND t.hi)"""


# --- links, entities, records ---------------------------------------------------------------


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    return (
        table(spark, sf_dir, "lineitem")
        .select("l_orderkey", "l_partkey")
        .join(part, "l_partkey")
        .select(
            F.col("l_orderkey").cast("string").alias("doc_idn"),
            F.col("l_partkey").cast("string").alias("gnd_idn"),
            F.col("p_name").alias("gnd_label"),
        )
    )


def link_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS id", "CAST(o_orderkey AS STRING) AS doc_idn"
    )


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS id", "CAST(p_partkey AS STRING) AS gnd_idn", "p_name AS gnd_label"
    )


def mappings(spark: SparkSession, sf_dir: str, records: DataFrame | None = None, known: DataFrame | None = None) -> DataFrame:
    """The mappings table, stored (pinned) as its reports read it more than once."""
    pairs = table(spark, sf_dir, "lineitem").selectExpr(
        "CAST(l_orderkey AS STRING) AS doc_idn", "CAST(l_partkey AS STRING) AS gnd_idn"
    )
    return pin(link_join(pairs, records or link_records(spark, sf_dir), known or entities(spark, sf_dir)))


LINKS_SQL = """
links AS (SELECT CAST(l_orderkey AS VARCHAR) AS doc_idn, CAST(l_partkey AS VARCHAR) AS gnd_idn, p_name AS gnd_label
          FROM lineitem JOIN part ON l_partkey = p_partkey)"""
MAPPINGS_SQL = """
lrecs AS (SELECT o_orderkey AS id, CAST(o_orderkey AS VARCHAR) AS doc_idn FROM orders),
ents AS (SELECT p_partkey AS id, CAST(p_partkey AS VARCHAR) AS gnd_idn, p_name AS gnd_label FROM part),
maps AS (SELECT DISTINCT l_orderkey AS record_id, l_partkey AS gnd_id FROM lineitem
         JOIN lrecs ON lrecs.id = l_orderkey JOIN ents ON ents.id = l_partkey)"""


# --- MARC records from orders ---------------------------------------------------------------

_MARC_PARTS = (
    "'<record><leader>x</leader><controlfield tag=\"001\">', o_orderkey, '</controlfield>'",
    "'<controlfield tag=\"008\">', CASE WHEN o_orderkey % 10 = 0 THEN '19990' WHEN o_orderkey % 10 = 1 THEN '970101s19uu    gw'"
    " ELSE concat('970101s', year(o_orderdate), '    gw') END, '</controlfield>'",
    "'<datafield tag=\"245\" ind1=\"1\" ind2=\"0\"><subfield code=\"a\">', o_orderpriority, '</subfield>',"
    " CASE WHEN o_orderstatus = 'F' THEN concat('<subfield code=\"c\">by ', o_custkey, '</subfield>') ELSE '' END, '</datafield>'",
    "'<datafield tag=\"245\" ind1=\"1\" ind2=\"1\"><subfield code=\"c\">second</subfield></datafield>'",
    "CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE concat('<datafield tag=\"082\" ind1=\"0\" ind2=\"4\"><subfield code=\"a\">',"
    " o_custkey % 1000, '</subfield><subfield code=\"a\">other</subfield></datafield>') END",
    "'<datafield tag=\"100\" ind1=\"1\" ind2=\" \"><subfield code=\"0\">P', o_custkey, '</subfield><subfield code=\"a\">Author ',"
    " o_custkey, '</subfield></datafield>'",
    "CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE concat('<datafield tag=\"856\" ind1=\"', CASE WHEN o_orderkey % 4 = 1 THEN '4\" ind2=\"0'"
    " WHEN o_orderkey % 4 = 2 THEN ' \" ind2=\"0' ELSE '4\" ind2=\" ' END, '\"><subfield code=\"u\">https://a.example/', o_orderkey,"
    " '</subfield></datafield>') END",
    "'<datafield tag=\"856\" ind1=\" \" ind2=\"0\"><subfield code=\"u\">https://b.example/', o_orderkey, '</subfield></datafield></record>'",
)


#: records of one task
_RECORDS = 50_000


def marc_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One MARC-XML record per order in the column ``xml``."""
    return spread(table(spark, sf_dir, "orders"), "o_orderkey", _RECORDS).selectExpr(f"concat({', '.join(_MARC_PARTS)}) AS xml")


MARC_SQL = """
marc AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS idn,
         CASE WHEN o_orderkey % 10 <= 1 THEN NULL ELSE CAST(year(o_orderdate) AS VARCHAR) END AS year,
         o_orderpriority AS title,
         CASE WHEN o_orderstatus = 'F' THEN concat('by ', o_custkey) END AS title_author,
         CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_custkey % 1000 AS VARCHAR) END AS ddc,
         concat('P', o_custkey) AS author_person_id, concat('Author ', o_custkey) AS author_person_name,
         concat('https://', CASE WHEN o_orderkey % 4 = 0 THEN 'b' ELSE 'a' END, '.example/', o_orderkey) AS urn,
         CASE WHEN o_orderkey % 4 = 1 THEN concat('https://a.example/', o_orderkey) END AS url_resolving_system,
         concat('https://', CASE WHEN o_orderkey % 4 = 2 THEN 'a' ELSE 'b' END, '.example/', o_orderkey) AS url_dnb_archive,
         CASE WHEN o_orderkey % 4 = 3 THEN concat('https://a.example/', o_orderkey) END AS url_publisher
  FROM orders)"""
