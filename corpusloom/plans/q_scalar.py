"""Queries over the column functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions import html, scalar, text
from corpusloom.functions.marc import marc_control, marc_subfield, marc_year
from corpusloom.plans import fixtures as fx
from corpusloom.plans.fixtures import table
from corpusloom.plans.registry import query
from corpusloom.session import spread
from corpusloom.sources.readers import marc_xml_parse

_SECTION_TERMS = ("Ascirr", "Esos", "the ", "der ")
_TOKEN_BOUNDS = (500, 1000, 2000, 4000)
_TOKEN_LABELS = ("<500", "500-1k", "1-2k", "2-4k", ">4k")
_YEAR_BOUNDS = (1996, 1998, 1999, 2000, 2001)
_YEAR_LABELS = ("<1996", "1996-1998", "1998-1999", "1999-2000", "2000-2001")
_PAGED = "replace(text, '. ', '.' || chr(12))"


def _bucket_sql(col, bounds, labels):
    arms = " ".join(f"WHEN {col} < {b} THEN '{name}'" for b, name in zip(bounds, labels))
    last = f" WHEN {col} >= {bounds[-1]} THEN '{labels[-1]}'" if len(labels) > len(bounds) else ""
    return f"CASE {arms}{last} END"


def _marc(spark, sf):
    return marc_xml_parse(fx.marc_xml(spark, sf), "xml")


@query("marc_subfield", f"WITH {fx.MARC_SQL} SELECT idn, title, title_author, ddc, author_person_id FROM marc")
def marc_subfield_query(spark, sf):
    return _marc(spark, sf).select(
        marc_control("001").alias("idn"), marc_subfield("245", "a").alias("title"),
        marc_subfield("245", "c").alias("title_author"), marc_subfield("082", "a").alias("ddc"),
        marc_subfield("100", "0").alias("author_person_id"),
    )


@query("marc_year", f"WITH {fx.MARC_SQL} SELECT idn, CASE WHEN CAST(idn AS BIGINT) % 10 = 0 THEN NULL ELSE year END AS year FROM marc")
def marc_year_query(spark, sf):
    return _marc(spark, sf).select(marc_control("001").alias("idn"), marc_year().alias("year"))


@query("marc_urls", f"WITH {fx.MARC_SQL} SELECT idn, urn, url_resolving_system, url_dnb_archive, url_publisher FROM marc")
def marc_urls(spark, sf):
    return _marc(spark, sf).select(
        marc_control("001").alias("idn"), marc_subfield("856", "u").alias("urn"),
        marc_subfield("856", "u", "4", "0").alias("url_resolving_system"),
        marc_subfield("856", "u", " ", "0").alias("url_dnb_archive"),
        marc_subfield("856", "u", "4", " ").alias("url_publisher"),
    )


@query("stratum_key", "SELECT o_orderkey, substring(o_orderpriority, 1, 1) AS stratum FROM orders")
def stratum_key(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", scalar.stratum_key(F.col("o_orderpriority")).alias("stratum"))


@query("safe_int", """SELECT p_partkey, CASE WHEN p_partkey % 4 <> 0 THEN p_size END AS value FROM part""")
def safe_int(spark, sf):
    raw = F.expr("CASE WHEN p_partkey % 4 = 0 THEN p_name WHEN p_partkey % 4 = 1 THEN concat(' ', p_size) ELSE CAST(p_size AS STRING) END")
    return table(spark, sf, "part").select("p_partkey", scalar.safe_int(raw).alias("value"))


@query("file_name_from_url", r"""
SELECT page_id, CAST(page_id AS VARCHAR) ||
  CASE WHEN regexp_extract(seg, '^\.*[^.].*(\.[^.]*)$', 1) = '' THEN '.pdf' ELSE regexp_extract(seg, '^\.*[^.].*(\.[^.]*)$', 1) END AS file_name
FROM (SELECT page_id, split_part(url, '/', -1) AS seg FROM pages)""")
def file_name_from_url(spark, sf):
    name = scalar.file_name_from_url(F.col("page_id").cast("string"), F.col("url"))
    return table(spark, sf, "pages").select("page_id", name.alias("file_name"))


@query("url_tail", """
SELECT page_id, url_decode(split_part(replace(url, '?', '%3F%20+'), '/', -1)) AS tail FROM pages""")
def url_tail(spark, sf):
    escaped = F.replace(F.col("url"), F.lit("?"), F.lit("%3F%20+"))
    return table(spark, sf, "pages").select("page_id", scalar.url_tail(escaped).alias("tail"))


@query("probe_status", """
SELECT event_id,
  CASE event_type WHEN 'error' THEN 'Error: reset' WHEN 'view' THEN 'Online' WHEN 'click' THEN 'Online (Not PDF)'
       ELSE concat('Offline (Status: ', CASE event_type WHEN 'signup' THEN 404 ELSE 503 END, ')') END AS status,
  CASE event_type WHEN 'view' THEN user_id * 1000 ELSE 0 END AS size,
  CASE event_type WHEN 'view' THEN concat(event_id, ' a+b.pdf') ELSE '' END AS filename
FROM events""")
def probe_status(spark, sf):
    log = table(spark, sf, "events").selectExpr(
        "event_id",
        "CASE event_type WHEN 'error' THEN NULL WHEN 'view' THEN 200 WHEN 'click' THEN 200 WHEN 'signup' THEN 404 ELSE 503 END AS status",
        "CASE event_type WHEN 'view' THEN 'application/pdf;charset=utf-8' ELSE 'text/html' END AS ctype",
        "user_id * 1000 AS len", "concat('https://x.example/d/', event_id, '%20a+b.pdf') AS url",
        "CASE event_type WHEN 'error' THEN 'reset' END AS error",
    )
    probe = scalar.probe_status(F.col("status"), F.col("ctype"), F.col("len"), F.col("url"), F.col("error"))
    return log.select("event_id", F.inline(F.array(probe)))


@query("sanitize_name", r"""
SELECT doc_id, regexp_replace(text || source, '[^\p{L}\p{N}_-]', '_', 'g') AS name FROM documents""")
def sanitize_name(spark, sf):
    raw = F.concat("text", "source")
    return table(spark, sf, "documents").select("doc_id", scalar.sanitize_name(raw).alias("name"))


@query("token_bucket", f"SELECT doc_id, {_bucket_sql('n_chars', _TOKEN_BOUNDS, _TOKEN_LABELS)} AS bucket FROM documents")
def token_bucket(spark, sf):
    bucket = scalar.token_bucket(F.col("n_chars"), _TOKEN_BOUNDS, _TOKEN_LABELS)
    return table(spark, sf, "documents").select("doc_id", bucket.alias("bucket"))


@query("year_bin", f"SELECT o_orderkey, {_bucket_sql('year(o_orderdate)', _YEAR_BOUNDS, _YEAR_LABELS)} AS bin FROM orders")
def year_bin(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", scalar.year_bin(F.year("o_orderdate"), _YEAR_BOUNDS, _YEAR_LABELS).alias("bin")
    )


@query("term_line_scan", f"""
SELECT doc_id, CAST(len(list_filter(lines, lambda l: contains(lower(l), 'en'))) AS INTEGER) AS num,
  CASE WHEN len(list_filter(lines, lambda l: contains(lower(l), 'en'))) = 0 THEN 0.0 ELSE
    CAST((2*list_position(list_transform(lines, lambda l: contains(lower(l), 'en')), true)*10000 + len(lines)) // (2*len(lines)) AS DOUBLE) / 100
  END AS pos
FROM (SELECT doc_id, string_split(regexp_replace(array_to_string(list_slice(string_split({_PAGED}, chr(12)), 1, 25), chr(12)),
                                  '\\n+$', ''), chr(10)) AS lines FROM documents)""")
def term_line_scan(spark, sf):
    paged = F.replace(F.col("text"), F.lit(". "), F.lit(".\f"))
    return fx.documents(spark, sf).select("doc_id", F.inline(F.array(text.term_line_scan(paged, "en", 25))))


def _term_sql(terms):
    return "CASE " + " ".join(f"WHEN contains(text, '{t}') THEN '{t}'" for t in terms) + " END"


SECTIONS_SQL = f"""
sec AS (SELECT doc_id, text, term, regexp_replace(split_part(split_part(text, term, 2), '#', 1), '^[\\s\\p{{Z}}]+|[\\s\\p{{Z}}]+$', '', 'g') AS section
        FROM (SELECT doc_id, text, {_term_sql(_SECTION_TERMS)} AS term FROM documents))"""


@query("section_extract", f"WITH {SECTIONS_SQL} SELECT doc_id, term, section FROM sec")
def section_extract(spark, sf):
    return fx.documents(spark, sf).select("doc_id", F.inline(F.array(text.section_extract(F.col("text"), _SECTION_TERMS))))


@query("snippet_context", f"""
SELECT doc_id, term,
  substring(text, greatest(1, p - 100), p - greatest(1, p - 100)) AS before,
  split_part(aft, '#', 1) AS section,
  substring(aft, length(split_part(aft, '#', 1)) + 1, 100) AS after
FROM (SELECT doc_id, text, term, strpos(text, term) AS p, split_part(text, term, 2) AS aft
      FROM (SELECT doc_id, text, {_term_sql(_SECTION_TERMS)} AS term FROM documents))""")
def snippet_context(spark, sf):
    return fx.documents(spark, sf).select("doc_id", F.inline(F.array(text.snippet_context(F.col("text"), _SECTION_TERMS))))


@query("token_count", r"""
SELECT doc_id, CAST(len(regexp_extract_all(text, '\p{L}+|\p{N}+|[^\s\p{L}\p{N}]')) AS INTEGER) AS token_count, 'regex' AS method FROM documents""")
def token_count(spark, sf):
    return text.token_count(fx.documents(spark, sf), "text").select("doc_id", "token_count", "method")


@query("doc_validate", """
SELECT doc_id, reason IS NULL AS is_valid, reason FROM (
  SELECT doc_id, CASE WHEN source = 'src3' THEN 'Invalid PDF signature' WHEN doc_id % 17 = 0 THEN 'PDF validation failed'
    WHEN n_chars // 200 = 0 THEN 'PDF has no pages'
    WHEN n_chars // 200 > 20 THEN concat('PDF exceeds 20 page limit (has ', n_chars // 200, ' pages)')
    WHEN doc_id % 19 = 0 THEN 'Cannot access first page' END AS reason FROM documents)""")
def doc_validate(spark, sf):
    docs = table(spark, sf, "documents")
    head = F.when(F.col("source") == "src3", F.substring("text", 1, 5)).otherwise("%PDF-")
    pages = F.when(F.col("doc_id") % 17 != 0, F.expr("n_chars div 200"))
    return docs.select("doc_id", F.inline(F.array(text.doc_validate(head, pages, F.col("doc_id") % 19 != 0, 20))))


@query("html_cell_normalize", r"""
SELECT page_id, CAST(pos - 1 AS INTEGER) AS pos, regexp_replace(trim(link), '\s+', '', 'g') AS code,
       trim(regexp_replace(link, '\s+', ' ', 'g')) AS topic
FROM (SELECT page_id, regexp_extract(li, '<a[^>]*>(.*?)</a>', 1) AS link, pos
      FROM (SELECT page_id, unnest(items) AS li, generate_subscripts(items, 1) AS pos
            FROM (SELECT page_id, regexp_extract_all(html, '<li>(.*?)</li>', 1, 's') AS items FROM pages)))""")
def html_cell_normalize(spark, sf):
    return html.list_items(spread(table(spark, sf, "pages").select("page_id", "html"), "page_id"), "page_id", "html")


@query("indent_level", """
SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_returnflag = 'R' THEN 0 ELSE CAST(l_quantity AS INTEGER) % 9 END AS level FROM lineitem""")
def indent_level(spark, sf):
    cell = F.expr("""
        CASE l_returnflag WHEN 'R' THEN '<td>plain</td>'
          WHEN 'A' THEN concat('<td><div style="padding-left: ', CAST(CAST(l_quantity AS INT) % 9 * 0.8 AS DECIMAL(9,1)), 'em">x</div></td>')
          ELSE concat('<td><div style="color:red;margin-left:', CAST(CAST(l_quantity AS INT) % 9 * 0.8 AS DECIMAL(9,1)), 'em">x</div></td>') END""")
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", html.indent_level(cell).alias("level"))
