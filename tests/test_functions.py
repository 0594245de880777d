"""Edge cases of the column functions."""

import os

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import html, marc, scalar, text
from corpusloom.sources.readers import marc_xml_parse


def values(spark, inputs, fn, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {dtype}")
    return [r.x for r in df.select("i", fn(F.col("v")).alias("x")).orderBy("i").collect()]


def test_safe_int(spark):
    got = values(spark, ["12", " 7 ", "+5", "-3", "", "x1", "1.5", None, "99999999999"], scalar.safe_int)
    assert got == [12, 7, 5, -3, None, None, None, None, None]


def test_file_names_follow_splitext(spark):
    urls = ["http://x/a.pdf", "http://x/a", "http://x/a..b", "http://x/.bash", "http://x/a.tar.gz", "http://x/d.e/f", "http://x/", "a.b.", "..x"]
    want = ["7" + (os.path.splitext(u)[1] or ".pdf") for u in urls]
    assert values(spark, urls, lambda c: scalar.file_name_from_url(F.lit("7"), c)) == want


def test_url_tail(spark):
    got = values(spark, ["http://x/a%20b", "http://x/a+b", "http://x/100%", "http://x/%C3%A4", "plain"], scalar.url_tail)
    assert got == ["a b", "a+b", "100%", "ä", "plain"]


def test_sanitize_name(spark):
    assert values(spark, ["Künste & Co.", "a-b_c", "5 x"], scalar.sanitize_name) == ["Künste___Co_", "a-b_c", "5_x"]


def test_buckets_are_half_open(spark):
    tokens = [0, 49_999, 50_000, 127_999, 128_000, 10**6, None]
    assert values(spark, tokens, scalar.token_bucket, "int") == ["<50k", "<50k", "50-80k", "100-128k", ">128k", ">128k", None]
    years = [1999, 2000, 2019, 2020, 2023, 2024, None]
    assert values(spark, years, scalar.year_bin, "int") == ["<2000", "2000-2010", "2015-2020", "2020-2024", "2020-2024", None, None]


def test_probe_status(spark):
    rows = [
        (200, "application/pdf", 10, "http://x/a%20b.pdf", None), (200, "application/pdf", None, "http://x/c", None),
        (200, "text/html", 5, "http://x/d", None), (200, None, 5, "u", None), (404, "application/pdf", 5, "u", None), (None, None, None, "u", "timeout"),
    ]
    df = spark.createDataFrame(rows, "s int, t string, l long, u string, e string")
    probe = scalar.probe_status(F.col("s"), F.col("t"), F.col("l"), F.col("u"), F.col("e"))
    assert [tuple(r.p) for r in df.select(probe.alias("p")).collect()] == [
        ("Online", 10, "a b.pdf"), ("Online", 0, "c"), ("Online (Not PDF)", 0, ""), ("Online (Not PDF)", 0, ""),
        ("Offline (Status: 404)", 0, ""), ("Error: timeout", 0, ""),
    ]


def test_rounding_is_half_up_and_safe_for_zero(spark):
    df = spark.createDataFrame([(1, 800), (9, 400), (1, 3), (0, 5), (1, 0)], "n long, d long")
    assert [r.p for r in df.select(scalar.percent(F.col("n"), F.col("d"), 1).alias("p")).collect()] == [0.1, 2.3, 33.3, 0.0, None]
    near = spark.range(1).select(scalar.rounded_ratio(F.lit(5 * 10**9 - 1), F.lit(10**10), 0).alias("p")).first().p
    assert near == 0.0  # 0.4999999999
    big = spark.range(1).select(scalar.percent(F.lit(10**14), F.lit(3 * 10**14)).alias("p")).first().p
    assert big == 33.33


def test_micros_with_and_without_zone(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-03-01 12:34:56.789012' AS a, TIMESTAMP'2024-03-01 12:34:56.789012' AS b, TIMESTAMP_NTZ'1969-12-31 23:59:59.5' AS c")
    row = df.select(scalar.micros(df, "a").alias("a"), scalar.micros(df, "b").alias("b"), scalar.micros(df, "c").alias("c")).first()
    assert row.a == row.b == 1709296496789012 and row.c == -500_000


PAGE26 = "\f".join(["x"] * 25 + ["abstract"])
SCANS = [
    ("Abstract\nfoo", (1, 50.0)), ("a\nb\n", (0, 0.0)), ("", (0, 0.0)), ("a\nan ABSTRACT abstract\nabstract\n\n\n", (2, 66.67)),
    (PAGE26, (0, 0.0)), ("\f".join(["x"] * 24 + ["abstract"]), (1, 100.0)), (None, None), ("\n" * 7 + "abstract", (1, 100.0)),
]


def test_term_line_scan(spark):
    assert tuple(values(spark, [PAGE26], lambda c: text.term_line_scan(c, "abstract"))[0]) == (1, 100.0)
    got = values(spark, [t for t, _ in SCANS], lambda c: text.term_line_scan(c, "abstract", 25))
    assert [None if g is None else tuple(g) for g in got] == [w for _, w in SCANS]


def test_term_is_taken_literally(spark):
    got = values(spark, ["c++ rocks\nplain c\nC++"], lambda c: text.term_line_scan(c, "C++"))
    assert tuple(got[0]) == (2, 33.33)


SECTIONS = [
    ("intro # Abstract\n text one # Next", ("# Abstract", "text one")), ("## Abstract x", ("# Abstract", "x")),
    ("#Abstract a #Abstract b", ("#Abstract", "a")), ("# abstract only", ("# abstract", "only")), ("nothing", (None, None)), ("", (None, None)),
    ("#Abstract late # Abstract  wins ", ("# Abstract", "wins")),
]


def test_long_runs_of_blanks_stay_linear(spark):
    junk = "x" + "\n" * 200_000 + "abstract" + " " * 200_000 + "y" + "\n" * 200_000
    assert tuple(values(spark, [junk], lambda c: text.term_line_scan(c, "abstract"))[0]) == (1, 100.0)
    got = values(spark, ["# Abstract" + " " * 200_000 + "a" + " " * 200_000 + "b" + " " * 200_000], text.section_extract)[0]
    assert len(got.section) == 200_002
    cell = "<a>" + "word " * 50_000 + "</a><span style='color:grey'>" + "z" * 50_000 + "</span>"
    assert len(values(spark, [cell], html.cell_code)[0]) == 250_000


def test_section_extract(spark):
    got = values(spark, [t for t, _ in SECTIONS], text.section_extract)
    assert [tuple(g) for g in got] == [w for _, w in SECTIONS]


def test_snippet_context(spark):
    body = "p" * 150 + "# Abstract section # rest of it"
    term, before, section, after = values(spark, [body], text.snippet_context)[0]
    assert (term, before, section, after) == ("# Abstract", "p" * 100, " section ", "# rest of it")
    term, before, section, after = values(spark, ["ab# Abstract s"], text.snippet_context)[0]
    assert (before, section, after) == ("ab", " s", "")


def test_token_count(spark):
    df = spark.createDataFrame([("Hallo, Welt 42!",), ("äö",), (None,)], "t string")
    assert [(r.token_count, r.method) for r in text.token_count(df, "t").collect()] == [(5, "regex"), (1, "regex"), (None, "regex")]


def test_doc_validate_order_of_reasons(spark):
    rows = [("%PDF-", 10, True), ("<html", None, False), ("%PDF-", None, True), ("%PDF-", 0, True), ("%PDF-", 201, True), ("%PDF-", 5, False), (None, 5, True)]
    df = spark.createDataFrame(rows, "h string, p int, ok boolean")
    got = [tuple(r.x) for r in df.select(text.doc_validate(F.col("h"), F.col("p"), F.col("ok")).alias("x")).collect()]
    assert got == [
        (True, None), (False, "Invalid PDF signature"), (False, "PDF validation failed"), (False, "PDF has no pages"),
        (False, "PDF exceeds 200 page limit (has 201 pages)"), (False, "Cannot access first page"), (False, "Invalid PDF signature"),
    ]


CELLS_CODE = [
    ('<span style="font-weight: bold">5<span style="color:grey">00</span>10 </span>', "510"), ('<a href="x"> 51 0.<b>1</b></a>', "510.1"),
    ('<a>51</a><span style="color: grey">&nbsp;0</span>', "510"), ("plain", ""), ('<span style="bold; font-weight:x">T1&#8211;09</span>', "T1–09"),
]
CELLS_TOPIC = [
    ('<div style="padding-left:0.8em"><span style="font-weight:bold">Physik &amp;\n Chemie</span></div>', "Physik & Chemie"),
    ("<div><a href=x>K&uuml;nste  &lt;neu&gt;</a> more</div>", "Künste <neu>"), ("<div> plain  text </div>", "plain text"), ("no div here", "no divhere"),
]


def test_cells(spark):
    assert values(spark, [c for c, _ in CELLS_CODE], html.cell_code) == [w for _, w in CELLS_CODE]
    assert values(spark, [c for c, _ in CELLS_TOPIC], html.cell_topic) == [w for _, w in CELLS_TOPIC]


def test_indent_level(spark):
    cells = ['<div style="padding-left: 2.4em">', '<div style="margin-left:0.8em;x:y">', "<div>", "<td>", '<div style="color:red">', '<div style="padding-left:1.5em">']
    assert values(spark, cells, html.indent_level) == [3, 1, 0, 0, 0, 1]


def test_schedule_rows(spark):
    page = """<table id="scheduleResult"><tr><th>h</th></tr>
      <tr><td><a>500</a></td><td><div style="padding-left:0em"><a>Science</a></div></td></tr>
      <tr><td> </td><td>skipped</td></tr>
      <tr><td><a>510</a></td><td><div style="padding-left:0.8em"><a>Maths</a></div></td></tr></table>"""
    df = spark.createDataFrame([(1, page), (2, "<p>none</p>")], "page int, html string")
    got = [(r.page, r.level, r.code, r.topic) for r in html.schedule_rows(df, "page", "html").orderBy("pos").collect()]
    assert got == [(1, 0, "500", "Science"), (1, 1, "510", "Maths")]


RECORD = """<record><controlfield tag="001">97250155X</controlfield><controlfield tag="008">{y}</controlfield>
<datafield tag="245" ind1="0" ind2="0"><subfield code="a">T</subfield></datafield>
<datafield tag="245" ind1="0" ind2="1"><subfield code="c">later</subfield></datafield>
<datafield tag="856" ind1="4" ind2="2"><subfield code="z">note</subfield></datafield>
<datafield tag="856" ind1=" " ind2="0"><subfield code="u">archive</subfield></datafield></record>"""


def test_marc_first_field_only(spark):
    years = ["970101s1999    gw", "970101s", "970101s19uu    gw", "970101s20"]
    df = marc_xml_parse(spark.createDataFrame([(RECORD.format(y=y),) for y in years], "xml string"), "xml")
    rows = marc.marc_flatten(df).collect()
    assert [r.year for r in rows] == ["1999", None, None, "20"]
    first = rows[0]
    assert (first.idn, first.title, first.title_author) == ("97250155X", "T", None)
    assert (first.urn, first.url_dnb_archive, first.url_publisher, first.ddc) == (None, "archive", None, None)


def test_html_references_quotes_attributes_and_depth(spark):
    assert values(spark, ["a &#xFC; &apos;x&apos; &#8211; &Uuml; &nosuch; &amp"], html.decode_entities) == ["a ü 'x' – Ü &nosuch; &amp"]
    cells = ["<div style='padding-left: 1.6em'>x</div>", '<div style="margin-left:0.8em">x</div>', "<div>x</div>"]
    assert values(spark, cells, html.indent_level) == [2, 1, 0]
    nested = '<span style="font-weight: bold">5<span>1<span>0<span>.<i>2</i></span></span></span></span>'
    assert values(spark, [nested], html.cell_code) == ["510.2"]
    page = f"<table class='t' id='scheduleResult'><tr class=a><td>{nested}</td><td><div style='padding-left:0.8em'>Topic</div></td></tr></table><ul><li class='b'><a>42</a> Name</li></ul>"
    df = spark.createDataFrame([("p", page)], "page string, html string")
    assert [tuple(r) for r in html.schedule_rows(df, "page", "html").collect()] == [("p", 0, 1, "510.2", "Topic")]
    assert html.list_items(df, "page", "html").count() == 1


def test_spans_nested_thirty_deep(spark):
    deep = "x"
    for i in range(30):
        deep = f'<span class="d{i}">{i % 10}{deep}</span>'
    cell = f'<span style="font-weight:bold">A{deep}<span style="color: grey">g<span>h</span>i</span>B</span> tail'
    assert values(spark, [cell], html.cell_code) == ["A" + "".join(str(i % 10) for i in reversed(range(30))) + "xB"]
    assert values(spark, [f"<div>1<div>2</div>{cell}</div><div>no</div>", "<div>a<div>b</div>c</div>d"], html.cell_topic)[1] == "abc"


def test_nested_lists_and_tables(spark):
    page = "<ul><li>a<ul><li>b</li><li>c<ul><li>d</li></ul></li></ul>e</li><li>f</li></ul>"
    df = spark.createDataFrame([("p", page), ("q", "<li>x</li><LI>"), ("r", None)], "page string, html string")
    got = sorted((r.page, r.pos, r.topic) for r in html.list_items(df, "page", "html").collect())
    assert got == [("p", 0, "abcde"), ("p", 1, "b"), ("p", 2, "cd"), ("p", 3, "d"), ("p", 4, "f"), ("q", 0, "x")]
    inner = "<table><tr><td>in</td></tr></table>"
    row = lambda code, topic: f'<tr><td><a>{code}</a></td><td><div style="margin-left:0.8em"><a>{topic}</a>{inner}</div></td></tr>'
    table = f'<table id="scheduleResult">{row(1, "one")}{row(2, "two")}</table>'
    df = spark.createDataFrame([("p", f"{inner}{table}{row(3, 'no')}")], "page string, html string")
    assert [(r.code, r.topic, r.level) for r in html.schedule_rows(df, "page", "html").orderBy("pos").collect()] == [("1", "one", 1), ("2", "two", 1)]
