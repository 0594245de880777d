"""Cells of classification tables: codes, topics and indentation, as column expressions."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Possessive quantifiers keep matching iterative on long cells.
_SPACE = r"(?:[\s\x{a0}]++|&nbsp;|&#160;)*+"
_BOLD = r"<span\b(?=[^>]*font-weight)(?=[^>]*bold)[^>]*>"
_GREY = r"<span\b(?=[^>]*color)(?=[^>]*grey)[^>]*>"
_LINK = r"(?s)<a\b[^>]*>(.*?)</a>"
_DIV = r"<div\b[^>]*>"


def element(html: Column, tag: str, start: str) -> Column:
    """The first element ``tag`` whose start tag matches ``start`` -> struct (before, body, after), NULL without one.

    A stack of one kind of tag is a number: the text is cut into tags and what stands between, and one pass counts
    how many elements ``tag`` are open inside the one wanted, to any depth. An element that never ends reaches to the end.
    """
    tokens = F.regexp_extract_all(html, F.lit(r"(?s)<[^>]*+>|<|[^<]++"), 0)
    state = F.struct(F.lit(-1).alias("open"), F.lit("").alias("before"), F.lit("").alias("body"), F.lit("").alias("after"))

    def step(s: Column, t: Column) -> Column:
        # open: -1 before the element, the number of open elements inside it, 0 behind its end
        inner = s["open"] + F.when(t.rlike(rf"^<{tag}\b(?!.*/>$)"), 1).when(t.rlike(rf"^</{tag}\b"), -1).otherwise(0)
        found = (s["open"] == -1) & t.rlike(f"(?s)^(?:{start})")
        state = F.when(found, 1).when(s["open"] > 0, inner).otherwise(s["open"])
        return F.struct(
            state.alias("open"),
            F.when((s["open"] == -1) & ~found, F.concat(s["before"], t)).otherwise(s["before"]).alias("before"),
            F.when((s["open"] > 0) & (inner > 0), F.concat(s["body"], t)).otherwise(s["body"]).alias("body"),
            F.when(s["open"] == 0, F.concat(s["after"], t)).otherwise(s["after"]).alias("after"))

    return F.when(html.rlike(f"(?s){start}"), F.aggregate(tokens, state, step))


def decode_entities(text: Column) -> Column:
    """Decode named (HTML 5), decimal and hexadecimal character references."""
    names = F.from_json(F.lit(json.dumps({n[:-1]: c for n, c in html5.items() if n.endswith(";")})), "MAP<STRING, STRING>")

    def decode(part):
        name = F.regexp_extract(part, r"^&([a-zA-Z][a-zA-Z0-9]*);", 1)
        number = F.regexp_extract(part, r"^&#0*([0-9]{1,7});", 1)
        hexed = F.regexp_extract(part, r"^&#[xX]0*([0-9a-fA-F]{1,6});", 1)
        rest = F.regexp_replace(part, r"^&#?[a-zA-Z0-9]+;", "")
        number = F.when(hexed != "", F.conv(hexed, 16, 10)).otherwise(number)
        char = F.decode(F.unhex(F.lpad(F.hex(number.try_cast("int")), 8, "0")), "UTF-32")
        return (
            F.when((name != "") & F.try_element_at(names, name).isNotNull(), F.concat(names[name], rest))
            .when(number != "", F.concat(char, rest))
            .otherwise(part)
        )

    return F.when(~F.contains(text, F.lit("&")), text).otherwise(
        F.array_join(F.transform(F.split(text, "(?=&)"), decode), "")
    )


def cell_text(html: Column) -> Column:
    """Text of an HTML fragment; each text node is stripped, entities are decoded."""
    bare = F.regexp_replace(html, rf"(?s){_SPACE}<[^>]*>{_SPACE}", "")
    return F.trim(decode_entities(bare))


def _squeeze(text: Column, joiner: str) -> Column:
    plain = F.replace(text, F.lit("\u00a0"), F.lit(""))
    return F.regexp_replace(F.regexp_replace(plain, r"^\s+|\s+$", ""), r"\s+", joiner)


def cell_code(cell: Column) -> Column:
    """Code of a table cell: bold text without its grey part, else link text plus grey text."""
    bold = element(cell, "span", _BOLD)["body"]
    inner = element(bold, "span", _GREY)
    without_grey = F.coalesce(F.concat(inner["before"], inner["after"]), bold)
    link = F.regexp_extract(cell, _LINK, 1)
    grey = element(cell, "span", _GREY)["body"]
    code = F.when(cell.rlike(_BOLD), cell_text(without_grey)).when(
        cell.rlike(r"<a\b"), F.concat(cell_text(link), F.coalesce(cell_text(grey), F.lit("")))
    )
    return _squeeze(F.coalesce(code, F.lit("")), "")


def cell_topic(cell: Column) -> Column:
    """Topic of a table cell: in its div the bold text, link text or all text, else the cell's text."""
    div = element(cell, "div", _DIV)["body"]
    in_div = F.coalesce(element(div, "span", _BOLD)["body"], F.when(div.rlike(r"<a\b"), F.regexp_extract(div, _LINK, 1)), div)
    return _squeeze(cell_text(F.coalesce(in_div, cell)), " ")


def indent_level(cell: Column) -> Column:
    """Depth from the em indent of the first div, 0.8 em per level; 0 without one.

    The division is decimal: 2.4 em is level 3.
    """
    style = F.regexp_extract(cell, r"""(?s)<div\b[^>]*?style\s*=\s*(["'])(.*?)\1""", 2)
    first_div = F.regexp_extract(cell, r"(?s)(<div\b[^>]*>)", 1)
    em = F.regexp_extract(style, r"(?:padding-left|margin-left):\s*([\d.]+)em", 1)
    level = F.floor(em.try_cast("decimal(9,3)") / F.lit("0.8").cast("decimal(2,1)")).cast("int")
    return F.when(first_div.rlike(r"style\s*="), F.coalesce(level, F.lit(0))).otherwise(0)


def elements(html: Column, tag: str) -> Column:
    """The bodies of all elements ``tag`` in the order of their starts; one that lies inside another has its own entry too.

    Each start is paired with its own end: behind a start, the depth is a running sum over the tags that follow. Texts in
    which none lies inside another are cut by a pattern alone.
    """
    plain = F.regexp_extract_all(html, F.lit(rf"(?s)<{tag}\b[^>]*>(.*?)</{tag}>"), 1)
    inside = html.rlike(rf"(?s)<{tag}\b[^>]*>(?:[^<]++|<(?!/?{tag}\b))*+<{tag}\b")
    pieces = F.split(html, rf"(?=<{tag}\b)")
    bodies = F.transform(pieces, lambda piece, i: element(F.array_join(F.slice(pieces, i + 1, F.size(pieces)), ""), tag, rf"<{tag}\b[^>]*>")["body"])
    starts = F.transform(pieces, lambda piece: piece.rlike(rf"^<{tag}\b[^>]*>"))
    own = F.transform(F.filter(F.arrays_zip(starts.alias("is_start"), bodies.alias("body")), lambda x: x["is_start"]), lambda x: x["body"])
    return F.when(inside, own).otherwise(plain)


def schedule_rows(df: DataFrame, page: str, html: str) -> DataFrame:
    """Rows of the result table of each page -> (page, pos, level, code, topic); rows without code drop out."""
    table = element(F.col(html), "table", r"""<table\b[^>]*\bid\s*=\s*["']?scheduleResult(?=["'\s>])[^>]*>""")["body"]
    return (
        df.select(page, table.alias("_table"))
        .select(page, F.posexplode(elements(F.col("_table"), "tr")).alias("pos", "_row"))
        .withColumn("_cells", elements(F.col("_row"), "td"))
        .where(F.size("_cells") >= 2)
        .select(
            page,
            "pos",
            indent_level(F.get("_cells", F.lit(1))).alias("level"),
            cell_code(F.get("_cells", F.lit(0))).alias("code"),
            cell_topic(F.get("_cells", F.lit(1))).alias("topic"),
        )
        .where("code <> ''")
    )


def list_items(df: DataFrame, page: str, html: str) -> DataFrame:
    """Normalised list entries of each page -> (page, pos, code, topic)."""
    return df.select(page, F.posexplode(elements(F.col(html), "li")).alias("pos", "_cell")).select(
        page, "pos", cell_code(F.col("_cell")).alias("code"), cell_topic(F.col("_cell")).alias("topic")
    )
