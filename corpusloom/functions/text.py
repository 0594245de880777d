"""Text scanning as built-in column expressions; whole texts, no explode, no shuffle."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.scalar import percent

# Search terms for the abstract heading, shortest full section, model context size.
ABSTRACT_TERMS = ("# Abstract", "# abstract", "#Abstract")
MIN_SECTION_CHARS = 500
TOKEN_LIMIT = 128_000

# The lookbehind lets a long run of blanks be tried once, not from each of its characters.
_STRIP = r"^[\s\p{Z}]++|(?<![\s\p{Z}])[\s\p{Z}]++$"
#: words, numbers and single symbols
TOKEN_PATTERN = r"\p{L}+|\p{N}+|[^\s\p{L}\p{N}]"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip_text(text: Column) -> Column:
    """Remove leading and trailing whitespace of any kind."""
    return F.regexp_replace(text, _STRIP, "")


def term_line_scan(text: Column, term: str, pages: int | None = None) -> Column:
    """Look for ``term`` (any case) in the text, or in its first ``pages`` form-feed separated pages.

    -> struct(num INT, pos DOUBLE): lines holding the term, and the first such line in percent
    of all lines; (0, 0.0) without a hit, NULL for a NULL text. Trailing newlines do not count as
    lines. Texts without the term cost one substring search.
    """
    needle = F.lit(term.lower())
    rest_of_line = F.lit(re.escape(term.lower()) + r"[^\n]*")
    lines = lambda c: F.size(F.split(c, "\n"))
    head = F.lower(F.rtrim(text if pages is None else F.substring_index(text, "\f", pages), F.lit("\n")))
    counts = _let(
        head,
        lambda h: F.when(
            F.contains(h, needle),
            F.struct(
                F.regexp_count(h, rest_of_line).alias("num"),
                lines(F.substring_index(h, term.lower(), 1)).alias("first"),
                lines(h).alias("total"),
            ),
        ),
    )
    found = _let(
        counts,
        lambda c: F.struct(
            F.coalesce(c["num"], F.lit(0)).cast("int").alias("num"),
            F.coalesce(percent(c["first"], c["total"]), F.lit(0.0)).alias("pos"),
        ),
    )
    return F.when(text.isNotNull(), found)


def matched_term(text: Column, terms=ABSTRACT_TERMS) -> Column:
    """The first of ``terms`` that occurs in ``text``."""
    out = F.when(F.contains(text, F.lit(terms[0])), terms[0])
    for term in terms[1:]:
        out = out.when(F.contains(text, F.lit(term)), term)
    return out


def _after_term(text: Column, term: Column) -> Column:
    return F.split_part(text, term, F.lit(2))


def _to_heading(after: Column) -> Column:
    return F.substring_index(after, "#", 1)


def section_extract(text: Column, terms=ABSTRACT_TERMS) -> Column:
    """Section under the first matching term -> struct(term, section); NULLs without a match.

    The section ends at the next occurrence of the term or at the next ``#``.
    """
    return _let(
        matched_term(text, terms),
        lambda t: F.struct(t.alias("term"), strip_text(_to_heading(_after_term(text, t))).alias("section")),
    )


def snippet_context(text: Column, terms=ABSTRACT_TERMS, width: int = 100) -> Column:
    """The section with up to ``width`` characters around it -> struct(term, before, section, after)."""

    def cut(at):
        begin = F.greatest(F.lit(1), at["start"] - width)
        section = _to_heading(at["after"])
        return F.struct(
            at["term"].alias("term"),
            F.substring(text, begin, at["start"] - begin).alias("before"),
            section.alias("section"),
            F.substring(at["after"], F.length(section) + 1, F.lit(width)).alias("after"),
        )

    located = _let(
        matched_term(text, terms),
        lambda t: F.struct(t.alias("term"), F.instr(text, t).alias("start"), _after_term(text, t).alias("after")),
    )
    return _let(located, cut)


def regex_token_count(text: Column) -> Column:
    """Number of words, numbers and symbols."""
    return F.regexp_count(text, F.lit(TOKEN_PATTERN)).cast("int")


def token_count(df: DataFrame, text: str, counter: Callable[[Column], Column] | None = None,
                name: str = "token_count") -> DataFrame:
    """Add the token count of ``text`` and the ``method`` it was counted with.

    The default needs no vocabulary and stays in the JVM; its numbers differ from those of a BPE
    encoder. ``counter`` may be another column function.
    """
    count = regex_token_count(F.col(text)) if counter is None else counter(F.col(text))
    return df.withColumn(name, count).withColumn("method", F.lit("regex" if counter is None else "bpe"))


def doc_validate(head: Column, num_pages: Column, first_page_ok: Column | None = None,
                 max_pages: int = 200) -> Column:
    """First reason a document is unusable -> struct(is_valid, reason).

    ``head`` holds the first bytes as text; NULL pages stand for a file that could not be parsed.
    """
    readable = F.lit(True) if first_page_ok is None else F.coalesce(first_page_ok, F.lit(False))
    reason = (
        F.when(~F.coalesce(F.startswith(head, F.lit("%PDF-")), F.lit(False)), "Invalid PDF signature")
        .when(num_pages.isNull(), "PDF validation failed")
        .when(num_pages == 0, "PDF has no pages")
        .when(
            num_pages > max_pages,
            F.concat(F.lit(f"PDF exceeds {max_pages} page limit (has "), num_pages.cast("string"), F.lit(" pages)")),
        )
        .when(~readable, "Cannot access first page")
    )
    return F.struct(reason.isNull().alias("is_valid"), reason.alias("reason"))
