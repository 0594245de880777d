"""Main text of web pages by the maximum-scoring run of blocks.

A page is read as a sequence of words and tags. Words score positive and tags negative; the weights come from
labelled pages, those that mark their content with an ``article`` (else ``main``) element: a word weighs the share of such words
that lie inside the content, a tag minus TAG_COST times the share of such tags that lie outside. Words in links have
their own weight. One linear scan finds the contiguous run of blocks with the largest sum. From that run,
blocks inside boilerplate containers (menus, sidebars, adverts, notices, forms, comments, by element, role or
class) are left out.

Two sets of weights are learned from the same pages: one that knows whether a token stands inside the marked element, for
pages that mark it, and one that does not, for all others. The second takes all sectioning elements for plain ``div``, so it
also fits pages that name nothing, and weighs words by the element that holds them. Words of the classes and ids
of containers have weights too: a block counts by the least share among the containers around it (inside the marked element, those inside it),
and one below LEAST_SHARE is left out of the run like listed boilerplate.

Blocks are separated by block-level tags; ``br`` counts as white space. Character references are decoded, white space
inside a block becomes one blank, blocks are joined by line feeds.

Defined cases: NULL and empty pages, and pages without text, give the empty string; unclosed comments, scripts and
tags end with the page; repeated rows are extracted each; without labelled pages the weights are their priors; an empty table
gives an empty table; further columns stay as they are (``text`` and ``n_chars`` replace columns of that name).
"""

from __future__ import annotations

import html as html_entities
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.words import slices
from corpusloom.session import pin

#: words that one certain boilerplate tag outweighs
TAG_COST = 8.0
#: pseudo counts of the prior share (one half) of every weight
PRIOR = 2
#: blocks in containers whose words lie in the content less often than this are left out
LEAST_SHARE = 0.02
#: a class or id word is learned if one labelled page in this many has it, so the weights are bounded by the words a page has
PAGES_PER_NAME = 5_000
#: counts a task holds before it passes them on
HELD = 50_000

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|textarea|iframe|svg|math|object|select|button|title)(?=[\s>/])"
    r"(?:(?>\"[^\"]*+\"|'[^']*+'|[^'\">])*+>|[^>]*>).*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-z][a-z0-9:-]*)(?P<attrs>(?>\"[^\"]*+\"|'[^']*+'|[^'\">])*+|[^>]*)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.IGNORECASE | re.DOTALL,
)
MARKS = re.compile(r"\b(class|id|role|aria-label|hidden|aria-hidden|style)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.IGNORECASE)

INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q rb rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BOILERPLATE_TAGS = set("nav footer aside form dialog head menu fieldset".split())
BOILERPLATE_ROLES = set("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
BOILERPLATE_WORDS = set(
    "nav navbar navigation menu topnav subnav breadcrumb breadcrumbs sidebar aside footer masthead topbar toolbar "
    "ad ads adv advert adverts advertisement adsense adslot adbox sponsor sponsored promo promotion promoted banner "
    "cookie cookies consent gdpr notice notices alert notification newsletter subscribe subscription signup paywall "
    "comment comments commentlist disqus replies respond related recommended recommendations share sharing social "
    "pagination pager popup modal overlay login search widget widgets skip".split()
)
#: elements whose class and id say what they hold; those of headings, paragraphs, items and marked words only name them
CONTAINERS = set("div section article ul ol dl table tbody center details".split())
CONTENT_TAGS = ("article", "main")
#: elements that pages without marks write as ``div``
SECTIONS = set("article main section header footer nav aside".split())
HEADINGS = set("h2 h3 h4 h5 h6".split())  # counted as h1
_WORD = re.compile(r"[a-z]+")


def is_boilerplate(name: str, attrs: str) -> bool:
    """True if an element's name or role, or the class or id of a container, says that it is not main text."""
    if name in BOILERPLATE_TAGS:
        return True
    if not attrs or name in ("html", "body", "main"):
        return False
    for m in MARKS.finditer(attrs):
        key, value = m.group(1).lower(), (m.group(2) or m.group(3) or m.group(4) or "").lower()
        if key == "hidden" or key == "aria-hidden" and value == "true":
            return True
        if key == "style" and "display:none" in value.replace(" ", ""):
            return True
        if key == "role" and value in BOILERPLATE_ROLES:
            return True
        if key in ("class", "id") and name in CONTAINERS and not BOILERPLATE_WORDS.isdisjoint(_WORD.findall(value)):
            return True
    return False


def names_of(name: str, attrs: str) -> tuple[str, ...]:
    """Words of the class and id of a container, as tokens that start with a dot."""
    if name not in CONTAINERS or not attrs:
        return ()
    values = ((m.group(1).lower(), m.group(2) or m.group(3) or m.group(4) or "") for m in MARKS.finditer(attrs))
    return tuple("." + w for key, value in values if key in ("class", "id") for w in _WORD.findall(value.lower()))


class Block:
    """Text between two block-level tags, with the tags before it, what its words are and what holds them."""

    __slots__ = ("parts", "plain", "linked", "tags", "inside", "boilerplate", "home", "names")

    def __init__(self, inside: bool, boilerplate: bool):
        self.parts: list[str] = []
        self.plain = self.linked = 0
        self.tags: list[tuple[str, bool]] = []
        self.inside, self.boilerplate = inside, boilerplate
        self.home = ""
        self.names: tuple[str, ...] = ()


def blocks(page: str) -> tuple[list[Block], bool]:
    """The blocks of a page in order, and whether it marks its content."""
    tokens = list(TOKEN.finditer(page))
    marked = ""
    for wanted in CONTENT_TAGS:
        if any((m["name"] or "").lower() == wanted and not m["close"] and not is_boilerplate(wanted, m["attrs"] or "") for m in tokens):
            marked = wanted
            break
    out: list[Block] = []
    stack: list[tuple[str, bool, bool, tuple[str, ...]]] = []  # name, boilerplate, marks content, words of class and id
    inside = boilerplate = link = 0
    block = Block(False, False)

    def text(piece: str) -> None:
        piece = html_entities.unescape(piece) if "&" in piece else piece
        block.parts.append(piece)
        n = len(piece.split())
        if link:
            block.linked += n
        else:
            block.plain += n

    def flush() -> None:
        nonlocal block
        if block.plain or block.linked:
            out.append(block)
            block = Block(inside > 0, boilerplate > 0)
        else:
            tags = block.tags
            block = Block(inside > 0, boilerplate > 0)
            block.tags = tags

    at = 0
    for m in tokens:
        if m.start() > at:
            text(page[at:m.start()])
        at = m.end()
        name = (m["name"] or "").lower()
        if not name:
            continue
        if name in HEADINGS:
            name = "h1"
        if name == "br":
            block.parts.append(" ")
            continue
        closing = bool(m["close"])
        if name == "a":
            link = 0 if closing else 1
        if name in INLINE:
            block.tags.append((name, inside > 0))
            if name in VOID or closing and not any(e[0] == name for e in stack):
                continue
            if not closing and not (m["attrs"] and is_boilerplate(name, m["attrs"])):
                continue
        else:
            link = 0  # a link left open does not reach over its block
        if name in VOID:
            flush()
            block.tags.append((name, inside > 0))
            continue
        if closing:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    for _, bad, content, _ in stack[k:]:
                        boilerplate -= bad
                        inside -= content
                    del stack[k:]
                    break
        else:
            attrs = m["attrs"] or ""
            bad = is_boilerplate(name, attrs)
            content = name == marked and not bad
            if name == "header" and not inside:
                bad = True
            if name == "body" or content and not inside:
                # what was left open before the body or the content ends here
                stack = [] if name == "body" else [(n, False, c, names) for n, _, c, names in stack]
                boilerplate = 0
            while name in ("p", "li") and stack and stack[-1][0] == name:
                _, b, c, _ = stack.pop()
                boilerplate -= b
                inside -= c
            if not attrs.endswith("/"):
                stack.append((name, bad, content, names_of(name, attrs)))
                boilerplate += bad
                inside += content
        flush()
        block.inside, block.boilerplate = inside > 0, boilerplate > 0
        around = stack[max((k for k, e in enumerate(stack) if e[2]), default=-1) + 1:] if inside else stack
        block.names = tuple(w for e in around for w in e[3])
        block.home = _plain(stack[-1][0]) if stack else ""
        block.tags.append((name, inside > 0))
    if at < len(page):
        text(page[at:])
    if block.plain or block.linked:
        out.append(block)
    return out, bool(marked)


def _plain(name: str) -> str:
    return "div" if name in SECTIONS else name


Weights = dict[tuple[bool, str, bool], float]


def token_counts(page: str) -> Counter:
    """Of a labelled page: (knows the mark, token, stands inside, lies in the content) -> tokens."""
    counts: Counter = Counter()
    found, marked = blocks(page)
    if not marked:
        return counts
    for block in found:
        content = block.inside and not block.boilerplate
        words = [("#word", block.plain), ("#link", block.linked)]
        for token, n in words + [(name, 1) for name, _ in block.tags]:
            if n:
                counts[True, token, block.inside, block.inside] += n
                counts[False, _plain(token), False, content] += n
                if token[0] == "#":
                    counts[False, f"{token} {block.home}", False, content] += n
        for name in set(block.names):
            counts[False, name, False, content] += block.plain + block.linked
    return counts


def weights_of(counts: dict[tuple[bool, str, bool, bool], int]) -> Weights:
    """Weight of every (knows the mark, token, stands inside): words positive, tags negative."""
    out: Weights = {}
    for key in {k[:3] for k in counts}:
        share = (counts.get((*key, True), 0) + PRIOR / 2) / (counts.get((*key, True), 0) + counts.get((*key, False), 0) + PRIOR)
        out[key] = share if key[1][0] in "#." else -TAG_COST * (1 - share)
    return out


def scores_of(found: list[Block], marked: bool, weights: Weights) -> tuple[list[float], list[float]]:
    """Per block the cost of the tags before it and the value of its words (0 for what is left out of a run)."""
    word = weights.get
    costs, values = [], []
    for block in found:
        inside = marked and block.inside
        least = min((word((False, name, False), 1.0) for name in block.names), default=1.0)
        if block.boilerplate or least < LEAST_SHARE:
            value = 0.0
        elif marked:
            # inside a marked element what was never seen there counts as content
            value = least * (block.plain * word((True, "#word", inside), 1.0 if inside else 0.5)
                             + block.linked * word((True, "#link", inside), 1.0 if inside else 0.25))
        else:
            value = least * (block.plain * word((False, f"#word {block.home}", False), word((False, "#word", False), 0.5))
                             + block.linked * word((False, f"#link {block.home}", False), word((False, "#link", False), 0.25)))
        if marked:
            cost = sum(word((True, name, within), 0.0 if within else -TAG_COST / 4) for name, within in block.tags)
        else:
            cost = sum(word((False, _plain(name), False), -TAG_COST / 4) for name, _ in block.tags)
        costs.append(cost)
        values.append(value)
    return costs, values


def best_run(costs: list[float], values: list[float]) -> tuple[int, int]:
    """(first, end) of the run with the largest sum; the cost before its first block belongs to no run."""
    best, run = 0.0, (0, 0)
    total, begin = 0.0, 0
    for i, (cost, value) in enumerate(zip(costs, values)):
        if total + cost <= 0:
            total, begin = 0.0, i
        else:
            total += cost
        total += value
        if total > best or total == best and total:
            best, run = total, (begin, i + 1)
    return run


def main_text(page: str, weights: Weights) -> str:
    """The text of the best-scoring run of blocks without its boilerplate."""
    found, marked = blocks(page)
    costs, values = scores_of(found, marked, weights)
    first, end = best_run(costs, values)
    lines = (" ".join("".join(b.parts).split()) for b, value in zip(found[first:end], values[first:end]) if value > 0)
    return "\n".join(line for line in lines if line)


def learn_weights(pages: DataFrame, html: str = "html") -> Weights:
    """Weights from all labelled pages; counts are summed per token before they reach the driver.

    The result is bounded: names of elements outside HTML's own are counted as one, and words of classes and ids are
    kept if a fixed share of the labelled pages has them.
    """
    known = INLINE | VOID | BOILERPLATE_TAGS | set(
        "html body main article section header div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption figure figcaption blockquote pre address details summary center".split())

    fields = (("knows", pa.bool_()), ("token", pa.string()), ("inside", pa.bool_()), ("content", pa.bool_()), ("n", pa.int64()), ("pages", pa.int64()))

    def bounded(token: str) -> str:
        sign, _, home = token.rpartition(" ")
        if token[0] == "." or home in known or not home or home[0] == "#":
            return token
        return f"{sign} other".strip()

    def rows(total: Counter, pages: Counter) -> pa.RecordBatch:
        out = [(*key, n, pages[key]) for key, n in total.items()]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], kind) for i, (_, kind) in enumerate(fields)], names=[f for f, _ in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = Counter(), Counter()
        for batch in batches:
            for page in batch.column(0).to_pylist():
                counts = token_counts(page or "")
                for (knows, token, inside, content), n in counts.items():
                    key = knows, bounded(token), inside, content
                    total[key] += n
                    seen[key] += 1
                if counts:
                    seen[False, ".", False, True] += 1  # all labelled pages
                    total[False, ".", False, True] += 1
                if len(total) > HELD:
                    yield rows(total, seen)
                    total, seen = Counter(), Counter()
        yield rows(total, seen)

    counted = pages.select(html).mapInArrow(run, "knows boolean, token string, inside boolean, content boolean, n long, pages long")
    summed = pin(counted.groupBy("knows", "token", "inside", "content").agg(F.sum("n").alias("n"), F.sum("pages").alias("pages")))
    labelled = summed.where("token = '.'").agg(F.coalesce(F.sum("pages"), F.lit(0))).collect()[0][0]
    often = F.sum("pages").over(Window.partitionBy("token")) * PAGES_PER_NAME >= labelled
    found = summed.where("token <> '.'").withColumn("often", often).where("often OR NOT startswith(token, '.')").collect()
    return weights_of({(r.knows, r.token, r.inside, r.content): r.n for r in found})


def extract_text(pages: DataFrame, html: str = "html", weights: Weights | None = None) -> DataFrame:
    """Add ``text`` and ``n_chars`` (code points) of the whole pages; weights are learned first if not given."""
    shared = pages.sparkSession.sparkContext.broadcast(learn_weights(pages, html) if weights is None else weights)
    source = pages.columns.index(html)
    keep = [i for i, c in enumerate(pages.columns) if c.lower() not in ("text", "n_chars")]
    schema = T.StructType([pages.schema[i] for i in keep] + [T.StructField("text", T.StringType(), False), T.StructField("n_chars", T.LongType(), False)])
    positions = pages.toDF(*[f"c{i}" for i in range(len(pages.columns))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(source)
            for i, j, _, _ in slices(column):
                texts = [main_text(page or "", shared.value) for page in column.slice(i, j - i).to_pylist()]
                out = [batch.column(k).slice(i, j - i) for k in keep]
                out += [pa.array(texts, pa.string()), pa.array(np.fromiter(map(len, texts), np.int64, len(texts)))]
                yield pa.RecordBatch.from_arrays(out, names=schema.fieldNames())

    return positions.mapInArrow(run, schema)
