"""Allow or block URLs by rules and by a path-template tree per host, in DataFrame operations only.

Rules name a host and the start of a path (``example.org/es/``), fit the host and its subdomains, and the longest
that fits decides. URLs without a rule are judged by the method:

1. *Generalise.* In every path segment runs of digits and long hexadecimal ids become ``#``. Equal paths of a host
   are counted once from here on. A node of the host's tree that has many different children with few URLs each takes the
   wildcard ``*`` in place of its children. This goes level by level from the root: a wildcard's children are those of all the
   nodes it took the place of.
2. *Merge.* Branches of a host that differ in one segment only are merged if the labelled purity of a
   branch does not differ from that of all of them by more than MERGE_Z standard errors, again level by level, with the
   merged branches as one node from there on.
3. *Reject.* A template is blocked if its smoothed purity is below one half. Purity is the share of allowed URLs among
   those labelled by rules; the share in the host's template is smoothed towards the same template over all hosts, that one
   towards all URLs.

Every grouping is pre-aggregated on (host, generalised path), so that a host with a third of all pages is some thousand
rows. Defined cases: NULL URLs and those without ``://`` have an empty host and path and are judged as such; repeated rows are
judged each; without labelled URLs all templates have purity one half and are allowed; an empty table gives an
empty table; further columns stay as they are (result columns replace columns of the same name).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.session import pin

#: a node with more different children than this, and fewer URLs per child than CHILD_URLS, takes a wildcard
MIN_CHILDREN = 20
CHILD_URLS = 10
#: standard errors within which a branch counts as similar
MERGE_Z = 1.96
#: pseudo counts of the smoothing
SMOOTH = 4.0

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """From after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, bool]]) -> tuple[Column, Column]:
    """The longest fitting rule and whether it allows; NULL without one. ``rules`` holds (host/path, allows)."""
    rule, allows = F.lit(None).cast("string"), F.lit(None).cast("boolean")
    for text, allowed in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        name, _, start = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + start)
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        allows = F.when(fits, F.lit(allowed)).otherwise(allows)
    return rule, allows


def segments_of(path: Column) -> Column:
    """Generalised segments of a path; empty segments do not count."""
    ids = F.regexp_replace(path, r"(?<![0-9a-zA-Z])(?=[a-fA-F]*[0-9])[0-9a-fA-F]{8,}(?![0-9a-zA-Z])", "#")
    return F.filter(F.split(F.regexp_replace(ids, r"[0-9]+", "#"), "/"), lambda x: x != "")


def _share(good: str, seen: str, prior: Column) -> Column:
    return (F.col(good) + F.lit(SMOOTH) * prior) / (F.col(seen) + F.lit(SMOOTH))


def _with_segment(segments: str, level: int, segment: str, where: Column) -> Column:
    """The array with another segment at ``level`` (from 0) on the rows of ``where``."""
    changed = F.transform(segments, lambda x, i: F.when(i == level, F.lit(segment)).otherwise(x))
    return F.when(where, changed).otherwise(F.col(segments))


def _start(segments: str, level: int) -> Column:
    return F.array_join(F.slice(segments, 1, level), "/")


def generalise(paths: DataFrame) -> DataFrame:
    """Add ``template``, the segments with wildcards, to rows (host, segments, n, ...).

    Each level is decided on the nodes that the levels above have left. Levels where no host has more than
    MIN_CHILDREN different segments cannot have a wildcard and take no pass.
    """
    named = paths.withColumn("template", F.col("segments"))
    segments = paths.select("host", F.posexplode("segments").alias("level", "segment")).distinct()
    many = segments.groupBy("host", "level").count().where(F.col("count") > MIN_CHILDREN)
    for level in sorted(r.level for r in many.select("level").distinct().collect()):
        named = named.withColumn("parent", _start("template", level))
        children = (
            named.where(F.size("template") > level)
            .groupBy("host", "parent", F.get("template", F.lit(level)).alias("segment")).agg(F.sum("n").alias("n"))
        )
        wild = (
            children.groupBy("host", "parent").agg(F.count("*").alias("children"), F.sum("n").alias("n"))
            .where((F.col("children") > MIN_CHILDREN) & (F.col("n") < CHILD_URLS * F.col("children")))
            .select("host", "parent", F.lit(True).alias("wild"))
        )
        named = pin(named.join(wild, ["host", "parent"], "left").withColumn(
            "template", _with_segment("template", level, "*", F.col("wild"))).select(*paths.columns, "template"))
    return named


def merge_siblings(tree: DataFrame) -> DataFrame:
    """Add ``merged``, the template with ``{}`` for similar siblings, to rows (host, template, good, seen).

    Levels where no two templates of a host have the same rest after different segments have no siblings and take no pass;
    at the first level a template without siblings is ``{}`` as well.
    """
    tree = pin(tree.withColumn("merged", F.when(F.size("template") == 0, F.array(F.lit(""))).otherwise(F.col("template"))))
    rest = F.xxhash64(F.slice("merged", F.col("level") + 2, F.size("merged")))
    steps = tree.select("host", "merged", F.posexplode("merged").alias("level", "segment")).select("host", "level", "segment", rest.alias("rest"))
    several = steps.groupBy("host", "level", "rest").agg(F.min("segment").alias("low"), F.max("segment").alias("high")).where("low < high")
    for level in sorted({0} | {r.level for r in several.select("level").distinct().collect()}):
        keys = ["host", "parent", "rest", "segment"]
        at = tree.withColumns({
            "parent": _start("merged", level), "segment": F.get("merged", F.lit(level)),
            "rest": F.array_join(F.slice("merged", level + 2, F.greatest(F.size("merged"), F.lit(1))), "/")})
        siblings = at.where(F.size("merged") > level).groupBy(*keys).agg(F.sum("good").alias("good"), F.sum("seen").alias("seen"))
        pooled = siblings.groupBy("host", "parent", "rest").agg(
            F.sum("good").alias("all_good"), F.sum("seen").alias("all_seen"), F.count("*").alias("siblings"))
        p = _share("all_good", "all_seen", F.lit(0.5))
        error = F.sqrt(p * (1 - p) / F.greatest(F.col("seen"), F.lit(1)))
        similar = (
            siblings.join(pooled.where(F.col("siblings") > (1 if level else 0)), ["host", "parent", "rest"])
            .where(((F.col("seen") > 0) | (F.col("all_seen") == 0))
                   & (F.abs(F.col("good") / F.greatest(F.col("seen"), F.lit(1)) - p) <= MERGE_Z * error))
            .select(*keys, F.lit(True).alias("similar"))
        )
        tree = pin(at.join(similar, keys, "left").withColumn(
            "merged", _with_segment("merged", level, "{}", F.col("similar"))).select(*tree.columns))
    return tree


def template_purity(paths: DataFrame) -> DataFrame:
    """(host, segments, template, purity) of the rows (host, segments, n, good, seen), one per generalised path.

    ``seen`` counts the URLs with a label, ``good`` those labelled as allowed.
    """
    named = generalise(paths)
    tree = merge_siblings(named.groupBy("host", "template").agg(F.sum("good").alias("good"), F.sum("seen").alias("seen")))
    own = tree.groupBy("host", "merged").agg(F.sum("good").alias("good"), F.sum("seen").alias("seen"))
    # the same template over all hosts, and all URLs
    shapes = tree.groupBy("template").agg(F.sum("good").alias("shape_good"), F.sum("seen").alias("shape_seen"))
    total = tree.agg(F.sum("good").alias("total_good"), F.sum("seen").alias("total_seen"))
    overall = total.select(_share("total_good", "total_seen", F.lit(0.5)).alias("overall"))
    shapes = shapes.join(F.broadcast(overall)).withColumn("prior", _share("shape_good", "shape_seen", F.col("overall")))  # one row
    judged = (
        tree.select("host", "template", "merged").join(own, ["host", "merged"])
        .join(shapes.select("template", "prior"), ["template"])
        .select("host", F.col("template").alias("_template"), F.concat(F.lit("/"), F.array_join("merged", "/")).alias("template"),
                _share("good", "seen", F.col("prior")).alias("purity"))
    )
    named = named.select("host", "segments", F.col("template").alias("_template"))
    return named.join(judged, ["host", "_template"]).select("host", "segments", "template", "purity")


def judge_urls(pages: DataFrame, rules: list[tuple[str, bool]], url: str = "url") -> DataFrame:
    """Add ``host``, ``path``, ``rule``, ``template``, ``purity`` and ``verdict`` (allow or block) to ``pages``."""
    host, path = host_of(F.col(url)), path_of(F.col(url))
    rule, allows = rule_of(F.col("host"), F.col("path"), rules)
    new = ["host", "path", "rule", "template", "purity", "verdict"]
    kept = [F.col(f"`{c}`") for c in pages.columns if c.lower() not in new]
    parsed = pages.select(*kept, host.alias("host"), path.alias("path")).withColumn("_segments", segments_of(F.col("path")))
    paths = pin(
        pages.select(host.alias("host"), path.alias("path"))
        .select("host", segments_of(F.col("path")).alias("segments"), allows.alias("allows"))
        .groupBy("host", "segments")
        .agg(F.count("*").alias("n"), F.count_if("allows").alias("good"), F.count("allows").alias("seen"))
    )
    purity = pin(template_purity(paths).withColumnRenamed("host", "_host"))
    judged = parsed.join(purity, (F.col("host") == F.col("_host")) & (F.col("_segments") == F.col("segments")), "left")
    verdict = F.when(F.coalesce(allows, F.col("purity") >= 0.5, F.lit(True)), "allow").otherwise("block")
    return judged.select(*kept, "host", "path", rule.alias("rule"), "template", "purity", verdict.alias("verdict"))
