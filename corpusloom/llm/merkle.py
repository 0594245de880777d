"""Merkle manifest of a table: a root over all rows, and per row a proof that needs no other row.

H is the lowercase hex SHA-256 of its inputs one after another, digests as hex text. The leaf of a row is H over its
columns, each as ``-`` if NULL, else as its number of UTF-8 bytes, ``:`` and the value. In a group the leaves
stand in order; while there are several nodes, every FAN consecutive ones (the last run may be shorter, even
one) become their H. What remains is the group's subroot; the subroots, ordered by group with NULL first, become the root
likewise.

Built as a rollup of nested structs. The place of a node among the nodes of its level, written in base FAN, gives one column per
digit. Within a block of FAN ** DIGITS consecutive nodes the digit columns are grouped away one after another, each
time nesting the children's structs into their parent, so that a block ends as one row that holds its whole subtree. The
blocks' own digests are the nodes of the next, FAN ** DIGITS times smaller table, until each group is one node. Then the
way back: a block row, next to the path above it, is opened digit by digit: a transform gives each child its siblings,
an explode emits it. A block and its path meet by grouping on the block (one row each), not by a join. No group or source
is ever in one task; a row holds at most one block.

Defined cases: a NULL in the order column comes first; equal places in the order go by leaf digest, and rows that repeat in
full are interchangeable leaves of their own; NULL and empty texts are told apart by the leaf; a group of one row has that leaf
as subroot; an empty table gives an empty table; further columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.session import pin

#: children of a node
FAN = 16
#: digit columns of a block: a block holds up to FAN ** DIGITS nodes
DIGITS = 3

_PATH = "array<struct<before: string, after: string>>"


def framed(value: Column) -> Column:
    """``-`` for NULL, else byte count, ``:`` and value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def leaf_digest(values: list[Column]) -> Column:
    return digest(F.concat(*[framed(v) for v in values]))


def fold(start: Column, path: Column) -> Column:
    """The root that the digest ``start`` leads to along ``path``."""
    return F.aggregate(path, start, lambda d, step: digest(F.concat(step["before"], d, step["after"])))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings of a path, level by level, from left to right."""
    return digest(F.array_join(F.transform(path, lambda step: F.concat(step["before"], step["after"])), ""))


def _levels(n: str) -> Column:
    """Times FAN nodes become one until ``n`` nodes are one."""
    powers = F.array(*[F.lit(FAN**k).cast("long") for k in range(1, 16)])
    return F.when(F.col(n) <= 1, 0).otherwise(F.size(F.filter(powers, lambda p: p < F.col(n))) + 1)


def _placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """Stored ``rows`` with a column ``g``, with ``place`` (0-based, within ``g``) and ``levels`` (of the tree of ``g``).

    Range partitions by (g, order), so a long group spans many tasks; the table of offsets has one row per
    group and partition.
    """
    laid = rows.repartitionByRange("g", *order).sortWithinPartitions("g", *order)
    laid = pin(laid.withColumn("_mid", F.monotonically_increasing_id())).withColumn("_pid", F.shiftright("_mid", 33))
    parts = laid.groupBy("g", "_pid").agg(F.count("*").alias("_n"), F.min("_mid").alias("_from"))
    group = Window.partitionBy("g")
    before = F.sum("_n").over(group.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.withColumn("_total", F.sum("_n").over(group)).select(
        "g", "_pid", (F.coalesce(before, F.lit(0)) - F.col("_from")).alias("_shift"), _levels("_total").alias("levels"))
    return laid.join(parts, ["g", "_pid"]).select(*rows.columns, (F.col("_mid") + F.col("_shift")).alias("place"), "levels")


def _rollup(nodes: DataFrame) -> DataFrame:
    """Nodes (g, place, levels, digest, other columns) -> their blocks (g, place, levels, digest, kids), one row each.

    ``kids`` nests DIGITS levels of structs (k, digest, kids); the innermost ``kids`` holds the other columns. A level above the
    group's root hands its only node on as it is.
    """
    others = [c for c in nodes.columns if c not in ("g", "place", "levels", "digest")]
    digits = [F.expr(f"CAST(place div {FAN**i} % {FAN} AS INT)").alias(f"d{i}") for i in range(DIGITS)]
    rows = nodes.select(
        "g", F.expr(f"place div {FAN**DIGITS}").alias("place"), "levels", "digest", F.struct(*others or [F.lit(0).alias("_")]).alias("kids"), *digits)
    rows = rows.repartition("g", "place")  # of this partitioning all groupings below are refinements
    for i in range(DIGITS):
        rest = [f"d{j}" for j in range(i + 1, DIGITS)]
        kids = F.sort_array(F.collect_list(F.struct(F.col(f"d{i}").alias("k"), "digest", "kids")))
        below = F.array_join(F.transform("kids", lambda kid: kid["digest"]), "")
        own = F.when(F.col("levels") > i, digest(below)).otherwise(F.element_at("kids", 1)["digest"])
        rows = rows.groupBy("g", "place", *rest).agg(F.max("levels").alias("levels"), kids.alias("kids")).withColumn("digest", own)
    return rows.select("g", "place", "levels", "digest", "kids")


def _with_path(i: int):
    """For digit ``i``: a child struct at its index among the digests ``near`` -> (k, kids, path)."""

    def child(kid: Column, at: Column) -> Column:
        before = F.array_join(F.slice("near", F.lit(1), at), "")
        after = F.array_join(F.slice("near", at + 2, F.lit(FAN)), "")
        step = F.array(F.struct(before.alias("before"), after.alias("after")))
        path = F.when(F.col("levels") > i, F.concat(step, F.col("path"))).otherwise(F.col("path"))
        return F.struct(kid["k"].alias("k"), kid["kids"].alias("kids"), path.alias("path"))

    return child


def _open(blocks: DataFrame, above: DataFrame) -> DataFrame:
    """Blocks, and (g, place, path, subroot) of what stands above them -> (g, place, path, subroot, other columns) of their nodes."""
    parts = {"levels": "int", "kids": blocks.schema["kids"].dataType.simpleString(), "path": _PATH, "subroot": "string"}

    def side(df: DataFrame) -> DataFrame:
        return df.select("g", "place", *[(F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in parts.items()])

    # one block and one path per key
    rows = side(blocks.drop("digest")).unionByName(side(above.drop("levels")))
    rows = rows.groupBy("g", "place").agg(*[F.first(c, ignorenulls=True).alias(c) for c in parts])
    for i in reversed(range(DIGITS)):
        near = rows.withColumn("near", F.transform("kids", lambda kid: kid["digest"]))
        opened = near.select("g", "levels", "subroot", F.col("place").alias("_above"), F.explode(F.transform("kids", _with_path(i))).alias("_kid"))
        rows = opened.select("g", "levels", "subroot", (F.col("_above") * FAN + F.col("_kid.k")).alias("place"), "_kid.kids", "_kid.path")
    return rows.select("g", "place", "path", "subroot", "kids.*")


def roll_up(nodes: DataFrame) -> list[DataFrame]:
    """The stored blocks of all rounds over ``nodes`` (g, place, levels, digest, other columns); the last has one row per ``g``."""
    rounds = []
    while True:
        blocks = pin(_rollup(nodes))
        rounds.append(blocks)
        if blocks.where("place > 0").isEmpty():
            return rounds
        nodes = blocks.select("g", "place", F.greatest(F.col("levels") - DIGITS, F.lit(0)).alias("levels"), "digest")


def open_up(rounds: list[DataFrame], tops: DataFrame) -> DataFrame:
    """The nodes of the first round with whole paths, below ``tops`` (g, path, subroot)."""
    found = tops.withColumn("place", F.lit(0).cast("long"))
    for blocks in reversed(rounds):
        found = _open(blocks, found.select("g", "place", "path", "subroot"))
    return found


def merkle_manifest(df: DataFrame, columns: list[str], group: str, order: str, other_leaf: Column | None = None) -> DataFrame:
    """Per row of ``df``: ``order``, ``group``, leaf, other_leaf, path, subroot and root; the leaf covers ``columns``.

    ``path`` has by level, from the leaf's run up to the root, the siblings' digests before and after. ``other_leaf`` is any
    digest of the row that is to be carried along, to be folded by the same path. Runs jobs while it is built; their
    results lie in the shared folder (``spark.checkpoint.dir``).
    """
    # NULL first, then by bytes: a sign in front tells NULL from the empty name
    key = F.when(F.col(group).isNull(), "").otherwise(F.concat(F.lit("="), F.col(group).cast("string")))
    leaves = pin(df.select(
        key.alias("g"), F.col(group).alias("name"), F.col(order).alias("id"), leaf_digest([F.col(c) for c in columns]).alias("digest"),
        (F.lit(None) if other_leaf is None else other_leaf).cast("string").alias("other_leaf"), F.monotonically_increasing_id().alias("tie")))
    placed = _placed(leaves, ["id", "digest", "tie"])
    rounds = roll_up(placed.select("g", "place", "levels", "digest", "name", "id", F.col("digest").alias("leaf"), "other_leaf"))

    subroots = pin(rounds[-1].select(F.lit("").alias("g"), F.col("g").alias("of"), "digest"))
    upper = roll_up(_placed(subroots, ["of"]).select("g", "place", "levels", "digest", "of", F.col("digest").alias("own")))
    root = upper[-1].select("digest").scalar()
    start = upper[-1].select("g", F.array().cast(_PATH).alias("path"), F.lit("").alias("subroot"))
    tops = pin(open_up(upper, start).select(F.col("of").alias("g"), "path", F.col("own").alias("subroot")))

    found = open_up(rounds, tops)
    return found.select(F.col("id").alias(order), F.col("name").alias(group), "leaf", "other_leaf", "path", "subroot", root.alias("root"))
