"""Connected components of a large edge table by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.session import pin


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) for every vertex with an edge; the component is the smallest vertex reachable.

    Each round maps a vertex to its smallest neighbour or itself and replaces edges by the edges of the
    images; at least half of the vertices that still have edges vanish per round, as only local minima
    remain. Rounds are written to the shared folder, which also cuts the lineage. Nothing is collected.
    """
    one = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b")
    both = pin(one.union(one.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    rounds = []
    while not both.isEmpty():
        parent = pin(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("id"), F.least("a", "m").alias("parent")))
        rounds.append(parent)
        first = both.join(parent.select(F.col("id").alias("a"), F.col("parent").alias("pa")), "a").select("pa", "b")
        second = first.distinct().join(parent.select(F.col("id").alias("b"), F.col("parent").alias("pb")), "b")
        both = pin(second.where("pa <> pb").select(F.col("pa").alias("a"), F.col("pb").alias("b")).distinct())
    if not rounds:
        return one.select(F.col("a").alias("id"), F.col("a").alias("component"))
    found = rounds[-1].withColumnRenamed("parent", "component")
    for parent in reversed(rounds[:-1]):
        upper = found.select(F.col("id").alias("parent"), F.col("component").alias("c"))
        found = pin(parent.join(upper, "parent", "left").select("id", F.coalesce("c", "parent").alias("component")))
    return found
