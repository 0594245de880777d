"""Stratified and plain reproducible samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.operators.quota import quota_waterfill
from corpusloom.operators.ranking import (
    bucket_histogram,
    digits_for,
    order_key,
    random_rank_in_stratum,
    take_lowest,
    with_order_key,
)
from corpusloom.operators.skew import BROADCAST_ROWS, bounded_join
from corpusloom.session import pin


def base_filter(df: DataFrame, pages: str = "num_pages", hits: str = "abstract_num", max_pages: int = 200) -> DataFrame:
    """Records of at most ``max_pages`` pages in which the term was looked for and found."""
    return df.where((F.col(pages) <= max_pages) & F.col(hits).isNotNull() & (F.col(hits) != 0))


def allotted(df: DataFrame, quota: DataFrame, stratum: str, rank: str = "row_num") -> DataFrame:
    """Keep rows ranked within the quota of their stratum; unknown and NULL strata are dropped."""
    limits = pin(quota.select(stratum, F.col("quota").alias("_quota")))
    return bounded_join(df, limits, stratum).where(F.col(rank) <= F.col("_quota")).select(*df.columns)


def quota_join(df: DataFrame, quota: DataFrame, stratum: str, id_col: str, seed: int = 42, rank: str = "row_num") -> DataFrame:
    """The random rows of each stratum up to its quota, with their rank.

    Equal to ``allotted`` on ranks of all rows, but the scan drops what lies above the bucket where a quota runs out, and
    only rows kept are shuffled and ranked: the lowest keys of a stratum have the same rank among themselves.
    """
    keyed = with_order_key(df, id_col, seed, digits_for(df))
    kept = take_lowest(keyed, pin(bucket_histogram(keyed, stratum)), quota, stratum, id_col)
    return random_rank_in_stratum(kept, stratum, id_col, seed, rank)


def balanced_quota(df: DataFrame, stratum: str, total: int, strata=None) -> DataFrame:
    """Counts per stratum (one pass) -> (stratum, n, quota)."""
    rows = df if strata is None else df.where(F.col(stratum).isin(*strata))
    return quota_waterfill(rows.groupBy(stratum).agg(F.count("*").alias("n")), stratum, "n", total)


def draw_balanced(df: DataFrame, stratum: str, id_col: str, total: int, seed: int = 42,
                  strata=None, digits: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Balanced random subset of ``total`` rows (fewer if ``df`` is smaller) -> (subset, quota).

    Two passes over ``df``: the first aggregates a small histogram (pinned) that yields both the
    counts for the quota and the point where each quota runs out, the second keeps the rows
    below that point. Cost of the shuffle: the rows kept, not the corpus. ``strata`` restricts
    the allotment to given strata, else every non-NULL stratum takes part.
    """
    rows = df if strata is None else df.where(F.col(stratum).isin(*strata))
    keyed = with_order_key(rows, id_col, seed, digits or digits_for(rows))
    hist = pin(bucket_histogram(keyed, stratum))
    counts = hist.groupBy(stratum).agg(F.sum("_n").alias("n"))
    quota = pin(quota_waterfill(counts, stratum, "n", total))
    return take_lowest(keyed, hist, quota, stratum, id_col), quota


def balanced_subset(df: DataFrame, stratum: str, id_col: str, total: int, seed: int = 42,
                    strata=None, digits: int | None = None) -> DataFrame:
    """The subset of ``draw_balanced``."""
    return draw_balanced(df, stratum, id_col, total, seed, strata, digits)[0]


def subset_extend(df: DataFrame, subset: DataFrame, stratum: str, id_col: str, extra: int,
                  seed: int = 42, strata=None) -> DataFrame:
    """``subset`` plus ``extra`` rows balanced over the rows of ``df`` not yet in it.

    Candidates are pinned as (id, stratum), so the wide table is read once, for the rows picked.
    There are at most ``extra`` of those, which decides whether they are broadcast.
    """
    present = subset.select(id_col).distinct()
    candidates = pin(df.select(id_col, stratum).join(present, id_col, "left_anti"))
    picked = balanced_subset(candidates, stratum, id_col, extra, seed, strata).select(id_col)
    if extra <= BROADCAST_ROWS:
        picked = F.broadcast(picked)
    return subset.unionByName(df.join(picked, id_col, "left_semi"), allowMissingColumns=True)


def subset_verify(subset: DataFrame, quota: DataFrame, stratum: str) -> DataFrame:
    """Actual against expected rows per stratum -> (stratum, actual, expected)."""
    actual = subset.groupBy(stratum).agg(F.count("*").alias("_actual"))
    return actual.join(quota.select(stratum, F.col("quota").alias("_expected")), stratum, "full").select(
        stratum,
        F.coalesce("_actual", F.lit(0)).alias("actual"),
        F.coalesce("_expected", F.lit(0)).alias("expected"),
    )


def random_sample_n(df: DataFrame, id_col: str, n: int, seed: int = 42) -> DataFrame:
    """``ORDER BY RANDOM() LIMIT n``, reproducible, for any ``n``.

    One pass aggregates the histogram of the order key, a second drops the buckets beyond the point where ``n`` runs
    out in the scan; only the rows left are shuffled, in buckets of bounded size.
    """
    keyed = with_order_key(df, id_col, seed, digits_for(df))
    hist = keyed.groupBy("_bucket").agg(F.count("*").alias("_n"))
    upto = hist.withColumn("_upto", F.sum("_n").over(Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)))
    short = F.col("_upto") < n
    cut = pin(upto.agg(
        F.coalesce(F.min(F.when(~short, F.col("_bucket"))), F.lit("g")).alias("_cut"),  # "g" is above every hex digit
        F.coalesce(F.sum(F.when(short, F.col("_n"))), F.lit(0)).alias("_sure")))
    last, sure = cut.select("_cut").scalar(), cut.select("_sure").scalar()
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy("_key", id_col))
    kept = keyed.where(F.col("_bucket") <= last).withColumn("_rn", rank)
    return kept.where((F.col("_bucket") < last) | (F.col("_rn") + sure <= n)).drop("_key", "_bucket", "_rn")


def top_k(df: DataFrame, by: str, id_col: str, k: int = 20) -> DataFrame:
    """The ``k`` rows of highest ``by``; ties by ascending id."""
    return df.orderBy(F.col(by).desc(), F.col(id_col)).limit(k)


def top_n_per_group(df: DataFrame, groups, order, n: int) -> DataFrame:
    """At most ``n`` rows per group. ``n`` is a literal, so every task cuts its own groups to
    ``n`` rows before the shuffle and a hot group costs ``n`` rows per task."""
    rank = F.row_number().over(Window.partitionBy(*groups).orderBy(*order))
    return df.withColumn("_rn", rank).where(F.col("_rn") <= n).drop("_rn")


def diverse_pick(df: DataFrame, group, id_col: str, recent: Column, n: int = 5, seed: int = 42) -> DataFrame:
    """Up to ``n`` random recent and ``n`` random older rows per group, in one pass."""
    groups = [group] if isinstance(group, str) else list(group)
    flagged = df.withColumn("is_recent", recent).withColumn("_key", order_key(id_col, seed))
    return top_n_per_group(flagged, [*groups, "is_recent"], ["_key", id_col], n).drop("_key")


__all__ = [
    "allotted",
    "balanced_quota",
    "balanced_subset",
    "draw_balanced",
    "base_filter",
    "diverse_pick",
    "quota_join",
    "random_rank_in_stratum",
    "random_sample_n",
    "subset_extend",
    "subset_verify",
    "top_k",
    "top_n_per_group",
]
