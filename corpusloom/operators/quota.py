"""Balanced quotas over strata."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.ranking import global_position
from corpusloom.session import pin

#: levels tried in one pass of the search
PROBES = 64


def water_level(counts: DataFrame, n_col: str, total: int) -> tuple[int, int]:
    """(level, rest): the highest level at which strata cut down to it hold at most ``total`` rows, and what is left of ``total``.

    Each pass adds up the strata cut at PROBES levels at once and narrows the range to one step between them.
    """
    n = F.greatest(F.col(n_col), F.lit(0))
    low, high = 0, counts.agg(F.max(n)).first()[0] or 0
    held = 0
    while low < high:
        step = max(1, (high - low) // PROBES)
        levels = sorted({high, *range(low + step, high, step)})
        sums = counts.agg(*[F.sum(F.least(n, F.lit(level))) for level in levels]).first()
        fits = [(level, s) for level, s in zip(levels, sums) if s <= total]
        if fits:
            low, held = fits[-1]
        high = next((level - 1 for level, s in zip(levels, sums) if s > total), low)
    return low, total - held


def quota_waterfill(counts: DataFrame, stratum: str, n_col: str, total: int) -> DataFrame:
    """Share ``total`` rows as evenly as the strata allow -> (stratum, n, quota).

    Equal to handing out equal rounds until ``total`` or every stratum is used up: small strata
    are taken whole, the others get the level ``L`` and the first ``r`` of them, in ascending
    stratum order, one more. The NULL stratum takes no part.

    The level is searched for by sums over all strata, and the last stratum that gets one more is found by its position; no
    task sees all strata. Runs jobs while it is built.
    """
    base = pin(counts.where(F.col(stratum).isNotNull()).select(stratum, F.col(n_col).cast("bigint").alias("n")))
    level, rest = water_level(base, "n", max(total, 0))
    quota = F.least(F.greatest(F.col("n"), F.lit(0)), F.lit(level))
    taller = base.where(F.col("n") > level)
    if rest and not taller.isEmpty():
        last = global_position(taller.select(stratum), [F.col(stratum)], "pos").where(F.col("pos") == rest).select(stratum)
        quota = quota + F.when((F.col("n") > level) & (F.col(stratum) <= pin(last).scalar()), 1).otherwise(0)
    return base.select(stratum, "n", quota.cast("bigint").alias("quota"))
