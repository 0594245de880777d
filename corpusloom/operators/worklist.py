"""Worklists over "result still NULL" state, and reports on the progress of a run."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.scalar import micros, percent, rounded_ratio
from corpusloom.operators.ranking import global_position
from corpusloom.session import pin


def blacklist_anti(df: DataFrame, failed: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not on the failure list (repeats on the list are folded first)."""
    return df.join(failed.select(key).distinct(), key, "left_anti")


def anti_join_not_in(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """``key NOT IN (ids)`` with SQL's NULL rules: empty as soon as ``ids`` holds a NULL, and a NULL
    key only qualifies against an empty list.

    Written as an ordinary anti join plus two one-row facts about ``ids``: the built-in
    null-aware join must broadcast the whole list.
    """
    facts = ids.agg(F.count("*").alias("n"), F.count_if(F.col(key).isNull()).alias("nulls"))
    total, nulls = facts.select("n").scalar(), facts.select("nulls").scalar()
    listed = ids.select(key).where(F.col(key).isNotNull()).distinct()
    return df.join(listed, key, "left_anti").where((total == 0) | ((nulls == 0) & F.col(key).isNotNull()))


def worklist(df: DataFrame, source: str, result: str, failed: DataFrame, key: str) -> DataFrame:
    """Rows that have a source, no result yet, and no entry on the failure list.

    Recomputed from the table state, so nothing is skipped while results come in.
    """
    return blacklist_anti(df.where(F.col(source).isNotNull() & F.col(result).isNull()), failed, key)


def _ordered(order) -> list[tuple[str, bool]]:
    """(column, descending) of names such as ``a`` and ``-b``."""
    return [(c.removeprefix("-"), c.startswith("-")) for c in order]


def _positions(df: DataFrame, order) -> DataFrame:
    """The order columns alone with the 1-based position ``pos``; only these are shuffled and stored."""
    columns = _ordered(order)
    return global_position(df.select(*[c for c, _ in columns]), [F.col(c).desc() if down else F.col(c).asc() for c, down in columns], "pos")


def _not_after(first: Column, columns: list[tuple[str, bool]]) -> Column:
    """True if the struct ``first`` does not come after the row: NULL first in rising, last in falling order."""
    out = F.lit(True)
    for name, down in reversed(columns):
        a, b = first[name], F.col(name)
        nulls = a.isNotNull() & b.isNull() if down else a.isNull() & b.isNotNull()
        out = F.coalesce(a > b if down else a < b, F.lit(False)) | nulls | (a.eqNullSafe(b) & out)
    return out


def work_batches(df: DataFrame, order, size: int, name: str = "batch_id") -> DataFrame:
    """Number the rows in ``order`` and cut them into batches of ``size`` (0-based).

    ``order`` names columns, ``-`` in front for falling order; together they tell all rows apart. Only they are sorted; the rows
    get their batch by a join on them.
    """
    columns = [c for c, _ in _ordered(order)]
    numbers = _positions(df, order).select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(columns)], F.floor((F.col("pos") - 1) / size).alias(name))
    same = [df[c].eqNullSafe(numbers[f"_k{i}"]) for i, c in enumerate(columns)]
    return df.join(numbers, reduce(and_, same)).select(*df.columns, name)


def work_chunks(df: DataFrame, order, n_chunks: int, max_rows: int | None = None) -> DataFrame:
    """Split the rows into ``n_chunks`` contiguous chunks whose sizes differ by at most one, larger ones first
    -> input plus ``chunk``. ``max_rows`` is the budget of this run: rows beyond it have a NULL chunk and wait for the next.

    ``order`` as in ``work_batches``. The order columns alone are sorted to find the first row of every chunk (at most
    ``n_chunks`` + 1 rows); all rows are then compared with these, without a shuffle or a join. Runs jobs while it is built.
    """
    columns = _ordered(order)
    placed = _positions(df, order)
    rows = placed.count()
    work = rows if max_rows is None else min(rows, max_rows)
    sizes = [work // n_chunks + (i < work % n_chunks) for i in range(n_chunks)]
    starts = [sum(sizes[:i]) + 1 for i in range(n_chunks) if sizes[i]] + ([work + 1] if work < rows else [])
    wanted = placed.where(F.col("pos").isin(starts)).select(F.struct(*[c for c, _ in columns]).alias("first"))
    firsts = pin(wanted.agg(F.collect_list("first").alias("firsts"))).select("firsts").scalar()
    passed = F.size(F.filter("_firsts", lambda first: _not_after(first, columns)))
    chunk = F.when(passed <= sum(s > 0 for s in sizes), (passed - 1).cast("long"))
    return df.withColumn("_firsts", firsts).withColumn("chunk", chunk).drop("_firsts")


def progress_report(log: DataFrame, source: Column, done: Column, ts: str) -> DataFrame:
    """Totals, percentage, speed and remaining time of a run, from one pass over its log.

    ``source`` and ``done`` are conditions on log rows; ``ts`` is when a row was finished. The time
    elapsed is that from the first to the last finished row.
    """
    us = micros(log, ts)
    finished = source & done
    return (
        log.agg(
            F.count_if(source).alias("total"),
            F.count_if(finished).alias("done"),
            ((F.max(F.when(finished, us)) - F.min(F.when(finished, us))) / 1_000_000).cast("bigint").alias("elapsed_sec"),
        )
        .withColumn("left", F.col("total") - F.col("done"))
        .withColumn("pct", percent(F.col("done"), F.col("total")))
        .withColumn("per_hour", rounded_ratio(F.col("done"), F.col("elapsed_sec"), 1, scale=3600))
        .withColumn("eta_sec", F.expr("left * elapsed_sec div nullif(done, 0)"))
    )


def stall_gaps(log: DataFrame, key: str, ts: str, gap_seconds: int) -> DataFrame:
    """Pauses of more than ``gap_seconds`` between consecutive entries of a key
    -> (key, gap_start_us, gap_end_us, gap_sec).

    Entries within one time slot of ``gap_seconds`` cannot be that far apart, so it is enough to
    compare the last entry of a slot with the first one of the next used slot. Slots aggregate
    map-side, and a key's window holds its slots, not its entries.
    """
    slot_us = gap_seconds * 1_000_000
    slots = (
        log.where(F.col(ts).isNotNull())
        .select(key, micros(log, ts).alias("_us"))
        .groupBy(key, F.floor(F.col("_us") / slot_us).alias("_slot"))
        .agg(F.min("_us").alias("gap_end_us"), F.max("_us").alias("_last"))
    )
    previous = F.lag("_last").over(Window.partitionBy(key).orderBy("_slot"))
    return (
        slots.withColumn("gap_start_us", previous)
        .where(F.col("gap_end_us") - F.col("gap_start_us") > slot_us)
        .select(
            key,
            "gap_start_us",
            "gap_end_us",
            F.expr("(gap_end_us - gap_start_us) div 1000000").alias("gap_sec"),
        )
    )


def failure_list(known: DataFrame, failed: DataFrame, key: str) -> DataFrame:
    """Failure list with newly failed ids added, each once."""
    return known.select(key).unionByName(failed.select(key)).distinct()
