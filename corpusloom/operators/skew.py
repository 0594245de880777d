"""Joins and groupings that stay even when one key holds a large share of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.session import pin

#: rows of one key that a single task may comfortably hold
ROWS_PER_TASK = 1_000_000
#: rows of a task that holds them in several sorts or hash tables at once
TASK_ROWS = 150_000
#: rows of one key that such a task may hold
KEY_ROWS = 100_000
#: keys are counted in this many bins
BINS = 1 << 16
#: narrow rows that may be broadcast
BROADCAST_ROWS = 200_000


def deal(df: DataFrame, keys, key_rows: int = KEY_ROWS) -> DataFrame | None:
    """``df`` hashed by ``keys`` to as many tasks as its rows need, so that a task holds the same at any size; None if a key
    may have more than ``key_rows`` rows.

    Groupings and windows by ``keys`` and further columns then need no other shuffle. Keys are counted in bins, which few
    counts suffice for: an upper bound. An action; it reads only ``keys``.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    bins = df.groupBy(F.pmod(F.xxhash64(*keys), F.lit(BINS)).alias("_bin")).agg(F.count("*").alias("_n"))
    rows, most = bins.agg(F.coalesce(F.sum("_n"), F.lit(0)), F.coalesce(F.max("_n"), F.lit(0))).first()
    if most > key_rows:
        return None
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // TASK_ROWS)), *keys)


def bounded_join(left: DataFrame, small: DataFrame, on, how: str = "inner",
                 max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``small`` once its row count is known to be at most ``max_rows``; salt otherwise.

    Counting is an action, so ``small`` should be narrow and cheap (pinned or aggregated).
    """
    if small.limit(max_rows + 1).count() <= max_rows:
        return left.join(F.broadcast(small), on, how)
    return salted_join(left, small, on, how)


def salted_join(left: DataFrame, right: DataFrame, on, how: str = "inner", salts: int = 64) -> DataFrame:
    """Equi join with every key split over ``salts`` tasks; ``right`` is repeated per salt.

    The salt is a hash of the left row, so exact copies of a row should be folded before.
    ``how`` must keep left rows only: inner, left, left_semi or left_anti.
    """
    keys = [on] if isinstance(on, str) else list(on)
    lhs = left.withColumn("_salt", F.pmod(F.xxhash64(*left.columns), F.lit(salts)).cast("int"))
    rhs = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return lhs.join(rhs, [*keys, "_salt"], how).drop("_salt")


def hot_groups(df: DataFrame, keys, floor: int = ROWS_PER_TASK) -> DataFrame | None:
    """Keys with more than ``floor`` rows and their counts, pinned (at most rows/floor of them);
    None if there are none.

    ``df`` should be a stored table. Its rows are counted first, which reads no columns: a table
    of up to ``floor`` rows needs no grouping.
    """
    if df.count() <= floor:
        return None
    hot = pin(df.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > floor))
    return None if hot.isEmpty() else hot


def spread_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner",
                floor: int = ROWS_PER_TASK, counted_on: DataFrame | None = None) -> DataFrame:
    """Join distinct ``left`` rows to the unique-keyed ``right``, splitting only the hot keys.

    Without hot keys this is an ordinary join (Spark broadcasts ``right`` if its measured size
    allows). A hot key gets one salt per ``floor`` rows on both sides. Keys are counted on ``left``
    or on ``counted_on``, a cheaper table with at least as many rows of each key.
    """
    hot = hot_groups(left if counted_on is None else counted_on, [key], floor)
    if hot is None:
        return left.join(right, key, how)
    salts = hot.select(key, (F.floor(F.col("_n") / floor) + 1).cast("int").alias("_salts"))
    one = F.coalesce(F.col("_salts"), F.lit(1))
    lhs = (
        bounded_join(left, salts, key, "left")
        .withColumn("_salt", F.pmod(F.xxhash64(*left.columns), one).cast("int"))
        .drop("_salts")
    )
    rhs = (
        bounded_join(right, salts, key, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), one - 1)))
        .drop("_salts")
    )
    return lhs.join(rhs, [key, "_salt"], how).drop("_salt")


def prefix_extreme(df: DataFrame, keys, pos: str, value, name: str, fn: str = "max",
                   inclusive: bool = True, reverse: bool = False, block: int | None = None) -> DataFrame:
    """Running ``min``/``max`` of ``value`` along ``pos`` within ``keys``; NULLs are ignored.

    ``block=None`` is for groups known to be short: one window per group. Otherwise groups are
    cut into blocks of ``block`` positions. Each block runs its own window; one summary row per
    block carries the extreme of the blocks before it (after it with ``reverse``). The input is
    pinned then, as window and summary both read it.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    agg = F.max if fn == "max" else F.min
    pick = F.greatest if fn == "max" else F.least
    inner_pos = -F.col(pos) if reverse else F.col(pos)
    end = 0 if inclusive else -1
    if block is None:
        whole = Window.partitionBy(*keys).orderBy(inner_pos).rowsBetween(Window.unboundedPreceding, end)
        return df.withColumn(name, agg(value).over(whole))
    blocked = pin(df.withColumn("_blk", F.floor(F.col(pos) / block)).withColumn("_v", value))
    inner = Window.partitionBy(*keys, "_blk").orderBy(inner_pos)
    frame = inner.rowsBetween(Window.unboundedPreceding, end)
    local = blocked.withColumn("_local", agg("_v").over(frame))

    summary = blocked.groupBy(*keys, "_blk").agg(agg("_v").alias("_bv"))
    outer = Window.partitionBy(*keys).orderBy(-F.col("_blk") if reverse else F.col("_blk"))
    carry = (
        summary.withColumn("_carry", agg("_bv").over(outer.rowsBetween(Window.unboundedPreceding, -1)))
        .where(F.col("_carry").isNotNull())
        .drop("_bv")
    )
    return (
        local.join(carry, [*keys, "_blk"], "left")
        .select(*df.columns, pick("_local", "_carry").alias(name))
    )
