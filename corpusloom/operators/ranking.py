"""Exact ranks and positions without a single-task window over raw rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.operators.skew import bounded_join
from corpusloom.session import pin


#: rows of one hash bucket that a window task ranks, whatever the size of the table
BUCKET_ROWS = 100_000


def digits_for(df: DataFrame) -> int:
    """Hex digits of the order key that keep a bucket near BUCKET_ROWS even if all rows are of one stratum (counts ``df``)."""
    rows, digits = df.count(), 2
    while rows > BUCKET_ROWS * 16**digits:
        digits += 1
    return digits


def order_key(id_col: str, seed: int = 42) -> Column:
    """Reproducible stand-in for ``RANDOM()``: md5 of ``id:seed``, uniform over 32 hex digits."""
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f":{seed}")).cast("binary"))


def with_order_key(df: DataFrame, id_col: str, seed: int, digits: int) -> DataFrame:
    """Add ``_key`` and ``_bucket``, its leading ``digits`` hex digits (same order as the key)."""
    return df.withColumn("_key", order_key(id_col, seed)).withColumn("_bucket", F.substring("_key", 1, digits))


def bucket_histogram(keyed: DataFrame, stratum: str) -> DataFrame:
    """Rows per (stratum, bucket): combines map-side to strata x 16^digits rows per task."""
    return keyed.groupBy(stratum, "_bucket").agg(F.count("*").alias("_n"))


def random_rank_in_stratum(df: DataFrame, stratum: str, id_col: str, seed: int = 42,
                           name: str = "row_num", digits: int | None = None) -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY stratum ORDER BY md5(id:seed), id)`` for every row.

    A stratum is ranked in 16^digits independent hash buckets, as many as its rows need; the rank of a row is its rank in
    the bucket plus the rows of the lower buckets. So a stratum with a third of the corpus
    still spreads over the cluster. A NULL stratum is ranked as a stratum of its own.
    """
    keyed = (
        with_order_key(df, id_col, seed, digits or digits_for(df))
        .withColumn("_null", F.col(stratum).isNull())
        .withColumn("_s", F.coalesce(F.col(stratum).cast("string"), F.lit("")))
    )
    group = ["_null", "_s", "_bucket"]
    hist = keyed.groupBy(*group).agg(F.count("*").alias("_n"))
    below = Window.partitionBy("_null", "_s").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = hist.select(*group, F.coalesce(F.sum("_n").over(below), F.lit(0)).alias("_before"))
    in_bucket = F.row_number().over(Window.partitionBy(*group).orderBy("_key", id_col))
    return (
        keyed.withColumn("_rn", in_bucket)
        .join(offsets, group)
        .select(*df.columns, (F.col("_before") + F.col("_rn")).cast("bigint").alias(name))
    )


def take_lowest(keyed: DataFrame, hist: DataFrame, quota: DataFrame, stratum: str, id_col: str,
                quota_col: str = "quota") -> DataFrame:
    """The ``quota`` rows of lowest order key in each stratum.

    ``hist`` tells for each stratum the bucket in which its quota runs out: lower buckets are
    kept whole, higher ones are filtered in the scan, and only the rows kept are shuffled to rank
    the cut bucket. Strata that ``quota`` does not name (NULL too) are dropped.
    """
    upto = F.sum("_n").over(
        Window.partitionBy(stratum).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    )
    cuts = (
        hist.join(quota.select(stratum, F.col(quota_col).alias("_q")).where("_q > 0"), stratum)
        .withColumn("_upto", upto)
        .groupBy(stratum)
        .agg(
            F.min(F.when(F.col("_upto") >= F.col("_q"), F.col("_bucket"))).alias("_cut"),
            F.max("_q").alias("_q"),
            F.sum(F.when(F.col("_upto") < F.col("_q"), F.col("_n")).otherwise(0)).alias("_sure"),
        )
        .withColumn("_take", F.col("_q") - F.col("_sure"))
        .select(stratum, "_cut", "_take")
    )
    kept = bounded_join(keyed, pin(cuts), stratum).where(F.col("_cut").isNull() | (F.col("_bucket") <= F.col("_cut")))
    rank = F.row_number().over(Window.partitionBy(stratum, "_bucket").orderBy("_key", id_col))
    whole = F.col("_cut").isNull() | (F.col("_bucket") < F.col("_cut"))
    return (
        kept.withColumn("_rn", rank)
        .where(whole | (F.col("_rn") <= F.col("_take")))
        .select(*[c for c in keyed.columns if c not in ("_key", "_bucket")])
    )


def _ranged(df: DataFrame, order) -> DataFrame:
    """Range-partitioned, sorted and pinned, with ``_pid`` and the 0-based ``_idx`` in the partition."""
    laid_out = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    return (
        pin(laid_out)
        .withColumn("_pid", F.shiftright("_mid", 33).cast("int"))
        .withColumn("_idx", F.col("_mid").bitwiseAND((1 << 33) - 1))
        .drop("_mid")
    )


def global_position(df: DataFrame, order, name: str = "pos") -> DataFrame:
    """Dense 1-based position of each row in the order ``order``, which must tell all rows apart.

    One range shuffle; the layout is pinned because positions are only valid for the layout
    they were counted on. The offsets table has one row per range partition.
    """
    ranged = _ranged(df, order)
    sizes = ranged.groupBy("_pid").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("_pid", F.coalesce(before, F.lit(0)).alias("_off"))
    return (
        ranged.join(F.broadcast(offsets), "_pid")
        .select(*df.columns, (F.col("_off") + F.col("_idx") + 1).alias(name))
    )


def group_position(df: DataFrame, group: str, order, name: str = "pos") -> DataFrame:
    """Dense 0-based position of each row within ``group``; ``order`` tells its rows apart.

    Rows are range-partitioned by (group, order), so a long group spans many tasks. Only the first group of a partition can have
    started in an earlier one, so the table of offsets has at most one row per partition.
    """
    ranged = _ranged(df, [F.col(group), *order])
    sizes = ranged.groupBy(group, "_pid").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select(group, "_pid", before.alias("_off")).where(F.col("_off") > 0).drop("_n")
    local = F.row_number().over(Window.partitionBy(group, "_pid").orderBy("_idx")) - 1
    return (
        ranged.withColumn("_rn", local)
        .join(F.broadcast(offsets), [group, "_pid"], "left")
        .select(*df.columns, (F.col("_rn") + F.coalesce(F.col("_off"), F.lit(0))).cast("bigint").alias(name))
    )
