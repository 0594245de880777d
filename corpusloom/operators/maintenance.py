"""Table maintenance: each operator returns the next version of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.operators.ranking import global_position
from corpusloom.operators.skew import KEY_ROWS, deal



def _one_per_key(df: DataFrame, key: str) -> DataFrame:
    """The smallest row of each key (deterministic, combines map-side)."""
    rest = [c for c in df.columns if c != key]
    if not rest:
        return df.distinct()
    return df.groupBy(key).agg(F.min(F.struct(*rest)).alias("_row")).select(key, "_row.*")


def insert_if_absent(target: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """``target`` plus the new rows whose key it lacks; repeated and NULL keys in ``new`` go in once or never."""
    fresh = _one_per_key(new.where(F.col(key).isNotNull()), key)
    return target.unionByName(fresh.join(target.select(key).distinct(), key, "left_anti"))


def update_by_key(df: DataFrame, updates: DataFrame, key: str, cols) -> DataFrame:
    """Set ``cols`` on the rows whose key is in ``updates``, also to NULL; other rows stay as they are."""
    latest = _one_per_key(updates.select(key, *cols), key).select(
        key, F.struct(*cols).alias("_new"), F.lit(True).alias("_hit")
    )
    out = df.join(latest, key, "left")
    for c in cols:
        value = F.col("_new")[c]
        if c in df.columns:
            value = F.when(F.col("_hit"), value).otherwise(F.col(c)).cast(df.schema[c].dataType)
        out = out.withColumn(c, value)
    return out.select(*df.columns, *[c for c in cols if c not in df.columns])


def reset_columns(df: DataFrame, cols) -> DataFrame:
    """Set ``cols`` to NULL, keeping their types."""
    return df.withColumns({c: F.lit(None).cast(df.schema[c].dataType) for c in cols})


def reset_check(df: DataFrame, columns) -> DataFrame:
    """Per column the rows that still hold a value, and all rows, in one pass."""
    counts = df.agg(F.count("*").alias("_all"), *[F.count(c).alias(f"_{i}") for i, c in enumerate(columns)])
    lines = [F.struct(F.lit(c).alias("column_name"), F.col(f"_{i}").alias("still_set"), F.col("_all").alias("n_rows")) for i, c in enumerate(columns)]
    return counts.select(F.inline(F.array(*lines)))


def add_column(df: DataFrame, name: str, dtype: str) -> DataFrame:
    """Add a NULL column unless there is one of that name."""
    return df if name in df.columns else df.withColumn(name, F.lit(None).cast(dtype))


def reject_split(df: DataFrame, types: dict[str, str], key: str, key_rows: int = KEY_ROWS) -> tuple[DataFrame, DataFrame]:
    """Load-time checks in one pass -> (valid, rejected).

    Reasons, first match: a column that does not cast to its type, a NULL key, a repeated key.
    Of a repeated key the smallest row is kept. ``rejected`` has one row per different bad row
    with ``reason`` and ``copies``, so valid rows plus copies add up to the input.

    Rows are dealt to tasks by key, as many tasks as they need. If a key may have more than ``key_rows`` rows, copies are
    folded before any shuffle instead; no join is needed, hence no key can be hot. Counts rows while it is built.
    """
    cols = list(types)
    bad = None
    for c, t in types.items():
        test = F.col(c).isNotNull() & F.col(c).try_cast(t).isNull()
        bad = F.when(test, f"type:{c}") if bad is None else bad.when(test, f"type:{c}")
    reason = bad.when(F.col(key).isNull(), "null key")
    judged = df.select(*cols).withColumn("reason", reason)
    typed = judged.where("reason IS NULL").select(*[F.col(c).try_cast(t).alias(c) for c, t in types.items()])
    dealt = deal(typed, key, key_rows)
    if dealt is not None:
        smallest = Window.partitionBy(key).orderBy(*[c for c in cols if c != key] or [key])
        ranked = dealt.groupBy(*cols).agg(F.count("*").alias("copies")).withColumn("_rank", F.row_number().over(smallest))
        valid = ranked.where("_rank = 1").select(*cols)
        surplus = ranked.withColumn("copies", F.when(F.col("_rank") == 1, F.col("copies") - 1).otherwise(F.col("copies")))
    else:
        folded = typed.groupBy(*cols).agg(F.count("*").alias("copies"))
        valid = _one_per_key(folded.select(*cols), key).select(*cols)
        less = valid.withColumn("copies", F.lit(-1).cast("bigint"))
        surplus = folded.unionByName(less).groupBy(*cols).agg(F.sum("copies").alias("copies"))

    text = [F.col(c).cast("string").alias(c) for c in cols]
    surplus = surplus.where("copies > 0").select(*text, F.lit("duplicate key").alias("reason"), "copies")
    broken = judged.where("reason IS NOT NULL").groupBy(*cols, "reason").agg(F.count("*").alias("copies")).select(*text, "reason", "copies")
    return valid, broken.unionByName(surplus)


def find_entry(df: DataFrame, name: str, kind: str) -> DataFrame:
    """Record of a file: converted text (``mmd``) is found by its converted name, others by path."""
    return df.where(F.col("converted_file" if kind == "mmd" else "path") == f"{name}.{kind}")


def load_if_empty(target: DataFrame, rows: DataFrame) -> DataFrame:
    """``rows`` if the target holds none yet, else the target unchanged (looks at one row)."""
    return rows if target.isEmpty() else target


def surrogate_key(df: DataFrame, key: str, name: str = "id") -> DataFrame:
    """Dense ids 1..n in key order for a table of unique keys."""
    return global_position(df, [F.col(key)], name)
