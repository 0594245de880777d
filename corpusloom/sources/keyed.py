"""A stored table with one row per key, in hash buckets of the key, of which a change rewrites only those it touches.

``state/version=V/bucket=B`` holds the rows of bucket B as change V left them, and ``pointer/batch=N`` lists, after change N, the
version of every bucket. A change reads only the buckets that its keys fall into, writes these anew and then its
pointer; so rows elsewhere are neither read nor written, and until the pointer is there readers see the state before. One
writer at a time. Versions that no pointer in use names may be deleted at any time.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.operators.maintenance import update_by_key
from corpusloom.session import pin

#: hash buckets of a table; a change rewrites whole buckets, so choose more for larger tables and keep the number
BUCKETS = 64


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def bucket_versions(spark: SparkSession, path: str, before: int | None = None) -> dict[int, int]:
    """The version of every bucket after the last change (the last one below ``before``); empty if there is none."""
    try:
        pointers = spark.read.schema("bucket INT, version LONG, batch LONG").parquet(f"{path}/pointer")
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":  # nothing has been committed yet
            raise
        return {}
    if before is not None:
        pointers = pointers.where(F.col("batch") < before)
    last = pointers.agg(F.max("batch")).first()[0]
    return {} if last is None else {r.bucket: r.version for r in pointers.where(F.col("batch") == last).collect()}  # one row per bucket


def read_buckets(spark: SparkSession, path: str, schema: T.StructType, found: dict[int, int]) -> DataFrame:
    """The rows of the buckets in ``found`` (bucket -> version)."""
    paths = [f"{path}/state/version={v}/bucket={b}" for b, v in found.items()]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def keyed_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table as the last change left it."""
    return read_buckets(spark, path, schema, bucket_versions(spark, path))


def change_buckets(keys: DataFrame, path: str, version: int, key: str, schema: T.StructType,
                   change: Callable[[DataFrame], DataFrame], buckets: int = BUCKETS) -> None:
    """Replace the buckets that ``keys`` fall into by ``change`` of their rows, as change number ``version``.

    The same number again replaces its own earlier attempt.
    """
    spark = keys.sparkSession
    found = bucket_versions(spark, path, before=version)
    touched = [r.b for r in keys.select(bucket_of(key, buckets).alias("b")).distinct().collect()]  # at most ``buckets``
    old = read_buckets(spark, path, schema, {b: found[b] for b in touched if b in found})
    changed = change(old).select(*schema.fieldNames()).withColumn("bucket", bucket_of(key, buckets))
    changed.repartition(max(1, len(touched)), "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/state/version={version}")
    pointer = found | dict.fromkeys(touched, version)
    spark.createDataFrame(list(pointer.items()), "bucket INT, version LONG").coalesce(1).write.mode("overwrite").parquet(f"{path}/pointer/batch={version}")


def store_keyed(df: DataFrame, path: str, key: str, buckets: int = BUCKETS) -> DataFrame:
    """Store ``df`` (one row per key) as the first version of a table and read it back."""
    change_buckets(df.select(key), path, 0, key, df.schema, lambda _: df, buckets)
    return keyed_table(df.sparkSession, path, df.schema)


def update_stored(updates: DataFrame, path: str, version: int, key: str, cols, schema: T.StructType, buckets: int = BUCKETS) -> DataFrame:
    """``update_by_key`` on a stored table as change ``version``: copy on write of the buckets that can hold an updated key."""
    updates = pin(updates.select(key, *cols))
    change_buckets(updates, path, version, key, schema, lambda old: update_by_key(old, updates, key, cols), buckets)
    return keyed_table(updates.sparkSession, path, schema)
