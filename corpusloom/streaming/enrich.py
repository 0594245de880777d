"""Incremental enrichment: process what is new, once, into a table that is kept compacted by key (``sources.keyed``)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.session import pin, spread
from corpusloom.sources.keyed import BUCKETS, change_buckets, keyed_table


def latest_by_key(df: DataFrame, key: str, version: str) -> DataFrame:
    """The row of highest ``version`` for each key; of several, the largest in column order."""
    rest = [c for c in df.columns if c not in (key, version)]
    return df.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(version, *rest)).alias("_row")).select(key, "_row.*")


def merge_batch(rows: DataFrame, out: str, batch: int, key: str, buckets: int = BUCKETS) -> None:
    """Bring the rows of batch ``batch`` into the state below ``out``; a row replaces earlier ones of its key.

    Of several rows of a key in one batch the largest in column order stays. A batch that is merged again replaces its own
    earlier attempt.
    """
    fresh = pin(latest_by_key(rows.withColumn("_v", F.lit(1)), key, "_v").select(rows.columns))

    def merge(old: DataFrame) -> DataFrame:
        return latest_by_key(old.withColumn("_v", F.lit(0)).unionByName(fresh.withColumn("_v", F.lit(1))), key, "_v")

    change_buckets(fresh, out, batch, key, rows.schema, merge, buckets)


def run_incremental(spark: SparkSession, source: str, out: str, checkpoint: str, schema: T.StructType,
                    enrich: Callable[[DataFrame], DataFrame], key: str, glob: str = "*.parquet",
                    max_files: int = 1000, buckets: int = BUCKETS) -> None:
    """Enrich the Parquet files that arrived in ``source`` since the last run, merge them into the state below ``out``, then stop.

    A batch replayed after a failure replaces its earlier attempt. ``buckets`` must stay the same over all runs.
    """
    stream = (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", glob)
        .option("maxFilesPerTrigger", max_files)
        .parquet(source)
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        merge_batch(enrich(spread(batch, key)), out, batch_id, key, buckets)

    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def incremental_enrich(spark: SparkSession, source: str, out: str, checkpoint: str, schema: T.StructType,
                       enrich: Callable[[DataFrame], DataFrame], key: str, glob: str = "*.parquet",
                       max_files: int = 1000, buckets: int = BUCKETS) -> DataFrame:
    """``run_incremental``, then the latest result of every key processed so far, read as it is stored."""
    run_incremental(spark, source, out, checkpoint, schema, enrich, key, glob, max_files, buckets)
    return keyed_table(spark, out, enrich(spark.createDataFrame([], schema)).schema)
