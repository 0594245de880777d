"""Writers: appends, replacements, verified snapshots."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def batch_insert(df: DataFrame, path: str) -> None:
    """Append records; every task writes its own rows, so there is no batch size."""
    df.write.mode("append").parquet(path)


def idempotent_replace(df: DataFrame, path: str, partition_by: str | None = None) -> DataFrame:
    """Replace the table at ``path`` and read it back (``replaced_table`` reads it later).

    The new content is written to a folder of its own; one row in ``committed`` then makes it the table. Until that
    row is there, also after a failure, readers get the old content, and the new content may be computed from it. One writer
    at a time. Folders of earlier contents may be deleted once nobody reads them.
    """
    spark = df.sparkSession
    content = uuid.uuid4().hex
    writer = df.write.mode("errorifexists")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(f"{path}/content/{content}")
    last = _committed(spark, path)
    row = [((last[0] if last else 0) + 1, content)]
    spark.createDataFrame(row, _COMMITTED).coalesce(1).write.mode("append").parquet(f"{path}/committed")
    return replaced_table(spark, path, df.schema)


_COMMITTED = "number LONG, content STRING"


def _committed(spark: SparkSession, path: str) -> tuple[int, str] | None:
    """(number, folder) of the last content; None before the first."""
    try:
        rows = spark.read.schema(_COMMITTED).parquet(f"{path}/committed")
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    last = rows.agg(F.max(F.struct("number", "content")).alias("last")).first().last
    return None if last is None else (last.number, last.content)


def replaced_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The content that ``idempotent_replace`` committed last."""
    last = _committed(spark, path)
    if last is None:
        raise ValueError(f"nothing has been committed to {path}")
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{path}/content/{last[1]}")


def schema_report(df: DataFrame) -> DataFrame:
    """Columns in order with their types and non-NULL counts, in one scan."""
    names = df.columns
    entries = [
        F.struct(
            F.lit(i).alias("ordinal"), F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"), F.col(f"_c{i}").alias("non_null"),
        )
        for i, f in enumerate(df.schema.fields, start=1)
    ]
    return df.agg(*[F.count(F.col(c)).alias(f"_c{i}") for i, c in enumerate(names, start=1)]).select(F.inline(F.array(*entries)))


def fingerprint(df: DataFrame, stratum: str) -> DataFrame:
    """Row count and order-free content hash per stratum; rows are hashed where they are read."""
    cols = sorted(df.columns)
    row = F.xxhash64(*cols, *[F.col(c).isNull() for c in cols])
    return df.groupBy(stratum).agg(
        F.count("*").alias("n"), F.bit_xor(row).alias("h_xor"), F.sum(row.cast("decimal(20,0)")).alias("h_sum")
    )


def compare_tables(source: DataFrame, copy: DataFrame, stratum: str) -> DataFrame:
    """(stratum, n_source, n_copy, same) of two tables, compared by content."""
    left = fingerprint(source, stratum).withColumn("_s", F.coalesce(F.col(stratum).cast("string"), F.lit(""))).withColumn("_z", F.col(stratum).isNull())
    right = fingerprint(copy, stratum).select(
        F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("_s"), F.col(stratum).isNull().alias("_z"),
        F.col(stratum).alias("_st"), F.col("n").alias("n2"), F.col("h_xor").alias("x2"), F.col("h_sum").alias("s2"),
    )
    same = (F.col("n").eqNullSafe(F.col("n2"))) & F.col("h_xor").eqNullSafe(F.col("x2")) & F.col("h_sum").eqNullSafe(F.col("s2"))
    return left.join(right, ["_s", "_z"], "full").select(
        F.coalesce(stratum, "_st").alias(stratum),
        F.coalesce("n", F.lit(0)).alias("n_source"),
        F.coalesce("n2", F.lit(0)).alias("n_copy"),
        same.alias("same"),
    )


def copy_table(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` to the new folder ``path`` and read it from there."""
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def snapshot_verify(df: DataFrame, path: str, stratum: str) -> DataFrame:
    """Write a copy to the new folder ``path`` and compare it with the source per stratum.

    An existing folder is never overwritten: the last good copy stays until another one is known to be equal.
    """
    return compare_tables(df, copy_table(df, path), stratum)


def snapshot_publish(df: DataFrame, root: str, version: int, stratum: str) -> bool:
    """Snapshot ``df`` as the new ``version``; it becomes current only if the copy equals the source."""
    report = snapshot_verify(df, f"{root}/data/version={version}", stratum)
    if not report.where("NOT same").isEmpty():
        return False
    df.sparkSession.range(1).select(F.lit(version).alias("version")).write.mode("append").parquet(f"{root}/published")
    return True


def snapshot_current(spark: SparkSession, root: str) -> DataFrame:
    """The latest published snapshot."""
    version = spark.read.schema("version INT").parquet(f"{root}/published").agg(F.max("version")).first()[0]
    return spark.read.parquet(f"{root}/data/version={version}")


def export_lines(df: DataFrame, path: str, col: str = "value") -> None:
    """Write a string column as UTF-8 text, one row per line."""
    df.select(col).write.mode("overwrite").text(path)
