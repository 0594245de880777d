"""Counts, rates, distributions and report tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.scalar import (
    TOKEN_BOUNDS,
    TOKEN_LABELS,
    YEAR_BOUNDS,
    YEAR_LABELS,
    half_open_bucket,
    ordinal,
    percent,
    rounded_ratio,
)
from corpusloom.operators.skew import bounded_join



def with_share(df: DataFrame, n_col: str = "n", name: str = "pct", digits: int = 2) -> DataFrame:
    """Percentage of each aggregated row in their total.

    The total is a scalar subquery over the aggregate (its shuffle is reused), so no window
    without partitions gathers the rows in one task.
    """
    whole = df.agg(F.sum(n_col)).scalar()
    return df.withColumn(name, percent(F.col(n_col), whole, digits))


def count_by_stratum(df: DataFrame, stratum: str, domain=None) -> DataFrame:
    """Rows per stratum in one pass -> (stratum, n).

    With ``domain`` exactly its strata are reported, absent ones with 0; without it every stratum
    that occurs, NULL included.
    """
    if domain is None:
        return df.groupBy(stratum).agg(F.count("*").alias("n"))
    counts = df.where(F.col(stratum).isin(*domain)).groupBy(stratum).agg(F.count("*").alias("_n"))
    listed = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(d) for d in domain])).alias(stratum))
    return listed.join(counts, stratum, "left").select(stratum, F.coalesce("_n", F.lit(0)).alias("n"))


def conditional_rate(df: DataFrame, stratum: str, flag: str, digits: int = 2) -> DataFrame:
    """Per non-NULL stratum: rows, rows with ``flag`` other than 0, and their percentage."""
    return (
        df.where(F.col(stratum).isNotNull())
        .groupBy(stratum)
        .agg(F.count("*").alias("total_count"), F.count_if(F.col(flag) != 0).alias("hit_count"))
        .withColumn("pct", percent(F.col("hit_count"), F.col("total_count"), digits))
    )


def overall_rate(df: DataFrame, flag: str, digits: int = 2) -> DataFrame:
    """Processed rows, those with a hit, and their percentage (0 if none is processed)."""
    return df.agg(
        F.count_if(F.col(flag) != 0).alias("hit_count"), F.count(flag).alias("processed_count")
    ).withColumn("pct", F.coalesce(percent(F.col("hit_count"), F.col("processed_count"), digits), F.lit(0.0)))


def class_sum_rate(df: DataFrame, stratum: str, classes, flag: str, digits: int = 2) -> DataFrame:
    """Rows and hits over the given strata together."""
    return (
        df.where(F.col(stratum).isin(*[str(c) for c in classes]))
        .agg(F.count("*").alias("total_count"), F.count_if(F.col(flag) != 0).alias("hit_count"))
        .withColumn("pct", percent(F.col("hit_count"), F.col("total_count"), digits))
    )


def with_page_limit(df: DataFrame, pages: str, limit: int | None = None) -> DataFrame:
    """``pages <= limit`` if a limit is given, else all rows."""
    return df if limit is None else df.where(F.col(pages) <= limit)


def non_null_profile(df: DataFrame, cols) -> DataFrame:
    """Total rows and non-NULL values per column, in one scan."""
    return df.agg(F.count("*").alias("total_records"), *[F.count(c).alias(f"non_null_{c}") for c in cols])


def sum_positive(df: DataFrame, col: str) -> DataFrame:
    """Rows with a positive value, and their sum."""
    return df.where(F.col(col) > 0).agg(
        F.count("*").alias("total_records"), F.sum(F.col(col).cast("bigint")).alias("total_pages")
    )


def token_stats(df: DataFrame, tokens: str, name_col: str, suffix: str = ".mmd") -> DataFrame:
    """Count, average, extremes of the token counts, and files with ``suffix``."""
    return (
        df.where(F.col(tokens).isNotNull())
        .agg(
            F.count("*").alias("total_files"),
            F.sum(F.col(tokens).cast("bigint")).alias("_sum"),
            F.min(tokens).alias("min_tokens"),
            F.max(tokens).alias("max_tokens"),
            F.count_if(F.endswith(F.col(name_col), F.lit(suffix))).alias("suffix_files"),
        )
        .withColumn("avg_tokens", rounded_ratio(F.col("_sum"), F.col("total_files"), 0))
        .drop("_sum")
    )


def with_total(rows: DataFrame, key: str, n_col: str, label: str = "Total", **fixed: Column) -> DataFrame:
    """Append a total row; ``fixed`` gives its other columns."""
    total = rows.agg(F.sum(n_col).alias(n_col)).select(F.lit(label).alias(key), n_col, *[c.alias(k) for k, c in fixed.items()])
    return rows.unionByName(total)


def bucket_distribution(df: DataFrame, col: str, bounds=TOKEN_BOUNDS, labels=TOKEN_LABELS) -> DataFrame:
    """Rows and percentage per bucket, a Total row, and ``ord`` for the display order."""
    counts = (
        df.where(F.col(col).isNotNull())
        .groupBy(half_open_bucket(F.col(col), bounds, labels).alias("bucket"))
        .agg(F.count("*").alias("n"))
    )
    table = with_total(with_share(counts, digits=1), "bucket", "n", pct=F.lit(100.0))
    return table.withColumn("ord", F.coalesce(ordinal(F.col("bucket"), labels), F.lit(len(labels) + 1)))


def label_lookup(df: DataFrame, code: str, names: DataFrame, default: str = "Unknown", name: str = "name") -> DataFrame:
    """Name of each code from a unique-keyed (code, name) table, ``default`` if unknown.

    A few codes cover all rows, so a shuffle by code would be lopsided: ``names`` is counted and
    broadcast, or salted if it is large. It should be a stored table, as counting reads it.
    """
    dim = names.select(F.col("code").alias(code), F.col("name").alias("_name"))
    joined = bounded_join(df, dim, code, "left")
    return joined.withColumn(name, F.coalesce("_name", F.lit(default))).drop("_name")


def stratum_share_table(df: DataFrame, stratum: str, names: DataFrame) -> DataFrame:
    """Per stratum: name, rows and percentage, plus a Total row; the NULL stratum is left out."""
    counts = count_by_stratum(df.where(F.col(stratum).isNotNull()), stratum)
    named = label_lookup(with_share(counts, digits=1), stratum, names)
    return with_total(named, stratum, "n", name=F.lit(""), pct=F.lit(100.0))


def stratum_year_count(df: DataFrame, stratum: str, year: str) -> DataFrame:
    """Rows per (stratum, year), years that are digits only."""
    return (
        df.where(F.col(year).rlike("^[0-9]+$"))
        .groupBy(stratum, F.col(year).try_cast("int").alias(year))
        .agg(F.count("*").alias("n"))
    )


def stratum_bin_crosstab(df: DataFrame, stratum: str, year: str, names: DataFrame,
                         bounds=YEAR_BOUNDS, labels=YEAR_LABELS) -> DataFrame:
    """Strata against year bins, 0 for empty cells, with a Total row; only digit strata count."""
    counts = (
        stratum_year_count(df, stratum, year)
        .withColumn("_bin", half_open_bucket(F.col(year), bounds, labels))
        .where(F.col("_bin").isNotNull() & F.col(stratum).rlike("^[0-9]"))
    )
    cells = [F.coalesce(F.sum(F.when(F.col("_bin") == b, F.col("n"))), F.lit(0)).alias(b) for b in labels]
    table = counts.groupBy(stratum).agg(*cells)
    named = label_lookup(table, stratum, names)
    total = table.agg(*[F.sum(F.col(f"`{b}`")).alias(b) for b in labels]).select(
        F.lit("Total").alias(stratum), F.lit("").alias("name"), *[F.col(f"`{b}`") for b in labels]
    )
    return named.unionByName(total)


def availability_rate(df: DataFrame, col: str) -> DataFrame:
    """Rows, rows with a value in ``col``, percentage."""
    return df.agg(F.count("*").alias("total_records"), F.count(col).alias("available")).withColumn(
        "pct", percent(F.col("available"), F.col("total_records"))
    )


def over_limit_share(df: DataFrame, tokens: str, limit: int) -> DataFrame:
    """Rows above ``limit`` tokens, all rows, percentage (NULL for no rows)."""
    return df.agg(
        F.count_if(F.col(tokens) > limit).alias("n_over"), F.count("*").alias("n_docs")
    ).withColumn("pct", percent(F.col("n_over"), F.col("n_docs")))


def over_limit_list(df: DataFrame, id_col: str, tokens: str, limit: int) -> DataFrame:
    """The documents above ``limit`` tokens with their counts."""
    return df.where(F.col(tokens) > limit).select(id_col, tokens)


def term_hit_rate(sections: DataFrame, terms, min_chars: int) -> DataFrame:
    """Files per first-matching term and overall, with the sections shorter than ``min_chars``.

    ``sections`` has ``term`` and ``section``. One row per term (0 if it never matched) plus
    the row ``any term``.
    """
    hit = lambda t: F.col("term") == t
    short = F.length("section") < min_chars
    aggs = [F.count("*").alias("_all"), F.count("term").alias("_n_any"),
            F.count_if(F.col("term").isNotNull() & short).alias("_s_any")]
    for k, term in enumerate(terms):
        aggs += [F.count_if(hit(term)).alias(f"_n{k}"), F.count_if(hit(term) & short).alias(f"_s{k}")]
    rows = [F.struct(F.lit(t).alias("term"), F.col(f"_n{k}").alias("n"), F.col(f"_s{k}").alias("n_short"))
            for k, t in enumerate(terms)]
    rows.append(F.struct(F.lit("any term").alias("term"), F.col("_n_any").alias("n"), F.col("_s_any").alias("n_short")))
    return (
        sections.agg(*aggs)
        .select("_all", F.inline(F.array(*rows)))
        .select("term", "n", "n_short", F.coalesce(percent(F.col("n"), F.col("_all")), F.lit(0.0)).alias("pct"))
    )


def custom_order(df: DataFrame, label: str, labels) -> DataFrame:
    """Sort by the position of ``label`` in ``labels``; others last."""
    rank = F.coalesce(ordinal(F.col(label), labels), F.lit(len(labels) + 1)).alias("ord")
    return df.select("*", rank).orderBy("ord", label)
