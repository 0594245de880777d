"""Roll-ups along a two-level subject taxonomy whose leaves are codes or code ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.scalar import sanitize_name
from corpusloom.operators.sampling import diverse_pick
from corpusloom.operators.pages import PAGE_SIZE, paged

# Labels of codes the taxonomy does not cover.
SUB_MISSING = "Unterkategorie nicht gefunden"
MAIN_MISSING = "Kategorie nicht gefunden"


def taxonomy_dimension(flat: DataFrame) -> DataFrame:
    """Equi-join form of a flattened taxonomy: one row per main class and each of its 100 decades.

    ``flat`` is (main, main_name, sub_key, lo, hi, sub_name). Ranges are unrolled to decades, so
    the lookup needs no range join. An exact key beats a range, then the smaller key wins.
    """
    mains = flat.where(F.length("main") == 1).groupBy("main").agg(F.min("main_name").alias("main_name"))
    grid = mains.select("*", F.explode(F.sequence(F.lit(0), F.lit(990), F.lit(10))).alias("decade"))
    first = (F.ceil(F.col("lo") / 10) * 10).cast("int")
    last = (F.floor(F.col("hi") / 10) * 10).cast("int")
    subs = (
        flat.where("lo IS NOT NULL AND hi IS NOT NULL")
        .where(first <= last)
        .select(
            "main",
            F.explode(F.sequence(first, last, F.lit(10))).alias("decade"),
            F.struct(
                F.contains("sub_key", F.lit("-")).alias("is_range"),
                F.concat_ws(" ", "sub_key", "sub_name").alias("label"),
            ).alias("_hit"),
        )
        .groupBy("main", "decade")
        .agg(F.min("_hit")["label"].alias("_label"))
    )
    missing = F.concat(F.lpad(F.col("decade").cast("string"), 3, "0"), F.lit(f" {SUB_MISSING}"))
    return grid.join(subs, ["main", "decade"], "left").select(
        "main", "decade", "main_name", F.coalesce("_label", missing).alias("sub_label")
    )


def taxonomy_lookup(df: DataFrame, code: str, dimension: DataFrame) -> DataFrame:
    """Add ``main``, ``main_name`` and ``sub_label`` for a code.

    The first three characters, left-padded with zeros and rounded down to the ten, pick the
    sub-category. A code that is no number or whose main class is unknown counts as not found.
    ``dimension`` comes from ``taxonomy_dimension``: 100 rows per one-character main class, which
    is what bounds the broadcast.
    """
    prefix = F.substring(F.col(code), 1, 3)
    decade = F.when(prefix.rlike("^[0-9]+$"), F.expr(f"try_cast(substring(`{code}`, 1, 3) AS INT) div 10 * 10"))
    dim = dimension.select(
        F.col("main").alias("_m"), F.col("decade").cast("bigint").alias("_d"), "main_name", "sub_label"
    )
    keyed = df.withColumn("_m", F.substring(F.col(code), 1, 1)).withColumn("_d", decade)
    joined = keyed.join(F.broadcast(dim), ["_m", "_d"], "left")
    return (
        joined.withColumn("main", F.when(F.col("main_name").isNull(), "0").otherwise(F.col("_m")))
        .withColumn("sub_label", F.coalesce("sub_label", F.lit(f"000 {SUB_MISSING}")))
        .withColumn("main_name", F.coalesce("main_name", F.lit(MAIN_MISSING)))
        .drop("_m", "_d")
    )


def leading_number(label: Column) -> Column:
    """Sort key of a label: its first word if that is a number, else 999 (ranges sort last)."""
    word = F.split_part(label, F.lit(" "), F.lit(1))
    return F.when(word.rlike("^[0-9]+$"), word).otherwise("999")


def taxonomy_counts(df: DataFrame, code: str, dimension: DataFrame) -> DataFrame:
    """Records per (main, main_name, sub_label); empty codes do not count.

    Records are counted per 3-character code first, so the lookup runs on distinct codes only.
    """
    per_code = (
        df.where(F.col(code).isNotNull() & (F.col(code) != ""))
        .groupBy(F.substring(F.col(code), 1, 3).alias("_code"))
        .agg(F.count("*").alias("_n"))
    )
    return (
        taxonomy_lookup(per_code, "_code", dimension)
        .groupBy("main", "main_name", "sub_label")
        .agg(F.sum("_n").alias("n"))
    )


def taxonomy_tree_count(df: DataFrame, code: str, dimension: DataFrame) -> DataFrame:
    """Counts per main class (``sub_label`` NULL) and sub-category, with the sort key of the listing."""
    counts = taxonomy_counts(df, code, dimension)
    return (
        counts.rollup("main", "main_name", "sub_label")
        .agg(F.sum("n").alias("n"), F.grouping("main_name").alias("_g"))
        .where("_g = 0")
        .select("main", "main_name", "sub_label", "n", leading_number(F.col("sub_label")).alias("sort_key"))
        .withColumn("sort_key", F.when(F.col("sub_label").isNull(), "").otherwise(F.col("sort_key")))
    )


def treemap_table(df: DataFrame, code: str, dimension: DataFrame) -> DataFrame:
    """Rows (name, parent, value) for main classes and sub-categories, and the grand total."""
    counts = taxonomy_counts(df, code, dimension)
    rolled = counts.rollup("main_name", "sub_label").agg(
        F.sum("n").alias("value"), F.grouping("main_name").alias("_gm"), F.grouping("sub_label").alias("_gs")
    )
    return rolled.select(
        F.when(F.col("_gm") == 1, "Total").when(F.col("_gs") == 1, F.col("main_name")).otherwise(F.col("sub_label")).alias("name"),
        F.when(F.col("_gm") == 1, None).when(F.col("_gs") == 1, "").otherwise(F.col("main_name")).alias("parent"),
        "value",
    )


def representative_codes(df: DataFrame, code: str, dimension: DataFrame, usable: Column) -> DataFrame:
    """Smallest code of each sub-category under whose prefix a usable record exists."""
    known = df.where(F.col(code).isNotNull() & (F.col(code) != ""))
    codes = known.select(F.substring(F.col(code), 1, 3).alias("_code")).distinct()
    prefixes = (
        known.where(usable)
        .select(F.substring(F.col(code), 1, 3).alias("_c3"))
        .distinct()
        .select(F.explode(F.transform(F.sequence(F.lit(1), F.length("_c3")), lambda k: F.substring(F.col("_c3"), F.lit(1), k))).alias("_code"))
        .distinct()
    )
    return (
        taxonomy_lookup(codes.join(prefixes, "_code", "left_semi"), "_code", dimension)
        .groupBy("main", "main_name", "sub_label")
        .agg(F.min("_code").alias("rep_code"))
    )


def diverse_documents(df: DataFrame, code: str, dimension: DataFrame, id_col: str, year: str, path: str,
                      cutoff: int, n: int = 5, seed: int = 42) -> DataFrame:
    """Per sub-category up to ``n`` recent and ``n`` older PDF records of its representative code.

    Recent means ``year >= cutoff``; the year must be a number. The table of representative codes
    has at most one row per dimension row, which bounds its broadcast.
    """
    year_no = F.when(F.col(year).rlike("^[0-9]+$"), F.col(year).try_cast("int"))
    usable = F.endswith(F.col(path), F.lit(".pdf")) & year_no.isNotNull()
    reps = representative_codes(df, code, dimension, usable)
    spelled = F.transform(
        F.sequence(F.lit(1), F.least(F.length(code), F.lit(3))), lambda k: F.substring(F.col(code), F.lit(1), k)
    )
    candidates = (
        df.where(usable & (F.col(code) != ""))
        .select(id_col, year, path, F.explode(spelled).alias("rep_code"))
        .join(F.broadcast(reps), "rep_code")
    )
    return diverse_pick(candidates, ["main", "main_name", "sub_label"], id_col, year_no >= cutoff, n, seed)


def copy_manifest(picked: DataFrame, year: str, path: str, root: str = "examples") -> DataFrame:
    """Add the folder names and the target path of each picked file."""
    main_word = F.regexp_extract("main_name", r"^\s*(\S+)", 1)
    main_folder = sanitize_name(F.concat_ws("_", "main", main_word))
    words = F.split(F.trim(F.regexp_replace("sub_label", r"\s+", " ")), " ")
    sub_folder = sanitize_name(F.concat_ws("_", words[0], F.array_join(F.slice(words, F.lit(2), F.size(words)), " ")))
    file_name = F.concat_ws("_", F.col(year), F.substring_index(F.col(path), "/", -1))
    return (
        picked.withColumn("main_folder", main_folder)
        .withColumn("sub_folder", sub_folder)
        .withColumn("target", F.concat_ws("/", F.lit(root), "main_folder", "sub_folder", file_name))
    )


def nested_json_export(flat: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """Flattened taxonomy -> one JSON object per main class and page in the column ``value``.

    Each line is ``{main: {"name": ..., "sub": {key: {"name": ...}}}}``; children are in key order over the pages of
    ``page_size``. A main class without children has an empty ``sub``. Of a repeated key the smallest name stays.
    ``taxonomy_scan`` reads it back.
    """
    folded = flat.groupBy("main", "sub_key").agg(F.min("main_name").alias("main_name"), F.min("sub_name").alias("sub_name"))
    child = F.struct(F.col("sub_key").alias("key"), F.struct(F.col("sub_name").alias("name")).alias("value"))
    sub = F.map_from_entries(F.sort_array(F.collect_list(F.when(F.col("sub_key").isNotNull(), child))))
    return (
        paged(folded, "main", [F.col("sub_key").asc_nulls_last()], page_size)
        .groupBy("main", "page")
        .agg(F.min("main_name").alias("name"), sub.alias("sub"))
        .where((F.col("page") == 0) | (F.size("sub") > 0))
        .select(F.to_json(F.create_map("main", F.struct("name", "sub"))).alias("value"))
    )
