"""Authority links between documents and entities (many-to-many)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.scalar import percent, rounded_ratio
from corpusloom.operators.maintenance import surrogate_key
from corpusloom.operators.pages import PAGE_SIZE, paged
from corpusloom.operators.skew import deal, spread_join
from corpusloom.operators.stats import with_share



def distinct_links(links: DataFrame) -> DataFrame:
    """Links without exact duplicates (copies combine before the shuffle)."""
    return links.distinct()


def link_counts(links: DataFrame) -> DataFrame:
    """Documents, (entity, label) pairs and distinct links, in one row."""
    per = links.distinct().agg(
        F.count_distinct("doc_idn").alias("n_docs"),
        F.count_distinct("gnd_idn", "gnd_label").alias("n_entities"),
        F.count("*").alias("n_mappings"),
    )
    return per


def entity_dedup(links: DataFrame, key: str = "gnd_idn", label: str = "gnd_label") -> DataFrame:
    """One label per entity: the smallest, as files have no stable order in Spark."""
    return links.groupBy(key).agg(F.min(label).alias(label))


def duplicate_report(links: DataFrame, keys) -> DataFrame:
    """Superfluous rows: exact copies, and repeats of ``keys`` (all but the first of each).

    Rows are dealt to tasks by ``keys``, as many tasks as they need, unless one may be too frequent. Counts rows while it is built.
    """
    dealt = deal(links, keys)
    exact = (links if dealt is None else dealt).groupBy(*links.columns).agg(F.count("*").alias("_n"))
    by_key = exact.groupBy(*keys).agg(F.sum("_n").alias("_n"), F.sum(F.col("_n") - 1).alias("_copies"))
    return by_key.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("exact_duplicates"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("key_duplicates"),
    )


def semi_join_ids(records: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Records whose key is listed; repeated ids are folded before the join."""
    return records.join(ids.select(key).distinct(), key, "left_semi")


def link_join(links: DataFrame, records: DataFrame, entities: DataFrame) -> DataFrame:
    """Distinct (record_id, gnd_id) pairs of the links whose both ends exist.

    ``records(id, doc_idn)`` and ``entities(id, gnd_idn)`` are unique by their natural key, so
    folding duplicate pairs before the joins is enough, and it shrinks hot documents. A hot
    document or entity is split over several tasks.
    """
    keys = links.select("doc_idn", "gnd_idn")
    doc_side = records.select("doc_idn", F.col("id").alias("record_id"))
    entity_side = entities.select("gnd_idn", F.col("id").alias("gnd_id"))
    with_record = spread_join(keys.distinct(), doc_side, "doc_idn", counted_on=keys)
    with_both = spread_join(with_record, entity_side, "gnd_idn", counted_on=keys)
    return with_both.select("record_id", "gnd_id")


def link_star(links: DataFrame, records: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Linked records, entities with dense ids, and mappings, from raw links.

    ``records`` is unique by ``doc_idn`` and by ``id``.
    """
    entities = surrogate_key(entity_dedup(links), "gnd_idn")
    linked = semi_join_ids(records, links, "doc_idn")
    return linked, entities, link_join(links, linked, entities)


def link_coverage(records: DataFrame, links: DataFrame, key: str) -> DataFrame:
    """Records, records with a link, percentage; all links and links per linked document.

    Duplicate links count in the average.
    """
    ids = records.select(key).distinct().withColumn("_rec", F.lit(1))
    per_doc = links.groupBy(key).agg(F.count("*").alias("_n"))
    return (
        ids.join(per_doc, key, "full")
        .agg(
            F.count("_rec").alias("total_records"),
            F.count_if(F.col("_rec").isNotNull() & F.col("_n").isNotNull()).alias("linked_records"),
            F.sum("_n").alias("total_links"),
            F.count("_n").alias("_docs"),
        )
        .select(
            "total_records",
            "linked_records",
            percent(F.col("linked_records"), F.col("total_records")).alias("pct"),
            "total_links",
            rounded_ratio(F.col("total_links"), F.col("_docs"), 2).alias("avg_links"),
        )
    )


def link_summary(records: DataFrame, entities: DataFrame, mappings: DataFrame) -> DataFrame:
    """One row: records, entities, mappings, average and maximum mappings per record."""
    per_record = mappings.groupBy("record_id").agg(F.count("*").alias("_n"))
    return per_record.agg(
        F.sum("_n").alias("total_mappings"), F.count("*").alias("_recs"), F.max("_n").alias("max_mappings")
    ).select(
        records.agg(F.count("*")).scalar().alias("total_records"),
        entities.agg(F.count("*")).scalar().alias("total_entities"),
        "total_mappings",
        rounded_ratio(F.col("total_mappings"), F.col("_recs"), 2).alias("avg_mappings"),
        "max_mappings",
    )


def degrees(links: DataFrame, doc: str) -> DataFrame:
    """Links per document."""
    return links.groupBy(doc).agg(F.count("*").alias("keyword_count"))


def degree_shares(links: DataFrame, doc: str) -> DataFrame:
    """Documents per number of links, with percentage."""
    spread = degrees(links, doc).groupBy("keyword_count").agg(F.count("*").alias("document_count"))
    return with_share(spread, "document_count", "percentage")


def degree_distribution(links: DataFrame, doc: str, n: int = 5) -> DataFrame:
    """``degree_shares`` for the ``n`` smallest link counts."""
    return degree_shares(links, doc).orderBy("keyword_count").limit(n)


def degree_min_max(links: DataFrame, doc: str) -> DataFrame:
    """Fewest, most and average links per document, duplicates included."""
    return (
        degrees(links, doc)
        .agg(
            F.min("keyword_count").alias("min_links"),
            F.max("keyword_count").alias("max_links"),
            F.sum("keyword_count").alias("_sum"),
            F.count("*").alias("_docs"),
        )
        .select("min_links", "max_links", rounded_ratio(F.col("_sum"), F.col("_docs"), 2).alias("avg_links"))
    )


def top_labels(mappings: DataFrame, entities: DataFrame, n: int = 10) -> DataFrame:
    """Most used labels with their share in all mappings.

    Mappings are counted per entity before the label joins on, so hot entities cost one row.
    """
    usage = mappings.groupBy("gnd_id").agg(F.count("*").alias("_n"))
    labels = entities.select(F.col("id").alias("gnd_id"), "gnd_label")
    by_label = usage.join(labels, "gnd_id").groupBy("gnd_label").agg(F.sum("_n").alias("usage_count"))
    return with_share(by_label, "usage_count", "percentage").orderBy(F.col("usage_count").desc(), "gnd_label").limit(n)


def keyword_agg(mappings: DataFrame, entities: DataFrame, records: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """Labels of each record, sorted and joined with ``" | "``, and their number.

    Labels are in order over the pages of ``page_size``; the lists of a record's pages one after another are its whole list.
    """
    labels = entities.select(F.col("id").alias("gnd_id"), "gnd_label")
    labelled = spread_join(mappings, labels, "gnd_id")
    lists = (
        paged(labelled, "record_id", ["gnd_label", "gnd_id"], page_size)
        .groupBy("record_id", "page")
        .agg(
            F.array_join(F.sort_array(F.collect_list("gnd_label")), " | ").alias("gnd_keywords"),
            F.count("*").alias("keyword_count"),
        )
    )
    return records.select(F.col("id").alias("record_id"), "doc_idn").join(lists, "record_id").select(
        "doc_idn", "page", "gnd_keywords", "keyword_count"
    )


def links_by_doc(links: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """Each document's links as a sorted array of (gnd_idn, gnd_label, copies).

    Copies of a link are folded into their number (``copies``) before the shuffle. The links are in order over the
    pages of ``page_size`` different links.
    """
    folded = links.groupBy("doc_idn", "gnd_idn", "gnd_label").agg(F.count("*").alias("copies"))
    entry = F.struct("gnd_idn", "gnd_label", "copies")
    return (
        paged(folded, "doc_idn", ["gnd_idn", "gnd_label"], page_size)
        .groupBy("doc_idn", "page")
        .agg(F.sort_array(F.collect_list(entry)).alias("links"), F.sum("copies").alias("n_links"))
    )
