"""The paths taken for hot keys give the same results as plain joins, windows and groupings."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusloom.operators import linkage, skew
from corpusloom.operators.pages import paged
from corpusloom.session import pin, spread


@pytest.fixture(scope="module")
def sides(spark):
    """A third of the left rows share key 1; some keys are missing on the right."""
    left = spark.range(3000).selectExpr("id", "IF(id % 3 = 0, 1, id % 40) AS k").cache()
    right = spark.range(35).selectExpr("id AS k", "concat('v', id) AS v").cache()
    return left, right


def same(a, b):
    cols = sorted(b.columns)
    return a.select(cols).exceptAll(b.select(cols)).isEmpty() and b.select(cols).exceptAll(a.select(cols)).isEmpty()


@pytest.mark.parametrize("how", ["inner", "left"])
def test_spread_join_with_hot_keys(sides, how):
    left, right = sides
    got = skew.spread_join(left, right, "k", how, floor=100)
    assert same(got, left.join(right, "k", how))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join(sides, how):
    left, right = sides
    assert same(skew.salted_join(left, right, "k", how, 5), left.join(right, "k", how))


def test_bounded_join_falls_back_beyond_its_bound(sides):
    left, right = sides
    small, large = skew.bounded_join(left, right, "k"), skew.bounded_join(left, right, "k", max_rows=10)
    assert "_salt" not in small._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in large._jdf.queryExecution().optimizedPlan().toString()
    assert same(small, large)


def test_spread_leaves_well_split_tables_alone(spark):
    few, many = spark.range(100).repartition(2), spark.range(100).repartition(64)
    assert spread(few, "id").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert spread(many, "id") is many


def test_pinned_tables_lie_in_one_folder_per_application(spark):
    files = pin(spark.range(5)).inputFiles()
    assert files and all(f"corpusloom-{spark.sparkContext.applicationId}/pinned-" in f for f in files)


def test_pages_follow_the_order_and_are_full(sides):
    left, _ = sides
    pages = {}
    for r in paged(left, "k", [F.col("id").desc()], size=50).collect():
        pages.setdefault(r.k, {}).setdefault(r.page, []).append(r.id)
    want = {}
    for r in left.collect():
        want.setdefault(r.k, []).append(r.id)
    for k, ids in want.items():
        ids.sort(reverse=True)
        assert [sorted(pages[k][p], reverse=True) for p in sorted(pages[k])] == [ids[i:i + 50] for i in range(0, len(ids), 50)]


@pytest.mark.parametrize("fn", ["min", "max"])
@pytest.mark.parametrize("inclusive", [True, False])
@pytest.mark.parametrize("reverse", [True, False])
def test_prefix_extreme_in_blocks(spark, fn, inclusive, reverse):
    df = spark.range(400).selectExpr("id % 3 AS g", "id div 3 AS p", "IF(id % 11 = 0, NULL, (id * 7919) % 101) AS v")
    args = dict(fn=fn, inclusive=inclusive, reverse=reverse)
    blocked = skew.prefix_extreme(df, "g", "p", F.col("v"), "x", block=10, **args)
    w = Window.partitionBy("g").orderBy(F.col("p").desc() if reverse else F.col("p"))
    w = w.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    want = df.withColumn("x", (F.min if fn == "min" else F.max)("v").over(w))
    assert same(blocked, want)
    assert same(skew.prefix_extreme(df, "g", "p", F.col("v"), "x", **args), want)


def test_link_join_with_hot_document_and_hot_entity(spark, monkeypatch):
    links = spark.range(900).selectExpr("CAST(IF(id % 2 = 0, 1, id % 60) AS STRING) AS doc_idn", "CAST(IF(id % 3 = 0, 2, id % 70) AS STRING) AS gnd_idn")
    records = spark.range(50).selectExpr("id AS id", "CAST(id AS STRING) AS doc_idn")
    entities = spark.range(60).selectExpr("id + 1000 AS id", "CAST(id AS STRING) AS gnd_idn", "concat('L', id % 5) AS gnd_label")
    plain = linkage.link_join(links, records, entities)
    monkeypatch.setattr(skew.spread_join, "__defaults__", ("inner", 20, None))
    split = linkage.link_join(links, records, entities)
    assert same(split, plain) and split.count() == split.distinct().count() > 0


def test_keyword_pages_hold_all_labels(spark):
    mappings = spark.range(300).selectExpr("IF(id < 200, 1, 2 + id % 9) AS record_id", "id AS gnd_id")
    entities = spark.range(300).selectExpr("id", "CAST(id AS STRING) AS gnd_idn", "lpad(CAST(id AS STRING), 3, '0') AS gnd_label")
    records = spark.range(20).selectExpr("id", "CAST(id AS STRING) AS doc_idn")
    got = linkage.keyword_agg(mappings, entities, records, page_size=50).collect()
    hot = [r for r in got if r.doc_idn == "1"]
    assert len(hot) > 1 and sum(r.keyword_count for r in hot) == 200
    assert [w for r in sorted(hot, key=lambda r: r.page) for w in r.gnd_keywords.split(" | ")] == [f"{i:03d}" for i in range(200)]
    assert all(r.gnd_keywords.split(" | ") == sorted(r.gnd_keywords.split(" | ")) for r in got)
