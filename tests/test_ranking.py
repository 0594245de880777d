"""Quotas, ranks, samples and positions against plain single-machine versions."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import ranking, sampling
from corpusloom.operators.quota import quota_waterfill


def rotate(counts, total):
    """Hand out rows round by round (plain restatement of the rule)."""
    given = dict.fromkeys(counts, 0)
    while total > 0:
        room = [s for s in sorted(counts) if given[s] < counts[s]]
        if not room:
            break
        step = max(1, total // len(room))
        for s in room:
            take = min(step, counts[s] - given[s], total)
            given[s] += take
            total -= take
    return given


def key(i, seed=42):
    return hashlib.md5(f"{i}:{seed}".encode()).hexdigest()


CASES = [
    ({"a": 5, "b": 5, "c": 5}, 7), ({"a": 0, "b": 3}, 2), ({"a": 2, "b": 9, "c": 100}, 50), ({"a": 1}, 10), ({"a": 4, "b": 4}, 0),
    ({"b": 1, "a": 1, "c": 1}, 2), ({"a": 1000, "b": 1, "c": 1}, 999),
]


def test_quota_fixed_and_random_cases(spark):
    rng = random.Random(7)
    cases = CASES + [
        ({f"s{k}": rng.choice([0, 1, 2, 5, 30, 400]) for k in range(rng.randint(1, 9))}, rng.randint(0, 700)) for _ in range(8)
    ]
    for counts, total in cases:
        df = spark.createDataFrame(list(counts.items()), "s string, c int")
        got = {r.s: r.quota for r in quota_waterfill(df, "s", "c", total).collect()}
        assert got == rotate(counts, total), (counts, total)


def test_quota_ignores_null_stratum_and_empty_input(spark):
    df = spark.createDataFrame([(None, 50), ("a", 3)], "s string, c int")
    assert [(r.s, r.quota) for r in quota_waterfill(df, "s", "c", 10).collect()] == [("a", 3)]
    assert quota_waterfill(df.where("false"), "s", "c", 10).count() == 0


@pytest.fixture(scope="module")
def rows(spark):
    """4000 rows, one stratum holding most of them, some without stratum."""
    strata = ["big"] * 7 + ["mid", "small", None]
    data = [(i, strata[i % 10] if i % 400 or i % 10 != 8 else "rare") for i in range(4000)]
    return data, spark.createDataFrame(data, "id long, s string").repartition(5).cache()


def test_random_rank_is_a_row_number(rows):
    data, df = rows
    want = {}
    for s in {s for _, s in data}:
        for n, i in enumerate(sorted((i for i, t in data if t == s), key=lambda i: (key(i), i)), start=1):
            want[i] = n
    got = {r.id: r.row_num for r in sampling.random_rank_in_stratum(df, "s", "id").collect()}
    assert got == want


@pytest.mark.parametrize(("total", "digits"), [(1, 2), (30, 1), (1500, 1), (1500, 2), (10_000, 2)])
def test_balanced_subset_is_the_lowest_keys(spark, rows, total, digits):
    data, df = rows
    counts = {}
    for _, s in data:
        if s is not None:
            counts[s] = counts.get(s, 0) + 1
    quota = rotate(counts, total)
    want = set()
    for s, q in quota.items():
        want |= set(sorted((i for i, t in data if t == s), key=lambda i: (key(i), i))[:q])
    picked = sampling.balanced_subset(df, "s", "id", total, digits=digits)
    assert picked.columns == ["id", "s"]
    assert {r.id for r in picked.collect()} == want
    assert len(want) == min(total, sum(counts.values()))


def test_balanced_subset_restricted_strata(rows):
    _, df = rows
    got = sampling.balanced_subset(df, "s", "id", 20, strata=["mid", "small"]).groupBy("s").count().collect()
    assert {r.s: r["count"] for r in got} == {"mid": 10, "small": 10}


def test_subset_extend_adds_only_new_rows(rows):
    _, df = rows
    first = sampling.balanced_subset(df, "s", "id", 40).cache()
    more = sampling.subset_extend(df, first, "s", "id", 15).collect()
    ids = [r.id for r in more]
    assert len(ids) == len(set(ids)) == 55
    assert {r.id for r in first.collect()} < set(ids)
    assert all(r.s is not None for r in more)


def test_subset_verify_reports_missing_and_unexpected_strata(spark):
    subset = spark.createDataFrame([("a",), ("a",), ("x",)], "s string")
    quota = spark.createDataFrame([("a", 2), ("b", 1)], "s string, quota long")
    got = {r.s: (r.actual, r.expected) for r in sampling.subset_verify(subset, quota, "s").collect()}
    assert got == {"a": (2, 2), "b": (0, 1), "x": (1, 0)}


@pytest.mark.parametrize("n", [5, 100, 101, 777, 9999])
def test_random_sample(rows, n):
    data, df = rows
    want = set(sorted((i for i, _ in data), key=lambda i: (key(i), i))[:n])
    assert {r.id for r in sampling.random_sample_n(df, "id", n).collect()} == want


def test_allotted_drops_unknown_and_null_strata(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), (None, 1), ("z", 1)], "s string, row_num int")
    quota = spark.createDataFrame([("a", 1), ("b", 0), (None, 5)], "s string, quota long")
    assert [(r.s, r.row_num) for r in sampling.allotted(df, quota, "s").collect()] == [("a", 1)]


def test_global_position_over_several_partitions(spark, many_partitions):
    df = spark.range(1000).selectExpr("id", "id % 7 AS g").repartition(6)
    placed = ranking.global_position(df, [F.col("g").desc(), F.col("id")])
    got = {r.id: r.pos for r in placed.collect()}
    want = {i: n for n, i in enumerate(sorted(range(1000), key=lambda i: (-(i % 7), i)), start=1)}
    assert got == want


def test_group_position_of_a_group_spanning_partitions(spark, many_partitions):
    df = spark.range(2000).selectExpr("id", "IF(id % 3 = 0, id % 50, 7) AS g").repartition(6)
    got = {r.id: r.pos for r in ranking.group_position(df, "g", ["id"]).collect()}
    seen, want = {}, {}
    for i in range(2000):
        g = i % 50 if i % 3 == 0 else 7
        want[i] = seen.get(g, 0)
        seen[g] = want[i] + 1
    assert got == want


def test_diverse_pick_cuts_groups_before_the_shuffle(rows):
    _, df = rows
    picked = sampling.diverse_pick(df, "s", "id", F.col("id") % 2 == 0)
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2  # partial and final
    sizes = picked.groupBy("s", "is_recent").count().collect()
    assert all(r["count"] <= 5 for r in sizes) and sum(r["count"] for r in sizes) > 20


def test_top_k_breaks_ties_by_id(spark):
    df = spark.createDataFrame([(1, 5), (2, 9), (3, 9), (4, None)], "id int, n int")
    assert [r.id for r in sampling.top_k(df, "n", "id", 2).collect()] == [2, 3]


def test_base_filter_drops_nulls_and_zeros(spark):
    df = spark.createDataFrame([(1, 200, 1), (2, 201, 1), (3, None, 1), (4, 5, 0), (5, 5, None)], "id int, num_pages int, abstract_num int")
    assert [r.id for r in sampling.base_filter(df).collect()] == [1]


def test_buckets_keep_their_size_as_a_stratum_grows(spark, monkeypatch):
    from corpusloom.operators import ranking

    monkeypatch.setattr(ranking, "BUCKET_ROWS", 20)
    df = spark.range(60_000).selectExpr("id", "IF(id % 3 = 0, id % 50, 99) AS g")
    digits = ranking.digits_for(df)
    assert digits == 3
    largest = ranking.bucket_histogram(ranking.with_order_key(df, "id", 42, digits), "g").agg(F.max("_n")).first()[0]
    assert largest < 60
    ranked = ranking.random_rank_in_stratum(df, "g", "id").where("g = 99 AND row_num <= 10")
    assert sorted(r.row_num for r in ranked.collect()) == list(range(1, 11))
