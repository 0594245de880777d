"""Every registered query against its SQL on the smallest data set."""

import oracle
import pytest

from corpusloom.plans import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SF_DIR)


# Rows leave the JVM in no registered query, and nothing joins by comparing all pairs.
UNWANTED = ("EvalPython", "InPandas", "InArrow", "CartesianProduct", "NestedLoopJoin")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [node for node in UNWANTED if node in plan]
    message = oracle.compare(duck, df, ORACLES.get(name))
    assert message is None, message  # an empty result is a failure too


def test_scans_read_only_what_they_need(spark):
    plan = QUERIES["like_filter"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "StringStartsWith(p_name,s)" in plan and "StringEndsWith(p_name,bolt)" in plan
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string>" in plan
    plan = QUERIES["key_lookup"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(doc_id,77)" in plan and "text:string" not in plan
    plan = QUERIES["duplicate_report"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint>" in plan


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_entry_point(spark):
    import __spark_entry__ as contract

    rows = contract.entry(spark).collect()
    assert rows and all(r.actual == r.expected for r in rows)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())
