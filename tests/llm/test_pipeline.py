"""The corpus pipeline against brute force on its own inputs, and the entry point."""

import os

import brute
import pytest

from corpusloom.session import pin

corpus_pipeline = pytest.importorskip("corpus_pipeline")
SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, stages, before = docs.columns, {}, docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, before, SF).write.parquet(str(tmp_path / str(k)))
        after = spark.read.parquet(str(tmp_path / str(k)))
        stages[name] = ({r.doc_id: r.text for r in before.collect()}, {r.doc_id: r for r in after.collect()})
        before = after
        if k < len(corpus_pipeline.STAGES) - 1:
            assert after.columns == columns and after.dtypes == docs.dtypes
    given, kept = stages["quality"]
    labels = dict(spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality").collect())
    assert sum((i in kept) == bool(y) for i, y in labels.items()) >= 0.95 * len(labels)
    given, kept = stages["near_duplicates"]
    assert set(kept) == {i for i, (_, c) in brute.ngram_groups(given.items()).items() if c == i}
    given, kept = stages["repeated_passages"]
    want = {i: (n, gone) for i, n, gone, _ in brute.passages(given.items())}
    assert {i: len(r.text.split()) for i, r in kept.items()} == {i: n - gone for i, (n, gone) in want.items() if not gone or n > gone}
    assert all(r.text == given[i] for i, r in kept.items() if not want[i][1])
    assert set(stages["decontamination"][1]) <= set(stages["decontamination"][0])
    assert set(stages["tokens"][1]) == set(stages["tokens"][0])


def test_rows_that_share_an_id_and_nulls(spark):
    long = " ".join(f"t{i}" for i in range(40))
    rows = [(1, long), (1, long), (1, "something else " * 9), (2, long), (None, None), (3, "z " + long)]
    docs = spark.createDataFrame([(i, t, None, None, t and len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.near_duplicates(spark, docs, SF).collect()
    assert sorted((r.doc_id or 0, len(r.text or "")) for r in got) == [(0, 0), (1, 135), (1, len(long))]
    got = corpus_pipeline.repeated(spark, docs, SF).collect()
    assert sorted((r.doc_id or 0, r.text) for r in got if r.doc_id) == [(1, "something else " * 9), (1, long), (1, long), (3, "z")]


def test_empty_tables_nulls_and_further_columns(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    item = " ".join(f"leak{i}" for i in range(30))
    rows = [(1, f"some words {item} and more", "de", None, 9), (2, None, None, None, None), (None, "good " * 30, "en", "s", 1), (3, "", "en", "s", 0)]
    given = spark.createDataFrame(rows, schema).selectExpr("*", "1 AS id", "2 AS s", "'x' AS score", "0 AS ids")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = given
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        for n, table in enumerate((docs, docs.limit(0))):
            stage(spark, table, str(tmp_path)).write.parquet(str(tmp_path / f"{k}-{n}"))
        assert spark.read.parquet(str(tmp_path / f"{k}-1")).count() == 0
        kept = spark.read.parquet(str(tmp_path / f"{k}-0"))
        if name == "decontamination":
            assert {r.doc_id for r in docs.collect()} - {r.doc_id for r in kept.collect()} == {1}
        docs = kept


def test_entry_point_lists_the_queries():
    import __spark_entry__ as contract

    names = set(contract.queries())
    assert "pipeline" in names and {n.split("_")[0] for n in names if n.startswith("op") and n[2].isdigit()} == {f"op{i}" for i in range(1, 14)}


def test_repeated_passages_leave_no_shuffles_and_move_no_whole_documents(spark, tmp_path):
    shared = " ".join(f"w{i}" for i in range(30))
    rows = [(i, f"own{i} " * 20 + (shared if i % 3 == 0 else ""), f"l{i}", f"s{i}", 7) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    disk = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()
    shuffles = lambda: sum(f.getName().endswith(".data") for f in [disk.getAllFiles().apply(i) for i in range(disk.getAllFiles().size())])
    before = shuffles()
    out = corpus_pipeline.repeated(spark, docs, SF)
    assert shuffles() <= before  # of all the steps that ran while it was built
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftAnti") == 1 and "strategy=broadcast" in plan.split("Join LeftAnti")[1].split("\n")[0]
    got = {r.doc_id: r for r in out.collect()}
    assert len(got) == 60 and got[0].text == rows[0][1] and got[0].n_chars == 7
    for i in range(3, 60, 3):
        own = ("own%d " % i * 20).strip()
        assert got[i] == (i, own, f"l{i}", f"s{i}", len(own))
    assert all(got[i] == rows[i] for i in range(60) if i % 3)


def test_pinned_tables_have_data_files_only(spark):
    """No mark of success, whose mode Hadoop sets by a process that the driver starts."""
    table = pin(spark.range(5).withColumnRenamed("id", "doc_id"))
    names = [os.path.basename(f) for f in table.inputFiles()]
    folder = os.path.dirname(table.inputFiles()[0].removeprefix("file://"))
    assert names and sorted(n for n in os.listdir(folder) if not n.startswith(".")) == sorted(names)
    assert not any("_SUCCESS" in n for n in os.listdir(folder)) and table.count() == 5
