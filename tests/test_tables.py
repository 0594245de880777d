"""Readers, writers, maintenance, worklists, linkage reports and the incremental job."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from corpusloom import schemas
from corpusloom.functions.text import term_line_scan
from corpusloom.operators import linkage, maintenance, skew, stats, taxonomy, worklist
from corpusloom.plans import QUERIES, q_sources
from corpusloom.session import spread
from corpusloom.sources import keyed, readers, writers
from corpusloom.streaming import enrich
from corpusloom.streaming.enrich import incremental_enrich


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- sources and sinks --------------------------------------------------------------------------


def test_usual_records_parse_as_the_xml_parser_does(spark):
    cf, sub = '<controlfield tag="001">{}</controlfield>', '<datafield tag="245" ind1="1" ind2=" "><subfield code="a">{}</subfield></datafield>'
    values = ["x", " x ", "a &amp; b", 'say "x"', "back\\slash", "ü ", "tab\there", "  ", "", "a\u0001b", "a>b", "<![CDATA[x]]>", "null", "{[,]}"]
    texts = [f"<record>{cf.format(a)}{sub.format(b)}</record>" for a in values for b in values]
    texts += [f"<record>\n  <leader>l</leader>\r\n\t{cf.format(1)}\n{sub.format('x')}\n{sub.format('y')}\n</record>", f"<record>{sub.format('x')}{cf.format('1')}</record>",
              f"<record>{cf.format(1)}</record>", f"<record>{cf.format(1)}{sub.format('x')}", '<record><controlfield tag="">1</controlfield></record>',
              f'<record>{cf.format(1)}<datafield ind1="1" tag="245" ind2="0"><subfield code="a">x</subfield></datafield></record>']
    df = spark.createDataFrame([(t,) for t in texts], "xml string")
    options = {"ignoreSurroundingSpaces": "false", "columnNameOfCorruptRecord": "_corrupt"}
    both = df.select(readers._parsed(F.col("xml")).alias("a"), F.from_xml("xml", f"{schemas.MARC}, _corrupt STRING", options).alias("b"), F.col("xml").rlike(readers._USUAL).alias("usual")).collect()
    assert [r.a for r in both] == [r.b for r in both]
    assert sum(r.usual for r in both) > 20


def test_csv_without_line_breaks_stays_where_it_is_read(spark, tmp_path):
    text = "doc_idn,gnd_idn,gnd_label\n" + "".join(f'{i},{i},"a, b"\n' for i in range(100))
    for n in range(3):
        (tmp_path / f"{n}.csv").write_text(text)
    df = readers.link_csv_scan(spark, str(tmp_path))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "Window" not in plan and df.count() == 300


def test_small_files_are_listed_once(spark, tmp_path):
    (tmp_path / "d" / "e").mkdir(parents=True)
    (tmp_path / "a.txt").write_text("a\nb\n")
    (tmp_path / "d" / "e" / "b.txt").write_text("c")
    for df in (readers.text_corpus_scan(spark, str(tmp_path), "*.txt"), readers.binary_doc_scan(spark, str(tmp_path), 5, "*.txt")):
        assert df.count() == 2 and "Union" not in df._jdf.queryExecution().optimizedPlan().toString()
    folders = {p.split("/corpus-")[1].split("/")[1] for p in spark.read.text(q_sources._bounded_files(spark, "/root/testdata/sf0.001"), recursiveFileLookup=True).inputFiles()}
    assert folders == {"folder=0"}


def test_records_of_few_large_splits_get_tasks_by_their_number(spark, tmp_path):
    spark.range(1000).coalesce(1).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    assert spread(df, "id", 20).rdd.getNumPartitions() == 50 and spread(df, "id", 20).count() == 1000
    assert spread(df, "id").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_marc_scan_splits_one_file_by_record(spark, tmp_path):
    body = "".join(f'<record>\n<controlfield tag="001">{i}</controlfield></record>\n' for i in range(500))
    (tmp_path / "all.xml").write_text(f'<?xml version="1.0"?>\n<collection xmlns="http://www.loc.gov/MARC21/slim">{body}</collection>\n')
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = readers.marc_xml_scan(spark, str(tmp_path))
        assert df.rdd.getNumPartitions() > 3
        assert sorted(int(r[0]) for r in df.select(F.col("controlfield")[0]["_VALUE"]).collect()) == list(range(500))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_csv_links_stay_strings(spark, tmp_path):
    (tmp_path / "l.csv").write_text('doc_idn,gnd_idn,gnd_label\n97250155X,0042,"A, B"\n97250155X,0042,"A, B"\n1,0042,C\n')
    df = readers.link_csv_scan(spark, str(tmp_path))
    assert set(df.dtypes) == {(c, "string") for c in schemas.LINK_COLUMNS}
    assert rows(df)[-1] == ("97250155X", "0042", "A, B")
    assert tuple(linkage.duplicate_report(df, ["doc_idn", "gnd_idn"]).first()) == (1, 1)
    assert tuple(linkage.link_counts(df).first()) == (2, 2, 2)


def test_corpus_and_binary_scan(spark, tmp_path):
    (tmp_path / "a.mmd").write_text("# Abstract\none\n")
    (tmp_path / "b.txt").write_text("no")
    (tmp_path / "c.pdf").write_bytes(b"%PDF-1.7\xff\xfe")
    assert rows(readers.text_corpus_scan(spark, str(tmp_path)).drop("path")) == [("a.mmd", 0, "# Abstract\none\n")]
    assert rows(readers.binary_doc_scan(spark, str(tmp_path), glob="*.pdf").drop("path")) == [("c.pdf", 10, "%PDF-")]


TAXONOMY = {
    "5": {"name": "Science", "sub": {"500": {"name": "General"}, "510": {"name": "Maths"}, "580-590": {"name": "Plants"}}},
    "7": {"name": "Arts", "sub": {}},
}


@pytest.fixture
def flat(spark, tmp_path):
    (tmp_path / "t.json").write_text(json.dumps(TAXONOMY, indent=2))
    return readers.taxonomy_scan(spark, str(tmp_path / "t.json")).cache()


def test_taxonomy_scan_and_export(spark, flat, tmp_path):
    assert ("5", "Science", "580-590", 580, 590, "Plants") in rows(flat)
    assert ("7", "Arts", None, None, None, None) in rows(flat)
    assert rows(readers.class_names(flat)) == [("5", "Science"), ("7", "Arts")]
    writers.export_lines(taxonomy.nested_json_export(flat), str(tmp_path / "out"))
    back = readers.taxonomy_scan(spark, str(tmp_path / "out"), lines=True)
    assert rows(back) == rows(flat)
    doubled = flat.union(flat.where("sub_key = '580-590'").withColumn("sub_name", F.lit("Zoo")))
    assert rows(taxonomy.nested_json_export(doubled)) == rows(taxonomy.nested_json_export(flat))
    paged = taxonomy.nested_json_export(flat, page_size=1)
    assert paged.count() > 1
    writers.export_lines(paged, str(tmp_path / "paged"))
    assert rows(readers.taxonomy_scan(spark, str(tmp_path / "paged"), lines=True)) == rows(back)


def test_taxonomy_lookup_cases(spark, flat):
    missing = taxonomy.SUB_MISSING
    unknown = ("0", taxonomy.MAIN_MISSING, f"000 {missing}")
    cases = {
        "510": ("5", "Science", "510 Maths"), "519.2": ("5", "Science", "510 Maths"), "585": ("5", "Science", "580-590 Plants"),
        "599": ("5", "Science", "580-590 Plants"), "520": ("5", "Science", f"520 {missing}"), "5": ("5", "Science", f"000 {missing}"),
        "51": ("5", "Science", f"050 {missing}"), "780": ("7", "Arts", f"780 {missing}"), "900": unknown, "x": unknown, "5x": unknown,
    }
    df = spark.createDataFrame([(c,) for c in cases], "code string")
    got = {r.code: (r.main, r.main_name, r.sub_label) for r in taxonomy.taxonomy_lookup(df, "code", taxonomy.taxonomy_dimension(flat)).collect()}
    assert got == cases


def test_tree_count_sorts_ranges_last(spark, flat):
    df = spark.createDataFrame([("510",), ("511",), ("581",), ("",), (None,)], "ddc string")
    counts = taxonomy.taxonomy_tree_count(df, "ddc", taxonomy.taxonomy_dimension(flat)).orderBy("main", "sort_key").collect()
    assert [(r.sub_label, r.n) for r in counts] == [(None, 3), ("510 Maths", 2), ("580-590 Plants", 1)]


def test_snapshot_publishes_only_equal_copies(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "snap")
    df = spark.createDataFrame([(1, "a", None), (2, "b", "x"), (3, None, "y")], "id int, s string, t string")
    assert writers.snapshot_publish(df, root, 1, "s")
    assert rows(writers.snapshot_current(spark, root)) == rows(df)
    real = writers.copy_table
    monkeypatch.setattr(writers, "copy_table", lambda d, p: real(d.where("id <> 2"), p))
    assert not writers.snapshot_publish(df, root, 2, "s")
    assert writers.snapshot_current(spark, root).count() == 3


def test_fingerprint_sees_swapped_and_moved_values(spark):
    a = spark.createDataFrame([("s", "x", None), ("s", "y", "z")], "s string, t string, u string")
    for other in ([("s", None, "x"), ("s", "y", "z")], [("s", "x", None), ("s", "x", None)], [("s", "x", None)], [("r", "x", None), ("s", "y", "z")]):
        b = spark.createDataFrame(other, "s string, t string, u string")
        assert not writers.compare_tables(a, b, "s").where("NOT same OR same IS NULL").isEmpty()
    assert writers.compare_tables(a, a.orderBy("t"), "s").where("NOT same").isEmpty()


def test_replace_and_append(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(10).selectExpr("id", "id % 2 AS g")
    assert writers.idempotent_replace(df, path).count() == writers.idempotent_replace(df, path).count() == 10
    assert writers.idempotent_replace(writers.replaced_table(spark, path).where("g = 1"), path).count() == 5
    for _ in range(2):
        writers.batch_insert(df, str(tmp_path / "grown"))
    assert spark.read.parquet(str(tmp_path / "grown")).count() == 20


def test_record_schemas(spark):
    v1, v2 = (spark.createDataFrame([], s) for s in (schemas.RECORD_V1, schemas.RECORD_V2))
    assert (len(v1.columns), len(v2.columns)) == (28, 36) and v2.columns[:28] == v1.columns
    grown = v1.unionByName(v2, allowMissingColumns=True)
    assert grown.columns == v2.columns


# --- maintenance --------------------------------------------------------------------------------


def test_insert_update_reset_add(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    new = spark.createDataFrame([(2, "z"), (3, "d"), (3, "c"), (None, "n")], "id int, v string")
    assert rows(maintenance.insert_if_absent(target, new, "id")) == [(1, "a"), (2, "b"), (3, "c")]
    updates = spark.createDataFrame([(1, None), (9, "q")], "id int, v string")
    assert rows(maintenance.update_by_key(target, updates, "id", ["v"])) == [(1, None), (2, "b")]
    extra = maintenance.update_by_key(target, updates.withColumn("w", F.lit(5)), "id", ["w"])
    assert rows(extra) == [(1, "a", 5), (2, "b", None)]
    reset = maintenance.reset_columns(target, ["v"])
    assert reset.schema["v"].dataType == target.schema["v"].dataType and reset.where("v IS NOT NULL").isEmpty()
    assert maintenance.add_column(target, "v", "int").columns == ["id", "v"]
    assert maintenance.add_column(target, "n", "int").dtypes[-1] == ("n", "int")


def test_reject_split_accounts_for_every_row(spark):
    data = [("1", "5"), ("1", "4"), ("1", "4"), ("2", "x"), ("2", "x"), (None, "3"), ("3", None), ("3", None), ("y", "1"), ("4", "7")]
    raw = spark.createDataFrame(data, "k string, n string")
    valid, bad = maintenance.reject_split(raw, {"k": "int", "n": "int"}, "k")
    assert rows(valid) == rows(spark.createDataFrame([(1, 4), (3, None), (4, 7)], "k int, n int"))
    got = {(r.k, r.n, r.reason): r.copies for r in bad.collect()}
    assert got == {
        ("1", "5", "duplicate key"): 1, ("1", "4", "duplicate key"): 1, ("2", "x", "type:n"): 2, (None, "3", "null key"): 1,
        ("3", None, "duplicate key"): 1, ("y", "1", "type:k"): 1,
    }
    assert valid.count() + sum(got.values()) == len(data)
    assert maintenance.load_if_empty(raw, raw.limit(1)).count() == len(data)
    assert maintenance.load_if_empty(raw.where("false"), raw).count() == len(data)


def test_tasks_of_reject_split_and_duplicate_report_follow_the_rows(spark, monkeypatch):
    monkeypatch.setattr(skew, "TASK_ROWS", 10)
    raw = spark.range(1000).selectExpr("CAST(id % 400 AS STRING) AS k", "CASE WHEN id % 7 = 0 THEN 'x' ELSE CAST(id % 9 AS STRING) END AS n")
    raw = raw.unionByName(raw.where("n = '3'"))
    one, other = (maintenance.reject_split(raw, {"k": "int", "n": "int"}, "k", key_rows=n) for n in (100_000, 0))
    assert one[0].rdd.getNumPartitions() > 80
    assert rows(one[0]) == rows(other[0]) and rows(one[1]) == rows(other[1])
    assert "REPARTITION_BY_NUM" in linkage.duplicate_report(raw, ["k"])._jdf.queryExecution().executedPlan().toString()
    want = (raw.count() - raw.distinct().count(), raw.count() - 400)
    assert tuple(linkage.duplicate_report(raw, ["k"]).first()) == want
    monkeypatch.setattr(linkage, "deal", lambda df, keys: None)
    assert tuple(linkage.duplicate_report(raw, ["k"]).first()) == want


# --- worklists ----------------------------------------------------------------------------------


def test_not_in_follows_sql_null_rules(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "id int")
    ids = lambda *v: spark.createDataFrame([(x,) for x in v], "id int")
    assert rows(worklist.anti_join_not_in(df, ids(1), "id")) == [(2,)]
    assert rows(worklist.anti_join_not_in(df, ids(1, None), "id")) == []
    assert len(rows(worklist.anti_join_not_in(df, ids(), "id"))) == 3


def test_worklist_batches_and_chunks(spark, many_partitions):
    df = spark.createDataFrame([(i, "u" if i % 4 else None, "done" if i % 5 == 0 else None) for i in range(100)], "id int, url string, res string")
    failed = spark.createDataFrame([(1,), (1,), (2,)], "id int")
    todo = worklist.worklist(df, "url", "res", failed, "id")
    ids = sorted(r.id for r in todo.collect())
    assert ids == [i for i in range(100) if i % 4 and i % 5 and i not in (1, 2)]
    batches = {r.id: r.batch_id for r in worklist.work_batches(todo, ["-id"], 7).collect()}
    assert batches == {i: n // 7 for n, i in enumerate(sorted(ids, reverse=True))}
    for n, cap in ((4, 1000), (7, 20), (9, 5)):
        chunks = {r.id: r.chunk for r in worklist.work_chunks(todo, ["id"], n, cap).collect()}
        total = min(cap, len(ids))
        sizes = [total // n + (k < total % n) for k in range(n)]
        want = [k for k, size in enumerate(sizes) for _ in range(size)]
        assert chunks == dict(zip(ids, want + [None] * (len(ids) - total)))
    everything = worklist.work_chunks(todo, ["id"], 3).collect()
    assert sorted(r.id for r in everything) == ids and {r.chunk for r in everything} == {0, 1, 2}


def test_progress_report_of_an_empty_run(spark):
    log = spark.sql("SELECT 'a' AS url, 'todo' AS st, TIMESTAMP_NTZ'2024-01-01 00:00:00' AS ts")
    row = worklist.progress_report(log, F.col("url").isNotNull(), F.col("st") == "done", "ts").first()
    assert (row.total, row.done, row.left, row.pct, row.per_hour, row.eta_sec) == (1, 0, 1, 0.0, None, None)


def test_stall_gaps_against_sorted_times(spark):
    rng = random.Random(5)
    data = [(k, rng.randrange(0, 5000)) for k in (1, 2, 3) for _ in range(60)] + [(4, 0), (4, 900), (4, 1801), (5, 7)]
    log = spark.createDataFrame(data, "k int, s long").selectExpr("k", "timestamp_seconds(s) AS ts")
    want = []
    for k in {k for k, _ in data}:
        t = sorted(s for q, s in data if q == k)
        want += [(k, a * 10**6, b * 10**6, b - a) for a, b in zip(t, t[1:]) if b - a > 120]
    assert rows(worklist.stall_gaps(log, "k", "ts", 120)) == sorted(want, key=repr)
    assert [r.gap_sec for r in worklist.stall_gaps(log.where("k = 4"), "k", "ts", 900).collect()] == [901]


# --- reports ------------------------------------------------------------------------------------


def test_rates_of_empty_tables(spark):
    empty = spark.createDataFrame([], "s string, f int, n int")
    assert tuple(stats.overall_rate(empty, "f").first()) == (0, 0, 0.0)
    assert stats.over_limit_share(empty, "n", 5).first().pct is None
    assert rows(stats.count_by_stratum(empty, "s", ["0", "1"])) == [("0", 0), ("1", 0)]


def test_link_coverage_counts_duplicates(spark):
    records = spark.createDataFrame([("1",), ("1",), ("2",), ("3",)], "d string")
    links = spark.createDataFrame([("1",), ("1",), ("9",)], "d string")
    assert tuple(linkage.link_coverage(records, links, "d").first()) == (3, 1, 33.33, 3, 1.5)


def test_link_star_from_raw_links(spark):
    raw = [("1", "b", "B"), ("1", "b", "B"), ("1", "b", "A"), ("2", "a", "Z"), ("9", "a", "Z"), ("2", "b", "B")]
    links = spark.createDataFrame(raw, "doc_idn string, gnd_idn string, gnd_label string")
    records = spark.createDataFrame([(10, "1"), (20, "2"), (30, "3")], "id int, doc_idn string")
    kept, entities, mappings = linkage.link_star(links, records)
    assert rows(kept.select("id")) == [(10,), (20,)]
    assert rows(entities.select("id", "gnd_idn", "gnd_label")) == [(1, "a", "Z"), (2, "b", "A")]
    assert rows(mappings) == [(10, 2), (20, 1), (20, 2)]


def test_find_entry_picks_the_column_by_type(spark):
    df = spark.createDataFrame([(1, "97250155X.pdf", None), (2, None, "97250155X.mmd")], "id int, path string, converted_file string")
    assert [r.id for r in maintenance.find_entry(df, "97250155X", "mmd").collect()] == [2]
    assert [r.id for r in maintenance.find_entry(df, "97250155X", "pdf").collect()] == [1]
    assert maintenance.find_entry(df, "x", "pdf").isEmpty()


# --- incremental --------------------------------------------------------------------------------


def test_incremental_equals_batch_and_runs_once(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").cache()
    src, out, ckpt = (str(tmp_path / d) for d in ("src", "out", "ckpt"))
    hits = lambda df: df.select("doc_id", F.inline(F.array(term_line_scan(F.col("text"), "the"))))
    (tmp_path / "src").mkdir()
    assert incremental_enrich(spark, src, out, ckpt, docs.schema, hits, "doc_id").isEmpty()
    half = docs.where("doc_id % 2 = 0")
    half.repartition(5).write.mode("append").parquet(src)
    run = lambda: incremental_enrich(spark, src, out, ckpt, docs.schema, hits, "doc_id", max_files=2)
    assert rows(run()) == rows(hits(half))
    batches = lambda: spark.read.parquet(f"{out}/pointer").select("batch").distinct().count()
    assert batches() == 3
    assert rows(run()) == rows(hits(half)) and batches() == 3
    docs.where("doc_id % 2 = 1").repartition(3).write.mode("append").parquet(src)
    assert rows(run()) == rows(hits(docs))


def test_incremental_query_reads_a_table_of_several_files(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    docs.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    want = rows(QUERIES["incremental_enrich"](spark, "/root/testdata/sf0.001"))
    assert rows(QUERIES["incremental_enrich"](spark, str(tmp_path))) == want and len(want) == docs.count()


def test_a_batch_touches_only_its_buckets(spark, tmp_path):
    out = str(tmp_path / "out")
    df = lambda pairs: spark.createDataFrame(pairs, "k int, v string")
    read = lambda: rows(keyed.keyed_table(spark, out, df([(1, "")]).schema))
    enrich.merge_batch(df([(i, "old") for i in range(100)] + [(5, "older"), (None, "n")]), out, 0, "k", 8)
    state = {(i, "older" if i == 5 else "old") for i in range(100)} | {(None, "n")}
    assert read() == sorted(state, key=repr)
    before = keyed.bucket_versions(spark, out)
    # files of the other buckets are out of reach during the second run
    (bucket,) = {r[0] for r in df([(7, "")]).select(keyed.bucket_of("k", 8)).collect()}
    held = [d for d in (tmp_path / "out" / "state" / "version=0").iterdir() if d.is_dir() and d.name != f"bucket={bucket}"]
    for d in held:
        d.chmod(0)
        for f in d.iterdir() if os.access(d, os.R_OK) else ():
            f.rename(tmp_path / f"{d.name}-{f.name}")
    enrich.merge_batch(df([(7, "new")]), out, 1, "k", 8)
    for d in held:
        d.chmod(0o755)
    for f in tmp_path.glob("bucket=*-*"):
        f.rename(tmp_path / "out" / "state" / "version=0" / f.name.split("-", 1)[0] / f.name.split("-", 1)[1])
    state = state - {(7, "old")} | {(7, "new")}
    assert read() == sorted(state, key=repr)
    assert keyed.bucket_versions(spark, out) == before | {bucket: 1} and keyed.bucket_versions(spark, out, before=1) == before
    # a replay replaces its own attempt, and a batch without a pointer is not seen
    enrich.merge_batch(df([(7, "newer"), (300, "x")]), out, 1, "k", 8)
    assert read() == sorted(state - {(7, "new")} | {(7, "newer"), (300, "x")}, key=repr)


def test_update_rewrites_only_the_buckets_of_updated_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(i, f"s{i}", i) for i in range(200)], "k long, s string, n int")
    assert rows(keyed.store_keyed(df, path, "k", 16)) == rows(df)
    updates = spark.createDataFrame([(3, None), (900, 5), (17, 1), (17, 0)], "k long, n int")
    got = keyed.update_stored(updates, path, 1, "k", ["n"], df.schema, 16)
    assert rows(got) == rows(maintenance.update_by_key(df, updates, "k", ["n"])) != rows(df)
    hit = {r[0] for r in updates.select(keyed.bucket_of("k", 16)).collect()}
    assert keyed.bucket_versions(spark, path) == {b: int(b in hit) for b in range(16)}
    assert rows(keyed.update_stored(updates.limit(0), path, 2, "k", ["n"], df.schema, 16)) == rows(got)


def test_replace_keeps_the_old_table_until_the_commit(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    writers.idempotent_replace(spark.range(5), path)
    broken = spark.range(9).withColumn("id", F.when(F.col("id") == 8, F.raise_error(F.lit("torn"))).otherwise(F.col("id")).cast("long"))
    with pytest.raises(Exception, match="torn"):
        writers.idempotent_replace(broken, path)
    assert writers.replaced_table(spark, path).count() == 5
    monkeypatch.setattr(writers, "_committed", lambda *a: 1 / 0)  # between writing and committing
    with pytest.raises(ZeroDivisionError):
        writers.idempotent_replace(spark.range(7), path)
    monkeypatch.undo()
    assert writers.replaced_table(spark, path).count() == 5
    assert writers.idempotent_replace(writers.replaced_table(spark, path).where("id > 1"), path).count() == 3


def test_chunks_with_nulls_and_several_columns(spark, many_partitions):
    data = [(a, b, i) for i, (a, b) in enumerate((a, b) for a in (None, 3, 1, 2) for b in ("x", None, "y"))]
    df = spark.createDataFrame(data, "a int, b string, i int")
    rank = lambda r, down: sorted(data, key=lambda t: (-(t[0] or 0) if down else (t[0] is not None, t[0] or 0), t[1] is not None, t[1] or ""))
    for order, down in ((["a", "b"], False), (["-a", "b"], True)):
        place = {t[2]: k for k, t in enumerate(rank(data, down))}
        chunked = worklist.work_chunks(df, order, 5)
        plan = chunked._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan.split("Subquery")[0] and "Join" not in plan
        assert {r.i: r.chunk for r in chunked.collect()} == {i: [0, 0, 0, 1, 1, 1, 2, 2, 3, 3, 4, 4][p] for i, p in place.items()}
        assert {r.i: r.batch_id for r in worklist.work_batches(df, order, 5).collect()} == {i: p // 5 for i, p in place.items()}
        assert {r.i: r.chunk for r in worklist.work_chunks(df, order, 3, 2).collect()} == {i: p if p < 2 else None for i, p in place.items()}
    assert worklist.work_chunks(df.limit(0), ["a", "b"], 3).collect() == []


def test_marc_scan_loses_no_record(spark, tmp_path):
    one = lambda i, p="": f'<{p}controlfield tag="001">{i}</{p}controlfield>'
    (tmp_path / "a.xml").write_text(
        f'<collection><record>{one(1)}</record ><record type="x">{one(2)}</record\n>\n<record><!-- </b> <record> -->{one(3)}</record>'
        f'<marc:record xmlns:marc="u">{one(4, "marc:")}</marc:record><record>{one(5)}<datafield></record><record>{one(6)}</record></collection>')
    (tmp_path / "b.xml").write_text(f'<record>{one(7)}<!-- </record> -->{one(8)}</record><record>{one(9)}')
    found = [r.controlfield[0]["_VALUE"] for r in readers.marc_xml_scan(spark, str(tmp_path)).collect()]
    rejected = readers.marc_xml_rejects(spark, str(tmp_path)).collect()
    assert sorted(found + [x for r in rejected for x in "123456789" if f">{x}<" in r.xml]) == list("123456789")
    assert set("123456") - set(found) == {"3", "5"} and all(r.reason for r in rejected)


def test_link_csv_quotes_and_line_breaks(spark, tmp_path):
    (tmp_path / "l.csv").write_text('doc_idn,gnd_idn,gnd_label\n1,2,"say ""hi"", now"\n3,4X,"two\nlines"\n05,6,"back\\"\n')
    assert rows(readers.link_csv_scan(spark, str(tmp_path))) == [("05", "6", "back\\"), ("1", "2", 'say "hi", now'), ("3", "4X", "two\nlines")]


def test_broken_json_fails(spark, tmp_path):
    (tmp_path / "f.json").write_text('["1", "2"')
    for scan in (readers.failure_list_scan, readers.taxonomy_scan):
        with pytest.raises(Exception, match="MALFORMED|Malformed"):
            scan(spark, str(tmp_path)).collect()


def test_snapshot_never_overwrites(spark, tmp_path):
    df = spark.range(5).selectExpr("id", "id % 2 AS g")
    assert writers.snapshot_publish(df, str(tmp_path), 1, "g")
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        writers.snapshot_publish(df.limit(2), str(tmp_path), 1, "g")
    assert writers.snapshot_current(spark, str(tmp_path)).count() == 5


def test_latest_by_key_breaks_ties_by_the_row(spark):
    from corpusloom.streaming.enrich import latest_by_key

    df = spark.createDataFrame([(1, 1, "b"), (1, 1, "a"), (1, 0, "z"), (2, 0, None)], "k int, v int, x string")
    assert rows(latest_by_key(df.repartition(3), "k", "v")) == [(1, "b"), (2, None)]


@pytest.mark.parametrize("name", ["text_corpus_scan", "binary_doc_scan"])
def test_corpus_files_are_bounded_for_a_hot_source(spark, tmp_path, monkeypatch, name):
    docs = [(i, f"{'ab' if i == 0 else f'text {i}'} " * (1 if i < 3 else 50), "hot" if i < 380 else f"s{i % 4}") for i in range(400)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").withColumns({"lang": F.lit("de"), "n_chars": F.length("text").cast("long")})
    df.select("doc_id", "text", "lang", "source", "n_chars").coalesce(1).write.parquet(str(tmp_path / "sf" / "documents.parquet"))
    monkeypatch.setattr(q_sources, "_FILE_DOCS", 40)
    monkeypatch.setattr(q_sources, "shared_path", lambda spark, label: str(tmp_path / label))
    got = getattr(q_sources, name)(spark, str(tmp_path / "sf"))
    whole = {}
    for i, text, source in docs:
        whole[source, i // 40] = whole.get((source, i // 40), "") + text + "\n"
    if name == "text_corpus_scan":
        assert rows(got) == sorted(((s, b, 0, t) for (s, b), t in whole.items()), key=repr)
    else:
        assert rows(got) == sorted(((s, b, len(t), t[:5].encode().hex().upper()) for (s, b), t in whole.items()), key=repr)
    assert max(f.stat().st_size for f in (tmp_path / "corpus").rglob("part-*.txt")) < 30_000


@pytest.fixture
def small_pieces(spark):
    """Read files in pieces of 300 bytes."""
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_quoted_line_breaks_split_over_pieces(spark, tmp_path, small_pieces, end):
    rng = random.Random(len(end))
    one = lambda: "".join(rng.choice(["a", "ü", ",", '"', "\n", " ", "bc"]) for _ in range(rng.choice([0, 1, 4, 30, 400])))
    wide = lambda values: ",".join('"' + v.replace('"', '""') + '"' if rng.random() < 0.2 or set(v) & set(',"\n') else v for v in values)
    for name in ("a.csv", "b.csv"):
        data = [[f"{name}{i}", one(), one()] for i in range(150)]
        lines = ["doc_idn,gnd_idn,gnd_label", *map(wide, data)]
        lines.insert(40, "")
        (tmp_path / name).write_bytes((end.join(lines) + (end if name == "a.csv" else "")).encode())
    got = readers.link_csv_scan(spark, str(tmp_path))
    schema = ", ".join(f"{c} STRING" for c in schemas.LINK_COLUMNS)
    one_task = spark.read.schema(schema).option("header", True).option("escape", '"').option("multiLine", True).csv(str(tmp_path))
    assert got.count() == 300 and rows(got) == rows(one_task)
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 20


def test_csv_header_is_checked(spark, tmp_path):
    (tmp_path / "l.csv").write_text("\ufeffdoc_idn,gnd_idn,gnd_label\n1,2,3\n")
    assert rows(readers.link_csv_scan(spark, str(tmp_path))) == [("1", "2", "3")]
    (tmp_path / "m.csv").write_text("gnd_idn,doc_idn,gnd_label\n1,2,3\n")
    with pytest.raises(Exception, match="header is not"):
        readers.link_csv_scan(spark, str(tmp_path)).collect()


def test_text_blocks_of_large_files(spark, tmp_path, small_pieces):
    rng = random.Random(4)
    texts = {}
    for i, ended in enumerate((True, False, True, False)):
        lines = ["ä" * rng.choice([0, 1, 30, 700]) for _ in range(120 if i else 2)]
        texts[f"{i}.mmd"] = "\n".join(lines) + ("\n" if ended else "x")
        (tmp_path / f"{i}.mmd").write_text(texts[f"{i}.mmd"])
    for size in (100, 1000, 10**6):
        found = {}
        for r in readers.text_corpus_scan(spark, str(tmp_path), block_bytes=size).orderBy("file", "offset").collect():
            assert len("".join(found.setdefault(r.file, [])).encode()) == r.offset
            found[r.file].append(r.content)
            assert len(r.content.encode()) < size + 1402
        assert {f: "".join(parts) for f, parts in found.items()} == texts


def test_heads_of_large_files(spark, tmp_path, small_pieces):
    files = {"a": b"%PDF-1.4\n" + bytes(range(256)) * 20, "b": b"\n\n\xff\n" + b"x" * 3000, "c": b"ab", "d": b"q" * 2000}
    for name, content in files.items():
        (tmp_path / name).write_bytes(content)
    want = sorted((n, len(c), c[:5].decode("latin-1")) for n, c in files.items())
    for whole in (0, 100, 10**6):
        assert rows(readers.binary_doc_scan(spark, str(tmp_path), whole_bytes=whole).drop("path")) == sorted(want, key=repr)
