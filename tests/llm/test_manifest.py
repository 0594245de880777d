"""Merkle manifest against SQL and a plain version."""

import hashlib
import random
import zlib

import oracle
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import merkle
from corpusloom.llm.q_manifest import COLUMNS, MANIFEST_SQL, op13_merkle_manifest

SF = "/root/testdata/sf0.001"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def levels_of(nodes, fan):
    out = [nodes]
    while len(nodes) > 1:
        nodes = [h(*nodes[i:i + fan]) for i in range(0, len(nodes), fan)]
        out.append(nodes)
    return out


def walk(levels, place, fan):
    for nodes in levels[:-1]:
        first = place // fan * fan
        yield "".join(nodes[first:place]), "".join(nodes[place + 1:first + fan])
        place //= fan


def brute(rows, fan):
    """Sorted (id, source, leaf, subroot, root, path)."""
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append((row[0] is not None, row[0] or 0, leaf(row), row))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels_of([g[2] for g in sorted(groups[s], key=lambda g: g[:3])], fan) for s in names}
    top = levels_of([trees[s][-1][0] for s in names], fan)
    out = []
    for k, s in enumerate(names):
        for place, (_, _, own, row) in enumerate(sorted(groups[s], key=lambda g: g[:3])):
            path = [*walk(trees[s], place, fan), *walk(top, k, fan)]
            out.append((row[0], s, own, trees[s][-1][0], top[-1][0], path))
    return sorted(out, key=repr)


def rows_of(found):
    return sorted(((r.doc_id, r.source, r.leaf, r.subroot, r.root, [(p.before, p.after) for p in r.path]) for r in found.collect()), key=repr)


def corpus(seed, n, sources):
    rng = random.Random(seed)
    return [(rng.choice([None, *range(n)]) if rng.random() < 0.2 else i, rng.choice(sources), rng.choice(["de", None]), rng.randrange(9), rng.choice([None, "", "Aß", "x" * 5]))
            for i in range(n)]


@pytest.mark.parametrize("fan,digits,n,sources", [
    (2, 1, 40, ["a", "b", None]), (2, 2, 70, ["a"]), (3, 2, 90, ["a", "", "Z", "ä", None, "b"]), (16, 3, 300, ["a", "a", "b"]), (2, 2, 30, [f"s{i}" for i in range(30)])])
def test_trees_against_brute_force(spark, many_partitions, monkeypatch, fan, digits, n, sources):
    monkeypatch.setattr(merkle, "FAN", fan)
    monkeypatch.setattr(merkle, "DIGITS", digits)
    rows = corpus(n, n, sources)
    rows += rows[:5]  # repeated rows
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars int, text string")
    found = merkle.merkle_manifest(df.withColumn("g", F.lit(1)).withColumn("place", F.lit(2)).repartition(5), COLUMNS, "source", "doc_id")
    assert rows_of(found) == brute(rows, fan)


def test_blocks_over_several_rounds(spark):
    rows = [(i, "hot" if i % 9 else "rare", "en", i, f"t{i}") for i in range(9000)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars int, text string")
    assert rows_of(merkle.merkle_manifest(df, COLUMNS, "source", "doc_id")) == brute(rows, 16)


def test_query_against_sql(spark):
    assert oracle.compare(oracle.connect(SF), op13_merkle_manifest(spark, SF), MANIFEST_SQL) is None


def test_tampering_shows(spark):
    texts = dict(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    for r in op13_merkle_manifest(spark, SF).collect():
        tampered = zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and any("A" <= c <= "Z" for c in texts[r.doc_id])
        assert r.verified is not tampered and (r.folded_root == r.root) is r.verified


def test_empty_and_single(spark, tmp_path):
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    spark.createDataFrame([], schema).write.parquet(str(tmp_path / "documents.parquet"))
    assert op13_merkle_manifest(spark, str(tmp_path)).collect() == []
    one = spark.createDataFrame([(None, None, None, None, None)], schema)
    one.write.parquet(str(tmp_path / "one" / "documents.parquet"))
    (r,) = op13_merkle_manifest(spark, str(tmp_path / "one")).collect()
    assert r.leaf == r.subroot == r.root == r.folded_root == h("-----") and r.proof_sha256 == h() and r.verified
