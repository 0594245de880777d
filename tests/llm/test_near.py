"""Near copies: n-gram join, repeated passages and cap filters against brute force."""

import random

import brute
import numpy as np
import pytest

from corpusloom.llm import ngram_join as ngram_module
from corpusloom.llm import q_near
from corpusloom.llm.cap_filters import AT_LEAST, ProductCode, near_vectors
from corpusloom.llm.components import components
from corpusloom.llm.ngram_join import InvertedLists, ngram_join, recurring
from corpusloom.llm.substrings import repeated_passages

SF = "/root/testdata/sf0.001"


def texts(seed, n=60):
    """Documents with copies, edited copies, shared passages, short and empty ones."""
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghij") + rng.choice("klmnop") + str(rng.randrange(30))
    shared = [word() for _ in range(40)]
    base = [[word() for _ in range(rng.choice([0, 1, 3, 5, 12, 13, 60, 200]))] for _ in range(n // 3)]
    out = []
    for i in range(n):
        words = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2, 6]) if words else 0):
            words[rng.randrange(len(words))] = word()
        if rng.random() < 0.3:
            at = rng.randrange(len(words) + 1)
            words[at:at] = shared[rng.randrange(20):]
        sep = rng.choice([" ", "\n", "\t  ", "\x0b"])
        out.append((i * 3 % 101, sep.join(w.upper() if rng.random() < 0.02 else w for w in words)))
    return out + [(500, None), (501, ""), (502, " \t\n"), (503, "x" * 3000), (504, "é " * 4000)]


@pytest.mark.parametrize("seed", [1, 2])
def test_ngram_join_equals_brute_force(spark, many_partitions, seed):
    rows = texts(seed)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute.ngram_groups(rows)


def test_ngram_join_on_a_large_group_of_edited_copies(spark, many_partitions):
    rng = random.Random(3)
    base = [f"w{i}" for i in range(120)]
    rows = [(10_000, " ".join(base))]
    for i in range(700):
        words = list(base)
        for at in rng.sample(range(120), 3):
            words[at] = f"e{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute.ngram_groups(rows)


def test_ngram_join_defined_cases(spark):
    long = " ".join(f"t{i}" for i in range(50))
    rows = [(7, long, "a"), (7, long, "b"), (None, long, "c"), (3, long.upper(), None), (9, None, "d"), (9, None, "d")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_shingles string")
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id) for r in ngram_join(df).collect())
    assert got == [(False, 3, 46, 3), (False, 7, 46, 3), (False, 7, 46, 3), (False, 9, 0, 9), (False, 9, 0, 9), (True, 0, 46, 3)]
    assert ngram_join(df.limit(0)).collect() == []


def test_lists_find_what_plain_counting_finds():
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 50)).astype(np.uint64)) for _ in range(80)]
    lists = InvertedLists(sets)
    for query in sets[:30]:
        want = [i for i, x in enumerate(sets) if 100 * len(np.intersect1d(query, x)) >= 75 * len(np.union1d(query, x))]
        assert sorted(lists.linked(query, 75)) == want


@pytest.mark.parametrize("size", [1, 2, 3, 7, 100])
def test_recurring_is_the_same_for_any_batches(size):
    import pyarrow as pa

    rng = np.random.default_rng(1)
    rows = sorted(zip(rng.integers(0, 30, 60).tolist(), rng.integers(0, 4, 60).tolist()))
    batches = [pa.RecordBatch.from_pydict({"h": [r[0] for r in rows[i:i + size]], "s": [r[1] for r in rows[i:i + size]]}) for i in range(0, len(rows), size)]
    got = [tuple(r.values()) for b in recurring(iter(batches)) for r in b.to_pylist()]
    distinct = sorted(set(rows))
    assert got == [r for r in distinct if sum(x[0] == r[0] for x in distinct) > 1]


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i + 1, i) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(200, 200), (300, 301), (301, 300)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert all(got[i] == 0 for i in range(41)) and all(got[i] == 100 for i in range(100, 130)) and got[301] == 300
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


@pytest.mark.parametrize("seed", [4, 5])
def test_repeated_passages_equal_brute_force(spark, many_partitions, seed):
    rows = texts(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    q = repeated_passages(df).selectExpr("doc_id", "n_words", "n_removed", "coalesce(sha2(kept, 256), words_sha256)", "spans")
    got = q.collect()
    assert sorted(tuple(r)[:4] for r in got) == sorted(brute.passages(rows))
    assert all(sum(s.end - s.first for s in r.spans) == r.n_removed for r in got)


def test_many_texts_under_one_id(spark, many_partitions):
    rng = random.Random(8)
    shared = " ".join(f"s{i}" for i in range(30))
    other = " ".join(f"o{i}" for i in range(20))
    rows = [(1, f"a{i} " * rng.randrange(40) + (shared if i % 2 else other) + f" b{i}" * rng.randrange(30)) for i in range(200)]
    rows += [(2, "x y z " + shared), (3, other + " tail " + shared), (3, other + " tail " + shared), (0, "head " + " ".join(f"o{i}" for i in range(15)))]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = repeated_passages(df).selectExpr("doc_id", "n_words", "n_removed", "coalesce(sha2(kept, 256), words_sha256)").collect()
    assert sorted(map(tuple, got)) == sorted(brute.passages(rows))


def test_repeated_passages_defined_cases(spark):
    long = " ".join(f"t{i}" for i in range(30))
    rows = [(5, long), (5, long), (5, "x " + long), (None, long), (8, long), (9, "a b " + long + " c"), (10, None), (11, "t1 t2")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'k' AS kept", "1 AS n_words")
    got = repeated_passages(df).selectExpr("doc_id", "n_words", "n_removed", "coalesce(sha2(kept, 256), words_sha256)").collect()
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(map(key, got)) == sorted(map(key, brute.passages(rows)))
    assert repeated_passages(df.limit(0)).collect() == []


def test_near_vectors_equal_brute_force_and_recall(spark, many_partitions):
    rng = np.random.default_rng(2)
    rows, centres = [], rng.standard_normal((25, 32))
    for i in range(900):
        vector = centres[rng.integers(0, 25)] + rng.normal(0, rng.choice([0.0, 0.05, 0.14]), 32)
        rows.append((i, [float(x) for x in vector * rng.choice([1.0, 3.0])], int(rng.integers(0, 3))))
    rows += [(1000, None, 1), (1001, [0.0] * 32, 1), (1002, [float("nan")] * 32, 1), (1003, rows[0][1], None), (1004, [1.0, None], 1), (1005, [], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_vectors(df).collect()}
    want = brute.near_vectors(rows)
    assert set(got) == set(want)
    assert sum(n for n, _ in got.values()) >= 0.99 * sum(n for n, _ in want.values())
    assert all(got[i][0] <= want[i][0] for i in want)
    assert all(r.kept == (r.vec_id == r.component_id) for r in near_vectors(df.limit(50)).collect())
    assert near_vectors(df.limit(0)).collect() == []


@pytest.mark.parametrize("size", [3, 12, 64])
def test_caps_list_all_exceeding_directions(size):
    rng = np.random.default_rng(7)
    code = ProductCode(size, 60, 0.98, 5)
    x = rng.standard_normal((40, size))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    scores = np.zeros((40, 1))
    for axes, book in zip(code.cuts, code.books):
        scores = (scores[:, :, None] + ((x @ code.rotation)[:, axes] @ book.T)[:, None, :]).reshape(40, -1)
    for row, found in zip(scores, code.decode(x)):
        threshold = code.threshold
        while (row >= threshold).sum() < AT_LEAST:
            threshold -= 0.2 / np.sqrt(size)
        assert found.tolist() == np.flatnonzero(row >= threshold).tolist()


@pytest.mark.parametrize("points", [10**3, 10**6, 10**9])
@pytest.mark.parametrize("size", [16, 64])
def test_recall_of_codes_for_larger_tables(points, size):
    rng = np.random.default_rng(3)
    code = ProductCode(size, points, 0.98, 5)
    x, z = rng.standard_normal((2, 1500, size))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z -= (z * x).sum(axis=1, keepdims=True) * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    pairs = zip(code.decode(x), code.decode(0.98 * x + np.sqrt(1 - 0.98**2) * z))
    assert np.mean([len(np.intersect1d(a, b)) > 0 for a, b in pairs]) >= 0.99


def test_near_vectors_counts_a_large_group_of_equal_vectors(spark):
    rows = [(i, [1.0, 2.0, 3.0], 1) for i in range(600)] + [(i, [1.0, 2.0, 3.001], 1) for i in range(600, 610)] + [(700, [1.0, 2.0, 3.0], 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr("*", "0 AS n_links")
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_vectors(df).collect()}
    assert got == {i: (609, 0) for i in range(610)} | {700: (0, 700)}


def test_registered_queries_on_whole_tables(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in q_near.op3_ngram_join(spark, SF).collect()}
    assert got == brute.ngram_groups(docs)
    assert sorted(map(tuple, q_near.op8_substring_dedup(spark, SF).collect())) == sorted(brute.passages(docs))
    vectors = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    got = {r.vec_id: (r.n_links, r.component_id) for r in q_near.op5_cap_filters(spark, SF).collect()}
    assert got == brute.near_vectors(vectors)


def edited_copies(seed, n, edits, words=120):
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(words)]
    rows = [(10_000, " ".join(base))]
    for i in range(n):
        copy = list(base)
        for at in rng.sample(range(words), rng.choice(edits)):
            copy[at] = f"e{rng.randrange(10**6)}"
        rows.append((i, " ".join(copy)))
    return rows


def test_ngram_join_searches_few_of_the_pairs_of_a_large_group(spark, many_partitions, monkeypatch):
    rows = edited_copies(5, 300, [2, 3, 4, 5])
    searched = []

    def search_blocks(members, sets, percent, marks=False):
        if marks:
            searched.append(members.count())
        return original(members, sets, percent, marks)

    original = ngram_module.search_blocks
    monkeypatch.setattr(ngram_module, "search_blocks", search_blocks)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute.ngram_groups(rows)
    assert len({c for _, c in got.values()}) > 20
    assert len(searched) == 1 and searched[0] < 10 * len(rows)


def test_ngram_join_deals_hot_n_grams_by_set_and_cuts_their_sets_into_cells(spark, many_partitions, monkeypatch):
    for name, value in {"HOT_BITS": 3, "BUCKET_BITS": 3, "PAIR_CELL": 8, "FLUSH": 500, "PACKED": 7, "PAIRS": 50, "AT_ONCE": 64}.items():
        monkeypatch.setattr(ngram_module, name, value)
    rows = texts(7) + [(i + 1000, t) for i, t in edited_copies(6, 60, [1, 3, 4, 6])] + [(2000, "w0 w1"), (2001, "W0 w1"), (2002, "w0")]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()}
    assert got == brute.ngram_groups(rows)


def test_pairs_within_keeps_the_first_common_n_gram_of_linked_sets():
    rng = np.random.default_rng(4)
    base, pairs, wanted = rng.choice(2**40, 90, replace=False), set(), set()
    sets = [np.unique(np.where(rng.random(90) < rng.choice([0.02, 0.1, 0.2]), rng.integers(0, 2**40, 90), base)[rng.integers(0, 6):]) for _ in range(50)]
    df = {h: sum(h in x for x in map(set, sets)) for h in np.unique(np.concatenate(sets)).tolist()}
    rows = []
    for s, x in enumerate(sets):
        marks = sorted(x.tolist(), key=lambda h: (df[h], h))[:ngram_module.extended_length(len(x), 75)]
        marks = [h for h in marks if df[h] > 1]
        rows += [(h, s, len(x), s % 7, len(marks) - i, s % 3 > 0 or s % 7 > 0) for i, h in enumerate(marks)]
    h, s, n, c, left, query = (np.array(x) for x in zip(*sorted(rows)))
    first = np.flatnonzero(np.diff(h, prepend=-1))
    for found in ngram_module.pairs_within(first, s, n, c, left, query, 75):
        pairs |= set(map(tuple, found.tolist()))
    for a in range(50):
        for b in range(a):
            shared = len(np.intersect1d(sets[a], sets[b]))
            if 100 * shared >= 75 * (len(sets[a]) + len(sets[b]) - shared) and a % 7 != b % 7:
                wanted.add((b, a))
    assert wanted <= pairs and wanted and len(pairs) < 50 * 49 // 2
