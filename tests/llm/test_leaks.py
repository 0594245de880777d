"""Benchmark passages in documents."""

import random
import tracemalloc

import numpy as np

from corpusloom.llm import q_leaks
from corpusloom.llm.decontaminate import TERM_BITS, Searcher, contaminated, cut_items, fold_words, latent_basis, lcs, read_item
from corpusloom.llm.words import word_hashes

SF = "/root/testdata/sf0.01"


def folded(text):
    raw = (text or "").encode()
    words = fold_words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
    return b" " + words.text(0, len(words.start)) + b" "


def test_lcs_equals_the_table():
    rng = random.Random(1)
    for _ in range(200):
        a, b = ([rng.randrange(6) for _ in range(rng.randrange(15))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert lcs(a, b) == table[-1][-1]


def test_pieces_cover_items():
    for n in (1, 5, 8, 20, 47, 48, 60, 72, 73, 200):
        item = read_item(0, " ".join(f"w{i}" for i in range(n)))
        assert sum(len(p.terms) for p in cut_items([item])) >= n and 0 <= item.answer < n
    assert read_item(0, "one two three. four five.").answer == 3


def test_every_inserted_item_is_found_and_nothing_else(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    inside = {(d.doc_id, i.item_id) for i in items for d in docs if folded(i.text) in folded(d.text)}
    got = {(r.doc_id, r.item_id): r for r in q_leaks.op4_benchmark_leaks(spark, SF).collect()}
    assert inside and inside <= set(got)
    assert all(r.lcs_share >= 0.6 for r in got.values()) and len(set(got) - inside) <= 0.1 * len(inside)


def test_paraphrases_long_items_and_defined_cases(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("bcdfgaeiou") for _ in range(rng.randrange(2, 7)))
    noise = lambda n: " ".join(word() for _ in range(n))
    items = [(1, noise(30)), (2, noise(150)), (3, "tiny item here now"), (4, None), (5, ""), (6, noise(9))]
    one = items[0][1].split()
    changed = [w if rng.random() > 0.15 else word() for w in one]
    docs = [(10, noise(100) + " " + items[0][1].upper() + ", " + noise(50)), (11, noise(40) + " " + " ".join(changed) + " " + noise(40)), (12, noise(20) + items[1][1] + noise(9)),
            (13, noise(7) + " Tiny item, here now. " + noise(30)), (14, noise(500)), (15, None), (16, ""), (None, items[0][1]), (10, items[0][1]), (17, " ".join(one[:8])), (18, noise(20000) + " " + items[5][1])]
    docs = spark.createDataFrame([(i, t, "z") for i, t in docs], "doc_id long, text string, item_id string")
    bench = spark.createDataFrame(items, "item_id int, text string")
    got = sorted((r[0], r[1]) for r in contaminated(docs, bench).collect())
    assert got == [(10, 1), (11, 1), (12, 2), (13, 3), (18, 6)]
    assert contaminated(docs.limit(0), bench).collect() == [] and contaminated(docs, bench.limit(0)).collect() == []


def test_paraphrases_without_their_rarest_words(spark):
    """A paraphrase that keeps enough words is found also if the words it lacks carry most of the weight."""
    rng = random.Random(5)
    common = [f"c{k}" for k in range(60)]
    noise = lambda n: [rng.choice(common) if rng.random() < 0.3 else f"n{rng.randrange(3000)}" for _ in range(n)]
    items, docs = [], []
    for k in range(30):
        words = [rng.choice(common) if j % 3 else f"rare{k}x{j}" for j in range(36 if k % 2 else 90)]
        items.append((k, " ".join(words)))
        changed = [w if w in common else f"n{rng.randrange(3000)}" for w in words]
        docs.append((k, " ".join(noise(40) + changed + noise(40))))
    docs += [(100 + k, " ".join(noise(300))) for k in range(100)]
    got = {(r.doc_id, r.item_id) for r in contaminated(
        spark.createDataFrame(docs, "doc_id int, text string"), spark.createDataFrame(items, "item_id int, text string"), least_cosine=0.1).collect()}
    assert {(k, k) for k in range(30)} <= got


def test_the_bound_is_never_below_the_subsequence():
    rng = random.Random(6)
    items = [read_item(k, " ".join(f"w{rng.randrange(40)}" for _ in range(rng.choice((3, 12, 64, 65, 200))))) for k in range(40)]
    searcher = Searcher(items, cut_items(items), np.ones((1 << 16, 4), np.float32), np.ones(1 << 16), 0.5, 0.6, 0.4)
    raw = " ".join(f"w{rng.randrange(60)}" for _ in range(3000)).encode()
    hashes = word_hashes(fold_words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)])))
    low = np.array([rng.randrange(2900) for _ in range(2000)])
    high = np.minimum(low + np.array([rng.randrange(1, 400) for _ in range(2000)]), len(hashes))
    item = np.array([rng.randrange(40) for _ in range(2000)])
    got = searcher.possible(hashes, low, high, item)
    enough = np.array([lcs(items[i].words.tolist(), hashes[a:b].tolist()) >= searcher.need[i] for a, b, i in zip(low, high, item)])
    assert enough.any() and not (enough & ~got).any() and not got.all()


def test_the_driver_holds_rows_for_the_terms_of_the_benchmark_only(spark):
    """The basis and what is broadcast follow the passages, not all hashed terms; what is found is the same."""
    rng = random.Random(7)
    items = [(k, " ".join(f"w{rng.randrange(900)}" for _ in range(rng.choice((6, 40, 70))))) for k in range(150)]
    docs = [(k, " ".join(f"w{rng.randrange(3000)}" for _ in range(60)) + " " + items[k % 150][1]) for k in range(300)]
    frame = spark.createDataFrame(docs, "doc_id int, text string").repartition(2).cache()
    bench = spark.createDataFrame(items, "item_id int, text string")
    frame.count()
    tracemalloc.start()
    try:
        found = contaminated(frame, bench)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert {(r.doc_id, r.item_id) for r in found.collect()} >= {(k, k % 150) for k in range(300)}
    assert peak < 16 << 20  # 2**16 terms took over 50 MB
    read = [read_item(*item) for item in items]
    passages, weight = cut_items(read), np.random.default_rng(1).random(1 << TERM_BITS) + 0.1
    terms, basis = latent_basis(frame, passages, weight, 3)
    assert set(terms.tolist()) == {t for p in passages for t in p.terms.tolist()} and np.allclose(basis.T @ basis, np.eye(basis.shape[1]), atol=1e-4)
    whole = np.zeros((1 << TERM_BITS, basis.shape[1]), np.float32)
    whole[terms] = basis
    raw = "\n".join(text for _, text in docs).encode()
    words = fold_words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
    few, all_ = (sorted(Searcher(read, passages, *x).search(words)) for x in ((basis, weight, 0.5, 0.6, 0.4, terms), (whole, weight, 0.5, 0.6, 0.4)))
    assert few == all_ and len(few) > 100
