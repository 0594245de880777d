"""Quality classifier, pseudo-likelihood scores."""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from corpusloom.llm import q_quality
from corpusloom.llm.pseudo_likelihood import (
    SHAPES, Lexicon, Network, Trainer, classes_of, company, distinct_texts, padded, pseudo_likelihood, train, word_counts,
)
from corpusloom.llm.quality import FEATURE_BITS, features, fit, quality_scores
from corpusloom.llm.words import find_words, run_hashes, run_starts, slices, word_hashes
from corpusloom.session import pin

SF = "/root/testdata/sf0.01"


def split(texts, lower=False):
    for _, _, buf, offsets in slices(pa.array(texts)):
        yield find_words(buf, offsets, lower)


def test_words_do_not_depend_on_slices():
    texts = ["Ab  cd\n", None, "", "cd", " x\x0by\x0cz\r\t", "é À", "ab"]
    (words,) = split(texts, lower=True)
    assert [words.text(a, b) for a, b in zip(words.first[:-1], words.first[1:])] == [b"ab cd", b"", b"", b"cd", b"x y z", "é À".encode(), b"ab"]
    hashes = word_hashes(words)
    assert hashes[0] == hashes[-1] and hashes[1] == hashes[2] and len(set(hashes.tolist())) == len(hashes) - 2
    (alone,) = split(["cd"])
    assert word_hashes(alone)[0] == hashes[1]
    assert run_starts(words, 2).tolist() == [0, 3, 4, 6]
    assert run_hashes(hashes, 2).shape == (len(hashes) - 1,)
    assert [w.counts.tolist() for w in split([])] == []


def test_features_are_the_distinct_ngrams():
    texts = ["ab ab ab", "", "x", "ab"]
    (_, _, buf, offsets), = slices(pa.array(texts))
    found = list(features(buf, offsets))
    assert len(found[1]) == 0 and len(found[2]) == 1 and set(found[3]) < set(found[0])
    assert all((np.diff(f) > 0).all() and (f < 1 << FEATURE_BITS).all() for f in found if len(f))


def test_dual_coordinate_descent_separates_and_balances():
    rng = np.random.default_rng(0)
    rows, good = [], np.array([True] * 80 + [False] * 20)
    for label in good:
        rows.append(np.unique(np.concatenate([rng.integers(0, 500, 40), rng.integers(600 if label else 700, 620 if label else 720, 4)])))
    model = fit(rows, good, 0.8)
    assert [model.score(r) >= 0.5 for r in rows] == good.tolist()
    assert fit(rows[:80], good[:80], 1.0).score(rows[0]) == 0.5


def test_repeated_ids_with_different_texts_learn_alike_in_any_order(spark):
    rows = [(i, f"{'good fine' if i % 2 else 'bad junk'} word{i % 9} {side} {i * side}") for i in range(60) for side in (1, 2)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    found = []
    for parts, seed in ((1, 1), (5, 2), (13, 3)):
        mixed = [rows[k] for k in np.random.default_rng(seed).permutation(len(rows)).tolist()]
        docs = spark.createDataFrame(mixed, "doc_id long, text string").repartition(parts)
        found.append(sorted((r.doc_id, r.text, r.score) for r in quality_scores(docs, labels).collect()))
    assert found[0] == found[1] == found[2]


def test_held_out_accuracy(spark):
    rows = {r.doc_id: r for r in q_quality.op1_quality(spark, SF).collect()}
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    labels = dict(spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality").collect())
    right = [rows[i].predicted == y for i, y in labels.items() if rows[i].held_out]
    assert len(right) > 50 and sum(right) / len(right) > 0.93
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for i, r in rows.items())


def test_quality_defined_cases(spark):
    docs = spark.createDataFrame([(1, "good words here", 1.0), (2, "BAD!! BAD!!", 2.0), (None, None, None), (4, "", 3.0), (1, "good words here", 1.0), (5, "a " * 50000, 0.0)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (4, None), (2, 0), (9, 1)], "doc_id long, quality int")
    got = quality_scores(docs, labels).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 for r in got) and got[0].score == got[4].score
    assert all(r.score == 0.5 and r.predicted == 1 for r in quality_scores(docs, labels.limit(0)).collect())
    assert quality_scores(docs.limit(0), labels).collect() == []


def small_model(spark, texts, **kw):
    """Lexicon and trained network of some texts, as the operator makes them."""
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    counts = pin(word_counts(df))
    lexicon = Lexicon.of(counts, kw.get("head", 4096), kw.get("known", 1 << 18))
    distinct = distinct_texts(df, spark.sparkContext.broadcast(lexicon), 1)
    classes = classes_of(company(distinct, lexicon.head, lexicon.border))
    start = Network.start(classes, lexicon, 9)
    return lexicon, classes, start, train(distinct, start, lexicon.border, 9)


def corpus(n=400, words=300, seed=3):
    """Texts of a chain in which the word before and the word behind tell much about a word; rare words between."""
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        at, text = int(rng.integers(words)), []
        for _ in range(int(rng.integers(5, 60))):
            at = (at * 7 + int(rng.integers(3))) % words
            text.append(f"w{at}" if rng.random() < 0.9 else f"{['no', 'Ya', 'x9', 'zz!'][at % 4]}{at}{i if at % 2 else ''}")
        out.append(" ".join(text))
    return out


def test_network_probabilities_sum_to_one_and_training_beats_shares_of_words(spark):
    texts = corpus()
    lexicon, classes, start, net = small_model(spark, texts, head=200)
    assert sorted(np.concatenate(classes).tolist()) == list(range(200)) and max(map(len, classes)) <= 64
    (words,) = split(texts, lower=True)
    tokens, n = lexicon.tokens(words, word_hashes(words))
    assert (n > 0).all() and set(tokens.tolist()) <= set(range(200 + SHAPES))
    row, place = padded(tokens, words.first, lexicon.border)
    around = row[place[:, None] + np.array([-2, -1, 1, 2])]
    assert (around[0, :2] == lexicon.border).all() and around[1, 1] == tokens[0] and (around[words.first[1] - 1, 2:] == lexicon.border).all()
    every = np.arange(200 + SHAPES)
    for context in around[:5]:
        p = np.exp(net.logs(np.repeat(context[None], len(every), axis=0), every))
        assert abs(p.sum() - 1) < 1e-4 and (p > 0).all()
    assert net.logs(around, tokens).mean() > start.logs(around, tokens).mean() + 0.2
    # a changed neighbour changes the prediction: words are predicted and seen as words
    other = around.copy()
    other[:, 1] = (other[:, 1] + 1) % 200
    assert np.abs(net.logs(other, tokens) - net.logs(around, tokens)).max() > 0.1
    again = net.unpack(net.pack())
    assert np.array_equal(again.logs(around, tokens), net.logs(around, tokens))


def test_gradients_agree_with_differences(spark):
    lexicon, _, start, net = small_model(spark, corpus(60, 40), head=30)
    rng = np.random.default_rng(0)
    context, target = rng.integers(0, 30 + SHAPES + 1, (50, 4)), rng.integers(0, 30 + SHAPES, 50)
    moved = {}
    trainer = Trainer(net.unpack(net.pack()))
    trainer._move = lambda name, at, gradient: moved.setdefault(name, []).append((at, gradient.astype(float)))
    trainer.step(context, target)
    for name, place in (("inner", (3,)), ("near", (1, 5)), ("out", (2, 1)), ("bias", (0,)), ("words", (0, 4, 3)), ("word_bias", (0, 2))):
        ends = []
        for step in (1e-2, -1e-2):
            other = net.unpack(net.pack())
            getattr(other, name)[place] += step
            ends.append(other.logs(context, target).mean())
        at, gradient = moved[name][0]
        assert abs((ends[0] - ends[1]) / 2e-2 - gradient[place]) < 2e-4
    rows, gradient = moved["vectors"][0]
    ends = []
    for step in (1e-2, -1e-2):
        other = net.unpack(net.pack())
        other.vectors[rows[2], 6] += step
        ends.append(other.logs(context, target).mean())
    assert abs((ends[0] - ends[1]) / 2e-2 - gradient[2, 6]) < 2e-4


def test_scores_equal_brute_force_in_any_split(spark):
    texts = corpus(200) + ["w1 W2  w1 lonely9 lonely9", "w1 W2  w1 lonely9 lonely9", "", None]
    rows = [(i, t) for i, t in enumerate(texts)]
    lexicon, _, _, net = small_model(spark, texts, head=100, known=150)
    lists = {i: (t or "").lower().split() for i, t in rows}
    total = Counter(w for ws in lists.values() for w in ws)
    (words,) = split(texts, lower=True)
    token_of = dict(zip((w for ws in lists.values() for w in ws), lexicon.tokens(words, word_hashes(words))[0].tolist()))
    by_shape = {}
    for w, t in token_of.items():
        if t >= 100:
            n, k = by_shape.get(t, (0, 0))
            by_shape[t] = n + total[w], k + 1
    assert 100 < len(lexicon.hashes) <= 150 < len(total)  # head, known and joined words
    found = []
    for parts, seed in ((1, 0), (7, 1)):
        mixed = [rows[k] for k in np.random.default_rng(seed).permutation(len(rows)).tolist()]
        df = spark.createDataFrame(mixed, "doc_id long, text string").repartition(parts)
        found.append({r.doc_id: r for r in pseudo_likelihood(df, carry=["doc_id"], head=100, known=150).collect()})
    for i, ws in lists.items():
        own, logs, unseen = Counter(ws), 0.0, 0
        line = [lexicon.border] * 2 + [token_of[w] for w in ws] + [lexicon.border] * 2
        for p, w in enumerate(ws):
            context = np.array([[line[p], line[p + 1], line[p + 3], line[p + 4]]])
            logs += float(net.logs(context, np.array([token_of[w]]))[0])
            if token_of[w] >= 100:
                n, k = by_shape[token_of[w]]
                logs += math.log((total[w] - own[w] + 0.5) / (n - own[w] + 0.5 * k))
                unseen += total[w] == own[w]
        for got in found:
            assert (got[i].n_words, got[i].n_unseen) == (len(ws), unseen)
            assert abs(got[i].pseudo_log_likelihood - logs) < 1e-3 * max(1, len(ws)) and set(got[i].asDict()) == {"doc_id", "n_words", "n_unseen", "pseudo_log_likelihood", "mean_log_probability", "unseen_share"}
    assert found[0][200].n_unseen == 0  # its copy has the same words
    assert all(abs(found[0][i].pseudo_log_likelihood - found[1][i].pseudo_log_likelihood) < 1e-4 * max(1, len(ws)) for i, ws in lists.items())


def test_scores_tell_order_from_disorder(spark):
    rng = np.random.default_rng(1)
    lines = ["red green blue one two three"] * 20
    rows = [(i, " ".join(lines[:20 - i % 10])) for i in range(150)]
    mixed = " ".join(lines).split()
    rng.shuffle(mixed)
    rows += [(1000, " ".join(mixed)), (1001, None), (1002, " \n"), (0, " ".join(lines)), (None, "red"), (1003, "a " * 30000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS N_Words", "'x' AS key", "doc_id AS c0").repartition(2)
    got = {r.doc_id: r for r in pseudo_likelihood(df).collect()}
    assert got[1000].mean_log_probability < got[10].mean_log_probability
    assert got[10].n_words == 120 and abs(got[10].pseudo_log_likelihood - 120 * got[10].mean_log_probability) < 1e-6
    assert got[10].key == "x" and got[10].c0 == 10 and got[10].text == " ".join(lines) and got[1003].n_words == 30000
    assert (got[1001].n_words, got[1001].pseudo_log_likelihood, got[1001].mean_log_probability) == (0, 0.0, None) and got[1002].n_words == 0
    assert pseudo_likelihood(df.limit(0)).collect() == []
    empty = pseudo_likelihood(spark.createDataFrame([(1, None), (1, "")], "doc_id long, text string")).collect()
    assert [(r.n_words, r.n_unseen, r.unseen_share) for r in empty] == [(0, 0, None)] * 2


def test_documents_that_occur_twice_are_told_apart(spark):
    rows = {r.doc_id: r for r in q_quality.op2_pseudo_likelihood(spark, SF).collect()}
    texts = dict(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    times = Counter(texts.values())
    once = sorted(rows[i].unseen_share for i, t in texts.items() if times[t] == 1 and t)
    bar = once[len(once) // 10]  # nine in ten documents without a copy lie above
    twice = [rows[i].unseen_share for i, t in texts.items() if times[t] == 2]
    assert len(twice) > 20 and sum(x <= bar for x in twice) / len(twice) > 0.95


def test_pseudo_likelihood_query_scores_every_document(spark):
    rows = q_quality.op2_pseudo_likelihood(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == 200 and all(r.pseudo_log_likelihood < 0 for r in rows)


def test_workers_hold_little_text_at_a_time():
    import tracemalloc

    texts = pa.array([f"word{i} and some more of them " * 100 for i in range(1000)])
    tracemalloc.start()
    rows = 0
    for i, j, buf, offsets in slices(texts):
        found = find_words(buf, offsets, lower=True)
        rows += len(found.counts)
        assert len(word_hashes(found)) == 600 * (j - i)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 1000 and peak < 48 << 20


def test_words_are_looked_up_as_by_bisection(spark):
    from corpusloom.llm.pseudo_likelihood import _row_max

    rng = np.random.default_rng(4)
    for known in (np.sort(rng.integers(0, 2**64, 3000, dtype=np.uint64)), np.arange(40, dtype=np.uint64), np.array([2**64 - 1], np.uint64)):
        lexicon = Lexicon(known, np.ones(len(known), np.int64), np.zeros(len(known), np.uint16), np.zeros(0, np.int64), np.zeros(SHAPES), np.zeros(SHAPES))
        asked = np.concatenate([known, known + np.uint64(1), rng.integers(0, 2**64, 5000, dtype=np.uint64), np.array([0, 2**64 - 1], np.uint64)])
        assert np.array_equal(lexicon._places(asked), np.searchsorted(known, asked))
    for width in (1, 2, 5, 64, 81):
        x = rng.normal(size=(50, width)).astype(np.float32)
        assert np.array_equal(_row_max(x)[:, 0], x.max(axis=1))


def test_rare_words_come_with_the_distinct_texts(spark):
    texts = ["a b b rare1 rare1 rare2", "a b b rare1 rare1 rare2", "a  B b rare1", "a b a a", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    lexicon = Lexicon.of(word_counts(df), 2, 2)
    rows = distinct_texts(df, spark.sparkContext.broadcast(lexicon), 2).collect()
    assert sorted(len(r.rare) // 8 for r in rows) == [0, 1, 3] and len({r.key for r in rows}) == 3


def test_short_rows_are_worked_on_in_bulk(monkeypatch):
    from corpusloom.llm import pseudo_likelihood as module

    rng = np.random.default_rng(5)
    # no pass for the largest logit of each row unless float32 needs it
    calls = []
    monkeypatch.setattr(module, "_row_max", lambda x: calls.append(1) or x.max(axis=1, keepdims=True))
    target = rng.integers(0, 80, 500)
    for shift, passes in ((0, 0), (200, 1), (-200, 1)):
        calls.clear()
        logits = rng.normal(size=(500, 80)) + shift
        logits[:, 3] = -1e4  # no word there
        target[target == 3] = 4
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        got = module._log_softmax(logits.astype(np.float32), target)
        error = module._softmax_error(logits.astype(np.float32), target)
        assert len(calls) == 2 * passes and np.abs(got - np.log(p[np.arange(500), target])).max() < 1e-4
        assert np.abs(error - (np.eye(80)[target] - p)).max() < 1e-5 and np.isfinite(error).all()
    assert module._log_softmax(np.zeros((0, 80), np.float32), np.zeros(0, np.int64)).shape == (0,)
    for n in (0, 3, 8, 21):
        rows, by = rng.normal(size=(n, 24)).astype(np.float32), rng.normal(size=24).astype(np.float32)
        assert np.array_equal(module._times(rows, by, out=np.empty_like(rows)), rows * by)


def test_bytes_are_told_apart_and_hashed_as_by_tables():
    rng = np.random.default_rng(6)
    texts = [bytes(range(256)), b"", b" ", b"word " * 20000, b"Zz@[`{"] + [rng.integers(0, 256, int(k), dtype=np.uint8).tobytes() for k in rng.integers(0, 300, 300)]
    from corpusloom.llm.pseudo_likelihood import _runs, _summed, shapes_of
    from corpusloom.llm.words import _BYTE, _powers, mix

    for _, _, buf, offsets in slices(pa.array(texts, pa.large_binary())):
        found = find_words(buf, offsets, lower=True)
        lists = [t.translate(bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))).split() for t in texts]
        whole = [w for ws in lists for w in ws]
        assert found.counts.tolist() == [len(ws) for ws in lists]
        assert [found.buf[a:b].tobytes() for a, b in zip(found.start, found.end)] == whole
        up = _powers(1 << 10)[0]
        one = lambda w: mix(np.array([int((_BYTE[np.frombuffer(w, np.uint8)] * up[:len(w)]).sum()) + len(w) * 0xD6E8FEB86659FD93 & 2**64 - 1], np.uint64))[0]
        hashes = word_hashes(found)
        assert hashes.tolist() == [one(w) for w in whole]  # blocks of bytes carry on where the last one ended
        kind = lambda b: 0 if b in b"aeiou" else 1 if 97 <= b <= 122 else 2 if 48 <= b <= 57 else 3
        assert shapes_of(found).tolist() == [min((len(w) - 1) // 3, 3) * 4 + kind(w[-1]) for w in whole]
        total, doc = Counter(hashes.tolist()), found.doc()
        h, shape, n = _summed(hashes, shapes_of(found))
        assert dict(zip(h.tolist(), n.tolist())) == total and dict(zip(h.tolist(), shape.tolist())) == dict(zip(hashes.tolist(), shapes_of(found).tolist()))
        place, times = _runs(doc, hashes)
        assert dict(zip(zip(doc[place].tolist(), hashes[place].tolist()), times.tolist())) == Counter(zip(doc.tolist(), hashes.tolist()))


def test_workers_use_freed_memory_again():
    import subprocess
    import sys

    code = """
import resource, sys
import numpy as np
from corpusloom.llm import words
if sys.argv[1] == "keep":
    words.keep_memory()
faults = lambda: resource.getrusage(resource.RUSAGE_SELF).ru_minflt
for i in range(60):
    if i == 10:
        start = faults()
    arrays = [np.ones(400_000, np.float32) for _ in range(5)]
    del arrays
print(faults() - start)
words.release()
"""
    run = lambda how: int(subprocess.run([sys.executable, "-c", code, how], capture_output=True, text=True, check=True, cwd=".").stdout)
    assert run("keep") < run("plain") / 10


def test_company_counts_neighbours_within_texts_only(spark):
    texts = [[0, 1, 0, 5], [], [1], [1, 0], [5, 6, 9, 1, 1]]
    rows = [(np.array(t, np.uint16).tobytes(),) for t in texts]
    expected = np.zeros((6, 12))
    for t in texts:
        for a, b in zip(t, t[1:]):
            if b < 6 and a < 6:
                expected[b, a] += 1
                expected[a, 6 + b] += 1
    for parts in (1, 3):
        assert np.array_equal(company(spark.createDataFrame(rows, "tokens binary").repartition(parts), 6, 9), expected)
