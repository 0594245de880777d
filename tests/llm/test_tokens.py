"""Token ids and prefix counts against the libraries of the vocabulary files."""

import base64
import hashlib
import random

import public_tokenizers as tok
import pytest
import tiktoken
from tokenizers import Tokenizer

from corpusloom.llm import q_tokens
from corpusloom.llm.bpe import Encoder, bpe_decode, bpe_encode, load_ranks
from corpusloom.llm.prefix_counts import PrefixCounter, count_tokens

SF = "/root/testdata/sf0.001"
ALPHABET = [*" \n\t'srelvéßüçaab1２³Ⅷ!?#　\x1c\x85​漢字🙂", "<|endoftext|>", "'re", "'ll", "the", "   ", "\r\n"]


def samples(seed, n, sizes=(0, 1, 3, 9, 40)):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.choice(sizes))) for _ in range(n)]


@pytest.fixture(scope="module")
def library():
    with open(tok.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=tok.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_segment_tree_merges_like_the_library(library):
    own = Encoder(load_ranks(q_tokens.RANKS), tok.PATTERN)
    for text in [*samples(1, 800), "ab" * 3000 + "!" * 500, "a" * 65, "é" * 33, "x" * 64]:
        ids, counts = own.encode([text, "", text])
        want = library.encode_ordinary(text)
        assert ids.tolist() == want + want and counts.tolist() == [len(want), 0, len(want)]
        assert own.decode(ids)[0].tobytes() == (text + text).encode()
        if len(text.encode()) > 1:
            assert own.merge_one(text.encode()) == [int(x) for x in own.merge_many([text.encode()], 1 << (len(text.encode()) - 1).bit_length())[0]]


def test_a_full_cache_starts_afresh(library, monkeypatch):
    monkeypatch.setattr("corpusloom.llm.bpe.CACHE_PIECES", 3)
    own = Encoder(load_ranks(q_tokens.RANKS), tok.PATTERN)
    for text in samples(5, 60):
        assert own.encode([text])[0].tolist() == library.encode_ordinary(text)


def test_encode_and_decode_keep_other_columns(spark, library):
    rows = [(1, "a b", "k"), (1, "a b", "k"), (None, None, None), (2, "", "x"), (3, "Ünï " * 20000, "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, IDS string").withColumnRenamed("IDS", "Ids")
    coded = bpe_encode(df, q_tokens.RANKS, tok.PATTERN)
    assert coded.columns == ["doc_id", "text", "ids"]
    back = bpe_decode(coded, q_tokens.RANKS, tok.PATTERN).collect()
    assert len(back) == 5 and all(bytes(r.decoded).decode() == (r.text or "") and r.ids == library.encode_ordinary(r.text or "") for r in back)
    assert bpe_encode(df.limit(0), q_tokens.RANKS, tok.PATTERN, decoded="d").collect() == []


def test_round_trip_query(spark, library):
    texts = dict(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    for r in q_tokens.op7_bpe_roundtrip(spark, SF).collect():
        ids = library.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_every_prefix_count_is_exact():
    own, library = PrefixCounter(q_tokens.TOKENIZER, tok.PATTERN), Tokenizer.from_file(q_tokens.TOKENIZER)
    count = lambda s: len(library.encode(s, add_special_tokens=False).ids)
    for text in samples(2, 250, (0, 1, 4, 25)):
        want = [count(text[:i]) for i in range(len(text) + 1)]
        assert own.prefix_counts(text) == want
        pieces, counts = own.pieces(text)
        assert sum(counts) == want[-1]
        for limit in (0, 1, 3, 8):
            assert own.fitting(text, pieces, counts, limit) == max(i for i, n in enumerate(want) if n <= limit)


def test_count_query_and_defined_cases(spark):
    library = Tokenizer.from_file(q_tokens.TOKENIZER)
    texts = dict(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    for r in q_tokens.op9_token_counts(spark, SF).collect():
        n = len(library.encode(texts[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 512)
    df = spark.createDataFrame([(1, None, 5), (1, None, 5), (None, "", 6), (2, "<|endoftext|>a", 7), (3, "wo " * 50000, 8)], "id long, text string, N_TOKENS long")
    got = count_tokens(df, q_tokens.TOKENIZER, tok.PATTERN, 4, prefix_table=True).drop("text").collect()
    assert [(r.id, r.n_bytes, r.n_tokens, r.over_limit, r.fit_chars) for r in got[:4]] == [(1, 0, 0, False, 0), (1, 0, 0, False, 0), (None, 0, 0, False, 0), (2, 14, 2, False, 14)]
    assert got[4].over_limit and len(got[4].prefix_tokens) == 150001
    assert count_tokens(df.limit(0), q_tokens.TOKENIZER, tok.PATTERN, 4).collect() == []
