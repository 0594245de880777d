"""Piece ids and decoded texts against the library of the model file."""

import hashlib
import random

import numpy as np
import pytest
import sentencepiece

from corpusloom.llm import q_tokens
from corpusloom.llm.piece_bpe import PieceEncoder, piece_decode, piece_encode

SF = "/root/testdata/sf0.001"
SIGNS = [*" \n\t\r\x0b\x0c'srelvéßüçaab1２³Ⅷ!?#　\x1c\x85​漢字🙂▁\x00", "<s>", "</s>", "<unk>", "<0x41>", "the", "   ", "\r\n", "        ", "();"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=q_tokens.PIECES)


@pytest.fixture(scope="module")
def own():
    return PieceEncoder(q_tokens.PIECES)


def samples(library, seed):
    rng = random.Random(seed)
    pieces = [library.id_to_piece(i) for i in range(259, library.get_piece_size())]
    texts = ["".join(rng.choice(SIGNS) for _ in range(rng.choice((0, 1, 3, 9, 40, 200)))) for _ in range(1500)]
    texts += ["".join(rng.choice(pieces) for _ in range(rng.choice((2, 5, 30)))) for _ in range(1500)]
    texts += ["".join(rng.choice(pieces).strip("▁") for _ in range(60)) for _ in range(200)]  # one long word each
    return texts + [sign * n for n in range(1, 70) for sign in (" ", "a", "▁ ", "\n", "=")] + ["ab" * 3000, "\n\n a"]


def test_rounds_merge_like_the_library(library, own):
    texts = samples(library, 1)
    ids, counts = own.encode(texts)
    ends = np.concatenate([[0], np.cumsum(counts)])
    decoded = own.decode(ids, counts)
    for i, want in enumerate(library.encode(texts)):
        assert ids[ends[i]:ends[i + 1]].tolist() == want, texts[i]
        assert decoded[i] == library.decode(want) == texts[i].replace("▁", " ")


def test_any_ids_decode_like_the_library(library, own):
    rng = random.Random(2)
    for _ in range(1500):
        ids = [rng.randrange(32000) if rng.random() < 0.5 else rng.randrange(259) for _ in range(rng.choice((0, 1, 2, 8)))]
        assert own.decode(np.array(ids, np.int64), np.array([len(ids)])) == [library.decode(ids)]
    with pytest.raises(ValueError):
        own.decode(np.array([32000]), np.array([1]))


def test_a_full_store_keeps_the_last_words(library, monkeypatch):
    monkeypatch.setattr("corpusloom.llm.piece_bpe.CACHE_WORDS", 3)
    monkeypatch.setattr("corpusloom.llm.piece_bpe.MERGE_CHARS", 5)
    own = PieceEncoder(q_tokens.PIECES)
    for text in samples(library, 3)[::7]:
        assert own.encode([text, text])[0].tolist() == 2 * library.encode(text)


def test_other_models_are_refused(tmp_path):
    unigram = bytes([0x0A, 3, 0x0A, 1, 0x61, 0x12, 2, 0x18, 1])  # one piece, model type 1
    (tmp_path / "m").write_bytes(unigram)
    with pytest.raises(ValueError):
        PieceEncoder(str(tmp_path / "m"))


def test_columns_and_defined_cases(spark, library):
    rows = [(1, "a b", "k"), (1, "a b", "k"), (None, None, None), (2, "", "x"), (3, "Ünï " * 20000, "y"), (4, "x" * 50000, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, IDS string").withColumnRenamed("IDS", "Ids")
    coded = piece_encode(df, q_tokens.PIECES)
    assert coded.columns == ["doc_id", "text", "ids"]
    back = piece_decode(coded, q_tokens.PIECES).collect()
    assert len(back) == 6 and all(r.decoded == (r.text or "") and r.ids == library.encode(r.text or "") for r in back)
    assert piece_encode(df.limit(0), q_tokens.PIECES, decoded="d").collect() == []
    nulls = spark.createDataFrame([(1, None), (2, [])], "id long, ids array<int>")
    assert [r.decoded for r in piece_decode(nulls, q_tokens.PIECES).collect()] == ["", ""]


def test_round_trip_query(spark, library):
    texts = dict(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    rows = q_tokens.op11_piece_roundtrip(spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id])
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
