"""SentencePiece operator against the sentencepiece library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from vigia.llm import sentencepiece_bpe as bpe
from vigia.llm.queries import op3_sentencepiece

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def vocab():
    return bpe.Vocabulary(bpe.read_model(MODEL))


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def sample_texts(n=1500, seed=3):
    rng = random.Random(seed)
    words = ("the of and thing internationalization Ouwhea aaaaaaaa banana mississippi éèê größe Straße "
             "niño 中文字 日本語 😀😃 <s> </s> <unk> <0x0A> ▁ 000000 12345 http://x.y/z don't --- .... ((( "
             "İ ſK \x00 \x7f ﬁ").split(" ")
    gaps = [" ", "  ", "   ", "\n", "\n\n", "\t", " \n ", "", "         ", "\r\n", " "]
    out = ["", " ", "  ", "\n", "▁", "a", " a", "a ", "<unk>", "x" * 3000, " " * 50, " " * 200_003 + "the", "\t" + " " * 77 + "\n" + " " * 64, "ab" * 2000, "\n \n"]
    for _ in range(n):
        out.append("".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randrange(1, 25))))
    for _ in range(n):
        out.append("".join(chr(rng.choice([rng.randrange(1, 128), rng.randrange(128, 0x800),
                                           rng.randrange(0x4E00, 0x5000), 0x1F600, 32, 32, 97, 101, 116]))
                           for _ in range(rng.randrange(1, 80))))
    return out


def test_encode_and_decode_equal_library(vocab, library):
    texts = sample_texts()
    got = vocab.encode_batch(texts)
    for t, x in zip(texts, got, strict=True):
        ids = np.frombuffer(x, "<u4").tolist()
        assert ids == library.encode(t), repr(t)
        assert vocab.decode(np.array(ids, dtype=np.int64)).decode() == library.decode(ids), repr(t)


def test_decode_of_any_ids_equals_library(vocab, library):
    rng = random.Random(5)
    for _ in range(2000):
        ids = [rng.choice([rng.randrange(0, 32000), rng.randrange(0, 300), 1, 2, 13]) for _ in range(rng.randrange(0, 20))]
        assert vocab.decode(np.array(ids, dtype=np.int64)).decode() == library.decode(ids), ids


def test_query_equals_library(spark, library, tmpdir_path):
    rows = [(1, "Hello  world\nnew é"), (2, None), (3, ""), (4, "x" * 200_000), (4, "x" * 200_000), (None, "a b")]
    spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'k' as ids", "1 as n_tokens") \
        .write.parquet(f"{tmpdir_path}/documents.parquet")
    got = sorted(map(tuple, op3_sentencepiece(spark, tmpdir_path).collect()), key=str)
    want = []
    for i, t in rows:
        ids = library.encode(t or "", add_bos=True, add_eos=True)
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    assert got == sorted(want, key=str)


def test_general_operator_round_trip_and_empty_table(spark):
    df = spark.createDataFrame([("a  b\nc", 1), (None, 2)], "text string, ids int")
    out = bpe.decode(bpe.encode(df, MODEL).drop("decoded"), MODEL).collect()
    assert [r["decoded"] for r in out] == ["a  b\nc", ""]
    assert bpe.encode(df.limit(0), MODEL).count() == 0
