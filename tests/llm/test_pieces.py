import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from tidemark.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    "", " ", "   ", "a", " a", "a ", "a  b   c", "▁", "▁▁a ▁b", "a▁b", "\n", "a\nb\r\n\tc", "日本語 テスト 🎉🏳️‍🌈", "<s> </s> <unk> <0x0A>",
    "\x00 \x01x", "é é ﬁ", " x　y", "x" * 3000, " " * 100 + "end", "…—“”", "� ﻿a", "a" + "\U0010ffff" + "b",
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def table():
    with open(PATH, "rb") as file:
        return pieces.ChunkTable(file.read(), size=500)


def same(table, library, *texts):
    for text, (packed, decoded) in zip(texts, table.encode(list(texts)), strict=True):
        one(library, text, packed, decoded)


def one(library, text, packed, decoded):
    ids = library.encode(text, add_bos=True, add_eos=True)
    assert np.frombuffer(packed, "<u4").tolist() == ids
    assert decoded == library.decode(ids)


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(table, library, text):
    same(table, library, text)


def test_random_texts(table, library):
    rng = random.Random(5)
    symbols = "ab T▁  \n\té日́🎉.<0x>\x00 "
    for _ in range(300):
        same(table, library, *("".join(rng.choices(symbols, k=rng.randrange(40))) for _ in range(5)))


def test_long_chunks_are_not_kept_and_the_table_is_bounded_by_bytes(library):
    with open(PATH, "rb") as file:
        table = pieces.ChunkTable(file.read(), size=20_000)
    long_ = "日本" * 2_000
    same(table, library, f"a {long_} b", long_)
    assert set(table.known) == {"a", "b"}
    rng = random.Random(6)
    for _ in range(60):
        same(table, library, " ".join(f"w{rng.randrange(10**6)}" for _ in range(20)))
        assert table.held <= 20_000 + 20 * (pieces.OVERHEAD + 50)


def test_table_and_query(spark, library, whole):
    from tidemark.llm.queries import op6_sentencepiece

    texts = {r.doc_id: r.text for r in whole("documents").collect()}
    for r in op6_sentencepiece(spark, "/root/testdata/sf0.001").collect():
        ids = library.encode(texts[r.doc_id], add_bos=True, add_eos=True)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_nulls_repeats_and_empty_table(documents, library):
    rows = [(None, "x y"), (1, None), (1, None), (2, "")]
    got = pieces.encode(documents(rows, ids=("int", 1), decoded=("int", 1)), PATH).collect()
    assert sorted(((r._id, r.n_tokens, r.decoded) for r in got), key=repr) == sorted(
        [(None, len(library.encode("x y")) + 2, "x y"), (1, 2, ""), (1, 2, ""), (2, 2, "")], key=repr
    )
    assert pieces.encode(documents([]), PATH).collect() == []
