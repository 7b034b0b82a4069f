"""Encoding and decoding against the tokenizers library."""

import random

import numpy as np
import pytest
from pyspark.sql import Row

tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")

from varstrata.llm.bpe import WordBpe, bpe_decode, bpe_encode  # noqa: E402

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    "", " ", "Hello, World!", "it's we'RE 'LL 've", "aaaaaaaaaaaaaaaaaaaaaaa", "aaa aaaa aaaaa", "ΑΣ ΟΔΥΣΣΕΥΣ Σ", "İstanbul ǅ ß ẞ",
    "é é ẛ̣", "a\x1cb\x85c\xa0d e​f", "<|endoftext|> x<|startoftext|><|endoftext|", "< | <|", "1234 ½ ² x2y",
    "日本語テキスト 🙂🙂 👩‍👩‍👧", "über straße öüä", "x" * 5000, "$$$ ### *** &&& %%%", "\n\n\t a \r\n b", "don't 'S'T", "﻿\u0000\x07", "ﬁ ﷺ",
]


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


def expected(library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    return ids, library.decode(ids, skip_special_tokens=False)


def test_texts(library):
    coder = WordBpe(open(PATH, encoding="utf-8").read())
    random.seed(5)
    alphabet = "aabbcde thing'é́ßΣİ 1 \n.,!日🙂ñ"
    texts = TEXTS + ["".join(random.choices(alphabet, k=random.randint(1, 60))) for _ in range(2000)]
    for text, packed in zip(texts, coder.encode(texts), strict=True):
        ids, decoded = expected(library, text)
        assert np.frombuffer(packed, "<u4").tolist() == ids, text
        assert coder.decode(packed) == decoded


def test_forgotten_pieces(library, monkeypatch):
    monkeypatch.setattr("varstrata.llm.bpe.CACHED_PIECES", 3)
    coder = WordBpe(open(PATH, encoding="utf-8").read())
    for _ in range(3):
        for text in TEXTS:
            assert np.frombuffer(coder.encode([text])[0], "<u4").tolist() == expected(library, text)[0]


def test_frame(spark, library):
    rows = [(i, t, "keep") for i, t in enumerate(TEXTS)] + [(None, None, None), (1, "twice", "x"), (1, "twice", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = bpe_decode(bpe_encode(docs, PATH), PATH).collect()
    assert len(out) == len(rows)
    one_pass = bpe_encode(docs.withColumnRenamed("ids", "decoded"), PATH, decoded=True)
    assert sorted(map(str, one_pass.select("ids", "n_tokens", "decoded").collect())) == sorted(str(Row(ids=r.ids, n_tokens=r.n_tokens, decoded=r.decoded)) for r in out)
    for row in out:
        ids, decoded = expected(library, row.text or "")
        assert np.frombuffer(row.ids, "<u4").tolist() == ids and row.n_tokens == len(ids)
        assert row.decoded == decoded


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert bpe_decode(bpe_encode(docs, PATH), PATH).count() == 0
