"""Token files against the tokenizers library, byte by byte, and their round trip."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")

from test_bpe import TEXTS  # noqa: E402
from varstrata.llm import tokenfile  # noqa: E402
from varstrata.llm.tokenfile import WordCoder, read_tokens, write_tokens  # noqa: E402

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


def plain(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, 1]


def expected(library, rows):
    """(id, start, ids), ordered by id, null first; texts of equal id must be equal."""
    out, start = [], 0
    for id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = plain(library, text)
        out.append((id, start, ids))
        start += len(ids)
    return out


def told(frame):
    return sorted(((r.doc_id, r.start, np.frombuffer(r.ids, "<u4").tolist()) for r in frame.collect()), key=lambda r: r[1])


def test_texts(library):
    coder = WordCoder(open(PATH, encoding="utf-8").read())
    random.seed(12)
    letters = ["aabbcde thing'éßÀ×÷Ÿ 1 \n.,!\"'s't're", "áeé İΣσς日🙂ñ \x85\xa0\x1c\x1d ​'ſK", "<|endoftext|> <|startoftext|>a<", "ab \t\r\n\x0b\x0c\x00\x7f\x80"]
    texts = TEXTS + ["".join(random.choices(a, k=random.randint(1, 60))) for a in letters for _ in range(2000)]
    for text, packed in zip(texts, coder.encode(texts), strict=True):
        assert np.frombuffer(packed, "<u2").tolist() == plain(library, text), repr(text)


def test_every_character(library):
    coder = WordCoder(open(PATH, encoding="utf-8").read())
    points = [chr(i) for i in range(0x3000) if not 0xD800 <= i < 0xE000]
    texts = [f"a{c}b {c}'s x{c}1{c} {c}{c}" for c in points]
    assert [np.frombuffer(p, "<u2").tolist() for p in coder.encode(texts)] == [plain(library, t) for t in texts]


def test_forgotten_words(library, monkeypatch):
    monkeypatch.setattr(tokenfile, "CACHED_PIECES", 2)
    coder = WordCoder(open(PATH, encoding="utf-8").read())
    for _ in range(2):
        for text in TEXTS:
            assert np.frombuffer(coder.encode([text])[0], "<u2").tolist() == plain(library, text)


def test_round_trip(spark, library):
    rows = [(i * 7 - 40, t) for i, t in enumerate(TEXTS)] + [(10**12, None), (10**12 + 1, "long " * 60_000), (10**13, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).withColumn("ids", F.lit("clash")).withColumn("start", F.lit(1))
    path = write_tokens(docs, PATH)
    assert told(read_tokens(spark, path)) == expected(library, rows)
    manifest = spark.read.parquet(f"{path}/manifest").orderBy("part", "seq").collect()
    assert [m.base for m in manifest] == np.cumsum([0, *[m.n_tokens for m in manifest]])[:-1].tolist()
    # the files themselves
    where = path.removeprefix("file:")
    flat, ids = [], []
    for m in manifest:
        offsets = np.fromfile(f"{where}/{m.name}.idx", "<u8")
        assert len(offsets) == m.n_docs + 1 and offsets[0] == 0 and offsets[-1] == m.n_tokens
        flat += np.memmap(f"{where}/{m.name}.bin", "<u2", "r").tolist()
        ids += np.fromfile(f"{where}/{m.name}.doc", "<i8", m.n_docs).tolist()
    assert flat == [i for _, _, x in expected(library, rows) for i in x] and ids == sorted(ids)


def test_equal_and_null_ids(spark, library):
    rows = [(None, "null id")] * 40 + [(5, "same text")] * 60 + [(6, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert told(read_tokens(spark, write_tokens(docs, PATH))) == expected(library, rows)


def test_small_files_and_reads(spark, library):
    rows = [(i, f"word{i} " * (i % 5)) for i in range(200)]
    path = write_tokens(spark.createDataFrame(rows, "doc_id long, text string"), PATH, file_tokens=50)
    assert spark.read.parquet(f"{path}/manifest").count() > 20
    assert told(read_tokens(spark, path, together=7)) == expected(library, rows)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert read_tokens(spark, write_tokens(docs, PATH)).count() == 0


def test_query(spark, library):
    from varstrata.llm.queries import LLM_QUERIES

    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    want = [(i, s, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, s, x in expected(library, rows)]
    assert sorted(map(tuple, LLM_QUERIES["op12_token_files"](spark, "/root/testdata/sf0.001").collect()), key=lambda r: r[1]) == want
