"""The stages on small documents, each against a plain version on its own input."""

import uuid

import numpy as np
import pytest

tokenizers = pytest.importorskip("tokenizers")

import corpus_pipeline  # noqa: E402
from test_linededup import brute as plain_lines  # noqa: E402
from test_linededup import chunks_of  # noqa: E402
from test_minhash import brute as plain_groups  # noqa: E402

from varstrata.llm.toxicity import Summer, toxicity_model  # noqa: E402
from varstrata.llm.queries import held_out  # noqa: E402

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return {r.doc_id: r for r in df.collect()}


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, SF), name)
        out.append(docs)
    return out


def test_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "minhash_near_dedup", "mix_sources", "bpe"]
    for docs in stages[:-1]:
        assert docs.dtypes == stages[0].dtypes


def test_toxicity_stage(spark, stages):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = toxicity_model(stages[0], labels, train=~held_out())
    before, after = rows_of(stages[0]), rows_of(stages[1])
    ids = sorted(before)
    scores = model.score(Summer(model.landmarks).sums([before[i].text or "" for i in ids]))
    assert sorted(after) == [i for i, s in zip(ids, scores, strict=True) if s < 0.5]
    assert all(after[i] == before[i] for i in after)


def test_line_stage(spark, stages):
    before, after = rows_of(stages[1]), rows_of(stages[2])
    ids = sorted(before)
    chunked = chunks_of(spark, [before[i].text for i in ids])
    for i, chunks, (text, removed) in zip(ids, chunked, plain_lines(chunked), strict=True):
        if removed and removed == len(chunks):
            assert i not in after
        else:
            assert after[i].text == text and after[i].n_chars == (len(text) if removed else before[i].n_chars)
    assert set(after) <= set(ids)


def test_near_duplicate_stage(stages):
    before, after = rows_of(stages[2]), rows_of(stages[3])
    label = plain_groups([(i, r.text) for i, r in before.items()])
    assert sorted(after) == sorted(i for i in before if label[i] == i)
    assert all(after[i] == before[i] for i in after)


def test_mixing_stage(stages):
    assert rows_of(stages[4]) == rows_of(stages[3])
    sources = [r.source for r in stages[4].collect()]
    assert sources != sorted(sources)


def test_encoding_stage(stages):
    library = tokenizers.Tokenizer.from_file(corpus_pipeline.VOCABULARY)
    before, after = rows_of(stages[4]), rows_of(stages[5])
    assert set(before) == set(after)
    for i, r in after.items():
        assert np.frombuffer(r.ids, "<u4").tolist() == library.encode(before[i].text or "", add_special_tokens=False).ids


def test_empty_and_odd_documents(spark, tmp_path):
    docs = spark.createDataFrame(
        [(1, None, None, None, None, "x"), (2, "", "en", "s", 0, "x"), (None, "a b c", "en", None, 5, "x"), (3, "q " * 40_000, "en", "s", 80_000, "x"), (3, "q " * 40_000, "en", "s", 80_000, "x")],
        "doc_id long, text string, lang string, source string, n_chars long, score string",
    )
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for frame, n in ((docs, 5), (docs.limit(0), 0)):
        for _, stage in corpus_pipeline.STAGES:
            frame = corpus_pipeline.written(stage(spark, frame, str(tmp_path)), "t")
        assert frame.count() == n


def test_order_survives_files_of_unequal_size(spark, tmp_path):
    docs = spark.range(600).selectExpr(
        "id doc_id", "repeat('word ', cast(1 + pow(id % 7, 3) as int)) text", "'en' lang", "if(id % 3 = 0, 'a', if(id % 5 = 0, 'b', 'c')) source", "1L n_chars")
    mixed = corpus_pipeline.mix(docs)
    want = [r.doc_id for r in mixed.orderBy("place.slot", "place.at").collect()]
    corpus_pipeline.in_order(mixed, rows_per_file=100).write.parquet(f"{tmp_path}/mixed")
    out = corpus_pipeline.encode(spark, spark.read.parquet(f"{tmp_path}/mixed"), "")
    out.write.parquet(f"{tmp_path}/coded")
    rows = spark.read.parquet(f"{tmp_path}/coded").orderBy("slot", "at").collect()
    assert [r.doc_id for r in rows] == want
    files = sorted((tmp_path / "coded").glob("part-*.parquet"))
    assert [r.doc_id for f in files for r in spark.read.parquet(str(f)).collect()] == want


def test_codes_are_made_once_and_not_written_aside(spark, stages, monkeypatch, tmp_path):
    encode = corpus_pipeline.bpe_encode

    def watched(docs, *args, **kwargs):
        def note(batches):
            (tmp_path / uuid.uuid4().hex).touch()
            yield from batches

        coded = encode(docs.coalesce(1), *args, **kwargs)
        return coded.mapInArrow(note, coded.schema)

    def refused(df, label="table"):
        raise AssertionError(f"{label} written")

    monkeypatch.setattr(corpus_pipeline, "bpe_encode", watched)
    monkeypatch.setattr(corpus_pipeline, "written", refused)
    out = corpus_pipeline.encode(spark, stages[4], SF)
    assert sorted(map(tuple, out.drop("slot", "at").collect())) == sorted(map(tuple, stages[5].drop("slot", "at").collect()))
    assert len(list(tmp_path.iterdir())) == 1
