"""The kernel against its definition, the machine on separable data, and held-out accuracy."""

import itertools
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from varstrata.llm.queries import held_out
from varstrata.llm.toxicity import (
    SHARPNESS, SILENT, Summer, alike, choose_landmarks, codes, fit_svm, kernel, stems, subsequence_kernel, toxicity_model, toxicity_scores, windows, words_of
)


def by_definition(s, t, order=3, decay=0.5):
    def spans(x):
        out = {}
        for at in itertools.combinations(range(len(x)), order):
            out.setdefault("".join(x[i] for i in at), []).append(at[-1] - at[0] + 1)
        return out

    a, b = spans(s), spans(t)
    return sum(decay ** (x + y) for u in a if u in b for x in a[u] for y in b[u])


def test_kernel_by_definition():
    rng = random.Random(0)
    words = ["".join(rng.choices("abcé", k=rng.randint(0, 8))) for _ in range(30)]
    marked = ["\x01" + w for w in words]
    a, b = codes(words), codes(words[::-1])
    got = subsequence_kernel(a, b)
    assert np.allclose(got, [by_definition(x, y) for x, y in zip(marked, marked[::-1], strict=True)], rtol=1e-4)


def test_gaps_and_insertions():
    values = kernel(["idiot", "idxiot", "i.d.i.o.t", "theory", "idiots"], ["idiot"])[:, 0] ** 0.25
    assert values[0] == pytest.approx(1) and values[1] > 0.5 and values[4] > 0.8 and values[2] > values[3] == 0


def test_words():
    assert words_of("You i d i o t NOW") == ["you", "i", "d", "i", "o", "t", "now", "idiot"]
    assert windows("**clown!!") == ["clown"] and windows("###") == []
    long = "x" * 100 + "idiot"
    assert all(len(w) <= 24 for w in windows(long)) and windows(long)[-1].endswith("idiot")
    assert all(any(long[i : i + 12] in w for w in windows(long)) for i in range(len(long) - 11))
    assert "idio" in stems("an idiot") and "an" not in stems("an idiot")


def test_cache_does_not_matter(monkeypatch):
    texts = ["the idiot came", "a clown, an idio t", "", "#" * 9, "x" * 50_000]
    once = Summer(["idiot", "clown"]).sums(texts)
    monkeypatch.setattr("varstrata.llm.toxicity.CACHED_WORDS", 1)
    again = Summer(["idiot", "clown"])
    assert np.allclose(once, np.vstack([again.sums([t]) for t in texts]))


def test_machine():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 4))
    y = (x[:, 0] - 2 * x[:, 2] > 0.1).astype(int)
    w = fit_svm(x, y, 10.0)
    assert ((x @ w[:-1] + w[-1] > 0) == y).mean() > 0.97


def test_degenerate(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None), (None, ""), (2, "b")], "doc_id long, text string")
    for rows, want in (([], 0.0), ([(1, 1)], 1.0), ([(1, 0), (2, None), (None, 1)], 0.0)):
        labels = spark.createDataFrame(rows, "doc_id long, toxic int")
        out = toxicity_scores(docs, toxicity_model(docs, labels)).collect()
        assert [r.score for r in out] == [want] * 4
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (3, 0)], "doc_id long, toxic int")
    more = docs.union(spark.createDataFrame([(3, "nothing at all to see")], docs.schema))
    extra = more.withColumn("score", F.lit("old")).withColumn("y", F.lit(1))
    out = toxicity_scores(extra, toxicity_model(extra, labels)).collect()
    assert len(out) == 5 and all(0 <= r.score <= 1 for r in out)
    none = docs.limit(0)
    assert toxicity_scores(none, toxicity_model(none, labels)).count() == 0


SF = "/root/testdata/sf0.1"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    docs = docs.join(labels.select("doc_id"), "doc_id", "left_semi").select("doc_id", "text")
    model = toxicity_model(docs, labels, train=~held_out())
    out = toxicity_scores(docs.filter(held_out()), model).join(labels, "doc_id").toPandas()
    said = out["score"] >= 0.5
    assert (said == (out["toxic"] == 1)).mean() > 0.96
    assert out["toxic"][said].mean() > 0.9 and said[out["toxic"] == 1].mean() > 0.8


def test_no_audible_pair_is_left_out():
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdeé", k=rng.randint(1, 12))) for _ in range(300)] + ["idxiotic", "clwn", "stupd"]
    marks = ["".join(rng.choices("abcdefg", k=rng.randint(4, 10))) for _ in range(30)] + ["idiot", "clown", "stupid"]
    a, b = codes([w for w in words for _ in marks]), codes(marks * len(words))
    own = np.sqrt(subsequence_kernel(a, a) * subsequence_kernel(b, b))
    full = ((subsequence_kernel(a, b) / np.maximum(own, 1e-30)) ** SHARPNESS).reshape(len(words), len(marks))
    assert alike(words, marks)[full >= SILENT].all()
    assert np.allclose(kernel(words, marks)[full >= SILENT], full[full >= SILENT], rtol=1e-4)


def test_rare_sure_words_are_landmarks():
    # one in 1 % of toxic and in no clean text, beside a common one
    chosen = choose_landmarks([("zorblat", 20, 0), ("idiot", 900, 10), ("window", 200, 1800)], 2000, 18_000)
    assert chosen == ["idiot", "zorblat", "window"]


def test_rare_insults_alone_do_not_make_scores_constant(spark):
    rng = random.Random(8)
    plain = ["stone", "river", "garden", "monday", "window", "paper", "music", "winter"]
    insults = ["".join(rng.choices("bdfgklmnprstvzaeiou", k=8)) for _ in range(60)]
    rows = [(i, " ".join(rng.choices(plain, k=20)) + (f" {insults[i % 60]}" if i < 120 else ""), int(i < 120)) for i in range(1200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity_model(docs, docs.select("doc_id", "toxic"))
    known = [r for r in toxicity_scores(docs, model).collect() if any(m in r.text for m in model.landmarks if m not in " ".join(plain))]
    assert len(model.landmarks) == 48 and len(known) > 60 and np.mean([r.score >= 0.5 for r in known if r.toxic]) > 0.9
