"""Candidates, features and held-out accuracy of the forest."""

import random
import re

import numpy as np
import pytest

from varstrata.llm.secrets import _with_features, FEATURES, candidates, coverage, features, findings, label_by_assignment, secret_model, secret_scan, transition_table


def slow_candidates(text):
    return [m.span() for m in re.finditer(r"[A-Za-z0-9+/_=-]+", text) if len(m.group()) >= 16 and re.search("[0-9]", m.group())]


def test_candidates():
    rng = random.Random(0)
    texts = ["".join(rng.choices("ab0F-_ \n.", weights=[9, 9, 3, 9, 2, 2, 1, 1, 1], k=200)) for _ in range(300)]
    for text in [*texts, "", "a" * 20_000 + "1", "a" * 50_000, "1" * 16, "1" * 15, "é" + "1" * 16 + "é"]:
        assert list(candidates(text)) == slow_candidates(text)


def test_features():
    table = transition_table({"hello": 5, "there": 3})
    dictionary = frozenset(["hello", "there"])
    f = dict(zip(FEATURES, features("hello-there-12345", "src/test/x.py", 'api_key = "', '" there', table, dictionary), strict=True))
    assert f["dictionary"] == pytest.approx(10 / 17) and f["harmless_path"] == f["says_secret"] == f["assigned"] == f["quoted"] == 1
    assert coverage("", dictionary) == 0 and np.isfinite(list(f.values())).all()


def corpus(n, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = [rng.choice(["stone", "river", "garden", "monday", "window"]) for _ in range(30)]
        if rng.random() < 0.5:
            words.insert(rng.randrange(30), 'token = "' + "".join(rng.choices("0123456789abcdef", k=40)) + '"')
        words.insert(rng.randrange(30), rng.choice(["2024-garden-window-7-stone", "/river/stone/garden/monday1", "1234567890123456789"]))
        rows.append((i, " ".join(words), f"src{i % 3}", "own"))
    return rows


def test_scan(spark):
    schema = "doc_id long, text string, source string, score string"
    docs = spark.createDataFrame(corpus(200, 1), schema)
    model = secret_model(docs)
    odd = [(None, None, None, ""), (905, "", "x", ""), (906, "garden", None, ""), (907, "z" * 100_000 + "9", "y", "")]
    test = corpus(100, 2)
    out = secret_scan(spark.createDataFrame(test + odd + test[:1], schema), model).collect()
    right = sum(r.is_secret == bool(re.fullmatch("[0-9a-f]{40}", r.candidate)) for r in out if r.doc_id != 907)
    assert right >= 0.98 * (len(out) - 1)
    texts = {i: t for i, t, _, _ in test + odd}
    assert all(texts[r.doc_id][r.start : r.end] == r.candidate for r in out)
    assert len(out) == sum(len(slow_candidates(t or "")) for _, t, _, _ in test + odd + test[:1])


def test_degenerate(spark):
    schema = "doc_id long, text string, source string"
    none = spark.createDataFrame([], schema)
    assert secret_scan(none, secret_model(none)).count() == 0
    docs = spark.createDataFrame([(1, "a 12345678901234567 b", None)], schema)
    assert [(r.score, r.is_secret) for r in secret_scan(docs, secret_model(docs)).collect()] == [(0.0, False)]
    labelled = findings(docs).selectExpr("candidate", "path", "before", "after", "1 label")
    assert secret_scan(docs, secret_model(docs, labelled)).first().is_secret


def test_assigned_values(spark):
    lines = {
        "API_KEY=9f8e7d6c5b4a39281706": ["9f8e7d6c5b4a39281706"], "token=04dbebab91ab85687d33": ["04dbebab91ab85687d33"],
        "GET /x?token=04dbebab91ab85687d33&n=1": ["04dbebab91ab85687d33"], "db_password: 'Tr0ub4dor&3'": ["Tr0ub4dor&3"],
        "export PASSWORD=hunter!hunter": ["hunter!hunter"], '{"api_key": "abcdefgh"}': ["abcdefgh"], "secret=QUJDREVGR0hJSktMTU5PUA==": ["QUJDREVGR0hJSktMTU5PUA=="],
    }
    for text, want in lines.items():
        assert [text[a:b] for a, b in candidates(text)] == want
    for text in ("Note: something else", "a == b", "http://garden.example", "=" * 50_000, "a:" * 20_000, "a=" * 20_000):
        assert not list(candidates(text))
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string").selectExpr("*", "'x' source")
    assert [r.label for r in label_by_assignment(findings(docs)).collect()] == [1] * len(lines)


def test_learns_from_every_document(spark):
    """One secret in 24,000 documents, and words that stand in two of them each."""
    docs = spark.range(24_000).selectExpr(
        "id doc_id",
        """concat(if(id = 12345, 'token = "', 'build '), substring(sha2(cast(id as string), 256), 1, 30), '"', if(id % 600 < 2, concat(' zebra',
        translate(cast(id div 600 as string), '0123456789', 'abcdefghij')), ' plain')) text""", "'x' source")
    model = secret_model(docs, trees=3)
    found = findings(docs).count()
    assert 24_000 <= found and model.share == 1 / found
    assert {"zebra" + "".join("abcdefghij"[int(d)] for d in str(i)) for i in range(40)} <= model.dictionary
    bins = model.forest.stages[0]
    scanned = model.forest.transform(_with_features(findings(docs).filter("id = 12345"), model.table, model.dictionary))
    assert max(map(len, bins.getSplitsArray())) <= 36 and scanned.select("prediction").first()[0] == 1


def test_long_findings_are_learned_from(spark):
    labelled = spark.createDataFrame([("q7" * 5000, "x", "", "", 1), ("q7" * 5000, "x", "", "", 0)], "candidate string, path string, before string, after string, label int")
    assert secret_model(spark.createDataFrame([], "doc_id long, text string, source string"), labelled, trees=3).share == 0.5


def test_model_does_not_depend_on_partitions(spark):
    docs = spark.createDataFrame(corpus(300, 3), "doc_id long, text string, source string, score string")
    one, other = secret_model(docs.coalesce(1), trees=5), secret_model(docs.repartition(7), trees=5)
    assert one.forest.stages[-1].toDebugString.split("\n")[1:] == other.forest.stages[-1].toDebugString.split("\n")[1:]
