"""Removal of repeated strings against counting all windows."""

import random
import uuid
from collections import Counter

import pytest

from varstrata.llm import suffix
from varstrata.llm.suffix import suffix_dedup


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    count = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = [False] * len(d)
        for i in range(len(d) - length + 1):
            if count[d[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        spans, kept = [], bytearray()
        for i, g in enumerate(gone):
            if not g:
                kept.append(d[i])
            elif i and gone[i - 1]:
                spans[-1][1] = i + 1
            else:
                spans.append([i, i + 1])
        out.append((len(d), [tuple(s) for s in spans], bytes(kept)))
    return out


def corpus(seed, n):
    rng = random.Random(seed)
    shared = ["".join(rng.choices("abcdé ", k=rng.choice([15, 30, 90]))) for _ in range(5)]
    texts = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randrange(0, 6)):
            parts.append(rng.choice(shared) if rng.random() < 0.5 else "".join(rng.choices("abcdé ", k=rng.randrange(40))))
        texts.append("".join(parts))
    return texts + ["abab" * 30, "x" * 100, "x" * 41, "", None, texts[3], texts[3]]


@pytest.mark.parametrize("most", [2, 4096])
def test_against_counting(spark, most):
    texts = corpus(most, 60)
    docs = spark.createDataFrame([(i if i % 9 else None, t, "own", "x") for i, t in enumerate(texts)], "doc_id long, text string, kept string, key string")
    out = suffix_dedup(docs, length=20, gram=6, most=most).collect()
    assert len(out) == len(texts) and "key" in out[0].asDict()
    got = sorted((r.text is None, r.text or "", r.n_bytes, [tuple(s) for s in r.removed], bytes(r.kept)) for r in out)
    assert got == sorted((t is None, t or "", *x) for t, x in zip(texts, brute(texts, 20), strict=True))


def test_long_texts_and_default_length(spark):
    rng = random.Random(4)
    long = "".join(rng.choices("abcdefgh ", k=2_500_000))
    texts = [long, "intro " + long[1_048_300:1_048_900] + " end", long[-200:], long[-199:], "q" + long[5:205]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r.doc_id: r for r in suffix_dedup(docs).collect()}
    n = len(long)
    assert [tuple(s) for s in out[0].removed] == [(5, 205), (1_048_300, 1_048_900), (n - 200, n)]
    assert [tuple(s) for s in out[1].removed] == [(6, 606)] and bytes(out[1].kept) == b"intro  end"
    assert [tuple(s) for s in out[2].removed] == [(0, 200)] and not out[3].removed and [tuple(s) for s in out[4].removed] == [(1, 201)]


def test_empty(spark):
    assert suffix_dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_segments_are_found_once(spark, monkeypatch, tmp_path):
    """The counts and the join read the same segments: texts are cut and hashed once."""
    find = suffix._occurrences

    def watched(docs, length, gram):
        def note(batches):
            (tmp_path / uuid.uuid4().hex).touch()
            yield from batches

        found = find(docs.coalesce(1), length, gram)
        return found.mapInArrow(note, found.schema)

    monkeypatch.setattr(suffix, "_occurrences", watched)
    docs = spark.createDataFrame(list(enumerate(corpus(7, 20))), "doc_id long, text string")
    suffix_dedup(docs, length=20, gram=6).collect()
    assert len(list(tmp_path.iterdir())) == 1
