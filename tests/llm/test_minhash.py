"""Near-duplicates against brute force over all pairs."""

import random

import numpy as np
import pytest

from varstrata.llm import minhash
from varstrata.llm.components import components
from varstrata.llm.minhash import linked, near_duplicates, shingle_sets


def plain_set(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in text.replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def brute(rows):
    """component by id from all pairs"""
    sets = [(id, plain_set(text)) for id, text in rows if id is not None]
    label = {id: id for id, _ in sets}
    changed = True
    while changed:
        changed = False
        for i, (a, x) in enumerate(sets):
            for b, y in sets[:i]:
                if label[a] != label[b] and (a == b or (x and y and 100 * len(x & y) >= 75 * len(x | y))):
                    label[a] = label[b] = min(label[a], label[b])
                    changed = True
    return label


def check(spark, rows, **options):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, component_id string, g int")
    out = near_duplicates(docs, **options).collect()
    label = brute(rows)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles) for r in out) == sorted(
        (i is None, i or 0, len(plain_set(t))) for i, t in rows
    )
    for r in out:
        assert r.component_id == (None if r.doc_id is None else label[r.doc_id]), r
        assert r.kept == (r.doc_id is None or r.component_id == r.doc_id)


def made(seed, n):
    rng = random.Random(seed)
    vocabulary = ["the", "ärger", "of", "Mill", "stone", "rain", "bow", "x1", "né", "!"] + [f"w{i}" for i in range(60)]
    bases = [[rng.choice(vocabulary) for _ in range(rng.choice([3, 12, 60, 200]))] for _ in range(8)]
    rows = []
    for i in range(n):
        words = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5])):
            words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
        rows.append((i * 3 + 1, rng.choice([" ", "\n", " \t"]).join(words)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block", [4, 192])
def test_against_all_pairs(spark, block):
    check(spark, made(1, 160), block=block)


def test_edges(spark):
    rows = [
        (5, None), (6, ""), (7, " \n\t "), (8, "one two"), (2, "ONE  two"), (9, "one two three"), (None, "one two"), (None, "one two"),
        (10, "a " * 30_000), (11, "A " * 30_001), (12, "x" * 100_000), (13, "x" * 100_000), (20, "p q r s t u"), (20, "one two"), (20, "one two"),
        (21, "Ä b c d e"), (22, "ä b c d e"), (30, "a\x1cb c d e f"), (31, "a b c d e f"),
    ]
    check(spark, rows)


def test_empty(spark):
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_sets():
    texts = ["a b c d e f a b c d e", "", "A b", "q\x0bw e r t y u", "e " * 50]
    flat, bounds = shingle_sets([t.encode() for t in texts])
    assert np.diff(bounds).tolist() == [len(plain_set(t)) for t in texts]
    label = linked(*shingle_sets([b"a b c d e f", b"A b c d e f", b"z", b"z"]))
    assert label.tolist() == [0, 0, 2, 2]


def test_signature_is_unbiased():
    rng = np.random.default_rng(0)
    flat = rng.integers(0, 2**63, 300, dtype=np.uint64)
    a, b = np.sort(flat[:200]), np.sort(flat[50:])
    s = minhash.min_max(np.concatenate([a, b]), np.array([0, 200, 450]), 2000)
    assert abs((s[0] == s[1]).mean() - 150 / 300) < 0.03


def test_components(spark):
    rng = random.Random(3)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 450)] + [(1000, i) for i in range(900, 990)]
    label = {x: x for p in pairs for x in p}
    for _ in range(60):
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
    out = {r.node: r.component for r in components(spark.createDataFrame([*pairs, (None, 3)], "a long, b long")).collect()}
    assert out == {x: c for x, c in label.items() if any(x in p and p[0] != p[1] for p in pairs)}
