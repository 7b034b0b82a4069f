"""Patterns against plain regular expressions, and the random field on small documents."""

import itertools
import random
import re

import numpy as np

from varstrata.llm import pii
from varstrata.llm.pii import Field, Graph, add_text, base_spans, find_pii, marginals, pii_model


def plain(text):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((0, *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append((1, *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub(r"\D", "", m.group())
        odd, even = digits[::-1][::2], digits[::-1][1::2]
        total = sum(map(int, odd)) + sum(sum(map(int, str(2 * int(d)))) for d in even)
        if 16 <= len(digits) <= 19 and total % 10 == 0:
            out.append((2, *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub(r"\D", "", m.group())) <= 15:
            out.append((3, *m.span()))
    return out


def test_patterns():
    rng = random.Random(0)
    pieces = ["a", "b.", "@", "x-1", ".", "..", "1", "22", "255", "256", "001", " ", "-", "+", "(", ")", "é", "\n", "4111 1111 1111 1111", "4111111111111111", "a@b.c", "+1 (017) 555-7713", "1.2.3.4", "%", "٣", "²"]
    for _ in range(4000):
        text = "".join(rng.choices(pieces, k=rng.randrange(25)))
        assert base_spans(text) == plain(text), text


def test_long_texts():
    for text in ("1" * 200_000, "1." * 100_000, "a@" * 100_000, "+1" + " " * 200_000, "a" * 300_000 + "@b.c", "1 " * 100_000, "+1" * 50_000):
        base_spans(text)
        graph = Graph.empty()
        add_text(graph, 0, text, [])


def exact(graph, field):
    """Marginals by adding up all labellings."""
    n = len(graph.start)
    total = np.zeros((n, pii.LABELS))
    for labels in itertools.product(range(pii.LABELS), repeat=n):
        if any(b and b != y for b, y in zip(graph.base, labels, strict=True)):
            continue
        score = sum(field.unary[f, y] for fs, y in zip(graph.features, labels, strict=True) for f in fs)
        score = score if not any(graph.base) else sum(field.unary[f, y] for fs, y, b in zip(graph.features, labels, graph.base, strict=True) if not b for f in fs)
        score += sum(field.chain[labels[i], labels[j]] for i, j in graph.chain) + sum(field.skip[labels[i], labels[j]] for i, j in graph.skip)
        for i, y in enumerate(labels):
            total[i, y] += np.exp(score)
    return total / total.sum(1, keepdims=True)


def test_messages_are_exact_on_trees():
    rng = np.random.default_rng(0)
    graph = Graph([0] * 4, [0] * 4, [1] * 4, rng.integers(0, pii.BUCKETS, (4, 3)).tolist(), [0, 0, 2, 0], [(0, 1), (1, 2)], [(0, 3)])
    field = Field(rng.normal(size=(pii.BUCKETS, pii.LABELS)), rng.normal(size=(5, 5)), rng.normal(size=(5, 5)))
    assert np.allclose(marginals(graph, field, 60), exact(graph, field), atol=1e-3)


def documents(n, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = [rng.choice(["river", "stone", "and", "the", "12", "1999", "x9"]) for _ in range(40)]
        phone = f"+1 ({rng.randrange(100, 999)}) 555-{rng.randrange(1000, 9999)}"
        for value in (phone, phone, f"me.{rng.randrange(99)}@mail.example.com", f"10.{rng.randrange(256)}.3.4"):
            if rng.random() < 0.7:
                words.insert(rng.randrange(40), value)
        rows.append((i, " ".join(words), "mine"))
    return rows


def test_labels_reach_like_tokens(spark):
    schema = "doc_id long, text string, spans string"
    field = pii_model(spark.createDataFrame(documents(300, 1), schema))
    assert field.skip[4, 4] > field.skip[4, 0]
    told = "call +1 (017) 555-7713 now, or again 555-7713 the river"
    rows = documents(50, 2) + [(100, told, ""), (101, "just 555-7713 alone", ""), (102, None, None), (103, "", ""), (None, told, ""), (100, told, "")]
    out = find_pii(spark.createDataFrame(rows, schema), field).collect()
    assert len(out) == len(rows)
    for r in out:
        base = [(s.kind, s.start, s.end) for s in r.base]
        assert base == [(pii.KINDS[k], s, e) for k, s, e in plain(r.text or "")]
        assert set(base) <= {(s.kind, s.start, s.end) for s in r.spans}
        added = {(s.kind, s.start, s.end) for s in r.spans} - set(base)
        if r.text == told:
            assert added == {("phone", 37, 45)}
        else:
            # a number whose pattern ran on into other numbers and failed
            assert all(re.fullmatch(r"\+1 \(\d{3}\) 555-\d{4}|\d{3}\) 555-\d{4}", r.text[s:e]) for _, s, e in added), (r.text, added)


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert find_pii(none, pii_model(none)).count() == 0
    one = spark.createDataFrame([(1, "call +1 (017) 555-7713")], "doc_id long, text string")
    assert len(find_pii(one, pii_model(none)).first().base) == 1
