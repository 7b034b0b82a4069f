"""Chunks of many rolling hashes against a plain version that cuts roll by roll."""

import random
import struct

import pytest
import xxhash
from test_linededup import corpus

from varstrata.llm.linechunks import INNER, LONGEST, ROLLS, chunk_dedup, rolled_chunks
from varstrata.llm.linededup import LEAST_BYTES


def kind(lines, at, roll):
    """o, c or i: what a line does in a roll."""
    salt = at % 2 + 1 if lines[at] in lines[max(at - 1, 0) : at] + lines[at + 1 : at + 2] else 0
    h = xxhash.xxh64_intdigest(struct.pack("<i", salt), seed=xxhash.xxh64_intdigest(lines[at].encode(), seed=42))
    base = xxhash.xxh64_intdigest(struct.pack("<Q", h), seed=42)
    bits = [xxhash.xxh64_intdigest(struct.pack("<i", k), seed=base) >> roll & 1 for k in range(INNER + 1)]
    return "i" if all(bits[1:]) else "o" if bits[0] else "c"


def weight(lines):
    return len("".join("".join(lines).split()).encode())


def plain_chunks(text, rolls=ROLLS):
    """(first, lines), cut roll by roll: between two lines stands a boundary unless one opens or goes on and the next goes on or closes."""
    lines, out = text.split("\n"), set()
    for roll in range(rolls):
        kinds = [kind(lines, k, roll) for k in range(len(lines))]
        ends = [k + 1 for k in range(len(lines)) if k + 1 == len(lines) or not (kinds[k] in "oi" and kinds[k + 1] in "ic")]
        for first, end in zip([0, *ends], ends, strict=False):
            for start in range(first, end):  # a chunk begins where it opens
                if kinds[start] == "o" and kinds[end - 1] == "c" and 2 <= end - start <= LONGEST:
                    out.add((start, tuple(lines[start:end])))
    return {(s, c) for s, c in out if weight(c)}


def plain(texts, rolls=ROLLS, least=LEAST_BYTES):
    first, count, chunks = {}, {}, [plain_chunks(t, rolls) for t in texts]
    for i, cs in enumerate(chunks):
        for at, c in sorted(cs):
            first.setdefault(c, (i, at))
            count[c] = count.get(c, 0) + 1
    out = []
    for i, (text, cs) in enumerate(zip(texts, chunks, strict=True)):
        gone, stays, removed = set(), set(), 0
        for at, c in cs:
            j, start = first[c]
            if count[c] > 1 and (i, at) == (j, start):
                stays |= set(range(at, at + len(c)))
            elif j < i or at >= start + len(c):
                gone |= set(range(at, at + len(c)))
                removed += 1
        gone, lines, k = gone - stays, text.split("\n"), 0
        while k < len(lines):  # runs of little text stay
            end = next(e for e in range(k, len(lines) + 1) if e not in gone)
            if weight(lines[k:end]) < least:
                gone -= set(range(k, end))
            k = end + 1
        out.append(("\n".join(x for k, x in enumerate(lines) if k not in gone), len(cs), removed, len(gone)))
    return out


def cleaned(spark, texts, **options):
    docs = spark.createDataFrame([(i, t, "own", 7) for i, t in enumerate(texts)], "doc_id long, text string, cleaning string, h int")
    rows = chunk_dedup(docs.repartition(3), **options).orderBy("doc_id").collect()
    assert all(r.h == 7 and r.cleaning.n_lines == t.count("\n") + 1 for r, t in zip(rows, texts, strict=True))
    return [(r.text, r.cleaning.n_chunks, r.cleaning.removed_chunks, r.cleaning.removed_lines) for r in rows]


@pytest.mark.parametrize(("bits", "rolls", "least"), [(128, ROLLS, 0), (128, 3, 12), (3, 5, 30)])
def test_against_plain(spark, bits, rolls, least):
    texts = corpus(60, 4)
    texts[-3] = "a\nb\n" * 300 + "the same again\n" * 7
    assert cleaned(spark, texts, hash_bits=bits, rolls=rolls, least_bytes=least) == plain(texts, rolls, least)


def test_chunks_depend_on_their_own_lines_only(spark):
    rng = random.Random(5)
    body = [f"line of its own {rng.randrange(10**6)}" for _ in range(60)]
    texts = ["\n".join(body), "\n".join(["new", "lines", "here", *body, "tail"])]
    lines = spark.createDataFrame([(t.split("\n"),) for t in texts], "l array<string>")
    found = [{(c.code >> 32, c.code & 0xFFFFFFFF) for c in r[0]} for r in lines.select(rolled_chunks(lines.l)).collect()]
    assert {(s + 3, n) for s, n in found[0]} <= found[1] and {n for _, n in found[0]} >= {2, 3}


def test_passages(spark):
    """The first copy stays whole, layout is no passage, and short passages are found wherever they stand."""
    w, x, y = ("a line with enough letters " + c for c in "wxy")
    only = lambda texts: [r[0] for r in cleaned(spark, texts)]
    assert only([f"{x}\n{y}", f"{w}\n{x}\n{y}", f"{w}\n{x}"]) == [f"{x}\n{y}", f"{w}\n{x}", ""]
    layout = ["alpha\n\n\nbeta", "gamma\n\n\ndelta", "if a:\n    }\n}\nfoo", "if b:\n    }\n}\nbar"]
    assert only(layout) == layout
    rng = random.Random(17)
    line = lambda: " ".join(str(rng.randrange(10**6)) for _ in range(12))
    passages = [[line() for _ in range(2 + k % 5)] for k in range(100)]
    texts = [[line() for _ in range(rng.randrange(3, 9))] for _ in range(300)]
    for i, t in enumerate(texts):
        at = rng.randrange(len(t) + 1)
        t[at:at] = passages[i % 100]
    removed = sum(r[3] for r in cleaned(spark, ["\n".join(t) for t in texts]))
    assert removed >= 0.99 * 2 * sum(map(len, passages))


def test_odd_rows(spark):
    schema = "doc_id long, text string"
    assert chunk_dedup(spark.createDataFrame([], schema)).count() == 0
    text = "\n".join(f"a line with number {i}" for i in range(30))
    rows = [(None, text), (4, text), (4, text), (9, text), (5, None), (6, ""), (7, "x"), (8, "x")]
    out = chunk_dedup(spark.createDataFrame(rows, schema)).collect()
    assert sorted(((r.doc_id or 0, r.text) for r in out), key=str) == sorted([(0, ""), (4, text), (4, text), (9, ""), (5, None), (6, ""), (7, "x"), (8, "x")], key=str)
    only_null = chunk_dedup(spark.createDataFrame([(None, text), (None, text)], schema)).collect()
    assert [r.text for r in only_null] == [text, text]
