"""The prefix trie against a plain one built by dictionaries."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from varstrata.llm import trie
from varstrata.llm.trie import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [t[1:] for t in sorted(ts, key=lambda t: t[0])] for c, ts in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        built[c] = own.get(base, [])[:h] + turns[h:]
    members, ends = {}, {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    children, leaves, saved = {}, {}, {}
    for node in members:
        if node:
            children[node[:-1]] = children.get(node[:-1], 0) + 1
    for node in members:
        worth = (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
        for d in range(len(node) + 1):
            saved[node[:d]] = saved.get(node[:d], 0) + worth
            leaves[node[:d]] = leaves.get(node[:d], 0) + (node not in children)
    return [
        (min(m), len(n), min(members[n[:-1]]) if n else None, len(m), children.get(n, 0), leaves[n], saved[n],
         hashlib.sha256(",".join(map(str, sorted(ends.get(n, [])))).encode()).hexdigest())
        for n, m in members.items()
    ]


def told(rows):
    return sorted(map(str, (tuple(r) for r in rows)))


def check(spark, rows):
    turns = spark.createDataFrame(rows, SCHEMA).withColumn("name", F.lit("clash")).withColumn("p", F.lit(1))
    assert told(prefix_trie(turns).collect()) == told(plain(rows))


def test_random_conversations(spark):
    random.seed(11)
    rows = []
    for c in sorted({*random.sample(range(400), 60), *range(100, 140), 300, 10**12, 10**12 + 7, -3, -250}):
        for turn in range(random.randrange(1, 9)):
            rows.append((c, turn, random.choice(["user", "assistant"]), random.choice(["hi", "ok", "é🙂", ""])))
    check(spark, rows)


def test_nulls_ties_and_long_texts(spark):
    rows = [
        (0, None, None, None), (0, 1, "user", ""), (0, 2, "", "user"), (1, 0, "user", "a" * 100_000), (1, 1, "user", None), (None, 0, "user", "x"), (5, None, "u", "t"),
        (202, 0, "user", "no base"), (202, 1, "user", "goes on"), (300, 3, "a", "same"), (300, 3, "a", "same"), (300, 3, "a", "same"), (301, 4, "b", "same"),
    ]
    check(spark, rows)


def test_one_conversation_of_a_third_of_all_rows(spark, monkeypatch):
    monkeypatch.setattr(trie, "BLOCK", 4)
    random.seed(1)
    rows = [(700, t, "user", random.choice("ab")) for t in range(150)] + [(701, t, "user", "ab"[t % 2]) for t in range(70)]
    rows += [(c, t, "user", "a") for c in range(800, 860) for t in range(3)]
    check(spark, rows)


def test_many_copies_and_children(spark, monkeypatch):
    monkeypatch.setattr(trie, "IDS_TOGETHER", 7)
    monkeypatch.setattr(trie, "HEAVY_NODES", 3)
    rows = [(c, t, "user", f"t{t}") for c in range(300) for t in range(7)] + [(1000 + c, t, "user", f"{t} {c if t else 0}") for c in range(150) for t in range(7)]
    check(spark, rows)


@pytest.mark.parametrize("rows", [[], [(None, 1, "user", "x")]])
def test_none(spark, rows):
    assert prefix_trie(spark.createDataFrame(rows, SCHEMA)).count() == 0


def test_turnless_conversation(spark):
    # no base, and its own turns all lie among those that it would take over
    c = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 >= 2)
    check(spark, [(c, 0, "user", "x"), (c, 1, "user", "y")])
