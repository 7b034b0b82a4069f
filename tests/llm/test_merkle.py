"""Merkle trees against a plain construction, on groups of all small sizes and with small blocks, so that there are several tiers."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from varstrata.llm.merkle import folded, leaf, merkle_manifest, siblings_digest

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row):
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[0], row[3], row[2], row[4], row[1])))


def tree(hashes):
    """Root, and for each of the hashes the list of (left, right)."""
    paths, owners = [[] for _ in hashes], [[i] for i in range(len(hashes))]
    while len(hashes) > 1:
        up, who = [], []
        for low in range(0, len(hashes), 3):
            run = hashes[low : low + 3]
            for j in range(len(run)):
                for i in owners[low + j]:
                    paths[i].append(("".join(run[:j]), "".join(run[j + 1 :])))
            up.append(H(*run))
            who.append([i for o in owners[low : low + 3] for i in o])
        hashes, owners = up, who
    return hashes[0], paths


def plain(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[3], []).append(row)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees, members = {}, {}
    for name in names:
        members[name] = sorted(groups[name], key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(r)))
        trees[name] = tree([plain_leaf(r) for r in members[name]])
    root, tops = tree([trees[n][0] for n in names])
    out = []
    for name, top in zip(names, tops, strict=True):
        for row, path in zip(members[name], trees[name][1], strict=True):
            steps = path + top
            changed = plain_leaf((row[0], row[1] and row[1].replace("\n", ""), *row[2:]))
            told = changed
            for left, right in steps:
                told = H(left, told, right)
            out.append((row[0], plain_leaf(row), trees[name][0], root, H(*(a + b for a, b in steps)), told))
    return out


def made(spark, rows, **options):
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("leaf", F.lit("clash")).withColumn("root", F.lit(1)).withColumn("tree", F.lit(2))
    changed = leaf("doc_id", "source", "lang", "n_chars", F.replace("text", F.lit("\n"), F.lit(""))).alias("changed")
    out = merkle_manifest(docs, carry=[changed], **options)
    return out.select(
        "doc_id", "leaf", "subroot", "root", siblings_digest(F.col("proof")).alias("proof"), folded(F.col("changed"), F.col("proof")).alias("told")
    )


def told(rows):
    return sorted(map(str, (tuple(r) for r in rows)))


@pytest.mark.parametrize("digits", [1, 2, 6])
def test_groups_of_many_sizes(spark, digits):
    random.seed(digits)
    rows = []
    for i, size in enumerate([1, 2, 3, 4, 9, 10, 28]):
        rows += [(random.randrange(10**6), f"a\nb{random.random()}", "en", f"s{i}", 3) for _ in range(size)]
    assert told(made(spark, rows, digits=digits).collect()) == told(plain(rows))


def test_nulls_ties_and_texts(spark):
    rows = [
        (None, None, None, None, None), (None, "x", None, None, 1), (1, "", "", "", 0), (1, "", "", "", 0), (1, "tie", "en", "", 3), (2, "é\n🙂", "de", "ß", 3),
        (3, "long " * 50_000, "en", "z", None), (-5, "\n", "en", "z", 1), (10**15, "-", "-", "-", 1),
    ]
    assert told(made(spark, rows, digits=1).collect()) == told(plain(rows))


def test_hot_group_and_equal_rows(spark):
    rows = [(7, "same", "en", "hot", 4)] * 300 + [(i, f"t{i}", "en", "cold" + str(i % 2), 2) for i in range(50)]
    assert told(made(spark, rows, digits=2).collect()) == told(plain(rows))


def test_one_row_and_none(spark):
    row = (1, "a", "en", "s", 1)
    only = made(spark, [row]).collect()
    assert told(only) == told(plain([row])) and only[0].leaf == only[0].subroot == only[0].root
    assert made(spark, []).count() == 0


def test_unchanged_leaves_fold_to_the_root(spark):
    docs = spark.range(100).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.lit("en").alias("lang"), F.lit(1).alias("n_chars"), F.col("id").cast("string").alias("text"))
    out = merkle_manifest(docs, digits=2)
    assert out.filter(folded(F.col("leaf"), F.col("proof")) != F.col("root")).isEmpty() and out.count() == 100


def test_no_joins_after_the_ranks(spark):
    docs = spark.createDataFrame([(1, "a", "en", "s", 1)], SCHEMA)
    plan = merkle_manifest(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "BroadcastExchange" not in plan
