"""A Merkle tree over a table, by sources: roots, and for each row the proof that it belongs to them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varstrata.llm.ordered import ranked
from varstrata.plans.runtime import written

FAN = 3
DIGITS = 6  # levels of a block: a row holds the tree over 3 ** 6 nodes at most
STEPS = "array<struct<left: string, right: string>>"


def digest(*values: Column) -> Column:
    """SHA-256 of the values one after the other, in lower-case hexadecimal digits."""
    return F.sha2(F.concat(*values), 256)


def leaf(*fields: str | Column) -> Column:
    """The digest of a row: of each field ``-`` if null, else its bytes in UTF-8, ``:`` and the value."""
    parts = []
    for field in fields:
        value = (F.col(field) if isinstance(field, str) else field).cast("string")
        parts.append(F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)))
    return digest(*parts)


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(proof, leaf, lambda below, step: digest(step["left"], below, step["right"]))


def siblings_digest(proof: Column) -> Column:
    """The digest of all siblings in a proof, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda step: F.concat(step["left"], step["right"])), ""), 256)


def _joined(nodes: Column) -> Column:
    return F.array_join(F.transform(nodes, lambda k: k["node"]["h"]), "")


def _tier(nodes: DataFrame, tree: str, fan: int, digits: int) -> DataFrame:
    """One row for each block of ``fan ** digits`` neighbouring nodes: its root as a struct that nests those below.

    nodes: tree, rank, n (nodes of the tree on this level) and node, a struct with h. The rows of a block are brought together once; then the digits of their
    rank are grouped away, the last one first, which needs no further shuffle. A level over a lone node is none: it hands the node on.
    """
    rows = nodes.withColumn("block", F.expr(f"rank div {fan**digits}")).repartition(tree, "block")
    for _ in range(digits):
        digit = rows.withColumn("digit", F.col("rank") % fan).withColumn("rank", F.expr(f"rank div {fan}"))
        runs = digit.groupBy(tree, "block", "n", "rank").agg(F.array_sort(F.collect_list(F.struct("digit", "node"))).alias("kids"))
        real = F.col("n") > 1
        h = F.when(real, F.sha2(_joined(F.col("kids")), 256)).otherwise(F.col("kids")[0]["node"]["h"])
        node = F.struct(h.alias("h"), real.alias("real"), F.col("kids"))
        rows = runs.select(tree, "block", F.expr(f"(n + {fan - 1}) div {fan}").alias("n"), "rank", node.alias("node"))
    return rows.select(tree, "block", "n", "node")


def _tiers(nodes: DataFrame, tree: str, fan: int, digits: int) -> list[DataFrame]:
    """Blocks of nodes, blocks of the blocks' roots and so on, until every tree is one block."""
    tiers = []
    most = 2
    while most > 1:
        tier = written(_tier(nodes, tree, fan, digits), "tier")
        most = tier.agg(F.max("n").alias("most")).first().most or 1
        tiers.append(tier)
        nodes = tier.select(tree, F.col("block").alias("rank"), "n", F.struct("node.h").alias("node"))
    return tiers


def _below(node: Column, rank: Column, path: Column, digits: int, fan: int) -> Column:
    """An array of the nodes that a block's root nests, each with its rank and the steps up from it."""
    if not digits:
        return F.array(F.struct(rank.alias("rank"), node.alias("node"), path.alias("path")))
    kids = node["kids"]

    def kid(k: Column, i: Column) -> Column:
        step = F.struct(_joined(F.slice(kids, F.lit(1), i)).alias("left"), _joined(F.slice(kids, i + 2, F.size(kids))).alias("right"))
        steps = F.when(node["real"], F.array(step)).otherwise(F.array().cast(STEPS))
        return _below(k["node"], rank * fan + k["digit"], F.concat(steps, path), digits - 1, fan)

    return F.flatten(F.transform(kids, kid))


def _proofs(tiers: list[DataFrame], tree: str, paths: DataFrame, fan: int, digits: int) -> DataFrame:
    """The nodes that the first tier was made of, with the steps up from each.

    paths: tree, block (0), path and told (what goes to every node of the tree) of each tree's root. A tier's rows get their path by a union with those of the tier
    above and one grouping, then unfold their nodes by transforms alone.
    """
    for tier in reversed(tiers):
        both = tier.select(tree, "block", "node").unionByName(paths, allowMissingColumns=True)
        met = both.groupBy(tree, "block").agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("node", "path", "told")])
        nodes = met.select(tree, "told", F.explode(_below(F.col("node"), F.col("block"), F.col("path"), digits, fan)).alias("x"))
        paths = nodes.select(tree, F.col("x.rank").alias("block"), "x.path", "told", F.col("x.node").alias("below"))
        if tier is not tiers[0]:
            paths = paths.drop("below")
    return paths


def merkle_manifest(
    rows: DataFrame, group: str = "source", id: str = "doc_id", fields: Sequence[str | Column] = ("doc_id", "source", "lang", "n_chars", "text"),
    carry: Sequence[Column] = (), fan: int = FAN, digits: int = DIGITS,
) -> DataFrame:
    """(id, leaf, subroot, root, proof, the columns of ``carry``): one row for each row of the table.

    Leaves are digests of ``fields``. The leaves of a group, ascending by id, make a tree of ``fan`` children a node, whose root is the group's subroot; the last
    run of a level may be shorter. Subroots, ordered by group (by bytes, null first), make the tree of the root. proof has a step for each level from the leaf up: the
    digests of its siblings to the left and to the right, as text. ``folded`` and ``siblings_digest`` work on it.

    How: texts are read once, for the digests; only those travel. Ranks come from ranges and prefix sums, so that a group of any size is dealt over tasks. Rank digits are
    grouped away one by one within blocks of ``fan ** digits`` leaves, each level nesting the structs of the one below; roots of blocks are the leaves of the next tier. From the top,
    transforms unfold the structs to proofs. Block rows meet the paths of the tier above by a union and a grouping; nothing is joined, and no row holds more than one block.

    Nulls: a null field counts as ``-``; rows of null group are a group, the first one; null ids come first in their group. Rows of equal id are ordered by their digest, so that
    the result does not depend on how the table was read; equal rows are leaves each. Empty and very long texts are values as any. An empty table gives an empty result. Other
    columns are not read, so their names don't matter; ``carry`` must not use the names of the result.
    """
    carried = [f"c{i}" for i in range(len(carry))]
    told_names = rows.select(*carry).columns if carry else []
    leaves = rows.select(
        F.col(group).alias("tree"), F.col(id).alias("id"), leaf(*fields).alias("h"), *[c.alias(n) for c, n in zip(carry, carried, strict=True)]
    )
    placed = ranked(leaves, ["tree"], ["id", "h"], "leaves")
    tiers = _tiers(placed.select("tree", F.col("__rank").alias("rank"), F.col("__n").alias("n"), F.struct("h", "id", *carried).alias("node")), "tree", fan, digits)

    subroots = ranked(tiers[-1].select(F.lit(0).alias("all"), "tree", "node.h"), ["all"], ["tree"], "subroots")
    upper = _tiers(subroots.select("all", F.col("__rank").alias("rank"), F.col("__n").alias("n"), F.struct("h", "tree").alias("node")), "all", fan, digits)
    top = upper[-1].select("all", "block", F.array().cast(STEPS).alias("path"), F.struct(F.col("node.h").alias("root")).alias("told"))
    trees = _proofs(upper, "all", top, fan, digits).select(
        F.col("below.tree").alias("tree"), F.lit(0).cast("bigint").alias("block"), "path", F.struct(F.col("below.h").alias("subroot"), "told.root").alias("told")
    )
    proofs = _proofs(tiers, "tree", trees, fan, digits)
    return proofs.select(
        F.col("below.id").alias(id), F.col("below.h").alias("leaf"), "told.subroot", "told.root", F.col("path").alias("proof"),
        *[F.col(f"below.{n}").alias(name) for n, name in zip(carried, told_names, strict=True)],
    )
