"""The trie of all prefixes of conversations, by cutting sequences at half depth."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varstrata.llm.ordered import ranked
from varstrata.plans.runtime import written

MOST_COPIED = 5  # turns that a conversation takes over from another one, at most
BLOCK = 12  # bits of a rank within a block of a long conversation
HEAVY_NODES = 1000
IDS_TOGETHER = 4096
ENDS = "name binary, ends_sha256 string"


def _name(tag: str, *parts: Column) -> Column:
    """128 bits that stand for the parts."""
    return F.substring(F.unhex(F.sha2(F.concat(F.lit(tag.encode()), *parts), 256)), 1, 16)


def _root() -> Column:
    return _name("r")


def rebuilt(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, p, sym, points, top): the turns of the rebuilt conversations by place from 0, and after them one row without sym, the end.

    sym stands for role and text, points are the text's code points, top is the number of binary digits of the end's place.
    """
    role_, text_ = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    sym = _name("s", F.octet_length(role_).cast("string").cast("binary"), F.lit(b":"), role_.cast("binary"), text_.cast("binary"))
    rows = turns.filter(F.col(conv).isNotNull()).select(
        F.col(conv).alias("conv"), F.col(turn).alias("turn"), sym.alias("sym"), F.length(text_).cast("bigint").alias("points")
    )
    placed = ranked(rows, ["conv"], ["turn", "sym"], "turns").withColumnRenamed("__rank", "rank").withColumnRenamed("__n", "n")

    # one row for each conversation, and the first turns of those that others copy
    convs = placed.filter("rank = 0").select("conv", "n", (F.col("conv") - F.col("conv") % 100).alias("base"), (F.crc32(F.col("conv").cast("string").cast("binary")) % 6).alias("h"))
    copied = placed.filter((F.col("rank") < MOST_COPIED) & (F.col("conv") % 100 == 0))
    heads = copied.groupBy(F.col("conv").alias("base")).agg(F.array_sort(F.collect_list(F.struct("rank", "sym", "points"))).alias("head"))
    none = F.array().cast("array<struct<rank: bigint, sym: binary, points: bigint>>")
    met = convs.join(heads, "base", "left").withColumn("head", F.slice(F.coalesce("head", none), F.lit(1), F.col("h").cast("int")))
    length = F.size("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0))
    known = written(met.select("conv", "n", "h", "head", length.alias("length")), "convs")
    top = F.when(F.col("length") > 0, F.length(F.bin("length"))).otherwise(0).alias("top")

    end = F.struct(F.col("length").alias("rank"), F.lit(None).cast("binary").alias("sym"), F.lit(0).cast("bigint").alias("points"))
    taken = known.select("conv", top, F.explode(F.concat("head", F.array(end))).alias("x")).select("conv", F.col("x.rank").alias("p"), "x.sym", "x.points", "top")
    # a row of known for each block of ranks, so that a long conversation is no hot key
    blocks = known.filter("n > h").select("conv", "h", top, (F.size("head") - F.col("h")).alias("shift"), F.explode(F.sequence(F.lit(0), F.shiftright("n", BLOCK))).alias("block"))
    own = placed.withColumn("block", F.shiftright("rank", BLOCK)).join(blocks, ["conv", "block"]).filter("rank >= h")
    return taken.unionByName(own.select("conv", (F.col("rank") + F.col("shift")).alias("p"), "sym", "points", "top"))


def _halves(rows: DataFrame, whole) -> list[DataFrame]:
    """The tables of all cuts: level k holds, for each segment of 2 ** k places, what its halves are.

    rows: conv, p, top and val. A level has conv, p (the segment's number), top, left and right (the values of the halves; right is null if there is none) and val, which ``whole``
    makes of both. A conversation takes part up to level top, at which it is one segment, so the levels together are not larger than about twice the rows.
    """
    levels = []
    for level in range(rows.agg(F.max("top").alias("top")).first().top or 0):
        going = rows.filter(F.col("top") > level)
        sides = [F.first(F.when(F.col("p") % 2 == side, F.col("val")), ignorenulls=True).alias(name) for side, name in ((0, "left"), (1, "right"))]
        pairs = going.groupBy("conv", F.shiftright("p", 1).alias("half"), "top").agg(*sides).withColumnRenamed("half", "p")
        rows = written(pairs.withColumn("val", whole(F.col("left"), F.col("right"))), "halves")
        levels.append(rows)
    return levels


def _cut(levels: list[DataFrame], rows: DataFrame, start: Column, lower: Column, upper: Column) -> DataFrame:
    """From whole conversations down to places: ``state`` of every row.

    A conversation begins at level top with ``start``. At each level ``lower`` is the state of the right half and ``upper`` that of the left one, if there is a right half.
    """
    state = None
    for k, level in reversed([(0, rows), *enumerate(levels, 1)]):
        if state is None:
            known = level.withColumn("state", start)
        else:
            known = level.join(state, ["conv", "p"], "left").withColumn("state", F.coalesce("state", start))
        if k:
            first = F.struct((F.col("p") * 2).alias("p"), F.when(F.col("right").isNull(), F.col("state")).otherwise(upper).alias("state"))
            second = F.when(F.col("right").isNotNull(), F.struct((F.col("p") * 2 + 1).alias("p"), lower.alias("state")))
            parts = known.select("conv", F.explode(F.array_compact(F.array(first, second))).alias("x"))
            state = parts.select("conv", "x.p", "x.state")
    return known


def _named(rows: DataFrame) -> DataFrame:
    """(conv, p, top, at_end, name, parent, points): the prefix before each place, the prefix one turn shorter, and the code points of its last turn.

    A prefix is named after its parts at the cuts: the binary digits of its length, the highest first, each stand for a left half that the prefix holds whole. So equal prefixes
    have equal names, whatever follows them. spine lists the left halves along the way to a segment's last place.
    """
    bytes_, none = F.lit(None).cast("binary"), F.array().cast("array<binary>")
    value = F.struct(F.col("sym").alias("h"), none.alias("spine"), F.col("points").alias("points"))

    def whole(left: Column, right: Column) -> Column:
        spine = F.concat(F.array(left["h"]), right["spine"])
        return F.struct(_name("b", left["h"], right["h"]).alias("h"), spine.alias("spine"), right["points"].alias("points"))

    table = written(rows.select("conv", "p", "top", F.col("sym").isNull().alias("at_end"), value.alias("val")), "rebuilt")
    start = F.struct(_root().alias("name"), bytes_.alias("parent"), F.lit(0).cast("bigint").alias("points"))
    name = F.col("state.name")
    lower = F.struct(
        _name("n", name, F.col("left.h")).alias("name"), F.aggregate("left.spine", name, lambda above, h: _name("n", above, h)).alias("parent"),
        F.col("left.points").alias("points"),
    )
    placed = _cut(_halves(table, whole), table, start, lower, F.col("state"))
    return placed.select("conv", "p", "top", "at_end", "state.name", "state.parent", "state.points")


def _owned_after(rows: DataFrame) -> DataFrame:
    """Adds after: the sums of val over all later places of the conversation. The sums of lower parts are grafted to the upper ones cut by cut."""

    def both(a: Column, b: Column) -> Column:
        return F.struct(*[(a[f] + b[f]).alias(f) for f in ("leaves", "saved")])

    zero = F.struct(F.lit(0).cast("bigint").alias("leaves"), F.lit(0).cast("bigint").alias("saved"))
    levels = _halves(rows.select("conv", "p", "top", "val"), lambda left, right: F.when(right.isNull(), left).otherwise(both(left, right)))
    return _cut(levels, rows, zero, F.col("state"), both(F.col("state"), F.col("right"))).withColumnRenamed("state", "after")


def _ends(rows: DataFrame) -> DataFrame:
    """(name, ends_sha256) of the names that rows (name, conv) have: SHA-256 of their conversations, ascending, with commas.

    Ids are joined to texts of some thousands in ranges of (name, conv) first; the task that has a name digests its texts as they come, in order, and holds one at a time.
    """

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(held: list[tuple[bytes, int, str]]) -> pa.RecordBatch:
            columns = zip(*held, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.binary(), pa.int64(), pa.string()), strict=True)], names=["name", "first", "ids"])

        for batch in batches:
            names, convs = batch.column("name").to_pylist(), batch.column("conv").to_pylist()
            out, low = [], 0
            for i in range(1, len(names) + 1):
                if i == len(names) or names[i] != names[low] or i - low == IDS_TOGETHER:
                    out.append((names[low], convs[low], ",".join(map(str, convs[low:i]))))
                    low = i
            if out:
                yield packed(out)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told(done: list[tuple[bytes, str]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([n for n, _ in done], pa.binary()), pa.array([d for _, d in done], pa.string())], names=["name", "ends_sha256"])

        current, state = None, None
        for batch in batches:
            done = []
            for name, ids in zip(batch.column("name").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if name != current:
                    if state is not None:
                        done.append((current, state.hexdigest()))
                    current, state = name, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if done:
                yield told(done)
        if state is not None:
            yield told([(current, state.hexdigest())])

    dealt = rows.select("name", "conv").repartitionByRange("name", "conv").sortWithinPartitions("name", "conv")
    texts = dealt.mapInArrow(join, "name binary, first bigint, ids string")
    return texts.repartition("name").sortWithinPartitions("name", "first").select("name", "ids").mapInArrow(digest, ENDS)


def prefix_trie(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256): one row for each node of the trie of conversations.

    Conversations are ordered by turn and rebuilt: number c takes its first h turns from conversation c - c % 100, h = crc32 of c's digits % 6, and goes on with its own turns
    after its first h. Each distinct prefix is a node, named by the smallest conversation that has it (conv_id) and its depth.

    How: sequences are cut at half depth again and again; all segments of a level are one table. On the way up each segment gets a hash of its halves; on the way down the
    prefixes at the cuts are named, which gives the roots of the lower forests while the upper part is cut on, in the same step. Subtree totals come the same way: each node counts
    for the smallest conversation that has it, the totals of lower halves are grafted to the upper ones, and a node adds up what its members have from its depth on. For n turns
    and a longest conversation of m, that is log2 m steps over about 2 n narrow rows together, whatever a conversation's length; texts are read once, for hashes and lengths.

    Nulls: null turns come first; null role or text is empty; rows of null conversation belong to none and are left out. Turns equal in number are ordered by a hash of role and
    text, so that the result does not depend on how the table was read; equal rows are turns each. Empty and very long texts are turns as any. A conversation whose base is absent begins with its
    own later turns, or is empty and then counts at the root only. % is Spark's, also for negative numbers. An empty table has no nodes. Other columns are not read.
    """
    places = written(_named(rebuilt(turns, conv, turn, role, text)), "places")
    one = [F.first(c).alias(c) for c in ("parent", "points")]
    counted = places.groupBy("name").agg(
        F.min("conv").alias("conv"), F.min("p").alias("p"), F.count(F.lit(1)).alias("n_convs"), F.count_if("at_end").alias("n_ends"), *one
    )
    nodes = written(counted, "nodes")

    weight = F.struct((F.col("n_convs") == F.col("n_ends")).cast("bigint").alias("leaves"), ((F.col("n_convs") - 1) * F.col("points")).alias("saved"))
    nothing = F.struct(F.lit(0).cast("bigint").alias("leaves"), F.lit(0).cast("bigint").alias("saved"))
    weighed = places.select("conv", "p", "top", "name").join(nodes.select("conv", "p", weight.alias("val")), ["conv", "p"], "left")
    weighed = written(weighed.withColumn("val", F.coalesce("val", nothing)), "weighed")
    totals = _owned_after(weighed).groupBy("name").agg(
        F.sum(F.col("val.leaves") + F.col("after.leaves")).alias("n_leaves"), F.sum(F.col("val.saved") + F.col("after.saved")).alias("saved_tokens")
    )
    ends = _ends(places.filter("at_end"))

    children = nodes.filter("parent is not null").groupBy(F.col("parent").alias("name")).agg(F.count(F.lit(1)).alias("n_children"))
    full = nodes.join(children, "name", "left").join(totals, "name").join(ends, "name", "left").drop("points", "n_ends")
    full = written(full.withColumn("n_children", F.coalesce("n_children", F.lit(0))), "full")
    # a parent of very many children would be a hot key: there are HEAVY_NODES of them at most
    limit = full.count() / HEAVY_NODES
    above = full.select(F.col("name").alias("of"), F.col("conv").alias("parent_conv_id"), "n_children")
    heavy = F.broadcast(above.filter(F.col("n_children") >= limit).select("of", F.col("parent_conv_id").alias("heavy_id")))
    met = full.join(heavy, F.col("parent") == F.col("of"), "left").drop("of")
    light = above.filter(F.col("n_children") < limit).drop("n_children")
    rest = met.filter("heavy_id is null and parent is not null").join(light, F.col("parent") == F.col("of")).drop("of")
    done = met.filter("heavy_id is not null or parent is null").withColumn("parent_conv_id", F.col("heavy_id"))
    return rest.unionByName(done).select(
        F.col("conv").alias("conv_id"), F.col("p").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
