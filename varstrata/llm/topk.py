"""Exact search for the largest inner products, pruned by segment statistics from coarse to fine."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from varstrata.llm.groups import matrix, runs
from varstrata.plans.runtime import written

QUERY_CELLS = 2**21  # components of the queries that a task holds
CANDIDATES = 4096  # rows that a task holds
SLICE = 256  # queries compared at once
FIRST = 8  # one of so many blocks of rows is searched first; the scores found there are the floors for the others
SPARSE = 1 / 16  # of pairs left: below it bounds are computed pair by pair, above it as a matrix product


def levels(dim: int) -> tuple[int, ...]:
    """Numbers of segments, coarse to fine: of 16, of 4 and of 2 components each."""
    return tuple(sorted({max(1, dim // part) for part in (16, 4, 2)}))


def segment_statistics(vectors: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """For each segment, the mean and the deviation, both times the root of the segment's length.

    As xy = sum over segments of length * (mean x * mean y) + (x - mean x)(y - mean y), the sum of the products of these numbers is
    not below xy, and the squared distance not below |x|^2 + |y|^2 - 2 times that sum.
    """
    cuts = np.linspace(0, vectors.shape[1], min(segments, vectors.shape[1]) + 1).astype(int)
    roots = np.sqrt(np.diff(cuts))
    sums = np.add.reduceat(vectors, cuts[:-1], axis=1)
    squares = np.add.reduceat(vectors * vectors, cuts[:-1], axis=1)
    means = sums / roots
    return means, np.sqrt(np.maximum(squares - means * means, 0))


class Side:
    """Vectors of one block with their statistics at each resolution."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, resolutions: tuple[int, ...]):
        self.ids, self.vectors = ids, vectors
        self.plain = vectors.astype(np.float64)
        self.statistics = [np.hstack(segment_statistics(self.plain, s)) for s in resolutions]
        self.length = np.sqrt((self.plain * self.plain).sum(1))


def products(queries: Side, rows: Side, q: np.ndarray, r: np.ndarray) -> np.ndarray:
    """The exact inner products of pairs, ordered by query, cut off at the ends of 64 bits."""
    out = np.empty(len(q), np.int64)
    if not len(q):
        return out
    part = slice(q[0], q[-1] + 1)
    if len(q) > SPARSE * (part.stop - part.start) * len(rows.ids) and queries.length[part].max() * rows.length.max() < 2.0**52:
        return (queries.plain[part] @ rows.plain.T)[q - part.start, r].astype(np.int64)  # doubles hold such whole numbers exactly
    for low in range(0, len(q), 65_536):
        a, b = q[low:low + 65_536], r[low:low + 65_536]
        out[low:low + len(a)] = np.einsum("ij,ij->i", queries.vectors[a], rows.vectors[b])
        # no partial sum exceeds the product of the lengths
        for i in np.flatnonzero(queries.length[a] * rows.length[b] >= 2.0**62):
            exact = sum(x * y for x, y in zip(queries.vectors[a[i]].tolist(), rows.vectors[b[i]].tolist(), strict=True))
            out[low + i] = min(max(exact, -(2**63)), 2**63 - 1)
    return out


def survivors(queries: Side, rows: Side, part: slice, k: int, floor: np.ndarray, left: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pairs of a slice of queries that no bound excludes, and the queries' floors; ``left`` counts all pairs and those left by each level.

    A query without a floor gets one: the k-th of the exact scores of the pairs with the highest bounds of the finest level.
    """
    slack = 1e-6 * (1 + queries.length[part, None] * rows.length[None, :])  # rounding of the bounds
    open_ = queries.ids[part, None] != rows.ids[None, :]
    left[0] += open_.size
    known = floor[part].copy()
    finest = len(queries.statistics) - 1
    for level, (mine, its) in enumerate(zip(queries.statistics, rows.statistics, strict=True)):
        if level and open_.mean() < SPARSE and np.isfinite(known).all():
            q, r = np.nonzero(open_)
            for low in range(0, len(q), 65_536):
                a, b = q[low:low + 65_536], r[low:low + 65_536]
                open_[a, b] = np.einsum("ij,ij->i", mine[part][a], its[b]) + slack[a, b] >= known[a]
        elif level == finest or np.isfinite(known).any():
            bound = np.where(open_, mine[part] @ its.T + slack, -np.inf)
            if level == finest and open_.shape[1] > 4 * k:
                new = np.flatnonzero(~np.isfinite(known))
                best = np.argpartition(-bound[new], 4 * k - 1, axis=1)[:, :4 * k]
                score = products(queries, rows, np.repeat(new + part.start, 4 * k), best.ravel()).reshape(best.shape).astype(np.float64)
                score[~np.take_along_axis(open_[new], best, 1)] = -np.inf
                known[new] = np.partition(score, -k, axis=1)[:, -k]
            open_ &= bound >= known[:, None]
        left[level + 1] += int(open_.sum())
    q, r = np.nonzero(open_)
    return q + part.start, r, known


def best_in_block(
    queries: Side, rows: Side, k: int, floor: np.ndarray | None = None, left: list[int] | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, score) of the k largest inner products of each query with another row of the block that reach the query's ``floor``.

    Pairs whose bound is below the floor go, level by level from coarse to fine; what is left is computed exactly. Ties go to the smaller id.
    """
    floor = np.full(len(queries.ids), -np.inf) if floor is None else floor
    left = [0] * (len(queries.statistics) + 1) if left is None else left
    found = []
    for low in range(0, len(queries.ids), SLICE):
        q, r, known = survivors(queries, rows, slice(low, min(low + SLICE, len(queries.ids))), k, floor, left)
        exact = products(queries, rows, q, r)
        reach = exact.astype(np.float64) >= known[q - low]
        q, r, exact = q[reach], r[reach], exact[reach]
        order = np.lexsort((rows.ids[r], -np.clip(exact, -(2**63) + 1, None), q))
        q, r, exact = q[order], r[order], exact[order]
        start = np.flatnonzero(np.append(True, q[1:] != q[:-1])) if len(q) else q
        place = np.arange(len(q)) - np.repeat(start, np.diff(np.append(start, len(q))))
        keep = place < k
        found.append((q[keep], r[keep], exact[keep]))
    return tuple(np.concatenate(column) for column in zip(*found, strict=True))


def _search(batches: Iterator[pa.RecordBatch], k: int, resolutions: tuple[int, ...] | None) -> Iterator[pa.RecordBatch]:
    """Rows (g, asks, id, v, floor) by g -> (query_id, vec_id, score)."""

    for group in runs(batches):
        asks, ids = group.column(1).to_numpy().astype(bool), group.column(2).to_numpy()
        vectors = matrix(group.column(3))
        if asks.all() or not asks.any():
            continue
        queries, block = (Side(ids[part], vectors[part], resolutions or levels(vectors.shape[1])) for part in (asks, ~asks))
        floor = group.column(4).to_numpy()[asks].astype(np.float64)
        q, r, score = best_in_block(queries, block, k, np.where(np.isnan(floor) | (floor <= -(2.0**63)), -np.inf, floor))
        yield pa.RecordBatch.from_arrays([pa.array(queries.ids[q]), pa.array(block.ids[r]), pa.array(score)], names=["query_id", "vec_id", "score"])


def top_k(
    vectors: DataFrame, queries: Column, id: str = "vec_id", vector: str = "embedding", k: int = 5, scale: float = 256.0,
    resolutions: tuple[int, ...] | None = None, query_block: int | None = None, block: int = CANDIDATES,
) -> DataFrame:
    """The k rows of largest inner product for each query row: (query_id, rank, vec_id, score).

    Components are turned into whole numbers, floor(scale * x), so scores are exact. ``queries`` is a condition on vectors
    that says which rows ask. A row is not its own answer; ties go to the smaller id; a query with fewer than k other rows gets all.

    Queries and rows are dealt by hash into blocks, and each block of rows meets each block of queries in a task that
    keeps k answers for a query. Both block sizes are fixed (that of queries by their dimension, unless it is given), so neither side needs to fit in one
    place. One in eight blocks of rows is searched first, and the k-th score of each query there is its floor in all the others: the more rows there
    are, the higher the floors, and the fewer pairs pass the bounds. ``resolutions``: the numbers of segments, coarse to fine; else :func:`levels`.

    Null and empty vectors, those with null or non-finite components and rows of null id take no part; vectors of different length are
    not compared; repeated ids are one another's "own row"; equal rows appear as often as they occur. Whole numbers and scores beyond 64 bits
    count as the nearest ones of 64 bits; below that all are exact. Of other columns nothing is read. An empty table or no query gives an empty result.
    """
    rows = vectors.select(F.col(id).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("v"), queries.alias("asks"))
    sound = F.coalesce(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    cell = lambda x: F.when(F.abs(x) < 2.0**63 / scale, F.floor(F.lit(scale) * x)).when(x > 0, F.lit(2**63 - 1)).otherwise(F.lit(-(2**63) + 1))
    whole = rows.filter(sound & F.col("id").isNotNull() & (F.size("v") > 0)).select(
        "id", F.transform("v", cell).alias("v"), F.size("v").alias("dim"), F.coalesce("asks", F.lit(False)).alias("asks"),
    )
    count = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("asks").alias("q"), F.max(F.size("v")).alias("dim")).first()
    query_block = query_block or max(SLICE, QUERY_CELLS // max(1, count["dim"] or 1))
    row_blocks, query_blocks = max(1, -(-count["n"] // block)), max(1, -(-count["q"] // query_block))
    first = -(-row_blocks // FIRST)

    def own(blocks: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(11), "id"), F.lit(blocks)).cast("int")

    def search(asking: DataFrame, low: int, high: int) -> DataFrame:
        """The best answers from the blocks of rows from ``low`` to before ``high``."""
        kinds = [
            asking.withColumn("a", own(query_blocks)).withColumn("b", F.explode(F.sequence(F.lit(low), F.lit(high - 1)))),
            whole.withColumn("floor", F.lit(None).cast("bigint")).withColumn("asks", F.lit(False)).withColumn("b", own(row_blocks))
            .filter(F.col("b").between(low, high - 1)).withColumn("a", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)))),
        ]
        pieces = [kind.select(F.xxhash64("dim", "a", "b").alias("g"), "asks", "id", "v", "floor") for kind in kinds]
        dealt = pieces[0].union(pieces[1]).repartition("g").sortWithinPartitions("g")
        return dealt.mapInArrow(lambda batches: _search(batches, k, resolutions), "query_id bigint, vec_id bigint, score bigint")

    def best(found: DataFrame) -> DataFrame:
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

    asking = whole.filter("asks")
    found = search(asking.withColumn("floor", F.lit(None).cast("bigint")), 0, first)
    if first == row_blocks:
        return best(found)
    ahead = written(best(found), "ahead")
    floors = ahead.filter(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("floor"))
    rest = search(asking.join(floors, "id", "left"), first, row_blocks)
    return best(ahead.select("query_id", "vec_id", "score").union(rest))
