"""Near-duplicate vectors by tile products of quantised vectors with error bounds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varstrata.llm.components import components
from varstrata.llm.groups import matrix, runs
from varstrata.plans.runtime import written

COSINE = 0.93
TILE = 512
_EXACT = 1024  # products of this many int8 pairs add up exactly in single precision


class Tile:
    """Unit vectors, their int8 form, and for each a bound of what quantising loses."""

    def __init__(self, vectors: np.ndarray):
        self.full = vectors
        self.norm = np.sqrt((vectors * vectors).sum(1))
        unit = vectors / np.abs(vectors).max(1, keepdims=True)  # no overflow or underflow of squares
        unit /= np.sqrt((unit * unit).sum(1, keepdims=True))
        self.unit = unit
        self.scale = np.abs(unit).max(1) / 127
        self.small = np.rint(unit / self.scale[:, None]).astype(np.int8)
        kept = self.small * self.scale[:, None]
        self.lost = np.sqrt(((unit - kept) ** 2).sum(1))
        self.length = np.sqrt((kept * kept).sum(1))

    def __len__(self) -> int:
        return len(self.full)


def links(x: Tile, y: Tile, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) of rows with a cosine of at least ``cosine`` in double precision.

    With x = x' + e and y = y' + f, xy differs from x'y' by at most |x'||f| + |e||y'| + |e||f|. Only pairs whose bound
    reaches the threshold are computed in full. Products of int8 numbers are exact in single precision up to 1024 at once.
    """
    product = np.zeros((len(x), len(y)))
    for low in range(0, x.small.shape[1], _EXACT):
        product += x.small[:, low : low + _EXACT].astype(np.float32) @ y.small[:, low : low + _EXACT].astype(np.float32).T
    product *= x.scale[:, None] * y.scale[None, :]
    product += x.length[:, None] * y.lost[None, :] + x.lost[:, None] * (y.length + y.lost)[None, :]
    i, j = np.nonzero(product >= cosine - 1e-9)
    exact = np.empty(len(i))
    for low in range(0, len(i), 65_536):
        part = slice(low, low + 65_536)
        exact[part] = (x.unit[i[part]] * y.unit[j[part]]).sum(1)
    near = exact >= cosine
    return i[near], j[near]


def _forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of n nodes the least node that pairs lead to."""
    label = np.arange(n)
    while len(i):
        before = label.copy()
        np.minimum.at(label, i, label[j])
        np.minimum.at(label, j, label[i])
        label = label[label]
        if (before == label).all():
            break
    return label


def _compare(batches: Iterator[pa.RecordBatch], cosine: float) -> Iterator[pa.RecordBatch]:
    """Rows (g, side, id, weight, vector) by g and side -> (id, n, other): links of a vector found in a tile pair, and one of them."""

    for group in runs(batches):
        side, ids, weight = (group.column(k).to_numpy() for k in (1, 2, 3))
        vectors = matrix(group.column(4))
        a, b = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        x = Tile(vectors[a]) if len(a) else None
        if side[0] == 2:  # a tile with itself
            x = Tile(vectors)
            i, j = links(x, x, cosine)
            keep = i < j
            i, j = i[keep], j[keep]
        elif len(a) and len(b):
            i, j = links(x, Tile(vectors[b]), cosine)
            i, j = a[i], b[j]
        else:
            i = j = np.zeros(0, np.int64)
        n = np.bincount(i, weight[j], len(ids)) + np.bincount(j, weight[i], len(ids))
        label = _forest(len(ids), i, j)
        out = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids[out]), pa.array(n[out].astype(np.int64)), pa.array(ids[label[out]])], names=["id", "n", "other"]
        )


def embedding_near_duplicates(
    vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label", cosine: float = COSINE, tile: int = TILE
) -> DataFrame:
    """One row for each of vectors: (id, n_links, component_id, kept).

    Rows of one label (and length) are linked if the cosine of their vectors, in double precision, is ``cosine`` or
    more. n_links counts the other rows linked directly, component_id is the smallest id that links lead to, kept says whether it is the row's own.

    Equal vectors of a label are one class, whose rows are linked with each other. Classes of a label are dealt into tiles of about
    ``tile`` by hash, and every two tiles of a label are one piece of work: a large label is many pieces, a row goes to
    as many as its label has tiles. A piece returns counts and one partner for each vector, not pairs.

    Null, empty and zero vectors and those with null or non-finite components, and rows of null label, are linked with
    nothing; rows of null id count as links of others but have no component themselves (null, kept). Repeated rows are rows with equal
    vectors. An empty table gives an empty result. Of other columns nothing is read. ids are whole numbers.
    """
    rows = vectors.select(F.col(id).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("v"), F.col(label).alias("label"))
    sound = F.coalesce(
        F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0), F.lit(False)
    ) & F.col("label").isNotNull()
    rows = rows.select("id", "label", F.when(sound, F.transform("v", lambda x: x + F.lit(0.0))).alias("v"), sound.alias("sound"))
    # two hashes name a vector: equal vectors have equal ones
    key = [F.xxhash64("v").alias("k1"), F.xxhash64(F.lit(1), F.col("v")).alias("k2")]
    good = rows.filter("sound").select("id", "label", "v", *key)
    own = F.xxhash64("label", "k1", "k2")
    classes = written(
        good.groupBy("label", "k1", "k2").agg(F.count(F.lit(1)).alias("weight"), F.min("id").alias("low"), F.first("v").alias("v"))
        .withColumn("class", own), "classes"
    )
    sizes = classes.groupBy("label", F.size("v").alias("dim")).agg(F.count(F.lit(1)).alias("n")).select(
        "label", "dim", F.ceil(F.col("n") / F.lit(tile)).cast("int").alias("tiles")
    )
    dealt = (
        classes.withColumn("dim", F.size("v")).join(sizes, ["label", "dim"])
        .withColumn("own", F.pmod(F.xxhash64(F.lit(7), "class"), F.col("tiles")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    )
    piece = F.xxhash64("label", "dim", F.least("own", "other"), F.greatest("own", "other"))
    side = F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1)
    pieces = dealt.select(piece.alias("g"), side.alias("side"), "class", "weight", "v").repartition("g").sortWithinPartitions("g", "side")

    found = written(pieces.mapInArrow(lambda b: _compare(b, cosine), "id bigint, n bigint, other bigint"), "found")
    counts = found.groupBy("id").agg(F.sum("n").alias("n")).withColumnRenamed("id", "class")
    groups = components(found.filter("id != other"), "id", "other")
    whole = classes.select("class", "low", "label", "k1", "k2", "weight").join(groups.withColumnRenamed("node", "class"), "class", "left").withColumn(
        "root", F.coalesce("component", "class")
    )
    least = whole.groupBy("root").agg(F.min("low").alias("component_id"))
    named = whole.join(counts, "class", "left").join(least, "root").select(
        "label", "k1", "k2", (F.col("weight") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), "component_id"
    )
    keyed = rows.select("id", "label", "sound", *key)
    out = keyed.join(named, ["label", "k1", "k2"], "left")
    linked = F.col("sound") & F.col("id").isNotNull()
    component = F.when(linked, F.col("component_id")).otherwise(F.col("id"))
    return out.select(
        F.col("id").alias(id), F.when(F.col("sound"), F.col("n_links")).otherwise(F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"), (F.col("id").isNull() | (F.col("id") == component)).alias("kept"),
    )
