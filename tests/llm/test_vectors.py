"""Vector operators against brute force."""

import numpy as np
import pytest

from varstrata.llm.quantised import Tile, embedding_near_duplicates, links
from varstrata.llm.topk import Side, best_in_block, levels, segment_statistics, top_k
from pyspark.sql import functions as F

SCHEMA = "vec_id long, embedding array<float>, label int, g string"


def clouds(seed, n, dim=24):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dim))
    rows = []
    for i in range(n):
        v = centres[rng.integers(6)] + rng.normal(size=dim) * rng.choice([0, 0.2, 0.3, 0.4, 1.0])
        rows.append((int(i * 2), [float(x) for x in v.astype(np.float32)], int(rng.integers(3)), "x"))
    return rows + [(5001 + i, rows[3][1], rows[3][2], "copy") for i in range(5)]


ODD = [
    (9001, None, 1, "n"), (9003, [], 1, "e"), (9005, [0.0] * 24, 1, "z"), (9007, [1.0] * 23 + [None], 1, "n"), (9009, [float("nan")] * 24, 1, "n"),
    (9011, [float("inf")] * 24, 1, "i"), (9013, [1.0] * 24, None, "l"), (9015, [2.0] * 24, None, "l"), (9017, [1.0, 2.0], 1, "short"),
    (9019, [2.0, 4.0], 1, "short"), (9021, [1e-30] * 24, 2, "tiny"), (9023, [1e30] * 24, 2, "huge"), (9025, [-0.0, 1.0], 0, "m"), (9027, [0.0, 1.0], 0, "m"),
]


def sound(v, label):
    return v is not None and label is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)


@pytest.mark.parametrize("tile", [7, 512])
def test_links(spark, tile):
    rows = clouds(0, 150) + ODD
    near, label = {r[0]: set() for r in rows}, {r[0]: r[0] for r in rows}
    good = [(i, np.array(v, np.float64), l) for i, v, l, _ in rows if sound(v, l)]
    for n, (a, x, l) in enumerate(good):
        for b, y, m in good[:n]:
            if l == m and len(x) == len(y):
                x1, y1 = x / np.abs(x).max(), y / np.abs(y).max()
                if x1 @ y1 / np.sqrt((x1 @ x1) * (y1 @ y1)) >= 0.93:
                    near[a].add(b), near[b].add(a)
    for _ in range(len(rows)):
        for a in near:
            label[a] = min([label[a], *(label[b] for b in near[a])])
    out = embedding_near_duplicates(spark.createDataFrame(rows, SCHEMA), tile=tile).collect()
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in out} == {i: (len(near[i]), label[i], label[i] == i) for i in near}


def test_null_ids_and_repeats(spark):
    rows = [(None, [1.0, 0.0], 1, ""), (None, [1.0, 0.0], 1, ""), (4, [2.0, 0.0], 1, ""), (3, [1.0, 0.0], 1, ""), (3, [1.0, 0.0], 1, "")]
    out = embedding_near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.vec_id or 0, r.n_links, r.component_id or 0, r.kept) for r in out) == [
        (0, 4, 0, True), (0, 4, 0, True), (3, 4, 3, True), (3, 4, 3, True), (4, 4, 3, False)
    ]


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert embedding_near_duplicates(none).count() == 0 and top_k(none, F.col("vec_id") % 50 == 0).count() == 0


def test_bound_holds():
    rng = np.random.default_rng(4)
    x, y = (Tile(rng.normal(size=(200, 40)) * rng.choice([1e-8, 1, 1e9], (200, 1))) for _ in range(2))
    product = (x.small.astype(int) @ y.small.T.astype(int)) * x.scale[:, None] * y.scale
    bound = x.length[:, None] * y.lost + x.lost[:, None] * (y.length + y.lost)
    assert (np.abs(product - x.unit @ y.unit.T) <= bound + 1e-12).all()
    i, j = links(x, y, 0.3)
    a, b = np.nonzero(x.unit @ y.unit.T >= 0.3)
    assert set(zip(i, j, strict=True)) == set(zip(a, b, strict=True))


def brute_top(rows, k):
    whole = {i: np.floor(256 * np.array(v, np.float64)).astype(int) for i, v in rows}
    out = []
    for q in whole:
        if q % 50 == 0:
            scores = sorted((-int(whole[q] @ v), i) for i, v in whole.items() if i != q and len(v) == len(whole[q]))
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("blocks", [(3, 11), (512, 4096)])
def test_top_k(spark, blocks):
    rows = clouds(2, 200) + [r for r in ODD if r[3] != "huge"] + [(9050, [1.0, 3.0], 1, "short"), (9100, [5.0] * 3, 1, "alone"), (9150, None, 1, "")]
    frame = spark.createDataFrame(rows + [(None, [1.0] * 24, 1, "")], SCHEMA)
    out = top_k(frame, F.col("vec_id") % 50 == 0, query_block=blocks[0], block=blocks[1]).collect()
    good = [(i, v) for i, v, _, _ in rows if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v)]
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in out) == brute_top(good, 5)


def test_statistics_bound():
    rng = np.random.default_rng(1)
    x, y = rng.integers(-99, 99, (50, 30)).astype(float), rng.integers(-99, 99, (60, 30)).astype(float)
    for s in (1, 4, 7, 30, 100):
        assert (np.hstack(segment_statistics(x, s)) @ np.hstack(segment_statistics(y, s)).T >= x @ y.T - 1e-6).all()
    side = Side(np.arange(50), x.astype(np.int64), (4, 16))
    q, r, s = best_in_block(side, side, 3)
    assert (q != r).all() and len(q) == 150


def test_large_components_are_exact(spark):
    """Scores up to the end of 64 bits are exact, and beyond it cut off; no finite vector is left out."""
    rng = np.random.default_rng(7)
    rows = [(i, [float(x) for x in rng.normal(size=4)], 0, "") for i in range(60)]
    rows += [(61, [2.0**21, 1.0, 0.0, -1.0], 0, ""), (100, [2.0**30, 2.0**23 + 1, 3.0, -0.25], 0, ""), (63, [2.0**15, 2.0**20, -1.0, 0.5], 0, "")]
    rows += [(200, [1e30, 0.0, 1.0, 1.0], 0, ""), (67, [-3e38, 1.0, 1.0, 1.0], 0, ""), (69, [1e300, 1e-300, 0.0, 0.0], 0, "")]
    frame = spark.createDataFrame([r[:2] for r in rows], "vec_id long, embedding array<double>")
    edge = 2**63 - 1

    def whole(v):
        return [min(max(int(np.floor(256 * x)), -edge), edge) for x in v]

    want = []
    for q, v, *_ in rows:
        if q % 50 == 0:
            scores = sorted((-min(max(sum(x * y for x, y in zip(whole(v), whole(w))), -edge - 1), edge), i) for i, w, *_ in rows if i != q)
            want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:5])]
    for sizes in ((2, 7), (None, 4096)):
        out = top_k(frame, F.col("vec_id") % 50 == 0, query_block=sizes[0], block=sizes[1]).collect()
        assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in out) == sorted(want)


def test_floors_and_levels_exclude_pairs():
    """A floor from elsewhere leaves fewer pairs, level by level, and never one that reaches it."""
    rng = np.random.default_rng(3)
    x, y = (np.floor(256 * v / np.linalg.norm(v, axis=1, keepdims=True)).astype(np.int64) for v in (rng.normal(size=(300, 64)), rng.normal(size=(2000, 64))))
    queries, rows = Side(np.arange(300), x, levels(64)), Side(np.arange(1000, 3000), y, levels(64))
    scores = x @ y.T
    own, floor = [0] * 4, np.sort(scores, 1)[:, -1].astype(float)
    best_in_block(queries, rows, 5, left=own)
    left = [0] * 4
    q, r, s = best_in_block(queries, rows, 5, floor, left)
    assert left[0] >= left[1] >= left[2] > left[3] and left[3] < own[3] < own[0] / 1.5
    assert (np.bincount(q, minlength=300) >= 1).all() and (s == scores[q, r]).all() and (s >= floor[q]).sum() == 300
