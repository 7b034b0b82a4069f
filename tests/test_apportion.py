"""Quotas that add up, against a division worked out in exact fractions."""

import random
from fractions import Fraction

import pytest

from varstrata import apportioned, apportioned_allocation, sample_allocated
from varstrata.operators import lowest

SCHEMA = "k string, n long, gamma double"


def divided(rows, m):
    """Water-filling one stratum at a time, then the largest remainders."""
    budget = min(max(int(m), 0), sum(n for _, n, _ in rows))
    weight = {k: Fraction(g) if g is not None and 0 < g < float("inf") else Fraction(0) for k, _, g in rows}
    size = {k: n for k, n, _ in rows}
    share = dict.fromkeys(size, Fraction(0))
    varied = sum(n for k, n in size.items() if weight[k])
    if varied < budget:
        for k, n in size.items():
            share[k] = Fraction(n) if weight[k] else Fraction(n * (budget - varied), sum(size.values()) - varied)
    else:
        left, still = Fraction(budget), sorted((k for k in size if weight[k]), key=lambda k: size[k] / weight[k])
        while still:
            k = still[0]
            level = left / sum(weight[j] for j in still)
            if level * weight[k] < size[k]:
                share.update({j: level * weight[j] for j in still})
                break
            share[k], left, still = Fraction(size[k]), left - size[k], still[1:]
    out = {k: int(v) for k, v in share.items()}
    spare = budget - sum(out.values())
    order = sorted((k for k in out if out[k] < size[k]), key=lambda k: (-(share[k] - out[k]), k is not None, k or ""))
    for k in order[:spare]:
        out[k] += 1
    return out


def quotas(spark, rows, m):
    return {r.k: r.s for r in apportioned(spark.createDataFrame(rows, SCHEMA), "k", m).collect()}


@pytest.mark.parametrize("seed", range(4))
def test_equals_exact_division(spark, seed):
    draw = random.Random(seed)
    rows = [(f"k{i:03}", draw.choice([1, 2, 5, 40, 1000]), draw.choice([0.0, -1.0, 0.125, 0.25, 1.5, 3.0, draw.random()])) for i in range(60)]
    rows += [(None, 7, 0.5), ("inf", 3, float("inf")), ("nan", 3, float("nan")), ("none", 3, None)]
    total = sum(n for _, n, _ in rows)
    for m in (draw.randrange(total), total - 5):
        got = quotas(spark, rows, m)
        assert got == divided(rows, m)
        assert sum(got.values()) == m and all(got[k] <= n for k, n, _ in rows)


@pytest.mark.parametrize("m, want", [(-3, 0), (0, 0), (0.9, 0), (10**12, 12)])
def test_budgets_beyond_the_ends(spark, m, want):
    assert sum(quotas(spark, [("a", 5, 0.5), ("b", 7, 0.0)], m).values()) == want


def test_no_strata_and_ties(spark):
    assert quotas(spark, [], 5) == {}
    assert quotas(spark, [("b", 9, 1.0), (None, 9, 1.0), ("a", 9, 1.0)], 5) == {None: 2, "a": 2, "b": 1}


def test_remainders_by_ranges(spark, monkeypatch):
    """More remainders than the planner trims, and strata that no task may hold: the ranked cut by ranges."""
    monkeypatch.setattr(lowest, "group_limit", lambda spark: 3)
    rows = [(f"k{i:03}", 9, 1.0) for i in range(50)]
    from varstrata.operators import apportion

    plain = lowest.keep_lowest
    monkeypatch.setattr(apportion, "keep_lowest", lambda *a, **k: plain(*a, **{**k, "rows_per_task": 10}))
    assert quotas(spark, rows, 75) == divided(rows, 75)


def test_sample_takes_the_whole_budget(spark):
    df = spark.range(1000).selectExpr("id", "id % 7 AS k", "double((id * 37) % 101 + 1) AS x", "'t' AS s", "1 AS gamma")
    alloc = apportioned_allocation(df.select("id", "k", "x"), "K", "x", 123)
    assert alloc.agg({"s": "sum"}).first()[0] == 123
    assert sample_allocated(df.select("id", "k", "x"), alloc, "k", id="id").count() == 123
