"""Mixtures: deviation from the weights, wholeness, and the schedule against a plain simulation."""

import random
import re
from collections import Counter


from varstrata.llm.mixing import in_order, mix, period_slots, target_shares
from varstrata.plans.runtime import settings


def simulate(shares):
    """Earliest deadline first, slot by slot."""
    names = sorted(shares, key=lambda s: (shares[s], s is not None, s or ""))
    p, done, out = sum(shares.values()), dict.fromkeys(shares, 0), []
    for slot in range(p):
        open_ = [
            (-((-(done[s] + 1) * p) // shares[s]), names.index(s)) for s in names
            if done[s] < shares[s] and done[s] * p // shares[s] <= slot
        ]
        s = names[min(open_)[1]]
        done[s] += 1
        out.append(s)
    return out


def test_schedule(spark):
    rng = random.Random(0)
    for trial in range(4):
        sizes = {f"s{i}": rng.choice([1, 10, 400, 3000, 90_000]) for i in range(rng.choice([1, 3, 12]))}
        table = target_shares(spark.createDataFrame(list(sizes.items()), "source string, n long"), period=200)
        shares = {r.source: r.a for r in table.collect()}
        slots = [r.source for r in period_slots(table).orderBy("slot").collect()]
        assert slots == simulate(shares)
        done = Counter()
        for t, s in enumerate(slots, 1):
            done[s] += 1
            for name, a in shares.items():
                assert abs(done[name] - t * a / len(slots)) < 1


def rows_of(spark, n, seed=1):
    rng = random.Random(seed)
    data = [(i, rng.choice(["a"] * 6 + ["b", "b", "c", None]), f"text {i}", "own") for i in range(n)]
    return spark.createDataFrame(data, "doc_id long, source string, text string, place string")


def test_prefixes_follow_weights(spark):
    docs = rows_of(spark, 3000)
    weights = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 1.0), (None, 0.5), ("none", 9.0)], "source string, weight double")
    clashing = docs.selectExpr("*", "1 a", "2 p", "3 k", "4 slot", "5 n", "6 o", "7 t")
    out = mix(clashing, weights=weights.filter("source is null or source != 'none'"), block_rows=4, period=100).collect()
    assert all((r.a, r.p, r.k, r.slot, r.n, r.o, r.t) == (1, 2, 3, 4, 5, 6, 7) for r in out)
    assert sorted(r.doc_id for r in out) == list(range(3000))
    blocks = sorted({(r.place.slot, r.source) for r in out}, key=lambda x: x[0])
    assert len({slot for slot, _ in blocks}) == len(blocks)
    total = Counter(s for _, s in blocks)
    p = sum(round(100 * w / 4.5) for w in (1, 2, 1, 0.5))
    done = Counter()
    for t, (slot, source) in enumerate(blocks, 1):
        assert slot == t - 1
        done[source] += 1
        for name, w in (("a", 1), ("b", 2), ("c", 1), (None, 0.5)):
            assert abs(done[name] - t * round(100 * w / 4.5) / p) < 1
        if any(done[s] == total[s] for s in total):
            break
    for r in out:
        assert r.place.release <= r.place.slot < r.place.deadline
    per_block = Counter((r.source, r.place.block) for r in out)
    assert all(n == 4 for (s, b), n in per_block.items() if b < total[s] - 1)


def test_order_and_repeatability(spark):
    docs = rows_of(spark, 500).unionByName(rows_of(spark, 3))
    mixed = mix(docs)
    again = mix(docs.repartition(3))
    key = ["doc_id", "place.slot", "place.at"]
    assert sorted(map(tuple, mixed.select(*key).collect())) == sorted(map(tuple, again.select(*key).collect()))
    ordered = in_order(mixed, rows_per_file=100)
    assert ordered.columns == ["doc_id", "source", "text"] and ordered.count() == 503
    ids = [r.doc_id for r in ordered.collect()]
    assert ids == [r.doc_id for r in mixed.orderBy("place.slot", "place.at").collect()]


def test_odd_rows(spark):
    schema = "doc_id long, source string"
    assert mix(spark.createDataFrame([], schema)).count() == 0
    assert in_order(mix(spark.createDataFrame([], schema))).count() == 0
    out = mix(spark.createDataFrame([(None, None), (None, None), (1, None), (1, None), (2, "x")], schema)).collect()
    assert len(out) == 5 and len({(r.place.slot, r.place.at) for r in out}) == 5
    zero = spark.createDataFrame([("x", 0.0)], "source string, weight double")
    assert mix(spark.createDataFrame([(1, "x"), (2, "y")], schema), weights=zero).count() == 2


def test_many_sources(spark):
    """Ten thousand sources: one of half the weight keeps it at every point, and no source is a block or more off."""
    weights = spark.range(10_000).selectExpr("concat('s', id) source", "if(id = 0, 9999.0, 1.0 + id % 2) n")
    table = target_shares(weights, temperature=1.0)
    shares = {r.source: (r.a, r.p) for r in table.collect()}
    slots = [r.source for r in period_slots(table).orderBy("slot").collect()]
    a, p = shares["s0"]
    assert abs(a / p - 9999 / (9999 + 1.5 * 10_000)) < 0.01 and len(slots) == p == sum(x for x, _ in shares.values())
    done = Counter()
    for t, s in enumerate(slots, 1):
        done[s] += 1
        assert abs(done[s] - t * shares[s][0] / p) < 1
        assert abs(done["s0"] - t * a / p) < 1
    assert done == {s: x for s, (x, _) in shares.items()}


def test_rows_without_id_are_spread(spark):
    docs = spark.range(2000).selectExpr("cast(null as long) doc_id", "'s' source", "concat('text ', id) text", "map('a', id) m")
    out = mix(docs).collect()
    assert len(out) == 2000 and len({(r.place.slot, r.place.at) for r in out}) == 2000
    assert [r.text for r in sorted(out, key=lambda r: (r.place.slot, r.place.at))] != sorted(r.text for r in out)
    again = mix(docs.repartition(5)).collect()
    assert {(r.text, r.place.slot, r.place.at) for r in out} == {(r.text, r.place.slot, r.place.at) for r in again}


def test_texts_are_shuffled_once(spark):
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false"):
        mixed = mix(rows_of(spark, 300))
        plan = mixed._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    exchanges = re.findall(r"\) Exchange\nInput \[\d+\]: (\[.*\])", plan)
    assert sum("text#" in columns for columns in exchanges) == 1
