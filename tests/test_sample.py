import hashlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from varstrata import windowed_allocation, windowed_sample
from varstrata import (
    allocation,
    first_fill_allocated,
    first_fill_sample,
    sample_allocated,
    stratified_sample,
)
from varstrata.functions import ranks
from varstrata.operators import sample as sample_module


@pytest.fixture(scope="module")
def rows(spark):
    """12,000 rows: one stratum has 90 % of them, one key is null, some strata are tiny."""
    hot = F.when(F.col("id") % 10 != 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") / 10 % 40).cast("int")))
    key = F.when(F.col("id") % 1000 == 500, None).otherwise(hot)
    df = spark.range(12000).select(
        F.col("id"), key.alias("key"), (F.hash("id") % 1000 / 10.0 + 200).alias("x"), F.lit("p").alias("note")
    )
    return df.repartition(6).persist()


def quotas_of(alloc):
    return {r.key: (r.n, r.s) for r in alloc.collect()}


def expected_ids(rows, alloc, seed=42):
    """Brute force: the ids of lowest md5 rank in every stratum."""
    groups = defaultdict(list)
    for r in rows.select("id", "key").collect():
        groups[r.key].append((hashlib.md5(f"{seed}|{r.id}".encode()).hexdigest(), r.id))
    out = set()
    for key, (_, s) in quotas_of(alloc).items():
        out.update(i for _, i in sorted(groups[key])[: max(s, 0)])
    return out


def ids(df):
    found = [r.id for r in df.select("id").collect()]
    assert len(found) == len(set(found))
    return set(found)


@pytest.fixture(scope="module")
def small(rows):
    return allocation(rows, "key", "x", 300).persist()


@pytest.mark.parametrize(
    "options",
    [
        {},
        {"broadcast_bytes": 0},
        {"broadcast_bytes": 450},
        {"rows_per_task": 1000},
        {"slack": -1e9},
        {"slack": -1e9, "broadcast_bytes": 0, "rows_per_task": 1000},
    ],
    ids=["plain", "no_broadcast", "hot_broadcast", "salted", "redraw_all", "redraw_salted"],
)
def test_every_plan_gives_the_brute_force_sample(rows, small, options):
    drawn = sample_allocated(rows, small, "key", id="id", hash="md5", **options)
    assert drawn.columns == rows.columns
    assert ids(drawn) == expected_ids(rows, small)


@pytest.mark.parametrize("options", [{}, {"broadcast_bytes": 0}, {"slack": -1e9}], ids=["plain", "shuffled", "redraw"])
def test_quotas_above_the_group_limit_are_ranked_by_range(rows, options):
    alloc = allocation(rows, "key", "x", 300).withColumn("s", F.when(F.col("key") == "hot", 4321).otherwise(F.col("s")))
    assert ids(sample_allocated(rows, alloc, "key", id="id", hash="md5", **options)) == expected_ids(rows, alloc)


@pytest.mark.parametrize("options", [{"hash": "md5"}, {"hash": "xxhash64"}, {"broadcast_bytes": 0}, {"id": None}])
def test_rows_above_every_cut_off_are_left_out_early(rows, options):
    hot = rows.filter("key = 'hot' or key = 'k0'").withColumn("key", F.coalesce(F.when(F.col("id") % 2 == 0, "a"), F.lit("b")))
    alloc = allocation(hot, "key", "x", 20)
    options = {"id": "id", **options}
    drawn = sample_allocated(hot, alloc, "key", **options)
    everything = sample_allocated(hot, alloc, "key", slack=1e9, **options)
    assert drawn.count() == everything.count() == 20
    if options["id"]:
        assert ids(drawn) == ids(everything)


def test_quota_above_stratum_size_takes_all(rows):
    alloc = allocation(rows, "key", "x", 300).withColumn("s", F.lit(20000).cast("bigint"))
    assert ids(sample_allocated(rows, alloc, "key", id="id")) == set(range(12000))


def test_same_sample_whatever_the_partitioning(rows):
    first = ids(stratified_sample(rows, "key", "x", 300, id="id"))
    assert ids(stratified_sample(rows.repartition(1), "key", "x", 300, id="id")) == first
    assert ids(stratified_sample(rows.repartition(13, "x"), "key", "x", 300, id="id")) == first
    assert ids(stratified_sample(rows, "key", "x", 300, id="id", seed=7)) != first


@pytest.mark.parametrize("options", [{"hash": "xxhash64", "id": "id"}, {"id": None}], ids=["xxhash64", "random"])
@pytest.mark.parametrize("budget", [0, 10**7])
def test_other_ranks_give_exact_sizes(rows, small, options, budget):
    drawn = sample_allocated(rows, small, "key", broadcast_bytes=budget, with_quota=True, **options)
    found = Counter(r.key for r in drawn.collect())
    assert found == {k: min(n, s) for k, (n, s) in quotas_of(small).items() if s > 0}
    ids(drawn)
    assert {(r.key, r.n, r.s) for r in drawn.collect()} <= {(k, n, s) for k, (n, s) in quotas_of(small).items()}


@pytest.mark.parametrize("m", [300, 9000])
@pytest.mark.parametrize("per_task", [1000, 10**6])
def test_copies_of_one_row_do_not_change_sizes(spark, m, per_task):
    # a third of all rows share one id, so they all lie on the same side of any cut-off
    df = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("id"),
        F.when(F.col("id") % 9 == 1, "b").otherwise("a").alias("key"),
        (F.col("id") % 7 + 1.0).alias("x"),
    )
    alloc = allocation(df, "key", "x", m)
    for seed in (1, 2, 3):
        drawn = sample_allocated(df, alloc, "key", id="id", seed=seed, rows_per_task=per_task)
        found = Counter(r.key for r in drawn.collect())
        assert found == {k: min(n, s) for k, (n, s) in quotas_of(alloc).items()}


def test_counts_of_another_table_still_give_what_there_is(rows, small):
    part = rows.filter(F.col("id") < 300)
    drawn = Counter(r.key for r in sample_allocated(part, small, "key", id="id").collect())
    there = Counter(r.key for r in part.collect())
    assert drawn == {k: min(there[k], s) for k, (_, s) in quotas_of(small).items() if s > 0 and there[k]}


def test_inclusion_is_uniform(spark):
    # 400 strata of 20 rows, 5 drawn from each: every place is drawn in about a quarter of them
    df = spark.range(8000).select(F.floor(F.col("id") / 20).alias("run"), (F.col("id") % 20).alias("place"))
    alloc = df.groupBy("run").agg(F.count("*").alias("n"), F.lit(5).cast("bigint").alias("s"))
    drawn = sample_allocated(df, alloc, "run", id=["run", "place"])
    found = Counter(r.place for r in drawn.collect())
    assert sum(found.values()) == 2000
    sigma = (400 * 0.25 * 0.75) ** 0.5
    assert all(abs(found[p] - 100) < 4.5 * sigma for p in range(20))


def test_cut_off_agrees_with_the_rank(spark):
    df = spark.range(20000).withColumn("id", F.col("id").cast("string"))
    for kind in ranks.KINDS:
        below = df.filter(ranks.rank(["id"], 5, kind) <= ranks.cut_off(F.lit(0.125), ["id"], kind)).count()
        assert abs(below - 2500) < 5 * (20000 * 0.125 * 0.875) ** 0.5
        assert df.filter(ranks.rank(["id"], 5, kind) <= ranks.cut_off(F.lit(1.0), ["id"], kind)).count() == 20000


def test_edge_strata(edge):
    df = edge(
        ("one", "", "5", "r1"), ("same", "", "2", "r2"), ("same", "", "2", "r3"),
        ("neg", "", "-1", "r4"), ("neg", "", "-3", "r5"), (None, "", "1", "r6"), (None, "", "9", "r7"),
    )
    drawn = stratified_sample(df, "k1", "x", 4, id="note")
    assert {r.note for r in drawn.collect()} == {"r6", "r7"}
    none = stratified_sample(df.filter("k1 in ('one', 'same')"), "k1", "x", 4, id="note", with_quota=True)
    assert none.count() == 0 and none.columns == ["k1", "k2", "x", "note", "n", "s"]


def test_dropped_measures_are_not_sampled(edge):
    df = edge(("a", "", "1", "r1"), ("a", "", "bad", "r2"), ("a", "", "9", "r3"))
    drawn = stratified_sample(df, "k1", "x", 10, id="note", bad_measure="drop")
    assert {r.note for r in drawn.collect()} == {"r1", "r3"}


def test_column_names_with_dots(spark):
    df = spark.range(60).select(
        (F.col("id") % 3).cast("string").alias("District.Name"), F.col("id").alias("row.id"), F.col("id").alias("Number")
    )
    drawn = stratified_sample(df, "district.name", "number", 9, id="row.id")
    assert drawn.columns == df.columns and drawn.count() == 9


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plan_cuts_before_the_only_shuffle(spark, small, rows, monkeypatch, tmp_path):
    path = str(tmp_path / "rows")
    rows.write.parquet(path)
    seen = []
    monkeypatch.setattr(sample_module, "materialize", lambda df: (seen.append(df), df)[1])
    sample_allocated(spark.read.parquet(path), small, "key", id="id", hash="md5")
    text = plan(seen[0])
    # one shuffle of rows (the other exchange is the broadcast), trimmed on its way in
    assert text.count("Exchange hashpartitioning") == 1
    assert "WindowGroupLimit" in text and "Partial" in text
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    shuffle = text.index("Exchange hashpartitioning")
    assert text.index("BroadcastHashJoin") > shuffle and text.index("md5") > shuffle


def test_plan_without_broadcast_shares_one_partitioning(spark, small, rows, monkeypatch):
    seen = []
    monkeypatch.setattr(sample_module, "materialize", lambda df: (seen.append(df), df)[1])
    sample_allocated(rows, small, "key", id="id", broadcast_bytes=0)
    text = plan(seen[0])
    # rows and quotas are shuffled for the join; ranking reuses that partitioning
    assert text.count("Exchange hashpartitioning") == 2


def brute_first_fill(rows, alloc):
    groups = defaultdict(list)
    for r in rows.collect():
        groups[r.key].append(r.id)
    out = set()
    for key, (n, s) in quotas_of(alloc).items():
        if 0 < s <= n:
            out.update(sorted(groups[key])[:s])
    return out


@pytest.mark.parametrize("m", [300, 2000])
def test_first_fill_takes_the_first_rows(rows, m):
    alloc = allocation(rows, "key", "x", m)
    expected = brute_first_fill(rows, alloc)
    assert ids(first_fill_sample(rows, "key", "x", m, arrival="id")) == expected
    for options in ({"broadcast_bytes": 0}, {"rows_per_task": 1000}):
        assert ids(first_fill_allocated(rows, alloc, "key", arrival="id", **options)) == expected


@pytest.mark.parametrize("options", [{}, {"broadcast_bytes": 0}, {"broadcast_bytes": 450}])
def test_first_fill_above_the_group_limit(rows, options):
    alloc = allocation(rows, "key", "x", 300).withColumn("s", F.when(F.col("key") == "hot", 4321).otherwise(F.col("s")))
    found = ids(first_fill_allocated(rows, alloc, "key", arrival="id", **options))
    assert found == brute_first_fill(rows, alloc)


def test_first_fill_above_the_group_limit_with_ties_and_nulls(rows):
    coarse = rows.withColumn("minute", F.when(F.col("id") % 50 != 0, F.floor(F.col("id") / 3000)))
    alloc = allocation(rows, "key", "x", 300).withColumn("s", F.when(F.col("key") == "hot", 4321).otherwise(F.col("s")))
    found = ids(first_fill_allocated(coarse, alloc, "key", arrival=["minute", "id"]))
    groups = defaultdict(list)
    for r in coarse.collect():
        groups[r.key].append((r.minute is not None, r.minute or 0, r.id))
    assert found == {i for k, (n, s) in quotas_of(alloc).items() if 0 < s <= n for _, _, i in sorted(groups[k])[:s]}


def test_first_fill_of_text_times(rows):
    named = rows.withColumn("time", F.lpad(F.col("id").cast("string"), 6, "0"))
    alloc = allocation(rows, "key", "x", 300).withColumn("s", F.when(F.col("key") == "hot", 4321).otherwise(F.col("s")))
    assert ids(first_fill_allocated(named, alloc, "key", arrival="time")) == brute_first_fill(rows, alloc)


def test_first_fill_gives_nothing_for_small_strata(edge):
    df = edge(("a", "", "1", "r1"), ("a", "", "9", "r2"), ("b", "", "1", "r3"), ("b", "", "3", "r4"))
    assert first_fill_sample(df, "k1", "x", 100, arrival="note").count() == 0
    assert stratified_sample(df, "k1", "x", 100, id="note").count() == 4


def test_a_stratum_with_more_rows_than_counted_does_not_hide_one_with_fewer(spark):
    rows = spark.range(20_000).select("id", F.when(F.col("id") < 10, "a").otherwise("b").alias("k"))
    alloc = spark.createDataFrame([("a", 5, 10), ("b", 315_000, 10)], "k string, n long, s long")
    sizes = {r.k: r["count"] for r in sample_allocated(rows, alloc, "k", id="id", seed=1).groupBy("k").count().collect()}
    assert sizes == {"a": 10, "b": 10}


def test_windowed_sample_sizes(spark):
    rows = spark.range(3000).select(
        "id", F.expr("timestamp'2024-01-01' + make_dt_interval(int(id % 4), int(id % 24))").alias("ts"),
        F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") % 2 == 0, "cold").alias("key"), (F.hash("id") % 90 + 100.0).alias("x"),
    ).union(spark.sql("select 9999L, cast(null as timestamp), 'hot', 1.0D"))
    alloc = windowed_allocation(rows.filter("ts is not null"), "key", "x", "ts", "1 day", 40).persist()
    want = {(r.window.start, r.key): min(r.s, r.n) for r in alloc.collect() if r.s > 0}
    sample = windowed_sample(rows, "key", "x", "ts", "1 day", 40, id="id", with_quota=True)
    got = {(r.start, r.key): r["count"] for r in sample.groupBy(F.col("window.start").alias("start"), "key").count().collect()}
    assert got == want and len(got) > 6 and sample.select("id").distinct().count() == sample.count()


def test_large_quotas_of_few_candidates_are_ranked_by_a_plain_window(spark, rows, monkeypatch):
    from varstrata.operators import lowest

    monkeypatch.setattr(lowest, "_ranged", lambda *a: pytest.fail("cut into ranges"))
    alloc = rows.groupBy("key").agg(F.count("*").alias("n")).withColumn("s", F.lit(1500).cast("bigint")).persist()
    assert ids(sample_allocated(rows, alloc, "key", id="id", hash="md5")) == expected_ids(rows, alloc)


def test_first_fill_ranks_only_early_rows(rows, monkeypatch):
    seen = []
    keep = sample_module.keep_lowest
    monkeypatch.setattr(sample_module, "keep_lowest", lambda df, *a, **b: seen.append(df.count()) or keep(df, *a, **b))
    first_fill_sample(rows, "key", "x", 30, arrival="id").count()
    assert 0 < sum(seen) < rows.count() / 4
