import os
import shutil
from collections import Counter

import pytest
from pyspark.sql import functions as F

from varstrata import allocation, cumulative_stats, strata_stats, stratified_sample, windowed_stats, word_count
from varstrata.operators.allocate import rows_with_allocation
from varstrata.streaming.reservoir import admitted_to, reservoir_sample, reservoir_to
from varstrata.streaming.runner import append_to, file_stream, with_arrival_time, with_event_time
from varstrata.streaming.windows import cumulative_to, totals_to, window_gamma, windows_to
from varstrata.streaming.words import counts_to

SCHEMA = "id long, ts timestamp_ntz, key string, x double, text string"


@pytest.fixture(scope="module")
def events(spark):
    """Six days of events; one stratum has most rows, one key is null."""
    day = F.floor(F.col("id") / 200).cast("int")
    return spark.range(1200).select(
        "id",
        F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(int(id / 200), 0, int(id % 200))").alias("ts"),
        F.when(F.col("id") % 5 > 0, "hot").when(F.col("id") % 2 == 0, "cold").alias("key"),
        (F.hash("id") % 50 + 100.0 + day).alias("x"),
        F.concat_ws(" ", F.lit("One"), (F.col("id") % 7).cast("string"), F.lit("two,two")).alias("text"),
    ).persist()


@pytest.fixture()
def folder(events, tmp_path):
    """The events in four files, by time; read as a stream one file at a time."""
    path = tmp_path / "in"
    path.mkdir()
    for i in range(4):
        piece = str(tmp_path / f"piece{i}")
        events.filter(F.floor(F.col("id") / 300) == i).coalesce(1).write.parquet(piece)
        name = next(f for f in os.listdir(piece) if f.endswith(".parquet"))
        shutil.copy(os.path.join(piece, name), path / f"{i}.parquet")
        os.utime(path / f"{i}.parquet", (1_700_000_000 + i, 1_700_000_000 + i))
    return str(path)


@pytest.fixture()
def stream(spark, folder):
    return file_stream(spark, folder, SCHEMA, files_per_trigger=1)


@pytest.fixture()
def sink(tmp_path):
    return {"path": str(tmp_path / "out"), "checkpoint": str(tmp_path / "state"), "partitions": 3}


def closed(windows, end="2024-01-06"):
    """Windows that end before the last event."""
    return windows.filter(F.col("window.end") <= F.lit(end).cast("timestamp"))


def as_set(df, *columns, decimals=9):
    return {tuple(round(v, decimals) if isinstance(v, float) else v for v in r) for r in df.select(*columns).collect()}


def daily(stream):
    return windowed_stats(with_event_time(stream, "ts", "0 seconds"), "key", "x", "ts", "1 day")


def batch_daily(events):
    return windowed_stats(events.withColumn("ts", F.col("ts").cast("timestamp")), "key", "x", "ts", "1 day")


def test_windowed_totals_equal_batch(events, stream, sink):
    out = totals_to(daily(stream), **sink)
    batch = closed(batch_daily(events))
    totals = batch.groupBy("window").agg(F.sum("gamma").alias("total_gamma"))
    columns = ("window.start", "key", "n", "gamma", "total_gamma")
    assert as_set(out, *columns) == as_set(batch.join(totals, "window"), *columns)
    assert out.count() == 15


def test_window_gamma_is_a_window_over_windows(events, stream, sink):
    out = append_to(window_gamma(daily(stream), "1 day"), **sink)
    batch = closed(batch_daily(events)).groupBy("window").agg(
        F.count("*").alias("strata"), F.sum("gamma").alias("total_gamma")
    )
    # a window over windows closes one step later
    assert as_set(out, "window.start", "strata", "total_gamma") <= as_set(batch, "window.start", "strata", "total_gamma")
    assert out.count() >= 4


@pytest.mark.parametrize("closed_only", [True, False])
def test_all_windows_come(events, stream, sink, closed_only):
    out = windows_to(daily(stream), "key", closed_only=closed_only, **sink)
    batch = batch_daily(events)
    batch = closed(batch) if closed_only else batch
    columns = ("window.start", "key", "n", "mean", "sd", "low", "high", "gamma")
    assert as_set(out, *columns) == as_set(batch, *columns)
    assert out.filter("closed").count() == 15 and out.count() == (15 if closed_only else 18)


def test_totals_of_all_windows(events, stream, sink):
    out = totals_to(daily(stream), keys="key", **sink)
    batch = batch_daily(events)
    totals = batch.groupBy("window").agg(F.sum("gamma").alias("total_gamma"))
    columns = ("window.start", "key", "n", "gamma", "total_gamma")
    assert as_set(out, *columns) == as_set(batch.join(totals, "window"), *columns)


def test_cumulative_equals_batch(events, stream, sink):
    out = cumulative_to(daily(stream), "key", **sink)
    batch = cumulative_stats(batch_daily(events), "key")
    columns = ("window.start", "key", "n", "mean", "sd", "gamma")
    assert as_set(out, *columns, decimals=6) == as_set(batch, *columns, decimals=6)


def test_empty_streams_give_empty_tables(spark, events, sink, tmp_path):
    (tmp_path / "none").mkdir()
    alloc = allocation(events, "key", "x", 60)
    for i, run in enumerate((
        lambda s, p: append_to(s, **p), lambda s, p: reservoir_to(s, alloc, "key", id="id", **p), lambda s, p: admitted_to(s, alloc, "key", id="id", **p),
        lambda s, p: counts_to(s, **p), lambda s, p: windows_to(daily(s), "key", **p), lambda s, p: cumulative_to(daily(s), "key", **p),
    )):
        places = {k: f"{v}{i}" if isinstance(v, str) else v for k, v in sink.items()}
        assert run(file_stream(spark, str(tmp_path / "none"), SCHEMA), places).count() == 0


def test_values_pass_through_reservoirs_unchanged(spark, tmp_path, sink):
    rows = spark.sql(
        "select id, if(id % 3 = 0, null, 9007199254740993 + id) as big, timestamp'9999-12-31' as late,"
        " timestamp_ntz'9999-12-31' as local, 'k' as key, cast(id as decimal(30, 5)) as d from range(50)"
    )
    rows.write.parquet(str(tmp_path / "rows"))
    alloc = spark.createDataFrame([("k", 50, 20)], "key string, n long, s long")
    for name, run in (("a", reservoir_to), ("b", admitted_to)):
        places = {k: v + name if isinstance(v, str) else v for k, v in sink.items()}
        out = run(file_stream(spark, str(tmp_path / "rows"), rows.schema), alloc, "key", id="id", **places)
        assert out.select(rows.columns).exceptAll(rows).count() == 0 and out.count() == 20


def test_streams_read_tables_that_are_folders(spark, tmp_path, monkeypatch):
    from varstrata.plans import queries

    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("no test tables")
    for name in ("events", "documents"):
        spark.read.parquet(f"{sf}/{name}.parquet").repartition(4).write.parquet(f"{tmp_path}/{name}.parquet")
    for name in [n for n in queries.QUERIES if n.startswith("stream_")]:
        one, many = (queries.QUERIES[name](spark, d) for d in (sf, str(tmp_path)))
        assert sorted(map(str, one.collect())) == sorted(map(str, many.collect())), name


def test_rows_join_a_static_allocation(events, stream, sink):
    alloc = allocation(events, "key", "x", 50)
    out = append_to(rows_with_allocation(stream, alloc, "key"), **sink)
    assert as_set(out, "id", "s") == as_set(rows_with_allocation(events, alloc, "key"), "id", "s")


@pytest.mark.parametrize("hash", ["md5", "xxhash64"])
@pytest.mark.parametrize("budget", [0, 10**7])
def test_admitted_rows_hold_the_batch_sample(events, stream, sink, hash, budget):
    alloc = allocation(events, "key", "x", 60).persist()
    admitted = admitted_to(stream, alloc, "key", id="id", hash=hash, broadcast_bytes=budget, **sink)
    sample = reservoir_sample(admitted.drop("batch_id"), alloc, "key", id="id", hash=hash)
    expected = stratified_sample(events, "key", "x", 60, id="id", hash=hash)
    assert as_set(sample, "id", "key") == as_set(expected, "id", "key")
    # admissions grow with the logarithm of the stream
    assert admitted.count() < 300 and admitted.select("id").distinct().count() == admitted.count()


@pytest.mark.parametrize("m", [60, 2600])
@pytest.mark.parametrize("budget", [0, 10**7])
def test_reservoir_table_equals_the_batch_sample(events, stream, sink, m, budget):
    alloc = allocation(events, "key", "x", m)
    sample = reservoir_to(stream, alloc, "key", id="id", with_quota=True, broadcast_bytes=budget, **sink)
    expected = stratified_sample(events, "key", "x", m, id="id")
    assert as_set(sample, "id", "key") == as_set(expected, "id", "key")


def test_reservoirs_go_on_after_a_restart(spark, events, folder, sink, tmp_path):
    alloc = allocation(events, "key", "x", 60).persist()
    late = tmp_path / "late"
    late.mkdir()
    for i in (2, 3):
        shutil.move(os.path.join(folder, f"{i}.parquet"), late / f"{i}.parquet")

    def run(name):
        places = {k: v + name if isinstance(v, str) else v for k, v in sink.items()}
        source = file_stream(spark, folder, SCHEMA)
        if name == "table":
            return reservoir_to(source, alloc, "key", id="id", **places)
        admitted = admitted_to(source, alloc, "key", id="id", **places)
        return reservoir_sample(admitted.drop("batch_id"), alloc, "key", id="id")

    half = events.filter("id < 600")
    for name in ("table", "admitted"):
        assert run(name).count() == drawn_size(half, alloc)
    for i in (2, 3):
        shutil.copy(late / f"{i}.parquet", os.path.join(folder, f"{i}.parquet"))
    expected = as_set(stratified_sample(events, "key", "x", 60, id="id"), "id")
    for name in ("table", "admitted"):
        assert as_set(run(name), "id") == expected


def drawn_size(rows, alloc):
    there = Counter(r.key for r in rows.collect())
    return sum(min(there[r.key], r.s) for r in alloc.collect() if r.s > 0)


def test_word_counts_of_all_batches(spark, events, stream, sink):
    counts = counts_to(stream, **sink)
    assert as_set(counts, "word", "n") == as_set(word_count(events), "word", "n")
    # the table holds two states and does not grow with the batches
    assert spark.read.parquet(sink["path"]).count() <= 2 * counts.count()


def test_running_statistics_without_windows(spark, events, stream, sink):
    from varstrata.streaming.runner import batches_to

    out = batches_to(strata_stats(stream, "key", "x"), mode="update", **sink)
    last = out.groupBy("key").agg(F.max_by("gamma", "n").alias("gamma"), F.max("n").alias("n"))
    assert as_set(last, "key", "n", "gamma") == as_set(strata_stats(events, "key", "x"), "key", "n", "gamma")


def test_windows_on_arrival_time(stream, sink):
    stamped = with_arrival_time(stream).withWatermark("arrived", "0 seconds")
    stats = windowed_stats(stamped, "key", "x", "arrived", "1 hour")
    assert stats.isStreaming and stats.schema["window"].dataType["start"].dataType.typeName() == "timestamp"


def test_session_settings_are_put_back(spark, stream, sink):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    counts_to(stream, **sink)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_queries_do_not_depend_on_the_sessions_zone(spark):
    from varstrata.plans import queries
    from varstrata.plans.runtime import settings

    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("no test tables")
    for name in ("windowed_total_events", "windowed_sample_events", "stream_windowed_total", "stream_windowed_sample"):
        want = sorted(map(str, queries.QUERIES[name](spark, sf).collect()))
        with settings(spark, spark__sql__session__timeZone="Asia/Tokyo"):
            assert sorted(map(str, queries.QUERIES[name](spark, sf).collect())) == want, name


def test_a_first_batch_of_everything_writes_few_rows(events, spark, folder, sink, monkeypatch):
    from varstrata.operators import sample
    from varstrata.streaming import reservoir

    alloc = allocation(events, "key", "x", 60).persist()
    wanted = sum(r.s for r in alloc.collect())
    counted = []

    def spy(df, real=sample.materialize):
        out = real(df)
        counted.append(out.count())
        return out

    monkeypatch.setattr(sample, "materialize", spy)
    monkeypatch.setattr(reservoir, "materialize", spy)
    reservoir_to(file_stream(spark, folder, SCHEMA), alloc, "key", id="id", **sink)
    assert 0 < sum(counted) <= 3 * wanted < events.count()
