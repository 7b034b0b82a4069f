"""Joins of two running streams, and statistics that are carried forward, over several micro-batches and runs."""

import os

import pytest
from pyspark.sql import functions as F

from varstrata import cumulative_stats, windowed_sample, windowed_stats
from varstrata.operators.sample import with_window
from varstrata.streaming.carried import carried_to, held_strata
from varstrata.streaming.joined import joined_stream, stream_sample_to
from varstrata.streaming.runner import file_stream, with_event_time

SCHEMA = "id long, ts timestamp, key string, x double"


class Feed:
    """A folder of files, each a micro-batch, with rows (id, day, hour, key, x)."""

    def __init__(self, spark, path):
        self.spark, self.path, self.files, self.rows = spark, str(path), 0, []

    def add(self, rows):
        frame = self.frame(rows)
        target = f"{self.path}/{self.files:03d}"
        frame.coalesce(1).write.parquet(target)
        for name in os.listdir(target):
            if name.endswith(".parquet"):
                os.utime(f"{target}/{name}", (1_700_000_000 + self.files, 1_700_000_000 + self.files))
        self.files += 1
        self.rows += rows

    def frame(self, rows):
        at = F.expr("timestamp'2024-01-01 00:00:00' + make_dt_interval(day, hour)")
        plain = self.spark.createDataFrame(rows, "id long, day int, hour int, key string, x double")
        return plain.select("id", at.alias("ts"), "key", "x")

    def stream(self):
        files = file_stream(self.spark, f"{self.path}/*", SCHEMA, files_per_trigger=1)
        return with_event_time(files, "ts", "0 seconds")

    def table(self):
        return self.frame(self.rows)


@pytest.fixture()
def feed(spark, tmp_path):
    return Feed(spark, tmp_path / "in")


@pytest.fixture()
def sink(tmp_path):
    return {"path": str(tmp_path / "out"), "checkpoint": str(tmp_path / "state"), "partitions": 1}


def some_days(first, last, keys=("hot", "hot", "hot", "cold", None), per_day=30):
    return [
        (day * 1000 + i, day, i % 24, keys[i % len(keys)], float((day * 31 + i * 17) % 23)) for day in range(first, last) for i in range(per_day)
    ]


def daily(stream):
    return windowed_stats(stream, "key", "x", "ts", "1 day")


def closed(windows, days):
    return windows.filter(F.col("window.end") <= F.expr(f"timestamp'2024-01-01' + make_dt_interval({days})"))


def as_set(df, *columns):
    return {tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(*columns).collect()}


def sampled(feed, sink, salts=8):
    stream = feed.stream()
    return stream_sample_to(with_window(stream, "ts", "1 day"), daily(feed.stream()), "key", 12, id="id", salts=salts, **sink)


def test_sample_of_two_streams_equals_batch(feed, sink):
    for first in (0, 3, 6):
        feed.add(some_days(first, min(first + 3, 8)))
    out, query = sampled(feed, sink)
    batch = windowed_sample(feed.table(), "key", "x", "ts", "1 day", 12, id="id", with_quota=True)
    columns = ("window", "id", "key", "x", "n", "s")
    assert as_set(out, *columns) == as_set(closed(batch, 7), *columns) and out.count() == closed(batch, 7).count()
    # rows wait for their window only: the state falls as the watermark passes
    joins = [op["numRowsTotal"] for p in query.recentProgress for op in p["stateOperators"] if op["operatorName"] == "symmetricHashJoin"]
    assert max(joins) > 0 and joins[-1] <= 30 + 3 * 8 < sum(1 for r in feed.rows if r[1] < 7)


def test_sample_goes_on_after_a_restart(feed, sink):
    feed.add(some_days(0, 3))
    sampled(feed, sink, salts=1)
    feed.add(some_days(3, 6))
    out, _ = sampled(feed, sink, salts=1)
    batch = windowed_sample(feed.table(), "key", "x", "ts", "1 day", 12, id="id", with_quota=True)
    assert as_set(out, "window", "id", "n", "s") == as_set(closed(batch, 5), "window", "id", "n", "s")


def test_late_rows_meet_no_window(feed, sink):
    feed.add(some_days(0, 3))
    feed.add(some_days(3, 5))
    kept = list(feed.rows)
    feed.add([(99_999, 0, 5, "hot", 1000.0), *some_days(5, 7)])
    out, _ = sampled(feed, sink)
    batch = windowed_sample(feed.frame(kept + some_days(5, 7)), "key", "x", "ts", "1 day", 12, id="id", with_quota=True)
    assert as_set(out, "window", "id", "n", "s") == as_set(closed(batch, 6), "window", "id", "n", "s")


def test_empty_stream_gives_an_empty_sample(feed, sink):
    feed.add([])
    assert sampled(feed, sink)[0].count() == 0


def test_clashing_column(feed):
    feed.add(some_days(0, 1))
    rows = with_window(feed.stream(), "ts", "1 day").withColumn("mean", F.lit(1))
    with pytest.raises(ValueError, match="mean"):
        joined_stream(rows, daily(feed.stream()), "key")


def test_carried_equals_batch(feed, sink):
    for first in range(0, 9, 3):
        feed.add(some_days(first, first + 3))
    out = carried_to(daily(feed.stream()), "key", **sink)
    batch = closed(cumulative_stats(daily(feed.table()), "key"), 8)
    columns = ("window", "key", "n", "mean", "sd", "gamma")
    assert as_set(out, *columns) == as_set(batch, *columns)


def test_constant_stratum_has_no_deviation(feed, sink):
    feed.add([(i, i // 5, 0, "same", 0.1) for i in range(15)])
    feed.add([(100 + i, 3 + i // 5, 0, "same", 0.1) for i in range(10)])
    out = carried_to(daily(feed.stream()), "key", **sink)
    assert {r.sd for r in out.collect()} == {0.0} and out.agg(F.max("n")).first()[0] == 20


def test_cost_follows_the_strata_not_the_history(spark, feed, sink):
    for day in range(8):
        feed.add(some_days(day, day + 1, per_day=10))
    carried_to(daily(feed.stream()), "key", **sink)
    assert held_strata(spark, sink["path"]).count() == 3
    # what was written before is never read again
    os.rename(f"{sink['path']}/rows", f"{sink['path']}/aside")
    feed.add(some_days(8, 10, per_day=10))
    out = carried_to(daily(feed.stream()), "key", **sink)
    batch = closed(cumulative_stats(daily(feed.table()), "key"), 9).filter("window.start >= timestamp'2024-01-08'")
    assert as_set(out, "window", "key", "n", "mean", "sd") == as_set(batch, "window", "key", "n", "mean", "sd")


def test_idle_strata_are_forgotten(spark, feed, sink):
    """Three runs of one checkpoint: a key is there, then idle, then back."""

    def run():
        return carried_to(daily(feed.stream()), "key", expire="2 days", **sink)

    feed.add(some_days(0, 3, keys=("busy", "idle")))
    run()
    assert {r.key for r in held_strata(spark, sink["path"]).collect()} == {"busy", "idle"}
    feed.add(some_days(3, 8, keys=("busy",)))
    run()
    assert {r.key for r in held_strata(spark, sink["path"]).collect()} == {"busy"}
    feed.add(some_days(8, 10, keys=("busy", "idle")))
    feed.add(some_days(10, 11, keys=("busy",)))
    out = run()
    idle = {r.window.start.day: r.n for r in out.filter("key = 'idle'").collect()}
    assert idle == {1: 15, 2: 30, 3: 45, 9: 15, 10: 30}
    anew = windowed_stats(feed.table().filter("key = 'idle' and ts >= '2024-01-09'"), "key", "x", "ts", "1 day")
    back = out.filter("key = 'idle' and window.start >= '2024-01-09'")
    assert as_set(back, "window", "n", "mean", "sd") == as_set(cumulative_stats(anew, "key"), "window", "n", "mean", "sd")


def test_a_gap_within_one_micro_batch(feed, sink):
    days = [0, 1, 4, 5, 9, 12]
    feed.add([(d * 10 + i, d, i, "k", float(i + d)) for d in days for i in range(4)])
    out = carried_to(daily(feed.stream()), "key", expire="2 days", **sink)
    # idle from the end of one window to the start of the next: 2 days go on, 3 begin anew
    assert {r.window.start.day - 1: r.n for r in out.collect()} == {0: 4, 1: 8, 4: 12, 5: 16, 9: 4}
