"""Runs of a stream's aggregates, merged level by level."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from varstrata import word_count
from varstrata.streaming import levels
from varstrata.streaming.levels import add_batch, level_counts_to, live_runs, next_run, read_levels
from varstrata.streaming.runner import file_stream

COUNTS = T.StructType([T.StructField("word", T.StringType()), T.StructField("n", T.LongType())])


def add_up(rows):
    return rows.groupBy("word").agg(F.sum("n").alias("n"))


def counted(frame):
    return sorted((r.word, r.n) for r in frame.collect())


@pytest.mark.parametrize("fanout", [2, 3, 4])
def test_runs_cover_every_batch_once(fanout):
    held = []
    for batch in range(100):
        run, parts = next_run(batch, fanout)
        assert held[len(held) - len(parts):] == parts
        held = [*held[: len(held) - len(parts)], run]
        assert held == live_runs(batch + 1, fanout)
        assert [b for level, i in held for b in range(i * fanout**level, (i + 1) * fanout**level)] == list(range(batch + 1))


@pytest.fixture()
def folder(spark, tmp_path):
    """Ten files of texts; words of their own, words of all, an empty and a null text."""
    path = tmp_path / "in"
    path.mkdir()
    for i in range(10):
        rows = [(f"all Of us, only{i} only{i}",), ("",), (None,), ("us",)] if i != 4 else []
        piece = spark.createDataFrame(rows, "text string").toPandas()
        piece.astype("string").to_parquet(path / f"{i}.parquet")
        os.utime(path / f"{i}.parquet", (1_700_000_000 + i, 1_700_000_000 + i))
    return str(path)


@pytest.mark.parametrize("fanout", [2, 4])
def test_counts_of_ten_batches(spark, folder, tmp_path, fanout):
    source = file_stream(spark, folder, "text string", files_per_trigger=1)
    out = level_counts_to(source, str(tmp_path / "out"), str(tmp_path / "state"), fanout=fanout, partitions=2)
    assert counted(out) == counted(word_count(spark.read.schema("text string").parquet(folder)))
    # a second run of the same checkpoint has nothing to add
    again = level_counts_to(source, str(tmp_path / "out"), str(tmp_path / "state"), fanout=fanout, partitions=2)
    assert counted(again) == counted(out)


def test_writes_follow_the_batches(spark, tmp_path, monkeypatch):
    sizes, plain = [], levels._write
    monkeypatch.setattr(levels, "_write", lambda rows, place: (sizes.append(rows.count()), plain(rows, place)))
    for i in range(16):
        add_batch(spark.range(i * 10, i * 10 + 10).selectExpr("string(id) AS word", "1L AS n"), str(tmp_path), i, add_up, COUNTS)
    assert sizes == [10, 10, 10, 40] * 3 + [10, 10, 10, 160]
    assert read_levels(spark, str(tmp_path), add_up, COUNTS).count() == 160


def test_a_batch_that_breaks_off_loses_nothing(spark, tmp_path, monkeypatch):
    path, plain = str(tmp_path), levels._write
    rows = spark.sql("SELECT 'a' AS word, 1L AS n UNION ALL SELECT 'b', 2L")
    want = 0
    for i in range(5):
        for moment in ("before", "after"):

            def broken(rows, place):
                if moment == "after":
                    plain(rows, place)
                raise OSError("lost")

            monkeypatch.setattr(levels, "_write", broken)
            with pytest.raises(OSError):
                add_batch(rows, path, i, add_up, COUNTS, 2)
            # what was there before can still be read
            assert counted(read_levels(spark, path, add_up, COUNTS)) == ([("a", want), ("b", 2 * want)] if want else [])
        monkeypatch.setattr(levels, "_write", plain)
        add_batch(rows, path, i, add_up, COUNTS, 2)
        want += 1
        assert counted(read_levels(spark, path, add_up, COUNTS)) == [("a", want), ("b", 2 * want)]


def test_nothing_yet_and_another_fanout(spark, tmp_path):
    path = str(tmp_path / "none")
    assert read_levels(spark, path, add_up, COUNTS).count() == 0
    add_batch(spark.createDataFrame([], COUNTS), path, 0, add_up, COUNTS, 2)
    assert read_levels(spark, path, add_up, COUNTS).count() == 0
    with pytest.raises(ValueError, match="fanout=2"):
        add_batch(spark.createDataFrame([], COUNTS), path, 1, add_up, COUNTS, 3)
