"""Removal of line chunks that repeat across a corpus, with boundaries chosen by content."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varstrata.plans.runtime import written

AVERAGE_LINES = 4
LEAST_BYTES = 20  # of a passage, without white space
BLANKS = " \t\n\v\f\r"


def _bounds(hashes: Column, average: int) -> Column:
    """Ends (exclusive) of the chunks of a list of line hashes.

    A rolling hash (cyclic shift and exclusive or) over a line and the one before it marks the line as an end, one time in ``average``, unless the
    line before it is marked as well, so that chunks have two lines or more. Marks depend on three lines only: chunks
    fall into step again two lines after any insertion.
    """

    def marked(i: Column) -> Column:
        before = F.coalesce(F.get(hashes, i - 1), F.lit(0).cast("long"))
        rolled = F.get(hashes, i).bitwiseXOR(F.shiftleft(before, 1))
        return F.pmod(F.shiftrightunsigned(rolled, 11), F.lit(average)) == 0

    n = F.size(hashes)
    return F.filter(
        F.sequence(F.lit(1), n), lambda end: (end == n) | (marked(end - 1) & ((end < 2) | ~marked(end - 2)) & (end > 1))
    )


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """An expression over a value that is computed once for each row.

    As a lambda's variable it stays one value wherever the optimizer moves the expression; a column used in lambdas would be
    computed again for every element once a filter on the result is pushed below it.
    """
    return F.transform(F.array(value), use)[0]


def line_chunks(docs: DataFrame, text: str = "text", average: int = AVERAGE_LINES, hash_bits: int = 64) -> DataFrame:
    """Adds __lines (the lines of a text, null as empty) and __chunks: structs (code, h) in order.

    code is the first line's number from 0 and the number of lines, in one number; h is a hash of the lines.
    """
    lines = F.split(F.coalesce(text, F.lit("")), "\n", -1)

    def cut(lines: Column) -> Column:
        return _once(F.transform(lines, lambda line: F.xxhash64(line)), lambda hashes: _once(_bounds(hashes, average), lambda ends: chunks(lines, ends)))

    def chunks(lines: Column, ends: Column) -> Column:
        def chunk(end: Column, i: Column) -> Column:
            first = F.coalesce(F.get(ends, i - 1), F.lit(0))
            h = F.shiftrightunsigned(F.xxhash64(F.slice(lines, first + 1, end - first)), 64 - hash_bits)
            return F.struct((F.shiftleft(first.cast("long"), 32) + (end - first)).alias("code"), h.alias("h"))

        return F.transform(ends, chunk)

    return docs.withColumn("__lines", lines).withColumn("__chunks", _once(F.col("__lines"), cut))


def _first(code: Column) -> Column:
    return F.shiftright(code, 32).cast("int")


def _count(code: Column) -> Column:
    return code.bitwiseAND(F.lit(0xFFFFFFFF)).cast("int")


def _chunk_text(code: Column) -> Column:
    return F.array_join(F.slice("__lines", _first(code) + 1, _count(code)), "\n")


def line_dedup(
    docs: DataFrame, id: str = "doc_id", text: str = "text", average: int = AVERAGE_LINES, hash_bits: int = 64
) -> DataFrame:
    """Removes every chunk of two lines or more that occurred before, byte for byte; adds cleaning (struct of n_lines,
    n_chunks, removed_chunks, removed_lines).

    The first occurrence stays: that in the row of the smallest id, and there the first one. A text that loses all its
    lines becomes empty; rows are never dropped.

    Chunks are counted by their bytes: the texts are grouped, per task first. Only a hash of each chunk goes to the
    table of repeated chunks, to find them in their rows; a hash that two texts share is looked up by text as well.
    The corpus is shuffled once for the count and once for the removal.

    Null texts count as one empty line and stay null. Single lines are never removed. Rows equal in id and text are
    cleaned alike. A chunk that only rows of null id hold stays once in each of them. An empty table gives an empty
    result. Other columns are carried along; one named cleaning is replaced.
    """
    docs = docs.drop("cleaning")
    key = F.xxhash64(F.coalesce(text, F.lit("")))
    source = docs.select(F.col(id).alias("__id"), F.col(text).alias("__text"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("__key"))
    # explode_outer: the filter that Spark infers for explode would repeat the cutting; a text has a chunk anyway
    rows = line_chunks(source, "__text", average, hash_bits).select("__id", "__key", "__lines", F.explode_outer("__chunks").alias("c"))
    parts = rows.filter(_count(F.col("c.code")) > 1).select("__id", "__key", "__lines", "c.code", "c.h")

    texts = parts.groupBy("h", _chunk_text(F.col("code")).alias("chunk")).agg(
        F.count(F.lit(1)).alias("n"), F.min("__id").alias("first_id")
    )
    by_hash = texts.groupBy("h").agg(F.count(F.lit(1)).alias("texts"), F.max("n").alias("n"), F.min("first_id").alias("first_id"))
    repeated = written(by_hash.filter("n > 1"), "repeated")

    places = parts.select("__id", "__key", "code", "h")
    found = places.join(repeated.filter("texts = 1").select("h", "first_id"), "h")
    shared = repeated.filter("texts > 1").select("h")
    if not shared.isEmpty():
        by_text = written(texts.filter("n > 1").join(shared, "h", "left_semi").select("h", "chunk", "first_id"), "shared")
        with_text = parts.join(shared, "h", "left_semi").withColumn("chunk", _chunk_text(F.col("code")))
        found = found.unionByName(with_text.join(by_text, ["h", "chunk"]).select("h", "__id", "__key", "code", "first_id"))
    # what a row loses: all it has of a chunk, or all but the first
    per_chunk = found.groupBy("__id", "__key", "h", "first_id").agg(F.sort_array(F.collect_set("code")).alias("codes"))
    own = F.col("__id").eqNullSafe(F.col("first_id"))
    lost = per_chunk.select("__id", "__key", F.explode(F.when(own, F.slice("codes", 2, F.size("codes"))).otherwise(F.col("codes"))).alias("code"))
    per_row = written(lost.groupBy("__id", "__key").agg(F.collect_list("code").alias("__lost")), "lost")

    marked = docs.withColumn("__key", key).alias("d").join(
        # the same plan at every size: the losses grow with the corpus
        per_row.withColumnRenamed("__key", "__lost_key").hint("merge").alias("l"),
        F.col(f"d.{id}").eqNullSafe(F.col("l.__id")) & (F.col("__key") == F.col("__lost_key")),
        "left",
    )
    cut = line_chunks(marked.drop("__id", "__lost_key", "__key"), text, average, hash_bits)
    lost_codes = F.coalesce("__lost", F.array().cast("array<bigint>"))
    kept = cut.withColumn("__kept", F.array_except(F.transform("__chunks", lambda c: c["code"]), lost_codes))
    clean = _once(
        F.col("__lines"),
        lambda lines: F.array_join(F.flatten(F.transform("__kept", lambda c: F.slice(lines, _first(c) + 1, _count(c)))), "\n"),
    )
    lines_lost = F.aggregate(lost_codes, F.lit(0), lambda n, c: n + _count(c))
    cleaning = F.struct(
        F.size("__lines").alias("n_lines"), F.size("__chunks").alias("n_chunks"),
        F.coalesce(F.size("__lost"), F.lit(0)).alias("removed_chunks"), lines_lost.alias("removed_lines"),
    )
    new_text = F.when(F.col("__lost").isNull(), F.col(text)).otherwise(clean)
    columns = [new_text.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns]
    return kept.select(*columns, cleaning.alias("cleaning"))


def _pairs(lines: Column, least_bytes: int) -> Column:
    """Structs (code, h) of every two neighbouring lines of enough bytes: the first one's number from 0, and the SHA-256 of both."""
    n = F.size(lines)
    both = lambda i: F.concat(F.get(lines, i), F.lit("\n"), F.get(lines, i + 1))
    at = F.sequence(F.lit(0), F.greatest(n - 2, F.lit(0)))
    if least_bytes:
        at = F.filter(at, lambda i: F.octet_length(F.translate(both(i), BLANKS, "")) >= least_bytes)
    return F.when(n < 2, F.array().cast("array<struct<code: int, h: binary>>")).otherwise(
        F.transform(at, lambda i: F.struct(i.alias("code"), F.unhex(F.sha2(F.encode(both(i), "utf-8"), 256)).alias("h")))
    )


def _both_lines(codes: str) -> Column:
    return F.array_union(codes, F.transform(codes, lambda c: c + 1))


def repeated_passages(docs: DataFrame, id: str = "doc_id", text: str = "text", least_bytes: int = 0, whole_first: bool = False) -> DataFrame:
    """Removes every run of two lines or more that occurred before, wherever it begins and ends; adds cleaning (struct of
    n_lines, n_chunks, removed_chunks, removed_lines; the chunks are all pairs of neighbouring lines).

    A line goes if it and a neighbour stand, as a pair, in a row of a smaller id, or two lines or more further up in the same row. A line
    that goes always has an equal one earlier that stays or goes for a still earlier one, so that no line leaves the corpus. No boundaries are
    guessed: a passage that stands in otherwise different texts is found whole, also if it has two lines only.

    least_bytes: two lines of fewer bytes, white space not counted, are no passage: pairs of blank lines or of braces stand in most texts and are layout.

    whole_first: lines that the first copy of a repeated pair consists of stay, also if another pair would take them away. Without it, a passage's only copy left may lose lines to
    another passage that overlaps it, though each of its lines stays somewhere. With it, every pair of lines that is removed anywhere stands whole where it occurred first.

    Pairs are counted by their SHA-256, so that no text is shuffled for the count; the corpus is shuffled once, for the removal.

    Nulls, ids, repeated rows, empty tables and other columns are treated as by ``line_dedup``.
    """
    docs = docs.drop("cleaning")
    key = F.xxhash64(F.coalesce(text, F.lit("")))
    lines = F.split(F.coalesce(text, F.lit("")), "\n", -1)
    source = docs.select(F.col(id).alias("__id"), key.alias("__key"), _once(lines, lambda x: _pairs(x, least_bytes)).alias("__pairs"))
    places = source.select("__id", "__key", F.explode_outer("__pairs").alias("c")).select("__id", "__key", "c.code", "c.h").filter("code is not null")
    counted = places.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min("__id").alias("first_id"))
    repeated = written(counted.filter("n > 1").select("h", "first_id"), "repeated")

    found = places.join(repeated.hint("merge"), "h")  # the same plan at every size: the repeats grow with the corpus
    own = F.col("__id").eqNullSafe(F.col("first_id"))
    others = found.filter(~own).select("__id", "__key", "code")
    first = found.filter(own).groupBy("__id", "__key", "h").agg(F.collect_set("code").alias("codes"))
    again = first.select("__id", "__key", F.explode(F.filter("codes", lambda c: c > F.array_min("codes") + 1)).alias("code"))
    lost = others.unionByName(again).withColumn("stays", F.lit(None).cast("int"))
    if whole_first:
        stays = first.select("__id", "__key", F.lit(None).cast("int").alias("code"), F.array_min("codes").alias("stays"))
        lost = lost.unionByName(stays)
    sets = lost.groupBy("__id", "__key").agg(F.collect_set("code").alias("__lost"), F.collect_set("stays").alias("__stays"))
    per_row = written(sets.filter(F.size("__lost") > 0), "lost")

    marked = docs.withColumn("__key", key).alias("d").join(
        per_row.withColumnRenamed("__key", "__lost_key").hint("merge").alias("l"),
        F.col(f"d.{id}").eqNullSafe(F.col("l.__id")) & (F.col("__key") == F.col("__lost_key")),
        "left",
    )
    every = marked.drop("__id", "__lost_key", "__key").withColumn("__lines", lines)
    gone = F.array_except(_both_lines("__lost"), _both_lines("__stays"))
    cut = every.withColumn("__kept", F.when(F.col("__lost").isNotNull(), F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), gone)))
    clean = _once(F.col("__lines"), lambda lines: F.array_join(F.transform("__kept", lambda i: F.get(lines, i)), "\n"))
    n = F.size("__lines")
    cleaning = F.struct(
        n.alias("n_lines"), (n - 1).alias("n_chunks"), F.coalesce(F.size("__lost"), F.lit(0)).alias("removed_chunks"),
        F.coalesce(n - F.size("__kept"), F.lit(0)).alias("removed_lines"),
    )
    new_text = F.when(F.col("__lost").isNull(), F.col(text)).otherwise(clean)
    columns = [new_text.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns]
    return cut.select(*columns, cleaning.alias("cleaning"))
