"""Removal of repeated line chunks, cut by many rolling hashes at once and compared byte by byte."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varstrata.llm.linededup import BLANKS, LEAST_BYTES, _chunk_text, _count, _first, _once
from varstrata.plans.runtime import written

ROLLS = 40
LONGEST = 4  # lines of a chunk
INNER = 4  # a line goes on, neither opens nor closes, in one of 2**INNER rolls


def _marks(h: Column, rolls: int) -> Column:
    """In which rolls a line of hash h opens a chunk, closes one or goes on: struct (opens, closes, inner) of bit sets, bit r for roll r."""

    def sets(h: Column) -> Column:
        bits = [F.xxhash64(h, F.lit(k)) for k in range(INNER + 1)]
        mask = F.lit((1 << rolls) - 1).cast("long")
        inner = reduce(Column.bitwiseAND, bits[1:]).bitwiseAND(mask)
        either = mask.bitwiseXOR(inner)
        return _once(inner, lambda i: F.struct(
            bits[0].bitwiseAND(either).alias("opens"), F.bitwise_not(bits[0]).bitwiseAND(either).alias("closes"), i.alias("inner")))

    return _once(h, sets)


def rolled_chunks(lines: Column, rolls: int = ROLLS, least_bytes: int = 1, hash_bits: int = 128) -> Column:
    """The chunks of a text in all rolls, each once: structs (code, h, g), as in ``linededup.line_chunks``, with two hashes of the lines.

    Each of the ``rolls`` independent hashes rolls over the hashes of neighbouring lines and puts a boundary between two of them unless the first opens a
    chunk, or goes on in one, and the second goes on or closes it. A chunk thus depends on its own lines only, wherever it stands: boundaries
    resist any insertion before or after it. Lines equal to a neighbour, of which no hash could tell the one that opens from the one that closes, are told apart
    by odd and even numbers; as chunks are named by their bytes, it matters little which is which. Chunks are of 2 to ``LONGEST`` lines and hold ``least_bytes`` or more besides white space. The rolls are the bits
    of one number, so that all are cut at once; two lines are a chunk of none of 40 rolls once in 20,000.
    """

    def chunks(marks: Column, weights: Column) -> Column:
        at = F.sequence(F.lit(0), F.greatest(F.size(lines) - 2, F.lit(0)))

        def of(length: int) -> Column:
            def cut(i: Column) -> Column:
                inner = [F.get(marks, i + k)["inner"] for k in range(1, length - 1)]
                common = reduce(Column.bitwiseAND, inner, F.get(marks, i)["opens"].bitwiseAND(F.get(marks, i + (length - 1))["closes"]))
                heavy = reduce(Column.__add__, [F.get(weights, i + k) for k in range(length)]) >= least_bytes
                return (common != 0) & heavy

            def named(i: Column) -> Column:
                text = F.slice(lines, i + 1, length)
                h, g = F.xxhash64(text), F.xxhash64(F.lit(1), text)
                if hash_bits < 128:
                    h, g = F.shiftrightunsigned(h, 64 - hash_bits), F.lit(0).cast("long")
                return F.struct((F.shiftleft(i.cast("long"), 32) + length).alias("code"), h.alias("h"), g.alias("g"))

            return F.transform(F.filter(at, cut), named)

        return F.concat(*[of(length) for length in range(2, LONGEST + 1)])

    weight: Callable[[Column], Column] = lambda line: F.octet_length(F.translate(line, BLANKS, ""))

    def told_apart(line: Column, i: Column) -> Column:
        equal = F.coalesce(F.get(lines, i - 1) == line, F.lit(False)) | F.coalesce(F.get(lines, i + 1) == line, F.lit(False))
        return _marks(F.xxhash64(line, F.when(equal, i % 2 + 1).otherwise(F.lit(0))), rolls)

    return _once(F.transform(lines, told_apart),
                 lambda marks: _once(F.transform(lines, weight), lambda weights: chunks(marks, weights)))


def _lines_of(codes: Column) -> Column:
    return F.flatten(F.transform(codes, lambda c: F.sequence(_first(c), _first(c) + _count(c) - 1)))


def _heavy(numbers: Column, lines: Column, least_bytes: int) -> Column:
    """Of sorted line numbers those in runs of ``least_bytes`` or more besides white space."""
    starts = F.filter(numbers, lambda x, k: F.coalesce(F.get(numbers, k - 1) < x - 1, F.lit(True)))
    ends = F.filter(numbers, lambda x, k: F.coalesce(F.get(numbers, k + 1) > x + 1, F.lit(True)))
    runs = F.zip_with(starts, ends, lambda s, e: F.struct(s.alias("s"), e.alias("e")))
    text = lambda r: F.array_join(F.slice(lines, r["s"] + 1, r["e"] - r["s"] + 1), "")
    heavy = F.filter(runs, lambda r: F.octet_length(F.translate(text(r), BLANKS, "")) >= least_bytes)
    return F.flatten(F.transform(heavy, lambda r: F.sequence(r["s"], r["e"])))


def chunk_dedup(docs: DataFrame, id: str = "doc_id", text: str = "text", rolls: int = ROLLS, least_bytes: int = LEAST_BYTES,
                hash_bits: int = 128) -> DataFrame:
    """Removes every chunk (``rolled_chunks``) that occurred before, byte for byte; adds cleaning (struct of n_lines, n_chunks,
    removed_chunks, removed_lines).

    A chunk's first copy is the one in the row of the smallest id, and there the first; it stays whole, also where it overlaps a chunk that goes. Later copies
    go, except those that overlap the first in the same text. Whatever is removed thus stands whole somewhere. As chunks of many rolls overlap, a
    repeated passage of two lines or more goes from its first line to its last. A text that loses all its lines becomes empty; rows are never dropped.

    least_bytes: a run of lines that would go stays if it holds less besides white space: two or three braces stand in most texts and are layout, a hundred
    lines of a word each are a passage. Chunks of blank lines only are not looked for. In cleaning, removed_chunks are all later copies, also of light runs.

    Chunks are counted by 128-bit hashes of their lines, so that no text is shuffled for it. Of those that repeat, the texts are grouped and compared; should
    two texts share a hash, chunks of that hash are told apart by their texts in a second count. The corpus is shuffled once, to meet its lists
    of repeated chunks.

    Null texts count as one empty line and stay null. Single lines are never removed. Rows equal in id and text are cleaned alike. A chunk that only
    rows of null id hold stays once in each of them. An empty table gives an empty result. Other columns are carried along; one named cleaning is replaced.
    """
    docs = docs.drop("cleaning")
    key = F.xxhash64(F.coalesce(text, F.lit("")))
    lines = F.split(F.coalesce(text, F.lit("")), "\n", -1)
    source = docs.select(F.col(id).alias("__id"), key.alias("__key"), lines.alias("__lines"))
    cut = written(source.select("__id", "__key", _once(F.col("__lines"), lambda x: rolled_chunks(x, rolls, 1, hash_bits)).alias("__chunks")), "cut")
    sizes = cut.select("__id", "__key", F.size("__chunks").alias("n_chunks"))
    places = cut.select("__id", "__key", F.explode("__chunks").alias("c")).select("__id", "__key", "c.*", F.lit(None).cast("string").alias("chunk"))

    marked = _marked(docs, places, sizes, id, key)
    texts = (
        marked.filter("size(__seen) > 0").withColumn("__lines", lines).select("__lines", F.explode("__seen").alias("c"))
        .groupBy("c.h", "c.g", _chunk_text(F.col("c.code")).alias("chunk")).agg(F.count(F.lit(1)).alias("n"))
    )
    clashes = written(texts.groupBy("h", "g").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1").select("h", "g"), "clashes")
    if not clashes.isEmpty():
        seen = marked.select(F.col(id).alias("__id"), key.alias("__key"), lines.alias("__lines"), F.explode("__seen").alias("c"))
        apart = seen.join(clashes, (F.col("c.h") == clashes["h"]) & (F.col("c.g") == clashes["g"]), "left_semi")
        apart = apart.select("__id", "__key", "c.*", _chunk_text(F.col("c.code")).alias("chunk"))
        marked = _marked(docs, places.join(clashes, ["h", "g"], "left_anti").unionByName(apart), sizes, id, key)

    every = marked.withColumn("__lines", lines)
    n = F.size("__lines")
    later = F.array_sort(F.array_except(_lines_of(F.col("__lost")), _lines_of(F.col("__stays"))))
    gone = _once(later, lambda gone: _heavy(gone, F.col("__lines"), least_bytes))
    every = every.withColumn("__kept", F.when(F.size("__lost") > 0, _once(gone, lambda gone: F.when(
        F.size(gone) > 0, F.array_except(F.sequence(F.lit(0), n - 1), gone)))))
    clean = _once(F.col("__lines"), lambda lines: F.array_join(F.transform("__kept", lambda i: F.get(lines, i)), "\n"))
    cleaning = F.struct(
        n.alias("n_lines"), F.col("__n_chunks").alias("n_chunks"), F.size("__lost").alias("removed_chunks"),
        F.coalesce(n - F.size("__kept"), F.lit(0)).alias("removed_lines"),
    )
    new_text = F.when(F.col("__kept").isNull(), F.col(text)).otherwise(clean)
    columns = [new_text.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns]
    return every.select(*columns, cleaning.alias("cleaning"))


def _marked(docs: DataFrame, places: DataFrame, sizes: DataFrame, id: str, key: Column) -> DataFrame:
    """The documents with __n_chunks and their repeated chunks: __seen (code, h, g), and of these the codes of __lost and of first copies, __stays."""
    name = ["h", "g", "chunk"]
    counted = places.groupBy(*name).agg(F.count(F.lit(1)).alias("n"), F.min("__id").alias("first_id"))
    repeated = written(counted.filter("n > 1").select(*[F.col(c).alias(f"__{c}") for c in name], "first_id"), "repeated")

    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in name])
    found = places.join(repeated.hint("merge"), same)  # the same plan at every size: the repeats grow with the corpus
    own = F.col("__id").eqNullSafe(F.col("first_id"))
    per_chunk = found.groupBy("__id", "__key", *name, own.alias("own")).agg(F.collect_set("code").alias("codes"))
    first = F.array_min("codes")
    after = F.filter("codes", lambda c: _first(c) >= _first(first) + _count(first))
    lists = per_chunk.select(
        "__id", "__key", F.transform("codes", lambda c: F.struct(c.alias("code"), F.col("h"), F.col("g"))).alias("seen"),
        F.when(F.col("own"), after).otherwise(F.col("codes")).alias("lost"), F.when(F.col("own"), first).alias("stays"))
    every = lists.unionByName(sizes, allowMissingColumns=True)
    per_row = every.groupBy(F.col("__id").alias("__lost_id"), F.col("__key").alias("__lost_key")).agg(
        F.max("n_chunks").alias("__n_chunks"), F.flatten(F.collect_list("seen")).alias("__seen"), F.flatten(F.collect_list("lost")).alias("__lost"), F.collect_list("stays").alias("__stays"))
    joined = docs.withColumn("__key", key).alias("d").join(
        per_row.hint("merge").alias("l"), F.col(f"d.`{id}`").eqNullSafe(F.col("__lost_id")) & (F.col("__key") == F.col("__lost_key")), "left")
    return written(joined.drop("__key", "__lost_id", "__lost_key"), "marked")
