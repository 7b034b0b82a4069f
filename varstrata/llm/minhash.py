"""Near-duplicate documents by min-max hashing of word shingles, confirmed on full sets."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varstrata.llm.anchors import scramble
from varstrata.llm.components import components
from varstrata.llm.groups import text_parts
from varstrata.plans.runtime import written

WORDS = 5
PERCENT = 75
PERMUTATIONS = 112  # each gives a minimum and a maximum
ROWS = 4  # values of a band
BLOCK = 192  # members of a group compared in one piece
BYTES_AT_ONCE = 2_000_000
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@functools.cache
def _numbers(seed: int, n: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _powers(n: int) -> np.ndarray:
    base = np.full(n, _numbers(3, 1)[0], np.uint64)
    base[:1] = 1
    return np.cumprod(base, dtype=np.uint64)


def shingle_sets(texts: list[bytes], words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each text as sorted 64-bit hashes: one flat array, and where each text's begin and end.

    A-Z are lower-cased, words are parted by ASCII white space. A text of fewer words is one shingle, one of none has none.
    """
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    raw = _LOWER[np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)]
    space = _SPACE[raw]
    # a word's hash is a polynomial of its bytes: differences of running sums, shifted to a common power from the end
    starts = np.flatnonzero(~space & np.append(True, space[:-1]))
    ends = np.flatnonzero(space & np.append(False, ~space[:-1]))
    letters = scramble(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))[raw]
    position = np.arange(len(raw), dtype=np.int64) - np.repeat(starts, ends - starts)[np.cumsum(~space) - 1] if len(starts) else starts
    if len(starts):
        powers = _powers(int((ends - starts).max()) + 1)
        position[space] = 0
        sums = np.append(np.uint64(0), np.cumsum(np.where(space, np.uint64(0), letters * powers[position]), dtype=np.uint64))
        hashes = scramble(sums[ends] - sums[starts] + (ends - starts).astype(np.uint64))
    else:
        hashes = np.zeros(0, np.uint64)
    limits = np.append(0, np.cumsum(sizes + 1))
    first = np.searchsorted(starts, limits)
    counts = np.diff(first)
    text_of = np.repeat(np.arange(len(texts)), counts)
    left = np.repeat(first[1:], counts) - np.arange(len(hashes))  # words from here to the text's end
    total = np.zeros(len(hashes), np.uint64)
    for k in range(words):
        has = left > k
        total[has] = scramble(total[has] + hashes[np.flatnonzero(has) + k] * _numbers(4, words)[k])
    begins = (left >= words) | ((np.repeat(counts, counts) < words) & (left == np.repeat(counts, counts)))
    total, text_of = total[begins], text_of[begins]
    order = np.lexsort((total, text_of))
    total, text_of = total[order], text_of[order]
    new = np.append(True, (total[1:] != total[:-1]) | (text_of[1:] != text_of[:-1])) if len(total) else np.zeros(0, bool)
    total, text_of = total[new], text_of[new]
    return total, np.append(0, np.cumsum(np.bincount(text_of, minlength=len(texts))))


def min_max(flat: np.ndarray, bounds: np.ndarray, permutations: int = PERMUTATIONS) -> np.ndarray:
    """For each non-empty set, the least hash under each permutation, then the greatest: two values for one evaluation."""
    full = np.flatnonzero(np.diff(bounds))
    out = np.empty((len(full), 2 * permutations), np.uint64)
    factors, shifts = _numbers(1, permutations), _numbers(2, permutations)
    for p in range(permutations):
        hashed = flat * factors[p] + shifts[p]
        out[:, p] = np.minimum.reduceat(hashed, bounds[full])
        out[:, permutations + p] = np.maximum.reduceat(hashed, bounds[full])
    return out


def band_keys(signatures: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key for each band of consecutive values."""
    bands = signatures.shape[1] // rows
    keys = np.repeat(np.arange(1, bands + 1, dtype=np.uint64)[None, :], len(signatures), 0)
    for r in range(rows):
        keys = scramble(keys * np.uint64(0x9E3779B97F4A7C15) + signatures[:, r : bands * rows : rows])
    return keys.view(np.int64)


def signatures(docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = WORDS, permutations: int = PERMUTATIONS, rows: int = ROWS) -> DataFrame:
    """(id, n_shingles, set_hash, bands) of each row; empty sets have no bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_parts(batch, 1, BYTES_AT_ONCE, b""):
                flat, bounds = shingle_sets(texts, words)
                counts = np.diff(bounds)
                set_hash = np.empty((len(texts), 2), np.uint64)
                for k in (0, 1):
                    sums = np.append(np.uint64(0), np.cumsum(scramble(flat ^ _numbers(5, 2)[k]), dtype=np.uint64))
                    set_hash[:, k] = sums[bounds[1:]] - sums[bounds[:-1]]
                hashes = pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(texts), [None, pa.py_buffer(set_hash.tobytes())])
                keys = band_keys(min_max(flat, bounds, permutations), rows)
                lengths = np.where(counts > 0, keys.shape[1], 0)
                bands = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(lengths)), pa.int32()), pa.array(keys.ravel(), pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(counts, pa.int64()), hashes.cast(pa.binary()), bands],
                    names=["id", "n_shingles", "set_hash", "bands"],
                )

    kind = docs.schema[id].dataType.simpleString()
    source = docs.select(F.col(id).alias("id"), F.encode(text, "utf-8").alias("text"))
    return source.mapInArrow(run, f"id {kind}, n_shingles bigint, set_hash binary, bands array<bigint>")


def linked(flat: np.ndarray, bounds: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """For each set of a group, the number of the first set that links lead to, by comparing all of them.

    Intersections are sums of products of 0 and 1 over the elements that several sets have, some thousand at a time.
    """
    n = len(bounds) - 1
    counts = np.diff(bounds)
    owner = np.repeat(np.arange(n), counts)
    order = np.argsort(flat, kind="stable")
    element = np.cumsum(np.append(True, np.diff(flat[order]) != 0)) - 1 if len(flat) else order
    often = np.bincount(element)[element] > 1 if len(flat) else np.zeros(0, bool)
    rows, columns = owner[order][often], element[often]
    columns = np.cumsum(np.append(True, np.diff(columns) != 0)) - 1 if len(columns) else columns
    common = np.zeros((n, n), np.float32)
    last = columns[-1] + 1 if len(columns) else 0
    for low in range(0, last, 4096):
        a, b = np.searchsorted(columns, [low, low + 4096])
        block = np.zeros((n, min(4096, last - low)), np.float32)
        block[rows[a:b], columns[a:b] - low] = 1
        common += block @ block.T
    common = common.astype(np.int64)
    union = counts[:, None] + counts[None, :] - common
    near = (100 * common >= percent * union) & (common > 0)
    near |= np.eye(n, dtype=bool)
    label = np.arange(n)
    while True:
        least = np.where(near, label[None, :], n).min(1)
        least = least[least]
        if (least == label).all():
            return label
        label = least


def _links(docs_in_groups: DataFrame, words: int, percent: int) -> DataFrame:
    """(a, b) links of the members of each group (columns g, member, text), rows of a group being next to each other."""

    def compare(members: list, texts: list[bytes]) -> list[tuple]:
        flat, bounds = shingle_sets(texts, words)
        label = linked(flat, bounds, percent)
        return [(members[i], members[j]) for i, j in enumerate(label) if i != j]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, members, texts = None, [], []
        for batch in batches:
            found = []
            for g, member, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if g != group:
                    if len(members) > 1:
                        found += compare(members, texts)
                    group, members, texts = g, [], []
                members.append(member)
                texts.append(text)
            yield _pairs(found, kind)
        if len(members) > 1:
            yield _pairs(compare(members, texts), kind)

    field = docs_in_groups.schema["member"]
    kind = pa.int64() if field.dataType.simpleString() == "bigint" else pa.string()
    return docs_in_groups.mapInArrow(run, f"a {field.dataType.simpleString()}, b {field.dataType.simpleString()}")


def _pairs(found: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[i] for p in found], kind) for i in (0, 1)], names=["a", "b"])


def _folds(count: Column, block: int) -> Column:
    return F.ceil(count / F.lit(block)).cast("int")


def near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT,
    permutations: int = PERMUTATIONS, rows: int = ROWS, block: int = BLOCK,
) -> DataFrame:
    """One row for each of docs: (id, n_shingles, component_id, kept).

    Two documents are linked if their sets of word shingles have a Jaccard similarity of ``percent`` or more;
    component_id is the smallest id that links lead to, kept says whether it is the row's own.

    1. Signatures of ``permutations`` minima and as many maxima, cut into bands of ``rows`` values. With 112 and 4, a pair at
       0.75 shares no band once in two billion.
    2. Equal sets are one class from here on, named by its smallest id, so copies cost nothing more.
    3. Classes that share a band are put in one group, named by the least id hash among them. The bands of a family of
       near copies mostly have the same least hash, so the family is compared once and not once for each band.
    4. Groups larger than ``block`` are cut, and every two of their cuts compared by a task of its own, on full sets. A task returns which
       members hang together, not the pairs.
    5. Components of those links.

    Null and empty texts have no shingles and are linked with nothing; rows of null id neither (component_id null, kept);
    rows of equal id are one document, which has the links of all its texts and is kept or not as a whole;
    texts of fewer words are one shingle. An empty table gives an empty result. Of other columns nothing is read.
    """
    marks = written(signatures(docs, id, text, words, permutations, rows), "signatures")
    real = marks.filter("n_shingles > 0 and id is not null")
    classes = written(
        real.groupBy("set_hash", "n_shingles").agg(F.min("id").alias("class"), F.min_by("bands", "id").alias("bands")), "classes"
    )
    places = classes.select("class", F.explode("bands").alias("band"))
    groups = (
        places.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.min(F.xxhash64("class")).alias("g")).filter("n > 1").select("band", "g")
    )
    members = written(places.join(groups, "band").select("g", "class").distinct(), "members")

    sizes = members.groupBy("g").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("g", _folds(F.col("n"), block).alias("folds"))
    dealt = (
        members.join(sizes, "g")
        .withColumn("own", F.pmod(F.xxhash64(F.lit(7), "class"), F.col("folds")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("folds") - 1)))
        .select("class", F.xxhash64("g", F.least("own", "other"), F.greatest("own", "other")).alias("g"))
    )
    texts = docs.select(F.col(id).alias("class"), F.encode(text, "utf-8").alias("text"))
    # merge: the same plan at every size, as the members grow with the corpus
    one_text = members.select("class").distinct().hint("merge").join(texts, "class")
    ready = dealt.hint("merge").join(one_text, "class").select("g", F.col("class").alias("member"), "text")
    parts = ready.repartition("g").sortWithinPartitions("g", "member")
    links = _links(parts, words, percent)
    twice = marks.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1 and id is not null").select("id")
    if not twice.isEmpty():
        # one document of several texts ties their classes together
        rows_of = real.join(twice, "id", "left_semi").join(classes.select("set_hash", "n_shingles", "class"), ["set_hash", "n_shingles"])
        links = links.union(rows_of.select("id", "class"))
    found = components(links)

    named = classes.join(found, classes["class"] == found["node"], "left").select(
        "set_hash", "n_shingles", F.coalesce("component", "class").alias("component_id")
    )
    out = marks.select("id", "n_shingles", "set_hash").join(named, ["set_hash", "n_shingles"], "left")
    own = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("id"))
    component = F.when(F.col("id").isNotNull(), own)
    return out.select(
        F.col("id").alias(id), "n_shingles", component.alias("component_id"), (F.col("id").isNull() | (F.col("id") == component)).alias("kept")
    )
