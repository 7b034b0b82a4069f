"""Removal of long byte strings that repeat across a corpus, by suffix arrays of shards."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varstrata.llm.anchors import GRAM, PIECE, Hashes, scramble, segments
from varstrata.llm.groups import runs
from varstrata.plans.runtime import written

LENGTH = 200
SHARD = 1 << 20  # bytes sorted at once
SEGMENTS = 4096  # different segments of one anchor sorted at once
BLOCKS = (16, 1)  # windows of a segment that stay together where an anchor has more


# ---- suffix arrays -----------------------------------------------------------------------------


def _induce_waves(text: np.ndarray, small: np.ndarray, sigma: int, lms: np.ndarray) -> np.ndarray:
    """All suffixes from the sorted leftmost-smaller ones, bucket by bucket; a bucket's own letters come in waves.

    small marks the suffixes less than their successors. First the larger suffixes are induced from the front, into the heads
    of their buckets, then the smaller ones from the back, into the tails.
    """
    n = len(text)
    counts = np.bincount(text, minlength=sigma)
    tails = np.cumsum(counts)
    heads = tails - counts
    order = np.full(n, -1, np.int64)
    lms_letters = text[lms]
    lms_ends = np.cumsum(np.bincount(lms_letters, minlength=sigma))
    fill = heads.copy()

    def put(at: np.ndarray) -> None:
        letters = text[at]
        rank = np.argsort(letters, kind="stable")
        letters, at = letters[rank], at[rank]
        first = np.flatnonzero(np.append(True, letters[1:] != letters[:-1]))
        size = np.diff(np.append(first, len(at)))
        place = np.repeat(fill[letters[first]], size) + np.arange(len(at)) - np.repeat(first, size)
        order[place] = at
        fill[letters[first]] += size

    # the end of the text precedes all: its last letter is a larger suffix
    put(np.array([n - 1]))
    for c in np.flatnonzero(counts):
        done = heads[c]
        while done < fill[c]:  # larger suffixes of this letter, also those that this loop adds
            wave = order[done : fill[c]]
            done = fill[c]
            before = wave[wave > 0] - 1
            before = before[~small[before]]
            if len(before):
                put(before)
        own = lms[lms_ends[c] - np.count_nonzero(lms_letters == c) : lms_ends[c]] if sigma <= 512 else lms[np.searchsorted(lms_letters, c) : np.searchsorted(lms_letters, c + 1)]
        before = own[own > 0] - 1
        before = before[~small[before]]
        if len(before):
            put(before)
    ends = tails.copy()

    def put_back(at: np.ndarray) -> None:
        """at in falling order"""
        letters = text[at]
        rank = np.argsort(letters, kind="stable")
        letters, at = letters[rank], at[rank]
        first = np.flatnonzero(np.append(True, letters[1:] != letters[:-1]))
        size = np.diff(np.append(first, len(at)))
        place = np.repeat(ends[letters[first]], size) - 1 - (np.arange(len(at)) - np.repeat(first, size))
        order[place] = at
        ends[letters[first]] -= size

    for c in np.flatnonzero(counts)[::-1]:
        done = tails[c]
        while done > ends[c]:
            wave = order[ends[c] : done][::-1]
            done = ends[c]
            before = wave[wave > 0] - 1
            before = before[small[before]]
            if len(before):
                put_back(before)
        wave = order[heads[c] : fill[c]][::-1]
        before = wave[wave > 0] - 1
        before = before[small[before]]
        if len(before):
            put_back(before)
    return order


def _induce_steps(text: np.ndarray, small: np.ndarray, sigma: int, lms: np.ndarray) -> np.ndarray:
    """The same for many letters: suffix by suffix."""
    n = len(text)
    counts = np.bincount(text, minlength=sigma)
    tails = np.cumsum(counts)
    heads, ends = (tails - counts).tolist(), tails.tolist()
    order = [-1] * n
    for i, c in zip(lms[::-1].tolist(), text[lms[::-1]].tolist(), strict=True):
        ends[c] -= 1
        order[ends[c]] = i
    c = int(text[n - 1])
    order[heads[c]] = n - 1
    heads[c] += 1
    # the letter before each suffix if that begins a larger (or smaller) one; at -1, a place not filled yet, none
    before = np.append(-1, np.append(np.where(small, -1, text)[:-1], -1)).tolist()
    for j in order:  # also meets what it adds further on
        c = before[j]
        if c >= 0:
            order[heads[c]] = j - 1
            heads[c] += 1
    ends = tails.tolist()
    before = np.append(-1, np.append(np.where(small, text, -1)[:-1], -1)).tolist()
    for j in reversed(order):
        c = before[j]
        if c >= 0:
            ends[c] -= 1
            order[ends[c]] = j - 1
    return np.array(order, np.int64)


def _double_ranks(text: np.ndarray) -> np.ndarray:
    """The order of all suffixes of a text of any letters: ranks by the first letter, then by the first 2, 4, 8, ...

    A rank is the place of the first suffix that has it; only suffixes that still share one are sorted again.
    """
    n = len(text)
    order = np.argsort(text, kind="stable")
    rank = np.empty(n, np.int64)
    at, key, step = np.arange(n), text[order], 1
    while True:
        new = np.append(True, key[1:] != key[:-1])
        first = np.flatnonzero(new)
        rank[order[at]] = np.repeat(at[first], np.diff(np.append(first, len(at))))
        at = at[~(new & np.append(new[1:], True))]
        if not len(at):
            return order
        who = order[at]
        follower = np.where(who + step < n, rank[np.minimum(who + step, n - 1)] + 1, 0)  # the end of the text precedes all
        key = rank[who] * (n + 1) + follower
        by_key = np.argsort(key, kind="stable")
        order[at], key = who[by_key], key[by_key]
        step *= 2


def _smaller(text: np.ndarray) -> np.ndarray:
    """Which suffixes are less than the next one; the last is not."""
    n = len(text)
    differs = np.append(text[1:] != text[:-1], True)
    following = np.flatnonzero(differs)[np.cumsum(differs) - differs]  # the end of each run of equal letters
    return np.append(text, -1)[following] < np.append(text, -1)[following + 1] if n else np.zeros(0, bool)


def suffix_array(text: np.ndarray) -> np.ndarray:
    """The order of all suffixes of a text of whole numbers from 0, by induced sorting.

    Suffixes are classified as less or greater than their successors. The leftmost of each run of lesser ones divide the text into substrings,
    which are sorted by inducing, named, and, where names repeat, sorted as suffixes of the text of their names, by doubled ranks.
    """
    text = np.asarray(text, np.int64)
    n = len(text)
    if n < 2:
        return np.arange(n)
    sigma = int(text.max()) + 1
    small = _smaller(text)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    induce = _induce_waves if sigma <= 512 else _induce_steps
    if not len(lms):
        return induce(text, small, sigma, lms)
    # any order within a letter sorts the substrings
    order = induce(text, small, sigma, lms[np.argsort(text[lms], kind="stable")])
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    found = order[is_lms[order]]
    number = np.zeros(n, np.int64)
    number[lms] = np.arange(len(lms))
    length = np.append(np.diff(lms), n - lms[-1]) + 1  # with the letter that begins the next
    a, b = found[:-1], found[1:]
    la, lb = length[number[a]], length[number[b]]
    equal = (la == lb) & (number[a] != len(lms) - 1) & (number[b] != len(lms) - 1)
    at = np.flatnonzero(equal)
    step = 0
    while len(at):
        differ = text[a[at] + step] != text[b[at] + step]
        equal[at[differ]] = False
        step += 1
        at = at[~differ]
        at = at[la[at] > step]
    names = np.empty(len(lms), np.int64)
    names[number[found]] = np.append(0, np.cumsum(~equal))
    if names.max() + 1 < len(lms):
        ranked = lms[_double_ranks(names)]
    else:
        ranked = np.empty(len(lms), np.int64)
        ranked[names] = lms
    return induce(text, small, sigma, ranked)


def common_prefixes(text: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """For each place of the order, how many letters its suffix shares with the one before, up to ``most``.

    Computed in the order of the text (permuted): a suffix shares with its predecessor at least what the suffix one to the left
    shares, less one. Many chains, one for each stretch of the text, go on side by side; letters are compared by eights if they are below 256, else by twos.
    """
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    bits = 8 if text.max() < 256 else 32
    width = 64 // bits
    padded = np.append(text, np.zeros(width, np.int64)).astype(np.uint64)
    words = np.zeros(n + 1, np.uint64)  # the letters from each place on, the first one lowest
    for k in range(width):
        words |= padded[k : k + n + 1] << np.uint64(bits * k)
    permuted = np.zeros(n, np.int64)
    stretch = 2 * min(most, n)
    at = np.arange(0, n, stretch)
    end = np.minimum(at + stretch, n)
    shared = np.zeros(len(at), np.int64)
    while len(at):
        other = before[at]
        limit = np.where(other < 0, 0, np.minimum(most, n - np.maximum(at, other)))  # neither goes past the end
        open_ = np.flatnonzero(shared < limit)
        while len(open_):
            differ = words[at[open_] + shared[open_]] ^ words[other[open_] + shared[open_]]
            low = differ & (~differ + np.uint64(1))
            same = np.where(differ == 0, width, np.bitwise_count(low - np.uint64(1)).astype(np.int64) // bits)
            shared[open_] += same
            open_ = open_[(same == width) & (shared[open_] < limit[open_])]
        shared = np.minimum(shared, limit)
        permuted[at] = shared
        at = at + 1
        shared = np.maximum(shared - 1, 0)
        keep = at < end
        at, end, shared = at[keep], end[keep], shared[keep]
    return permuted[order]


def repeated_windows(parts: list[bytes], windows: np.ndarray, length: int) -> list[np.ndarray]:
    """For each part, which of its first ``windows`` places begin a string of ``length`` bytes that begins anywhere else in the parts too."""
    sizes = np.fromiter(map(len, parts), np.int64, len(parts)) + 1
    # of UTF-8 no byte is above 0xF7, so that letters stay below 256
    text = np.frombuffer(b"\0".join(parts) + b"\0", np.uint8).astype(np.int64) + 1
    starts = np.cumsum(sizes) - sizes
    text[starts + sizes - 1] = 0
    order = suffix_array(text)
    begins = np.zeros(len(text), bool)
    inside = np.arange(len(text)) - np.repeat(starts, sizes)
    begins[inside < np.repeat(windows, sizes)] = True
    shared = common_prefixes(text, order, length) >= length
    # suffixes shorter than the length share less, so neighbours that share it are window starts
    twice = np.zeros(len(text), bool)
    twice[order[1:][shared[1:]]] = True
    twice[order[:-1][shared[1:]]] = True
    twice &= begins
    return [twice[s : s + w] for s, w in zip(starts, windows, strict=True)]


# ---- the corpus --------------------------------------------------------------------------------

OCCURRENCE = "h bigint, c bigint, key bigint, start bigint, n int"


def _pieces(text: bytes, length: int) -> Iterator[tuple[int, np.ndarray]]:
    """A text in pieces of a bounded size; every window begins in one of them and lies within it."""
    step = PIECE - length
    for at in range(0, max(1, len(text) - length + 1), step):
        yield at, np.frombuffer(text, np.uint8, min(len(text) - at, step + length - 1), at)


def _batch(columns: list, kinds: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    joined = [np.concatenate(c) if len(c) else np.zeros(0, np.int64) for c in columns]
    return pa.RecordBatch.from_arrays([pa.array(c.view(np.int64) if c.dtype == np.uint64 else c, k) for c, (_, k) in zip(joined, kinds, strict=True)], names=[n for n, _ in kinds])


_KINDS = [("h", pa.int64()), ("c", pa.int64()), ("key", pa.int64()), ("start", pa.int64()), ("n", pa.int32())]
_ROWS = 200_000  # of a batch that is handed back


def _occurrences(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """All segments of (key, text): (h, c, key, start, n), the anchor's hash, the segment's hash, its place and number of windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size = [[], [], [], [], []], 0
        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1), strict=True):
                for at, raw in _pieces(text.as_py() or b"", length):
                    hashes = Hashes(raw)
                    start, n, anchor, _ = segments(raw, hashes, length, gram)
                    found = (anchor, hashes.of(start, start + n + length - 1), np.full(len(start), key.as_py()), start + at, n.astype(np.int32))
                    for column, values in zip(out, found, strict=True):
                        column.append(values)
                    size += len(start)
                if size > _ROWS:
                    yield _batch(out, _KINDS)
                    out, size = [[], [], [], [], []], 0
        yield _batch(out, _KINDS)

    return docs.mapInArrow(run, OCCURRENCE)


def _refined(wanted: DataFrame, docs: DataFrame, length: int, gram: int, block: int) -> DataFrame:
    """Segments cut into runs of at most ``block`` windows that share a core: occurrences with finer h.

    Windows that begin between block * j and block * (j + 1) places before the anchor all contain the bytes that the outermost two have in common; these,
    with j, make the new h. Equal windows have equal anchors at equal places, so they stay together.
    """
    lists = wanted.groupBy("key").agg(F.collect_list("start").alias("starts"))
    source = lists.hint("merge").join(docs, "key").select("key", "text", "starts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text, starts in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                out = [[], [], [], [], []]
                for at, raw in _pieces(text, length):
                    hashes = Hashes(raw)
                    start, n, anchor, place = segments(raw, hashes, length, gram)
                    chosen = np.isin(start + at, starts)
                    start, n, anchor, place = start[chosen], n[chosen], anchor[chosen], place[chosen]
                    first = np.repeat(start, n)
                    p = first + np.arange(len(first)) - np.repeat(np.cumsum(n) - n, n)  # every window
                    m, h = np.repeat(place, n), np.repeat(anchor, n)
                    j = (m - p) // block
                    new = np.flatnonzero(np.append(True, (j[1:] != j[:-1]) | (m[1:] != m[:-1])))
                    size = np.diff(np.append(new, len(p)))
                    p, m, h, j = p[new], m[new], h[new], j[new]
                    # windows of this j begin from m - block * (j + 1) + 1 to m - block * j: the core is what all of them contain
                    core_start, core_end = m - block * j, m - block * (j + 1) + 1 + length
                    core = hashes.of(core_start, core_end)
                    mixed = scramble(h ^ scramble(core + j.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(block)))
                    found = (mixed, hashes.of(p, p + size + length - 1), np.full(len(p), key), p + at, size.astype(np.int32))
                    for column, values in zip(out, found, strict=True):
                        column.append(values)
                yield _batch(out, _KINDS)

    return source.mapInArrow(run, OCCURRENCE)


def _bytes(chosen: DataFrame, docs: DataFrame, length: int) -> DataFrame:
    """(h, c, n, bytes) of chosen segments (h, c, key, start, n)."""
    lists = chosen.groupBy("key").agg(F.collect_list(F.struct("h", "c", "start", "n")).alias("cuts"))
    texts = lists.hint("merge").join(docs, "key")
    cut = texts.select(F.explode("cuts").alias("x"), "text")
    part = F.substring("text", (F.col("x.start") + 1).cast("int"), F.col("x.n") + (length - 1))
    return cut.select("x.h", "x.c", "x.n", part.alias("bytes"))


def _sorted_shards(parts: DataFrame, length: int) -> DataFrame:
    """(h, n, bytes, c) by h -> (h, c, runs): runs (from, n) of the windows that other parts of the shard have as well."""

    def judged(held: list[tuple]) -> pa.RecordBatch:
        twice = repeated_windows([x[3] for x in held], np.array([x[2] for x in held]), length)
        spans = []
        for t in twice:
            edges = np.flatnonzero(np.diff(np.concatenate([[0], t.astype(np.int8), [0]])))
            spans.append([{"first": int(a), "n": int(b - a)} for a, b in zip(edges[::2], edges[1::2], strict=True)])
        kind = pa.list_(pa.struct([("first", pa.int32()), ("n", pa.int32())]))
        return pa.RecordBatch.from_arrays([pa.array([x[0] for x in held]), pa.array([x[1] for x in held]), pa.array(spans, kind)], names=["h", "c", "runs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for group in runs(batches):
            rows = list(zip(*(group.column(k).to_pylist() for k in range(4)), strict=True))
            held += rows
            size += sum(len(x[3]) for x in rows)
            if size > SHARD:  # whole groups only
                yield judged(held)
                held, size = [], 0
        if held:
            yield judged(held)

    by_group = parts.select("h", "c", "n", "bytes").repartition("h").sortWithinPartitions("h")
    return by_group.mapInArrow(run, "h bigint, c bigint, runs array<struct<first: int, n: int>>")


def repeated_ranges(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, most: int = SEGMENTS) -> DataFrame:
    """(key, start, n): runs of places of (key, text) at which a string of ``length`` bytes begins that begins somewhere else as well.

    1. Every window of ``length`` bytes has an anchor, so that equal windows have equal anchors; the windows of a text fall into segments of one anchor.
       Anchors are counted, per task first; those that occur once are done with.
    2. Where all segments of an anchor are equal, all their windows repeat.
    3. Of the others each different segment is read once. The segments of an anchor go to one shard, whose suffix array and
       common prefixes tell which windows two of them share. A segment that occurs twice has all its windows repeated.
    4. An anchor with more than ``most`` different segments is not sorted in one place: its segments are cut around ever larger common cores first,
       and 1 to 3 are done with those. At the last step a core is a window.
    """
    occurrences = written(_occurrences(docs, length, gram), "occurrences")  # read twice, for the counts and for the join
    done = []
    for block in (*BLOCKS, 0):
        groups = occurrences.groupBy("h").agg(F.count(F.lit(1)).alias("times"), F.min("c").alias("low"), F.max("c").alias("high"))
        again = groups.filter("times > 1").select("h", (F.col("low") == F.col("high")).alias("same"))
        found = written(occurrences.join(again, "h"), "repeated")
        done.append(found.filter("same").select("key", "start", "n"))
        mixed = found.filter("not same").drop("same")
        kinds = written(
            mixed.groupBy("h", "c").agg(F.count(F.lit(1)).alias("times"), F.min(F.struct("key", "start")).alias("at"), F.first("n").alias("n")), "kinds"
        )
        large = kinds.groupBy("h").agg(F.count(F.lit(1)).alias("kinds")).filter(F.col("kinds") > most).select("h")
        large = written(large, "large")
        any_large = block > 0 and not large.isEmpty()
        few = kinds.join(large, "h", "left_anti") if any_large else kinds
        parts = _bytes(few.select("h", "c", "at.key", "at.start", "n"), docs, length)
        shared = _sorted_shards(parts, length)
        whole = F.array(F.struct(F.lit(0).alias("first"), F.col("n").alias("n")))
        judged = few.join(shared, ["h", "c"]).select("h", "c", F.when(F.col("times") > 1, whole).otherwise(F.col("runs")).alias("runs"))
        judged = written(judged.filter("size(runs) > 0"), "runs")
        in_place = mixed.join(judged, ["h", "c"]).select("key", "start", F.explode("runs").alias("r"))
        done.append(in_place.select("key", (F.col("start") + F.col("r.first")).alias("start"), "r.n"))
        if not any_large:
            break
        occurrences = written(_refined(mixed.join(large, "h", "left_semi"), docs, length, gram, block), "finer")
    ranges = done[0]
    for more in done[1:]:
        ranges = ranges.unionByName(more)
    return ranges


def suffix_dedup(docs: DataFrame, id: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM, most: int = SEGMENTS) -> DataFrame:
    """Removes every byte that is part of a string of ``length`` bytes that begins anywhere else in the corpus too.

    Adds n_bytes, removed (array of struct start, end in bytes, in order, not touching) and kept (binary, what remains, end to end). Texts count as UTF-8 bytes and are judged as they
    were, not as they become; matches don't go across texts; in one text they may overlap.

    Null texts count as empty; texts shorter than ``length`` lose nothing; repeated rows are texts of their own and lose all that
    is long enough; null ids need no rule. Rows are told apart by a 64-bit hash of id and text. An empty table gives an
    empty result. Other columns are carried along; those named n_bytes, removed and kept are replaced.
    """
    docs = docs.drop("n_bytes", "removed", "kept")
    data = F.encode(F.coalesce(text, F.lit("")), "utf-8")
    key = F.xxhash64(F.col(id), F.coalesce(text, F.lit("")))
    source = docs.select(key.alias("key"), data.alias("text")).filter(F.length("text") >= length)
    ranges = repeated_ranges(source, length, gram, most)
    per_text = written(ranges.groupBy("key").agg(F.collect_set(F.struct("start", "n")).alias("__ranges")), "ranges")
    marked = docs.withColumn("__key", key).join(per_text.withColumnRenamed("key", "__other").hint("merge"), F.col("__key") == F.col("__other"), "left").drop("__key", "__other")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            rest = [n for n in names if n != "__ranges"]
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                sizes, spans, kept = [], [], []
                for value, found in zip(part.column(text), part.column("__ranges"), strict=True):
                    raw = (value.as_py() or "").encode()
                    spans.append(_spans(found.as_py() or [], length))
                    ends = [0, *(x for s in spans[-1] for x in (s["start"], s["end"])), len(raw)]
                    kept.append(b"".join(raw[a:b] for a, b in zip(ends[::2], ends[1::2], strict=True)))
                    sizes.append(len(raw))
                kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(n) for n in rest), pa.array(sizes, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())], names=[*rest, "n_bytes", "removed", "kept"]
                )

    schema = docs.selectExpr("*", "cast(0 as bigint) n_bytes", "cast(null as array<struct<start: bigint, end: bigint>>) removed", "cast('' as binary) kept").schema
    return marked.mapInArrow(run, schema)


def _spans(found: list[dict], length: int) -> list[dict]:
    """Runs of window starts as maximal runs of bytes."""
    out: list[dict] = []
    for x in sorted((r["start"], r["n"]) for r in found):
        end = x[0] + x[1] - 1 + length
        if out and x[0] <= out[-1]["end"]:
            out[-1]["end"] = max(out[-1]["end"], end)
        else:
            out.append({"start": x[0], "end": end})
    return out
