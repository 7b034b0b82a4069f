"""Mixing sources to target weights by proportionate-fair scheduling of blocks."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from varstrata.llm.linededup import _once
from varstrata.plans.runtime import written

PERIOD = 1000
BLOCKS = 20  # of a source in one period on average, at least
BROADCAST_ROWS = 1_000_000  # of a schedule


def target_shares(sizes: DataFrame, source: str = "source", period: int = PERIOD, weights: DataFrame | None = None,
                  temperature: float = 0.7) -> DataFrame:
    """Blocks of each source in one period of the schedule: (source, a, p), a out of p = sum(a) blocks.

    sizes: (source, n) with the rows of each source. weights: (source, weight), relative numbers, zero or more; without
    it a source's weight is its size to the power ``temperature``. Weights are rounded to 1/period, but a source never
    gets less than one block of a period, so every row finds a place. With many sources the period is longer, ``BLOCKS`` times their
    number, so that such single blocks take a twentieth of it at most.
    """
    if weights is None:
        shares = sizes.select(source, F.pow(F.col("n"), F.lit(temperature)).alias("weight"))
    else:
        given = weights.groupBy(source).agg(F.sum("weight").alias("weight"))
        shares = (
            sizes.join(given.withColumnRenamed(source, "__name"), sizes[source].eqNullSafe(F.col("__name")), "left")
            .select(sizes[source], F.coalesce("weight", F.lit(0.0)).alias("weight"))
        )
    # one row: the sources and their weights, as many as there are sources
    table = shares.agg(F.collect_list(F.struct(F.col(source).alias("s"), F.col("weight").cast("double").alias("w"))).alias("t"))
    total = F.aggregate("t", F.lit(0.0), lambda sum, x: sum + x["w"])

    def blocks(x: Column, sum: Column) -> Column:
        part = F.when(sum > 0, x["w"] / sum).otherwise(F.lit(0.0))
        return F.struct(x["s"].alias(source), F.greatest(F.lit(1), F.round(part * F.greatest(F.lit(period), F.size("t") * BLOCKS)).cast("int")).alias("a"))

    # bound once for the row, not for each source
    whole = table.select(_once(total, lambda sum: F.transform("t", lambda x: blocks(x, sum))).alias("t"))
    numbered = _once(F.col("t"), lambda t: _once(F.aggregate(t, F.lit(0), lambda sum, x: sum + x["a"]), lambda p: F.transform(
        t, lambda x: F.struct(x[source].alias(source), x["a"].alias("a"), p.alias("p")))))
    return whole.select(F.explode(numbered).alias("x")).select("x.*")


def _release(k: Column, a: Column, p: Column) -> Column:
    """First slot in which block k (from 0) of a source with weight a/p may run."""
    return F.floor(k * p / a).cast("long")


def _deadline(k: Column, a: Column, p: Column) -> Column:
    """Slot before which block k (from 0) has to run."""
    return F.ceil((k + 1) * p / a).cast("long")


def period_slots(shares: DataFrame, source: str = "source") -> DataFrame:
    """The schedule of one period: (source, a, p, k, slot), one row for each of its p blocks.

    In every slot, of the blocks released so far and not yet run, the one with the earliest deadline runs, the smaller
    source at equal deadlines. As block k of a source may run from floor(k/w) and must run before ceil((k+1)/w), at the
    end of each slot each source has run less than one block more or less than its weight asks for. All windows repeat
    after p slots, so one period is the whole schedule; its size depends on ``period`` and the number of sources only.

    Sources of equal weight have equal windows: their k-th blocks run one after another, all before any of the next. So a step has to look at
    one counter for each distinct a, of which there are fewer than sqrt(2 p), and block c of m such sources is block c / m of source c % m. Slots are folded
    in stretches of about sqrt(p), so that a step copies no more than one stretch.
    """
    named = written(shares.select("a", "p", F.col(source).alias("__s")), "shares")
    numbered = named.withColumn("__i", F.row_number().over(Window.partitionBy("a").orderBy(F.col("__s").asc_nulls_first())) - 1)
    classes = named.groupBy("a").agg(F.count(F.lit(1)).cast("int").alias("m"), F.max("p").alias("p"))
    table = classes.agg(F.sort_array(F.collect_list(F.struct("a", "m"))).alias("t"), F.max("p").alias("p"))

    def step(state: Column, slot: Column) -> Column:
        def window(x: Column, i: Column) -> Column:
            done = F.get(state["done"], i)
            k = F.floor(done / x["m"])
            open_ = (k < x["a"]) & (_release(k, x["a"], F.col("p")) <= slot)
            return F.when(open_, F.struct(_deadline(k, x["a"], F.col("p")).alias("d"), i.alias("i"), done.alias("c")))

        return _once(F.array_min(F.transform("t", window)), lambda pick: F.struct(
            F.transform(state["done"], lambda n, i: F.when(i == pick["i"], n + 1).otherwise(n)).alias("done"),
            F.concat(state["runs"], F.array(F.struct(pick["i"].alias("i"), pick["c"].alias("c")))).alias("runs"),
        ))

    none = F.array().cast("array<struct<i: int, c: int>>")
    stretch = F.ceil(F.sqrt("p")).cast("int")

    def some(state: Column, first: Column) -> Column:
        slots = F.sequence(first, F.least(first + stretch, F.col("p")) - 1)
        return _once(F.aggregate(slots, F.struct(state["done"].alias("done"), none.alias("runs")), step), lambda after: F.struct(
            after["done"].alias("done"), F.concat(state["runs"], F.array(after["runs"])).alias("runs")))

    start = F.struct(F.transform("t", lambda x: F.lit(0)).alias("done"), F.array().cast("array<array<struct<i: int, c: int>>>").alias("runs"))
    runs = table.filter("p > 0").select(
        "t", "p", F.flatten(F.aggregate(F.sequence(F.lit(0), F.col("p") - 1, stretch), start, some, lambda state: state["runs"])).alias("runs")
    )
    # the fold is written, as it would be repeated in filters and projections made of it
    told = written(runs.select("t", "p", F.posexplode("runs").alias("slot", "x")).select(
        F.get("t", F.col("x.i"))["a"].alias("a"), F.get("t", F.col("x.i"))["m"].alias("m"), F.col("x.c").alias("c"), F.col("slot").cast("long").alias("slot")
    ), "runs")
    placed = told.select("a", (F.col("c") % F.col("m")).alias("__i"), F.floor(F.col("c") / F.col("m")).cast("int").alias("k"), "slot")
    return placed.join(numbered, ["a", "__i"]).select(F.col("__s").alias(source), "a", "p", "slot", "k")


def mix(rows: DataFrame, source: str = "source", id: str = "doc_id", weights: DataFrame | None = None, block_rows: int = 16,
        period: int = PERIOD, temperature: float = 0.7, seed: int = 42) -> DataFrame:
    """The rows with their place in a mixture that follows target weights at every point.

    Adds place (struct of block, release, deadline, slot, at): the rows of a source are put in random but repeatable
    order (a hash of id and seed) and cut into blocks of ``block_rows``; blocks get slots by earliest deadline first
    (``period_slots``), at is the number within the block. Ordered by (slot, at), any prefix in which no source has run
    out holds of each source less than one block more or less than its weight. All rows stay, each once: a source that
    has run out leaves its later slots empty, so what follows is no longer to weight.

    Numbering within a source does not gather the source: rows are dealt by source and a range of the hash, about
    sqrt(n) rows each, numbered there, and raised by the counts of the earlier ranges. The counts are joined by the key that the rows
    are dealt by, so rows are shuffled once.

    The schedule is broadcast up to ``BROADCAST_ROWS`` rows and joined by source and block otherwise.

    Null sources are a source of their own; rows of null id are dealt by a hash of their other columns; repeated rows get places one after another; an empty table gives an empty result. Columns of other names are
    carried along; a column named place is replaced.
    """
    rows = rows.drop("place")
    n = rows.count()
    ranges = max(1, math.isqrt(n))
    others = [F.col(f"`{c}`") for c, kind in rows.dtypes if "map<" not in kind and "variant" not in kind]
    r = F.when(F.col(id).isNull(), F.xxhash64(F.lit(seed), *others)).otherwise(F.xxhash64(F.lit(seed), F.col(id)))
    # the hash as a number from 0 to 1 names the range
    part = F.floor((r.cast("double") / F.lit(2.0**64) + 0.5) * ranges).cast("long")
    # a struct is never null and equals one of the same source, null or not: window and join deal by the same columns
    one_source = F.struct(F.col(source).alias("s"))
    keyed = rows.withColumn("__r", r).withColumn("__key", one_source).withColumn("__range", F.least(F.greatest(part, F.lit(0)), F.lit(ranges - 1)))
    counts = written(keyed.groupBy(F.col(source).alias("__source"), "__range").agg(F.count(F.lit(1)).alias("__n")), "counts")
    before = Window.partitionBy("__source").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    sizes = counts.groupBy("__source").agg(F.sum("__n").alias("n"))
    if weights is not None:
        weights = weights.withColumnRenamed(source, "__source")
    slots = written(period_slots(target_shares(sizes, "__source", period, weights, temperature), "__source"), "slots")

    shares = slots.groupBy("__source").agg(F.max("a").alias("__a"), F.max("p").alias("__p"))
    offsets = offsets.alias("b").join(shares.alias("h"), F.col("b.__source").eqNullSafe(F.col("h.__source"))).select("b.*", "__a", "__p")
    offsets = offsets.withColumn("__key", F.struct(F.col("__source").alias("s")))
    numbered = (
        keyed.withColumn("__at", F.row_number().over(Window.partitionBy("__key", "__range").orderBy("__r", id)) - 1)
        .alias("r").join(offsets.alias("o"), ["__key", "__range"])
        .select(*[F.col("r." + f"`{c}`") for c in rows.columns], (F.col("__before") + F.col("__at")).alias("__at"), "__a", "__p")
        .withColumn("__block", F.floor(F.col("__at") / block_rows).cast("long"))
        .withColumn("__k", (F.col("__block") % F.col("__a")).cast("int"))
    )
    schedule = slots.select("__source", F.col("k").alias("__pk"), F.col("slot").alias("__slot"))
    if slots.count() <= BROADCAST_ROWS:
        schedule = F.broadcast(schedule)
    placed = numbered.join(schedule, F.col(source).eqNullSafe(F.col("__source")) & (F.col("__k") == F.col("__pk")))
    place = F.struct(
        F.col("__block").alias("block"),
        _release(F.col("__block"), F.col("__a"), F.col("__p")).alias("release"),
        _deadline(F.col("__block"), F.col("__a"), F.col("__p")).alias("deadline"),
        (F.floor(F.col("__block") / F.col("__a")) * F.col("__p") + F.col("__slot")).cast("long").alias("slot"),
        (F.col("__at") % block_rows).cast("int").alias("at"),
    )
    return placed.select(*[F.col(f"`{c}`") for c in rows.columns], place.alias("place"))


def in_order(mixed: DataFrame, rows_per_file: int = 20_000, keep_place: bool = False, places: DataFrame | None = None) -> DataFrame:
    """Rows of ``mix``, without place unless ``keep_place``, dealt and sorted so that files in name order are the mixture.

    Slots are cut into equal ranges, one for each partition: slots are numbered without gaps until the first source has run out, so
    partitions are about equal; no range sampling pass is needed. The last slot and the number of rows are counted beforehand in ``places``, the same
    rows with their place where they cost less to compute than ``mixed``.
    """
    size = (mixed if places is None else places).agg(F.max("place.slot").alias("last"), F.count(F.lit(1)).alias("n")).first()
    last, n = size["last"] or 0, size["n"] or 0
    parts = max(1, min(math.ceil(n / rows_per_file), 100_000))
    dealt = (
        mixed.repartitionById(parts, F.least(F.floor(F.col("place.slot") * parts / F.lit(last + 1)), F.lit(parts - 1)).cast("int"))
        .sortWithinPartitions("place.slot", "place.at")
    )
    return dealt if keep_place else dealt.drop("place")
