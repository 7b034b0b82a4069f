"""The registered queries: every operator on the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varstrata.functions.columns import lenient_double
from varstrata.operators.allocate import allocation, rows_with_allocation, with_quota
from varstrata.operators.apportion import apportioned_allocation
from varstrata.operators.sample import (
    first_fill_sample,
    sample_allocated,
    stratified_sample,
    windowed_sample,
    with_window,
)
from varstrata.operators.stats import (
    cumulative_stats,
    strata_stats,
    total_gamma,
    windowed_stats,
    windowed_total,
    with_total,
)
from varstrata.operators.words import word_count
from varstrata.plans.runtime import materialize, scratch_path
from varstrata.sources import delimited, nested, records
from varstrata.streaming.carried import carried_to
from varstrata.streaming.joined import stream_sample_to
from varstrata.streaming.levels import level_counts_to
from varstrata.streaming.reservoir import admitted_to, reservoir_sample, reservoir_to
from varstrata.streaming.runner import append_to, table_stream, with_event_time
from varstrata.streaming.windows import cumulative_to, totals_to, window_gamma, windows_to
from varstrata.streaming.words import counts_to

# samples rank by md5, which the comparison can recompute
ORDER_KEYS = ["o_orderpriority", "o_orderstatus"]
DAY = "1 day"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def instants(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Times without a zone taken as UTC, whatever the session's zone."""
    return df.withColumn(ts, F.from_utc_timestamp(F.col(ts).cast("timestamp"), F.current_timezone()))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def columns(spark: SparkSession, sf_dir: str, name: str, *names: str) -> DataFrame:
    """Some columns of a table: a sample is written out, so it reads whatever its input has."""
    return table(spark, sf_dir, name).select(*names)


def stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return table_stream(spark, f"{sf_dir}/{name}.parquet", table(spark, sf_dir, name).schema)


def sink(spark: SparkSession) -> dict:
    """A fresh table and checkpoint in the shared folder, with one state partition per core."""
    return {
        "path": scratch_path(spark, "table"),
        "checkpoint": scratch_path(spark, "checkpoint"),
        "partitions": spark.sparkContext.defaultParallelism,
    }


def rounded(*names: str, decimals: int = 6) -> list:
    return [F.round(name, decimals).alias(name) for name in names]


def day() -> list:
    """The day of a window of times without a zone."""
    return [F.date_format("window.start", "yyyy-MM-dd").alias("day")]


# ---- statistics -------------------------------------------------------------------------------


@query
def strata_stats_lineitem(spark, sf_dir):
    stats = strata_stats(table(spark, sf_dir, "lineitem"), "l_returnflag,l_linestatus", "l_quantity")
    return stats.select("l_returnflag", "l_linestatus", "n", *rounded("mean", "sd", "gamma"))


@query
def strata_stats_many_keys(spark, sf_dir):
    stats = strata_stats(table(spark, sf_dir, "lineitem"), "l_partkey", "l_quantity")
    return stats.select("l_partkey", "n", *rounded("mean", "sd", "gamma"))


@query
def strata_stats_text_measure(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    text = F.when(F.col("event_id") % 7 == 0, "n/a").otherwise(F.col("value").cast("string"))
    stats = strata_stats(events.select("event_type", text.alias("reading")), "event_type", "reading")
    return stats.select("event_type", "n", *rounded("mean", "sd", "gamma"))


@query
def strata_stats_drop_bad(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    text = F.when(F.col("event_id") % 7 == 0, "n/a").otherwise(F.col("value").cast("string"))
    stats = strata_stats(
        events.select("event_type", text.alias("reading")), "event_type", "reading", bad_measure="drop"
    )
    return stats.select("event_type", "n", *rounded("mean", "sd", "gamma"))


@query
def strata_stats_weighted(spark, sf_dir):
    stats = strata_stats(table(spark, sf_dir, "orders"), ORDER_KEYS, "o_totalprice", weight=2.0)
    return stats.select(*ORDER_KEYS, "n", *rounded("gamma"))


@query
def total_gamma_orders(spark, sf_dir):
    stats = strata_stats(table(spark, sf_dir, "orders"), ORDER_KEYS, "o_totalprice")
    return total_gamma(stats).select(*rounded("total_gamma"))


@query
def strata_with_total(spark, sf_dir):
    stats = with_total(strata_stats(table(spark, sf_dir, "orders"), ORDER_KEYS, "o_totalprice"))
    return stats.select(*ORDER_KEYS, "n", *rounded("gamma", "total_gamma"))


@query
def windowed_stats_events(spark, sf_dir):
    stats = windowed_stats(table(spark, sf_dir, "events"), "event_type", "value", "ts", DAY)
    return stats.select(*day(), "event_type", "n", *rounded("mean", "sd", "gamma"))


@query
def windowed_total_events(spark, sf_dir):
    stats = windowed_stats(table(spark, sf_dir, "events"), "event_type", "value", "ts", DAY)
    return windowed_total(stats).select(*day(), "event_type", *rounded("gamma", "total_gamma"))


@query
def cumulative_stats_events(spark, sf_dir):
    stats = windowed_stats(table(spark, sf_dir, "events"), "event_type", "value", "ts", DAY)
    running = cumulative_stats(stats, "event_type")
    return running.select(*day(), "event_type", "n", *rounded("mean", "sd", "gamma"))


# ---- allocation -------------------------------------------------------------------------------


@query
def allocation_orders(spark, sf_dir):
    alloc = allocation(table(spark, sf_dir, "orders"), ORDER_KEYS, "o_totalprice", 200)
    return alloc.select(*ORDER_KEYS, "n", *rounded("gamma", "total_gamma"), "s")


@query
def allocation_zero_guard(spark, sf_dir):
    # customers with a single order have no deviation
    alloc = allocation(table(spark, sf_dir, "orders"), "o_custkey", "o_totalprice", 2000)
    return alloc.select("o_custkey", "n", *rounded("gamma"), "s")


@query
def allocation_signed_means(spark, sf_dir):
    # some strata have a negative mean and so a negative quota
    alloc = allocation(table(spark, sf_dir, "customer"), "c_nationkey,c_mktsegment", "c_acctbal", 500)
    return alloc.select("c_nationkey", "c_mktsegment", "n", *rounded("gamma", "total_gamma"), "s")


@query
def allocation_absolute_means(spark, sf_dir):
    alloc = allocation(
        table(spark, sf_dir, "customer"), "c_nationkey,c_mktsegment", "c_acctbal", 500,
        abs_mean=True, min_per_stratum=1,
    )
    return alloc.select("c_nationkey", "c_mktsegment", "n", *rounded("gamma", "total_gamma"), "s")


@query
def allocation_whole_budget(spark, sf_dir):
    # the strata of highest variation are small and taken whole; customers with a single order vary not at all
    orders = table(spark, sf_dir, "orders")
    alloc = apportioned_allocation(orders, "o_custkey", "o_totalprice", orders.count() * 2 // 3)
    return alloc.select("o_custkey", "n", *rounded("gamma"), "s")


@query
def allocation_whole_budget_spent(spark, sf_dir):
    # a budget that takes all strata with variation, and some rows of those without
    orders = table(spark, sf_dir, "orders").select("o_orderpriority", "o_custkey", F.when(F.col("o_custkey") % 3 > 0, F.col("o_totalprice")).alias("price"))
    alloc = apportioned_allocation(orders, "o_orderpriority,o_custkey", "price", orders.count() * 9 // 10)
    return alloc.select("o_orderpriority", "o_custkey", "n", "s")


@query
def rows_with_allocation_events(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    alloc = allocation(events, "event_type", "value", 50)
    return rows_with_allocation(events, alloc, "event_type").select("event_id", "event_type", "n", "s")


# ---- samples ----------------------------------------------------------------------------------


@query
def stratified_sample_orders(spark, sf_dir):
    orders = columns(spark, sf_dir, "orders", "o_orderkey", *ORDER_KEYS, "o_totalprice")
    return stratified_sample(orders, ORDER_KEYS, "o_totalprice", 200, id="o_orderkey", hash="md5", with_quota=True)


@query
def stratified_sample_events(spark, sf_dir):
    events = columns(spark, sf_dir, "events", "event_id", "event_type", "value")
    sample = stratified_sample(events, "event_type", "value", 50, id="event_id", hash="md5", with_quota=True)
    return sample.drop("n")


@query
def stratified_sample_many_strata(spark, sf_dir):
    orders = columns(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_totalprice")
    sample = stratified_sample(orders, "o_custkey", "o_totalprice", 5000, id="o_orderkey", hash="md5", with_quota=True)
    return sample.drop("o_totalprice")


@query
def stratified_sample_large_quota(spark, sf_dir):
    orders = columns(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus", "o_totalprice")
    sample = stratified_sample(orders, "o_orderstatus", "o_totalprice", 6000, id="o_orderkey", hash="md5", with_quota=True)
    return sample.drop("o_totalprice")


@query
def first_fill_sample_events(spark, sf_dir):
    events = columns(spark, sf_dir, "events", "event_id", "event_type", "value")
    sample = first_fill_sample(events, "event_type", "value", 50, arrival="event_id", with_quota=True)
    return sample.drop("value", "n")


@query
def first_fill_small_strata(spark, sf_dir):
    # quotas near stratum sizes: strata smaller than their quota give nothing
    customers = columns(spark, sf_dir, "customer", "c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal")
    sample = first_fill_sample(
        customers, "c_nationkey,c_mktsegment", "c_acctbal", 2000, arrival="c_custkey", with_quota=True
    )
    return sample.drop("c_acctbal")


@query
def first_fill_large_quota(spark, sf_dir):
    orders = columns(spark, sf_dir, "orders", "o_orderkey", "o_orderdate", "o_orderstatus", "o_totalprice")
    sample = first_fill_sample(
        orders, "o_orderstatus", "o_totalprice", 6000, arrival="o_orderdate,o_orderkey", with_quota=True
    )
    return sample.drop("o_orderdate", "o_totalprice")


# ---- text, records, documents -----------------------------------------------------------------


def _event_lines(events: DataFrame) -> DataFrame:
    """Events as delimited lines: quoted fields hold commas, every seventh reading is not a number."""
    reading = F.when(F.col("event_id") % 7 == 0, "n/a").otherwise(F.col("value").cast("string"))
    who = F.format_string('"%s, %s"', "event_type", "user_id")
    props = F.concat(F.lit('"'), "props", F.lit('"'))
    return events.select(F.concat_ws(",", "event_id", who, reading, props).alias("value"))


@query
def csv_split_lenient(spark, sf_dir):
    lines = _event_lines(table(spark, sf_dir, "events"))
    rows = delimited.split_lines(lines, "event_id,who,reading,props")
    return rows.select(
        F.col("event_id").cast("bigint").alias("event_id"),
        "who",
        lenient_double(F.col("reading")).alias("reading"),
        "props",
    )


@query
def csv_file_read(spark, sf_dir):
    path = scratch_path(spark, "delimited")
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value", "props")
    events.write.option("header", True).option("escape", '"').csv(path)
    rows = delimited.read_delimited(spark, path, "event_id,event_type,reading,props")
    return rows.select(
        F.col("event_id").cast("bigint").alias("event_id"),
        "event_type",
        lenient_double(F.col("reading")).alias("reading"),
        "props",
    )


@query
def csv_lines_read(spark, sf_dir):
    path = scratch_path(spark, "lines")
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value", "props")
    events.write.option("header", True).option("escape", '"').csv(path)
    rows = delimited.split_lines(delimited.read_lines(spark, path), "event_id,event_type,reading,props")
    return rows.select(
        F.col("event_id").cast("bigint").alias("event_id"),
        "event_type",
        lenient_double(F.col("reading")).alias("reading"),
        "props",
    )


@query
def row_wire_roundtrip(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    rows = delimited.transform_rows(parts, "p_brand,p_type", "p_size")
    return records.decode_rows(records.encode_rows(rows))


@query
def row_payload_per_key(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    return delimited.transform_rows(parts, "p_brand,p_type", "p_size", payload="per_key")


@query
def stats_wire_roundtrip(spark, sf_dir):
    stats = with_total(strata_stats(table(spark, sf_dir, "orders"), ORDER_KEYS, "o_totalprice"))
    decoded = records.decode_stats(records.encode_stats(stats, ORDER_KEYS))
    return decoded.select("key", "n", *rounded("gamma", "total_gamma"))


@query
def stats_wire_allocation(spark, sf_dir):
    stats = with_total(strata_stats(table(spark, sf_dir, "orders"), ORDER_KEYS, "o_totalprice"))
    alloc = records.decode_allocation(records.encode_stats(stats, ORDER_KEYS), 200)
    return alloc.select("key", "n", *rounded("total_gamma"), "s")


@query
def sample_wire(spark, sf_dir):
    orders = columns(spark, sf_dir, "orders", "o_orderkey", "o_custkey", *ORDER_KEYS, "o_totalprice")
    sample = stratified_sample(orders, ORDER_KEYS, "o_totalprice", 200, id="o_orderkey", hash="md5")
    return records.encode_sample(sample.drop("o_totalprice"), ORDER_KEYS)


@query
def stats_report(spark, sf_dir):
    stats = strata_stats(table(spark, sf_dir, "orders"), ORDER_KEYS, "o_totalprice")
    return records.mean_report(stats, ORDER_KEYS, decimals=0)


@query
def quota_report(spark, sf_dir):
    alloc = allocation(table(spark, sf_dir, "orders"), ORDER_KEYS, "o_totalprice", 200)
    return records.quota_report(alloc, ORDER_KEYS)


@query
def nested_measurements(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("double")
    when = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("lastUpdated")

    def reading(name, value, unit):
        return F.struct(F.lit(name).alias("parameter"), value.alias("value"), when, F.lit(unit).alias("unit"))

    readings = F.array_compact(
        F.array(reading("value", F.col("value"), "ms"), F.when(k % 2 == 0, reading("k", k, "count")))
    )
    place = F.struct(
        F.col("event_type").alias("location"),
        F.col("user_id").cast("string").alias("city"),
        F.lit("µg").alias("country"),
        readings.alias("measurements"),
        F.struct(F.col("user_id").cast("double").alias("latitude")).alias("coordinates"),
    )
    documents = events.select(F.to_json(F.struct(F.array(place).alias("results"))).alias("value"))
    flat = nested.flatten_measurements(nested.parse_documents(documents))
    return flat.select("location", "city", "country", "utc", "parameter", "value", "unit", "latitude", "longitude")


@query
def word_count_documents(spark, sf_dir):
    return word_count(table(spark, sf_dir, "documents"))


@query
def strata_stats_drop_words(spark, sf_dir):
    # words that some parsers take for numbers are as unreadable as others
    events = table(spark, sf_dir, "events")
    word = F.element_at(F.array(*map(F.lit, ("inf", "nan", "Infinit", "-inf", ""))), (F.col("event_id") % 5 + 1).cast("int"))
    text = F.when(F.col("event_id") % 7 == 0, word).otherwise(F.col("value").cast("string"))
    stats = strata_stats(
        events.select("event_type", text.alias("reading")), "event_type", "reading", bad_measure="drop"
    )
    return stats.select("event_type", "n", *rounded("mean", "sd", "gamma"))


@query
def cumulative_total_events(spark, sf_dir):
    # running variation of each stratum, its total over the window, and the quotas from both
    stats = windowed_stats(table(spark, sf_dir, "events"), "event_type", "value", "ts", DAY)
    totals = with_quota(windowed_total(cumulative_stats(stats, "event_type")), 50)
    return totals.select(*day(), "event_type", "n", *rounded("gamma", "total_gamma"), "s")


@query
def windowed_sample_events(spark, sf_dir):
    events = columns(spark, sf_dir, "events", "event_id", "ts", "event_type", "value")
    sample = windowed_sample(events, "event_type", "value", "ts", DAY, 20, id="event_id", hash="md5", with_quota=True)
    return sample.select(*day(), "event_id", "event_type", "n", "s")


@query
def record_sample(spark, sf_dir):
    # the second pass as the stages hand it on: statistics and rows as text records, the sample as text
    price = F.round("o_totalprice").cast("bigint").alias("price")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", *ORDER_KEYS, price)
    stats = records.encode_stats(with_total(strata_stats(orders, ORDER_KEYS, "price")), ORDER_KEYS)
    rows = records.decode_rows(records.encode_rows(delimited.transform_rows(orders, ORDER_KEYS, "price")))
    alloc = materialize(records.decode_allocation(stats, 200))
    sample = sample_allocated(rows, alloc, "key", id="payload", hash="md5")
    return records.encode_sample(sample, "key")


@query
def row_wire_text(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_size")
    return records.encode_rows(delimited.transform_rows(parts, "p_brand", "p_size"))


@query
def stats_wire_text(spark, sf_dir):
    # sizes within a size: whole means, no deviation
    parts = table(spark, sf_dir, "part").select("p_size", F.col("p_size").alias("size"))
    return records.encode_stats(with_total(strata_stats(parts, "size", "p_size")), "size")


# ---- streams ----------------------------------------------------------------------------------


def _daily(spark, sf_dir) -> DataFrame:
    events = with_event_time(instants(stream(spark, sf_dir, "events")), "ts", "0 seconds")
    return windowed_stats(events, "event_type", "value", "ts", DAY)


def utc_day() -> list:
    start = F.to_utc_timestamp("window.start", F.current_timezone())
    return [F.date_format(start, "yyyy-MM-dd").alias("day")]


@query
def stream_windowed_stats(spark, sf_dir):
    stats = windows_to(_daily(spark, sf_dir), "event_type", **sink(spark))
    return stats.select(*utc_day(), "event_type", "n", *rounded("mean", "sd", "gamma"), "closed")


@query
def stream_closed_windows(spark, sf_dir):
    stats = windows_to(_daily(spark, sf_dir), "event_type", closed_only=True, **sink(spark))
    return stats.select(*utc_day(), "event_type", "n", *rounded("mean", "sd", "gamma"))


@query
def stream_window_gamma(spark, sf_dir):
    totals = window_gamma(windows_to(_daily(spark, sf_dir), "event_type", **sink(spark)))
    return totals.select(*utc_day(), "strata", *rounded("total_gamma"))


@query
def stream_windowed_total(spark, sf_dir):
    stats = totals_to(_daily(spark, sf_dir), keys="event_type", **sink(spark))
    return stats.select(*utc_day(), "event_type", *rounded("gamma", "total_gamma"))


@query
def stream_cumulative(spark, sf_dir):
    running = cumulative_to(_daily(spark, sf_dir), "event_type", **sink(spark))
    return running.select(*utc_day(), "event_type", "n", *rounded("mean", "sd", "gamma"))


@query
def stream_cumulative_total(spark, sf_dir):
    running = cumulative_to(_daily(spark, sf_dir), "event_type", **sink(spark))
    totals = with_quota(windowed_total(running), 50)
    return totals.select(*utc_day(), "event_type", "n", *rounded("gamma", "total_gamma"), "s")


@query
def stream_windowed_sample(spark, sf_dir):
    # both passes on streams: the first one's windows give the second one's quotas
    stats = windows_to(_daily(spark, sf_dir), "event_type", **sink(spark))
    alloc = materialize(with_quota(windowed_total(stats), 20).select("window", "event_type", "n", "s"))
    events = with_window(instants(stream(spark, sf_dir, "events")), "ts", DAY)
    sample = reservoir_to(
        events, alloc, ["window", "event_type"], id="event_id", hash="md5", with_quota=True, **sink(spark)
    )
    return sample.select(*utc_day(), "event_id", "event_type", "s")


@query
def stream_stream_sample(spark, sf_dir):
    # both passes run at once: rows wait for the statistics of their window
    events = with_event_time(instants(stream(spark, sf_dir, "events")), "ts", "0 seconds")
    rows = with_window(events.select("event_id", "ts", "event_type", "value"), "ts", DAY)
    sample, _ = stream_sample_to(rows, _daily(spark, sf_dir), "event_type", 20, id="event_id", hash="md5", **sink(spark))
    return sample.select(*utc_day(), "event_id", "event_type", "n", "s")


@query
def stream_carried(spark, sf_dir):
    running = carried_to(_daily(spark, sf_dir), "event_type", **sink(spark))
    return running.select(*utc_day(), "event_type", "n", *rounded("mean", "sd", "gamma"))


@query
def stream_expiring(spark, sf_dir):
    # statistics of a user, begun anew after more than a day without events
    events = with_event_time(instants(stream(spark, sf_dir, "events")), "ts", "0 seconds")
    running = carried_to(windowed_stats(events, "user_id", "value", "ts", DAY), "user_id", expire="1 day", **sink(spark))
    total = F.round(F.col("mean") * F.col("n"), 4).alias("total")
    return running.select(*utc_day(), "user_id", "n", total, *rounded("sd"))


@query
def stream_rows_with_allocation(spark, sf_dir):
    alloc = allocation(table(spark, sf_dir, "events"), "event_type", "value", 50)
    rows = rows_with_allocation(stream(spark, sf_dir, "events"), alloc, "event_type")
    return append_to(rows, **sink(spark)).select("event_id", "event_type", "n", "s")


@query
def stream_reservoir(spark, sf_dir):
    alloc = allocation(table(spark, sf_dir, "events"), "event_type", "value", 50)
    admitted = admitted_to(
        stream(spark, sf_dir, "events"), alloc, "event_type", id="event_id", hash="md5", **sink(spark)
    )
    sample = reservoir_sample(admitted, alloc, "event_type", id="event_id", hash="md5", with_quota=True)
    return sample.select("event_id", "event_type", "value", "s")


@query
def stream_reservoir_table(spark, sf_dir):
    alloc = allocation(table(spark, sf_dir, "events"), "event_type", "value", 50)
    events = stream(spark, sf_dir, "events")
    sample = reservoir_to(events, alloc, "event_type", id="event_id", hash="md5", with_quota=True, **sink(spark))
    return sample.select("event_id", "event_type", "value", "s")


@query
def stream_word_count(spark, sf_dir):
    return counts_to(stream(spark, sf_dir, "documents"), **sink(spark))


@query
def stream_word_count_levels(spark, sf_dir):
    return level_counts_to(stream(spark, sf_dir, "documents"), **sink(spark))
