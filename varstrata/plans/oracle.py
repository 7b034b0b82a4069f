"""Each registered query as SQL for an independent engine over the same tables."""

from __future__ import annotations


def guarded(mean: str, sd: str, weight: float = 1.0) -> str:
    root = f"sqrt(cast({weight} as double))"
    return f"case when {mean} <> 0 and {sd} <> 0 then {root} * {sd} / {mean} else cast(0 as double) end"


def stats(table: str, keys: str, x: str, *, gamma: str | None = None) -> str:
    gamma = gamma or guarded(f"avg({x})", f"stddev_pop({x})")
    return (
        f"select {keys}, count(*) as n, avg({x}) as mean, stddev_pop({x}) as sd, {gamma} as gamma"
        f" from {table} group by {keys}"
    )


def quotas(table: str, keys: str, x: str, m: int, *, gamma: str | None = None, least: int | None = None) -> str:
    share = f"cast(floor(cast({m} as double) * (gamma / total_gamma) + cast(0.5 as double)) as bigint)"
    s = f"case when total_gamma = 0 then 0 else {share} end"
    if least is not None:
        s = f"greatest({s}, {least})"
    return (
        f"with stats as ({stats(table, keys, x, gamma=gamma)}),"
        " totals as (select *, sum(gamma) over () as total_gamma from stats),"
        f" alloc as (select *, cast({s} as bigint) as s from totals)"
    )


def apportioned(table: str, keys: str, x: str, m: str) -> str:
    """Water-filling by running sums: the level is the highest that any stratum sees if all of smaller ``n / gamma`` are full."""
    by_ratio = f"over (order by n / w, {keys} rows between"
    return (
        f"with stats as ({stats(table, keys, x)}),"
        f" weighed as (select *, case when gamma > 0 then gamma else 0 end as w, cast({m} as bigint) as m from stats),"
        f" running as (select {keys}, (m - coalesce(sum(n) {by_ratio} unbounded preceding and 1 preceding), 0))"
        f" / sum(w) {by_ratio} current row and unbounded following) as level from weighed where w > 0),"
        " known as (select *, (select max(level) from running) as level, sum(n) over () as rows,"
        " coalesce(sum(n) filter (where w > 0) over (), 0) as varied from weighed),"
        " budgets as (select *, greatest(0, least(m, rows)) as budget from known),"
        " shares as (select *, case when varied >= budget then least(cast(n as double), w * coalesce(level, 0)) when w > 0 then n"
        " else cast(n as double) * (budget - varied) / (rows - varied) end as share from budgets),"
        " based as (select *, floor(share + 1e-9) as base, round(share - floor(share + 1e-9), 9) as rest from shares),"
        " placed as (select *, row_number() over (order by base < n desc, rest desc, "
        + ", ".join(f"{k} nulls first" for k in keys.split(", "))
        + ") as place, budget - sum(base) over () as spare from based),"
        " alloc as (select *, cast(base + case when place <= spare then 1 else 0 end as bigint) as s from placed)"
    )


def sample(table: str, keys: str, x: str, m: int, id: str, columns: str) -> str:
    of_key = ", ".join(f"r.{k}" for k in keys.split(", "))
    rank = f"md5(concat_ws('|', '42', cast(r.{id} as varchar)))"
    return (
        f"{quotas(table, keys, x, m)},"
        " ranked as (select r.*, a.n, a.s,"
        f" row_number() over (partition by {of_key} order by {rank}, r.{id}) as place"
        f" from {table} r join alloc a using ({keys}))"
        f" select {columns} from ranked where place <= s"
    )


def first_fill(table: str, keys: str, x: str, m: int, arrival: str, columns: str) -> str:
    of_key = ", ".join(f"r.{k}" for k in keys.split(", "))
    order = ", ".join(f"r.{c}" for c in arrival.split(", "))
    return (
        f"{quotas(table, keys, x, m)},"
        " ranked as (select r.*, a.n, a.s,"
        f" row_number() over (partition by {of_key} order by {order}) as place"
        f" from {table} r join alloc a using ({keys}))"
        f" select {columns} from ranked where place <= s and n >= s"
    )


def r6(*names: str) -> str:
    return ", ".join(f"round({n}, 6) as {n}" for n in names)


ORDERS = ("orders", "o_orderpriority, o_orderstatus", "o_totalprice")
ORDER_KEY = "concat_ws(',', o_orderpriority, o_orderstatus)"
PRICED = "(select *, cast(round(o_totalprice) as bigint) as price from orders)"
CUSTOMERS = ("customer", "c_nationkey, c_mktsegment", "c_acctbal")
EVENTS = ("events", "event_type", "value")

READINGS = (
    "(select event_type, case when event_id % 7 = 0 then cast(0 as double) else value end as reading from events)"
)
GOOD_READINGS = "(select event_type, value as reading from events where event_id % 7 <> 0)"

DAYS = "(select strftime(ts, '%Y-%m-%d') as day, * from events)"
# a window is closed when the latest event is past its end
CLOSED = (
    "(select strftime(ts, '%Y-%m-%d') as day, * from events"
    " where date_trunc('day', ts) + interval 1 day <= (select max(ts) from events))"
)


def daily(source: str) -> str:
    return stats(source, "day, event_type", "value")


def daily_total(source: str) -> str:
    return (
        f"select day, event_type, round(gamma, 6) as gamma,"
        f" round(sum(gamma) over (partition by day), 6) as total_gamma from ({daily(source)})"
    )


def running(source: str) -> str:
    # from the events themselves: all events of the type up to the end of the day
    return (
        f"with d as ({daily(source)}), m as (select a.day, a.event_type, count(*) as n, avg(e.value) as mean,"
        f" stddev_pop(e.value) as sd from d a join {source} e on e.event_type = a.event_type and e.day <= a.day"
        " group by a.day, a.event_type)"
        f" select day, event_type, n, {r6('mean', 'sd')}, round({guarded('mean', 'sd')}, 6) as gamma from m"
    )


def daily_quotas(gamma_from: str, m: int) -> str:
    """Day, type, n, gamma, the day's total and s of each type, from a table with day, event_type, n and gamma."""
    share = f"cast(floor(cast({m} as double) * (gamma / total_gamma) + cast(0.5 as double)) as bigint)"
    return (
        f"select *, case when total_gamma = 0 then 0 else {share} end as s from"
        f" (select *, sum(gamma) over (partition by day) as total_gamma from ({gamma_from}))"
    )


CUMULATIVE = (
    f"with d as ({daily(DAYS)}), m as (select a.day, a.event_type, count(*) as n, avg(e.value) as mean,"
    f" stddev_pop(e.value) as sd from d a join {DAYS} e on e.event_type = a.event_type and e.day <= a.day"
    f" group by a.day, a.event_type), g as (select day, event_type, n, {guarded('mean', 'sd')} as gamma from m)"
)
CUMULATIVE_TOTAL = (
    f"{CUMULATIVE} select day, event_type, n, {r6('gamma', 'total_gamma')}, s from ({daily_quotas('select * from g', 50)})"
)


def daily_sample(m: int, columns: str, source: str = DAYS) -> str:
    rank = "md5(concat_ws('|', '42', cast(r.event_id as varchar)))"
    return (
        f"with a as ({daily_quotas(daily(source), m)}), ranked as (select r.*, a.n, a.s,"
        f" row_number() over (partition by r.day, r.event_type order by {rank}, r.event_id) as place"
        f" from {source} r join a using (day, event_type)) select {columns} from ranked where place <= s"
    )


# a user's life ends with more than one day without events; statistics run over the days of one life
LIVES = (
    f"with e as {CLOSED}, d as (select distinct user_id, day, cast(day as date) as began from e),"
    " g as (select *, case when began - lag(began) over (partition by user_id order by began) > 2 then 1 else 0 end as anew from d),"
    " l as (select *, sum(anew) over (partition by user_id order by began) as life from g)"
    f" select l.day, l.user_id, count(*) as n, round(sum(e.value), 4) as total, round(stddev_pop(e.value), 6) as sd"
    " from l join l b on b.user_id = l.user_id and b.life = l.life and b.began <= l.began"
    " join e on e.user_id = b.user_id and e.day = b.day group by l.day, l.user_id"
)
WORDS = (
    "select word, count(*) as n from (select unnest(regexp_split_to_array(lower(text), '\\W+')) as word"
    " from documents) where word <> '' group by word"
)
LINE_COLUMNS = (
    "select event_id, {who}, case when event_id % 7 = 0 then cast(0 as double) else value end as reading,"
    " replace(props, '\"', '') as props from events"
)

ORACLE: dict[str, str] = {
    "strata_stats_lineitem": f"select l_returnflag, l_linestatus, n, {r6('mean', 'sd', 'gamma')} from"
    f" ({stats('lineitem', 'l_returnflag, l_linestatus', 'l_quantity')})",
    "strata_stats_many_keys": f"select l_partkey, n, {r6('mean', 'sd', 'gamma')} from"
    f" ({stats('lineitem', 'l_partkey', 'l_quantity')})",
    "strata_stats_text_measure": f"select event_type, n, {r6('mean', 'sd', 'gamma')} from"
    f" ({stats(READINGS, 'event_type', 'reading')})",
    "strata_stats_drop_bad": f"select event_type, n, {r6('mean', 'sd', 'gamma')} from"
    f" ({stats(GOOD_READINGS, 'event_type', 'reading')})",
    "strata_stats_weighted": f"select o_orderpriority, o_orderstatus, n, {r6('gamma')} from ("
    + stats(*ORDERS, gamma=guarded("avg(o_totalprice)", "stddev_pop(o_totalprice)", 2.0))
    + ")",
    "total_gamma_orders": f"select round(sum(gamma), 6) as total_gamma from ({stats(*ORDERS)})",
    "strata_with_total": "select o_orderpriority, o_orderstatus, n, round(gamma, 6) as gamma,"
    f" round(sum(gamma) over (), 6) as total_gamma from ({stats(*ORDERS)})",
    "windowed_stats_events": f"select day, event_type, n, {r6('mean', 'sd', 'gamma')} from ({daily(DAYS)})",
    "windowed_total_events": daily_total(DAYS),
    "cumulative_stats_events": running(DAYS),
    "allocation_orders": f"{quotas(*ORDERS, 200)} select o_orderpriority, o_orderstatus, n,"
    f" {r6('gamma', 'total_gamma')}, s from alloc",
    "allocation_zero_guard": f"{quotas('orders', 'o_custkey', 'o_totalprice', 2000)}"
    f" select o_custkey, n, {r6('gamma')}, s from alloc",
    "allocation_signed_means": f"{quotas(*CUSTOMERS, 500)} select c_nationkey, c_mktsegment, n,"
    f" {r6('gamma', 'total_gamma')}, s from alloc",
    "allocation_absolute_means": quotas(
        *CUSTOMERS, 500, gamma=guarded("abs(avg(c_acctbal))", "stddev_pop(c_acctbal)"), least=1
    )
    + f" select c_nationkey, c_mktsegment, n, {r6('gamma', 'total_gamma')}, s from alloc",
    "allocation_whole_budget": apportioned("orders", "o_custkey", "o_totalprice", "(select count(*) * 2 // 3 from orders)")
    + f" select o_custkey, n, {r6('gamma')}, s from alloc",
    "allocation_whole_budget_spent": apportioned(
        "(select *, coalesce(case when o_custkey % 3 > 0 then o_totalprice end, 0) as price from orders)", "o_orderpriority, o_custkey", "price",
        "(select count(*) * 9 // 10 from orders)",
    )
    + " select o_orderpriority, o_custkey, n, s from alloc",
    "rows_with_allocation_events": f"{quotas(*EVENTS, 50)} select event_id, event_type, n, s"
    " from events join alloc using (event_type)",
    "stratified_sample_orders": sample(
        *ORDERS, 200, "o_orderkey", "o_orderkey, o_orderpriority, o_orderstatus, o_totalprice, n, s"
    ),
    "stratified_sample_events": sample(*EVENTS, 50, "event_id", "event_id, event_type, value, s"),
    "stratified_sample_many_strata": sample(
        "orders", "o_custkey", "o_totalprice", 5000, "o_orderkey", "o_orderkey, o_custkey, n, s"
    ),
    "stratified_sample_large_quota": sample(
        "orders", "o_orderstatus", "o_totalprice", 6000, "o_orderkey", "o_orderkey, o_orderstatus, n, s"
    ),
    "first_fill_sample_events": first_fill(*EVENTS, 50, "event_id", "event_id, event_type, s"),
    "first_fill_small_strata": first_fill(
        *CUSTOMERS, 2000, "c_custkey", "c_custkey, c_nationkey, c_mktsegment, n, s"
    ),
    "first_fill_large_quota": first_fill(
        "orders", "o_orderstatus", "o_totalprice", 6000, "o_orderdate, o_orderkey", "o_orderkey, o_orderstatus, n, s"
    ),
    "csv_split_lenient": LINE_COLUMNS.format(who="event_type || ', ' || cast(user_id as varchar) as who"),
    "csv_file_read": "select event_id, event_type, value as reading, props from events",
    "csv_lines_read": "select event_id, event_type, value as reading, replace(props, '\"', '') as props from events",
    "row_wire_roundtrip": "select concat_ws(',', p_brand, p_type) as key,"
    " concat_ws(',', cast(p_partkey as varchar), p_name, cast(p_size as varchar)) as payload from part",
    "row_payload_per_key": "select concat_ws(',', p_brand, p_type) as key, cast(p_size as double) as measure,"
    " concat_ws(',', cast(p_partkey as varchar), p_name, p_type, cast(p_size as varchar),"
    " cast(p_partkey as varchar), p_name, p_brand, cast(p_size as varchar)) as payload from part",
    "stats_wire_roundtrip": f"select {ORDER_KEY} as key, cast(n as double) as n, round(gamma, 6) as gamma,"
    f" round(sum(gamma) over (), 6) as total_gamma from ({stats(*ORDERS)})",
    "stats_wire_allocation": f"{quotas(*ORDERS, 200)} select {ORDER_KEY} as key, n, {r6('total_gamma')}, s from alloc",
    "sample_wire": sample(
        *ORDERS, 200, "o_orderkey",
        "concat_ws(',', o_orderpriority, o_orderstatus, cast(o_orderkey as varchar),"
        " cast(o_custkey as varchar)) as value",
    ),
    "stats_report": f"select {ORDER_KEY} as key, 'Mean= ' || cast(cast(round(mean, 0) as bigint) as varchar) as mean,"
    " 'Standard deviation= ' || cast(cast(round(sd, 0) as bigint) as varchar) as sd"
    f" from ({stats(*ORDERS)})",
    "quota_report": f"{quotas(*ORDERS, 200)} select {ORDER_KEY} as key, 'si= ' || cast(s as varchar) as si from alloc",
    "nested_measurements": "with e as (select event_type as location, cast(user_id as varchar) as city,"
    " 'µg' as country, strftime(ts, '%Y-%m-%dT%H:%M:%S') as utc, value,"
    " cast(json_extract_string(props, '$.k') as double) as k, cast(user_id as double) as latitude,"
    " cast(null as double) as longitude from events)"
    " select location, city, country, utc, 'value' as parameter, value, 'ms' as unit, latitude, longitude from e"
    " union all"
    " select location, city, country, utc, 'k', k, 'count', latitude, longitude from e where k % 2 = 0",
    "word_count_documents": WORDS,
    "strata_stats_drop_words": f"select event_type, n, {r6('mean', 'sd', 'gamma')} from"
    f" ({stats(GOOD_READINGS, 'event_type', 'reading')})",
    "cumulative_total_events": CUMULATIVE_TOTAL,
    "windowed_sample_events": daily_sample(20, "day, event_id, event_type, n, s"),
    "record_sample": f"{quotas(PRICED, ORDERS[1], 'price', 200)}, rows as (select {ORDER_KEY} as key,"
    " concat_ws(',', cast(o_orderkey as varchar), cast(o_custkey as varchar), cast(price as varchar)) as payload"
    f" from {PRICED}),"
    f" keyed as (select {ORDER_KEY} as key, s from alloc),"
    " ranked as (select r.key, r.payload, k.s, row_number() over (partition by r.key order by"
    " md5(concat_ws('|', '42', r.payload)), r.payload) as place from rows r join keyed k using (key))"
    " select concat_ws(',', key, payload) as value from ranked where place <= s",
    "row_wire_text": "select concat_ws(';', p_brand, cast(cast(p_size as double) as varchar),"
    " concat_ws(',', cast(p_partkey as varchar), p_name, cast(p_size as varchar))) as value from part",
    "stats_wire_text": "select concat_ws(';', cast(p_size as varchar), cast(cast(p_size as double) as varchar), '0.0',"
    " cast(cast(count(*) as double) as varchar), '0.0', '0.0') as value from part group by p_size",
    "stream_windowed_stats": f"select day, event_type, n, {r6('mean', 'sd', 'gamma')},"
    " day < (select max(strftime(ts, '%Y-%m-%d')) from events) as closed"
    f" from ({daily(DAYS)})",
    "stream_closed_windows": f"select day, event_type, n, {r6('mean', 'sd', 'gamma')} from ({daily(CLOSED)})",
    "stream_window_gamma": "select day, count(*) as strata, round(sum(gamma), 6) as total_gamma"
    f" from ({daily(DAYS)}) group by day",
    "stream_windowed_total": daily_total(DAYS),
    "stream_cumulative": running(DAYS),
    "stream_cumulative_total": CUMULATIVE_TOTAL,
    "stream_windowed_sample": daily_sample(20, "day, event_id, event_type, s"),
    "stream_stream_sample": daily_sample(20, "day, event_id, event_type, n, s", CLOSED),
    "stream_carried": running(CLOSED),
    "stream_expiring": LIVES,
    "stream_rows_with_allocation": f"{quotas(*EVENTS, 50)} select event_id, event_type, n, s"
    " from events join alloc using (event_type)",
    "stream_reservoir": sample(*EVENTS, 50, "event_id", "event_id, event_type, value, s"),
    "stream_reservoir_table": sample(*EVENTS, 50, "event_id", "event_id, event_type, value, s"),
    "stream_word_count": WORDS,
    "stream_word_count_levels": WORDS,
}
