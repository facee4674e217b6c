"""Ordered analytics over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops.catalog.base import Tables, query
from lakeops.functions.scalars import money
from lakeops.operators.clean import dedup
from lakeops.operators.joins import interval_census
from lakeops.operators.ordered import dense_rank_by, sequence_and_gaps, surrogate_key, windowed
from lakeops.sources.readers import calendar, day_bounds, number_series


@query(
    "dedup_latest",
    """SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC)
    AS _rn FROM events) WHERE _rn = 1""",
)
def dedup_latest(t: Tables):
    return dedup(t.events, ["user_id", "event_type"], ["ts", "event_id"])


@query(
    "dedup_first",
    """SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id)
    AS _rn FROM events) WHERE _rn = 1""",
)
def dedup_first(t: Tables):
    return dedup(t.events, ["user_id", "event_type"], ["ts", "event_id"], keep="first")


@query(
    "visit_sequence_gaps",
    """SELECT o_custkey, o_orderkey, order_day, row_number() OVER w AS visit_number,
    date_diff('day', lag(order_day) OVER w, order_day) AS days_since_prev
    FROM (SELECT *, cast(o_orderdate AS date) AS order_day FROM orders) WINDOW w AS (PARTITION BY o_custkey ORDER BY order_day, o_orderkey)""",
)
def visit_sequence_gaps(t: Tables):
    rows = t.orders.select("o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("order_day"))
    return sequence_and_gaps(rows, ["o_custkey"], ["order_day", "o_orderkey"], "order_day")


STATUS_RUN = """SELECT o_orderstatus, o_orderkey, row_number() OVER w AS n, lag(o_custkey) OVER w AS prev_customer,
    cast(sum(cast(o_totalprice AS decimal(12,2))) OVER (w ROWS UNBOUNDED PRECEDING) AS double) AS running
    FROM (SELECT *, cast(o_orderdate AS date) AS order_day FROM orders) WINDOW w AS (PARTITION BY o_orderstatus ORDER BY order_day, o_orderkey)"""


@query("hot_key_windows", STATUS_RUN)
def hot_key_windows(t: Tables):
    """Sequence, lag and running total where every key holds a third of the rows and is cut into blocks."""
    rows = t.orders.select(
        "o_orderstatus",
        "o_orderkey",
        "o_custkey",
        F.to_date("o_orderdate").alias("order_day"),
        money("o_totalprice").alias("price"),
    )
    done = windowed(
        rows, ["o_orderstatus"], ["order_day", "o_orderkey"], number="n", lags={"prev_customer": "o_custkey"},
        sums={"running": "price"}, hot_rows=1000,
    )
    return done.select("o_orderstatus", "o_orderkey", "n", "prev_customer", "running")


@query(
    "dense_rank_value",
    """SELECT c_custkey, c_mktsegment, c_acctbal, dense_rank() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC) AS balance_rank
    FROM customer""",
)
def dense_rank_value(t: Tables):
    rows = t.customer.select("c_custkey", "c_mktsegment", "c_acctbal")
    return dense_rank_by(rows, ["c_mktsegment"], "c_acctbal", "balance_rank")


@query(
    "running_total",
    """SELECT o_custkey, o_orderkey, cast(sum(cast(o_totalprice AS decimal(12,2))) OVER (PARTITION BY o_custkey
    ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING) AS double) AS running FROM orders""",
)
def running_total(t: Tables):
    rows = t.orders.select("o_custkey", "o_orderkey", "o_orderdate", money("o_totalprice").alias("price"))
    done = windowed(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"], sums={"running": "price"})
    return done.select("o_custkey", "o_orderkey", "running")


@query(
    "surrogate_keys",
    "SELECT p_partkey, p_name, row_number() OVER (ORDER BY p_partkey) AS part_key FROM part",
)
def surrogate_keys(t: Tables):
    return surrogate_key(t.part.select("p_partkey", "p_name"), ["p_partkey"], "part_key")


@query(
    "surrogate_keys_composite",
    """SELECT o_orderkey, row_number() OVER (ORDER BY o_orderpriority, o_totalprice, o_orderkey) AS order_rank FROM orders""",
)
def surrogate_keys_composite(t: Tables):
    """Dense numbers along a composite order whose first column has few values."""
    rows = t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice")
    return surrogate_key(rows, ["o_orderpriority", "o_totalprice", "o_orderkey"], "order_rank").select(
        "o_orderkey", "order_rank"
    )


@query(
    "open_orders_census",
    """WITH span AS (SELECT cast(o_orderdate AS date) AS a, cast(o_orderdate AS date) + cast(o_orderkey % 40 AS integer) AS b,
    o_orderpriority FROM orders), cal AS (SELECT cast(unnest(generate_series((SELECT min(a) FROM span), (SELECT max(b) FROM span),
    interval 1 day)) AS date) AS day)
    SELECT p.o_orderpriority, day, count(span.a) AS open_orders FROM cal CROSS JOIN (SELECT DISTINCT o_orderpriority FROM orders) p
    LEFT JOIN span ON span.o_orderpriority = p.o_orderpriority AND day >= a AND day < b GROUP BY ALL""",
)
def open_orders_census(t: Tables):
    """Interval census over all days from the first order to the last end."""
    start = F.to_date("o_orderdate")
    spans = t.orders.select(
        "o_orderpriority", start.alias("opened"), F.date_add(start, (F.col("o_orderkey") % 40).cast("int")).alias("closed")
    )
    members = t.orders.select("o_orderpriority").distinct()
    span = day_bounds(spans, "opened", "closed").select(F.struct("first_day", "last_day")).scalar()
    return interval_census(spans, members, "o_orderpriority", "opened", "closed", span["first_day"], span["last_day"], "open_orders")


@query(
    "calendar_dim",
    """SELECT cast(strftime(day, '%Y%m%d') AS bigint) AS date_key, day AS full_date, cast(year(day) AS bigint) AS year_num,
    cast(quarter(day) AS bigint) AS quarter_num, cast(month(day) AS bigint) AS month_num, strftime(day, '%B') AS month_name,
    strftime(day, '%A') AS day_name, strftime(day, '%A') IN ('Saturday', 'Sunday') AS is_weekend, coalesce(n, 0) AS orders
    FROM (SELECT cast(unnest(generate_series((SELECT min(o_orderdate) FROM orders), (SELECT max(o_orderdate) FROM orders),
          interval 1 day)) AS date) AS day)
    LEFT JOIN (SELECT cast(o_orderdate AS date) AS day, count(*) AS n FROM orders GROUP BY 1) USING (day)""",
)
def calendar_dim(t: Tables):
    """Calendar over the days of the orders, with the number of orders of each day."""
    days = calendar(day_bounds(t.orders, "o_orderdate"), "first_day", "last_day")
    counts = t.orders.groupBy(F.to_date("o_orderdate").alias("full_date")).agg(F.count(F.lit(1)).alias("orders"))
    return days.join(counts, "full_date", "left").fillna(0, subset=["orders"])


@query(
    "number_series_gaps",
    """SELECT n // 1000 AS block, count(*) AS expected, count(l_orderkey) AS present FROM
    (SELECT unnest(generate_series(1, (SELECT max(l_orderkey) FROM lineitem))) AS n)
    LEFT JOIN (SELECT DISTINCT l_orderkey FROM lineitem) ON l_orderkey = n GROUP BY 1""",
)
def number_series_gaps(t: Tables):
    """Generated numbers up to the largest key, to find the keys that are missing."""
    top = t.lineitem.agg(F.max("l_orderkey")).first()[0]
    keys = t.lineitem.select("l_orderkey").distinct()
    joined = number_series(t.spark, top).join(keys, F.col("l_orderkey") == F.col("n"), "left")
    return joined.groupBy(F.floor(F.col("n") / 1000).alias("block")).agg(
        F.count(F.lit(1)).alias("expected"), F.count("l_orderkey").alias("present")
    )
