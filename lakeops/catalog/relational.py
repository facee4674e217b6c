"""Projections, filters, joins, aggregations, sorts and quality checks over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.catalog import domains as d
from lakeops.catalog.base import Tables, mean_cents, query
from lakeops.catalog.domains import with_
from lakeops.functions.scalars import money, risk_band, risk_bucket, risk_bucket_arrow, risk_bucket_row, zero_padded
from lakeops.operators.aggregates import (
    bitmaps,
    distinct_counts,
    keep_moments,
    pivot_counts,
    rolled_up,
    split_exact,
    split_random,
    split_stratified,
    top_k,
)
from lakeops.operators.clean import distinct_rows, fill, null_out, repair_sign, tidy_name, with_typed_null
from lakeops.operators.forest import threshold_label
from lakeops.operators.joins import broadcast_join, dim_lookup, heavy_keys, join_salting_hot, salted_join
from lakeops.operators.quality import control_totals, reconcile, ri_split, table_counts
from lakeops.session import scratch, stored
from lakeops.sources.readers import parse_payload
from lakeops.sources.sinks import publish_views

# --- projections and filters ----------------------------------------------------------------------------


@query(
    "column_basics",
    """SELECT o_orderkey AS order_no, o_orderstatus AS status, cast(year(o_orderdate) AS bigint) AS order_year,
    cast(quarter(o_orderdate) AS bigint) AS order_quarter, strftime(o_orderdate, '%B') AS month_name,
    strftime(o_orderdate, '%A') AS day_name, cast(strftime(o_orderdate, '%Y%m%d') AS bigint) AS date_key,
    lpad(cast(o_custkey AS varchar), cast(greatest(9, length(cast(o_custkey AS varchar))) AS integer), '0') AS customer_code,
    left(o_orderpriority, 1) AS rank_digit, right(o_orderpriority, 3) AS priority_end,
    replace(substr(o_orderpriority, 3), ' ', '_') AS priority_name,
    cast(o_orderdate AS date) + 30 AS due_date, cast(floor(o_totalprice) AS bigint) AS whole_price FROM orders""",
)
def column_basics(t: Tables):
    """Select, rename, add and drop columns; text, date and cast functions."""
    day = F.to_date("o_orderdate")
    return (
        t.orders.withColumnRenamed("o_orderkey", "order_no")
        .withColumns({
            "order_year": F.year(day),
            "order_quarter": F.quarter(day),
            "month_name": F.date_format(day, "MMMM"),
            "day_name": F.date_format(day, "EEEE"),
            "date_key": F.date_format(day, "yyyyMMdd").cast("bigint"),
            "customer_code": zero_padded("o_custkey", 9),
            "rank_digit": F.left("o_orderpriority", F.lit(1)),
            "priority_end": F.right("o_orderpriority", F.lit(3)),
            "priority_name": F.replace(F.substring("o_orderpriority", 3, 100), F.lit(" "), F.lit("_")),
            "due_date": F.date_add(day, 30),
            "whole_price": F.floor("o_totalprice"),
        })
        .withColumnRenamed("o_orderstatus", "status")
        .drop("o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")
    )


@query(
    "filter_predicates",
    """SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
    WHERE o_orderstatus IN ('F', 'P') AND o_totalprice BETWEEN 50000 AND 250000 AND o_orderpriority LIKE '2-%'
    AND NOT (o_orderstatus = 'P' AND o_totalprice > 200000)""",
)
def filter_predicates(t: Tables):
    """IN, BETWEEN, LIKE prefix, conjunction and negation; they reach the scan."""
    return t.orders.filter(
        F.col("o_orderstatus").isin("F", "P")
        & F.col("o_totalprice").between(50000, 250000)
        & F.col("o_orderpriority").like("2-%")
        & ~((F.col("o_orderstatus") == "P") & (F.col("o_totalprice") > 200000))
    ).select("o_orderkey", "o_orderstatus", "o_totalprice")


@query(
    "repairs_and_defaults",
    """SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS balance, abs(c_acctbal) AS repaired,
    coalesce(CASE WHEN c_mktsegment <> 'BUILDING' THEN upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) END,
    'Unknown') AS segment, cast(NULL AS double) AS risk_score, coalesce(CASE WHEN c_custkey % 4 <> 0 THEN c_nationkey END, 0)::bigint
    AS nation FROM customer""",
)
def repairs_and_defaults(t: Tables):
    """Null out invalid values, repair signs, tidy text, defaults for text and numbers, typed null column."""
    raw = t.customer.select(
        "c_custkey",
        F.col("c_acctbal").alias("balance"),
        F.col("c_acctbal").alias("repaired"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.concat(F.lit(" "), "c_mktsegment")).alias("segment"),
        F.when(F.col("c_custkey") % 4 != 0, F.col("c_nationkey")).alias("nation"),
    )
    filled = repair_sign(fill(raw, {"segment": "UNKNOWN"}, numeric=0), "repaired")
    tidy = filled.withColumn("segment", tidy_name("segment"))
    return with_typed_null(null_out(tidy, "balance", F.col("balance") < 0), "risk_score", "double")


@query(
    "modulo_buckets",
    """SELECT CASE WHEN c_custkey % 10 IN (0, 1) THEN 'Enterprise' WHEN c_custkey % 10 IN (2, 3, 4) THEN 'SMB'
    ELSE 'Consumer' END AS segment, CASE c_nationkey % 4 WHEN 0 THEN 'Air' WHEN 1 THEN 'Road' WHEN 2 THEN 'Rail'
    ELSE 'Port' END AS hub_type, count(*) AS n FROM customer GROUP BY ALL""",
)
def modulo_buckets(t: Tables):
    """Searched and simple CASE over modulo buckets. The buckets and their names."""
    slot = F.col("c_custkey") % 10
    segment = F.when(slot.isin(0, 1), "Enterprise").when(slot.isin(2, 3, 4), "SMB").otherwise("Consumer")
    kind = F.expr("CASE c_nationkey % 4 WHEN 0 THEN 'Air' WHEN 1 THEN 'Road' WHEN 2 THEN 'Rail' ELSE 'Port' END")
    return t.customer.groupBy(segment.alias("segment"), kind.alias("hub_type")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "next_run_id",
    """SELECT o_orderstatus, count(*) AS n, (SELECT coalesce(max(o_orderkey), 0) + 1 FROM orders) AS next_id
    FROM orders GROUP BY o_orderstatus""",
)
def next_run_id(t: Tables):
    """Scalar subquery: the next free id next to grouped rows."""
    next_id = t.orders.agg((F.coalesce(F.max("o_orderkey"), F.lit(0)) + 1).alias("i")).scalar()
    return t.orders.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n")).withColumn("next_id", next_id)


@query(
    "sql_cte_rollup",
    """WITH monthly AS (SELECT strftime(ts, '%Y-%m') AS m, event_type, sum(cast(value AS decimal(12,2))) AS total
    FROM events GROUP BY ALL) SELECT event_type, count(*) AS months, cast(sum(total) AS double) AS total
    FROM monthly GROUP BY event_type""",
)
def sql_cte_rollup(t: Tables):
    """SQL text over a session view, with a common table expression."""
    publish_views(t.events, "lakeops_events")
    return t.spark.sql(
        """WITH monthly AS (SELECT date_format(ts, 'yyyy-MM') AS m, event_type,
        sum(CAST(value AS decimal(12,2))) AS total FROM lakeops_events GROUP BY ALL)
        SELECT event_type, count(*) AS months, sum(total) AS total FROM monthly GROUP BY event_type"""
    )


@query(
    "global_view_counts",
    "SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_totalprice > 100000 GROUP BY o_orderpriority",
)
def global_view_counts(t: Tables):
    """A view that every session of the application sees."""
    publish_views(t.orders, "lakeops_orders", shared=True)
    return t.spark.sql(
        "SELECT o_orderpriority, count(*) AS n FROM global_temp.lakeops_orders "
        "WHERE o_totalprice > 100000 GROUP BY o_orderpriority"
    )


@query(
    "high_value_view",
    "SELECT event_id, user_id, value FROM events WHERE value >= 65",
)
def high_value_view(t: Tables):
    """Filter given as SQL text; it is pushed to the scan."""
    return t.events.filter("value >= 65").select("event_id", "user_id", "value")


@query(
    "json_props_parse",
    "SELECT event_id, cast(json_extract_string(props, '$.k') AS bigint) AS k, ts AS enqueued_ts FROM events",
)
def json_props_parse(t: Tables):
    """Message payload to typed columns, envelope time kept."""
    schema = T.StructType([T.StructField("k", T.IntegerType())])
    messages = t.events.withColumnRenamed("ts", "enqueued_ts")
    return parse_payload(messages, F.col("props").cast("binary"), schema, "event_id", "enqueued_ts")


RISK = "CASE WHEN age IS NULL THEN 'UNKNOWN' WHEN age >= 65 THEN 'HIGH' WHEN age >= 40 THEN 'MODERATE' ELSE 'LOW' END"
AGES = "(SELECT c_custkey, CASE WHEN c_custkey % 9 <> 0 THEN c_custkey * 13 % 96 END AS age FROM customer)"


def _ages(t: Tables):
    return t.customer.select("c_custkey", F.when(F.col("c_custkey") % 9 != 0, F.col("c_custkey") * 13 % 96).alias("age"))


@query("risk_bucket_native", f"SELECT c_custkey, age, {RISK} AS risk_bucket FROM {AGES}")
def risk_bucket_native(t: Tables):
    return _ages(t).withColumn("risk_bucket", risk_bucket("age"))


@query("risk_bucket_arrow", f"SELECT c_custkey, age, {RISK} AS risk_bucket FROM {AGES}")
def risk_bucket_arrow_query(t: Tables):
    """Same mapping as a vectorised function, batch by batch."""
    return _ages(t).withColumn("risk_bucket", risk_bucket_arrow("age"))


@query("risk_bucket_row", f"SELECT c_custkey, age, {RISK} AS risk_bucket FROM {AGES}")
def risk_bucket_row_query(t: Tables):
    """Same mapping as a plain Python function, for comparison only."""
    return _ages(t).withColumn("risk_bucket", risk_bucket_row("age"))


# --- joins ----------------------------------------------------------------------------------------------


@query(
    "broadcast_enrich",
    """SELECT l_orderkey, cast(l_linenumber AS bigint) AS l_linenumber, l_extendedprice, n_name, r_name FROM lineitem
    LEFT JOIN (SELECT s_suppkey, n_name, r_name FROM supplier JOIN nation ON s_nationkey = n_nationkey
               JOIN region ON n_regionkey = r_regionkey) ON s_suppkey = l_suppkey""",
)
def broadcast_enrich(t: Tables):
    """Fact enriched by a dimension that is broadcast after its size was measured."""
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    makers = t.supplier.join(places, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("l_suppkey"), "n_name", "r_name"
    )
    lines = t.lineitem.select("l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice")
    return broadcast_join(lines, makers, "l_suppkey", "left").drop("l_suppkey")


ORPHAN_BASE = "(SELECT o_orderkey, o_custkey, o_totalprice FROM orders)"
KNOWN = "(SELECT c_custkey FROM customer WHERE c_mktsegment <> 'MACHINERY')"


def _ri(t: Tables):
    known = t.customer.filter(F.col("c_mktsegment") != "MACHINERY")
    return ri_split(t.orders.select("o_custkey", "o_orderkey", "o_totalprice"), known, "o_custkey", "c_custkey")


@query("ri_passed", f"SELECT * FROM {ORPHAN_BASE} WHERE o_custkey IN {KNOWN}")
def ri_passed(t: Tables):
    return _ri(t)[0]


@query("ri_orphans", f"SELECT *, 'o_custkey not found' AS _dq_reason FROM {ORPHAN_BASE} WHERE o_custkey NOT IN {KNOWN}")
def ri_orphans(t: Tables):
    return _ri(t)[1]


@query(
    "unknown_member_fact",
    """SELECT coalesce(s_suppkey, -1) AS supplier_key, count(*) AS n, cast(sum(cast(l_extendedprice AS decimal(12,2))) AS double)
    AS total FROM lineitem LEFT JOIN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 3000) ON s_suppkey = l_suppkey GROUP BY 1""",
)
def unknown_member_fact(t: Tables):
    """Facts of a missing dimension member go to member -1."""
    members = t.supplier.filter("s_acctbal > 3000").select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_suppkey").alias("supplier_key")
    )
    keyed = dim_lookup(t.lineitem.select("l_suppkey", "l_extendedprice"), members, "l_suppkey", "supplier_key")
    return keyed.groupBy("supplier_key").agg(
        F.count(F.lit(1)).alias("n"), F.sum(money("l_extendedprice")).alias("total")
    )


SALTED = """SELECT s_nationkey::bigint AS s_nationkey, count(*) AS n, cast(sum(cast(l_extendedprice AS decimal(12,2))) AS double) AS total
    FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY s_nationkey"""


def _skew_sides(t: Tables):
    lines = t.lineitem.select("l_suppkey", "l_extendedprice")
    return lines, t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")


def _nation_totals(joined):
    return joined.groupBy("s_nationkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum(money("l_extendedprice")).alias("total")
    )


@query("salted_join_totals", SALTED)
def salted_join_totals(t: Tables):
    """Every key spread over salt buckets."""
    lines, makers = _skew_sides(t)
    return _nation_totals(salted_join(lines, makers, "l_suppkey", buckets=10))


@query("hot_key_join_totals", SALTED)
def hot_key_join_totals(t: Tables):
    """Only the keys above the average share spread over salt buckets."""
    lines, makers = _skew_sides(t)
    hot = heavy_keys(lines, "l_suppkey", 0.01)
    return _nation_totals(join_salting_hot(lines, makers, "l_suppkey", hot, buckets=8))


@query(
    "heavy_keys",
    """SELECT l_suppkey FROM lineitem GROUP BY l_suppkey HAVING count(*) > 0.01 * (SELECT count(*) FROM lineitem)""",
)
def heavy_keys_query(t: Tables):
    return heavy_keys(t.lineitem, "l_suppkey", 0.01)


@query(
    "key_statistics_join",
    """SELECT event_id, event_type, value, value > 2 * avg_value AS above FROM events JOIN (SELECT event_type,
    cast(sum(cast(value AS decimal(12,2))) AS double) / count(*) AS avg_value FROM events GROUP BY 1) USING (event_type)""",
)
def key_statistics_join(t: Tables):
    """Rows joined to the statistics of their own key."""
    rows = t.events.select("event_id", "event_type", "value")
    stats = rows.groupBy("event_type").agg(
        (F.sum(money("value")).cast("double") / F.count(F.lit(1))).alias("avg_value")
    )
    joined = broadcast_join(rows, stored(stats, "statistics"), "event_type")
    return joined.withColumn("above", F.col("value") > 2 * F.col("avg_value")).drop("avg_value")


@query(
    "inline_values_join",
    """SELECT label, count(*) AS n FROM orders JOIN (VALUES ('O', 'Open'), ('F', 'Filled'), ('P', 'Partial')) AS v(code, label)
    ON code = o_orderstatus GROUP BY label""",
)
def inline_values_join(t: Tables):
    """Inline VALUES as a lookup table."""
    names = t.spark.sql("SELECT * FROM VALUES ('O', 'Open'), ('F', 'Filled'), ('P', 'Partial') AS v(code, label)")
    joined = t.orders.join(names, F.col("code") == F.col("o_orderstatus"))
    return joined.groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@query(
    "inline_rows",
    """SELECT code, label, n, limit_usd FROM (SELECT o_orderstatus AS code, count(*) AS n FROM orders GROUP BY 1)
    JOIN (VALUES ('O', 'Open', 100.0::double), ('F', 'Filled', NULL), ('P', 'Partial', 20.5)) AS v(code, label, limit_usd) USING (code)""",
)
def inline_rows(t: Tables):
    """Inline rows under a typed schema and under a DDL text, and an empty frame that adds nothing."""
    kinds = T.StructType([T.StructField("code", T.StringType()), T.StructField("label", T.StringType())])
    names = t.spark.createDataFrame([("O", "Open"), ("F", "Filled"), ("P", "Partial")], kinds)
    limits = t.spark.createDataFrame([("O", 100.0), ("F", None), ("P", 20.5)], "code string, limit_usd double")
    more = t.spark.createDataFrame([], kinds)
    counts = t.orders.groupBy(F.col("o_orderstatus").alias("code")).agg(F.count(F.lit(1)).alias("n"))
    return counts.join(names.unionByName(more), "code").join(limits, "code")


@query(
    "random_split",
    """SELECT count(*) AS n, count(DISTINCT o_orderkey) AS distinct_orders, true AS repeatable, true AS share_kept FROM orders""",
)
def random_split(t: Tables):
    """Random split by a seed: nothing lost, nothing on both sides, the same rows again, about the share asked for."""
    rows = t.orders.select("o_orderkey")
    first, rest = split_random(rows, 0.8, 42)
    again = split_random(rows, 0.8, 42)[0].select(F.sum("o_orderkey")).scalar()
    sides = first.withColumn("train", F.lit(1)).unionByName(rest.withColumn("train", F.lit(0)))
    return sides.agg(
        F.count(F.lit(1)).alias("n"),
        F.countDistinct("o_orderkey").alias("distinct_orders"),
        (F.sum(F.when(F.col("train") == 1, F.col("o_orderkey"))) == again).alias("repeatable"),
        F.avg("train").between(0.7, 0.9).alias("share_kept"),
    )


# --- aggregations ---------------------------------------------------------------------------------------


@query(
    "order_status_summary",
    f"""SELECT o_orderstatus, o_orderpriority, n, customers, cast(total AS double) AS total, {mean_cents("total", "n")} AS mean,
    largest FROM (SELECT o_orderstatus, o_orderpriority, count(*) AS n, count(DISTINCT o_custkey) AS customers,
    sum(cast(o_totalprice AS decimal(12,2))) AS total, max(o_totalprice) AS largest FROM orders GROUP BY ALL)""",
)
def order_status_summary(t: Tables):
    """Count, distinct count, sum, rounded mean and maximum per group."""
    price, n = F.sum(money("o_totalprice")), F.count(F.lit(1))
    return (
        t.orders.groupBy("o_orderstatus", "o_orderpriority")
        .agg(
            n.alias("n"),
            F.countDistinct("o_custkey").alias("customers"),
            price.alias("total"),
            F.round(price / n, 2).alias("mean"),
            F.max("o_totalprice").alias("largest"),
        )
        .orderBy("o_orderstatus", F.desc("total"))
    )


@query(
    "conditional_sums",
    """SELECT l_returnflag, count(*) FILTER (l_linestatus = 'O') AS open_lines,
    cast(sum(CASE WHEN l_discount > 0.05 THEN cast(l_extendedprice AS decimal(12,2)) ELSE 0 END) AS double) AS discounted,
    bool_or(l_quantity >= 50) AS any_full, cast(round(stddev_samp(l_quantity), 8) AS double) AS spread
    FROM lineitem GROUP BY l_returnflag""",
)
def conditional_sums(t: Tables):
    """Conditional count and sum, boolean OR, sample standard deviation."""
    return t.lineitem.groupBy("l_returnflag").agg(
        F.count_if(F.col("l_linestatus") == "O").alias("open_lines"),
        F.sum(F.when(F.col("l_discount") > 0.05, money("l_extendedprice")).otherwise(0)).alias("discounted"),
        F.bool_or(F.col("l_quantity") >= 50).alias("any_full"),
        F.round(F.stddev_samp("l_quantity"), 8).alias("spread"),
    )


@query(
    "pivot_event_types",
    "SELECT user_id, "
    + ", ".join(f"count(*) FILTER (event_type = '{e}') AS {e}" for e in ("click", "error", "purchase", "signup", "view"))
    + " FROM events GROUP BY user_id",
)
def pivot_event_types(t: Tables):
    return pivot_counts(t.events, ["user_id"], "event_type", ["click", "error", "purchase", "signup", "view"])


@query(
    "top_parts",
    """SELECT l_partkey, cast(revenue AS double) AS revenue FROM (SELECT l_partkey, sum(cast(l_extendedprice AS decimal(12,2))) AS revenue
    FROM lineitem GROUP BY l_partkey) ORDER BY revenue DESC, l_partkey LIMIT 20""",
)
def top_parts(t: Tables):
    """Top-k report with a tie-break; each task keeps only its best k."""
    return top_k(t.lineitem, ["l_partkey"], F.sum(money("l_extendedprice")), "revenue", 20)


@query(
    "distinct_pairs",
    "SELECT DISTINCT user_id, event_type FROM events",
)
def distinct_pairs(t: Tables):
    return distinct_rows(t.events.select("user_id", "event_type"), ["user_id", "event_type"])


@query(
    "control_totals",
    """SELECT "check", actual FROM (SELECT cast(count(*) AS double) AS row_count, cast(count(DISTINCT l_orderkey) AS double) AS orders,
    cast(sum(cast(l_extendedprice AS decimal(12,2))) AS double) AS total_price, cast(count(*) FILTER (l_discount = 0) AS double) AS no_discount
    FROM lineitem) UNPIVOT (actual FOR "check" IN (row_count, orders, total_price, no_discount))""",
)
def control_totals_query(t: Tables):
    """Validation profile of a table as rows, from one pass."""
    return control_totals(t.lineitem, {
        "row_count": F.count(F.lit(1)),
        "orders": F.countDistinct("l_orderkey"),
        "total_price": F.sum(money("l_extendedprice")),
        "no_discount": F.count_if(F.col("l_discount") == 0),
    })


@query(
    "reconcile_lines",
    """SELECT "check", actual, expected, actual IS NOT DISTINCT FROM expected AS matches FROM
    (SELECT 'statuses' AS "check", cast(count(DISTINCT o_orderstatus) AS double) AS actual, 3.0::double AS expected FROM orders
     UNION ALL SELECT 'priorities', cast(count(DISTINCT o_orderpriority) AS double), 4.0::double FROM orders)""",
)
def reconcile_lines(t: Tables):
    actual = control_totals(
        t.orders,
        {"statuses": F.countDistinct("o_orderstatus"), "priorities": F.countDistinct("o_orderpriority")},
    )
    return reconcile(actual, {"statuses": 3, "priorities": 4})


@query(
    "table_counts",
    """SELECT 'orders' AS tbl, count(*) AS n FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem
    UNION ALL SELECT 'customer', count(*) FROM customer UNION ALL SELECT 'events', count(*) FROM events""",
)
def table_counts_query(t: Tables):
    return table_counts({"orders": t.orders, "lineitem": t.lineitem, "customer": t.customer, "events": t.events})


@query(
    "union_all_flows",
    """SELECT kind, count(*) AS n, cast(sum(cast(amount AS decimal(12,2))) AS double) AS total FROM
    (SELECT 'order' AS kind, o_totalprice AS amount FROM orders UNION ALL SELECT 'event', value FROM events) GROUP BY kind""",
)
def union_all_flows(t: Tables):
    flows = t.orders.select(F.lit("order").alias("kind"), F.col("o_totalprice").alias("amount")).unionByName(
        t.events.select(F.col("value").alias("amount"), F.lit("event").alias("kind"))
    )
    return flows.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.sum(money("amount")).alias("total"))


@query(
    "stratified_split",
    """SELECT o_orderstatus, count(*) AS n, count(*) AS distinct_orders, true AS share_kept FROM orders GROUP BY o_orderstatus""",
)
def stratified_split(t: Tables):
    """Split per label: nothing lost, nothing on both sides, the share about kept in every label."""
    first, rest = split_stratified(t.orders, "o_orderstatus", "o_orderkey", 0.8, 42)
    sides = first.withColumn("train", F.lit(1)).unionByName(rest.withColumn("train", F.lit(0)))
    return sides.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"),
        F.countDistinct("o_orderkey").alias("distinct_orders"),
        F.avg("train").between(0.7, 0.9).alias("share_kept"),
    )


@query(
    "exact_split",
    """SELECT o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_orderstatus ORDER BY md5('42:' || o_orderkey), o_orderkey)
    <= floor(count(*) OVER (PARTITION BY o_orderstatus) * 0.8::double + 0.5) AS train FROM orders""",
)
def exact_split(t: Tables):
    """Four fifths of the orders of every status, to the row, by a hash of the key."""
    first, rest = split_exact(t.orders.select("o_orderkey", "o_orderstatus"), "o_orderstatus", "o_orderkey", 0.8, 42)
    return first.withColumn("train", F.lit(True)).unionByName(rest.withColumn("train", F.lit(False)))


@query(
    "monthly_distinct_accounts",
    """SELECT event_type, strftime(ts, '%Y-%m') AS month, count(DISTINCT user_id) AS accounts, count(DISTINCT (user_id, cast(ts AS date))) AS account_days
    FROM events GROUP BY ALL""",
)
def monthly_distinct_accounts(t: Tables):
    """Daily bitmaps of accounts, stored, and the months' distinct accounts from these alone."""
    rows = t.events.select("event_type", F.to_date("ts").alias("day"), "user_id")
    daily = stored(bitmaps(rows, ["event_type", "day"], "user_id").withColumn("month", F.date_format("day", "yyyy-MM")), "bitmaps")
    by = ["event_type", "month"]
    months = distinct_counts(rolled_up(daily, by), by, "accounts")
    return months.join(distinct_counts(daily, by, "account_days"), by)


@query(
    "machine_statistics_kept",
    with_(
        "readings",
        """SELECT machine_id, count(temperature_c) AS temp_n, round(avg(temperature_c), 9) AS temp_mean, round(stddev_samp(temperature_c), 9) AS temp_std,
        count(vibration_mm_s) AS vibe_n, round(avg(vibration_mm_s), 9) AS vibe_mean, round(stddev_samp(vibration_mm_s), 9) AS vibe_std
        FROM readings GROUP BY machine_id""",
    ),
)
def machine_statistics_kept(t: Tables):
    """Statistics per machine after three batches, each merged into those kept so far; the second batch is done twice."""
    rows, root = d.readings(t), scratch(t.spark, "moments")
    third = F.least(F.floor(F.dayofmonth("reading_timestamp") / 11), F.lit(2))
    kept = None
    for number in (0, 1, 1, 2):
        kept = keep_moments(rows.filter(third == number), root, number, "machine_id", ["temperature_c", "vibration_mm_s"])
    out = ["machine_id"]
    for m, name in (("temperature_c", "temp"), ("vibration_mm_s", "vibe")):
        std = F.sqrt(F.try_divide(F.col(f"{m}_m2"), F.col(f"{m}_n") - 1))
        out += [F.col(f"{m}_n").alias(f"{name}_n"), F.round(f"{m}_mean", 9).alias(f"{name}_mean"), F.round(std, 9).alias(f"{name}_std")]
    return kept.select(*out)


@query(
    "orphan_free_bank",
    with_("bank", "SELECT channel, count(*) AS n FROM bank JOIN customer ON account_id = 'A' || cast(c_custkey AS varchar) GROUP BY 1"),
)
def orphan_free_bank(t: Tables):
    """Transactions whose account exists, per channel."""
    accounts = t.customer.select(F.concat(F.lit("A"), F.col("c_custkey").cast("string")).alias("account_id"))
    passed, _ = ri_split(d.bank(t), accounts, "account_id")
    return passed.groupBy("channel").agg(F.count(F.lit(1)).alias("n"))


@query("first_orders", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 10")
def first_orders(t: Tables):
    """The ten rows a reader would look at first."""
    return t.orders.select("o_orderkey", "o_totalprice").orderBy("o_orderkey").limit(10)


@query(
    "probability_bands",
    """SELECT CASE WHEN p <= 0.3 THEN 'Low' WHEN p <= 0.6 THEN 'Medium' ELSE 'High' END AS risk_band, flagged, count(*) AS n
    FROM (SELECT (o_orderkey % 101) / 100.0::double AS p, CASE WHEN o_totalprice > 250000 THEN 1 ELSE 0 END::bigint AS flagged FROM orders)
    GROUP BY ALL""",
)
def probability_bands(t: Tables):
    """Bands of a probability, and a label derived from a threshold."""
    rows = t.orders.select(((F.col("o_orderkey") % 101) / F.lit(100.0)).alias("p"), "o_totalprice")
    labelled = threshold_label(rows, "o_totalprice", 250000, "flagged")
    return labelled.groupBy(risk_band("p").alias("risk_band"), "flagged").agg(F.count(F.lit(1)).alias("n"))
