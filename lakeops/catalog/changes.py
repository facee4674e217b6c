"""Table changes over the given tables."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lakeops.catalog.base import Tables, query
from lakeops.functions.scalars import money
from lakeops.operators import changes, compare, rewrite
from lakeops.operators.clean import dedup
from lakeops.operators.quality import guarded
from lakeops.session import scratch
from lakeops.sources.sinks import write_partitioned

# Updates: customers of one segment with a low balance get another name and balance (unknown for some
# nations), and customers in debt open a second account.
UPDATES = """
    SELECT c_custkey, c_name || '*' AS c_name, CASE WHEN c_nationkey >= 5 THEN c_acctbal + 1000 END AS c_acctbal
    FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal < 5000
    UNION ALL SELECT c_custkey + 10000000, c_name, c_acctbal FROM customer WHERE c_acctbal < 0"""


def _target(t: Tables):
    return t.customer.select("c_custkey", "c_name", "c_acctbal")


def _updates(t: Tables):
    matched = t.customer.filter("c_mktsegment = 'BUILDING' AND c_acctbal < 5000").select(
        "c_custkey",
        F.concat("c_name", F.lit("*")).alias("c_name"),
        F.when(F.col("c_nationkey") >= 5, F.col("c_acctbal") + 1000).alias("c_acctbal"),
    )
    fresh = t.customer.filter("c_acctbal < 0").select(
        (F.col("c_custkey") + 10_000_000).alias("c_custkey"), "c_name", "c_acctbal"
    )
    return matched.unionByName(fresh)


@query(
    "upsert_scd1",
    f"""SELECT coalesce(u.c_custkey, t.c_custkey) AS c_custkey, CASE WHEN u.c_custkey IS NOT NULL THEN u.c_name ELSE t.c_name END AS c_name,
    CASE WHEN u.c_custkey IS NOT NULL THEN u.c_acctbal ELSE t.c_acctbal END AS c_acctbal
    FROM customer t FULL JOIN ({UPDATES}) u ON u.c_custkey = t.c_custkey""",
)
def upsert_scd1(t: Tables):
    return changes.upsert(_target(t), _updates(t), ["c_custkey"])


@query(
    "upsert_chosen_columns",
    f"""SELECT coalesce(t.c_custkey, u.c_custkey) AS c_custkey, CASE WHEN t.c_custkey IS NULL THEN u.c_name ELSE t.c_name END AS c_name,
    CASE WHEN u.c_custkey IS NOT NULL THEN u.c_acctbal ELSE t.c_acctbal END AS c_acctbal
    FROM customer t FULL JOIN ({UPDATES}) u ON u.c_custkey = t.c_custkey""",
)
def upsert_chosen_columns(t: Tables):
    """Matched rows take the balance only; new rows are inserted whole."""
    return changes.upsert(_target(t), _updates(t), ["c_custkey"], ["c_acctbal"])


@query(
    "insert_only",
    f"""SELECT c_custkey, c_name, c_acctbal FROM customer
    UNION ALL SELECT * FROM ({UPDATES}) WHERE c_custkey NOT IN (SELECT c_custkey FROM customer)""",
)
def insert_only(t: Tables):
    return changes.insert_only(_target(t), _updates(t), ["c_custkey"])


def _versions(t: Tables):
    """Suppliers at version 0, then without the poorest, with changed balances and with second branches."""
    old = t.supplier.select("s_suppkey", "s_name", "s_acctbal", "s_nationkey")
    changed = F.when(F.col("s_nationkey") < 8, F.col("s_acctbal") + 1).otherwise(F.col("s_acctbal"))
    kept = old.filter("s_acctbal >= 500").withColumn("s_acctbal", changed)
    fresh = old.filter("s_acctbal > 8000").withColumn("s_suppkey", F.col("s_suppkey") + 1_000_000)
    return old.drop("s_nationkey"), kept.unionByName(fresh).drop("s_nationkey")


V0 = "SELECT s_suppkey, s_name, s_acctbal FROM supplier"
V1 = """SELECT s_suppkey, s_name, CASE WHEN s_nationkey < 8 THEN s_acctbal + 1 ELSE s_acctbal END AS s_acctbal FROM supplier
    WHERE s_acctbal >= 500 UNION ALL SELECT s_suppkey + 1000000, s_name, s_acctbal FROM supplier WHERE s_acctbal > 8000"""
CHANGED = "WHERE s_acctbal >= 500 AND s_nationkey < 8"
FEED = f"""
    SELECT *, 'delete' AS _change_type FROM ({V0}) WHERE s_acctbal < 500
    UNION ALL SELECT s_suppkey, s_name, s_acctbal, 'update_preimage' FROM supplier {CHANGED}
    UNION ALL SELECT s_suppkey, s_name, s_acctbal + 1, 'update_postimage' FROM supplier {CHANGED}
    UNION ALL SELECT *, 'insert' FROM ({V1}) WHERE s_suppkey >= 1000000"""


def _log(t: Tables):
    old, new = _versions(t)
    start = changes.change_feed(old.limit(0), old, ["s_suppkey"], 0)
    return start.unionByName(changes.change_feed(old, new, ["s_suppkey"], 1))


@query("change_feed", f"SELECT *, cast(1 AS bigint) AS _commit_version FROM ({FEED})")
def change_feed(t: Tables):
    old, new = _versions(t)
    return changes.change_feed(old, new, ["s_suppkey"], 1).drop(changes.COMMITTED)


@query("change_feed_applied", V1)
def change_feed_applied(t: Tables):
    """The feed applied to the old version gives the new one."""
    old, new = _versions(t)
    return changes.apply_feed(old, changes.change_feed(old, new, ["s_suppkey"], 1), ["s_suppkey"])


@query("as_of_version", V0)
def as_of_version(t: Tables):
    return changes.as_of(_log(t), ["s_suppkey"], version=0)


@query("as_of_latest", V1)
def as_of_latest(t: Tables):
    return changes.as_of(_log(t), ["s_suppkey"], ts=F.current_timestamp())


@query("restored_version", V0)
def restored_version(t: Tables):
    """A restore is a new version whose content is the old one."""
    log, (_, new) = _log(t), _versions(t)
    undo = changes.restore(log, new, ["s_suppkey"], version=0, new_version=2)
    return changes.as_of(log.unionByName(undo), ["s_suppkey"], version=2)


@query(
    "version_history",
    f"""SELECT cast(0 AS bigint) AS _commit_version, count(*) AS inserted, 0::bigint AS updated, 0::bigint AS deleted FROM supplier
    UNION ALL SELECT 1, count(*) FILTER (_change_type = 'insert'), count(*) FILTER (_change_type = 'update_postimage'),
    count(*) FILTER (_change_type = 'delete') FROM ({FEED})""",
)
def version_history(t: Tables):
    return changes.history(_log(t)).drop(changes.COMMITTED)


V2 = f"SELECT s_suppkey, s_name, CASE WHEN s_acctbal < 2000 THEN s_acctbal * 2 ELSE s_acctbal END AS s_acctbal FROM ({V1})"
V3 = f"SELECT * FROM ({V2}) WHERE s_name NOT LIKE '%7'"


@query("as_of_snapshot", f"SELECT *, 1::bigint AS version FROM ({V1}) UNION ALL SELECT *, 3::bigint FROM ({V3})")
def as_of_snapshot(t: Tables):
    """Four versions with a snapshot every other one; one read by its number, one by time."""
    root, (old, new), keys = scratch(t.spark, "versions"), _versions(t), ["s_suppkey"]
    doubled = new.withColumn("s_acctbal", F.when(F.col("s_acctbal") < 2000, F.col("s_acctbal") * 2).otherwise(F.col("s_acctbal")))
    contents = [old.limit(0), old, new, doubled, doubled.filter(~F.col("s_name").like("%7"))]
    for version, (before, now) in enumerate(zip(contents, contents[1:], strict=False)):
        changes.commit(changes.change_feed(before, now, keys, version), root, keys, version, dt.datetime(2026, 1, 1 + version), every=2)
    by_number = changes.as_of_stored(t.spark, root, keys, version=1).withColumn("version", F.lit(1))
    by_time = changes.as_of_stored(t.spark, root, keys, at=dt.datetime(2026, 1, 4, 12)).withColumn("version", F.lit(3))
    return by_number.unionByName(by_time)


ORDER_COLUMNS = "o_orderkey, o_orderstatus, o_totalprice"


@query(
    "table_differences",
    f"""SELECT {ORDER_COLUMNS}, 'delete' AS difference FROM orders WHERE o_totalprice > 300000
    UNION ALL SELECT o_orderkey + 100000000, o_orderstatus, o_totalprice, 'insert' FROM orders WHERE o_totalprice < 2000
    UNION ALL SELECT {ORDER_COLUMNS}, 'update_preimage' FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' AND o_totalprice <= 300000
    UNION ALL SELECT o_orderkey, o_orderstatus, o_totalprice + 1, 'update_postimage' FROM orders
        WHERE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' AND o_totalprice <= 300000""",
)
def table_differences(t: Tables):
    """A stored table against a copy with rows changed, gone and added."""
    left, right = scratch(t.spark, "left"), scratch(t.spark, "right")
    columns, price = ["o_orderkey", "o_orderstatus", "o_totalprice"], F.col("o_totalprice")
    changed = F.when((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT"), price + 1).otherwise(price)
    fresh = t.orders.filter(price < 2000).select((F.col("o_orderkey") + 100_000_000).alias("o_orderkey"), "o_orderstatus", "o_totalprice")
    compare.write_comparable(t.orders.select(*columns), left, ["o_orderkey"], depth=1)
    compare.write_comparable(t.orders.filter(price <= 300_000).withColumn("o_totalprice", changed).select(*columns).unionByName(fresh), right, ["o_orderkey"], depth=1)
    return compare.differences(t.spark, left, right, ["o_orderkey"])


@query(
    "rewritten_files",
    """SELECT o_orderstatus, count(*) AS n, cast(sum(CASE WHEN o_orderkey > cut THEN cast(o_totalprice AS decimal(12,2)) WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END) AS double) AS total,
    true AS others_stay FROM orders, (SELECT max(o_orderkey) // 3 AS cut FROM orders) WHERE NOT (o_orderkey <= cut AND o_orderstatus = 'P') GROUP BY o_orderstatus""",
)
def rewritten_files(t: Tables):
    """The lower third of the keys updated, deleted and replaced by status in files ordered by key; no other file goes."""
    path, columns = scratch(t.spark, "files"), ["o_orderkey", "o_orderstatus", "o_totalprice"]
    t.orders.select(*columns).repartitionByRange(6, "o_orderkey").write.parquet(path)
    cut = t.orders.agg(F.floor(F.max("o_orderkey") / 3)).first()[0]
    low = F.col("o_orderkey") <= cut
    written = t.spark.read.parquet(path)
    touched = {f.rsplit("/", 1)[1] for f in rewrite.touched_files(written, low)}
    others = {f for f in written.inputFiles() if f.rsplit("/", 1)[1] not in touched}
    rewrite.update_rows(t.spark, path, low & (F.col("o_orderstatus") == "F"), {"o_totalprice": F.lit(0)})
    rewrite.delete_rows(t.spark, path, low & (F.col("o_orderstatus") == "P"))
    flat = t.orders.select(*columns).filter(low & (F.col("o_orderstatus") == "O")).withColumn("o_totalprice", F.lit(1.0))
    rewrite.replace_rows(t.spark, path, low & (F.col("o_orderstatus") == "O"), flat)
    t.spark.catalog.refreshByPath(path)
    after = t.spark.read.parquet(path)
    stay = others <= set(after.inputFiles())
    return after.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.sum(money("o_totalprice")).alias("total")).withColumn("others_stay", F.lit(stay))


@query(
    "repair_from_backup",
    """SELECT cast(sum(CASE WHEN l_suppkey = 5 THEN 0 ELSE cast(l_extendedprice AS decimal(12,2)) END) AS double) AS damaged_total,
    cast(sum(cast(l_extendedprice AS decimal(12,2))) AS double) AS repaired_total
    FROM (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey,
    l_quantity, l_extendedprice) AS rn FROM lineitem) WHERE rn = 1)""",
)
def repair_from_backup(t: Tables):
    """Damage, as a conditional update, then repair from the untouched copy."""
    keys = ["l_orderkey", "l_linenumber"]
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    intact = dedup(t.lineitem, keys, order, keep="first").select(*keys, "l_suppkey", money("l_extendedprice").alias("price"))
    broken = changes.conditional_update(intact, F.col("l_suppkey") == 5, {"price": F.lit(0)})
    fixed = changes.repair_from(broken, intact, keys, ["price"], F.col("l_suppkey") == 5)
    damaged = broken.agg(F.sum("price").alias("damaged_total")).scalar()
    return fixed.agg(F.sum("price").alias("repaired_total")).select(damaged.alias("damaged_total"), "repaired_total")


MONTHS = "SELECT l_orderkey, l_quantity, cast(strftime(l_shipdate, '%Y%m') AS bigint) AS ship_month, l_extendedprice FROM lineitem"


def _months(t: Tables):
    month = F.date_format("l_shipdate", "yyyyMM").cast("int").alias("ship_month")
    return t.lineitem.select("l_orderkey", "l_quantity", month, "l_extendedprice")


@query(
    "reload_slice",
    f"""SELECT ship_month, count(*) AS n, cast(sum(cast(l_extendedprice AS decimal(12,2))) AS double) AS total FROM
    (SELECT * FROM ({MONTHS}) WHERE ship_month <> 199607
     UNION ALL SELECT l_orderkey + 1000000, l_quantity, ship_month, l_extendedprice FROM ({MONTHS}) WHERE ship_month = 199607 AND l_quantity >= 25)
    GROUP BY ship_month""",
)
def reload_slice(t: Tables):
    """One month replaced by a delta; loaded twice, with the result of loading once."""
    fact = _months(t)
    delta = fact.filter("l_quantity >= 25").withColumn("l_orderkey", F.col("l_orderkey") + 1_000_000)
    once, _ = changes.reload_slice(fact, delta, "ship_month", 199607)
    twice, _ = changes.reload_slice(once, delta, "ship_month", 199607)
    return twice.groupBy("ship_month").agg(
        F.count(F.lit(1)).alias("n"), F.sum(money("l_extendedprice")).alias("total")
    )


@query(
    "reload_slice_log",
    f"""SELECT 'load_lines' AS proc_name, 199607::bigint AS ship_month, count(*) AS rows_deleted,
    count(*) FILTER (l_quantity >= 25) AS rows_inserted, 'SUCCESS' AS status, cast(NULL AS varchar) AS message
    FROM ({MONTHS}) WHERE ship_month = 199607""",
)
def reload_slice_log(t: Tables):
    fact = _months(t)
    _, log = changes.reload_slice(fact, fact.filter("l_quantity >= 25"), "ship_month", 199607, "load_lines")
    return log.drop("log_ts")


@query(
    "slice_load_run",
    f"""WITH s AS (SELECT count(*) AS n, count(*) FILTER (ship_month = 199607) AS a,
    count(*) FILTER (ship_month = 199607 AND l_quantity >= 25) AS h FROM ({MONTHS}))
    SELECT 1::bigint AS run, a AS rows_deleted, h AS rows_inserted, 'SUCCESS' AS status, n - a + h AS fact_rows FROM s
    UNION ALL SELECT 2, h, h, 'SUCCESS', n - a + h FROM s""",
)
def slice_load_run(t: Tables):
    """The load run twice against a partitioned folder, with its log and the fact count after each run."""
    path = scratch(t.spark, "fact")
    fact = _months(t)
    write_partitioned(fact, path, ["ship_month"])
    delta = fact.filter("l_quantity >= 25")
    runs = []
    for run in (1, 2):
        log = changes.run_slice_load(t.spark, path, delta, "ship_month", 199607)
        rows = t.spark.read.parquet(path).count()
        runs.append(log.select(F.lit(run).alias("run"), "rows_deleted", "rows_inserted", "status", F.lit(rows).alias("fact_rows")))
    return runs[0].unionByName(runs[1])


@query(
    "deleted_rows",
    "SELECT o_orderkey, status FROM (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS status FROM orders) "
    "WHERE status IS NULL OR status <> 'F'",
)
def deleted_rows(t: Tables):
    """Delete by predicate; rows for which it is unknown stay."""
    rows = t.orders.select("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("status"))
    return changes.delete_where(rows, F.col("status") == "F")


@query("guarded_rows", "SELECT o_orderkey, o_totalprice, true AS violation_stops FROM orders")
def guarded_rows(t: Tables):
    """Rows under a constraint that all of them meet, and whether one that some violate stops the job."""
    rows, price = t.orders.select("o_orderkey", "o_totalprice"), F.col("o_totalprice")
    try:
        stops = guarded(rows, "low price", price < rows.agg(F.max("o_totalprice")).scalar()).agg(F.sum("o_totalprice")).first() is None
    except PySparkException as problem:
        stops = "low price" in str(problem)
    return guarded(rows, "positive price", price >= 0).withColumn("violation_stops", F.lit(stops))
