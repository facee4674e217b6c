"""Physical plans: what reaches the scan, what is shuffled, what never appears."""

import time
from pathlib import Path

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from lakeops.catalog import QUERIES, domains, marts
from lakeops.catalog.base import Tables
from lakeops.operators.quality import quarantine
from lakeops.plans import retail, shipments
from lakeops.session import scratch, shared_root, stored
from lakeops.sources import files
from lakeops.sources.files import load_once
from lakeops.sources.readers import calendar, day_bounds
from lakeops.sources.sinks import key_slices


def test_filters_and_columns_reach_the_scan(spark, small):
    text = plan(QUERIES["filter_predicates"](spark, small))
    assert "In(o_orderstatus, [F,P])" in text and "GreaterThanOrEqual(o_totalprice,50000.0)" in text
    assert "StringStartsWith(o_orderpriority,2-)" in text
    assert "o_orderdate" not in text


def test_quality_rules_reach_the_scan(spark):
    path = scratch(spark, "rules")
    spark.range(10).select("id", F.lit("USD").alias("currency"), F.lit(1.0).alias("amount")).write.parquet(path)
    rules = {"amount": F.col("amount") > 0, "currency": F.col("currency").isin("USD", "EUR")}
    valid, _ = quarantine(spark.read.parquet(path), rules)
    assert "GreaterThan(amount,0.0)" in plan(valid) and "In(currency, [EUR,USD])" in plan(valid)


@pytest.mark.parametrize(
    "name",
    ["census_daily", "open_orders_census", "readmitted_after", "next_run_id", "calendar_dim", "hot_key_join_totals",
     "upsert_scd1", "surrogate_keys_composite", "zscore_anomalies", "freight_by_region_month"],
)
def test_no_nested_loops(spark, small, name):
    text = plan(QUERIES[name](spark, small))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_one_shuffle_where_one_is_enough(spark, small):
    for name in ("dedup_latest", "running_total", "visit_sequence_gaps", "readmission_lag", "churn_features", "ward_daily"):
        assert plan(QUERIES[name](spark, small)).count("Exchange hashpartitioning") == 1, name


def test_top_k_keeps_k_rows_per_task(spark, small):
    assert "TakeOrderedAndProject(limit=20" in plan(QUERIES["top_parts"](spark, small))


def test_no_python_outside_the_two_function_forms(spark, small):
    for name in ("risk_bucket_native", "retail_silver", "event_daily_channel", "zscore_anomalies", "shipment_fact"):
        assert "Python" not in plan(QUERIES[name](spark, small)), name


def test_reports_read_the_written_star(spark, small):
    """Q1 reads the months of its days, pruned at run time, and its three columns; the star itself is built without shuffling rows by carrier."""
    text = plan(QUERIES["freight_by_region_month"](spark, small))
    fact = next(line for line in text.split("\n") if "Scan parquet" in line and "ship_month" in line)
    assert "PartitionFilters: [isnotnull(ship_month" in fact and "dynamicpruningexpression(ship_month" in fact
    assert "shipment_id" not in fact and "carrier_key" not in fact
    assert "hashpartitioning(carrier_code" not in plan(QUERIES["shipment_fact"](spark, small))


def test_folders_pruned_by_any_attribute_of_the_calendar(spark, small):
    """Days chosen by weekday and quarter, which no folder is named by."""
    t = Tables(spark, small)
    days = calendar(day_bounds(t.orders, "o_orderdate"), "first_day", "last_day").where("quarter_num = 1 AND year_num = 1995")
    report = shipments.freight_of_days(marts.star(t), domains.hubs(t), days)
    assert "dynamicpruningexpression(ship_month" in plan(report)
    fact = marts.star(t).where("ship_month BETWEEN 199501 AND 199503").agg(F.sum("freight_amount")).first()[0]
    assert report.agg(F.sum("freight")).first()[0] == fact
    assert {r.month_num for r in report.collect()} == {1, 2, 3}


def test_bucketed_tables_join_without_a_shuffle(spark, small):
    text = plan(QUERIES["freight_by_segment_bucketed"](spark, small))
    assert "SortMergeJoin" in text and text.count("Bucketed: true") == 2
    assert "hashpartitioning(customer_key" not in text and "Broadcast" not in text


def test_a_rewritten_input_is_another_star(spark, small):
    """The same file names with other rows: reports see what is there now, and a load that was swept is done again."""
    folder = scratch(spark, "tables")
    for name in ("lineitem", "orders", "customer", "supplier", "nation", "region", "part"):
        spark.read.parquet(f"{small}/{name}.parquet").coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    t = Tables(spark, folder)
    counted = QUERIES["sla_verdict_counts"]
    before = sum(r.n for r in counted(spark, folder).collect())
    assert before == QUERIES["shipment_fact"](spark, folder).count()
    marts.star(t).createOrReplaceTempView("star_before")
    assert sum(r.n for r in counted(spark, folder).collect()) == before
    half = stored(t.lineitem.where("l_quantity < 25"))
    half.coalesce(1).write.mode("overwrite").parquet(f"{folder}/lineitem.parquet")
    spark.catalog.refreshByPath(folder)
    after = sum(r.n for r in counted(spark, folder).collect())
    assert after == QUERIES["shipment_fact"](spark, folder).count() < before
    files.remove(spark, load_once(spark, "star", [t.lineitem, t.orders, t.customer, t.supplier, t.nation, t.part], lambda path: None))
    assert sum(r.n for r in counted(spark, folder).collect()) == after


def test_buckets_follow_the_rows(spark):
    assert shipments.bucket_count(spark.range(1000)) == shipments.BUCKETS
    assert shipments.bucket_count(spark.range(20 * shipments.BUCKET_ROWS + 1)) == 21


def test_joined_lines_are_spread_by_their_number(spark):
    """Parts of the join follow the rows, not the bytes of the narrow rows before it; all rows stay."""
    lines = spark.range(1000).select((F.col("id") % 300).alias("l_orderkey"), "id")
    spread = domains.by_order(lines, 100)
    assert spread.rdd.getNumPartitions() == 10 and sorted(spread.collect()) == sorted(lines.collect())
    assert domains.by_order(lines, 200) is lines


def test_raw_sales_are_written_compressed(spark, small):
    before = set(files.matching(spark, f"{shared_root(spark)}/raw-*/*.csv*"))
    assert QUERIES["retail_layers"](spark, small).count() > 0
    written = set(files.matching(spark, f"{shared_root(spark)}/raw-*/*.csv*")) - before
    assert written and all(w.endswith(".csv.gz") for w in written)


def shuffle_files(spark) -> set[Path]:
    """Shuffle files that lie in the session's local folders."""
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for folder in folders for f in Path(folder.toString()).rglob("shuffle_*.data")}


@pytest.fixture
def sales_tables(spark):
    """The tables that retail sales are joined from; some lines come twice, some have no order."""
    folder, n = scratch(spark, "tables"), F.col("id")
    tables = {
        "region": spark.range(2).select(n.alias("r_regionkey"), F.when(n == 0, "ASIA").otherwise("EUROPE").alias("r_name")),
        "nation": spark.range(3).select(n.alias("n_nationkey"), (n % 2).alias("n_regionkey")),
        "customer": spark.range(60).select(n.alias("c_custkey"), F.concat(F.lit("C"), "id").alias("c_name"), (n % 3).alias("c_nationkey")),
        "part": spark.range(20).select(n.alias("p_partkey"), F.concat(F.lit("P"), "id").alias("p_name"), F.lit("LARGE").alias("p_type"), (n + 0.5).alias("p_retailprice")),
        "orders": spark.range(100).select(n.alias("o_orderkey"), (n % 60).alias("o_custkey"), F.date_add(F.lit("2026-01-01").cast("date"), (n % 90).cast("int")).alias("o_orderdate")),
        "lineitem": spark.range(400).select(
            F.when(n % 50 > 0, n % 110).alias("l_orderkey"), (n % 20).alias("l_partkey"), (n % 2).alias("l_linenumber"), (n % 9 + 1.0).alias("l_quantity"),
            F.lit(0.1).alias("l_discount"), (n * 1.5).alias("l_extendedprice"), F.lit("2026-02-01").cast("date").alias("l_shipdate"),
        ),
    }
    for name, table in tables.items():
        table.write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_retail_layers_in_slices(spark, sales_tables, monkeypatch):
    """All rows come through however few are shuffled at a time, and the shuffle files are gone when the layers are written."""
    whole = rows(QUERIES["retail_layers"](spark, sales_tables))
    monkeypatch.setattr(retail, "SLICE_ROWS", 90)
    before, folders = shuffle_files(spark), set(files.matching(spark, f"{shared_root(spark)}/retail-*"))
    sliced = QUERIES["retail_layers"](spark, sales_tables)
    until = time.time() + 20
    while (left := shuffle_files(spark) - before) and time.time() < until:  # they are removed in the background
        time.sleep(0.2)
    assert not left
    assert rows(sliced) == whole and len(whole) == 6
    (root,) = set(files.matching(spark, f"{shared_root(spark)}/retail-*")) - folders
    tables = ["bronze", "gold_customers", "gold_fact", "gold_monthly", "silver"]
    assert [t.rsplit("/", 1)[1] for t in files.matching(spark, f"{root}/*")] == tables
    bronze, silver = spark.read.parquet(f"{root}/bronze"), spark.read.parquet(f"{root}/silver")
    assert bronze.count() > 3 * 90 and rows(silver) == rows(retail.clean_sales(bronze, retail.TIES).drop("_source_file"))
    assert rows(spark.read.parquet(f"{root}/gold_fact")) == rows(retail.fact_sales(silver))


def test_sales_shuffle_few_columns(spark, sales_tables):
    """Customers are joined to the orders; a slice of the lines takes only its own orders."""
    t = Tables(spark, sales_tables)
    lines = t.lineitem.where(key_slices(t.lineitem, "l_orderkey", 100)[1])
    text = plan(domains.retail_bronze(t, lines))
    assert "pmod(xxhash64(l_orderkey" in text and "pmod(xxhash64(o_orderkey" in text
    every = [domains.retail_bronze(t, t.lineitem.where(held)) for held in key_slices(t.lineitem, "l_orderkey", 100)]
    assert len(every) == 4 and sorted(r for part in every for r in rows(part)) == sorted(rows(domains.retail_bronze(t)))
