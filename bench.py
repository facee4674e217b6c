"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the number of local cores. Every query runs to the end into
the ``noop`` sink. The JVM is warmed by a pass over the smallest sibling folder first, so start-up and code
generation are left out; the time covers the building of a query (stored intermediates included) and its run.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeops.catalog import QUERIES
from lakeops.catalog.base import Tables
from lakeops.catalog.marts import star
from lakeops.functions.scalars import money
from lakeops.session import local_session

HEADLINE = [
    "freight_by_region_month", "freight_by_region_month_raw", "top_customers_segment", "avg_transit_by_service",
    "avg_transit_by_service_raw", "sla_verdict_counts", "shipment_fact", "retail_silver", "monthly_region_category",
    "customer_lifetime", "star_sales_margin", "stockout_risk", "event_daily_channel", "event_quarantine",
    "visits_ranked", "hospital_fact", "dept_kpi", "readmission_rate", "readmitted_after", "census_daily",
    "zscore_anomalies", "maintenance_priority", "delivery_outcome", "carrier_scorecard", "churn_features",
    "salted_join_totals", "hot_key_join_totals", "dedup_latest", "visit_sequence_gaps", "dense_rank_value",
    "running_total", "surrogate_keys_composite", "upsert_scd1", "change_feed", "as_of_latest", "reload_slice",
    "partition_overwrite", "zorder_layout", "stream_ingest_equals_batch", "fraud_scores",
    "freight_by_segment_bucketed", "stream_upsert_event_order", "as_of_snapshot", "table_differences", "rewritten_files",
    "exact_split", "monthly_distinct_accounts", "machine_statistics_kept",
]
# Part of the total; a second sum leaves them out, as the total of the round before did.
APART = ("star_write", "fraud_scores")


def plain_join(t: Tables) -> DataFrame:
    """The salted join without salt."""
    joined = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    return joined.groupBy("s_nationkey").agg(F.sum(money("l_extendedprice")).alias("total"))


def literal_range_join(t: Tables) -> DataFrame:
    """One year of the census as the range join it is defined by."""
    start = F.to_date("o_orderdate")
    spans = t.orders.select(start.alias("a"), F.date_add(start, (F.col("o_orderkey") % 40).cast("int")).alias("b"))
    days = t.spark.sql("SELECT explode(sequence(date'1996-01-01', date'1996-12-31', interval 1 day)) AS day")
    joined = days.join(spans, (F.col("day") >= F.col("a")) & (F.col("day") < F.col("b")), "left")
    return joined.groupBy("day").agg(F.count("a").alias("open_orders"))


def global_row_number(t: Tables) -> DataFrame:
    """Surrogate keys by one unpartitioned window."""
    order = Window.orderBy("o_orderpriority", "o_totalprice", "o_orderkey")
    return t.orders.select("o_orderkey", F.row_number().over(order).alias("order_rank"))


CONTRAST = {
    "contrast_plain_join": plain_join,
    "contrast_range_join_census": literal_range_join,
    "contrast_global_row_number": global_row_number,
}


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    only = set(sys.argv[1:])
    spark = local_session(cores, app="lakeops-bench")
    small = os.path.join(os.path.dirname(folder.rstrip("/")), "sf0.001")
    for name in HEADLINE:
        if os.path.isdir(small) and name not in APART and (not only or name in only):
            run(QUERIES[name](spark, small))
    # The shipment star is written once, before the reports that read it; its time counts.
    times: dict[str, float] = {}
    if not only or "star_write" in only:
        start = time.perf_counter()
        star(Tables(spark, folder))
        times["star_write"] = round(time.perf_counter() - start, 3)
    for name in HEADLINE:
        if not only or name in only:
            start = time.perf_counter()
            run(QUERIES[name](spark, folder))
            times[name] = round(time.perf_counter() - start, 3)
    contrast: dict[str, float] = {}
    for name, build in CONTRAST.items():
        if not only or name in only:
            start = time.perf_counter()
            run(build(Tables(spark, folder)))
            contrast[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "without_star_and_training": round(sum(s for n, s in times.items() if n not in APART), 3),
        "queries": times, "contrast": contrast, "sf": os.path.basename(folder.rstrip("/")), "cores": int(cores),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
