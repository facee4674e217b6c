"""Shipment warehouse: all-text staging to a typed star, its reports, the incident drill."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.functions.scalars import case_of, holds, sla_verdict, text_date_key, zero_padded
from lakeops.operators.aggregates import top_k
from lakeops.operators.changes import repair_from
from lakeops.operators.clean import dedup
from lakeops.operators.joins import broadcast_join, dim_lookup
from lakeops.sources.sinks import write_bucketed, write_partitioned

STAGING = [
    "shipment_id", "customer_id", "hub_code", "carrier_code", "ship_date", "delivery_date", "weight_kg",
    "freight_amount", "status", "is_express",
]

# Rows of the fact to a bucket, and the least number of buckets.
BUCKET_ROWS, BUCKETS = 500_000, 8

# Service level by carrier number modulo 3.
SERVICE_LEVELS = {0: "Express", 1: "Standard", 2: "Economy"}


def carrier_dim(numbers: DataFrame) -> DataFrame:
    """Carriers from a column ``n`` plus the unknown member -1."""
    known = numbers.select(
        F.col("n").cast("int").alias("carrier_key"),
        F.concat(F.lit("CAR"), zero_padded("n", 2)).alias("carrier_code"),
        F.concat(F.lit("Carrier "), F.col("n").cast("string")).alias("carrier_name"),
        case_of(F.col("n") % 3, SERVICE_LEVELS).alias("service_level"),
    )
    unknown = numbers.sparkSession.sql(
        "SELECT * FROM VALUES (-1, 'UNK', 'Unknown carrier', 'Unknown')"
        " AS t(carrier_key, carrier_code, carrier_name, service_level)"
    )
    return unknown.unionByName(known)


def conformed(staging: DataFrame, customers: DataFrame, hubs: DataFrame, carriers: DataFrame) -> DataFrame:
    """Staging rows as typed fact rows: dimension keys, -1 for an unknown carrier, transit days."""
    keyed = broadcast_join(staging, customers.select("customer_id", "customer_key"), "customer_id")
    keyed = broadcast_join(keyed, hubs.select("hub_code", "hub_key"), "hub_code")
    keyed = dim_lookup(keyed, carriers, "carrier_code", "carrier_key")
    shipped, delivered = F.to_date("ship_date"), F.to_date("delivery_date")
    return keyed.select(
        F.expr("try_cast(substring(shipment_id, 4) AS bigint)").alias("shipment_key"),
        "shipment_id",
        "customer_key",
        "hub_key",
        "carrier_key",
        text_date_key("ship_date").alias("ship_date_key"),
        text_date_key("delivery_date").alias("delivery_date_key"),
        F.col("weight_kg").cast("decimal(8,2)").alias("weight_kg"),
        F.col("freight_amount").cast("decimal(12,2)").alias("freight_amount"),
        "status",
        (F.col("is_express") == "Y").alias("is_express"),
        F.datediff(delivered, shipped).cast("smallint").alias("transit_days"),
    )


def fact_shipments(staging: DataFrame, customers: DataFrame, hubs: DataFrame, carriers: DataFrame) -> DataFrame:
    """Typed fact with one row per shipment: the earliest shipped, equal dates by the remaining columns."""
    order = ["ship_date", *[c for c in STAGING if c not in ("shipment_id", "ship_date")]]
    return conformed(dedup(staging, ["shipment_id"], order, keep="first"), customers, hubs, carriers)


def write_star(fact: DataFrame, path: str) -> None:
    """The fact in one folder per ship month, so reports of a period read no others."""
    month = F.floor(F.col("ship_date_key") / 100).cast("int")
    write_partitioned(fact.withColumn("ship_month", month), path, ["ship_month"], mode="overwrite")


def incident_drill(fact: DataFrame, versions: str, damage: Column, keys: list[str]) -> DataFrame:
    """Back up the fact, damage some freight, read the fact as it was, and repair only what was damaged from that.

    The versions are folders under ``versions``; returns the repaired fact.
    """
    fact.write.mode("errorifexists").parquet(f"{versions}/version=0")
    zeroed = F.when(holds(damage), F.lit(0).cast(fact.schema["freight_amount"].dataType)).otherwise(F.col("freight_amount"))
    fact.withColumn("freight_amount", zeroed).write.mode("errorifexists").parquet(f"{versions}/version=1")
    every = fact.sparkSession.read.parquet(versions)
    before, after = (every.filter(F.col("version") == v).drop("version") for v in (0, 1))
    return repair_from(after, before, keys, ["freight_amount"], damage)


def validation(fact: DataFrame) -> dict[str, Column]:
    """Control totals of the fact, for :func:`lakeops.operators.quality.control_totals`."""
    return {
        "row_count": F.count(F.lit(1)),
        "distinct_keys": F.countDistinct("shipment_key"),
        "unknown_carrier": F.count_if(F.col("carrier_key") == -1),
        "total_freight": F.sum("freight_amount"),
        "total_weight": F.sum("weight_kg"),
        "null_transit": F.count_if(F.col("transit_days").isNull()),
    }


def freight_by_region_month(fact: DataFrame, hubs: DataFrame, dates: DataFrame, year: int) -> DataFrame:
    """Freight per region and month of one year, over typed keys."""
    if "ship_month" in fact.columns:
        return freight_of_days(fact, hubs, dates.filter(F.col("year_num") == year))
    # The calendar's keys of the year also bound the fact's own key, so the scan skips other years.
    first, last = year * 10000 + 101, year * 10000 + 1231
    rows = fact.filter(F.col("ship_date_key").between(first, last))
    days = dates.filter(F.col("year_num") == year).select("date_key", "year_num", "month_num")
    per_day = rows.groupBy("hub_key", "ship_date_key").agg(F.sum("freight_amount").alias("freight"))
    return (
        per_day.join(hubs.select("hub_key", "region"), "hub_key")
        .join(days, F.col("date_key") == F.col("ship_date_key"))
        .groupBy("region", "year_num", "month_num")
        .agg(F.sum("freight").alias("freight"))
    )


def freight_of_days(fact: DataFrame, hubs: DataFrame, days: DataFrame) -> DataFrame:
    """Freight per region and month over any choice of calendar days, from a fact written by ship month.

    The calendar has one row a day, so it is broadcast; its months prune the fact's folders at run time, whatever
    attribute of the calendar the days were chosen by.
    """
    month = (F.col("year_num") * 100 + F.col("month_num")).cast("int").alias("ship_month")
    chosen = days.select(F.col("date_key").alias("ship_date_key"), month, "year_num", "month_num")
    per_hub = fact.join(F.broadcast(chosen), ["ship_month", "ship_date_key"]).groupBy("hub_key", "year_num", "month_num")
    totals = per_hub.agg(F.sum("freight_amount").alias("freight")).join(hubs.select("hub_key", "region"), "hub_key")
    return totals.groupBy("region", "year_num", "month_num").agg(F.sum("freight").alias("freight"))


def bucket_count(fact: DataFrame) -> int:
    """Buckets of at most about ``BUCKET_ROWS`` rows, so that each is sorted in the memory of a task; no fewer than ``BUCKETS``."""
    return max(BUCKETS, math.ceil(fact.count() / BUCKET_ROWS))


def write_bucketed_star(fact: DataFrame, customers: DataFrame, root: str, buckets: int) -> tuple[DataFrame, DataFrame]:
    """Fact and customers in as many buckets of the customer's key, each sorted by it; both as written."""
    return write_bucketed(fact, f"{root}/fact", "customer_key", buckets), write_bucketed(customers, f"{root}/customers", "customer_key", buckets)


def freight_by_segment(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """Rows and freight per customer segment. Over tables in the same buckets the join shuffles neither side."""
    joined = fact.select("customer_key", "freight_amount").join(customers.select("customer_key", "segment").hint("merge"), "customer_key")
    return joined.groupBy("segment").agg(F.count(F.lit(1)).alias("n"), F.sum("freight_amount").alias("freight"))


def freight_by_region_month_raw(staging: DataFrame, hubs: DataFrame, year: int) -> DataFrame:
    """The same report over untyped staging rows, repeated rows included."""
    return (
        staging.filter(F.year(F.to_date("ship_date")) == year)
        .join(hubs.select("hub_code", "region"), "hub_code")
        .groupBy("region", F.left("ship_date", F.lit(7)).alias("ship_month"))
        .agg(F.sum(F.col("freight_amount").cast("decimal(12,2)")).alias("freight"))
    )


def top_customers(fact: DataFrame, customers: DataFrame, segment: str, k: int = 20) -> DataFrame:
    """Customers of a segment with the highest freight."""
    members = customers.filter(F.col("segment") == segment).select("customer_key", "customer_id")
    return top_k(fact.join(members, "customer_key"), ["customer_id"], F.sum("freight_amount"), "freight", k)


def transit_by_service(fact: DataFrame, carriers: DataFrame) -> DataFrame:
    """Mean transit days per service level of what was delivered."""
    moved = fact.filter((F.col("status") != "Cancelled") & F.col("transit_days").isNotNull())
    return (
        moved.join(carriers.select("carrier_key", "service_level"), "carrier_key")
        .groupBy("service_level")
        .agg(F.avg("transit_days").alias("avg_transit_days"))
    )


def sla_view(fact: DataFrame) -> DataFrame:
    return fact.select(
        "shipment_key", "status", "is_express", "transit_days",
        sla_verdict("transit_days", "is_express").alias("sla_result"),
    )
