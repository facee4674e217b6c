"""Generated shipment rows whose control totals are published; only tests use them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.functions.scalars import case_of, zero_padded
from lakeops.plans.shipments import STAGING
from lakeops.sources.readers import number_series

# City and region by hub number modulo 10, hub type by modulo 4; the moduli, factors and counts below make the
# published control totals.
HUB_CITIES = {
    0: ("Mumbai", "West"), 1: ("Delhi", "North"), 2: ("Bengaluru", "South"), 3: ("Chennai", "South"),
    4: ("Kolkata", "East"), 5: ("Hyderabad", "South"), 6: ("Pune", "West"), 7: ("Ahmedabad", "West"),
    8: ("Jaipur", "North"), 9: ("Lucknow", "North"),
}
HUB_TYPES = {0: "Air", 1: "Road", 2: "Rail", 3: "Port"}


def hub_dim(spark: SparkSession, count: int = 40) -> DataFrame:
    slot = F.col("n") % 10
    return number_series(spark, count).select(
        F.col("n").cast("int").alias("hub_key"),
        F.concat(F.lit("HUB"), zero_padded("n", 2)).alias("hub_code"),
        case_of(slot, {k: v[0] for k, v in HUB_CITIES.items()}).alias("city"),
        case_of(slot, {k: v[1] for k, v in HUB_CITIES.items()}).alias("region"),
        case_of(F.col("n") % 4, HUB_TYPES).alias("hub_type"),
    )


def customer_dim(spark: SparkSession, count: int = 50_000) -> DataFrame:
    slot = F.col("n") % 10
    segment = F.when(slot.isin(0, 1), "Enterprise").when(slot.isin(2, 3, 4), "SMB").otherwise("Consumer")
    return number_series(spark, count).select(
        F.col("n").cast("int").alias("customer_key"),
        F.concat(F.lit("CUST"), zero_padded("n", 5)).alias("customer_id"),
        segment.alias("segment"),
        F.date_add(F.lit("2022-01-01").cast("date"), (F.col("n") % 500).cast("int")).alias("signup_date"),
    )


def _days_on(start: Column, days: Column) -> Column:
    return F.date_format(F.date_add(start, days.cast("int")), "yyyy-MM-dd")


def _staged(numbers: DataFrame, **given: Column) -> DataFrame:
    """Staging columns every generated row shares, all as text."""
    n = F.col("n")

    def cents(value: Column) -> Column:
        return (value.cast("decimal(14,2)") / 100).cast("decimal(12,2)").cast("string")

    common = {
        "customer_id": F.concat(F.lit("CUST"), zero_padded((n * 7919) % 50000 + 1, 5)),
        "hub_code": F.concat(F.lit("HUB"), zero_padded((n * 31) % 40 + 1, 2)),
        "weight_kg": cents(50 + (n * 29) % 5000),
        "freight_amount": cents(5000 + (n * 37) % 250000),
        "is_express": F.when(n % 7 == 0, "Y").otherwise("N"),
        **given,
    }
    return numbers.select(*[common[c].alias(c) for c in STAGING])


def staged_shipments(spark: SparkSession, count: int = 1_000_000, repeat_every: int = 5000) -> DataFrame:
    """Deterministic staging rows with planted defects: unknown carriers, open deliveries, repeated rows."""
    n = F.col("n")
    start, offset = F.lit("2024-01-01").cast("date"), (n * 13) % 731
    status = case_of(n % 19, {0: "Returned", 1: "Cancelled", 2: "In Transit"}, "Delivered")
    carrier = F.concat(F.lit("CAR"), zero_padded((n * 17) % 12 + 1, 2))
    rows = _staged(
        number_series(spark, count),
        shipment_id=F.concat(F.lit("SHP"), zero_padded("n", 7)),
        carrier_code=F.when(n % 997 == 0, "CAR99").otherwise(carrier),
        ship_date=_days_on(start, offset),
        delivery_date=F.when(~(n % 19).isin(1, 2), _days_on(start, offset + 1 + n % 6)),
        status=status,
    )
    again = rows.filter(F.substring("shipment_id", 4, 7).cast("int") % repeat_every == 0)
    return rows.unionByName(again)


def staged_delta(spark: SparkSession, count: int = 5000, day: str = "2026-01-05") -> DataFrame:
    """Staging rows of one later day."""
    n, start = F.col("n"), F.lit(day).cast("date")
    return _staged(
        number_series(spark, count),
        shipment_id=F.concat(F.lit("SHP"), (n + 1_000_000).cast("string")),
        carrier_code=F.concat(F.lit("CAR"), zero_padded((n * 17) % 12 + 1, 2)),
        ship_date=F.lit(day),
        delivery_date=_days_on(start, 1 + n % 6),
        status=F.lit("Delivered"),
    )
