"""The given tables seen as the tables of each domain, as DataFrames and as SQL common table expressions.

Defects (unknown members, blanks, missing values, repeated keys) are derived from column values, so both
sides plant the same ones and they grow with the data.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.catalog.base import Tables
from lakeops.functions.scalars import zero_padded
from lakeops.operators.joins import broadcast_join


def with_(names: str, body: str) -> str:
    """``body`` preceded by the named common table expressions."""
    return "WITH " + ", ".join(f"{n} AS ({CTES[n]})" for n in names.split()) + " " + body


def padded(number: str, width: int) -> str:
    """SQL for :func:`lakeops.functions.scalars.zero_padded`."""
    text = f"cast({number} AS varchar)"
    return f"lpad({text}, cast(greatest({width}, length({text})) AS integer), '0')"


def payload_key() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def bank(t: Tables) -> DataFrame:
    """Events as bank transactions."""
    k = payload_key()
    slot = k % 20
    currency = (
        F.when(slot == 0, "XYZ").when(slot == 1, None).when(slot <= 6, "EUR").when(slot <= 9, "GBP")
        .when(slot <= 11, "INR").otherwise("USD")
    )
    return t.events.select(
        F.when(k != 7, F.col("event_id").cast("string")).alias("txn_id"),
        F.concat(F.lit("A"), F.col("user_id").cast("string")).alias("account_id"),
        F.when(~((F.col("event_type") == "error") & (k % 10 == 0)), F.col("value")).alias("amount"),
        currency.alias("currency"),
        F.col("ts").alias("txn_ts"),
        F.upper("event_type").alias("channel"),
    )


def retail_bronze(t: Tables, lines: DataFrame | None = None) -> DataFrame:
    """Line items, all or the given ones, as raw retail sales: untidy text, negative prices, blank customers, repeated order ids.

    Customers are joined to the orders, not to the lines, and orders last: fewer columns are shuffled with each line, and what
    lines of an order have in common is repeated in rows near one another, so that files of them are small.
    """
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "r_name")
    buyers = t.customer.join(places, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", "c_name", "r_name"
    )
    placed = t.orders.join(buyers, F.col("o_custkey") == F.col("c_custkey"))
    lines = t.lineitem if lines is None else lines
    full = lines.join(t.part, F.col("l_partkey") == F.col("p_partkey")).join(
        placed, F.col("l_orderkey") == F.col("o_orderkey")
    )
    number = F.col("l_linenumber")
    return full.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("order_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"),
        F.col("c_custkey").alias("customer_id"),
        F.when(F.col("c_custkey") % 50 == 0, "  ").otherwise(F.concat(F.lit("  "), "c_name")).alias("customer_name"),
        F.when(number % 2 == 0, F.upper("r_name"))
        .otherwise(F.concat(F.lit(" "), F.lower("r_name"), F.lit(" ")))
        .alias("region"),
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("l_quantity").alias("quantity"),
        F.when(number == 7, -F.col("p_retailprice")).otherwise(F.col("p_retailprice")).alias("unit_price"),
        F.col("l_discount").alias("discount"),
        F.col("l_extendedprice").alias("profit"),
        F.col("l_shipdate").alias("_ingested_at"),
    )


RETAIL_TIES = ["product_id", "quantity", "profit", "discount", "unit_price"]


# Joined line items become wide text rows, which later steps sort where they lie: no more of them to a task than this.
JOINED_ROWS = 500_000


def by_order(lines: DataFrame, rows: int) -> DataFrame:
    """Line items in parts of about ``rows`` by their order, for a join; a few parts are left as they lie.

    The number is given, as the sizes that AQE joins shuffled parts by are those of the narrow rows before the join.
    """
    parts = math.ceil(lines.count() / rows)
    return lines.repartition(parts, "l_orderkey") if parts > 8 else lines


def staging(t: Tables) -> DataFrame:
    """Line items as all-text shipment rows; the shipment number repeats where the line number does."""
    lines = by_order(t.lineitem, JOINED_ROWS).join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    number = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    shipped = F.to_date("o_orderdate")
    arrived = F.date_add(shipped, (1 + F.col("l_partkey") % 6).cast("int"))
    flag = F.col("l_returnflag")
    status = (
        F.when(F.col("l_partkey") % 19 == 1, "Cancelled").when(F.col("o_orderstatus") == "O", "In Transit")
        .when(flag == "R", "Returned").otherwise("Delivered")
    )
    return lines.select(
        F.concat(F.lit("SHP"), zero_padded(number, 12)).alias("shipment_id"),
        F.concat(F.lit("CUST"), zero_padded(F.col("o_custkey"), 9)).alias("customer_id"),
        F.concat(F.lit("HUB"), zero_padded(F.col("l_suppkey"), 7)).alias("hub_code"),
        F.when(F.col("l_partkey") % 97 == 0, "CAR99")
        .otherwise(F.concat(F.lit("CAR"), zero_padded(F.col("l_partkey") % 12 + 1, 2)))
        .alias("carrier_code"),
        F.date_format(shipped, "yyyy-MM-dd").alias("ship_date"),
        F.when(~status.isin("Cancelled", "In Transit"), F.date_format(arrived, "yyyy-MM-dd")).alias("delivery_date"),
        F.col("l_quantity").cast("decimal(8,2)").cast("string").alias("weight_kg"),
        F.col("l_extendedprice").cast("decimal(12,2)").cast("string").alias("freight_amount"),
        status.alias("status"),
        F.when(F.col("l_linestatus") == "F", "Y").otherwise("N").alias("is_express"),
    )


def hubs(t: Tables) -> DataFrame:
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return t.supplier.join(places, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("hub_key"),
        F.concat(F.lit("HUB"), zero_padded(F.col("s_suppkey"), 7)).alias("hub_code"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("region"),
    )


def carrier_numbers(t: Tables) -> DataFrame:
    """The carrier numbers that parts refer to."""
    return t.part.select((F.col("p_partkey") % 12 + 1).alias("n")).distinct()


def segments(t: Tables) -> DataFrame:
    return t.customer.select(
        F.col("c_custkey").alias("customer_key"),
        F.concat(F.lit("CUST"), zero_padded(F.col("c_custkey"), 9)).alias("customer_id"),
        F.col("c_mktsegment").alias("segment"),
    )


def departments(t: Tables) -> DataFrame:
    return t.nation.select(
        F.concat(F.lit("D"), zero_padded(F.col("n_nationkey"), 2)).alias("department_id"),
        F.col("n_name").alias("department_name"),
        (F.col("n_nationkey") % 7 + 5).alias("beds"),
    )


def doctors(t: Tables) -> DataFrame:
    return t.supplier.select(
        F.concat(F.lit("DR"), zero_padded(F.col("s_suppkey"), 7)).alias("doctor_id"),
        F.col("s_name").alias("doctor_name"),
        F.concat(F.lit("D"), zero_padded(F.col("s_nationkey"), 2)).alias("department_id"),
    )


def patients(t: Tables) -> DataFrame:
    age_days = (365 + F.col("c_custkey") * 37 % 32000).cast("int")
    return t.customer.select(
        F.concat(F.lit("PT"), zero_padded(F.col("c_custkey"), 9)).alias("patient_id"),
        F.date_sub(F.lit("2026-01-01").cast("date"), age_days).alias("birth_date"),
        F.col("c_mktsegment").alias("insurance_type"),
    )


def admissions(t: Tables) -> DataFrame:
    """Orders as hospital stays of 0 to 9 days, spread over all doctors. A small table of doctors is broadcast."""
    doctor = F.col("o_orderkey") % t.supplier.agg(F.count(F.lit(1))).scalar()
    placed = t.supplier.select(
        F.col("s_suppkey").alias("_doc"),
        F.concat(F.lit("D"), zero_padded(F.col("s_nationkey"), 2)).alias("department_id"),
    )
    start = F.to_date("o_orderdate")
    return broadcast_join(t.orders.withColumn("_doc", doctor), placed, "_doc").select(
        F.col("o_orderkey").alias("admission_id"),
        F.concat(F.lit("PT"), zero_padded(F.col("o_custkey"), 9)).alias("patient_id"),
        F.concat(F.lit("DR"), zero_padded("_doc", 7)).alias("doctor_id"),
        "department_id",
        start.alias("admit_date"),
        F.date_add(start, (F.col("o_orderkey") * 7 % 10).cast("int")).alias("discharge_date"),
        F.col("o_orderstatus").alias("diagnosis_group"),
        (F.col("o_orderpriority") == "1-URGENT").alias("is_emergency"),
        F.col("o_totalprice").alias("total_charges"),
    )


def stays(t: Tables) -> DataFrame:
    """Orders as ward stays of 1 to 9 days."""
    start, days = F.to_date("o_orderdate"), (F.col("o_orderkey") * 7 % 9 + 1).cast("int")
    return t.orders.select(
        F.col("o_orderkey").alias("admission_id"),
        F.col("o_custkey").alias("patient_id"),
        F.col("o_orderpriority").alias("ward"),
        start.alias("admit_date"),
        F.date_add(start, days).alias("discharge_date"),
        days.alias("length_of_stay_days"),
    )


def ward_patients(t: Tables) -> DataFrame:
    """All customers as ward patients."""
    return t.customer.select(
        F.col("c_custkey").alias("patient_id"),
        (F.col("c_custkey") * 13 % 96).alias("age"),
        (F.col("c_acctbal") < 2000).alias("has_chronic_condition"),
    )


def readings(t: Tables) -> DataFrame:
    """Events as sensor readings; a third of the hottest ones leaves the plausible range."""
    k = payload_key()
    return t.events.select(
        F.col("user_id").alias("machine_id"),
        F.col("ts").alias("reading_timestamp"),
        F.when(k != 3, F.col("value")).alias("temperature_c"),
        (k * 0.5).alias("vibration_mm_s"),
    )


def machines(t: Tables) -> DataFrame:
    return t.customer.select(
        F.col("c_custkey").alias("machine_id"),
        F.col("c_mktsegment").alias("machine_type"),
        F.concat(F.lit("Line "), (F.col("c_nationkey") % 3).cast("string")).alias("line"),
    )


def deliveries(t: Tables) -> DataFrame:
    """Line items as carrier deliveries; the shipment id repeats where the line number does."""
    promised = F.col("l_linenumber") % 5 + 1
    return t.lineitem.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("shipment_id"),
        (F.col("l_partkey") % 25).alias("warehouse_id"),
        F.col("l_suppkey").alias("carrier_id"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("ship_date"),
        promised.cast("string").alias("promised_delivery_days"),
        (promised + F.col("l_partkey") % 4 - 1).cast("string").alias("actual_delivery_days"),
        F.col("l_quantity").alias("weight_kg"),
        ((F.col("l_returnflag") == "R") & (F.col("l_partkey") % 5 == 0)).alias("damaged_on_arrival"),
        F.col("l_partkey").alias("_part"),
        F.col("l_extendedprice").alias("_price"),
    )


def warehouses(t: Tables) -> DataFrame:
    return t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").cast("bigint").alias("warehouse_id"), F.col("r_name").alias("region")
    )


def carriers(t: Tables) -> DataFrame:
    return t.supplier.select(F.col("s_suppkey").alias("carrier_id"), F.col("s_name").alias("carrier_name"))


def subscribers(t: Tables) -> DataFrame:
    key = F.col("c_custkey")
    return t.customer.select(
        key.alias("customer_id"),
        (key % 63 + 18).alias("age"),
        F.col("c_mktsegment").alias("plan"),
        F.when(F.col("c_nationkey") % 3 == 0, "Month-to-month")
        .when(F.col("c_nationkey") % 3 == 1, "1 Year")
        .otherwise("2 Year")
        .alias("contract_type"),
        (key % 72 + 1).alias("tenure_months"),
        F.abs("c_acctbal").cast("decimal(10,2)").alias("monthly_charge"),
        (key % 7).alias("support_tickets_90d"),
        (key % 5 > 1).alias("autopay_enabled"),
        ((F.col("c_nationkey") % 3 == 0) & (key % 7 >= 3) | (key % 11 == 0)).alias("churned"),
    )


def usage(t: Tables) -> DataFrame:
    """Orders as usage records; customers without orders have none."""
    return t.orders.select(
        F.col("o_custkey").alias("customer_id"),
        (F.col("o_orderkey") % 17).alias("data_gb"),
        (F.col("o_orderkey") % 401).alias("voice_minutes"),
        (F.col("o_orderkey") % 97).alias("sms_count"),
    )


def visits(t: Tables) -> DataFrame:
    """Orders as patient visits: missing departments and patients, impossible ages, repeated visits."""
    key = F.col("o_orderkey")
    return t.orders.select(
        F.when(key % 101 != 0, F.concat(F.lit("P"), F.col("o_custkey").cast("string"))).alias("patient_id"),
        F.date_add(F.trunc("o_orderdate", "MM"), F.dayofmonth("o_orderdate") % 5).alias("visit_date"),
        F.when(key % 13 != 0, F.col("o_orderpriority")).alias("department"),
        (key * 31 % 100 - 3).cast("int").alias("age"),
        F.concat(F.lit("C"), (key % 6).cast("string")).alias("diagnosis_code"),
    )


CTES = {
    "bank": """
        SELECT CASE WHEN k <> 7 THEN cast(event_id AS varchar) END AS txn_id,
               'A' || cast(user_id AS varchar) AS account_id,
               CASE WHEN NOT (event_type = 'error' AND k % 10 = 0) THEN value END AS amount,
               CASE WHEN k % 20 = 0 THEN 'XYZ' WHEN k % 20 = 1 THEN NULL WHEN k % 20 <= 6 THEN 'EUR'
                    WHEN k % 20 <= 9 THEN 'GBP' WHEN k % 20 <= 11 THEN 'INR' ELSE 'USD' END AS currency,
               ts AS txn_ts, upper(event_type) AS channel
        FROM (SELECT *, cast(json_extract_string(props, '$.k') AS integer) AS k FROM events)""",
    "bank_valid": """
        SELECT *, round(cast(amount AS decimal(18,2)) * CASE currency WHEN 'EUR' THEN 1.080 WHEN 'GBP' THEN 1.270
               WHEN 'INR' THEN 0.012 ELSE 1.000 END, 2) AS amount_usd
        FROM bank WHERE txn_id IS NOT NULL AND amount IS NOT NULL AND currency IN ('USD', 'EUR', 'GBP', 'INR')""",
    "retail": """
        SELECT cast(l_orderkey AS varchar) || '-' || cast(l_linenumber AS varchar) AS order_id,
               cast(o_orderdate AS date) AS order_date, c_custkey AS customer_id,
               trim(CASE WHEN c_custkey % 50 = 0 THEN '  ' ELSE '  ' || c_name END) AS customer_name,
               CASE r_name WHEN 'AFRICA' THEN 'Africa' WHEN 'AMERICA' THEN 'America' WHEN 'ASIA' THEN 'Asia'
                    WHEN 'EUROPE' THEN 'Europe' ELSE 'Middle East' END AS region,
               p_partkey AS product_id, p_name AS product_name, p_type AS category, l_quantity AS quantity,
               p_retailprice AS unit_price, l_discount AS discount, l_extendedprice AS profit,
               l_shipdate AS _ingested_at,
               CASE WHEN l_linenumber = 7 THEN -1 ELSE 1 END AS _side,
               cast(l_quantity AS decimal(10,0)) * cast(p_retailprice AS decimal(12,2))
                 * (1 - cast(l_discount AS decimal(4,2))) AS sales
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
        JOIN part ON l_partkey = p_partkey""",
    "retail_silver": """
        SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY _ingested_at DESC,
               product_id DESC, quantity DESC, profit DESC, discount DESC, unit_price DESC) AS _rn
        FROM retail WHERE customer_name <> '') WHERE _rn = 1""",
    "staging": f"""
        SELECT 'SHP' || {padded('l_orderkey * 10 + l_linenumber', 12)} AS shipment_id,
               o_custkey, l_suppkey, l_partkey,
               CASE WHEN l_partkey % 97 = 0 THEN 'CAR99'
                    ELSE 'CAR' || {padded('l_partkey % 12 + 1', 2)} END AS carrier_code,
               strftime(o_orderdate, '%Y-%m-%d') AS ship_date,
               CASE WHEN NOT (l_partkey % 19 = 1 OR o_orderstatus = 'O')
                    THEN strftime(cast(o_orderdate AS date) + cast(1 + l_partkey % 6 AS integer), '%Y-%m-%d')
                    END AS delivery_date,
               cast(cast(l_quantity AS decimal(8,2)) AS varchar) AS weight_kg,
               cast(cast(l_extendedprice AS decimal(12,2)) AS varchar) AS freight_amount,
               CASE WHEN l_partkey % 19 = 1 THEN 'Cancelled' WHEN o_orderstatus = 'O' THEN 'In Transit'
                    WHEN l_returnflag = 'R' THEN 'Returned' ELSE 'Delivered' END AS status,
               CASE WHEN l_linestatus = 'F' THEN 'Y' ELSE 'N' END AS is_express,
               'HUB' || {padded('l_suppkey', 7)} AS hub_code,
               'CUST' || {padded('o_custkey', 9)} AS customer_id
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "hubs": f"""
        SELECT s_suppkey AS hub_key, 'HUB' || {padded('s_suppkey', 7)} AS hub_code,
               n_name AS city, r_name AS region
        FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "carrier_dim": f"""
        SELECT -1 AS carrier_key, 'UNK' AS carrier_code, 'Unknown carrier' AS carrier_name, 'Unknown' AS service_level
        UNION ALL
        SELECT n, 'CAR' || {padded('n', 2)}, 'Carrier ' || cast(n AS varchar),
               CASE n % 3 WHEN 0 THEN 'Express' WHEN 1 THEN 'Standard' ELSE 'Economy' END
        FROM (SELECT DISTINCT p_partkey % 12 + 1 AS n FROM part)""",
    "fact": """
        SELECT cast(substr(shipment_id, 4) AS bigint) AS shipment_key, shipment_id, o_custkey AS customer_key,
               l_suppkey AS hub_key, coalesce(carrier_key, -1) AS carrier_key,
               cast(replace(ship_date, '-', '') AS bigint) AS ship_date_key,
               cast(replace(delivery_date, '-', '') AS bigint) AS delivery_date_key,
               cast(weight_kg AS decimal(8,2)) AS weight_kg, cast(freight_amount AS decimal(12,2)) AS freight_amount,
               status, is_express = 'Y' AS is_express,
               date_diff('day', cast(ship_date AS date), cast(delivery_date AS date)) AS transit_days
        FROM (SELECT *, row_number() OVER (PARTITION BY shipment_id ORDER BY ship_date, customer_id, hub_code,
              carrier_code, delivery_date NULLS FIRST, weight_kg, freight_amount, status, is_express) AS _rn
              FROM staging) AS s
        LEFT JOIN carrier_dim AS c ON c.carrier_code = s.carrier_code
        WHERE _rn = 1""",
    "hospital_departments": """
        SELECT row_number() OVER (ORDER BY n_nationkey) AS department_key, n_nationkey, n_name AS department_name,
               n_nationkey % 7 + 5 AS beds FROM nation""",
    "hospital_patients": """
        SELECT row_number() OVER (ORDER BY c_custkey) AS patient_key, c_custkey, c_mktsegment AS insurance_type,
               CASE WHEN years < 18 THEN '0-17' WHEN years < 40 THEN '18-39' WHEN years < 65 THEN '40-64'
                    ELSE '65+' END AS age_band, birth_date
        FROM (SELECT *, 2026 - year(birth_date) AS years
              FROM (SELECT *, date '2026-01-01' - cast(365 + c_custkey * 37 % 32000 AS integer) AS birth_date
                    FROM customer))""",
    "hospital_fact": """
        SELECT o_orderkey AS admission_key, patient_key, s_suppkey + 1 AS doctor_key, department_key,
               cast(o_orderdate AS date) AS admit_date,
               cast(o_orderdate AS date) + cast(o_orderkey * 7 % 10 AS integer) AS discharge_date,
               o_orderkey * 7 % 10 AS length_of_stay, o_orderstatus AS diagnosis_group,
               o_orderpriority = '1-URGENT' AS is_emergency, cast(o_totalprice AS decimal(14,2)) AS total_charges
        FROM orders JOIN hospital_patients ON o_custkey = c_custkey
        JOIN supplier ON s_suppkey = o_orderkey % (SELECT count(*) FROM supplier)
        JOIN hospital_departments ON n_nationkey = s_nationkey""",
    "stays": """
        SELECT o_orderkey AS admission_id, o_custkey AS patient_id, o_orderpriority AS ward,
               cast(o_orderdate AS date) AS admit_date,
               cast(o_orderdate AS date) + cast(o_orderkey * 7 % 9 + 1 AS integer) AS discharge_date,
               o_orderkey * 7 % 9 + 1 AS length_of_stay_days FROM orders""",
    "ward_patients": """
        SELECT c_custkey AS patient_id, c_custkey * 13 % 96 AS age, c_acctbal < 2000 AS has_chronic_condition
        FROM customer""",
    "readmitted": """
        SELECT a.*, EXISTS (SELECT 1 FROM stays b WHERE b.patient_id = a.patient_id
               AND b.admit_date > a.discharge_date AND b.admit_date <= a.discharge_date + 30) AS flag
        FROM stays a""",
    "readings": """
        SELECT user_id AS machine_id, ts AS reading_timestamp,
               CASE WHEN k <> 3 THEN value END AS temperature_c, k * 0.5::double AS vibration_mm_s
        FROM (SELECT *, cast(json_extract_string(props, '$.k') AS integer) AS k FROM events)""",
    "plausible": """
        SELECT * FROM readings WHERE temperature_c BETWEEN -20 AND 150 AND vibration_mm_s BETWEEN 0 AND 50""",
    "scored": """
        SELECT *, (temperature_c - avg(temperature_c) OVER m) / nullif(stddev_samp(temperature_c) OVER m, 0) AS temp_z,
               (vibration_mm_s - avg(vibration_mm_s) OVER m) / nullif(stddev_samp(vibration_mm_s) OVER m, 0) AS vibe_z
        FROM plausible WINDOW m AS (PARTITION BY machine_id)""",
    "flags": """
        SELECT machine_id, c_mktsegment AS machine_type, 'Line ' || cast(c_nationkey % 3 AS varchar) AS line,
               reading_timestamp, temperature_c, vibration_mm_s, temp_z, vibe_z
        FROM scored JOIN customer ON c_custkey = machine_id WHERE temp_z > 2 OR vibe_z > 2""",
    "outcome": """
        SELECT * FROM (SELECT cast(l_orderkey AS varchar) || '-' || cast(l_linenumber AS varchar) AS shipment_id,
               l_partkey % 25 AS warehouse_id, l_suppkey AS carrier_id, cast(l_shipdate AS date) AS ship_date,
               l_linenumber % 5 + 1 AS promised, l_partkey % 4 - 1 AS delay_days, l_quantity AS weight_kg,
               l_returnflag = 'R' AND l_partkey % 5 = 0 AS damaged,
               row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                  ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS _rn
               FROM lineitem) WHERE _rn = 1""",
    "visits": """
        SELECT CASE WHEN o_orderkey % 101 <> 0 THEN 'P' || cast(o_custkey AS varchar) END AS patient_id,
               cast(date_trunc('month', o_orderdate) AS date) + cast(day(o_orderdate) % 5 AS integer) AS visit_date,
               CASE WHEN o_orderkey % 13 <> 0 THEN o_orderpriority END AS department,
               o_orderkey * 31 % 100 - 3 AS age, 'C' || cast(o_orderkey % 6 AS varchar) AS diagnosis_code
        FROM orders""",
    "visits_clean": """
        SELECT patient_id, visit_date, coalesce(department, 'UNKNOWN') AS department,
               CASE WHEN age >= 0 THEN age END AS age, diagnosis_code
        FROM (SELECT *, row_number() OVER (PARTITION BY patient_id, visit_date, department
              ORDER BY age, diagnosis_code) AS _rn FROM visits WHERE patient_id IS NOT NULL) WHERE _rn = 1""",
}
