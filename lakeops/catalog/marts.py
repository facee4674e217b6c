"""Business marts over the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lakeops.catalog import domains as d
from lakeops.catalog.base import Tables, half_up, mean_cents, query
from lakeops.catalog.domains import with_
from lakeops.operators.aggregates import pivot_counts
from lakeops.operators.clean import distinct_rows
from lakeops.operators.quality import gate_metrics, quarantine
from lakeops.plans import banking, churn, hospital, logistics, retail, shipments, telemetry, visits
from lakeops.session import scratch, shuffles_dropped, stored
from lakeops.sources.files import load_once
from lakeops.sources.readers import calendar, day_bounds
from lakeops.sources.sinks import drop_table, key_slices

# --- retail ---------------------------------------------------------------------------------------------


def _silver(t: Tables):
    return retail.clean_sales(d.retail_bronze(t), d.RETAIL_TIES)


@query(
    "retail_silver",
    with_(
        "retail retail_silver",
        """SELECT order_id, order_date, customer_id, customer_name, region, product_id, product_name, category,
        quantity, unit_price, discount, cast(sales AS double) AS sales, profit FROM retail_silver""",
    ),
)
def retail_silver(t: Tables):
    return retail.fact_sales(_silver(t))


@query(
    "monthly_region_category",
    with_(
        "retail retail_silver",
        """SELECT year(order_date) AS order_year, month(order_date) AS order_month, region, category,
        cast(round(sum(sales), 2) AS double) AS total_sales,
        cast(sum(cast(profit AS decimal(12,2))) AS double) AS total_profit,
        count(DISTINCT order_id) AS order_count FROM retail_silver GROUP BY ALL""",
    ),
)
def monthly_region_category(t: Tables):
    return retail.monthly_region_category(_silver(t))


@query(
    "retail_layers",
    with_(
        "retail",
        """, kept AS (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY product_id DESC, quantity DESC, unit_price DESC,
        discount DESC, profit DESC) AS _rn FROM retail WHERE customer_name <> '')
        SELECT order_year, order_month, region, category, cast(round(sum(sales), 2) AS double) AS total_sales,
        cast(sum(cast(profit AS decimal(12,2))) AS double) AS total_profit, count(DISTINCT order_id) AS order_count
        FROM (SELECT *, year(order_date) AS order_year, month(order_date) AS order_month FROM kept WHERE _rn = 1) GROUP BY ALL""",
    ),
)
def retail_layers(t: Tables):
    """Raw CSV through bronze, silver and gold; the monthly gold table."""
    source = scratch(t.spark, "raw")
    for held in key_slices(t.lineitem, "l_orderkey", retail.SLICE_ROWS):
        raw = d.retail_bronze(t, t.lineitem.where(held)).drop("_ingested_at").withColumn("order_id", F.concat(F.lit("R"), "order_id"))
        raw = raw.withColumnsRenamed({"order_id": "OrderID", "unit_price": "UnitPrice"})
        with shuffles_dropped(t.spark):
            raw.write.mode("append").option("header", True).option("compression", "gzip").csv(source)
    schema = retail.RAW.replace("CustomerID string", "CustomerID bigint").replace("ProductID string", "ProductID bigint")
    return retail.run(t.spark, source, scratch(t.spark, "retail"), schema)["monthly"]


@query(
    "customer_lifetime",
    with_(
        "retail retail_silver",
        """SELECT customer_id, customer_name, cast(round(sum(sales), 2) AS double) AS lifetime_sales,
        cast(sum(cast(profit AS decimal(12,2))) AS double) AS lifetime_profit,
        count(DISTINCT order_id) AS total_orders FROM retail_silver GROUP BY ALL""",
    ),
)
def customer_lifetime(t: Tables):
    return retail.customer_lifetime(_silver(t))


def _star(t: Tables):
    sales = t.lineitem.select(
        F.col("l_suppkey").alias("store_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        (F.col("l_discount") * 100).cast("int").alias("discount_pct"),
    )
    products = t.part.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_retailprice").alias("unit_price"),
        (F.col("p_retailprice").cast("decimal(10,2)") / 2).alias("unit_cost"),
        F.col("p_type").alias("category"),
    )
    return retail.star_sales(sales, products)


STAR = """
    SELECT l_suppkey AS store_id, l_partkey AS product_id, cast(l_quantity AS bigint) AS quantity, p_type AS category,
           revenue, revenue - cast(l_quantity AS decimal(10,0)) * cost AS margin
    FROM (SELECT *, round(cast(l_quantity AS decimal(10,0)) * cast(p_retailprice AS decimal(10,2))
          * cast(1 - cast(cast(l_discount * 100 AS bigint) AS decimal(5,2)) * 0.01 AS decimal(8,4)), 2) AS revenue,
          cast((cast(p_retailprice * 100 AS bigint) + 1) // 2 AS decimal(12,2)) * 0.01 AS cost
          FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def _stores(t: Tables):
    return t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("store_id"), F.col("s_name").alias("store_name"), F.col("n_name").alias("region")
    )


@query(
    "star_sales_margin",
    f"""SELECT category, sum(quantity)::bigint AS units, cast(sum(revenue) AS double) AS revenue,
    cast(sum(margin) AS double) AS margin FROM ({STAR}) GROUP BY category""",
)
def star_sales_margin(t: Tables):
    return (
        _star(t)
        .groupBy("category")
        .agg(
            F.sum("quantity").alias("units"),
            F.sum("gross_revenue").alias("revenue"),
            F.sum("gross_margin").alias("margin"),
        )
    )


@query(
    "sales_performance",
    f"""SELECT store_id, s_name AS store_name, n_name AS region, category, sum(quantity)::bigint AS units_sold,
    cast(sum(revenue) AS double) AS total_revenue, cast(sum(margin) AS double) AS total_margin
    FROM ({STAR}) JOIN supplier ON s_suppkey = store_id JOIN nation ON n_nationkey = s_nationkey GROUP BY ALL""",
)
def sales_performance(t: Tables):
    return retail.sales_performance(_star(t), _stores(t))


def _inventory(t: Tables):
    return t.lineitem.select(
        F.col("l_suppkey").alias("store_id"),
        F.col("l_partkey").alias("product_id"),
        F.to_date("l_shipdate").alias("snapshot_date"),
        (F.col("l_quantity") - 5).cast("int").alias("quantity_on_hand"),
        (F.col("l_partkey") % 31 + 10).alias("reorder_point"),
    )


INVENTORY = """
    SELECT l_suppkey AS store_id, l_partkey AS product_id, cast(l_shipdate AS date) AS snapshot_date,
           cast(l_quantity AS bigint) - 5 AS quantity_on_hand, l_partkey % 31 + 10 AS reorder_point FROM lineitem"""


@query(
    "stockout_risk",
    f"""SELECT store_id, s_name AS store_name, product_id, p_name AS product_name, p_type AS category,
    snapshot_date, quantity_on_hand, reorder_point FROM ({INVENTORY})
    JOIN part ON p_partkey = product_id JOIN supplier ON s_suppkey = store_id
    WHERE quantity_on_hand >= 0 AND quantity_on_hand < reorder_point""",
)
def stockout_risk(t: Tables):
    passed, _ = retail.clean_inventory(_inventory(t))
    products = t.part.select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"), F.col("p_type").alias("category")
    )
    return retail.stockout_risk(passed, products, _stores(t))


@query(
    "inventory_quarantine",
    f"""SELECT *, 'negative quantity_on_hand' AS _dq_reason FROM ({INVENTORY}) WHERE quantity_on_hand < 0""",
)
def inventory_quarantine(t: Tables):
    return retail.clean_inventory(_inventory(t))[1]


# --- bank transactions ----------------------------------------------------------------------------------

REASONS = """concat_ws(',', CASE WHEN txn_id IS NULL THEN 'txn_id' END, CASE WHEN amount IS NULL THEN 'amount' END,
    CASE WHEN currency IS NULL OR currency NOT IN ('USD', 'EUR', 'GBP', 'INR') THEN 'currency' END)"""


@query(
    "event_quarantine",
    with_("bank", f"SELECT * FROM (SELECT *, {REASONS} AS _dq_reason FROM bank) WHERE _dq_reason <> ''"),
)
def event_quarantine(t: Tables):
    return quarantine(d.bank(t), banking.rules())[1]


@query("event_valid", with_("bank", f"SELECT * FROM bank WHERE {REASONS} = ''"))
def event_valid(t: Tables):
    return quarantine(d.bank(t), banking.rules())[0]


@query(
    "quality_gate_share",
    with_(
        "bank",
        f"""SELECT n AS batch_rows, n - bad AS valid_rows, bad AS rejected_rows,
        cast(bad AS double) / n AS rejected_share, bad > 0.10 * n AS gate_fails
        FROM (SELECT count(*) AS n, count(*) FILTER ({REASONS} <> '') AS bad FROM bank)""",
    ),
)
def quality_gate_share(t: Tables):
    metrics = gate_metrics(d.bank(t), banking.rules())
    return metrics.withColumn("gate_fails", F.col("rejected_rows") > F.col("batch_rows") * 0.10)


def _bank_silver(t: Tables):
    valid, _ = quarantine(d.bank(t), banking.rules())
    return banking.conform(valid, ["txn_ts", "account_id", "amount"])


@query(
    "currency_normalised",
    with_(
        "bank bank_valid",
        "SELECT txn_id, account_id, amount, currency, txn_ts, channel, cast(amount_usd AS double) AS amount_usd "
        "FROM bank_valid",
    ),
)
def currency_normalised(t: Tables):
    return _bank_silver(t)


@query(
    "event_daily_channel",
    with_(
        "bank bank_valid",
        f"""SELECT channel, txn_date, n AS txn_count, cast(total AS double) AS total_amount_usd,
        {mean_cents("total", "n")} AS avg_amount_usd, distinct_accounts
        FROM (SELECT channel, cast(txn_ts AS date) AS txn_date, count(*) AS n, sum(amount_usd) AS total,
              count(DISTINCT account_id) AS distinct_accounts FROM bank_valid GROUP BY ALL)""",
    ),
)
def event_daily_channel(t: Tables):
    return banking.daily_channel(_bank_silver(t))


MONTHLY = f"""SELECT txn_month, channel, n AS txn_count, cast(total AS double) AS total_amount,
    {mean_cents("total", "n")} AS avg_amount
    FROM (SELECT strftime(txn_ts, '%Y-%m') AS txn_month, channel, count(*) AS n,
          sum(cast(amount AS decimal(18,2))) AS total FROM bank WHERE amount IS NOT NULL GROUP BY ALL)"""


@query("monthly_summary", with_("bank", MONTHLY))
def monthly_summary(t: Tables):
    return banking.monthly_summary(d.bank(t), "txn_ts", "channel")


@query(
    "channel_rollup",
    with_("bank", "SELECT channel, cast(sum(cast(amount AS decimal(18,2))) AS double) AS group_total "
                  "FROM bank WHERE amount IS NOT NULL GROUP BY channel"),
)
def channel_rollup(t: Tables):
    return banking.group_rollup(banking.monthly_summary(d.bank(t), "txn_ts", "channel"), "channel")


# --- patient visits -------------------------------------------------------------------------------------


@query("visits_clean", with_("visits visits_clean", "SELECT * FROM visits_clean"))
def visits_clean(t: Tables):
    return visits.clean_visits(d.visits(t))


@query(
    "visits_ranked",
    with_(
        "visits visits_clean",
        """SELECT *, row_number() OVER p AS visit_number,
        date_diff('day', lag(visit_date) OVER p, visit_date) AS days_since_prev,
        dense_rank() OVER (PARTITION BY department ORDER BY age DESC NULLS LAST) AS dept_rank_by_age
        FROM visits_clean WINDOW p AS (PARTITION BY patient_id ORDER BY visit_date, department, diagnosis_code)""",
    ),
)
def visits_ranked(t: Tables):
    # A visit is one per patient, day and (raw) department, so the diagnosis only orders merged departments.
    return visits.ranked_visits(visits.clean_visits(d.visits(t)))


@query(
    "visits_by_department_diagnosis",
    with_(
        "visits visits_clean",
        "SELECT department, "
        + ", ".join(f"count(*) FILTER (diagnosis_code = 'C{i}') AS C{i}" for i in range(6))
        + " FROM visits_clean GROUP BY department",
    ),
)
def visits_by_department_diagnosis(t: Tables):
    clean = visits.clean_visits(d.visits(t))
    return pivot_counts(clean, ["department"], "diagnosis_code", [f"C{i}" for i in range(6)])


@query(
    "visits_department_counts",
    with_("visits visits_clean", "SELECT department, count(*) AS visit_count FROM visits_clean GROUP BY department"),
)
def visits_department_counts(t: Tables):
    return visits.department_counts(visits.clean_visits(d.visits(t)))


@query("visits_high_risk", with_("visits visits_clean", "SELECT * FROM visits_clean WHERE age >= 65"))
def visits_high_risk(t: Tables):
    return visits.high_risk(visits.clean_visits(d.visits(t)))


@query(
    "visits_enriched",
    with_(
        "visits visits_clean",
        """SELECT v.*, d.urgent FROM visits_clean v LEFT JOIN (SELECT o_orderpriority AS department,
        min(o_orderpriority) < '3' AS urgent FROM orders WHERE o_orderpriority <> '5-LOW' GROUP BY 1) d USING (department)""",
    ),
)
def visits_enriched(t: Tables):
    kinds = (
        t.orders.filter(F.col("o_orderpriority") != "5-LOW")
        .groupBy(F.col("o_orderpriority").alias("department"))
        .agg((F.min("o_orderpriority") < "3").alias("urgent"))
    )
    return visits.enrich(visits.clean_visits(d.visits(t)), kinds)


def _insurance(t: Tables):
    """Customers as nested insurance records; some have no insurer, some no procedures."""
    key = F.col("c_custkey")
    words = F.slice(F.array(F.lit("MRI"), F.lit("XRAY"), F.lit("CONSULT")), F.lit(1), (key % 4).cast("int"))
    insurer = F.struct(F.col("c_name").alias("policy_no"), F.col("c_mktsegment").alias("provider"))
    return t.customer.select(
        F.concat(F.lit("P"), key.cast("string")).alias("patient_id"),
        F.when(key % 7 != 0, insurer).alias("insurance"),
        words.alias("procedures"),
    )


@query(
    "insurance_rows",
    """SELECT 'P' || cast(c_custkey AS varchar) AS patient_id,
    CASE WHEN c_custkey % 7 <> 0 THEN c_mktsegment END AS insurance_provider,
    CASE WHEN c_custkey % 7 <> 0 THEN c_name END AS policy_no, p.procedure
    FROM customer LEFT JOIN (VALUES (1, 'MRI'), (2, 'XRAY'), (3, 'CONSULT')) AS p(i, procedure) ON p.i <= c_custkey % 4""",
)
def insurance_rows(t: Tables):
    return visits.insurance_rows(_insurance(t))


@query(
    "uninsured_visits",
    with_(
        "visits visits_clean",
        "SELECT * FROM visits_clean WHERE patient_id NOT IN (SELECT 'P' || cast(c_custkey AS varchar) FROM customer "
        "WHERE c_acctbal >= 0)",
    ),
)
def uninsured_visits(t: Tables):
    """Visits of patients without a record: customers in debt have none."""
    debtors = t.customer.filter("c_acctbal < 0").select(F.concat(F.lit("P"), F.col("c_custkey").cast("string")).alias("patient_id"))
    records = visits.insurance_rows(_insurance(t).join(debtors, "patient_id", "left_anti"))
    return visits.uninsured(visits.clean_visits(d.visits(t)), records)


# --- daily bank run -------------------------------------------------------------------------------------


@query(
    "bank_daily_rerun",
    with_(
        "bank",
        """, landed AS (SELECT *, CASE WHEN day(txn_ts) <= 15 THEN date '2026-01-01' ELSE date '2026-01-02' END AS batch FROM bank
            WHERE day(txn_ts) > 15 OR (day(txn_ts) > 3 AND currency IS NOT NULL)),
        marked AS (SELECT *, txn_id IS NOT NULL AND amount IS NOT NULL AND coalesce(currency IN ('USD', 'EUR', 'GBP', 'INR'), false) AS ok,
            round(cast(amount AS decimal(18,2)) * CASE currency WHEN 'EUR' THEN 1.080 WHEN 'GBP' THEN 1.270 WHEN 'INR' THEN 0.012
            ELSE 1.000 END, 2) AS usd FROM landed)
        SELECT 'quarantine' AS layer, batch AS day, NULL::varchar AS channel, count(*) AS n, NULL::double AS total FROM marked WHERE NOT ok GROUP BY batch
        UNION ALL SELECT 'silver', batch, NULL, count(*), cast(sum(usd) AS double) FROM marked WHERE ok GROUP BY batch
        UNION ALL SELECT 'gold', cast(txn_ts AS date), channel, count(*), cast(sum(usd) AS double) FROM marked WHERE ok GROUP BY 2, 3""",
    ),
)
def bank_daily_rerun(t: Tables):
    """Two dates landed, then the first one again from a corrected file: fewer days, fewer rejected rows."""
    root, landing, control = scratch(t.spark, "bank"), scratch(t.spark, "landing"), f"lakeops_{uuid.uuid4().hex}"
    rows = d.bank(t).select(*banking.SCHEMA.fieldNames()).withColumn("txn_ts", F.date_format("txn_ts", "yyyy-MM-dd HH:mm:ss"))
    early = F.dayofmonth("txn_ts") <= 15
    files = {
        "first": rows.where(early), "second": rows.where(~early),
        "corrected": rows.where(early & (F.dayofmonth("txn_ts") > 3) & F.col("currency").isNotNull()),
    }
    for name, part in files.items():
        part.write.option("header", True).csv(f"{landing}/{name}")
    for name, date, again in (("first", "2026-01-01", False), ("second", "2026-01-02", False), ("corrected", "2026-01-01", True)):
        banking.run_day(t.spark, f"{landing}/{name}", root, control, date, max_share=1.0, again=again)
    drop_table(t.spark, control)
    none = F.lit(None).cast("string").alias("channel")
    held = t.spark.read.parquet(f"{root}/quarantine").groupBy(F.lit("quarantine").alias("layer"), F.col("_batch_date").alias("day"), none).agg(
        F.count(F.lit(1)).alias("n"), F.lit(None).cast("decimal(38,2)").alias("total")
    )
    silver = t.spark.read.parquet(f"{root}/silver").groupBy(F.lit("silver").alias("layer"), F.col("_batch_date").alias("day"), none).agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount_usd").cast("decimal(38,2)").alias("total")
    )
    gold = t.spark.read.parquet(f"{root}/gold").select(
        F.lit("gold").alias("layer"), F.col("txn_date").alias("day"), "channel", F.col("txn_count").alias("n"), F.col("total_amount_usd").cast("decimal(38,2)").alias("total")
    )
    return held.unionByName(silver).unionByName(gold)


# --- shipment warehouse ---------------------------------------------------------------------------------


def _carrier_dim(t: Tables):
    return shipments.carrier_dim(d.carrier_numbers(t))


def _fact(t: Tables):
    return shipments.fact_shipments(d.staging(t), d.segments(t), d.hubs(t), _carrier_dim(t))


def star(t: Tables):
    """The fact read from the star that :func:`shipments.write_star` loads, once for each version of its inputs."""
    inputs = [t.lineitem, t.orders, t.customer, t.supplier, t.nation, t.part]
    return t.spark.read.parquet(load_once(t.spark, "star", inputs, lambda path: shipments.write_star(_fact(t), path)))


def _dates(t: Tables):
    return calendar(day_bounds(t.orders, "o_orderdate"), "first_day", "last_day")


FACT = "staging carrier_dim fact"


@query(
    "shipment_fact",
    with_(FACT, "SELECT * REPLACE (cast(weight_kg AS double) AS weight_kg, cast(freight_amount AS double) AS "
                "freight_amount, cast(carrier_key AS bigint) AS carrier_key) FROM fact"),
)
def shipment_fact(t: Tables):
    return _fact(t)


@query(
    "carrier_dimension",
    with_("carrier_dim", "SELECT cast(carrier_key AS bigint) AS carrier_key, carrier_code, carrier_name, service_level "
                         "FROM carrier_dim"),
)
def carrier_dimension(t: Tables):
    return _carrier_dim(t)


@query("hub_dimension", with_("hubs", "SELECT * FROM hubs"))
def hub_dimension(t: Tables):
    return d.hubs(t)


@query(
    "customer_dimension",
    f"""SELECT c_custkey AS customer_key, 'CUST' || {d.padded("c_custkey", 9)} AS customer_id, c_mktsegment AS segment FROM customer
    UNION ALL SELECT -1, 'UNK', 'Unknown'""",
)
def customer_dimension(t: Tables):
    """Customers by segment, and the member that facts without a known customer point to."""
    unknown = t.spark.sql("SELECT -1L AS customer_key, 'UNK' AS customer_id, 'Unknown' AS segment")
    return d.segments(t).unionByName(unknown)


@query(
    "freight_by_region_month",
    with_(
        FACT + " hubs",
        """SELECT region, ship_date_key // 10000 AS year_num, ship_date_key // 100 % 100 AS month_num,
        cast(sum(freight_amount) AS double) AS freight FROM fact JOIN hubs USING (hub_key)
        WHERE ship_date_key BETWEEN 19960101 AND 19961231 GROUP BY ALL""",
    ),
)
def freight_by_region_month(t: Tables):
    return shipments.freight_by_region_month(star(t), d.hubs(t), _dates(t), 1996)


@query(
    "freight_by_segment_bucketed",
    with_(FACT, """SELECT c_mktsegment AS segment, count(*) AS n, cast(sum(freight_amount) AS double) AS freight
        FROM fact JOIN customer ON c_custkey = customer_key GROUP BY 1"""),
)
def freight_by_segment_bucketed(t: Tables):
    """Fact and customers written in buckets of one key and joined as they lie."""
    rows = star(t)
    fact, customers = shipments.write_bucketed_star(rows, d.segments(t), scratch(t.spark, "bucketed"), shipments.bucket_count(rows))
    return shipments.freight_by_segment(fact, customers)


@query(
    "freight_by_region_month_raw",
    with_(
        "staging hubs",
        """SELECT region, left(ship_date, 7) AS ship_month,
        cast(sum(cast(freight_amount AS decimal(12,2))) AS double) AS freight
        FROM staging JOIN hubs USING (hub_code) WHERE year(cast(ship_date AS date)) = 1996 GROUP BY ALL""",
    ),
)
def freight_by_region_month_raw(t: Tables):
    return shipments.freight_by_region_month_raw(d.staging(t), d.hubs(t), 1996)


@query(
    "top_customers_segment",
    with_(
        FACT,
        f"""SELECT customer_id, cast(freight AS double) AS freight FROM (SELECT
        'CUST' || {d.padded("customer_key", 9)} AS customer_id, sum(freight_amount) AS freight
        FROM fact JOIN customer ON c_custkey = customer_key WHERE c_mktsegment = 'BUILDING' GROUP BY 1)
        ORDER BY freight DESC, customer_id LIMIT 20""",
    ),
)
def top_customers_segment(t: Tables):
    return shipments.top_customers(star(t), d.segments(t), "BUILDING", 20)


@query(
    "avg_transit_by_service",
    with_(
        FACT,
        """SELECT service_level, cast(sum(transit_days) AS double) / count(*) AS avg_transit_days
        FROM fact JOIN carrier_dim USING (carrier_key)
        WHERE status <> 'Cancelled' AND transit_days IS NOT NULL GROUP BY service_level""",
    ),
)
def avg_transit_by_service(t: Tables):
    return shipments.transit_by_service(star(t), _carrier_dim(t))


@query(
    "avg_transit_by_service_raw",
    with_(
        "staging carrier_dim",
        """SELECT service_level, cast(sum(days) AS double) / count(*) AS avg_transit_days
        FROM (SELECT service_level, date_diff('day', cast(ship_date AS date), cast(delivery_date AS date)) AS days
              FROM staging JOIN carrier_dim USING (carrier_code)
              WHERE status <> 'Cancelled' AND delivery_date IS NOT NULL) GROUP BY service_level""",
    ),
)
def avg_transit_by_service_raw(t: Tables):
    rows = d.staging(t).filter((F.col("status") != "Cancelled") & F.col("delivery_date").isNotNull())
    days = F.datediff(F.to_date("delivery_date"), F.to_date("ship_date"))
    levels = _carrier_dim(t).select("carrier_code", "service_level")
    return rows.join(levels, "carrier_code").groupBy("service_level").agg(F.avg(days).alias("avg_transit_days"))


SLA = """CASE WHEN transit_days IS NULL THEN 'Open' WHEN is_express AND transit_days > 2 THEN 'Breach'
    WHEN NOT is_express AND transit_days > 4 THEN 'Breach' ELSE 'Met' END"""


@query("sla_view", with_(FACT, f"SELECT shipment_key, status, is_express, transit_days, {SLA} AS sla_result FROM fact"))
def sla_view(t: Tables):
    return shipments.sla_view(star(t))


@query(
    "sla_verdict_counts",
    with_(FACT, f"SELECT {SLA} AS sla_result, is_express, count(*) AS n FROM fact GROUP BY ALL"),
)
def sla_verdict_counts(t: Tables):
    return shipments.sla_view(star(t)).groupBy("sla_result", "is_express").agg(F.count(F.lit(1)).alias("n"))


@query(
    "incident_drill",
    with_(
        FACT,
        """SELECT status, count(*) AS n, cast(sum(freight_amount) AS double) AS freight,
        cast(sum(CASE WHEN status <> 'Returned' THEN freight_amount ELSE 0 END) AS double) AS freight_while_damaged
        FROM fact GROUP BY status""",
    ),
)
def incident_drill(t: Tables):
    """Backup, damage to all returned shipments, read as of the backup, repair; totals damaged and repaired."""
    versions = scratch(t.spark, "drill")
    repaired = shipments.incident_drill(star(t).drop("ship_month"), versions, F.col("status") == "Returned", ["shipment_key"])
    damaged = t.spark.read.parquet(f"{versions}/version=1")
    broken = damaged.groupBy("status").agg(F.sum("freight_amount").alias("freight_while_damaged"))
    return repaired.groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.sum("freight_amount").alias("freight")).join(broken, "status")


# --- hospital star --------------------------------------------------------------------------------------


def _hospital(t: Tables, *wanted: str):
    """The fact with the keys of the wanted dimensions (all by default), and those dimensions."""
    wanted = wanted or ("patients", "doctors", "departments")
    departments = hospital.department_dim(d.departments(t)) if {"doctors", "departments"} & {*wanted} else None
    doctors = hospital.doctor_dim(d.doctors(t), departments) if "doctors" in wanted else None
    patients = hospital.patient_dim(d.patients(t)) if "patients" in wanted else None
    fact = hospital.fact_admissions(d.admissions(t), patients, doctors, departments)
    return fact, patients, doctors, departments


HOSPITAL = "hospital_departments hospital_patients hospital_fact"


@query("hospital_fact", with_(HOSPITAL, "SELECT * REPLACE (cast(total_charges AS double) AS total_charges) FROM hospital_fact"))
def hospital_fact(t: Tables):
    return _hospital(t)[0]


@query(
    "hospital_load_log",
    """SELECT run_id, step, n AS rows_affected FROM (SELECT 1 AS k, 'dim_department' AS step, count(*) AS n FROM nation
    UNION ALL SELECT 2, 'dim_doctor', count(*) FROM supplier UNION ALL SELECT 3, 'dim_patient', count(*) FROM customer
    UNION ALL SELECT 4, 'fact_admission', count(*) FROM orders)
    CROSS JOIN LATERAL (SELECT unnest([k, k + 4])::bigint AS run_id)""",
)
def hospital_load_log(t: Tables):
    """The star loaded twice; its run log."""
    root = scratch(t.spark, "hospital")
    for _ in range(2):
        log = hospital.load_star(t.spark, root, d.departments(t), d.doctors(t), d.patients(t), d.admissions(t))
    return log.select("run_id", "step", "rows_affected")


@query("age_bands", with_("hospital_patients", "SELECT patient_key, age_band, birth_date FROM hospital_patients"))
def age_bands(t: Tables):
    return hospital.patient_dim(d.patients(t)).select("patient_key", "age_band", "birth_date")


@query(
    "dept_kpi",
    with_(
        HOSPITAL,
        f"""SELECT department_name, n AS admissions, cast(los AS double) / n AS alos, cast(revenue AS double) AS revenue,
        urgent * 100.0::double / n AS emergency_pct
        FROM (SELECT department_name, count(*) AS n, sum(length_of_stay) AS los, sum(total_charges) AS revenue,
              count(*) FILTER (is_emergency) AS urgent
              FROM hospital_fact JOIN hospital_departments USING (department_key) GROUP BY department_name)""",
    ),
)
def dept_kpi(t: Tables):
    fact, _, _, departments = _hospital(t, "departments")
    return hospital.department_kpis(fact, departments)


@query(
    "readmission_rate",
    with_(
        HOSPITAL,
        f"""SELECT department_name, n AS admissions, hits AS readmits_30d, hits * 100.0::double / n AS readmit_rate_pct
        FROM (SELECT department_name, count(*) AS n,
              count(*) FILTER (date_diff('day', prev, admit_date) BETWEEN 0 AND 30) AS hits
              FROM (SELECT *, lag(discharge_date) OVER (PARTITION BY patient_key ORDER BY admit_date, admission_key) AS prev
                    FROM hospital_fact) JOIN hospital_departments USING (department_key) GROUP BY department_name)""",
    ),
)
def readmission_rate(t: Tables):
    fact, _, _, departments = _hospital(t, "patients", "departments")
    order = ["admit_date", "admission_key"]
    fact = stored(fact.select("patient_key", "department_key", "admit_date", "discharge_date", "admission_key"))
    flagged = hospital.readmission_lag(fact, "patient_key", order, "admit_date", "discharge_date")
    named = flagged.join(departments.select("department_key", "department_name"), "department_key")
    return hospital.readmission_rate(named, "department_name")


@query(
    "census_daily",
    with_(
        HOSPITAL,
        f""", cal AS (SELECT cast(unnest(generate_series((SELECT min(admit_date) FROM hospital_fact),
        (SELECT max(discharge_date) FROM hospital_fact), interval 1 day)) AS date) AS day)
        SELECT department_name, cast(beds AS bigint) AS beds, day, n AS in_patients, n * 100.0::double / beds AS occupancy_pct
        FROM (SELECT department_name, beds, day, count(a.admission_key) AS n FROM cal
              CROSS JOIN hospital_departments dep LEFT JOIN hospital_fact a ON a.department_key = dep.department_key
              AND cal.day >= a.admit_date AND cal.day < a.discharge_date GROUP BY ALL)""",
    ),
)
def census_daily(t: Tables):
    departments, stays = d.departments(t), d.admissions(t)
    span = day_bounds(stays, "admit_date", "discharge_date").select(F.struct("first_day", "last_day")).scalar()
    census = hospital.bed_census(stays, departments, "department_id", span["first_day"], span["last_day"])
    return census.drop("department_id")


@query(
    "age_band_mix",
    with_(
        HOSPITAL,
        f"""SELECT age_band, insurance_type, diagnosis_group, n AS admissions, {half_up("total * 100", "n * 100", 6)} AS avg_charge
        FROM (SELECT age_band, insurance_type, diagnosis_group, count(*) AS n, sum(total_charges) AS total
              FROM hospital_fact JOIN hospital_patients USING (patient_key) GROUP BY ALL)""",
    ),
)
def age_band_mix(t: Tables):
    fact, patients, _, _ = _hospital(t, "patients")
    return hospital.diagnosis_mix(fact, patients)


# --- readmission ----------------------------------------------------------------------------------------


@query("readmitted_after", with_("stays readmitted", "SELECT admission_id, flag AS is_readmission_within_30d FROM readmitted"))
def readmitted_after(t: Tables):
    return hospital.readmitted_after(d.stays(t)).select("admission_id", "is_readmission_within_30d")


@query(
    "readmission_lag",
    with_(
        "stays",
        """SELECT admission_id, patient_id, coalesce(date_diff('day', prev, admit_date) BETWEEN 0 AND 30, false)
        AS is_readmission FROM (SELECT *, lag(discharge_date) OVER (PARTITION BY patient_id
        ORDER BY admit_date, admission_id) AS prev FROM stays)""",
    ),
)
def readmission_lag(t: Tables):
    order = ["admit_date", "admission_id"]
    flagged = hospital.readmission_lag(d.stays(t), "patient_id", order, "admit_date", "discharge_date")
    return flagged.select("admission_id", "patient_id", "is_readmission")


@query(
    "readmission_risk",
    with_(
        "stays readmitted ward_patients",
        """SELECT patient_id, age, has_chronic_condition, n AS total_admissions, r AS readmissions_within_30d,
        cast(los AS double) / n AS avg_length_of_stay, r >= 1 OR (has_chronic_condition AND n >= 3) AS readmission_risk_flag
        FROM (SELECT patient_id, count(*) AS n, count(*) FILTER (flag) AS r, sum(length_of_stay_days) AS los
              FROM readmitted GROUP BY patient_id) JOIN ward_patients USING (patient_id)""",
    ),
)
def readmission_risk(t: Tables):
    return hospital.readmission_risk(hospital.readmitted_after(d.stays(t)), d.ward_patients(t))


@query(
    "ward_daily",
    with_(
        "stays",
        """SELECT ward, admit_date, count(*) AS admissions_that_day,
        cast(sum(length_of_stay_days) AS double) / count(*) AS avg_length_of_stay FROM stays GROUP BY ALL""",
    ),
)
def ward_daily(t: Tables):
    return hospital.ward_daily(d.stays(t))


# --- telemetry ------------------------------------------------------------------------------------------


@query(
    "readings_quarantine",
    with_(
        "readings",
        """SELECT *, 'outside the operating envelope' AS _dq_reason FROM readings
        WHERE NOT coalesce(temperature_c BETWEEN -20 AND 150 AND vibration_mm_s BETWEEN 0 AND 50, false)""",
    ),
)
def readings_quarantine(t: Tables):
    return telemetry.plausible(d.readings(t))[1]


def _flags(t: Tables):
    passed, _ = telemetry.plausible(d.readings(t))
    return telemetry.anomaly_flags(passed, d.machines(t))


@query(
    "zscore_anomalies",
    with_(
        "readings plausible scored flags",
        """SELECT machine_id, machine_type, line, reading_timestamp, temperature_c, vibration_mm_s,
        round(temp_z, 6) AS temp_zscore, round(vibe_z, 6) AS vibe_zscore FROM flags""",
    ),
)
def zscore_anomalies(t: Tables):
    return _flags(t).withColumns({z: F.round(z, 6) for z in telemetry.SCORES.values()})


@query(
    "maintenance_priority",
    with_(
        "readings plausible scored flags",
        """SELECT machine_id, machine_type, line, count(*) AS anomalous_reading_count,
        max(reading_timestamp) AS last_anomaly_at, CASE WHEN count(*) >= 20 THEN 'Urgent'
        WHEN count(*) >= 5 THEN 'Schedule Soon' ELSE 'Monitor' END AS maintenance_priority FROM flags GROUP BY ALL""",
    ),
)
def maintenance_priority(t: Tables):
    return telemetry.maintenance_queue(_flags(t))


# --- logistics ------------------------------------------------------------------------------------------

DELIVERY_TIES = ["ship_date", "_part", "carrier_id", "weight_kg", "_price"]


def _deliveries(t: Tables):
    outcome = logistics.delivery_outcome(d.deliveries(t), DELIVERY_TIES).drop("_part", "_price")
    return logistics.fact_deliveries(outcome, distinct_rows(d.warehouses(t), ["warehouse_id"]))


@query(
    "delivery_outcome",
    with_(
        "outcome",
        """SELECT shipment_id, warehouse_id, r_name AS region, carrier_id, ship_date, cast(promised AS bigint) AS promised_delivery_days,
        promised + delay_days AS actual_delivery_days, delay_days, delay_days <= 0 AS is_on_time, weight_kg,
        damaged AS damaged_on_arrival
        FROM outcome JOIN nation ON n_nationkey = warehouse_id JOIN region ON n_regionkey = r_regionkey""",
    ),
)
def delivery_outcome(t: Tables):
    return _deliveries(t)


OUTCOME = f"""n AS total_shipments, ok AS on_time_shipments, cast(delay AS double) / n AS avg_delay_days,
    {half_up("ok * 100", "n", 1)} AS on_time_pct"""
OUTCOME_SUMS = "count(*) AS n, count(*) FILTER (delay_days <= 0) AS ok, sum(delay_days) AS delay"


@query(
    "sla_by_region",
    with_(
        "outcome",
        f"""SELECT warehouse_id, region, {OUTCOME} FROM (SELECT warehouse_id, r_name AS region, {OUTCOME_SUMS}
        FROM outcome JOIN nation ON n_nationkey = warehouse_id JOIN region ON n_regionkey = r_regionkey GROUP BY ALL)""",
    ),
)
def sla_by_region(t: Tables):
    return logistics.warehouse_sla(_deliveries(t))


@query(
    "carrier_scorecard",
    with_(
        "outcome",
        f"""SELECT carrier_id, s_name AS carrier_name, {OUTCOME}, broken AS damaged_shipments,
        {half_up("broken * 100", "n", 2)} AS damage_rate_pct
        FROM (SELECT carrier_id, {OUTCOME_SUMS}, count(*) FILTER (damaged) AS broken FROM outcome GROUP BY carrier_id)
        JOIN supplier ON s_suppkey = carrier_id""",
    ),
)
def carrier_scorecard(t: Tables):
    return logistics.carrier_scorecard(_deliveries(t), d.carriers(t))


# --- churn ----------------------------------------------------------------------------------------------


@query(
    "churn_features",
    """SELECT c_custkey AS customer_id, c_custkey % 63 + 18 AS age, c_mktsegment AS plan,
    CASE c_nationkey % 3 WHEN 0 THEN 'Month-to-month' WHEN 1 THEN '1 Year' ELSE '2 Year' END AS contract_type,
    c_custkey % 72 + 1 AS tenure_months, cast(cast(abs(c_acctbal) AS decimal(10,2)) AS double) AS monthly_charge,
    c_custkey % 7 AS support_tickets_90d, c_custkey % 5 > 1 AS autopay_enabled, avg_data_gb, avg_voice_minutes,
    avg_sms_count, (c_nationkey % 3 = 0 AND c_custkey % 7 >= 3) OR c_custkey % 11 = 0 AS churned
    FROM customer LEFT JOIN (SELECT o_custkey, cast(sum(o_orderkey % 17) AS double) / count(*) AS avg_data_gb,
    cast(sum(o_orderkey % 401) AS double) / count(*) AS avg_voice_minutes,
    cast(sum(o_orderkey % 97) AS double) / count(*) AS avg_sms_count FROM orders GROUP BY 1) ON o_custkey = c_custkey""",
)
def churn_features(t: Tables):
    return churn.churn_features(d.subscribers(t), d.usage(t))
