"""Domain plans on fixed inputs with known results."""

import datetime as dt
from decimal import Decimal

import pytest
import staged_rows
from conftest import plan, rows
from pyspark.sql import functions as F

from lakeops.operators import aggregates, changes, forest
from lakeops.operators.quality import QualityGateError, control_totals, reconcile, table_counts
from lakeops.plans import banking, churn, hospital, logistics, retail, shipments, telemetry
from lakeops.session import scratch, stored
from lakeops.sources.readers import calendar, number_series


@pytest.fixture(scope="module")
def star(spark):
    hubs, customers = staged_rows.hub_dim(spark), staged_rows.customer_dim(spark)
    carriers = shipments.carrier_dim(number_series(spark, 12))
    staging = stored(staged_rows.staged_shipments(spark))
    fact = stored(shipments.fact_shipments(staging, customers, hubs, carriers))
    return {"hubs": hubs, "customers": customers, "carriers": carriers, "staging": staging, "fact": fact}


def test_star_row_counts(spark, star):
    got = dict(rows(table_counts({"staging": star["staging"], "hub": star["hubs"], "carrier": star["carriers"],
                                  "customer": star["customers"], "delta": staged_rows.staged_delta(spark)})))
    assert got == {"staging": 1_000_200, "hub": 40, "carrier": 13, "customer": 50_000, "delta": 5000}


def test_fact_control_totals(star):
    expected = {
        "row_count": 1_000_000, "distinct_keys": 1_000_000, "unknown_carrier": 1003, "total_freight": 1_299_995_000.00,
        "total_weight": 25_495_000.00, "null_transit": 105_264,
    }
    checked = reconcile(control_totals(star["fact"], shipments.validation(star["fact"])), expected)
    assert checked.filter("NOT matches").collect() == []
    assert dict(rows(star["fact"].groupBy("status").count())) == {
        "Delivered": 842_105, "Cancelled": 52_632, "In Transit": 52_632, "Returned": 52_631,
    }


def test_star_reports(spark, star):
    fact = star["fact"]
    assert dict(rows(shipments.sla_view(fact).groupBy("sla_result").count())) == {
        "Breach": 340_852, "Met": 553_884, "Open": 105_264,
    }
    assert dict(rows(shipments.transit_by_service(fact, star["carriers"]))) == {
        "Economy": 4.5, "Express": 3.5, "Standard": 2.5, "Unknown": 3.5,
    }
    bounds = spark.createDataFrame([(dt.date(2024, 1, 1), dt.date(2026, 12, 31))], "a date, b date")
    monthly = shipments.freight_by_region_month(fact, star["hubs"], calendar(bounds, "a", "b"), 2025)
    assert monthly.count() == 48 and "PushedFilters: [IsNotNull(ship_date_key), GreaterThanOrEqual(ship_date_key,20250101)" in plan(monthly).replace("[IsNotNull(hub_key), ", "[")
    raw = shipments.freight_by_region_month_raw(star["staging"], star["hubs"], 2025)
    repeated = raw.agg(F.sum("freight")).first()[0] - monthly.agg(F.sum("freight")).first()[0]
    assert raw.count() == 48 and repeated > 0  # the raw report counts the repeated rows
    top = shipments.top_customers(fact, star["customers"], "Enterprise")
    assert top.count() == 20 and "TakeOrderedAndProject" in plan(top)


def test_incident_drill(star):
    fact = star["fact"]
    assert fact.filter("hub_key = 5").agg(F.sum("freight_amount")).first()[0] == Decimal("32502000.00")
    broken = changes.conditional_update(fact, F.col("hub_key") == 5, {"freight_amount": F.lit(0)})
    assert broken.agg(F.sum("freight_amount")).first()[0] == Decimal("1267493000.00")
    fixed = changes.repair_from(broken, fact, ["shipment_key"], ["freight_amount"], F.col("hub_key") == 5)
    assert fixed.agg(F.sum("freight_amount")).first()[0] == Decimal("1299995000.00")


def test_slice_load_twice(spark, star):
    delta = shipments.conformed(staged_rows.staged_delta(spark), star["customers"], star["hubs"], star["carriers"])
    fact, moved = star["fact"], []
    for _ in range(2):
        fact, log = changes.reload_slice(fact, delta, "ship_date_key", 20260105)
        moved.append((log.first().rows_deleted, log.first().rows_inserted, fact.count()))
    assert moved == [(0, 5000, 1_005_000), (5000, 5000, 1_005_000)]


FACT_COLUMNS = [
    "order_id", "order_date", "customer_id", "customer_name", "region", "product_id", "product_name", "category", "quantity",
    "unit_price", "discount", "profit", "sales",
]
HEADER = "txn_id,account_id,amount,currency,txn_ts,channel\n"


def day_file(tmp_path, name, lines):
    path = tmp_path / name
    path.write_text(HEADER + "\n".join(lines) + "\n")
    return str(path)


def test_banking_days(spark, tmp_path):
    root, control = scratch(spark, "bank"), "bank_control"
    good = [f"T{i},A{i % 3},{100 + i},{'EUR' if i % 2 else 'USD'},2026-01-15 10:00:0{i % 10},POS" for i in range(20)]
    first = day_file(tmp_path, "a.csv", [*good, "T1,A1,101,EUR,2026-01-15 10:00:01,POS", "T99,A1,5,XYZ,2026-01-15 11:00:00,POS"])
    done = banking.run_day(spark, first, root, control, "2026-01-15")
    assert done == {"batch_date": "2026-01-15", "skipped": False, "bronze_rows": 22, "silver_rows": 20, "quarantined_rows": 1}
    gold = spark.read.parquet(f"{root}/gold")
    want = sum(Decimal(100 + i) * (Decimal("1.08") if i % 2 else 1) for i in range(20))
    assert rows(gold, "channel", "txn_count", "total_amount_usd", "distinct_accounts") == [("POS", 20, want, 3)]

    assert banking.run_day(spark, first, root, control, "2026-01-15")["skipped"]
    # The next day brings an id already landed (ignored) and one dated the day before (its day is recomputed).
    second = day_file(tmp_path, "b.csv", ["T3,A1,999,USD,2026-01-16 09:00:00,ATM", "T50,A1,10,USD,2026-01-15 23:00:00,POS"])
    assert banking.run_day(spark, second, root, control, "2026-01-16")["silver_rows"] == 1
    gold = spark.read.parquet(f"{root}/gold")
    assert rows(gold, "channel", "txn_count", "total_amount_usd") == [("POS", 21, want + 10)]

    bad = day_file(tmp_path, "c.csv", ["T60,A1,1,XYZ,2026-01-17 09:00:00,ATM", "T61,A1,10,USD,2026-01-17 23:00:00,POS"])
    with pytest.raises(QualityGateError):
        banking.run_day(spark, bad, root, control, "2026-01-17")
    assert spark.read.parquet(f"{root}/quarantine").filter("_batch_date = '2026-01-17'").count() == 1
    spark.sql(f"DROP TABLE {control}")


def test_bank_rerun_replaces(spark, tmp_path):
    """Corrected files for the same date: emptied sides and days leave nothing behind; empty and rejected first batches run."""
    root, control = scratch(spark, "bank"), "bank_rerun_control"
    header_only = day_file(tmp_path, "none.csv", [])
    assert banking.run_day(spark, header_only, root, control, "2026-01-14")["silver_rows"] == 0
    rejected = day_file(tmp_path, "bad.csv", ["T1,A1,1,XYZ,2026-01-15 09:00:00,ATM", "T2,A1,1,USD,,ATM"])
    assert banking.run_day(spark, rejected, root, control, "2026-01-15", max_share=1.0)["quarantined_rows"] == 2
    good = day_file(tmp_path, "good.csv", ["T1,A1,1,USD,2026-01-15 09:00:00,ATM", "T2,A1,2,USD,2026-01-13 09:00:00,ATM"])
    assert banking.run_day(spark, good, root, control, "2026-01-15", again=True)["silver_rows"] == 2
    assert spark.read.parquet(f"{root}/quarantine").count() == 0
    fewer = day_file(tmp_path, "fewer.csv", ["T1,A1,5,USD,2026-01-15 09:00:00,ATM"])
    banking.run_day(spark, fewer, root, control, "2026-01-15", again=True)
    assert rows(spark.read.parquet(f"{root}/gold"), "txn_date", "txn_count", "total_amount_usd") == [(dt.date(2026, 1, 15), 1, Decimal("5.00"))]
    banking.run_day(spark, header_only, root, control, "2026-01-15", again=True)
    assert spark.read.parquet(f"{root}/gold").count() == 0
    spark.sql(f"DROP TABLE {control}")


def test_retail_silver(spark):
    cols = [*[c for c in FACT_COLUMNS if c != "sales"], "_ingested_at"]
    base = ["1", "2026-01-02", "c1", " Ann ", " north ", "p1", "Tee", "Apparel", 2, -10.0, 0.1, 5.0]
    data = [
        (*base, 1), (*base[:9], 20.0, 0.1, 5.0, 2), ("2", *base[1:], 1), ("3", "2026-01-02", "c2", "  ", *base[4:], 1),
        ("4", "no date", *base[2:], 1),
    ]
    silver = retail.clean_sales(spark.createDataFrame(data, cols), ["unit_price"])
    assert rows(retail.fact_sales(silver), "order_id", "customer_name", "region", "unit_price", "sales") == [
        ("1", "Ann", "North", 20.0, Decimal("36.0000")), ("2", "Ann", "North", 10.0, Decimal("18.0000")),
        ("4", "Ann", "North", 10.0, Decimal("18.0000")),
    ]
    assert rows(retail.customer_lifetime(silver), "customer_id", "lifetime_sales", "total_orders") == [("c1", Decimal("72.00"), 3)]
    assert rows(retail.monthly_region_category(silver), "order_year", "order_month", "order_count") == [(2026, 1, 2), (None, None, 1)]


def test_retail_star_and_stock(spark):
    products = spark.createDataFrame([("p1", "Tee", 9.99, 5.0, "Apparel")], "product_id string, product_name string, unit_price double, unit_cost double, category string")
    sales = spark.createDataFrame([("s1", "p1", 3, 10)], "store_id string, product_id string, quantity int, discount_pct int")
    star = retail.star_sales(sales, products)
    assert rows(star, "gross_revenue", "gross_margin") == [(Decimal("26.97"), Decimal("11.97"))]
    stores = spark.createDataFrame([("s1", "Main", "North")], "store_id string, store_name string, region string")
    assert rows(retail.sales_performance(star, stores), "store_name", "units_sold") == [("Main", 3)]
    stock = spark.createDataFrame([("s1", "p1", "2026-01-01", q, 10) for q in (-1, 5, 10, None)], "store_id string, product_id string, snapshot_date string, quantity_on_hand int, reorder_point int")
    passed, failed = retail.clean_inventory(stock)
    assert (passed.count(), failed.count()) == (2, 2)
    assert rows(retail.stockout_risk(passed, products, stores), "quantity_on_hand") == [(5,)]


def test_readmission_definitions(spark):
    def d(n):
        return dt.date(2025, 1, 1) + dt.timedelta(days=n)

    data = [(1, "P", d(0), d(5)), (2, "P", d(5), d(8)), (3, "P", d(38), d(40)), (4, "P", d(71), d(72)), (5, "Q", d(0), d(1))]
    stays = spark.createDataFrame(data, "admission_id int, patient_id string, admit_date date, discharge_date date")
    later = hospital.readmission_lag(stays, "patient_id", ["admit_date", "admission_id"], "admit_date", "discharge_date")
    assert rows(later, "admission_id", "is_readmission") == [(1, False), (2, True), (3, True), (4, False), (5, False)]
    earlier = hospital.readmitted_after(stays)
    assert rows(earlier, "admission_id", "is_readmission_within_30d") == [(1, False), (2, True), (3, False), (4, False), (5, False)]


def test_sensor_edges(spark):
    at = dt.datetime(2026, 1, 1)
    data = [("M1", at, 60.0, 2.0)] * 30 + [("M1", at, 100.0, 2.0), ("M2", at, 70.0, 1.0), ("M3", at, 999.0, 1.0), ("M3", at, None, 1.0)]
    readings = spark.createDataFrame(data, "machine_id string, reading_timestamp timestamp, temperature_c double, vibration_mm_s double")
    machines = spark.createDataFrame([("M1", "Press", "A"), ("M2", "Lathe", "B")], "machine_id string, machine_type string, line string")
    passed, failed = telemetry.plausible(readings)
    assert (passed.count(), failed.count()) == (32, 2)
    flags = telemetry.anomaly_flags(passed, machines)
    assert rows(flags, "machine_id", "temperature_c", "vibe_zscore") == [("M1", 100.0, None)]  # constant signal: no score
    assert rows(telemetry.maintenance_queue(flags), "machine_id", "maintenance_priority") == [("M1", "Monitor")]


def test_hot_machine_scores_equal(spark, monkeypatch):
    i = F.col("id")
    df = spark.range(900).select(F.when(i % 3 > 0, 1).otherwise(i % 20).alias("k"), (i * 37 % 100).cast("double").alias("m"))
    small = rows(aggregates.zscores(df, "k", {"m": "z"}).withColumn("z", F.round("z", 9)))
    monkeypatch.setattr(aggregates, "fits_broadcast", lambda df: False)
    assert rows(aggregates.zscores(df, "k", {"m": "z"}, hot_share=0.2).withColumn("z", F.round("z", 9))) == small


def test_scorecard(spark):
    data = [("s1", "w1", "c1", "2026-01-01", "2", "2", 1.0, False), ("s1", "w1", "c1", "2026-01-01", "2", "2", 1.0, False),
            ("s2", "w1", "c1", "2026-01-01", "2", "5", 1.0, True), ("s3", "w1", "c2", "2026-01-01", "3", "1", 1.0, False)]
    names = ["shipment_id", "warehouse_id", "carrier_id", "ship_date", "promised_delivery_days", "actual_delivery_days", "weight_kg", "damaged_on_arrival"]
    outcome = logistics.delivery_outcome(spark.createDataFrame(data, names), ["ship_date"])
    fact = logistics.fact_deliveries(outcome, spark.createDataFrame([("w1", "North")], ["warehouse_id", "region"]))
    assert rows(logistics.warehouse_sla(fact), "total_shipments", "on_time_pct", "avg_delay_days") == [(3, Decimal("66.7"), 1 / 3)]
    carriers = spark.createDataFrame([("c1", "One"), ("c2", "Two")], ["carrier_id", "carrier_name"])
    assert [tuple(r) for r in logistics.carrier_scorecard(fact, carriers).select("carrier_name", "on_time_pct", "damage_rate_pct").collect()] == [
        ("Two", Decimal("100.0"), Decimal("0.00")), ("One", Decimal("50.0"), Decimal("50.00")),
    ]


def test_forest_is_fitted_on_all_cores(spark, monkeypatch):
    """Training rows that come from one file are spread before the fit."""
    seen, fit = [], forest.RandomForestClassifier.fit
    monkeypatch.setattr(forest.RandomForestClassifier, "fit", lambda self, df: seen.append(df.rdd.getNumPartitions()) or fit(self, df))
    i = F.col("id")
    monkeypatch.setattr(forest, "SPREAD_ROWS", 100)
    made = spark.range(400).coalesce(1).select("id", (i % 7).cast("double").alias("n"), (i % 5).cast("string").alias("c"), (i % 7 > 3).cast("int").alias("label"))
    model = forest.fit_forest(made, "label", ["n"], ["c"], trees=3, depth=3, balanced=True)
    assert seen[0] > 1
    assert forest.score(model, made, "p").where("p BETWEEN 0 AND 1").count() == 400


def test_churn_model(spark):
    i = F.col("id")
    customers = spark.range(600).select(
        i.alias("customer_id"), (i % 60 + 18).alias("age"), F.lit("Basic").alias("plan"),
        F.when(i % 2 == 0, "Month-to-month").otherwise("2 Year").alias("contract_type"), (i % 72).alias("tenure_months"),
        F.lit(25.0).alias("monthly_charge"), (i % 7).alias("support_tickets_90d"), (i % 3 == 0).alias("autopay_enabled"),
        ((i % 2 == 0) & (i % 7 > 3)).alias("churned"),
    )
    usage = spark.range(300).select(i.alias("customer_id"), (i % 9).alias("data_gb"), i.alias("voice_minutes"), i.alias("sms_count"))
    features = churn.churn_features(customers, usage)
    assert features.count() == 600 and features.filter("avg_data_gb IS NULL").count() == 300
    model, held_out, (auc, accuracy) = churn.train_churn(features, trees=10, depth=4)
    assert auc > 0.95 and accuracy > 0.85 and held_out.count() < 300
    scored = churn.churn_predictions(features, folds=3, trees=5, depth=4)
    assert scored.count() == scored.select("customer_id").distinct().count() == 600
    assert scored.filter("churn_probability < 0 OR churn_probability > 1 OR risk_band IS NULL").isEmpty()


def test_sweep_over_a_planted_signal(spark):
    """Each pair fitted once over features made once; the best model orders rows it has not seen, a grid of one does the same."""
    i = F.col("id")
    rows_of = spark.range(1500).select(i, (i % 24).cast("double").alias("hour"), F.concat(F.lit("c"), (i * 7 % 13).cast("string")).alias("kind"),
                                       ((i * 7 % 13 < 4) | (i % 19 == 0)).cast("int").alias("label"))
    train, test = aggregates.split_exact(rows_of, "label", "id", 0.8, 1)
    model, metrics = forest.sweep(train, test, "label", ["hour"], ["kind"], grid=((3, 2), (12, 5)))
    assert sorted(rows(metrics, "num_trees", "max_depth")) == [(3, 2), (12, 5)]
    assert metrics.agg(F.max("test_auc")).first()[0] > 0.85
    one, again = forest.sweep(train, test, "label", ["hour"], ["kind"], grid=((12, 5),), at_once=1)
    assert rows(again) == rows(metrics.where("num_trees = 12"))
    scored = forest.score(one, test, "p")
    assert scored.columns == [*test.columns, "p"] and scored.count() == test.count()
    means = dict(rows(scored.groupBy("label").agg(F.avg("p"))))
    assert means[1] > means[0] + 0.3
    unseen = forest.score(model, spark.createDataFrame([(1, 3.0, "never", 0)], rows_of.schema), "p")
    assert 0 <= unseen.first().p <= 1


def test_sweep_merges_equal_rows(spark, monkeypatch, tmp_path):
    """Many rows of few distinct features are fitted as weighted ones; forests, metrics and scores are as good as over all rows."""
    i = F.col("id")
    rows_of = spark.range(6000).select(i, (i % 24).cast("double").alias("hour"), F.concat(F.lit("c"), (i * 7 % 13).cast("string")).alias("kind"),
                                       ((i * 7 % 13 < 4) | (F.xxhash64("id") % 19 == 0)).cast("int").alias("label"))
    train, test = aggregates.split_exact(rows_of, "label", "id", 0.8, 1)
    _, over_all = forest.sweep(train, test, "label", ["hour"], ["kind"], grid=((12, 5),))
    seen, fit = [], forest.RandomForestClassifier.fit
    monkeypatch.setattr(forest.RandomForestClassifier, "fit", lambda self, df: seen.append(df.count()) or fit(self, df))
    monkeypatch.setattr(forest, "MERGE_ROWS", 1000)
    model, metrics = forest.sweep(train, test, "label", ["hour"], ["kind"], grid=((3, 2), (12, 5)))
    assert max(seen) <= 24 * 13 * 2 and len(seen) == 15
    assert len(model.stages[-1].trees) == model.stages[-1].getNumTrees in (3, 12)
    merged, plain = metrics.where("num_trees = 12").first(), over_all.first()
    assert abs(merged.test_auc - plain.test_auc) < 0.05 and abs(merged.accuracy - plain.accuracy) < 0.05
    one, again = forest.sweep(train, test, "label", ["hour"], ["kind"], grid=((12, 5),), balanced=False)
    assert rows(again) == rows(metrics.where("num_trees = 12"))
    assert one.stages[-1].getNumTrees == 12
    one.stages[-1].save(str(tmp_path / "forest"))
    loaded = forest.RandomForestClassificationModel.load(str(tmp_path / "forest"))
    assert len(loaded.trees) == 12 and loaded.getMaxDepth() == 5
    scored = forest.score(one, test, "p")
    # The merged test rows stand for all rows: metrics over the rows themselves are the same.
    assert forest.metrics_of(one, test, "label") == pytest.approx((merged.test_auc, merged.accuracy), abs=1e-9)
    assert scored.where("p BETWEEN 0 AND 1").count() == test.count()
    weighted, _ = forest.sweep(train, test, "label", ["hour"], ["kind"], grid=((4, 3),), balanced=True)
    assert forest.metrics_of(weighted, test, "label")[0] > 0.8


def test_draws_of_merged_rows(spark):
    """The draws of k equal rows sum to Poisson(k): mean and variance are k, each tree draws by itself, a re-run draws the same."""
    cells = spark.range(3000, numPartitions=2).select("id", F.when(F.col("id") % 2 == 0, 40).otherwise(1).cast("bigint").alias(forest.COUNT))
    schema = f"id bigint, {forest.COUNT} bigint, a int, b int"
    drawn = cells.mapInArrow(forest._drawn(["a", "b"], 7), schema)
    for k, mean, variance, joint in rows(drawn.groupBy(forest.COUNT).agg(F.avg("a"), F.var_samp("b"), F.corr("a", "b"))):
        assert abs(mean - k) < 0.1 * k and abs(variance - k) < 0.2 * k and abs(joint) < 0.1
    assert rows(drawn) == rows(cells.mapInArrow(forest._drawn(["a", "b"], 7), schema))


def test_retail_layers(spark, tmp_path):
    (tmp_path / "sales.csv").write_text(
        "OrderID,OrderDate,CustomerID,CustomerName,Region,ProductID,ProductName,Category,Quantity,UnitPrice,Discount,Profit\n"
        "O1,2026-01-02,c1, Ann , north ,p1,Tee,Apparel,2,-10.5,0.1,5.0\n"
        "O1,2026-01-02,c1,Ann,NORTH,p1,Tee,Apparel,3,10.5,0.1,5.0\n"
        "O2,2026-02-02,c2,,South,p1,Tee,Apparel,1,10.5,0,5.0\n"
    )
    root = scratch(spark, "retail")
    for _ in range(2):
        tables = retail.run(spark, str(tmp_path / "sales.csv"), root)
    assert tables["bronze"].count() == 3 and "_source_file" in tables["bronze"].columns
    assert rows(tables["silver"], "order_id", "customer_name", "region", "quantity") == [("O1", "Ann", "North", 3)]
    assert sorted(tables["fact"].columns) == sorted(FACT_COLUMNS)
    assert rows(tables["monthly"], "order_month", "total_sales", "order_count") == [(1, Decimal("28.35"), 1)]
    assert rows(tables["customers"], "customer_id", "lifetime_profit") == [("c1", Decimal("5.00"))]


def test_star_load_twice(spark):
    departments = spark.createDataFrame([("D02", "Neuro", 3), ("D01", "Cardio", 2)], "department_id string, department_name string, beds int")
    doctors = spark.createDataFrame([("R2", "B", "D01"), ("R1", "A", "D02"), ("R9", "X", "D99")], "doctor_id string, doctor_name string, department_id string")
    patients = spark.createDataFrame([("P1", dt.datetime(2008, 12, 31), "Private"), ("P2", dt.datetime(1950, 1, 1), "Self-pay")], "patient_id string, birth_date timestamp, insurance_type string")
    admissions = spark.createDataFrame(
        [(1, "P1", "R1", "D02", dt.datetime(2025, 1, 1), dt.datetime(2025, 1, 4), "Stroke", True, 10.005),
         (2, "P2", "R2", "D01", dt.datetime(2025, 1, 2), dt.datetime(2025, 1, 3), "Cardiac", None, 20.0),
         (3, "P2", "R9", "D01", dt.datetime(2025, 1, 2), dt.datetime(2025, 1, 3), "Cardiac", False, 20.0)],
        "admission_id int, patient_id string, doctor_id string, department_id string, admit_date timestamp, discharge_date timestamp, diagnosis_group string, is_emergency boolean, total_charges double",
    )
    root, seen = scratch(spark, "star"), []
    for _ in range(2):
        log = hospital.load_star(spark, root, departments, doctors, patients, admissions)
        fact = spark.read.parquet(f"{root}/fact_admission")
        seen.append(rows(fact))
    assert seen[0] == seen[1]
    assert rows(log, "run_id", "step", "rows_affected")[:4] == [(1, "dim_department", 2), (2, "dim_doctor", 2), (3, "dim_patient", 2), (4, "fact_admission", 2)]
    assert log.count() == 8 and log.agg(F.max("run_id")).first()[0] == 8
    assert rows(spark.read.parquet(f"{root}/dim_doctor"), "doctor_key", "doctor_id", "department_key") == [(1, "R1", 2), (2, "R2", 1)]
    patient = spark.read.parquet(f"{root}/dim_patient")
    assert rows(patient, "patient_id", "age_band") == [("P1", "18-39"), ("P2", "65+")]
    assert rows(fact, "admission_key", "length_of_stay", "is_emergency") == [(1, 3, True), (2, 1, False)]
    department = spark.read.parquet(f"{root}/dim_department")
    assert rows(hospital.department_kpis(fact, department), "department_name", "alos", "emergency_pct") == [("Cardio", 1.0, 0.0), ("Neuro", 3.0, 100.0)]
    census = hospital.bed_census(fact, department, "department_key", F.lit(dt.date(2025, 1, 1)), F.lit(dt.date(2026, 12, 1)))
    assert census.count() == 700 * 2 and census.agg(F.sum("in_patients")).first()[0] == 4
    assert rows(hospital.diagnosis_mix(fact, patient), "age_band", "admissions") == [("18-39", 1), ("65+", 1)]


def test_telemetry_run_twice(spark):
    at = "2026-01-01T00:00:00"
    landing, root = scratch(spark, "landing"), scratch(spark, "telemetry")
    data = [("M1", at, 60.0, 2.0, 900)] * 30 + [("M1", at, 100.0, 2.1, 900), ("M1", at, 999.0, 2.0, 900)]
    schema = "machine_id string, reading_timestamp string, temperature_c double, vibration_mm_s double, rpm int"
    readings = spark.createDataFrame(data, schema)
    machines = spark.createDataFrame([("M1", "Press", "A")], "machine_id string, machine_type string, line string")
    readings.coalesce(1).write.json(f"{landing}/batch_000")
    for _ in range(2):
        tables = telemetry.run(spark, landing, machines, root, readings.schema)
        assert {k: t.count() for k, t in tables.items()} == {"bronze": 32, "silver": 31, "quarantine": 1, "anomalies": 1, "maintenance": 1}
