import pytest
from conftest import rows
from pyspark.sql import functions as F

from lakeops.operators import quality as q


@pytest.fixture
def txns(spark):
    data = [("t1", 1.0, "USD"), ("t2", None, "USD"), (None, 2.0, "XYZ"), ("t4", 3.0, None), ("t5", 4.0, "EUR")]
    return spark.createDataFrame(data, "id string, amount double, currency string")


def rules():
    return {
        "id": F.col("id").isNotNull(),
        "amount": F.col("amount") > 0,
        "currency": F.col("currency").isin("USD", "EUR"),
    }


def test_split_loses_no_row(txns):
    valid, rejected = q.quarantine(txns, rules())
    assert rows(valid, "id") == [("t1",), ("t5",)]
    assert rows(rejected, "id", q.REASON) == [("t2", "amount"), ("t4", "currency"), (None, "id,currency")]
    assert valid.count() + rejected.count() == txns.count()


def test_gate(txns):
    metrics = q.gate_metrics(txns, rules())
    assert tuple(metrics.first()) == (5, 2, 3, 0.6)
    with pytest.raises(q.QualityGateError):
        q.quality_gate(metrics)
    assert q.quality_gate(metrics, max_share=0.6)["rejected_rows"] == 3  # strictly more fails


def test_referential_split(spark, txns):
    known = spark.createDataFrame([("t1",), ("t2",)], "code string")
    passed, orphans = q.ri_split(txns, known, "id", "code")
    assert rows(passed, "id") == [("t1",), ("t2",)]
    assert orphans.count() == 3 and set(r[q.REASON] for r in orphans.collect()) == {"id not found"}


def test_expectations(txns):
    assert q.expect(txns, {"positive": F.col("amount") >= 0}) is txns
    with pytest.raises(q.ExpectationError, match="positive"):
        q.expect(txns, {"positive": F.col("amount") >= 2})
    with pytest.raises(q.ExpectationError):
        q.expect(txns, {"positive": F.col("amount") >= 0}, null_ok=False)


def test_guard_stops_the_job(txns):
    assert q.guarded(txns, "positive", F.col("amount") >= 0).count() == 5
    with pytest.raises(Exception, match="rule broken: small"):
        q.guarded(txns, "small", F.col("amount") < 4).collect()


def test_control_totals_and_reconcile(txns):
    totals = q.control_totals(txns, {"n": F.count(F.lit(1)), "sum": F.sum("amount")})
    assert rows(totals) == [("n", 5.0), ("sum", 10.0)]
    got = rows(q.reconcile(totals, {"n": 5, "sum": 11}))
    assert got == [("n", 5.0, 5.0, True), ("sum", 10.0, 11.0, False)]


def test_table_counts(spark, txns):
    assert rows(q.table_counts({"a": txns, "b": txns.limit(2)})) == [("a", 5), ("b", 2)]
