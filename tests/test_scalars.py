import datetime as dt
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lakeops.functions import scalars as s


def one(spark, expr, **values):
    schema = ", ".join(f"{k} {t}" for k, (t, _) in values.items())
    return spark.createDataFrame([tuple(v for _, v in values.values())], schema).select(expr.alias("x")).first().x


def test_usd_rounds_half_up(spark):
    got = [one(spark, s.to_usd("a", "c"), a=("double", v), c=("string", c))
           for v, c in ((100.0, "EUR"), (10.05, "GBP"), (1234.5, "INR"), (7.0, "USD"), (7.0, None))]
    assert got == [Decimal("108.00"), Decimal("12.76"), Decimal("14.81"), Decimal("7.00"), Decimal("7.00")]


@pytest.mark.parametrize(
    ("age", "bucket"), [(None, "UNKNOWN"), (-5, "LOW"), (0, "LOW"), (39, "LOW"), (40, "MODERATE"), (64, "MODERATE"), (65, "HIGH"), (250, "HIGH")]
)
def test_risk_bucket_forms_agree(spark, age, bucket):
    df = spark.createDataFrame([(age,)], "age int")
    forms = [f("age") for f in (s.risk_bucket, s.risk_bucket_row, s.risk_bucket_arrow)]
    assert [df.select(f.alias("b")).first().b for f in forms] == [bucket] * 3


def test_risk_bands_close_upwards(spark):
    df = spark.createDataFrame([(p,) for p in (0.0, 0.3, 0.31, 0.6, 0.61, 1.0, None)], "p double")
    got = [r.b for r in df.select(s.risk_band("p").alias("b")).collect()]
    assert got == ["Low", "Low", "Medium", "Medium", "High", "High", None]


def test_age_band_counts_year_boundaries(spark):
    born, day = dt.date(2008, 12, 31), dt.date(2026, 1, 1)
    years = one(spark, s.year_boundaries("a", "b"), a=("date", born), b=("date", day))
    assert years == 18
    assert one(spark, s.age_band("y"), y=("int", years)) == "18-39"


def test_sla_verdict(spark):
    df = spark.createDataFrame(
        [(None, True), (2, True), (3, True), (4, False), (5, False)], "transit_days int, is_express boolean"
    )
    got = [r.v for r in df.select(s.sla_verdict("transit_days", "is_express").alias("v")).collect()]
    assert got == ["Open", "Met", "Breach", "Met", "Breach"]


def test_rate_of_empty_group_is_null(spark):
    assert one(spark, s.rate("a", "b", 1), a=("int", 1), b=("int", 0)) is None
    assert one(spark, s.rate("a", "b", 1), a=("int", 1), b=("int", 3)) == Decimal("33.3")


def test_dates(spark):
    assert one(spark, s.date_key("d"), d=("date", dt.date(2026, 1, 5))) == 20260105
    assert one(spark, s.text_date_key("d"), d=("string", "2026-01-05")) == 20260105
    assert one(spark, s.text_date_key("d"), d=("string", None)) is None


def test_holds_is_two_valued(spark):
    assert one(spark, s.holds(F.col("a") > 1), a=("int", None)) is False


def test_padding_never_cuts(spark):
    df = spark.createDataFrame([(7,), (12,), (112,), (1012,), (12345678901,), (12345678902,), (None,)], "n bigint")
    got = [r.p for r in df.select(s.zero_padded("n", 2).alias("p")).collect()]
    assert got == ["07", "12", "112", "1012", "12345678901", "12345678902", None]
