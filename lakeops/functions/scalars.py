"""Scalar expressions: money, ratios, bands, date parts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Conversion rates into US dollars.
USD_RATES = {"USD": "1", "EUR": "1.08", "GBP": "1.27", "INR": "0.012"}

# Upper age bounds (exclusive) and their labels.
AGE_BANDS = ((18, "0-17"), (40, "18-39"), (65, "40-64"))
AGE_BAND_LAST = "65+"

# Churn probability bands, upper bounds inclusive.
RISK_BANDS = ((0.3, "Low"), (0.6, "Medium"))
RISK_BAND_LAST = "High"


def col(name: str | Column) -> Column:
    return F.col(name) if isinstance(name, str) else name


def money(value: str | Column, precision: int = 12, scale: int = 2) -> Column:
    """Exact decimal form of an amount; sums of it do not depend on the order of the rows."""
    return col(value).cast(f"decimal({precision},{scale})")


def rate(num: str | Column, den: str | Column, digits: int) -> Column:
    """``num`` as percent of ``den``, rounded half up from the exact quotient; null where ``den`` is zero."""
    scaled = col(num).cast("decimal(20,2)") * F.lit(100)
    return F.round(F.try_divide(scaled, col(den).cast("decimal(20,2)")), digits)


def percent(num: str | Column, den: str | Column) -> Column:
    """``num`` as percent of ``den``, not rounded; null where ``den`` is zero."""
    return F.try_divide(col(num) * F.lit(100.0), col(den))


def to_usd(amount: str | Column, currency: str | Column) -> Column:
    """Amount converted by the fixed rates and rounded to cents."""
    converted = None
    for code, factor in USD_RATES.items():
        branch = (col(currency) == code, money(amount, 18, 2) * F.lit(factor).cast("decimal(6,3)"))
        converted = F.when(*branch) if converted is None else converted.when(*branch)
    plain = money(amount, 18, 2) * F.lit("1").cast("decimal(6,3)")
    return F.round(converted.otherwise(plain), 2).cast("decimal(18,2)")


def year_boundaries(start: str | Column, end: str | Column) -> Column:
    """Number of new-year boundaries between two dates (not elapsed years)."""
    return F.year(col(end)) - F.year(col(start))


def age_band(years: str | Column) -> Column:
    return steps(years, AGE_BANDS, AGE_BAND_LAST, inclusive=False)


def risk_band(probability: str | Column) -> Column:
    return steps(probability, RISK_BANDS, RISK_BAND_LAST, inclusive=True)


def steps(value: str | Column, bounds: Sequence[tuple], last: str, inclusive: bool) -> Column:
    """Label by the first upper bound that holds the value; null stays null."""
    v = col(value)
    label = F.when(v.isNull(), F.lit(None).cast("string"))
    for bound, name in bounds:
        label = label.when(v <= bound if inclusive else v < bound, name)
    return label.otherwise(last)


def risk_bucket(age: str | Column) -> Column:
    """HIGH from 65, MODERATE from 40, LOW below, UNKNOWN without an age."""
    a = col(age)
    return (
        F.when(a.isNull(), "UNKNOWN").when(a >= 65, "HIGH").when(a >= 40, "MODERATE").otherwise("LOW")
    )


@F.udf(T.StringType())
def risk_bucket_row(age):
    """Row-at-a-time form of :func:`risk_bucket`; kept for callers that pass a Python function."""
    if age is None:
        return "UNKNOWN"
    if age >= 65:
        return "HIGH"
    return "MODERATE" if age >= 40 else "LOW"


@F.pandas_udf(T.StringType())
def risk_bucket_arrow(age: pd.Series) -> pd.Series:
    """Batch form of :func:`risk_bucket`: how many of its bounds each age has reached names the band."""
    reached = (age >= 40).astype(int) + (age >= 65).astype(int)
    return reached.map({0: "LOW", 1: "MODERATE", 2: "HIGH"}).mask(age.isna(), "UNKNOWN")


def sla_verdict(transit_days: str | Column, is_express: str | Column) -> Column:
    """Open while undelivered; express breaches after 2 days, the rest after 4."""
    days = col(transit_days)
    limit = F.when(col(is_express), 2).otherwise(4)
    return F.when(days.isNull(), "Open").when(days > limit, "Breach").otherwise("Met")


def date_key(day: str | Column) -> Column:
    """Date as the integer yyyymmdd."""
    d = col(day)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def text_date_key(text: str | Column) -> Column:
    """ISO date text as the integer yyyymmdd."""
    return F.replace(col(text), F.lit("-"), F.lit("")).try_cast("int")


def zero_padded(number: str | Column, width: int) -> Column:
    """The number with leading zeros up to ``width`` digits; longer numbers keep all of theirs."""
    digits = col(number).cast("string")
    return F.lpad(digits, F.greatest(F.lit(width), F.length(digits)), F.lit("0"))


def case_of(value: str | Column, labels: Mapping, default: str | None = None) -> Column:
    """Simple CASE: a label per value."""
    v, out = col(value), None
    for key, label in labels.items():
        out = F.when(v == key, label) if out is None else out.when(v == key, label)
    return out.otherwise(default)


def holds(predicate: Column) -> Column:
    """Two-valued form of a predicate: unknown counts as false, so a split loses no row."""
    return F.coalesce(predicate, F.lit(False))
