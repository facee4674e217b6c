"""Patient visits: cleaning, ranking, department reports, insurance records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.operators.clean import dedup, fill, null_out
from lakeops.operators.joins import broadcast_join
from lakeops.operators.ordered import HOT_ROWS, dense_rank_by, sequence_and_gaps
from lakeops.session import stored
from lakeops.sources.readers import flatten_json

SCHEMA = T.StructType([
    T.StructField("patient_id", T.StringType()),
    T.StructField("visit_date", T.DateType()),
    T.StructField("department", T.StringType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("diagnosis_code", T.StringType()),
])

INSURANCE_SCHEMA = T.StructType([
    T.StructField("patient_id", T.StringType()),
    T.StructField("insurance", T.StructType([
        T.StructField("policy_no", T.StringType()),
        T.StructField("provider", T.StringType()),
    ])),
    T.StructField("procedures", T.ArrayType(T.StringType())),
])


def clean_visits(visits: DataFrame) -> DataFrame:
    """One row per patient, day and department; department defaulted, impossible ages nulled."""
    known = visits.filter(F.col("patient_id").isNotNull())
    once = dedup(known, ["patient_id", "visit_date", "department"], ["age", "diagnosis_code"], keep="first")
    return null_out(fill(once, {"department": "UNKNOWN"}), "age", F.col("age") < 0)


def ranked_visits(clean: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Visit number, days since the previous visit, and rank of the age within the department.

    The cleaned visits are stored, since both steps look at them more than once. A department has few
    distinct ages, so their ranks need no cutting.
    """
    order = ["visit_date", "department", "diagnosis_code"]
    numbered = sequence_and_gaps(stored(clean), ["patient_id"], order, "visit_date", hot_rows=hot_rows)
    return dense_rank_by(numbered, ["department"], "age", "dept_rank_by_age", hot_rows=None)


def enrich(clean: DataFrame, departments: DataFrame) -> DataFrame:
    return broadcast_join(clean, departments, "department", "left")


def insurance_rows(records: DataFrame) -> DataFrame:
    """One row per procedure with the insurer; records without procedures keep one row."""
    fields = {"insurance_provider": "insurance.provider", "policy_no": "insurance.policy_no"}
    return flatten_json(records, ["patient_id"], fields, "procedures", "procedure")


def uninsured(clean: DataFrame, insured: DataFrame) -> DataFrame:
    return clean.join(insured.select("patient_id"), "patient_id", "left_anti")


def department_counts(visits: DataFrame) -> DataFrame:
    return visits.groupBy("department").agg(F.count(F.lit(1)).alias("visit_count"))


def high_risk(visits: DataFrame, age: int = 65) -> DataFrame:
    return visits.filter(f"age >= {int(age)}")


