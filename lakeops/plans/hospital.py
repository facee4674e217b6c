"""Hospital star and its reports: department KPIs, readmissions, bed census, diagnosis mix, risk."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.functions.scalars import age_band, holds, money, percent, year_boundaries
from lakeops.operators.joins import broadcast_join, followed_within, interval_census
from lakeops.operators.ordered import HOT_ROWS, surrogate_key, windowed
from lakeops.sources.readers import read_if_present
from lakeops.sources.sinks import replaced


def department_dim(departments: DataFrame) -> DataFrame:
    return surrogate_key(departments, ["department_id"], "department_key")


def doctor_dim(doctors: DataFrame, departments: DataFrame) -> DataFrame:
    """Doctors of known departments, with their own and the department's key."""
    placed = doctors.join(departments.select("department_id", "department_key"), "department_id")
    return surrogate_key(placed.drop("department_id"), ["doctor_id"], "doctor_key")


def patient_dim(patients: DataFrame, at: str = "2026-01-01") -> DataFrame:
    """Patients with a dense key and the age band on a day."""
    years = year_boundaries(F.to_date("birth_date"), F.lit(at).cast("date"))
    banded = patients.withColumn("age_band", age_band(years))
    return surrogate_key(banded, ["patient_id"], "patient_key")


def fact_admissions(
    admissions: DataFrame, patients: DataFrame | None, doctors: DataFrame | None, departments: DataFrame | None
) -> DataFrame:
    """Admissions with the keys of the dimensions given, stay length and exact charges. Small dimensions are broadcast."""
    keyed, keys = admissions, []
    for member, dim in (("patient", patients), ("doctor", doctors), ("department", departments)):
        if dim is not None:
            keyed = broadcast_join(keyed, dim.select(f"{member}_id", f"{member}_key"), f"{member}_id")
            keys.append(f"{member}_key")
    return keyed.select(
        F.col("admission_id").alias("admission_key"),
        *keys,
        F.to_date("admit_date").alias("admit_date"),
        F.to_date("discharge_date").alias("discharge_date"),
        F.datediff("discharge_date", "admit_date").alias("length_of_stay"),
        "diagnosis_group",
        F.coalesce("is_emergency", F.lit(False)).alias("is_emergency"),
        money("total_charges", 14, 2).alias("total_charges"),
    )


def load_star(
    spark: SparkSession, root: str, departments: DataFrame, doctors: DataFrame, patients: DataFrame, admissions: DataFrame
) -> DataFrame:
    """Reload the whole star under ``root`` and append one row per table to its run log; returns the log.

    Keys depend on the members alone, so a second load of the same sources gives the same tables.
    """
    log_path = f"{root}/run_log"

    def load(step: str, df: DataFrame) -> DataFrame:
        table = replaced(df, f"{root}/{step}")
        log = read_if_present(spark, log_path)
        last = log.agg(F.max("run_id")).first()[0] if log is not None else 0
        row = table.agg(F.count(F.lit(1)).alias("rows_affected")).select(
            F.lit(last + 1).alias("run_id"), F.lit(step).alias("step"), F.current_timestamp().alias("logged_at"),
            "rows_affected",
        )
        row.write.mode("append").parquet(log_path)
        return table

    department = load("dim_department", department_dim(departments))
    doctor = load("dim_doctor", doctor_dim(doctors, department))
    patient = load("dim_patient", patient_dim(patients))
    load("fact_admission", fact_admissions(admissions, patient, doctor, department))
    return spark.read.parquet(log_path)


def department_kpis(fact: DataFrame, departments: DataFrame) -> DataFrame:
    """Admissions, mean stay, revenue and emergency share per department."""
    n = F.count(F.lit(1))
    per_key = fact.groupBy("department_key").agg(
        n.alias("admissions"),
        F.try_divide(F.sum("length_of_stay"), F.count("length_of_stay")).alias("alos"),
        F.sum("total_charges").alias("revenue"),
        percent(F.count_if("is_emergency"), n).alias("emergency_pct"),
    )
    names = departments.select("department_key", "department_name")
    return per_key.join(names, "department_key").drop("department_key")


def readmission_lag(
    stays: DataFrame, patient: str, order_by: list[str], admit: str, discharge: str, days: int = 30,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Flag the later stay when it starts 0..``days`` days after the patient's previous stay ended."""
    seen = windowed(stays, [patient], order_by, lags={"prev_discharge": discharge}, hot_rows=hot_rows)
    gap = F.datediff(admit, "prev_discharge")
    return seen.withColumn("is_readmission", holds(gap.between(0, days)))


def readmission_rate(flagged: DataFrame, group: str) -> DataFrame:
    """Admissions, readmissions and their share per group."""
    n, hits = F.count(F.lit(1)), F.count_if("is_readmission")
    return flagged.groupBy(group).agg(
        n.alias("admissions"), hits.alias("readmits_30d"), percent(hits, n).alias("readmit_rate_pct")
    )


def bed_census(
    stays: DataFrame, departments: DataFrame, key: str, first: Column, last: Column,
    admit: str = "admit_date", discharge: str = "discharge_date",
) -> DataFrame:
    """In-patients and occupied share per department and day, days without patients included."""
    present = interval_census(stays, departments, key, admit, discharge, first, last, "in_patients")
    return present.join(departments, key).withColumn("occupancy_pct", percent("in_patients", "beds"))


def diagnosis_mix(fact: DataFrame, patients: DataFrame) -> DataFrame:
    """Admissions and mean charge per age band, insurance and diagnosis."""
    groups = patients.select("patient_key", "age_band", "insurance_type")
    return (
        fact.join(groups, "patient_key")
        .groupBy("age_band", "insurance_type", "diagnosis_group")
        .agg(F.count(F.lit(1)).alias("admissions"), F.avg("total_charges").alias("avg_charge"))
    )


def readmitted_after(admissions: DataFrame, days: int = 30) -> DataFrame:
    """Flag the earlier stay when the patient has a stay starting 1..``days`` days after its end."""
    return followed_within(
        admissions, "patient_id", "admit_date", "discharge_date", days, "is_readmission_within_30d"
    )


def readmission_risk(flagged: DataFrame, patients: DataFrame) -> DataFrame:
    """Per patient: stays, readmissions, mean stay, and the risk flag."""
    totals = flagged.groupBy("patient_id").agg(
        F.count(F.lit(1)).alias("total_admissions"),
        F.count_if("is_readmission_within_30d").alias("readmissions_within_30d"),
        F.try_divide(F.sum("length_of_stay_days"), F.count("length_of_stay_days")).alias("avg_length_of_stay"),
    )
    chronic_often = F.col("has_chronic_condition") & (F.col("total_admissions") >= 3)
    return totals.join(patients.select("patient_id", "age", "has_chronic_condition"), "patient_id").withColumn(
        "readmission_risk_flag", (F.col("readmissions_within_30d") >= 1) | chronic_often
    )


def ward_daily(admissions: DataFrame) -> DataFrame:
    """Admissions and mean stay per ward and admission day."""
    return admissions.groupBy("ward", "admit_date").agg(
        F.count(F.lit(1)).alias("admissions_that_day"),
        F.try_divide(F.sum("length_of_stay_days"), F.count("length_of_stay_days")).alias("avg_length_of_stay"),
    )
