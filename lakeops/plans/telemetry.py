"""Machine telemetry: plausible readings, anomalies against the machine's own history, maintenance queue."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.operators.aggregates import anomalies, count_and_grade
from lakeops.operators.quality import quarantine
from lakeops.sources.sinks import replaced
from lakeops.streaming.ingest import append_stream, finish, stream_json

SCORES = {"temperature_c": "temp_zscore", "vibration_mm_s": "vibe_zscore"}
# The least number of anomalies for each priority.
PRIORITIES = {20: "Urgent", 5: "Schedule Soon", 0: "Monitor"}


def plausible(readings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Readings inside the operating envelope, and the rest with the reason."""
    envelope = F.col("temperature_c").between(-20, 150) & F.col("vibration_mm_s").between(0, 50)
    return quarantine(readings, {"outside the operating envelope": envelope})


def anomaly_flags(readings: DataFrame, machines: DataFrame, threshold: float = 2.0) -> DataFrame:
    """Readings above the threshold in either signal, with the machine's description."""
    found = anomalies(readings, "machine_id", SCORES, threshold)
    return found.join(machines.select("machine_id", "machine_type", "line"), "machine_id").select(
        "machine_id", "machine_type", "line", "reading_timestamp", *SCORES, *SCORES.values()
    )


def maintenance_queue(flags: DataFrame) -> DataFrame:
    """Machines by number of anomalies, with the priority that follows from it."""
    machine, n = ["machine_id", "machine_type", "line"], "anomalous_reading_count"
    graded = count_and_grade(flags, machine, n, PRIORITIES, "maintenance_priority", {"last_anomaly_at": F.max("reading_timestamp")})
    return graded.orderBy(F.desc(n), "machine_id")


def run(spark: SparkSession, landing: str, machines: DataFrame, root: str, schema: T.StructType) -> dict[str, DataFrame]:
    """New JSON readings into bronze as a stream, then silver, quarantine and the two gold tables.

    Bronze grows by what the checkpoint has not seen; the later layers are replaced. Returns the written tables.
    """
    arrived = stream_json(spark, landing, schema).withColumn("_ingested_at", F.current_timestamp())
    finish(append_stream(arrived, f"{root}/bronze", f"{root}/_checkpoint"))
    bronze = spark.read.parquet(f"{root}/bronze")
    if isinstance(bronze.schema["reading_timestamp"].dataType, T.StringType):
        bronze = bronze.withColumn("reading_timestamp", F.try_to_timestamp("reading_timestamp"))
    passed, failed = plausible(bronze)
    silver = replaced(passed, f"{root}/silver")
    flags = replaced(anomaly_flags(silver, machines), f"{root}/gold_anomalies")
    return {
        "bronze": bronze,
        "silver": silver,
        "quarantine": replaced(failed, f"{root}/quarantine"),
        "anomalies": flags,
        "maintenance": replaced(maintenance_queue(flags), f"{root}/gold_maintenance"),
    }
