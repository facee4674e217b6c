"""Bank transactions: quality rules, currency conversion, monthly and daily summaries, the daily run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.functions.scalars import money, to_usd
from lakeops.operators.changes import new_rows
from lakeops.operators.clean import dedup
from lakeops.operators.joins import fits_broadcast
from lakeops.operators.quality import gate_metrics, quality_gate, quarantine
from lakeops.session import stored
from lakeops.sources.readers import add_lineage, read_or_empty
from lakeops.sources.sinks import already_done, log_run, overwrite_partitions, replace_slice

CURRENCIES = ["USD", "EUR", "GBP", "INR"]

SCHEMA = T.StructType([
    T.StructField("txn_id", T.StringType()),
    T.StructField("account_id", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("currency", T.StringType()),
    T.StructField("txn_ts", T.TimestampType()),
    T.StructField("channel", T.StringType()),
])


def rules() -> dict:
    return {
        "txn_id": F.col("txn_id").isNotNull(),
        "account_id": F.col("account_id").isNotNull(),
        "amount": F.col("amount").isNotNull(),
        "currency": F.col("currency").isin(*CURRENCIES),
        "txn_ts": F.col("txn_ts").isNotNull(),
    }


def conform(valid: DataFrame, tie_break: list[str]) -> DataFrame:
    """One row per transaction with its amount in dollars."""
    return dedup(valid, ["txn_id"], tie_break, keep="first").withColumn("amount_usd", to_usd("amount", "currency"))


def daily_channel(silver: DataFrame) -> DataFrame:
    """Per channel and day: transactions, total, mean and accounts."""
    total, n = F.sum("amount_usd"), F.count(F.lit(1))
    return silver.groupBy("channel", F.to_date("txn_ts").alias("txn_date")).agg(
        n.alias("txn_count"),
        F.round(total, 2).alias("total_amount_usd"),
        F.round(total / n, 2).alias("avg_amount_usd"),
        F.countDistinct("account_id").alias("distinct_accounts"),
    )


def monthly_summary(txns: DataFrame, day: str, group: str) -> DataFrame:
    """Per month and group: rows, total and mean of the known amounts, largest total first."""
    amount = money("amount", 18, 2)
    total, n = F.sum(amount), F.count(F.lit(1))
    return (
        txns.filter(F.col("amount").isNotNull())
        .groupBy(F.date_format(day, "yyyy-MM").alias("txn_month"), group)
        .agg(n.alias("txn_count"), total.alias("total_amount"), F.round(total / n, 2).alias("avg_amount"))
        .orderBy("txn_month", F.desc("total_amount"), group)
    )


def group_rollup(summary: DataFrame, group: str) -> DataFrame:
    """Total per group over all months."""
    return summary.groupBy(group).agg(F.sum("total_amount").alias("group_total"))


def run_day(
    spark: SparkSession, source: str, root: str, control: str, run_date: str, max_share: float = 0.10, again: bool = False
) -> dict:
    """Bronze to gold for one batch date. Every layer replaces what it held of that date, so a re-run adds and leaves nothing.

    ``root`` is a shared folder; ``control`` the name of the run-log table. A batch that is already logged as
    done is skipped unless ``again``. The rows are read from the source once; later steps read what was written.
    """
    if not again and already_done(spark, control, run_date, "gold"):
        return {"batch_date": run_date, "skipped": True}
    date = F.lit(run_date).cast("date")

    raw = add_lineage(spark.read.schema(SCHEMA).option("header", True).option("mode", "PERMISSIVE").csv(source), run_date)
    replace_slice(raw, f"{root}/bronze", "_batch_date", run_date)
    batch = read_or_empty(spark, f"{root}/bronze", raw.schema).filter(F.col("_batch_date") == date)

    valid, rejected = quarantine(batch, rules())
    replace_slice(rejected, f"{root}/quarantine", "_batch_date", run_date)
    counts = quality_gate(gate_metrics(batch, rules()), max_share)
    log_run(spark, control, run_date, "bronze", "SUCCESS", counts["batch_rows"])

    fresh = conform(valid, ["txn_ts", "account_id", "amount", "currency", "channel"])
    silver_path, day = f"{root}/silver", F.to_date("txn_ts").alias("_day")
    earlier = read_or_empty(spark, silver_path, fresh.schema)
    others = earlier.filter(F.col("_batch_date") != date)
    fresh = new_rows(fresh, others, ["txn_id"], fits_broadcast(fresh.select("txn_id")))
    # Stored before the slice is replaced: the new rows, and the days of the rows they replace.
    fresh, old_days = stored(fresh, "fresh"), stored(earlier.filter(F.col("_batch_date") == date).select(day).distinct(), "days")
    replace_slice(fresh, silver_path, "_batch_date", run_date)
    landed = fresh.count()
    log_run(spark, control, run_date, "silver", "SUCCESS", landed)

    # Gold is rebuilt for every day the batch touches or has touched. The span reaches the scan, the days make it exact.
    days = stored(fresh.select(day).union(old_days).distinct(), "touched")
    span = days.agg(F.min("_day").alias("first"), F.max("_day").alias("last")).first()
    near = read_or_empty(spark, silver_path, fresh.schema).filter(
        (F.col("txn_ts") >= F.lit(span["first"]).cast("timestamp"))
        & (F.col("txn_ts") < F.date_add(F.lit(span["last"]).cast("date"), 1).cast("timestamp"))
    )
    gold = daily_channel(near.join(days, F.to_date("txn_ts") == F.col("_day"), "left_semi"))
    gold = stored(gold, "gold")
    if gold.isEmpty():
        replace_slice(gold, f"{root}/gold", "txn_date", span["first"])
    else:
        overwrite_partitions(gold, f"{root}/gold", ["txn_date"])
    # Days that have no rows any more; a batch touches few days.
    for row in days.join(gold, F.col("_day") == F.col("txn_date"), "left_anti").collect():
        replace_slice(gold, f"{root}/gold", "txn_date", row["_day"])
    log_run(spark, control, run_date, "gold", "SUCCESS", landed)
    return {
        "batch_date": run_date,
        "skipped": False,
        "bronze_rows": counts["batch_rows"],
        "silver_rows": landed,
        "quarantined_rows": counts["rejected_rows"],
    }
