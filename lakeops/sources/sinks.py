"""Sinks. Each writes in parallel and replaces or adds whole folders, so a re-run task is harmless."""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.sources.files import move, remove

MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def overwrite_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Managed table replaced together with its schema; with ``path`` the files lie there."""
    writer = df.write.mode("overwrite").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def replaced(df: DataFrame, path: str, **options: str) -> DataFrame:
    """Replace a table folder as a whole and read back what was written."""
    df.write.mode("overwrite").options(**options).parquet(path)
    return df.sparkSession.read.parquet(path)


def key_slices(df: DataFrame, key: str, rows: int) -> list[Column]:
    """Conditions that each hold for about ``rows`` rows, and for all rows of a key at once; every row, also one without a key, meets one."""
    count = max(1, math.ceil(df.count() / rows))
    return [F.pmod(F.xxhash64(key), F.lit(count)) == i for i in range(count)] if count > 1 else [F.lit(True)]


def replaced_in_slices(
    df: DataFrame, path: str, key: str, build: Callable[[DataFrame], DataFrame], rows: int, **options: str
) -> DataFrame:
    """Replace a table folder as a whole by ``build`` of ``df``, built from about ``rows`` rows at a time, all of a key at once.

    For a build that shuffles wide rows but needs only those of a key together: with the shuffle files dropped after each write,
    the disk holds those of one slice. Slices are gathered beside the folder and moved there when all are written.
    """
    spark, gathered = df.sparkSession, f"{path}-{uuid.uuid4().hex}"
    try:
        for held in key_slices(df, key, rows):
            build(df.where(held)).write.mode("append").options(**options).parquet(gathered)
        remove(spark, path)
        if not move(spark, gathered, path):
            raise OSError(f"{gathered} could not be moved to {path}")
    except BaseException:
        remove(spark, gathered)
        raise
    return spark.read.parquet(path)


def append_merged(df: DataFrame, path: str) -> None:
    """Append rows that may carry new columns; read back with schema merging."""
    df.write.mode("append").parquet(path)


def append_aligned(table: DataFrame, rows: DataFrame) -> DataFrame:
    """Union by column name; a column missing on one side is null there."""
    return table.unionByName(rows, allowMissingColumns=True)


def _spread(df: DataFrame, partition_cols: list[str]) -> DataFrame:
    """Rows of a folder together, so it gets few files; AQE splits a hot folder by size."""
    return df.hint("rebalance", *[F.col(c) for c in partition_cols])


def write_partitioned(
    df: DataFrame, path: str, partition_cols: list[str], mode: str = "append", spread: bool = True
) -> None:
    """Partition folders. ``spread=False`` writes without a shuffle, for rows that go into few folders anyway."""
    rows = _spread(df, partition_cols) if spread else df
    rows.write.mode(mode).partitionBy(*partition_cols).parquet(path)


def overwrite_partitions(df: DataFrame, path: str, partition_cols: list[str], spread: bool = True) -> None:
    """Replace only the partitions present in ``df``; all others stay as they are."""
    rows = _spread(df, partition_cols) if spread else df
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_cols)
        .parquet(path)
    )


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int) -> DataFrame:
    """Rows in ``buckets`` files by a hash of the key, each sorted by it, read back so that joins on the key need no shuffle.

    Choose the number so that a bucket fits a task, and the same for tables that are joined. The table's entry in the catalog is
    dropped again, the files stay.
    """
    name = f"bucketed_{uuid.uuid4().hex}"
    rows = df.repartition(buckets, key)
    rows.write.mode("overwrite").option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    written = df.sparkSession.table(name)
    written.schema  # resolved before the entry goes
    drop_table(df.sparkSession, name)
    return written


def replace_slice(df: DataFrame, path: str, slice_col: str, value: object, spread: bool = False) -> None:
    """Replace one partition of a table partitioned by ``slice_col`` by the rows of ``df`` that belong to it, also by none.

    Spark names the folder: rows are written by a dynamic overwrite, and an emptied slice is found through the files that hold
    its rows. A table that does not exist yet is created, empty if need be.
    """
    here = F.col(slice_col) == F.lit(value).cast(df.schema[slice_col].dataType)
    rows = df.where(here)
    if not rows.isEmpty():
        overwrite_partitions(rows, path, [slice_col], spread)
        return
    try:
        old = df.sparkSession.read.schema(df.schema).parquet(path).where(here)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        rows.write.partitionBy(slice_col).parquet(path)
        return
    folder = F.regexp_replace("_metadata.file_path", "/[^/]*$", "").alias("folder")
    for row in old.select(folder).distinct().collect():  # one folder: the slice's
        rows.drop(slice_col).write.mode("overwrite").parquet(unquote(row["folder"]))


def write_json_batch(df: DataFrame, path: str, files: int | None = None) -> None:
    """One JSON-lines batch folder, times with microseconds; ``files=1`` only for small landing batches."""
    writer = (df.coalesce(files) if files else df).write.mode("append")
    writer.option("timestampNTZFormat", MICROS).option("timestampFormat", f"{MICROS}XXX").json(path)


def create_table_if_missing(spark: SparkSession, name: str, ddl: str, partition_cols: list[str] | None = None) -> None:
    parts = f" PARTITIONED BY ({', '.join(partition_cols)})" if partition_cols else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING PARQUET{parts}")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def reload_table(df: DataFrame, name: str) -> None:
    """Truncate and insert: the table keeps its definition, only the rows are replaced."""
    columns = df.sparkSession.table(name).columns
    df.select(*columns).write.mode("overwrite").insertInto(name)


def publish_views(df: DataFrame, name: str, shared: bool = False) -> None:
    """Session view, or one that every session of the application sees under ``global_temp``."""
    df.createOrReplaceGlobalTempView(name) if shared else df.createOrReplaceTempView(name)


def log_run(spark: SparkSession, table: str, batch_date: str, stage: str, status: str, row_count: int) -> None:
    """Append one row to the control table, creating it on first use."""
    row = spark.createDataFrame(
        [(batch_date, stage, status, row_count)], "batch_date string, stage string, status string, row_count long"
    ).withColumn("run_ts", F.current_timestamp())
    row.write.mode("append").saveAsTable(table)


def already_done(spark: SparkSession, table: str, batch_date: str, stage: str) -> bool:
    """Whether the control table holds a successful run of this stage for the batch."""
    if not spark.catalog.tableExists(table):
        return False
    done = spark.table(table).filter(
        (F.col("batch_date") == batch_date) & (F.col("stage") == stage) & (F.col("status") == "SUCCESS")
    )
    return not done.isEmpty()
