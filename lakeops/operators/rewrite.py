"""Update, delete and replace by any predicate in a folder of Parquet files, rewriting only the files that hold a row it touches.

First the names of the files with such rows are found, reading only the columns of the predicate; then those files are read whole, changed and
written beside the table, and swapped in. A journal names what goes and what comes before anything is removed, so a swap
cut short is completed by the next call or by :func:`finish`. All other files stay as they are, names included.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.functions.scalars import holds
from lakeops.operators.changes import conditional_update, delete_where
from lakeops.sources.files import exists, matching, move, plain_path, remove

STAGED = "_rewrite-"


def touched_files(table: DataFrame, where: Column) -> list[str]:
    """Files with a row that meets the predicate; at most as many names as the table has files."""
    found = table.filter(holds(where)).select(F.col("_metadata.file_path").alias("file")).distinct().collect()
    return sorted(unquote(r["file"]) for r in found)


def _partition_columns(root: str, files: list[str]) -> list[str]:
    """Names of the folders between the table and its files."""
    return [p.split("=", 1)[0] for p in files[0].removeprefix(root).strip("/").split("/")[:-1] if "=" in p] if files else []


def finish(spark: SparkSession, path: str) -> int:
    """Complete or clear away rewrites that were cut short; returns how many were completed."""
    done = 0
    for staging in matching(spark, f"{path}/{STAGED}*"):
        if exists(spark, f"{staging}/journal/_SUCCESS"):
            for row in spark.read.text(f"{staging}/journal").collect():
                remove(spark, row["value"])
            # Partition folders of any depth; a file that was moved already is no longer there.
            for depth in range(12):
                for file in matching(spark, f"{staging}/new{'/*=*' * depth}/part-*"):
                    move(spark, file, f"{path}/{file.split(f'{STAGED}', 1)[1].split('/new/', 1)[1]}")
            done += 1
        remove(spark, staging)
    return done


def rewrite(spark: SparkSession, path: str, where: Column, change: Callable[[DataFrame], DataFrame], added: DataFrame | None = None) -> list[str]:
    """Apply ``change`` to the files that hold a row of ``where`` and add rows to what it gives; returns the files that went."""
    finish(spark, path)
    table = spark.read.parquet(path)
    files = touched_files(table, where)
    names = _partition_columns(plain_path(spark, path), [plain_path(spark, unquote(f)) for f in table.inputFiles()[:1]])
    new = change(spark.read.schema(table.schema).option("basePath", path).parquet(*files)).select(*table.columns) if files else None
    if added is not None:
        extra = added.select(*[F.col(c).cast(table.schema[c].dataType).alias(c) for c in table.columns])
        new = extra if new is None else new.unionByName(extra)
    if new is None:
        return []
    staging = f"{path}/{STAGED}{uuid.uuid4().hex}"
    writer = new.write.partitionBy(*names) if names else new.write
    writer.parquet(f"{staging}/new")
    spark.createDataFrame([(f,) for f in files], "value string").coalesce(1).write.text(f"{staging}/journal")
    finish(spark, path)
    return files


def delete_rows(spark: SparkSession, path: str, where: Column) -> list[str]:
    """SQL DELETE; rows for which the predicate is unknown stay."""
    return rewrite(spark, path, where, lambda rows: delete_where(rows, where))


def update_rows(spark: SparkSession, path: str, where: Column, values: dict[str, Column]) -> list[str]:
    """SQL UPDATE of the rows that meet the predicate."""
    return rewrite(spark, path, where, lambda rows: conditional_update(rows, where, values))


def replace_rows(spark: SparkSession, path: str, where: Column, rows: DataFrame) -> list[str]:
    """Rows that meet the predicate go, the given ones come; all of these must meet it."""
    checked = rows.filter(F.when(holds(where), F.lit(True)).otherwise(F.raise_error(F.lit("a new row is outside the predicate")).cast("boolean")))
    return rewrite(spark, path, where, lambda old: delete_where(old, where), checked)
