"""Cleaning: deterministic deduplication, repairs, defaults."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.functions.scalars import holds


def dedup(df: DataFrame, keys: list[str], order_by: list[str], keep: str = "last") -> DataFrame:
    """One row per key, the first or last in ``order_by``.

    ``order_by`` should end in tie-breaking columns; then the survivor is fixed. The ``= 1`` filter over
    ``row_number`` lets Catalyst keep one candidate per key and map task before the shuffle
    (``WindowGroupLimit``), so a key holding a large share of the rows reaches the reducer as a few rows.
    Text keys are sorted by a hash first: ids with a common prefix are then told apart without comparing text.
    """
    order = [F.col(c).desc() if keep == "last" else F.col(c).asc() for c in order_by]
    by = [*keys]
    if any(isinstance(df.schema[k].dataType, T.StringType) for k in keys):
        df, by = df.withColumn("_hash", F.xxhash64(*keys)), ["_hash", *keys]
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("_rn", rank).filter("_rn = 1").drop("_rn", "_hash")


def distinct_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key where the copies are equal, so it does not matter which one stays."""
    return df.dropDuplicates(keys)


def null_out(df: DataFrame, column: str, invalid: Column) -> DataFrame:
    """Null instead of an invalid value; the row stays."""
    return df.withColumn(column, F.when(~holds(invalid), F.col(column)))


def repair_sign(df: DataFrame, column: str) -> DataFrame:
    """Absolute value where a negative can only be an entry error."""
    return df.withColumn(column, F.abs(column))


def fill(df: DataFrame, defaults: Mapping[str, object] | None = None, numeric: object | None = None) -> DataFrame:
    """Defaults per column, and optionally one value for every numeric column."""
    out = df.fillna(numeric) if numeric is not None else df
    return out.fillna(dict(defaults)) if defaults else out


def tidy_name(column: str) -> Column:
    return F.initcap(F.trim(column))


def non_blank(column: str) -> Column:
    """True for text with at least one visible character."""
    return F.col(column).isNotNull() & (F.trim(column) != "")


def with_typed_null(df: DataFrame, column: str, type_name: str) -> DataFrame:
    return df.withColumn(column, F.lit(None).cast(type_name))
