"""Registry of queries and the SQL that states their results."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The Parquet tables of one folder as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def plain(df: DataFrame) -> DataFrame:
    """Result types that do not depend on the engine: whole numbers as bigint, decimals as double."""
    whole = (T.ByteType, T.ShortType, T.IntegerType)
    to = {f.name: "bigint" for f in df.schema if isinstance(f.dataType, whole)}
    to |= {f.name: "double" for f in df.schema if isinstance(f.dataType, T.DecimalType)}
    return df.select(*[F.col(c).cast(to[c]).alias(c) if c in to else F.col(c) for c in df.columns])


def query(name: str, sql: str | None = None):
    """Register ``build(tables) -> DataFrame`` under a name, with the equivalent SQL if there is one."""

    def register(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")

        @wraps(build)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return plain(build(Tables(spark, folder)))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def half_up(num: str, den: str, digits: int) -> str:
    """SQL for ``num / den`` rounded half up, by whole-number arithmetic on whole-number operands."""
    top = f"cast({num} as bigint)"
    scaled = f"(2 * abs({top}) * {10**digits} + ({den})) // (2 * ({den}))"
    return f"cast(sign({top}) * ({scaled}) as double) / {10**digits}"


def mean_cents(total: str, count: str) -> str:
    """SQL for the mean of a money total, rounded half up to cents."""
    return f"cast(sign({total}) * ((2 * cast(abs({total}) * 100 as bigint) + ({count})) // (2 * ({count}))) as double) / 100"
