"""Comparison of two stored tables that reads only where they differ.

A table is written in folders by a hash of its key, beside a tree of checksums that do not depend on the order of rows: a leaf per
folder, a node over every ``FAN`` nodes below it. Two tables are compared from the root down, following unequal nodes only; the rows of equal
folders are never read, those of unequal ones are joined by key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.operators.changes import CHANGE_TYPE, COMMITTED, VERSION, change_feed
from lakeops.sources.sinks import write_partitioned

FAN = 16
FOLDER = "_bucket"


def row_hash(df: DataFrame, seed: int) -> Column:
    """Hash of all values by column name; a null counts by its place, as the hash functions leave it out."""
    parts = [F.lit(seed)]
    for f in sorted(df.schema, key=lambda f: f.name):
        value = F.col(f"`{f.name}`")
        parts += [value.isNull(), F.to_json(F.struct(value)) if isinstance(f.dataType, T.MapType | T.VariantType) else value]
    return F.xxhash64(*parts)


def checksums(df: DataFrame, depth: int) -> DataFrame:
    """(level, node, n, total, mix) over a table with its folder numbers; level ``depth`` has the folders."""
    sums = [F.count(F.lit(1)).alias("n"), F.sum(row_hash(df.drop(FOLDER), 1).cast("decimal(38,0)")).alias("total"), F.bit_xor(row_hash(df.drop(FOLDER), 2)).alias("mix")]
    leaves = df.groupBy(F.col(FOLDER).alias("leaf")).agg(*sums)
    level = F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("level")
    nodes = leaves.select("*", level).withColumn("node", F.floor(F.col("leaf") / F.pow(F.lit(FAN), F.lit(depth) - F.col("level"))).cast("int"))
    return nodes.groupBy("level", "node").agg(F.sum("n").alias("n"), F.sum("total").cast("decimal(38,0)").alias("total"), F.bit_xor("mix").alias("mix"))


def write_comparable(df: DataFrame, path: str, keys: list[str], depth: int = 2) -> None:
    """The rows in ``FAN ** depth`` folders by a hash of the key, and their checksums."""
    placed = df.withColumn(FOLDER, F.pmod(F.xxhash64(*keys), F.lit(FAN**depth)).cast("int"))
    write_partitioned(placed, f"{path}/rows", [FOLDER], mode="overwrite")
    written = df.sparkSession.read.parquet(f"{path}/rows")
    checksums(written, depth).write.mode("overwrite").partitionBy("level").parquet(f"{path}/checksums")


def unequal_folders(spark: SparkSession, left: str, right: str) -> list[int]:
    """Folders whose checksums differ, found level by level; the driver holds numbers of folders only."""
    sides = [spark.read.parquet(f"{p}/checksums") for p in (left, right)]
    depths = {s.agg(F.max("level")).first()[0] or 0 for s in sides}
    if len(depths) > 1:
        raise ValueError(f"tables written with different depths: {sorted(depths)}")
    nodes = [0]
    for level in range(max(depths) + 1):
        if level:
            nodes = [n * FAN + i for n in nodes for i in range(FAN)]
        a, b = (s.filter((F.col("level") == level) & F.col("node").isin(nodes)).select("node", F.struct("n", "total", "mix").alias(x)) for s, x in zip(sides, "ab", strict=True))
        nodes = sorted(r["node"] for r in a.join(b, "node", "full").filter(~F.col("a").eqNullSafe(F.col("b"))).select("node").collect())
        if not nodes:
            return []
    return nodes


def differences(spark: SparkSession, left: str, right: str, keys: list[str]) -> DataFrame:
    """What turns the left table into the right one, as the rows of a change feed without its version."""
    folders = unequal_folders(spark, left, right)
    a, b = (spark.read.parquet(f"{p}/rows").filter(F.col(FOLDER).isin(folders)).drop(FOLDER) for p in (left, right))
    return change_feed(a, b, keys, 0).drop(VERSION, COMMITTED).withColumnRenamed(CHANGE_TYPE, "difference")
