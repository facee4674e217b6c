"""File layout: compaction, z-order clustering, copies, statistics."""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Distinct texts from which the cuts of a text column are taken.
TEXT_SAMPLE = 4096


def compact(spark: SparkSession, source: str, target: str) -> None:
    """Rewrite many small files as few: rows are rebalanced into partitions of the advisory size."""
    spark.read.parquet(source).hint("rebalance").write.mode("overwrite").parquet(target)


def z_value(buckets: list[str], bits: int) -> Column:
    """Bits of the bucket numbers interleaved into one number."""
    out = F.lit(0).cast("long")
    for bit in range(bits):
        for place, name in enumerate(buckets):
            one = F.shiftright(F.col(name), bit).bitwiseAND(F.lit(1)).cast("long")
            out = out.bitwiseOR(F.shiftleft(one, bit * len(buckets) + place))
    return out


def as_number(df: DataFrame, name: str) -> Column:
    """A number, date, time or boolean as a double that rises with it; null sorts lowest, as in Spark's ascending order."""
    kind, c = df.schema[name].dataType, F.col(name)
    if isinstance(kind, T.NumericType | T.BooleanType):
        number = c.cast("double")
    elif isinstance(kind, T.DateType):
        number = F.unix_date(c).cast("double")
    elif isinstance(kind, T.TimestampType):
        number = F.unix_micros(c).cast("double")
    elif isinstance(kind, T.TimestampNTZType):  # by its fields: a session time zone must not shift it
        clock = F.hour(c) * 3600 + F.minute(c) * 60
        number = F.unix_date(c.cast("date")) * 86400.0 + clock + F.date_part(F.lit("SECOND"), c).cast("double")
    else:
        raise TypeError(f"no curve along {name} of type {kind.simpleString()}")
    return F.coalesce(number, F.lit(float("-inf")))


def _number_buckets(df: DataFrame, cols: list[str], parts: int) -> DataFrame:
    """Bucket numbers from approximate quantiles, all columns in one pass; only these few numbers reach the driver."""
    out = df.withColumns({f"_v_{c}": as_number(df, c) for c in cols})
    found = out.approxQuantile([f"_v_{c}" for c in cols], [i / parts for i in range(1, parts)], 1.0 / (4 * parts)) if cols else []
    for c, cuts in zip(cols, found, strict=True):
        edges = [-math.inf, *sorted({v for v in cuts if math.isfinite(v)}), math.inf]
        if len(edges) > 2:
            out = Bucketizer(splits=edges, inputCol=f"_v_{c}", outputCol=f"_q_{c}", handleInvalid="keep").transform(out)
        out = out.withColumn(f"_q_{c}", F.col(f"_q_{c}").cast("int") if len(edges) > 2 else F.lit(0))
    return out


def _text_bucket(df: DataFrame, name: str, parts: int) -> Column:
    """Bucket number of a text among cuts of the whole texts, taken from a bounded sample of the distinct ones."""
    distinct = df.select(F.col(name).alias("t")).where("t IS NOT NULL").distinct().orderBy(F.xxhash64("t")).limit(TEXT_SAMPLE)
    texts = sorted((r["t"] for r in distinct.collect()), key=lambda t: t.encode())
    cuts = sorted({texts[len(texts) * i // parts] for i in range(1, parts)}, key=lambda t: t.encode()) if texts else []
    if not cuts:
        return F.lit(0)
    return F.when(F.col(name).isNull(), 0).otherwise(F.size(F.filter(F.lit(cuts), lambda cut: cut <= F.col(name))))


def with_z_order(df: DataFrame, cols: list[str], bits: int = 6) -> DataFrame:
    """Add ``_z``, the position along a z-curve over the columns' quantiles (for text, quantiles of the distinct values).

    Quantiles keep the curve balanced for any value distribution; only ``2 ** bits`` numbers per column and at most
    ``TEXT_SAMPLE`` texts per text column reach the driver.
    """
    texts = [c for c in cols if isinstance(df.schema[c].dataType, T.StringType)]
    out = _number_buckets(df, [c for c in cols if c not in texts], 2**bits)
    out = out.withColumns({f"_q_{c}": _text_bucket(df, c, 2**bits) for c in texts})
    return out.withColumn("_z", z_value([f"_q_{c}" for c in cols], bits)).select(*df.columns, "_z")


def zorder_write(df: DataFrame, path: str, cols: list[str], bits: int = 6) -> None:
    """Write files whose row groups cover small ranges in every named column, so scans on any of them skip.

    Range partitions are balanced by sampling; the columns themselves follow the curve position, so a
    frequent position is split further.
    """
    curve = with_z_order(df, cols, bits)
    (
        curve.repartitionByRange("_z", *cols)
        .sortWithinPartitions("_z", *cols)
        .drop("_z")
        .write.mode("overwrite")
        .parquet(path)
    )


def copy_table(df: DataFrame, path: str) -> DataFrame:
    """Independent copy of a table as a backup."""
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path)
