"""Joins the DataFrame API does not offer in one call."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.session import stored

BROADCAST_BYTES = 100 * 1024 * 1024


def row_width(df: DataFrame) -> Column:
    """Bytes of a row: eight a plain value, the bytes of a text, the JSON of what is nested."""
    parts = [F.lit(8)]
    for f in df.schema:
        if isinstance(f.dataType, T.StringType | T.BinaryType):
            parts.append(F.octet_length(F.col(f"`{f.name}`")) + 8)
        elif isinstance(f.dataType, T.StructType | T.ArrayType | T.MapType | T.VariantType):
            parts.append(F.octet_length(F.to_json(F.struct(F.col(f"`{f.name}`")))))
        else:
            parts.append(F.lit(8))
    return reduce(add, [F.coalesce(p, F.lit(8)) for p in parts]).cast("long")


def measured_bytes(df: DataFrame) -> int:
    """Size of all rows, from one pass that returns one number; meant for the side expected to be small."""
    return int(df.agg(F.sum(row_width(df))).first()[0] or 0)


def fits_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    return measured_bytes(df) <= max_bytes


def broadcast_join(
    fact: DataFrame, dim: DataFrame, on: str | list[str], how: str = "inner", max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Broadcast ``dim`` only after its rows were measured below ``max_bytes``.

    A larger one is joined without a hint: a shuffled join, where AQE splits skewed partitions.
    """
    return fact.join(F.broadcast(dim) if fits_broadcast(dim, max_bytes) else dim, on, how)


def dim_lookup(
    fact: DataFrame, dim: DataFrame, natural_key: str, surrogate: str, unknown: int = -1
) -> DataFrame:
    """Surrogate key of the dimension member, ``unknown`` where the member is missing. A small dimension is broadcast."""
    member = dim.select(natural_key, F.col(surrogate).alias("_sk"))
    found = broadcast_join(fact, member, natural_key, "left")
    return found.withColumn(surrogate, F.coalesce("_sk", F.lit(unknown))).drop("_sk")


def heavy_keys(df: DataFrame, key: str, share: float) -> DataFrame:
    """Keys holding more than ``share`` of the rows. At most ``1 / share`` keys can, which bounds the result.

    They are counted once, reading the key column only, and stored, since a join looks at them twice.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    cut = counts.agg((F.sum("_n") * F.lit(share)).alias("_cut")).scalar()
    return stored(counts.filter(F.col("_n") > cut).select(key), "hot")


def row_salt(df: DataFrame, buckets: int, by: list[str] | None = None) -> Column:
    """Bucket from columns of the row and the task that reads it.

    Exact copies of a row are spread as far as they lie in different partitions, and a re-run task gives its
    rows the same buckets whatever order it reads them in. ``by`` names the columns to use, so that a scan reads no others;
    by default all but maps.
    """
    cols = by or [f.name for f in df.schema if not isinstance(f.dataType, T.MapType)]
    return F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in cols], F.spark_partition_id()), F.lit(buckets)).cast("int")


def salted_join(fact: DataFrame, dim: DataFrame, on: str, buckets: int = 10, by: list[str] | None = None) -> DataFrame:
    """Inner join with every fact key spread over ``buckets`` and the dimension repeated per bucket."""
    salted = fact.withColumn("_salt", row_salt(fact, buckets, by))
    repeated = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    return salted.join(repeated, [on, "_salt"]).drop("_salt")


def join_salting_hot(
    fact: DataFrame, dim: DataFrame, on: str, hot: DataFrame, buckets: int = 32, how: str = "inner", by: list[str] | None = None
) -> DataFrame:
    """Join that spreads only the hot keys; the dimension is repeated for those keys alone.

    ``how`` is inner or left: repeated dimension rows without a match must not come out. ``hot`` is bounded (see
    :func:`heavy_keys`), so broadcasting it is safe at any data size.
    """
    if how not in ("inner", "left", "leftouter", "left_outer"):
        raise ValueError(f"a salted join cannot be {how}")
    marks = F.broadcast(hot.select(F.col(on), F.lit(True).alias("_hot")))
    salted = fact.join(marks, on, "left").withColumn(
        "_salt", F.when(F.col("_hot") | F.col(on).isNull(), row_salt(fact, buckets, by)).otherwise(0)
    )
    last = F.when(F.col("_hot"), buckets - 1).otherwise(0)
    repeated = dim.join(marks, on, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), last)))
    return salted.drop("_hot").join(repeated.drop("_hot"), [on, "_salt"], how).drop("_salt")


def followed_within(
    stays: DataFrame, key: str, start: str, end: str, days: int, out: str
) -> DataFrame:
    """Whether another stay of the same key starts 1..``days`` days after this stay's end.

    No pairs of stays are built. The start days of a key are reduced to sets per block of ``days`` days
    (at most ``2 * days`` dates per set, map-side combined); each stay then looks into the one set that
    covers its window, so a key with very many stays is spread over its blocks.
    """
    block = F.floor(F.unix_date(start) / F.lit(days)).cast("int")
    starts = (
        stays.select(F.col(key), F.col(start).alias("_day"), F.explode(F.array(block, block - 1)).alias("_block"))
        .filter(F.col(key).isNotNull() & F.col("_day").isNotNull())
        .groupBy(key, "_block")
        .agg(F.collect_set("_day").alias("_days"))
    )
    probe = stays.withColumn("_block", F.floor(F.unix_date(end) / F.lit(days)).cast("int"))
    later = F.exists(
        "_days", lambda d: (d > F.col(end)) & (F.datediff(d, F.col(end)) <= F.lit(days))
    )
    return (
        probe.join(starts, [key, "_block"], "left")
        .withColumn(out, F.coalesce(later, F.lit(False)))
        .select(*stays.columns, out)
    )


def interval_census(
    stays: DataFrame, members: DataFrame, key: str, start: str, end: str, first: Column, last: Column, out: str
) -> DataFrame:
    """Stays present per member and day (``start <= day < end``), zero where there are none.

    Each stay adds one on its start day and takes one away on its end day; the running sum over the days
    is the census. That is two rows per stay whatever its length, combined map-side to one row per member
    and day, and no range join. The window sees one row per day of a member, never its stays.
    """
    step = F.explode(
        F.array(
            F.struct(F.col(start).alias("day"), F.lit(1).alias("change")),
            F.struct(F.col(end).alias("day"), F.lit(-1).alias("change")),
        )
    )
    moves = stays.filter(F.col(end) > F.col(start)).select(key, step.alias("s"))
    moves = moves.select(key, "s.day", "s.change", F.lit(False).alias("_cell"))
    cells = members.select(
        key, F.explode(F.sequence(first, last)).alias("day"), F.lit(0).alias("change"), F.lit(True).alias("_cell")
    )
    daily = (
        moves.unionByName(cells)
        .groupBy(key, "day")
        .agg(F.sum("change").alias("change"), F.bool_or("_cell").alias("_cell"))
    )
    running = F.sum("change").over(Window.partitionBy(key).orderBy("day"))
    return daily.withColumn(out, running).filter("_cell").select(key, "day", out)
