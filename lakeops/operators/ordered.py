"""Ordered analytics per key: sequence numbers, lags, running totals, dense ranks, surrogate keys.

A plain window gathers all rows of a key in one task. Where some key is too large for that, the rows are range-partitioned by
(key, order) instead, by bounds that Spark samples from the columns themselves, so a key is cut into as many blocks as it
needs, whatever the types and however many such keys there are. The window runs per block, and a table of the keys that
cross a block's edge, at most two rows per block, carries the count, the total and the last value over to the next block.
The result is the same as that of the plain window.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeops.session import stored

# A key with fewer rows than this is never cut: one task sorts that many without trouble.
HOT_ROWS = 5_000_000
# Blocks smaller than ``HOT_ROWS`` are made no more than this: each costs a task, and the driver samples rows for its bounds.
SMALL_BLOCKS = 200


@dataclass
class Blocks:
    """A DataFrame and the columns that number its blocks; no columns if no key had to be cut."""

    df: DataFrame
    cols: list[str] = field(default_factory=list)


def rows_if_hot(df: DataFrame, keys: list[str], hot_rows: int) -> int:
    """The number of rows if some key has at least ``hot_rows``, else 0. Reads the key columns, counts are combined map-side."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    row = counts.agg(F.max("_n").alias("most"), F.sum("_n").alias("rows")).first()
    return row["rows"] if (row["most"] or 0) >= hot_rows else 0


def cut_blocks(df: DataFrame, keys: list[str], order_by: list[str], hot_rows: int | None = HOT_ROWS) -> Blocks:
    """Blocks of about ``hot_rows`` rows that rise along (key, order); without hot keys nothing changes.

    A small ``hot_rows`` cuts into at most ``SMALL_BLOCKS``, or as many as keep a block at ``HOT_ROWS`` rows.
    The blocks are written down, since later passes must see the same ones. ``hot_rows=None`` skips the count, for keys whose
    number of rows is bounded by their meaning.
    """
    rows = rows_if_hot(df, keys, hot_rows) if hot_rows is not None else 0
    if not rows:
        return Blocks(df)
    count = min(math.ceil(rows / hot_rows), max(SMALL_BLOCKS, math.ceil(rows / HOT_ROWS)))
    ranged = df.repartitionByRange(count, *keys, *order_by)
    return Blocks(stored(ranged.withColumn("_block", F.spark_partition_id()), "blocks"), ["_block"])


def windowed(
    df: DataFrame,
    keys: list[str],
    order_by: list[str],
    number: str | None = None,
    lags: Mapping[str, str] | None = None,
    sums: Mapping[str, str] | None = None,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Sequence number, previous value and running total per key, ascending along ``order_by``.

    ``lags`` and ``sums`` map an output name to its source column. ``order_by`` should identify a row within
    its key, otherwise equal rows are numbered in any order. With hot keys the input is read more than once,
    so it must give the same rows each time: store it first if it is expensive or not deterministic.
    """
    lags, sums = dict(lags or {}), dict(sums or {})
    cut = cut_blocks(df, keys, order_by, hot_rows)
    within = Window.partitionBy(*keys, *cut.cols).orderBy(*order_by)
    to_here = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    new = {
        "_rn": F.row_number().over(within).cast("bigint"),
        **{out: F.lag(c).over(within) for out, c in lags.items()},
        **{out: F.sum(c).over(to_here) for out, c in sums.items()},
    }
    result = cut.df.withColumns(new)
    if cut.cols:
        result = _carry(result, cut, keys, order_by, lags, sums)
    result = result.withColumn(number, F.col("_rn")) if number else result
    wanted = [c for c in (number, *lags, *sums) if c]
    return result.select(*df.columns, *wanted)


def _carry(
    part: DataFrame, cut: Blocks, keys: list[str], order_by: list[str], lags: dict[str, str], sums: dict[str, str]
) -> DataFrame:
    """Add what the earlier blocks of a key contribute to each of its blocks."""
    last_row, key, marks = F.struct(*order_by), F.struct(*keys), [*keys, *cut.cols]
    edges = cut.df.groupBy(*cut.cols).agg(F.array(F.min(key), F.max(key)).alias("_e")).select(F.explode("_e").alias("_e")).distinct()
    edges = F.broadcast(edges.select(*[F.col("_e")[k].alias(f"_e_{k}") for k in keys]))
    crossing = cut.df.join(edges, [F.col(k).eqNullSafe(F.col(f"_e_{k}")) for k in keys], "left_semi")
    ends = crossing.groupBy(*marks).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.sum(c).alias(f"_s_{out}") for out, c in sums.items()],
        *[F.max_by(F.struct(F.col(c).alias("v")), last_row).alias(f"_l_{out}") for out, c in lags.items()],
    )
    along = Window.partitionBy(*keys).orderBy(*cut.cols)
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(
        *[F.col(m).alias(f"_k_{m}") for m in marks],
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n0"),
        *[F.sum(f"_s_{out}").over(before).alias(f"_s0_{out}") for out in sums],
        *[F.lag(f"_l_{out}").over(along).alias(f"_l0_{out}") for out in lags],
    ).filter("_n0 > 0")
    carried = F.broadcast(carried)
    same = [F.col(m).eqNullSafe(F.col(f"_k_{m}")) for m in marks]
    joined = part.join(carried, same, "left")
    fixed = {
        **{
            out: F.when(F.col("_rn") == 1, F.col(f"_l0_{out}.v")).otherwise(F.col(out)) for out in lags
        },
        **{
            out: F.when(F.col(out).isNull(), F.col(f"_s0_{out}")).otherwise(
                F.col(out) + F.coalesce(F.col(f"_s0_{out}"), F.lit(0).cast(part.schema[out].dataType))
            )
            for out in sums
        },
    }
    return joined.withColumns(fixed).withColumn("_rn", F.col("_rn") + F.coalesce("_n0", F.lit(0)))


def sequence_and_gaps(
    df: DataFrame, entity: list[str], order_by: list[str], day: str, hot_rows: int | None = HOT_ROWS
) -> DataFrame:
    """Visit number and days since the previous visit of the same entity."""
    seen = windowed(df, entity, order_by, number="visit_number", lags={"_prev": day}, hot_rows=hot_rows)
    return seen.withColumn("days_since_prev", F.datediff(day, "_prev")).drop("_prev")


def dense_rank_by(
    df: DataFrame, group: list[str], measure: str, out: str, descending: bool = True, hot_rows: int | None = HOT_ROWS
) -> DataFrame:
    """Dense rank of ``measure`` within its group; nulls rank last when descending, first when ascending.

    The rank depends only on the distinct values, so these are numbered (repeats collapse map-side) and the
    numbers joined back. They are stored once where several passes need them, which is unless ``hot_rows`` is
    None. The descending rank is the ascending one counted from the group's last level.
    """
    levels = df.select(*group, measure).distinct()
    levels = levels if hot_rows is None else stored(levels, "levels")
    numbered = windowed(levels, group, [measure], number=out, hot_rows=hot_rows)
    if descending:
        sizes = levels.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"))
        sizes = sizes.select(*[F.col(g).alias(f"_g_{g}") for g in group], "_n")
        inside = [F.col(g).eqNullSafe(F.col(f"_g_{g}")) for g in group]
        numbered = numbered.join(sizes, inside).withColumn(out, F.col("_n") + 1 - F.col(out))
    marks = [*group, measure]
    ranks = numbered.select(*[F.col(m).alias(f"_k_{m}") for m in marks], out)
    same = [F.col(m).eqNullSafe(F.col(f"_k_{m}")) for m in marks]
    return df.join(ranks, same, "left").select(*df.columns, out)


def surrogate_key(df: DataFrame, order_by: list[str], out: str) -> DataFrame:
    """Dense keys 1..N in the order of ``order_by``, exactly those of a global ``row_number``.

    The rows are range-partitioned and sorted in parallel and written to the shared folder with their
    position; each partition then only needs the row count of those before it. ``order_by`` must be unique.
    """
    position = F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33)
    laid_out = stored(
        df.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_pos", position)
    )
    sizes = laid_out.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition, so the unpartitioned window is small at any data size.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    keyed = laid_out.join(F.broadcast(offsets), "_part")
    return keyed.withColumn(out, F.col("_before") + F.col("_pos") + 1).select(*df.columns, out)
