"""Mixing sources to target weights by Pfair scheduling, in DataFrame operations only.

A source's documents, in id order, are its stream of text; a stream is cut into blocks of ``block_chars`` characters, and a
document belongs to the block in which it begins. One slot of the output takes one block. With integer weights ``w`` that
sum to ``D`` over the sources, the ``i``-th block of a source (from 1) is released at slot ``floor((i-1) * D / w)`` and is due
by slot ``ceil(i * D / w)``. Earliest deadline first among released blocks then keeps each source, after any number of
slots, within less than one block of its target share.

The schedule repeats every ``D`` slots, so one cycle is scheduled and used for all. In cycle ``q`` a source with ``n``
blocks takes part with ``min(w, n - q * w)`` blocks: sources that end leave, and the others share their slots by their own
weights. All rows are kept; a shorter source is neither repeated nor a longer one cut. Cycles of the same members are one kind;
each kind's members meet at least one block each, so the schedules of all kinds have no more rows than there are blocks.

Earliest deadline first is found for all slots at once, by halving: the jobs of a cycle are numbered by (deadline, source). The
upper half of the numbers runs as if alone, so running sums tell which slots it takes and how many of them lie before a
release; the lower half has the other slots. Both halves are schedules of the same form over their own slots, and after as
many halvings as the number of jobs has bits each slot is left with one job. A cycle's rows are shuffled once.

Few short schedules meet the documents by a broadcast join, after a count; others are written out cycle by cycle, one row per
block, and joined by (source, block in cycle, cycle).

Order: (slot, doc_id). Defined cases: null and empty texts take no characters; null ids come first; a null source is a source
of its own; sources without a weight get ``default``; weights below one raise ValueError; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.session import stored

BLOCK_CHARS = 65_536
# Schedules of up to so many rows and kinds of cycles are broadcast; the results do not depend on it.
BROADCAST_ROWS = 100_000
BROADCAST_KINDS = 64
# Cycles written out at once.
CYCLES = 4096


def _weight(weights: dict[str, int], default: int) -> Column:
    out = F.lit(default)
    for name, weight in weights.items():
        out = F.when(F.col("source") == name, weight).otherwise(out)
    return out


def _before(rows: DataFrame) -> DataFrame:
    """Characters of the source before each document and in all: sums within range partitions plus the totals of others.

    Rows are range-partitioned by (source, doc_id), so a hot source spans many partitions; the partition of each row is
    written down, as later passes must see the same one.
    """
    ranged = stored(rows.repartitionByRange("source", "doc_id").withColumn("part", F.spark_partition_id()), "ranges")
    totals = ranged.groupBy("source", "part").agg(F.sum("chars").alias("sum_chars"))
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(
        F.col("source").alias("s"), F.col("part").alias("p"), F.coalesce(F.sum("sum_chars").over(earlier), F.lit(0)).alias("base"),
        F.sum("sum_chars").over(Window.partitionBy("source")).alias("all_chars"),
    )
    own = Window.partitionBy("part", "source").orderBy(F.col("doc_id").asc_nulls_first(), "chars").rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumn("local", F.coalesce(F.sum("chars").over(own), F.lit(0)))
    placed = local.join(bases, F.col("source").eqNullSafe(F.col("s")) & (F.col("part") == F.col("p")))
    return placed.select("doc_id", "source", "chars", (F.col("base") + F.col("local")).alias("before"), "all_chars")


def _jobs(sources: DataFrame) -> DataFrame:
    """One row per block (``r``) of each source in each kind of cycle, numbered by deadline.

    With it go the kind's cycles (from_cycle, to_cycle exclusive), its slots and the slots before them. The windows without
    a partition hold one row per kind, at most two for each source.
    """
    ends = sources.selectExpr("source", "weight", "blocks div weight AS whole", "blocks % weight AS rest")
    edges = ends.select(F.explode(F.expr("IF(rest > 0, array(0L, whole, whole + 1), array(0L, whole))")).alias("from_cycle")).distinct()
    by_cycle = Window.orderBy("from_cycle")
    kinds = edges.select((F.row_number().over(by_cycle) - 1).alias("kind"), "from_cycle", F.lead("from_cycle").over(by_cycle).alias("to_cycle"))
    last = ends.join(kinds.select(F.col("from_cycle").alias("whole"), F.col("kind").alias("last")), "whole")
    full = last.where("last > 0").selectExpr("source", "weight AS w", "explode(sequence(0, last - 1)) AS kind")
    members = full.unionByName(last.where("rest > 0").selectExpr("source", "rest AS w", "last AS kind"))
    sizes = members.groupBy("kind").agg(F.sum("w").alias("slots")).join(kinds, "kind")
    earlier = Window.orderBy("from_cycle").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("first_slot", F.coalesce(F.sum(F.expr("slots * (to_cycle - from_cycle)")).over(earlier), F.lit(0)))
    blocks = members.join(sizes, "kind").withColumn("r", F.explode(F.expr("sequence(0L, w - 1)")))
    jobs = blocks.withColumn("released", F.expr("r * slots div w")).withColumn("due", F.expr("((r + 1) * slots + w - 1) div w"))
    number = F.row_number().over(Window.partitionBy("kind").orderBy("due", F.col("source").asc_nulls_first()))
    return jobs.drop("w").withColumn("number", number.cast("bigint") - 1)


def _slots(jobs: DataFrame, halvings: int) -> DataFrame:
    """The job (its number) that earliest deadline first puts into each slot of a kind of cycle.

    Rows are the jobs at their release and the slots at their place; as many as there are jobs. In a node, ``at`` counts
    the node's own slots. Of the upper half's jobs, ``c`` lie before a place; if alone they would have taken
    ``min(c, at - m)`` slots before it, where ``m`` is the greatest release less the jobs released before it.
    """
    both = F.explode(F.array(F.lit(True), F.lit(False))).alias("is_job")
    rows = jobs.select("kind", "number", "released", both).repartition("kind")
    rows = rows.select("kind", "number", "is_job", F.when(F.col("is_job"), F.col("released")).otherwise(F.col("number")).alias("at"), F.lit(0).cast("bigint").alias("node"))
    places = Window.partitionBy("kind", "node").orderBy("at")
    before, until = places.rangeBetween(Window.unboundedPreceding, -1), places.rangeBetween(Window.unboundedPreceding, 0)
    for bit in reversed(range(halvings)):
        upper = F.shiftright("number", bit) % 2 == 0
        ahead = F.col("is_job") & upper
        counted = rows.withColumns({"c": F.count_if(ahead).over(before), "c_too": F.count_if(ahead).over(until)})
        late = F.when(ahead, F.col("at") - F.col("c"))
        busy = counted.withColumns({"m": F.max(late).over(before), "m_too": F.max(late).over(until)})
        # least() passes over nulls: no job before, no slot taken.
        busy = busy.withColumns({"taken": F.least("c", F.col("at") - F.col("m")), "taken_too": F.least("c_too", F.col("at") + 1 - F.col("m_too"))})
        busy = busy.withColumn("up", F.when(F.col("is_job"), upper).otherwise(F.col("taken_too") > F.col("taken")))
        rows = busy.select(
            "kind", "number", "is_job", F.when(F.col("up"), F.col("taken")).otherwise(F.col("at") - F.col("taken")).alias("at"),
            (F.col("node") * 2 + F.when(F.col("up"), 0).otherwise(1)).alias("node"),
        )
    return rows.where("NOT is_job").select("kind", F.col("node").alias("number"), F.col("number").alias("slot_in"))


def _every_cycle(pattern: DataFrame) -> DataFrame:
    """The schedule with a row for each cycle; long runs of cycles are cut and spread before they are written out."""
    runs = pattern.withColumn("run", F.explode(F.expr(f"sequence(from_cycle div {CYCLES}, (to_cycle - 1) div {CYCLES})"))).repartition("s", "r", "run")
    cycles = f"sequence(greatest(from_cycle, run * {CYCLES}), least(to_cycle, (run + 1) * {CYCLES}) - 1)"
    return runs.withColumn("own_cycle", F.explode(F.expr(cycles))).drop("run", "to_cycle")


def schedule(docs: DataFrame, weights: dict[str, int] | None = None, default: int = 1, block_chars: int = BLOCK_CHARS,
             doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """One row per document: doc_id, source, chars, block (from 0), slot, released and due (slots)."""
    if default < 1 or any(w < 1 for w in (weights or {}).values()):
        raise ValueError("weights must be whole numbers from 1")
    narrow = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"), F.col(source).cast("string").alias("source"),
        F.coalesce(F.length(F.col(text)), F.lit(0)).cast("bigint").alias("chars"),
    )
    rows = stored(_before(narrow), "streams")
    weight = _weight(weights or {}, default).cast("bigint").alias("weight")
    count = F.greatest(F.lit(1), F.ceil(F.col("all_chars") / F.lit(block_chars))).cast("bigint").alias("blocks")
    sources = stored(rows.select("source", weight, count).distinct(), "sources")
    jobs = stored(_jobs(sources), "jobs")
    longest = jobs.agg(F.max("slots")).first()[0] or 1
    pattern = jobs.join(_slots(jobs, (longest - 1).bit_length()), ["kind", "number"]).withColumnRenamed("source", "s")
    pattern = stored(pattern.drop("number"), "schedule")
    blocks = rows.select("doc_id", "source", "chars", "before", weight, count)
    blocks = blocks.withColumn("block", F.least(F.expr(f"before div {block_chars}"), F.col("blocks") - 1))
    blocks = blocks.withColumn("cycle", F.expr("block div weight")).withColumn("in_cycle", F.expr("block % weight"))
    size = pattern.agg(F.count("*"), F.max("kind")).first()
    same = F.col("source").eqNullSafe(F.col("s")) & (F.col("in_cycle") == F.col("r"))
    if size[0] <= BROADCAST_ROWS and (size[1] or 0) < BROADCAST_KINDS:
        met = blocks.join(F.broadcast(pattern), same & (F.col("cycle") >= F.col("from_cycle")) & (F.col("cycle") < F.col("to_cycle")))
    else:
        met = blocks.join(_every_cycle(pattern), same & (F.col("cycle") == F.col("own_cycle")))
    start = F.expr("first_slot + (cycle - from_cycle) * slots")
    return met.select(
        "doc_id", "source", "chars", "block", (start + F.col("slot_in")).alias("slot"), (start + F.col("released")).alias("released"), (start + F.col("due")).alias("due")
    )


def mixed(docs: DataFrame, weights: dict[str, int] | None = None, default: int = 1, block_chars: int = BLOCK_CHARS,
          doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """All rows with all their columns, in the order of the schedule: range-partitioned and sorted by (slot, id).

    Rows of one id are placed together, at the smallest of their slots.
    """
    slots = schedule(docs, weights, default, block_chars, doc_id, text, source).groupBy("doc_id").agg(F.min("slot").alias("_slot"))
    slots = slots.withColumnRenamed("doc_id", "_slot_id")
    whole = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("_row"), F.col(doc_id).cast("bigint").alias("_id"))
    placed = whole.join(slots, F.col("_id").eqNullSafe(F.col("_slot_id")))
    return placed.repartitionByRange("_slot", "_id").sortWithinPartitions("_slot", F.col("_id").asc_nulls_first()).select("_row.*")
