"""Exact duplicates by sorting content.

Rows are ordered by (head of the text, digest of the text, text, id). Spark samples splitters of the narrow part of that order
and range-partitions by them, sorts each partition externally, and one pass over the sorted rows compares each text with its
whole neighbour. Because the id is part of the order, a group of copies of any size is spread over as many partitions as it
needs. Only the first run of a partition can continue one of an earlier partition, so the digests with which partitions begin,
one per partition, are enough to put such groups together; they are broadcast.

Of equal texts the row with the largest id stays, or the smallest with ``keep="min"``.

Defined cases: a null text equals an empty one; a null id ranks after all others, so it stays only if its group has no other;
of rows equal in id and text exactly one stays; an empty table gives an empty result; other columns may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.session import stored

HEAD_CHARS = 32
FLUSH_ROWS = 20_000
_RUN_ROWS = pa.schema([
    ("doc_id", pa.int64()), ("keep_id", pa.int64()), ("group_size", pa.int64()), ("kept", pa.bool_()), ("text_sha256", pa.string()),
    ("part", pa.int64()), ("edge", pa.bool_()),
])
_RUN_TYPES = "doc_id bigint, keep_id bigint, group_size bigint, kept boolean, text_sha256 string, part bigint, edge boolean"


def _sorted(rows: DataFrame, keep: str) -> DataFrame:
    """``rows`` has _id and _text. The head bounds the size of the sampled splitters, the digest orders equal heads."""
    order = F.col("_id").desc_nulls_last() if keep == "max" else F.col("_id").asc_nulls_last()
    rows = rows.withColumn("_head", F.substring("_text", 1, HEAD_CHARS)).withColumn("_digest", F.sha2("_text", 256))
    return rows.repartitionByRange("_head", "_digest", order).sortWithinPartitions("_head", "_digest", "_text", order)


def _count_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per row: the first id and the size of its run in this partition. Holds the ids of one run of one partition."""
    part = TaskContext.get().partitionId()
    out: list[list] = [[] for _ in _RUN_ROWS]
    text, digest, ids, edge = None, None, [], True

    def close() -> None:
        n = len(ids)
        run = (ids, [ids[0]] * n, [n] * n, [True] + [False] * (n - 1), [digest] * n, [part] * n, [edge] * n)
        for column, values in zip(out, run, strict=True):
            column.extend(values)

    def flush() -> pa.RecordBatch:
        made = pa.record_batch([pa.array(c, f.type) for c, f in zip(out, _RUN_ROWS, strict=True)], schema=_RUN_ROWS)
        for column in out:
            column.clear()
        return made

    for batch in batches:
        for doc, now, sha in zip(*(batch.column(c).to_pylist() for c in ("_id", "_text", "_digest")), strict=True):
            if now != text:
                if ids:
                    close()
                    edge = False
                    if len(out[0]) >= FLUSH_ROWS:
                        yield flush()
                text, digest, ids = now, sha, []
            ids.append(doc)
    if ids:
        close()
    yield flush()


def _first_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first row of each run, its partition, and whether the partition begins with it."""
    part, text = TaskContext.get().partitionId(), None
    for batch in batches:
        firsts, edge = [], []
        for i, now in enumerate(batch.column("_text").to_pylist()):
            if now != text:
                edge.append(text is None)
                firsts.append(i)
                text = now
        taken = batch.select(["_row", "_digest"]).take(pa.array(firsts, pa.int64()))
        marks = [pa.array([part] * len(firsts), pa.int64()), pa.array(edge, pa.bool_())]
        yield pa.record_batch([*taken.columns, *marks], names=["_row", "_digest", "_part", "_edge"])


def label_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: str = "max") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    narrow = docs.select(F.col(doc_id).cast("bigint").alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    rows = stored(_sorted(narrow, keep).select("_id", "_text", "_digest").mapInArrow(_count_runs, _RUN_TYPES), "copies")
    edges = rows.where("edge AND kept").select("text_sha256").distinct()
    groups = (
        rows.where("kept")
        .join(F.broadcast(edges), "text_sha256")
        .groupBy("text_sha256")
        .agg(F.min("part").alias("lead"), F.min_by("keep_id", "part").alias("lead_id"), F.sum("group_size").alias("total"))
    )
    found = rows.join(F.broadcast(groups), "text_sha256", "left")
    return found.select(
        "doc_id",
        F.when(F.col("lead").isNull(), F.col("keep_id")).otherwise(F.col("lead_id")).alias("keep_id"),
        F.coalesce("total", "group_size").alias("group_size"),
        (F.col("kept") & (F.col("part") == F.coalesce("lead", "part"))).alias("kept"),
        "text_sha256",
    )


def drop_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: str = "max") -> DataFrame:
    """The rows that stay, with all their columns."""
    packed = docs.select(
        F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("_row"), F.col(doc_id).cast("bigint").alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_text")
    )
    kind = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("_row")).schema["_row"].dataType.simpleString()
    firsts = _sorted(packed, keep).select("_row", "_text", "_digest").mapInArrow(
        _first_rows, f"_row {kind}, _digest string, _part bigint, _edge boolean"
    )
    firsts = stored(firsts, "kept")
    edges = firsts.where("_edge").select("_digest").distinct()
    leads = firsts.select("_digest", "_part").join(F.broadcast(edges), "_digest").groupBy("_digest").agg(F.min("_part").alias("_lead"))
    kept = firsts.join(F.broadcast(leads), "_digest", "left").where(F.col("_part") == F.coalesce("_lead", "_part"))
    return kept.select("_row.*")
