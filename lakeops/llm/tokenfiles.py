"""Token ids as Parquet list columns.

A token table holds one row per document in ascending document order: its id, the number of its ids, where they start
within the file, and the ids as a list. Ids are dictionary coded (a vocabulary fits a dictionary page), the whole-number
columns delta coded by the version 2 writer; row groups and pages have set sizes, and the footer carries page indexes.
Readers that want lengths, places or single documents read only those columns and pages.

Null texts count as empty. Documents without an id come first. Rows with equal ids keep the order of their texts' bytes;
equal rows are equal output. Very long texts are one row each. An empty table gives no files' rows and no result rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeops.llm.tokens import blocks, encoder
from lakeops.session import scratch

ROW_GROUP_BYTES = 32 * 1024 * 1024
PAGE_BYTES = 256 * 1024


def _encoded(path: str, end_id: int):
    schema = pa.schema([("doc_id", pa.int64()), ("local_start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, place = encoder(path), 0
        for batch in batches:
            at = 0
            for texts in blocks(batch.column(1)):
                counts, ids = tokenizer.arrays(texts)
                ends = np.cumsum(counts + 1)
                values = np.insert(ids, np.cumsum(counts), end_id).astype("<i4", copy=False)
                lists = pa.ListArray.from_arrays(np.concatenate([[0], ends]).astype(np.int32), pa.array(values))
                starts = pa.array(place + ends - counts - 1)
                place += int(ends[-1])
                yield pa.record_batch([batch.column(0).slice(at, len(texts)), starts, pa.array(counts + 1), lists], schema=schema)
                at += len(texts)

    return run


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int, doc_id: str = "doc_id", text: str = "text") -> None:
    """Write the token table of ``docs``. File order, then row order, is document order.

    Texts are range-partitioned by document id (Spark samples the bounds) and sorted before they are encoded, so they are
    encoded once and ids, which take more room than text, are never shuffled.
    """
    narrow = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    ordered = narrow.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    rows = ordered.mapInArrow(_encoded(tokenizer, end_id), "doc_id bigint, local_start bigint, n_tokens bigint, ids array<int>")
    (
        rows.write.option("parquet.writer.version", "v2")
        .option("parquet.enable.dictionary", "false")
        .option("parquet.enable.dictionary#ids.list.element", "true")
        .option("parquet.block.size", str(ROW_GROUP_BYTES))
        .option("parquet.page.size", str(PAGE_BYTES))
        .option("parquet.page.row.count.limit", "1000")
        .option("compression", "zstd")
        .parquet(folder)
    )


def _file() -> Column:
    """Files of one write in partition order: Spark numbers them in their names."""
    return F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("bigint")


def token_metadata(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before it) and n_tokens, without reading any ids.

    The totals of the files before a document's own file are one number per file: a table bounded by the number of files,
    which is broadcast.
    """
    rows = spark.read.parquet(folder).select("doc_id", "local_start", "n_tokens", _file().alias("file"))
    return _placed(rows, rows).select("doc_id", "start", "n_tokens")


def _placed(rows: DataFrame, meta: DataFrame) -> DataFrame:
    totals = meta.groupBy("file").agg(F.sum("n_tokens").alias("file_tokens"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("file", F.coalesce(F.sum("file_tokens").over(before), F.lit(0)).alias("base"))
    return rows.join(F.broadcast(bases), "file").withColumn("start", F.col("base") + F.col("local_start"))


def _checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column(batch.schema.get_field_index("ids"))
        values, offsets = lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False), lists.offsets.to_numpy()
        crc = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        columns = [batch.column(i) for i in range(3)] + [pa.array(offsets[1:] - offsets[:-1], pa.int64()), pa.array(crc, pa.int64())]
        yield pa.record_batch(columns, names=["file", "doc_id", "local_start", "n_tokens", "ids_crc32"])


def read_tokens(spark: SparkSession, folder: str, doc_ids: list[int] | None = None) -> DataFrame:
    """The token table; a list of document ids reads only the row groups and pages that hold them."""
    rows = spark.read.parquet(folder)
    return rows if doc_ids is None else rows.where(F.col("doc_id").isin(doc_ids))


def token_digest(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and the crc32 of the ids, all from the written files; lengths are those of the lists."""
    rows = spark.read.parquet(folder).select(_file().alias("file"), "doc_id", "local_start", "ids")
    read = rows.mapInArrow(_checksums, "file bigint, doc_id bigint, local_start bigint, n_tokens bigint, ids_crc32 bigint")
    meta = spark.read.parquet(folder).select(_file().alias("file"), "n_tokens")
    return _placed(read, meta).select("doc_id", "start", "n_tokens", "ids_crc32")


def token_table(docs: DataFrame, tokenizer: str, end_id: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the token table to a fresh shared folder and give the digest read back from it."""
    folder = scratch(docs.sparkSession, "tokens")
    write_tokens(docs, folder, tokenizer, end_id, doc_id, text)
    return token_digest(docs.sparkSession, folder)
