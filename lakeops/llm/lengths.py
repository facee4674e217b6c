"""Exact token counts from a histogram of document lengths.

Documents are encoded once and reduced to (length, number of documents); running sums over that small table then answer
totals, quantiles and truncated totals for every context limit without touching a document again. Sums run within buckets of
lengths plus the totals of the buckets beyond, so no single task sees all lengths.

Defined cases: null and empty texts have length ``added`` (ids appended to each document, 0 by default); repeated rows count
each time; an empty table gives an empty histogram, null quantiles and a total of zero.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeops.llm.tokens import blocks, encoder
from lakeops.session import stored

BUCKET = 4096


def _lengths(path: str, added: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = encoder(path)
        for batch in batches:
            for texts in blocks(batch.column(0)):
                yield pa.record_batch([pa.array(tokenizer.arrays(texts)[0] + added, pa.int64())], names=["n_tokens"])

    return run


def token_lengths(docs: DataFrame, tokenizer: str, text: str = "text", added: int = 0) -> DataFrame:
    """(n_tokens, docs): how many documents have each encoded length."""
    texts = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text"))
    return texts.mapInArrow(_lengths(tokenizer, added), "n_tokens bigint").groupBy("n_tokens").agg(F.count(F.lit(1)).alias("docs"))


def length_histogram(lengths: DataFrame) -> DataFrame:
    """One row per length with, for that length as the limit: documents and tokens at or above it, documents and tokens
    below it, and the tokens that stay when every document is cut to it."""
    rows = stored(lengths.withColumn("tokens", F.col("docs") * F.col("n_tokens")).withColumn("bucket", F.expr(f"n_tokens div {BUCKET}")), "lengths")
    totals = rows.groupBy("bucket").agg(F.sum("docs").alias("d"), F.sum("tokens").alias("t"))
    beyond = Window.orderBy(F.col("bucket").desc()).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = totals.select("bucket", *[F.coalesce(F.sum(c).over(w), F.lit(0)).alias(n) for c, w, n in (
        ("d", beyond, "docs_beyond"), ("t", beyond, "tokens_beyond"), ("d", before, "docs_before"), ("t", before, "tokens_before"))])
    up = Window.partitionBy("bucket").orderBy(F.col("n_tokens").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    down = Window.partitionBy("bucket").orderBy("n_tokens").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.join(sums, "bucket")
    placed = placed.select(
        "n_tokens", "docs",
        (F.col("docs_beyond") + F.sum("docs").over(up)).alias("docs_at_least"),
        (F.col("tokens_beyond") + F.sum("tokens").over(up)).alias("tokens_at_least"),
        (F.col("docs_before") + F.coalesce(F.sum("docs").over(down), F.lit(0))).alias("docs_below"),
        (F.col("tokens_before") + F.coalesce(F.sum("tokens").over(down), F.lit(0))).alias("tokens_below"),
    )
    return placed.withColumn("truncated_tokens", F.col("tokens_below") + F.col("n_tokens") * F.col("docs_at_least"))


def truncated_total(histogram: DataFrame, limit: int) -> DataFrame:
    """One row: the tokens left when every document is cut to ``limit`` ids, and the documents that are cut."""
    return histogram.agg(
        F.coalesce(F.sum(F.col("docs") * F.least("n_tokens", F.lit(limit))), F.lit(0)).alias("tokens"),
        F.coalesce(F.sum(F.when(F.col("n_tokens") > limit, F.col("docs"))), F.lit(0)).alias("docs_cut"),
    )


def quantiles(histogram: DataFrame, shares: list[float]) -> DataFrame:
    """One row: the smallest length that at least each share of the documents does not exceed."""
    enough = [F.min(F.when(F.col("docs_below") + F.col("docs") >= F.lit(q) * (F.col("docs_below") + F.col("docs_at_least")), F.col("n_tokens"))) for q in shares]
    return histogram.agg(*[c.alias(f"q{q:g}") for c, q in zip(enough, shares, strict=True)])
