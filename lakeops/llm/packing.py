"""Best-fit packing of token pieces into sequences of a fixed length, with a bounded number of open sequences.

A packer keeps at most ``OPEN`` sequences open. A bit set marks which amounts of free space an open sequence has. A piece
goes to the open sequence with the least free space that still holds it, found by one shift and one lowest-bit search; if none
does, a new sequence opens, and where ``OPEN`` are open already the fullest closes first. Full sequences close at once.

Each task packs the rows it reads while it reads them. Without an order no row moves; with one, tasks take ranges of it. The
pieces of the sequences a task still has open at its end are packed again, in order, by fewer tasks, and so on until one task
is enough; each round handles only what the one before left open, at most ``OPEN`` sequences a task, so the last task's share
is bounded whatever the input. A sequence is numbered by the place of its first piece, in whichever round it closes.

Defined cases: a null text is empty; an empty text has its end id alone; documents longer than a sequence are cut into whole
sequences and a rest; repeated rows and null ids are packed like any others; an empty table gives an empty result.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.llm.tokens import encoder
from lakeops.session import scratch

OPEN = 512
REPACK_ROWS = 20_000
# Pieces of closed sequences that a task holds before it hands them on.
HELD_ROWS = 20_000
SLICE = 256
# The place of a piece holds the task of the first round and the piece within the task.
PLACE_BITS = 32

PIECE = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, place bigint"
PLACED = f"{PIECE}, sequence_id bigint, offset bigint, closed boolean"
_PIECE_NAMES = ["doc_id", "piece", "start", "length", "ids_crc32", "place"]
_SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
    ("place", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("closed", pa.bool_()),
])


class Packer:
    """Places items online; ``put`` returns the sequences that closed, each as (number, items)."""

    def __init__(self, size: int, open_limit: int = OPEN):
        self.size, self.open_limit = size, open_limit
        self.free = 0  # bit f is set if an open sequence has f free places
        self.by_free: dict[int, list[tuple[int, list]]] = {}
        self.open = self.made = 0

    def _take(self, space: int) -> tuple[int, list]:
        bins = self.by_free[space]
        found = bins.pop()
        if not bins:
            del self.by_free[space]
            self.free &= ~(1 << space)
        self.open -= 1
        return found

    def put(self, length: int, item) -> list[tuple[int, list]]:
        closed = []
        fitting = self.free >> length
        if fitting:
            space = length + (fitting & -fitting).bit_length() - 1
            number, items = self._take(space)
        else:
            if self.open >= self.open_limit:
                closed.append(self._take((self.free & -self.free).bit_length() - 1))
            space, number, items = self.size, self.made, []
            self.made += 1
        items.append((self.size - space, item))
        space -= length
        if space:
            self.by_free.setdefault(space, []).append((number, items))
            self.free |= 1 << space
            self.open += 1
        else:
            closed.append((number, items))
        return closed

    def rest(self) -> list[tuple[int, list]]:
        """The sequences still open, fullest first."""
        return [x for space in sorted(self.by_free) for x in self.by_free[space]]


def _batch(sequences: list[tuple[int, list]], closed: bool) -> pa.RecordBatch:
    """Pieces come by place, so a sequence's first item names it."""
    rows = [(*item, items[0][1][-1], offset, closed) for _, items in sequences for offset, item in items]
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in _SCHEMA]
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, _SCHEMA, strict=True)], schema=_SCHEMA)


def _packed(pieces: Iterator[tuple], size: int, open_limit: int, last: bool) -> Iterator[pa.RecordBatch]:
    """Pack (length, item) pairs; what is open at the end stays open unless this is the last round."""
    packer, closed, held = Packer(size, open_limit), [], 0
    for length, item in pieces:
        for sequence in packer.put(length, item):
            closed.append(sequence)
            held += len(sequence[1])
        if held >= HELD_ROWS:
            yield _batch(closed, True)
            closed, held = [], 0
    yield _batch(closed, True)
    yield _batch(packer.rest(), last)


def _cut(batches: Iterator[pa.RecordBatch], tokenizer: str, end_id: int, size: int) -> Iterator[tuple]:
    """The pieces of each document as (length, row)."""
    encode, end = encoder(tokenizer).encode, np.array([end_id], "<u4").tobytes()
    place = TaskContext.get().partitionId() << PLACE_BITS
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            part = batch.slice(at, SLICE)
            for doc, ids in zip(part.column(0).to_pylist(), encode(part.column(1).to_pylist()), strict=True):
                ids += end
                for piece in range(-(-len(ids) // (4 * size))):
                    own = ids[4 * size * piece : 4 * size * (piece + 1)]
                    yield len(own) // 4, (doc, piece, piece * size, len(own) // 4, zlib.crc32(own), place)
                    place += 1


def _again(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for row in zip(*(batch.column(n).to_pylist() for n in _PIECE_NAMES), strict=True):
            yield row[3], row


def _written(rows: DataFrame, label: str) -> DataFrame:
    """Stored with a folder for what is still open, so the next round reads nothing else."""
    path = scratch(rows.sparkSession, label)
    rows.write.partitionBy("closed").parquet(path)
    return rows.sparkSession.read.schema(PLACED).parquet(path)


def stored_order(docs: DataFrame) -> list[Column]:
    """Sort keys of the rows of a Parquet table as they are stored: Spark numbers the files of a write in their names.

    A plain scan does not keep this order: it hands out files by size, the largest first. Rows that do not come straight
    from files have no such keys; their tasks hold them in partition order. A column of the table named ``_metadata`` is
    not taken for the file's.
    """
    try:
        file = docs.metadataColumn("_metadata")
        docs.select(file["row_index"])
    except AnalysisException:
        return []
    part = F.regexp_extract(file["file_name"], r"part-(\d+)", 1).try_cast("bigint")
    return [part, file["file_path"], file["row_index"]]


def pack(docs: DataFrame, tokenizer: str, end_id: int, size: int = 4096, open_limit: int = OPEN,
         doc_id: str = "doc_id", text: str = "text", order: Sequence[Column] = ()) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Rows are packed by ``order``, and sequence ids ascend with the first piece of a sequence in it; without it, as tasks
    happen to read them.
    """
    keys = [f"key{i}" for i in range(len(order))]
    narrow = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), *(c.alias(k) for c, k in zip(order, keys, strict=True))
    )
    if keys:
        narrow = narrow.repartitionByRange(*keys).sortWithinPartitions(*keys).drop(*keys)

    def first(batches):
        return _packed(_cut(batches, tokenizer, end_id, size), size, open_limit, False)

    rounds = [_written(narrow.mapInArrow(first, PLACED), "packed-0")]
    tasks = sys.maxsize
    while rows := rounds[-1].where(~F.col("closed")).count():
        level, tasks = len(rounds), max(1, min(-(-rows // REPACK_ROWS), tasks // 2))

        def repack(batches, last=tasks == 1):
            return _packed(_again(batches), size, open_limit, last)

        left = rounds[-1].where(~F.col("closed")).select(*_PIECE_NAMES)
        left = (left.repartitionByRange(tasks, "place") if tasks > 1 else left.coalesce(1)).sortWithinPartitions("place")
        rounds.append(_written(left.mapInArrow(repack, PLACED), f"packed-{level}"))
    out = rounds[0].where("closed")
    for more in rounds[1:]:
        out = out.unionByName(more.where("closed"))
    return out.drop("place", "closed")
