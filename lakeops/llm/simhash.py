"""Near duplicates by SimHash, found with the pigeonring filter.

The 64 fingerprint bits are cut into ``max_bits + 1`` segments on a ring. If two fingerprints differ in at most ``max_bits``
bits, there is a segment from which every chain of ``l`` consecutive segments differs in at most ``l * max_bits / (max_bits + 1)``
bits, rounded down to ``l - 1``: the first segment is equal, the first two differ in one bit at most, and so on round the ring.
Candidates therefore meet under a key of one segment and one half of the next (one of its halves must be equal too). Inside a
task they are pruned chain by chain; the last chain is the whole ring, the full distance.

A key shared by very many fingerprints is cut into blocks, and every two of them are compared in a group of their own, so no link is
lost and no task holds more than two blocks of a key.

Equal fingerprints are one row from the start, whatever their number. A task does not give out all links of a group, only a
forest that connects the same fingerprints; components then come from star contraction. Every document keeps its component.

Defined cases: null and empty texts and texts without words have the fingerprint zero, which links like any other; a null id
belongs to its component but never names it (a component of null ids alone has a null id); repeated rows stay; an empty table
gives an empty result; very long texts are hashed in chunks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.llm.components import roots
from lakeops.operators.joins import heavy_keys, join_salting_hot
from lakeops.session import stored

BITS = 64
SEED = 42
CHUNK = 1 << 16
SLICE = 512
HOT_SHARE = 1 / 500
# Rows of a key that one task compares; beyond it pairs of blocks of as many go to tasks of their own.
BLOCK, SALTS = 8192, 16
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: str | None, words: int) -> int:
    """SimHash of the text's word shingles: a bit is set if it is set in over half the shingle hashes."""
    found = (text or "").encode().translate(_LOWER).split()
    if not found:
        return 0
    joined = b" ".join(found)
    if len(found) < words:
        return xxhash.xxh64_intdigest(joined, SEED)
    lengths = np.fromiter(map(len, found), np.int64, len(found))
    ends = np.cumsum(lengths + 1) - 1
    begins = (ends - lengths)[: len(found) - words + 1].tolist()
    ends = ends[words - 1 :].tolist()
    digest, counts = xxhash.xxh64_digest, np.zeros(BITS, np.int64)
    for at in range(0, len(begins), CHUNK):
        hashes = b"".join([digest(joined[a:b], SEED) for a, b in zip(begins[at : at + CHUNK], ends[at : at + CHUNK], strict=True)])
        counts += np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(begins)).tobytes(), "big")


def _fingerprints(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                prints = np.array([fingerprint(t, words) for t in part.column(1).to_pylist()], np.uint64)
                yield pa.record_batch([part.column(0), pa.array(prints.view(np.int64))], names=["doc_id", "fp"])

    return run


def fingerprints(docs: DataFrame, words: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp), fp as a signed 64-bit number."""
    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).mapInArrow(_fingerprints(words), "doc_id bigint, fp bigint")


def segments(max_bits: int) -> list[tuple[int, int]]:
    """(shift, width) of the ring's segments, from the low bits."""
    edges = [BITS * i // (max_bits + 1) for i in range(max_bits + 2)]
    return [(a, b - a) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def _part(shift: int, width: int) -> Column:
    return F.shiftrightunsigned(F.col("fp"), shift).bitwiseAND(F.lit((1 << width) - 1))


def _keys(max_bits: int) -> Column:
    """The keys of a fingerprint: per segment, the segment with either half of the next one."""
    ring, keys = segments(max_bits), []
    for i, (shift, width) in enumerate(ring):
        after, wide = ring[(i + 1) % len(ring)]
        low = wide // 2
        for half, (s, w) in enumerate(((after, low), (after + low, wide - low))):
            value = F.shiftleft(_part(shift, width), w).bitwiseOR(_part(s, w))
            keys.append(F.struct(F.lit(2 * i + half).alias("place"), value.alias("value")))
    return F.array(*keys)


class _Forest:
    """Union-find over the positions of an array, with roots kept current in ``label``."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        parent: dict[int, int] = {}

        def find(x: int) -> int:
            while x in parent:
                x = parent[x]
            return x

        for x, y in zip(self.label[a].tolist(), self.label[b].tolist(), strict=True):
            x, y = find(x), find(y)
            if x != y:
                parent[max(x, y)] = min(x, y)
        if parent:
            to = np.arange(len(self.label))
            for x in parent:
                to[x] = find(x)
            self.label = to[self.label]


def _links(max_bits: int):
    ring = segments(max_bits)
    masks = [np.uint64(((1 << w) - 1) << s) for s, w in ring]

    def linked(a: np.ndarray, b: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Positions of the pairs that pass every chain from the segment their key names; the longest chain is the ring."""
        rows, total = np.arange(len(a)), np.zeros(len(a), np.int64)
        differ, first, table = a ^ b, place // 2, np.array(masks)
        for length in range(1, len(ring) + 1):
            part = differ & table[(first + length - 1) % len(ring)]
            total = total + np.bitwise_count(part)
            keep = total <= length - 1
            rows, differ, first, total = rows[keep], differ[keep], first[keep], total[keep]
        return rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = list(batches)
        if tables:
            table = pa.Table.from_batches(tables)
            place, value, pair, fp = (table.column(c).to_numpy() for c in ("place", "value", "pair", "fp"))
            nodes, at = np.unique(fp, return_inverse=True)
            bits, forest = fp.view(np.uint64), _Forest(len(nodes))
            # Rows come sorted by key. The pairs of a group are met by distance: each row with the next one, the one after, ...
            group = np.cumsum(np.concatenate([[0], (place[1:] != place[:-1]) | (value[1:] != value[:-1]) | (pair[1:] != pair[:-1])]))
            last = np.searchsorted(group, group, side="right") - 1
            rows, step = np.arange(len(fp)), 1
            while len(rows := rows[rows + step <= last[rows]]):
                there = rows + step
                new = forest.label[at[rows]] != forest.label[at[there]]
                a, b = rows[new], there[new]
                hit = linked(bits[a], bits[b], place[a])
                forest.join(at[a[hit]], at[b[hit]])
                step += 1
            moved = forest.label != np.arange(len(nodes))
            yield pa.record_batch([pa.array(nodes[moved]), pa.array(nodes[forest.label[moved]])], names=["u", "v"])

    return run


def _split_hot(keyed: DataFrame, block: int) -> DataFrame:
    """Rows with the group they are compared in: the key's own, or for a key of more than ``block`` rows one per pair of its blocks.

    Rows of a hot key fall into blocks by a hash, and every two blocks meet in a group of their own, so each pair of rows meets in at
    least one group and no task holds more than two blocks of a key.
    """
    counts = keyed.groupBy("place", "value").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block)
    hot = stored(counts.select("place", "value", F.ceil(F.col("n") / block).cast("int").alias("blocks")), "hot")
    whole = keyed.withColumn("pair", F.lit(0).cast("long"))
    if hot.isEmpty():
        return whole
    # A hot key has more than ``block`` rows, so there are few of them beside the rows; salts spread the rows of one key over the join.
    rows, parts = keyed.withColumn("salt", F.pmod(F.xxhash64("fp"), F.lit(SALTS))), hot.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    met = rows.join(parts, ["place", "value", "salt"], "left")
    mine = F.pmod(F.xxhash64("fp", F.lit(1)), F.col("blocks"))
    others = F.filter(F.sequence(F.lit(0).cast("long"), F.col("blocks").cast("long") - 1), lambda c: c != mine)
    # Pairs of one key are numbered from 1.
    pairs = F.transform(others, lambda c: 1 + F.least(c, mine) * F.col("blocks") + F.greatest(c, mine))
    pair = F.explode(F.when(F.col("blocks").isNull(), F.array(F.lit(0).cast("long"))).otherwise(pairs))
    return met.select("place", "value", "fp", pair.alias("pair"))


def fingerprint_components(prints: DataFrame, max_bits: int, block: int = BLOCK) -> DataFrame:
    """(fp, root, component_id) of every distinct fingerprint of ``prints`` (doc_id, fp)."""
    distinct = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    if max_bits < 1:
        return distinct.select("fp", F.col("fp").alias("root"), F.col("least").alias("component_id"))
    keyed = distinct.select("fp", F.explode(_keys(max_bits)).alias("k")).select("k.place", "k.value", "fp")
    grouped = _split_hot(keyed, block).repartition("place", "value", "pair").sortWithinPartitions("place", "value", "pair", "fp")
    found = roots(grouped.mapInArrow(_links(max_bits), "u bigint, v bigint"))
    linked = distinct.join(found, distinct.fp == found.u, "left").select("fp", F.coalesce("root", "fp").alias("root"), "least")
    names = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    return join_salting_hot(linked.select("fp", "root"), names, "root", heavy_keys(linked, "root", HOT_SHARE)).select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, words: int = 4, max_bits: int = 4, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id (least document id reachable by links)."""
    prints = stored(fingerprints(docs, words, doc_id, text), "fingerprints")
    named = fingerprint_components(prints, max_bits).select("fp", "component_id")
    out = join_salting_hot(prints, named, "fp", heavy_keys(prints, "fp", HOT_SHARE))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _numbered(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        next_row = TaskContext.get().partitionId() << 36
        for batch in batches:
            n = batch.num_rows
            prints = np.array([fingerprint(t, words) for t in batch.column("_text").to_pylist()], np.uint64)
            columns = [batch.column("_row"), batch.column("_id"), pa.array(np.arange(next_row, next_row + n)), pa.array(prints.view(np.int64))]
            next_row += n
            yield pa.record_batch(columns, names=["_row", "doc_id", "row", "fp"])

    return run


def keep_representatives(docs: DataFrame, words: int = 4, max_bits: int = 4, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, of which one per component stays: one with its smallest id.

    Rows are numbered when they are stored, so exactly one row stays also where ids repeat or are null.
    """
    whole = F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("_row")
    packed = docs.select(whole, F.col(doc_id).cast("bigint").alias("_id"), F.col(text).alias("_text"))
    kind = packed.schema["_row"].dataType.simpleString()
    rows = stored(packed.mapInArrow(_numbered(words), f"_row {kind}, doc_id bigint, row bigint, fp bigint"), "numbered")
    prints = rows.select("doc_id", "row", "fp")
    named = fingerprint_components(prints, max_bits).select("fp", "root")
    labels = join_salting_hot(prints, named, "fp", heavy_keys(prints, "fp", HOT_SHARE))
    first = labels.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first"))
    return rows.join(first.select("first.row"), "row", "left_semi").select("_row.*")
