"""Approximate nearest neighbours by an adaptive scan of dimensions over inverted lists.

Index: centroids are fitted by k-means to at most ``FIT_ROWS`` rows (the smallest by hash); every row is put in the list of its
nearest centroid, its vector turned by a random rotation. Search: a query probes the ``probe`` share of lists nearest to
it. Within a list, distances grow by column blocks of the rotated vectors. As a rotation spreads a distance evenly
over the columns, the part summed so far estimates the whole; a hypothesis test against the k-th best distance known then
abandons candidates early. Survivors are measured exactly on the original vectors.

Lists are cut into blocks of bounded size, so a list that holds a third of all rows is many tasks; queries are cut into chunks.
A task returns at most k rows for each of its queries.

Distance is Euclidean in double precision; ties go to the smaller id. Defined cases: rows take no part if their id is null or
their vector is null, empty, zero, holds null or non-finite components, or has not the most common length (the greater of equally
common ones); a query is not its own neighbour, nor are other rows of its id; rows that repeat a query's id are one query, the
one whose vector's bytes are least; repeated candidates count each time; fewer candidates than k are all returned.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.session import stored

FIT_ROWS = 8192
FIT_ROUNDS = 8
PROBE = 0.8
COLUMNS = 16
EPSILON = 2.1
BLOCK_ROWS = 1024
QUERY_ROWS = 4096
AT_ONCE = 64
# Distances to centroids held at once.
CELLS = 1 << 22
SEED = 42


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Usable vectors as bytes of doubles."""
    for batch in batches:
        ids, vectors, asked = [], [], []
        for vec_id, vector, query in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if vec_id is None or not vector or any(x is None for x in vector):
                continue
            v = np.array(vector, np.float64)
            if np.isfinite(v).all() and v.any():
                ids.append(vec_id)
                vectors.append(v.tobytes())
                asked.append(bool(query))
        yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(vectors, pa.binary()), pa.array(asked, pa.bool_())], names=["vec_id", "vector", "asked"])


def _matrix(column) -> np.ndarray:
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), np.float64).reshape(len(values), -1)


def rotation(size: int) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(SEED).normal(size=(size, size)))
    return q * np.sign(np.diag(r))


def fit_centroids(rows: np.ndarray, lists: int) -> np.ndarray:
    """Lloyd's algorithm from distinct rows; a centroid without rows stays where it is."""
    rows = np.ascontiguousarray(rows)
    start = np.unique(rows, axis=0)
    centroids = start[np.random.default_rng(SEED).permutation(len(start))[:lists]].copy()
    for _ in range(FIT_ROUNDS):
        nearest = _first(rows, centroids)
        for c in range(len(centroids)):
            own = rows[nearest == c]
            if len(own):
                centroids[c] = own.mean(axis=0)
    return centroids


def _nearest(rows: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Centroids of each row, nearest first."""
    return np.argsort((centroids**2).sum(axis=1) - 2 * rows @ centroids.T, axis=1, kind="stable")


def _first(rows: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """The nearest centroid of each row, a slice of rows at a time."""
    size, step = (centroids**2).sum(axis=1), max(1, CELLS // len(centroids))
    return np.concatenate([np.argmin(size - 2 * rows[a : a + step] @ centroids.T, axis=1) for a in range(0, len(rows), step)] or [np.empty(0, np.int64)])


def _listed(centroids: np.ndarray, turn: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                rows = _matrix(batch.column(1))
                turned = [v.tobytes() for v in rows @ turn]
                lists = pa.array(_first(rows, centroids).astype(np.int32))
                yield pa.record_batch([*batch.columns, pa.array(turned, pa.binary()), lists], names=["vec_id", "vector", "asked", "turned", "list"])

    return run


def _probes(centroids: np.ndarray, sizes: np.ndarray, probe: float, k: int):
    """The lists a query probes: the share of them, and on until they hold k rows beside the query itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                order = _nearest(_matrix(batch.column(1)), centroids)
                enough = (np.cumsum(sizes[order], axis=1) > k).argmax(axis=1) + 1
                enough = np.where(sizes.sum() > k, enough, len(sizes))
                lists = [o[: max(ceil(probe * len(sizes)), n)].astype(np.int32).tolist() for o, n in zip(order, enough, strict=True)]
                yield pa.record_batch([*batch.columns, pa.array(lists, pa.list_(pa.int32()))], names=["query_id", "vector", "turned", "lists"])

    return run


def scan(queries: np.ndarray, rows: np.ndarray, far: np.ndarray, columns: int = COLUMNS, epsilon: float = EPSILON) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, row) of rotated vectors that the tests leave, given a squared distance per query that is far enough."""
    size = rows.shape[1]
    first = slice(0, min(columns, size))
    q, c = queries[:, first], rows[:, first]
    part = np.maximum((q**2).sum(axis=1)[:, None] + (c**2).sum(axis=1) - 2 * q @ c.T, 0)

    def limit(seen: int) -> np.ndarray:
        """The most a candidate may have summed over ``seen`` of the columns and still be likely to be near enough."""
        return far * (1 if seen >= size else seen / size * (1 + epsilon / sqrt(seen)) ** 2) * (1 + 1e-9)

    at, to = np.nonzero(part <= limit(first.stop)[:, None])
    sums = part[at, to]
    for begin in range(columns, size, columns):
        end = min(begin + columns, size)
        sums = sums + ((queries[at, begin:end] - rows[to, begin:end]) ** 2).sum(axis=1)
        keep = sums <= limit(end)[at]
        at, to, sums = at[keep], to[keep], sums[keep]
    return at, to


FOUND = "query_id bigint, vec_id bigint, score double"


def _searched(k: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = [[], [], []]
        if left.num_rows and right.num_rows:
            ids, asked = left.column("vec_id").to_numpy(), right.column("query_id").to_numpy()
            order = np.argsort(ids, kind="stable")
            ids = ids[order]
            rows, turned = _matrix(left.column("vector"))[order], _matrix(left.column("turned"))[order]
            queries, probes = _matrix(right.column("vector")), _matrix(right.column("turned"))
            for begin in range(0, len(asked), AT_ONCE):
                part = slice(begin, begin + AT_ONCE)
                q, own = probes[part], asked[part]
                # The k-th best of some candidates is measured first; one more row, as the query itself may be among them.
                some = turned[: max(4 * k, 64)]
                known = np.maximum((q**2).sum(axis=1)[:, None] + (some**2).sum(axis=1) - 2 * q @ some.T, 0)
                known[own[:, None] == ids[: len(some)]] = np.inf
                far = np.partition(known, k - 1, axis=1)[:, k - 1] if len(some) >= k else np.full(len(q), np.inf)
                at, to = scan(q, turned, np.where(np.isfinite(far), far + 1e-9, np.inf))
                other = own[at] != ids[to]
                at, to = at[other], to[other]
                score = np.sqrt(((queries[part][at] - rows[to]) ** 2).sum(axis=1))
                best = np.lexsort((ids[to], score, at))
                at, to, score = at[best], to[best], score[best]
                place = np.arange(len(at)) - np.searchsorted(at, at)
                near = place < k
                for column, values in zip(out, (own[at[near]], ids[to[near]], score[near]), strict=True):
                    column.append(values)
        kinds = (np.int64, np.int64, np.float64)
        return pa.table([pa.array(np.concatenate([*c, np.empty(0, t)]).astype(t)) for c, t in zip(out, kinds, strict=True)], names=["query_id", "vec_id", "score"])

    return run


def search(vectors: DataFrame, is_query: Column, k: int = 10, probe: float = PROBE, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score of the k nearest rows found for every row that ``is_query`` chooses."""
    spark = vectors.sparkSession
    narrow = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"), is_query.alias("asked"))
    usable = stored(narrow.mapInArrow(_vectors, "vec_id bigint, vector binary, asked boolean"), "vectors")
    common = usable.groupBy(F.length("vector").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    if common is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    usable, total = usable.where(F.length("vector") == common["size"]), common["count"]
    sample = usable.select("vector").orderBy(F.xxhash64("vec_id", "vector"), "vector").limit(FIT_ROWS).toArrow()
    centroids = fit_centroids(_matrix(sample.column("vector")), ceil(sqrt(total) / 2))
    turn = rotation(centroids.shape[1])
    kept = "vec_id bigint, vector binary, asked boolean, turned binary, list int"
    index = stored(usable.mapInArrow(_listed(centroids, turn), kept), "lists")
    # One row per list: bounded by the number of centroids.
    sizes = np.zeros(len(centroids), np.int64)
    for row in index.groupBy("list").count().collect():
        sizes[row["list"]] = row["count"]
    blocks = F.get(F.lit([max(1, ceil(int(n) / BLOCK_ROWS)) for n in sizes]), F.col("list"))
    asked = index.where("asked").groupBy("vec_id").agg(F.min(F.struct("vector", "turned")).alias("q")).select(F.col("vec_id").alias("query_id"), "q.*")
    chunks = max(1, ceil(asked.count() / QUERY_ROWS))
    probing = asked.mapInArrow(_probes(centroids, sizes, probe, k), "query_id bigint, vector binary, turned binary, lists array<int>")
    probing = probing.withColumn("chunk", F.pmod(F.xxhash64("query_id"), F.lit(chunks))).withColumn("list", F.explode("lists")).drop("lists")
    probing = probing.withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1)))
    rows = index.select("vec_id", "vector", "turned", "list")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), blocks).cast("int"))
    rows = rows.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(chunks - 1).cast("bigint"))))
    key = ["list", "block", "chunk"]
    found = rows.groupBy(*key).cogroup(probing.groupBy(*key)).applyInArrow(_searched(k), FOUND)
    nearest = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
