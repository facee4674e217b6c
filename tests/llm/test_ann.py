import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeops.llm import ann
from lakeops.llm.queries import QUERIES

SCHEMA = "vec_id bigint, embedding array<float>, label int, list int, block string, vector int"


def plain_nearest(rows, chosen, k):
    """{query: [(distance, id), ...]} by measuring every pair."""
    data = [(i, np.array(v, np.float32).astype(float)) for i, v in rows]
    return {q: sorted((math.sqrt(((u - v) ** 2).sum()), i) for i, v in data if i != q)[:k] for q, u in data if chosen(q)}


def answers(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert r["rank"] == len(out[r.query_id])
    return out


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_recall(spark, folder):
    table = spark.read.parquet(f"{folder}/embeddings.parquet")
    want = plain_nearest([(r.vec_id, r.embedding) for r in table.collect()], lambda i: i % 100 == 0, 10)
    got = answers(QUERIES["op6_nearest_neighbours"](spark, folder))
    assert set(got) == set(want) and all(len(g) == 10 for g in got.values())
    hits = sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want)
    assert hits >= 0.93 * 10 * len(want)
    exact = {(q, i): s for q in want for s, i in want[q]}
    for q in got:
        assert got[q] == sorted(got[q])
        assert all(abs(s - exact[q, i]) < 1e-12 for s, i in got[q] if (q, i) in exact)


def test_all_lists_find_all(spark, monkeypatch):
    """With every list probed only the tests could lose a neighbour; small blocks and chunks, a third of the rows alike."""
    monkeypatch.setattr(ann, "BLOCK_ROWS", 50)
    monkeypatch.setattr(ann, "QUERY_ROWS", 7)
    rng = random.Random(5)
    rows = [(i, [1.0, 2.0] + [0.5] * 22 if i % 3 == 0 else [rng.gauss(0, 1) for _ in range(24)]) for i in range(600)]
    table = spark.createDataFrame([(i, v, None, 1, "b", 1) for i, v in rows], SCHEMA).repartition(4)
    want = plain_nearest(rows, lambda i: i % 20 == 0, 10)
    got = answers(ann.search(table, F.col("vec_id") % 20 == 0, 10, probe=1.0))
    assert {q: [i for _, i in x] for q, x in got.items()} == {q: [i for _, i in x] for q, x in want.items()}


def test_scan_keeps_the_near():
    rng = np.random.default_rng(1)
    rows, queries = rng.normal(size=(500, 70)), rng.normal(size=(20, 70))
    exact = ((queries[:, None] - rows[None]) ** 2).sum(axis=2)
    far = np.partition(exact, 9, axis=1)[:, 9]
    at, to = ann.scan(queries, rows, far)
    assert all(exact[a, b] <= far[a] * (1 + 1e-8) for a, b in zip(at, to, strict=True))
    assert len(at) >= 0.98 * 200
    assert np.allclose(ann.rotation(70) @ ann.rotation(70).T, np.eye(70))


def test_rows_without_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [2.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (8, []),
            (9, [1.0]), (None, [1.0, 0.5]), (100, [0.0, 1.0]), (100, [0.0, 1.0]), (200, [0.0, 0.0]), (2, [2.0, 0.0])]
    table = spark.createDataFrame([(*r, None, None, None, None) for r in rows], SCHEMA)
    got = answers(ann.search(table, F.col("vec_id") % 100 == 0, 10))
    root2 = math.sqrt(2)
    assert {q: [(round(s, 9), i) for s, i in x] for q, x in got.items()} == {
        0: [(1.0, 1), (1.0, 2), (1.0, 2), (round(root2, 9), 100), (round(root2, 9), 100)],
        100: [(1.0, 1), (round(root2, 9), 0), (round(math.sqrt(5), 9), 2), (round(math.sqrt(5), 9), 2)],
    }
    for empty in (table.limit(0), table.where("vec_id = 3")):
        assert ann.search(empty, F.col("vec_id") % 100 == 0).collect() == []
