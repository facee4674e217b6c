import hashlib
import random
from collections import Counter, defaultdict
from math import ceil, floor

import pytest
from compare import connect, differences
from conftest import plan, rows
from edge_cases import edge_docs, no_docs  # noqa: F401

from lakeops.llm import exact, mixing
from lakeops.llm.queries import MIX_WEIGHTS, ORACLES, QUERIES
from lakeops.session import stored


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, small, name):
    assert differences(QUERIES[name](spark, small), connect(small), ORACLES[name]) == []


@pytest.mark.parametrize("keep", ["max", "min"])
def test_copies_by_hand(spark, edge_docs, no_docs, keep):
    """Groups that span partitions included: more partitions than rows of a text."""
    docs = edge_docs.unionByName(edge_docs.limit(0))
    many = spark.range(300).selectExpr("id + 100 AS doc_id", "'hot text' AS text")
    for table, parts in ((docs, "8"), (many.unionByName(docs.select("doc_id", "text")), "40")):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            got = exact.label_copies(table, keep=keep).collect()
            stay = exact.drop_copies(table, keep=keep)
            groups = defaultdict(list)
            for r in table.collect():
                groups[r.text or ""].append(r.doc_id)
            pick = max if keep == "max" else min
            best = {t: pick([x for x in ids if x is not None], default=None) for t, ids in groups.items()}
            sha = {hashlib.sha256(t.encode()).hexdigest(): t for t in groups}
            assert Counter((r.doc_id, sha[r.text_sha256]) for r in got) == Counter((i, t) for t, ids in groups.items() for i in ids)
            for r in got:
                t = sha[r.text_sha256]
                assert (r.keep_id, r.group_size) == (best[t], len(groups[t]))
            assert Counter((r.doc_id, sha[r.text_sha256]) for r in got if r.kept) == Counter((best[t], t) for t in groups)
            assert stay.columns == table.columns
            assert Counter((r.doc_id, r.text or "") for r in stay.collect()) == Counter((best[t], t) for t in groups)
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert exact.label_copies(no_docs).collect() == [] and exact.drop_copies(no_docs).collect() == []


def plain_schedule(blocks, weights):
    """Earliest deadline first, cycle by cycle."""
    left, done, out, slot = dict(blocks), Counter(), [], 0
    while left:
        active = sorted(((s, min(weights[s], n)) for s, n in left.items()), key=lambda x: (x[0] is not None, x[0] or ""))
        total, got = sum(w for _, w in active), Counter()
        for t in range(total):
            ready = [(ceil((got[s] + 1) * total / w), i, s) for i, (s, w) in enumerate(active) if got[s] < w and floor(got[s] * total / w) <= t]
            s = min(ready)[2]
            out.append((s, done[s]))
            got[s] += 1
            done[s] += 1
        slot += total
        left = {s: n - got[s] for s, n in left.items() if n > got[s]}
    return {b: i for i, b in enumerate(out)}


def stream_blocks(docs, size):
    """Block of each document: characters of the source before it."""
    before, out = Counter(), []
    for r in sorted(docs, key=lambda r: (r[0] is not None, r[0] or 0, len(r[1] or ""))):
        out.append((r[0], r[2], len(r[1] or ""), before[r[2]] // size))
        before[r[2]] += len(r[1] or "")
    blocks = {s: max(1, ceil(n / size)) for s, n in before.items()}
    return [(d, s, n, min(b, blocks[s] - 1)) for d, s, n, b in out], blocks


@pytest.mark.parametrize("size", [500, 3000, 65536])
def test_schedule_by_definition(spark, edge_docs, no_docs, small, size):
    weights = {**MIX_WEIGHTS, "s1": 3}
    for docs in (edge_docs, spark.read.parquet(f"{small}/documents.parquet")):
        data = docs.select("doc_id", "text", "source").collect()
        placed, blocks = stream_blocks(data, size)
        slots = plain_schedule(blocks, {s: weights.get(s, 1) for s in blocks})
        want = sorted(((d, s, n, b, slots[(s, b)]) for d, s, n, b in placed), key=repr)
        got = mixing.schedule(docs, weights, block_chars=size)
        assert rows(got, "doc_id", "source", "chars", "block", "slot") == want
        assert got.where("slot < released OR slot >= due").count() == 0
        whole = mixing.mixed(docs, weights, block_chars=size)
        assert rows(whole) == rows(docs)
    assert mixing.schedule(no_docs, weights).collect() == []
    with pytest.raises(ValueError):
        mixing.schedule(no_docs, {"a": 0})


@pytest.mark.parametrize("broadcast", [True, False])
def test_many_sources(spark, monkeypatch, broadcast):
    """Sources of many lengths and weights, so that nearly every cycle has other members; both ways to join the schedule."""
    monkeypatch.setattr(mixing, "BROADCAST_KINDS", 10_000 if broadcast else 0)
    monkeypatch.setattr(mixing, "CYCLES", 3)
    rng = random.Random(3)
    data = [(i, "x" * rng.randrange(0, 40), None if i % 50 == 0 else f"s{rng.randrange(60) ** 2 // 60}") for i in range(1500)]
    docs = spark.createDataFrame(data, "doc_id bigint, text string, source string").repartition(5)
    weights = {f"s{i}": 1 + i % 7 for i in range(0, 60, 2)}
    placed, blocks = stream_blocks(data, 50)
    slots = plain_schedule(blocks, {s: weights.get(s, 2) for s in blocks})
    got = mixing.schedule(docs, weights, default=2, block_chars=50)
    assert rows(got, "doc_id", "source", "chars", "block", "slot") == sorted(((d, s, n, b, slots[(s, b)]) for d, s, n, b in placed), key=repr)
    assert got.where("slot < released OR slot >= due").count() == 0


def test_ten_thousand_sources(spark):
    """One short document each: a cycle of as many slots, scheduled with one shuffle of its rows."""
    docs = spark.range(10_000).selectExpr("id AS doc_id", "'text' AS text", "lpad(id * 7919 % 10000, 5, '0') AS source")
    got = mixing.schedule(docs).orderBy("slot").collect()
    assert [(r.slot, r.source) for r in got] == [(i, f"{i:05d}") for i in range(10_000)]
    jobs = mixing._jobs(spark.range(40).selectExpr("string(id) AS source", "1 + id % 3 AS weight", "1 + id AS blocks"))
    halved = plan(mixing._slots(stored(jobs), 7))
    assert halved.count("Exchange") == 1 and halved.count("Window [") + halved.count("Window(") >= 14


def test_deviation_stays_below_a_block():
    weights = {"a": 7, "b": 3, "c": 1, "d": 1, "e": 5}
    order = sorted(plain_schedule({s: w * 20 for s, w in weights.items()}, weights).items(), key=lambda x: x[1])
    got = Counter()
    for t, ((s, _), _) in enumerate(order, 1):
        got[s] += 1
        assert all(abs(got[x] - t * w / 17) < 1 for x, w in weights.items())


def test_mixed_order_and_native_plan(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    slots = {r.doc_id: r.slot for r in mixing.schedule(docs, MIX_WEIGHTS, block_chars=2000).collect()}
    order = [r.doc_id for r in mixing.mixed(docs, MIX_WEIGHTS, block_chars=2000).collect()]
    assert order == sorted(order, key=lambda d: (slots[d], d))
    assert not any(x in plan(mixing.schedule(docs, MIX_WEIGHTS)) for x in ("Python", "Arrow", "Pandas", "CartesianProduct"))
