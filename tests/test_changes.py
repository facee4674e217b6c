import datetime as dt
from urllib.parse import unquote

import pytest
from conftest import plan, rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lakeops.operators import changes as c
from lakeops.operators import compare, layout, rewrite
from lakeops.session import scratch
from lakeops.sources import files
from lakeops.sources.sinks import write_partitioned

SCHEMA = "id string, name string, balance double"


@pytest.fixture
def target(spark):
    return spark.createDataFrame([("a", "A", 1.0), ("b", "B", 2.0), ("c", "C", 3.0), (None, "N", 0.0)], SCHEMA)


@pytest.fixture
def updates(spark):
    return spark.createDataFrame([("b", "B*", None), ("d", "D", 4.0)], SCHEMA)


@pytest.mark.parametrize("max_bytes", [c.BROADCAST_BYTES, 0])
def test_upsert(target, updates, max_bytes):
    assert rows(c.upsert(target, updates, ["id"], max_bytes=max_bytes)) == [
        ("a", "A", 1.0), ("b", "B*", None), ("c", "C", 3.0), ("d", "D", 4.0), (None, "N", 0.0),
    ]
    assert rows(c.upsert(target, updates, ["id"], ["balance"], max_bytes)) == [
        ("a", "A", 1.0), ("b", "B", None), ("c", "C", 3.0), ("d", "D", 4.0), (None, "N", 0.0),
    ]


def test_upsert_of_a_small_batch_does_not_shuffle_the_target(spark, updates):
    path = scratch(spark, "t")
    spark.range(1000).select(F.col("id").cast("string"), F.lit("n").alias("name"), F.lit(1.0).alias("balance")).write.parquet(path)
    text = plan(c.upsert(spark.read.parquet(path), updates, ["id"]))
    kept = text.split("BroadcastHashJoin [id")[1].split("BroadcastExchange")[0]
    assert "Exchange" not in kept


def test_upsert_refuses_repeated_source_keys(spark, target):
    twice = spark.createDataFrame([("b", "x", 1.0), ("b", "y", 2.0)], SCHEMA)
    with pytest.raises(c.DuplicateKeyError):
        c.upsert(target, twice, ["id"])
    nulls = spark.createDataFrame([(None, "x", 1.0), (None, "y", 2.0)], SCHEMA)
    assert c.upsert(target, nulls, ["id"]).count() == 6  # null matches nothing, so both are inserted


def test_insert_only_leaves_old_rows(target, updates):
    assert rows(c.insert_only(target, updates, ["id"]), "id", "name") == [
        ("a", "A"), ("b", "B"), ("c", "C"), ("d", "D"), (None, "N"),
    ]


def test_conditional_update_and_delete(target):
    up = c.conditional_update(target, F.col("id") == "b", {"balance": F.lit(0)})
    assert rows(up, "id", "balance") == [("a", 1.0), ("b", 0.0), ("c", 3.0), (None, 0.0)]
    assert rows(c.delete_where(target, F.col("id") == "b"), "id") == [("a",), ("c",), (None,)]


def log(spark):
    t = [F.lit(dt.datetime(2026, 1, day)) for day in (1, 2, 3)]
    v0 = spark.createDataFrame([("a", "A", 1.0), ("b", "B", 2.0)], SCHEMA)
    v1 = spark.createDataFrame([("a", "A", 5.0), ("c", "C", 3.0)], SCHEMA)
    feed = c.change_feed(v0.limit(0), v0, ["id"], 0, t[0]).unionByName(c.change_feed(v0, v1, ["id"], 1, t[1]))
    return v0, v1, feed


def test_change_feed(spark):
    v0, v1, feed = log(spark)
    assert rows(feed.filter("_commit_version = 1"), "id", "balance", c.CHANGE_TYPE) == [
        ("a", 1.0, "update_preimage"), ("a", 5.0, "update_postimage"), ("b", 2.0, "delete"), ("c", 3.0, "insert"),
    ]
    assert c.change_feed(v1, v1, ["id"], 2).isEmpty()
    assert rows(c.apply_feed(v0, feed.filter("_commit_version = 1"), ["id"])) == rows(v1)


def test_as_of_restore_history(spark):
    v0, v1, feed = log(spark)
    assert rows(c.as_of(feed, ["id"], version=0)) == rows(v0)
    assert rows(c.as_of(feed, ["id"], version=1)) == rows(v1)
    assert rows(c.as_of(feed, ["id"], ts=F.lit(dt.datetime(2026, 1, 1, 12)))) == rows(v0)
    undone = feed.unionByName(c.restore(feed, v1, ["id"], 0, 2))
    assert rows(c.as_of(undone, ["id"])) == rows(v0)
    assert rows(c.history(undone), c.VERSION, "inserted", "updated", "deleted") == [(0, 2, 0, 0), (1, 1, 1, 1), (2, 1, 1, 1)]


def test_repair(spark, target):
    broken = c.conditional_update(target, F.col("id").isin("b", "c"), {"balance": F.lit(0)})
    fixed = c.repair_from(broken, target, ["id"], ["balance"], F.col("id") == "b")
    assert rows(fixed, "id", "balance") == [("a", 1.0), ("b", 2.0), ("c", 0.0), (None, 0.0)]


def test_slice_load_twice_and_empty(spark):
    path = scratch(spark, "fact")
    fact = spark.range(100).select(F.col("id").cast("int").alias("n"), (F.col("id") % 4).cast("int").alias("day"))
    write_partitioned(fact, path, ["day"])
    delta = spark.range(10).select((F.col("id") + 500).cast("int").alias("n"), F.lit(2).alias("day"))
    counts = []
    for _ in range(2):
        run = c.run_slice_load(spark, path, delta, "day", 2).first()
        counts.append((run.rows_deleted, run.rows_inserted, run.status, spark.read.parquet(path).count()))
    assert counts == [(25, 10, "SUCCESS", 85), (10, 10, "SUCCESS", 85)]
    cleared = c.run_slice_load(spark, path, delta.limit(0), "day", 2).first()
    assert (cleared.rows_deleted, cleared.rows_inserted, spark.read.parquet(path).count()) == (10, 0, 75)


def test_slice_load_failure_is_logged_and_changes_nothing(spark):
    path = scratch(spark, "fact")
    write_partitioned(spark.range(8).select("id", (F.col("id") % 2).cast("int").alias("day")), path, ["day"])
    broken = spark.range(2).select("id", F.raise_error(F.lit("bad delta")).cast("int").alias("day"))
    run = c.run_slice_load(spark, path, broken, "day", 1).first()
    assert (run.status, run.rows_deleted, run.rows_inserted) == ("FAILED", 0, 0) and "bad delta" in run.message
    assert spark.read.parquet(path).count() == 8


def test_slice_load_with_odd_names(spark):
    """Partition values that Spark escapes, emptied and loaded again."""
    path = scratch(spark, "fact")
    fact = spark.range(12).select("id", F.when(F.col("id") % 3 == 0, "a/b").when(F.col("id") % 3 == 1, "c d=%").otherwise("e").alias("s"))
    write_partitioned(fact, path, ["s"])
    for value in ("a/b", "c d=%"):
        gone = c.run_slice_load(spark, path, fact.limit(0), "s", value).first()
        assert (gone.rows_deleted, gone.rows_inserted, gone.status) == (4, 0, "SUCCESS")
        assert spark.read.parquet(path).where(F.col("s") == value).count() == 0
        back = c.run_slice_load(spark, path, fact, "s", value).first()
        assert (back.rows_deleted, back.rows_inserted) == (0, 4)
    assert rows(spark.read.parquet(path), "id", "s") == rows(fact)


def test_change_feed_keys(spark):
    old = spark.createDataFrame([(None, 1), (1, 1), (2, None)], "k int, v int")
    assert c.change_feed(old, old, ["k"], 1).count() == 0
    new = spark.createDataFrame([(None, 2), (1, 1), (3, 3)], "k int, v int")
    feed = c.change_feed(old, new, ["k"], 1)
    assert rows(feed, "k", "v", "_change_type") == sorted(
        [(None, 1, "update_preimage"), (None, 2, "update_postimage"), (2, None, "delete"), (3, 3, "insert")], key=repr
    )
    twice = spark.createDataFrame([(1, 1), (1, 2)], "k int, v int")
    for sides in ((old, twice), (twice, old)):
        with pytest.raises(PySparkException, match="occurs 2 times"):
            c.change_feed(*sides, ["k"], 1).collect()
    assert plan(c.change_feed(old, new, ["k"], 1)).count("Exchange hashpartitioning") == 1
    with pytest.raises(c.DuplicateKeyError):
        c.repair_from(old, twice, ["k"], ["v"], F.col("v") == 1)


def test_z_order_keeps_rows_and_narrows_files(spark):
    df = spark.range(20_000).select((F.col("id") * 7919 % 20_000).alias("x"), (F.col("id") * 104_729 % 20_000).alias("y"))
    path = scratch(spark, "z")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        layout.zorder_write(df, path, ["x", "y"], bits=4)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    back = spark.read.parquet(path)
    assert rows(back) == rows(df)
    spans = back.groupBy(F.col("_metadata.file_path")).agg(
        (F.max("x") - F.min("x")).alias("x"), (F.max("y") - F.min("y")).alias("y")
    )
    widest = spans.agg(F.avg("x"), F.avg("y")).first()
    assert spans.count() == 8 and max(widest) < 14_000  # an unordered file spans all 20,000


def test_compaction(spark):
    small, large = scratch(spark, "small"), scratch(spark, "large")
    spark.range(1000).repartition(20).write.parquet(small)
    layout.compact(spark, small, large)
    files = spark.read.parquet(large).select(F.col("_metadata.file_path").alias("f")).distinct().count()
    assert spark.read.parquet(large).count() == 1000 and files < 20


def test_z_order_on_text_with_a_common_head(spark):
    df = spark.range(3000).select(F.concat(F.lit("ORDER#0000000"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("t"), (F.col("id") % 50).alias("n"))
    assert layout.with_z_order(df, ["t", "n"], bits=4).select("_z").distinct().count() > 100


def test_as_of_reads_a_snapshot_and_the_tail(spark):
    root, keys = scratch(spark, "versions"), ["id"]
    contents = [spark.range(n).selectExpr("id", f"id % {n} AS v") for n in (5, 9, 9, 7, 30)]
    at = [dt.datetime(2026, 1, 1 + i) for i in range(5)]
    before = contents[0].limit(0)
    for version, now in enumerate(contents):
        c.commit(c.change_feed(before, now, keys, version), root, keys, version, at[version], every=2)
        before = now
    c.commit(c.change_feed(contents[3], contents[4], keys, 4), root, keys, 4, at[4], every=2)  # again
    for version, now in enumerate(contents):
        assert rows(c.as_of_stored(spark, root, keys, version)) == rows(now)
        assert rows(c.as_of_stored(spark, root, keys, at=at[version] + dt.timedelta(hours=1))) == rows(now)
    assert rows(c.as_of_stored(spark, root, keys)) == rows(contents[4])
    text = plan(c.as_of_stored(spark, root, keys, version=3))
    tails = [line for line in text.split("\n") if "PartitionFilters" in line and "_commit_version" in line]
    assert tails and all("(_commit_version" in line and "> 2)" in line and "<= 3)" in line for line in tails)
    assert "version=2" in text and "version=0" not in text
    files.remove(spark, f"{root}/snapshots")
    assert rows(c.as_of_stored(spark, root, keys, version=3)) == rows(contents[3])


def test_comparison_reads_unequal_folders_only(spark):
    base = spark.range(2000).selectExpr("id AS k", "CASE WHEN id % 7 > 0 THEN concat('t', id) END AS a", "CASE WHEN id % 5 > 0 THEN id * 0.5D END AS b")
    planted = {3: ("x", 1.0), 77: (None, None), 1500: ("t1500", 9.0)}
    changed = base.filter("k NOT IN (3, 77, 1500, 42)").unionByName(spark.createDataFrame([(k, *v) for k, v in planted.items()] + [(5000, "new", None)], base.schema))
    left, right, same = (scratch(spark, x) for x in ("left", "right", "same"))
    for path, table in ((left, base), (right, changed), (same, base.repartition(3).select("b", "k", "a"))):
        compare.write_comparable(table, path, ["k"], depth=2)
    assert compare.unequal_folders(spark, left, same) == [] and compare.differences(spark, left, same, ["k"]).collect() == []
    folders = compare.unequal_folders(spark, left, right)
    assert 1 <= len(folders) <= 5
    found = compare.differences(spark, left, right, ["k"])
    old = {r.k: (r.a, r.b) for r in base.collect()}
    want = [(42, *old[42], "delete"), (5000, "new", None, "insert")]
    want += [x for k, v in planted.items() for x in ((k, *old[k], "update_preimage"), (k, *v, "update_postimage"))]
    assert rows(found, "k", "a", "b", "difference") == sorted(want, key=repr)
    scans = [line for line in plan(found).split("\n") if "PartitionFilters" in line]
    assert len(scans) == 2 and all("PartitionFilters: [_bucket" in line for line in scans)
    swapped = spark.createDataFrame([(None, 1), (1, None)], "a int, b int")
    assert swapped.select(compare.row_hash(swapped, 1)).distinct().count() == 2  # a null counts by its place
    with pytest.raises(ValueError, match="depths"):
        compare.write_comparable(base, same, ["k"], depth=1)
        compare.unequal_folders(spark, left, same)


@pytest.mark.parametrize("partitioned", [False, True])
def test_only_touched_files_are_rewritten(spark, partitioned):
    path = scratch(spark, "table dir") + "/a b"
    table = spark.range(1000).selectExpr("id AS k", "id % 10 AS v", "concat('p ', CAST(id % 2 AS string)) AS p")
    writer = table.repartitionByRange(5, "k").sortWithinPartitions("k").write
    (writer.partitionBy("p") if partitioned else writer).parquet(path)
    expected = {r.k: (r.v, r.p) for r in table.collect()}
    named = lambda paths: {unquote(f).split("a b/")[1] for f in paths}
    names = lambda: named(spark.read.parquet(path).inputFiles())

    def check(gone):
        spark.catalog.refreshByPath(path)
        now = names()
        gone = named(gone)
        assert not gone & now and before - gone <= now
        assert {r.k: (r.v, r.p) for r in spark.read.parquet(path).collect()} == expected
        assert spark.read.parquet(path).count() == len(expected)

    before = names()
    gone = rewrite.delete_rows(spark, path, F.col("k").between(10, 20))
    assert len(gone) == (2 if partitioned else 1)
    expected = {k: v for k, v in expected.items() if not 10 <= k <= 20}
    check(gone)
    before = names()
    gone = rewrite.update_rows(spark, path, F.col("k") == 500, {"v": F.lit(None)})
    expected[500] = (None, expected[500][1])
    assert len(gone) == 1
    check(gone)
    before = names()
    fresh = spark.createDataFrame([(1000 + i, i, "p 1") for i in range(3)] + [(999, 5, "p 1")], "k long, v long, p string")
    gone = rewrite.replace_rows(spark, path, F.col("k") >= 999, fresh)
    expected = {k: v for k, v in expected.items() if k < 999} | {r.k: (r.v, r.p) for r in fresh.collect()}
    check(gone)
    before = names()
    assert rewrite.delete_rows(spark, path, F.col("k") < 0) == []
    check([])
    with pytest.raises(PySparkException, match="outside the predicate"):
        rewrite.replace_rows(spark, path, F.col("k") < 0, fresh)
    assert rewrite.finish(spark, path) == 0
    check([])


def test_a_swap_cut_short_is_completed(spark, monkeypatch):
    path = scratch(spark, "table")
    spark.range(100).repartitionByRange(4, "id").write.parquet(path)
    monkeypatch.setattr(rewrite, "move", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError, match="lost"):
        rewrite.delete_rows(spark, path, F.col("id") < 10)
    monkeypatch.undo()
    assert rewrite.finish(spark, path) == 1 and rewrite.finish(spark, path) == 0
    spark.catalog.refreshByPath(path)
    assert rows(spark.read.parquet(path)) == [(i,) for i in sorted(range(10, 100), key=lambda i: repr((i,)))]
