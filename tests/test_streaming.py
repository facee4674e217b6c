import datetime as dt
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lakeops.session import scratch
from lakeops.sources.sinks import write_json_batch
from lakeops.streaming import ingest

SCHEMA = "txn_id string, amount double, txn_ts timestamp"


def batch(spark, *data):
    at = dt.datetime(2026, 1, 1)
    return spark.createDataFrame([(k, a, at + dt.timedelta(minutes=m)) for k, a, m in data], SCHEMA)


def test_append_reads_each_file_once(spark):
    landing, table, state = (scratch(spark, x) for x in ("in", "out", "state"))
    for i, data in enumerate(([("a", 1.0, 0), ("b", None, 0)], [("c", 2.0, -600)])):  # the last is late by hours
        write_json_batch(batch(spark, *data), f"{landing}/batch_{i:03d}", files=1)
        stream = ingest.stream_json(spark, landing, batch(spark).schema, max_files=1)
        query = ingest.append_stream(ingest.clean_stream(stream, "amount", "txn_ts"), table, state, "probe")
        progress = ingest.finish(query)
        assert progress is not None and not query.isActive
        # No stateful step follows the watermark, so a late row is kept.
        assert spark.read.parquet(table).count() == i + 1
    assert ingest.active_streams(spark) == []


def test_bounded_batches(spark):
    landing, table, state = (scratch(spark, x) for x in ("in", "out", "state"))
    for i in range(3):
        write_json_batch(batch(spark, (f"k{i}", 1.0, i)), f"{landing}/b{i}", files=1)
    stream = ingest.stream_json(spark, landing, batch(spark).schema, max_files=1)
    query = ingest.append_stream(stream, table, state)
    ingest.finish(query)
    assert len([p for p in query.recentProgress if p["numInputRows"] == 1]) == 3


def test_upsert_keeps_the_latest_and_replays_harmlessly(spark):
    landing, table, state = (scratch(spark, x) for x in ("in", "out", "state"))
    batches = [
        [("a", 1.0, 0), ("a", 2.0, 5), ("b", 3.0, 0)],
        [("a", 9.0, 1), ("c", 4.0, 0)],  # the later batch wins, as in a merge
    ]
    for i, data in enumerate(batches):
        write_json_batch(batch(spark, *data), f"{landing}/b{i}", files=1)
        stream = ingest.stream_json(spark, landing, batch(spark).schema)
        ingest.finish(ingest.stream_upsert(stream, ["txn_id"], ["txn_ts", "amount"], table, state))
    want = [("a", 9.0), ("b", 3.0), ("c", 4.0)]
    assert rows(ingest.current_rows(spark, table, ["txn_id"]), "txn_id", "amount") == want
    folders = spark.read.parquet(table).select("_stream", "_batch_id").distinct()
    assert rows(folders, "_batch_id") == [(0,), (1,)] and folders.select("_stream").distinct().count() == 1
    # A stream that lost its checkpoint starts at batch 0 again; it must not replace the first stream's batch 0.
    write_json_batch(batch(spark, ("c", 7.0, 9)), f"{landing}/late", files=1)
    again = ingest.stream_json(spark, f"{landing}/late", batch(spark).schema)
    ingest.finish(ingest.stream_upsert(again, ["txn_id"], ["txn_ts", "amount"], table, scratch(spark, "state")))
    want = [("a", 9.0), ("b", 3.0), ("c", 7.0)]
    assert rows(ingest.current_rows(spark, table, ["txn_id"]), "txn_id", "amount") == want


def test_replayed_batch_replaces_itself(spark):
    """A batch whose commit was lost runs again after a restart on the same checkpoint."""
    landing, table, state = (scratch(spark, x) for x in ("in", "out", "state"))
    write_json_batch(batch(spark, ("a", 1.0, 0), ("b", 2.0, 0)), landing, files=1)
    stream = ingest.stream_json(spark, landing, batch(spark).schema)
    ingest.finish(ingest.stream_upsert(stream, ["txn_id"], ["txn_ts"], table, state))
    for file in (Path(state, "commits", "0"), Path(state, "commits", ".0.crc")):
        file.unlink()
    ingest.finish(ingest.stream_upsert(stream, ["txn_id"], ["txn_ts"], table, state))
    assert spark.read.parquet(table).count() == 2
    assert rows(ingest.current_rows(spark, table, ["txn_id"]), "txn_id", "amount") == [("a", 1.0), ("b", 2.0)]


def test_folders_stay_few(spark):
    """Many batches, folded every third one: few folders, and the current rows of all batches by arrival and by event."""
    landing, table, state = (scratch(spark, x) for x in ("in", "out", "state"))
    for i in range(10):
        write_json_batch(batch(spark, ("a", float(i), 50 - i), (f"k{i}", 1.0, i)), f"{landing}/b{i}", files=1)
        stream = ingest.stream_json(spark, landing, batch(spark).schema)
        ingest.finish(ingest.stream_upsert(stream, ["txn_id"], ["txn_ts"], table, state, fanout=3, buckets=1))
        assert len(ingest.upsert_folders(spark, table)) <= 6
    want = [("a", 9.0), *[(f"k{i}", 1.0) for i in range(10)]]
    assert rows(ingest.current_rows(spark, table, ["txn_id"]), "txn_id", "amount") == want
    path = scratch(spark, "events")
    for i, (amount, minute) in enumerate(((1.0, 9), (2.0, 3))):
        late = batch(spark, ("a", amount, minute)).selectExpr("*", "current_timestamp() AS _merged_at", "'s' AS _stream", f"{i}L AS _batch_id")
        late.write.mode("append").partitionBy("_stream", "_batch_id").parquet(path)
    assert rows(ingest.current_rows(spark, path, ["txn_id"]), "amount") == [(2.0,)]
    assert rows(ingest.current_rows(spark, path, ["txn_id"], ["txn_ts"]), "amount") == [(1.0,)]


def test_folds_keep_both_orders(spark):
    """A late event after a newer one: what the order says does not depend on whether the batches were folded."""
    table = scratch(spark, "late")
    for i, (amount, minute) in enumerate(((1.0, 10), (2.0, 5), (3.0, 7), (9.0, 1))):
        ingest.upsert_batch(batch(spark, ("k", amount, minute), (f"only{i}", 0.0, i)), ["txn_id"], ["txn_ts"], table, "s", i)
        for folded in (0, 1):
            if folded:
                ingest.fold_upserts(spark, table, ["txn_id"], ["txn_ts"], fanout=2, buckets=3)
            by_arrival, by_event = (ingest.current_rows(spark, table, ["txn_id"], o).where("txn_id = 'k'") for o in (None, ["txn_ts"]))
            assert rows(by_arrival, "amount") == [(amount,)] and rows(by_event, "amount") == [(1.0,)]
    assert ingest.current_rows(spark, table, ["txn_id"]).count() == 5
    assert max(level for level, _, _ in ingest.upsert_folders(spark, table)) >= 1


def test_bytes_written_grow_with_the_levels(spark):
    """Rows written by folds of many small batches of new keys: each row once a level, never the whole table again."""
    table, written, seen, n = scratch(spark, "levels"), 0, set(), 81
    for i in range(n):
        rows_of = spark.range(i * 20, i * 20 + 20, 1, 1).selectExpr("concat('k', id) AS txn_id", "1.0D AS amount", "timestamp_seconds(id) AS txn_ts")
        ingest.upsert_batch(rows_of, ["txn_id"], ["txn_ts"], table, "s", i)
        ingest.fold_upserts(spark, table, ["txn_id"], ["txn_ts"], fanout=3, buckets=2)
        now = set(ingest.upsert_folders(spark, table))
        for level, bucket, run in now - seen:
            if level:
                written += spark.read.parquet(f"{table}/_level={level}/_bucket={bucket}/_run={run}").count()
        seen = now
    levels = max(level for level, _, _ in seen)
    assert levels <= 5 and written <= 20 * n * levels and len(seen) <= 2 * 3 * (levels + 1) + 3
    # Folding everything each third time would have written twelve times the rows.
    assert written < 5 * 20 * n
    assert ingest.current_rows(spark, table, ["txn_id"]).count() == 20 * n


def test_copies_within_the_watermark(spark):
    """Late copies go, also those of an earlier run on the same checkpoint; the state holds the last stretch of event time."""
    landing, table, state = (scratch(spark, x) for x in ("in", "out", "state"))
    held = []
    for i in range(8):
        fresh = [(f"k{i}-{j}", 1.0, 60 * i + j) for j in range(20)]
        copies = [(f"k{i - 1}-{j}", 1.0, 60 * (i - 1) + j) for j in range(20)] if i else []
        write_json_batch(batch(spark, *fresh, *fresh[:5], *copies), f"{landing}/b{i}", files=1)
        stream = ingest.once_within(ingest.stream_json(spark, landing, batch(spark).schema), ["txn_id"], "txn_ts", "90 minutes")
        progress = ingest.finish(ingest.append_stream(stream, table, state))
        held.append(progress["stateOperators"][0]["numRowsTotal"])
    assert spark.read.parquet(table).count() == 160 == spark.read.parquet(table).select("txn_id").distinct().count()
    assert max(held) <= 100


def test_stream_into_table(spark):
    landing, state = scratch(spark, "in"), scratch(spark, "state")
    write_json_batch(batch(spark, ("a", 1.0, 0)), landing, files=1)
    stream = ingest.stream_json(spark, landing, batch(spark).schema)
    ingest.finish(ingest.append_stream_table(stream, "stream_probe", state))
    assert spark.table("stream_probe").count() == 1
    spark.sql("DROP TABLE stream_probe")


def test_continuous_trigger_can_be_stopped(spark):
    landing, table, state = (scratch(spark, x) for x in ("in", "out", "state"))
    write_json_batch(batch(spark, ("a", 1.0, 0)), landing, files=1)
    stream = ingest.stream_json(spark, landing, batch(spark).schema)
    query = ingest.append_stream(stream, table, state, "ticking", **ingest.trigger_options("interval", "1 second"))
    query.processAllAvailable()
    assert "ticking" in [name for _, name, _ in ingest.active_streams(spark)]
    query.stop()
    assert spark.read.parquet(table).count() == 1


def test_triggers():
    assert ingest.trigger_options() == {"availableNow": True}
    assert ingest.trigger_options("interval", "2 minutes") == {"processingTime": "2 minutes"}
    with pytest.raises(ValueError, match="sometimes"):
        ingest.trigger_options("sometimes")


def test_messages(spark):
    landing, table, state = (scratch(spark, x) for x in ("in", "out", "state"))
    at = dt.datetime(2026, 1, 1)
    spark.createDataFrame([(b'{"txn_id": "a", "amount": 1.5}', at)], "value binary, timestamp timestamp").write.parquet(landing)
    log = spark.readStream.schema("value binary, timestamp timestamp").parquet(landing)
    ingest.finish(ingest.append_stream(ingest.stream_messages(log, batch(spark).schema), table, state))
    got = spark.read.parquet(table).select("txn_id", "amount", F.col("enqueued_ts"))
    assert rows(got) == [("a", 1.5, at)]
