"""Streaming queries: events land as JSON files, are ingested as a stream and read back as a batch table."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.catalog import domains as d
from lakeops.catalog.base import Tables, query
from lakeops.catalog.domains import with_
from lakeops.functions.scalars import money
from lakeops.plans import telemetry
from lakeops.session import scratch, stored
from lakeops.sources.sinks import write_json_batch
from lakeops.streaming import ingest

SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
])


def _rows(t: Tables):
    """Events as landed rows; error events have no value."""
    value = F.when(F.col("event_type") != "error", F.col("value")).alias("value")
    return t.events.select("event_id", "ts", "user_id", "event_type", value)


def _ingested(t: Tables):
    landing, table, state = (scratch(t.spark, x) for x in ("landing", "bronze", "state"))
    for part in range(2):
        write_json_batch(_rows(t).filter(F.col("event_id") % 2 == part), f"{landing}/batch_{part:03d}")
    for _ in range(2):  # the second run finds nothing new
        stream = ingest.stream_json(t.spark, landing, SCHEMA, max_files=10)
        timed = stream.withColumn("ts", F.col("ts").cast("timestamp"))
        ingest.finish(ingest.append_stream(ingest.clean_stream(timed, "value", "ts"), table, state))
    return t.spark.read.parquet(table)


@query(
    "stream_ingest_equals_batch",
    """SELECT event_type, cast(ts AS date) AS day, count(*) AS n, cast(sum(cast(value AS decimal(12,2))) AS double) AS total,
    true AS stamped FROM events WHERE event_type <> 'error' GROUP BY ALL""",
)
def stream_ingest_equals_batch(t: Tables):
    """Stream run twice on one checkpoint; the table equals the batch result."""
    return (
        _ingested(t)
        .groupBy("event_type", F.to_date("ts").alias("day"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(money("value")).alias("total"),
            F.bool_and(F.col("ingest_ts").isNotNull()).alias("stamped"),
        )
    )


@query(
    "stream_upsert_latest",
    """SELECT * EXCLUDE (rn) FROM (SELECT user_id, event_type, ts, event_id, value, row_number() OVER (PARTITION BY user_id, event_type
    ORDER BY event_id % 2 DESC, ts DESC, event_id DESC) AS rn FROM (SELECT event_id, ts, user_id, event_type, CASE WHEN event_type <> 'error'
    THEN value END AS value FROM events)) WHERE rn = 1""",
)
def stream_upsert_latest(t: Tables):
    """Current row per key after two landings, each upserted by its own run on one checkpoint."""
    landing, table, state = (scratch(t.spark, x) for x in ("landing", "silver", "state"))
    keys = ["user_id", "event_type"]
    for part in range(2):
        write_json_batch(_rows(t).filter(F.col("event_id") % 2 == part), f"{landing}/batch_{part:03d}")
        stream = ingest.stream_json(t.spark, landing, SCHEMA)
        ingest.finish(ingest.stream_upsert(stream, keys, ["ts", "event_id"], table, state))
    return ingest.current_rows(t.spark, table, keys)


@query(
    "stream_upsert_event_order",
    """SELECT * EXCLUDE (rn) FROM (SELECT user_id, event_type, ts, event_id, value, row_number() OVER (PARTITION BY user_id, event_type
    ORDER BY ts DESC, event_id DESC) AS rn FROM (SELECT event_id, ts, user_id, event_type, CASE WHEN event_type <> 'error'
    THEN value END AS value FROM events)) WHERE rn = 1""",
)
def stream_upsert_event_order(t: Tables):
    """Current row per key by event time, after landings that arrive in no order of time and were folded on the way."""
    landing, table, state = (scratch(t.spark, x) for x in ("landing", "silver", "state"))
    keys, order = ["user_id", "event_type"], ["ts", "event_id"]
    for part in (3, 0, 4, 1, 2):
        write_json_batch(_rows(t).filter(F.col("event_id") % 5 == part), f"{landing}/batch_{part:03d}")
        stream = ingest.stream_json(t.spark, landing, SCHEMA)
        ingest.finish(ingest.stream_upsert(stream, keys, order, table, state, fanout=2, buckets=2))
    return ingest.current_rows(t.spark, table, keys, order)


@query(
    "stream_once_within",
    """SELECT event_type, count(*) AS n, count(DISTINCT event_id) AS ids, cast(sum(cast(value AS decimal(12,2))) AS double) AS total, true AS state_bounded
    FROM (SELECT event_id, event_type, CASE WHEN event_type <> 'error' THEN value END AS value FROM events) GROUP BY event_type""",
)
def stream_once_within(t: Tables):
    """Events landed by days, each landing with the day before once more; copies go, and the state holds a few days' keys."""
    landing, table, state = (scratch(t.spark, x) for x in ("landing", "bronze", "state"))
    rows, held = stored(_rows(t), "rows"), 0
    first, last = rows.agg(F.min("ts"), F.max("ts")).first()
    day = F.floor(F.datediff("ts", F.lit(first)) * 6 / (F.datediff(F.lit(last), F.lit(first)) + 1))
    for part in range(6):
        write_json_batch(rows.filter(day.isin(part, part - 1)), f"{landing}/batch_{part:03d}")
        timed = ingest.stream_json(t.spark, landing, SCHEMA).withColumn("ts", F.col("ts").cast("timestamp"))
        once = ingest.once_within(timed, ["event_id"], "ts", "6 days")
        progress = ingest.finish(ingest.append_stream(once, table, state))
        held = max(held, progress["stateOperators"][0]["numRowsTotal"]) if progress else held
    kept = t.spark.read.parquet(table)
    everything = rows.agg(F.count(F.lit(1))).scalar()
    return kept.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("event_id").alias("ids"), F.sum(money("value")).alias("total")
    ).withColumn("state_bounded", F.lit(held) < everything)


@query(
    "stream_messages_parsed",
    """SELECT cast(json_extract_string(props, '$.k') AS bigint) AS k, count(*) AS n, max(ts) AS last_seen FROM events GROUP BY 1""",
)
def stream_messages_parsed(t: Tables):
    """Message log as a stream: binary payload parsed, enqueue time kept."""
    landing, table, state = (scratch(t.spark, x) for x in ("log", "parsed", "state"))
    t.events.select(F.col("props").cast("binary").alias("value"), F.col("ts").alias("timestamp")).write.parquet(landing)
    log = t.spark.readStream.schema("value binary, timestamp timestamp_ntz").parquet(landing)
    parsed = ingest.stream_messages(log, T.StructType([T.StructField("k", T.LongType())]))
    ingest.finish(ingest.append_stream(parsed, table, state))
    rows = t.spark.read.parquet(table)
    return rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("enqueued_ts").alias("last_seen"))


@query(
    "stream_to_anomalies",
    with_(
        "readings plausible scored flags",
        "SELECT machine_id, machine_type, line, count(*) AS anomalous_reading_count FROM flags GROUP BY ALL",
    ),
)
def stream_to_anomalies(t: Tables):
    """Readings streamed to a bronze folder, then cleaned and scored as a batch."""
    landing, root = scratch(t.spark, "landing"), scratch(t.spark, "telemetry")
    readings = d.readings(t)
    write_json_batch(readings, f"{landing}/batch_000")
    tables = telemetry.run(t.spark, landing, d.machines(t), root, readings.schema)
    return tables["maintenance"].select("machine_id", "machine_type", "line", "anomalous_reading_count")


@query(
    "stream_progress",
    "SELECT count(*) AS rows_read, false AS still_running, count(*) AS rows_stored FROM events",
)
def stream_progress(t: Tables):
    """What an available-now run reports about itself, beside the rows it stored."""
    landing, table, state = (scratch(t.spark, x) for x in ("landing", "bronze", "state"))
    write_json_batch(_rows(t), landing)
    stream = ingest.stream_json(t.spark, landing, SCHEMA)
    run = ingest.append_stream(stream, table, state, **ingest.trigger_options("available_now"))
    ingest.finish(run)
    read = sum(p["numInputRows"] for p in run.recentProgress)
    stored_rows = t.spark.read.parquet(table).agg(F.count(F.lit(1)).alias("rows_stored"))
    return stored_rows.select(
        F.lit(read).cast("bigint").alias("rows_read"), F.lit(run.isActive).alias("still_running"), "rows_stored"
    )
