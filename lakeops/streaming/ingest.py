"""Incremental ingest with Structured Streaming and the handoff to batch tables."""

from __future__ import annotations

import hashlib
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lakeops.operators.clean import dedup
from lakeops.sources.files import matching, remove
from lakeops.sources.readers import parse_payload
from lakeops.sources.sinks import overwrite_partitions

STREAM, BATCH, MERGED = "_stream", "_batch_id", "_merged_at"
LEVEL, BUCKET, RUN = "_level", "_bucket", "_run"
# Order of arrival: rows of equal time are of one batch or of several streams.
ARRIVAL = [MERGED, BATCH, STREAM]


def stream_json(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    """New JSON files of a folder tree as a stream; ``max_files`` bounds one micro-batch."""
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", True)
    return (reader.option("maxFilesPerTrigger", max_files) if max_files else reader).json(path)


def stream_messages(messages: DataFrame, schema: T.StructType, enqueued: str = "enqueued_ts") -> DataFrame:
    """Message log rows (``value`` binary, ``timestamp``) parsed to columns, with the enqueue time kept."""
    return parse_payload(messages.withColumnRenamed("timestamp", enqueued), "value", schema, enqueued)


def clean_stream(stream: DataFrame, required: str, event_time: str, lateness: str = "10 minutes") -> DataFrame:
    """Drop rows without the required value, stamp the ingest time, declare how late an event may be."""
    return (
        stream.filter(F.col(required).isNotNull())
        .withColumn("ingest_ts", F.current_timestamp())
        .withWatermark(event_time, lateness)
    )


def trigger_options(mode: str = "available_now", interval: str = "1 minute") -> dict:
    """``available_now`` takes what is there in bounded batches and stops; ``interval`` keeps running."""
    if mode == "available_now":
        return {"availableNow": True}
    if mode == "interval":
        return {"processingTime": interval}
    raise ValueError(f"unknown trigger {mode}")


def append_stream(
    stream: DataFrame, path: str, checkpoint: str, name: str | None = None, **trigger
) -> StreamingQuery:
    """Append to a Parquet folder; the checkpoint makes each input file count once."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    writer = writer.queryName(name) if name else writer
    return writer.trigger(**(trigger or trigger_options())).start(path)


def append_stream_table(stream: DataFrame, table: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Append to a catalog table."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or trigger_options())).toTable(table)


def once_within(stream: DataFrame, keys: list[str], event_time: str, lateness: str = "10 minutes") -> DataFrame:
    """The first row of each key, as long as its copies arrive within ``lateness`` of event time, across restarts on one checkpoint.

    The state store keeps a key until the watermark has passed it by that time, so it holds what arrived in the last stretch
    of event time and not all keys ever seen. Rows older than the watermark are dropped as late.
    """
    return stream.withWatermark(event_time, lateness).dropDuplicatesWithinWatermark(keys)


def stream_upsert(
    stream: DataFrame, keys: list[str], order_by: list[str], path: str, checkpoint: str, fanout: int = 8, buckets: int = 16, **trigger
) -> StreamingQuery:
    """Keyed upsert per micro-batch.

    A batch is reduced to the latest row per key by ``order_by`` and written to a folder of its own on level 0, named by the stream
    and the batch number; :func:`fold_upserts` then keeps the number of folders small at a cost that does not grow with the table.
    A replayed batch replaces its own folder; a stream that lost its checkpoint is a new stream and touches no earlier folder.
    Read the current rows with :func:`current_rows`.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        stream_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        upsert_batch(batch, keys, order_by, path, stream_id, batch_id)
        fold_upserts(batch.sparkSession, path, keys, order_by, fanout, buckets)

    writer = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or trigger_options())).start()


def upsert_batch(batch: DataFrame, keys: list[str], order_by: list[str], path: str, stream_id: str, batch_id: int) -> None:
    """One batch as a folder on level 0."""
    latest = dedup(batch, keys, order_by).withColumns({
        MERGED: F.current_timestamp(), STREAM: F.lit(stream_id), BATCH: F.lit(batch_id).cast("long"),
    })
    latest.write.mode("overwrite").parquet(f"{path}/{LEVEL}=0/{BUCKET}=-1/{RUN}=s-{stream_id}-{batch_id}")


def current_rows(spark: SparkSession, path: str, keys: list[str], event_order: list[str] | None = None) -> DataFrame:
    """Current row per key of an upserted folder: the one merged last, or with ``event_order`` the one latest by these columns.

    By arrival a late event replaces a newer row, as in a plain merge per batch; by event order it does not. ``event_order`` is
    the order the batches were upserted by, which folds keep.
    """
    rows = spark.read.parquet(path)
    return dedup(rows, keys, [*(event_order or []), *ARRIVAL]).drop(*ARRIVAL, LEVEL, BUCKET, RUN)


Folder = tuple[int, int, str]  # level, bucket, run


def upsert_folders(spark: SparkSession, path: str) -> list[Folder]:
    """The folders of an upserted table, from their names."""
    found = []
    for folder in matching(spark, f"{path}/{LEVEL}=*/{BUCKET}=*/{RUN}=*"):
        level, bucket, run = (unquote(p.split("=", 1)[1]) for p in folder.rsplit("/", 3)[1:])
        found.append((int(level), int(bucket), run))
    return sorted(found)


def _due(folders: list[Folder], fanout: int) -> list[list[Folder]]:
    """Groups of folders to fold, the fullest first: of level 0 all but each stream's last batch, above it those of one bucket."""
    last: dict[str, int] = {}
    for level, _, run in folders:
        if level == 0:
            stream, batch = run.removeprefix("s-").rsplit("-", 1)
            last[stream] = max(last.get(stream, -1), int(batch))
    groups: dict[tuple[int, int], list[Folder]] = {}
    for level, bucket, run in folders:
        if level or int(run.rsplit("-", 1)[1]) < last[run.removeprefix("s-").rsplit("-", 1)[0]]:
            groups.setdefault((level, bucket), []).append((level, bucket, run))
    full = [g for g in groups.values() if len(g) >= fanout]
    return sorted(full, key=lambda g: (-len(g), g[0]))


def fold_upserts(spark: SparkSession, path: str, keys: list[str], order_by: list[str], fanout: int = 8, buckets: int = 16, most: int = 2) -> int:
    """Fold what has piled up, at most ``most`` groups of folders; returns how many folders went.

    ``fanout`` batches of level 0 become one folder per bucket, a hash of the key, on level 1; ``fanout`` folders of one bucket
    and level become one on the next. So a row is rewritten once a level, the levels grow with the logarithm of the batches, and a fold
    reads one level of one bucket, never the table. A fold keeps per key the row latest by arrival and the one latest by
    ``order_by``, so both readings of :func:`current_rows` are those of the unfolded batches. The last batch of a stream may be
    replayed and stays. New folders are complete before the old ones go; a fold cut short leaves rows twice, which reading and the next
    fold resolve.
    """
    gone = 0
    for group in _due(upsert_folders(spark, path), fanout)[:most]:
        names = [f"{path}/{LEVEL}={level}/{BUCKET}={bucket}/{RUN}={run}" for level, bucket, run in group]
        rows = spark.read.option("basePath", path).parquet(*names).drop(LEVEL, BUCKET, RUN)
        level, bucket, run = group[0]
        place = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int") if level == 0 else F.lit(bucket)
        # Named by what it is made of: a fold done again writes the same folder.
        name = "f-" + hashlib.sha256("|".join(g[2] for g in group).encode()).hexdigest()[:24]
        kept = _both_latest(rows, keys, order_by).withColumns({LEVEL: F.lit(level + 1), BUCKET: place, RUN: F.lit(name)})
        overwrite_partitions(kept, path, [LEVEL, BUCKET, RUN], spread=False)
        for folder in names:
            remove(spark, folder)
        gone += len(group)
    return gone


def _both_latest(rows: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """Per key the row latest by arrival and the row latest by event, which may be the same."""
    by_arrival = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in ARRIVAL])
    by_event = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in (*order_by, *ARRIVAL)])
    ranked = rows.withColumns({"_arrival": F.row_number().over(by_arrival), "_event": F.row_number().over(by_event)})
    return ranked.where("_arrival = 1 OR _event = 1").drop("_arrival", "_event")


def finish(query: StreamingQuery) -> dict | None:
    """Wait for an available-now run and return its last progress."""
    query.awaitTermination()
    progress = query.lastProgress
    return dict(progress) if progress else None


def active_streams(spark: SparkSession) -> list[tuple]:
    """Identity and state of the running queries."""
    return [(q.id, q.name, q.status["message"]) for q in spark.streams.active]
