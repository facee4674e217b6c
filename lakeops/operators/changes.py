"""Table changes as plain DataFrame transformations: upsert, insert-only merge, change feed, as-of, reload.

No transactional table format is assumed. The functions return the new content; writing it is the caller's
step, either into a new version folder or by replacing the touched partitions.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.functions.scalars import holds
from lakeops.operators.clean import dedup
from lakeops.operators.joins import BROADCAST_BYTES, fits_broadcast
from lakeops.session import stored
from lakeops.sources.files import exists, matching
from lakeops.sources.sinks import overwrite_partitions, replace_slice

CHANGE_TYPE, VERSION, COMMITTED = "_change_type", "_commit_version", "_commit_timestamp"
FEED_COLUMNS = (CHANGE_TYPE, VERSION, COMMITTED)


class DuplicateKeyError(ValueError):
    """The source of a merge holds a key more than once, so the result would be arbitrary."""


def require_unique(df: DataFrame, keys: list[str], nulls: bool = False) -> None:
    """Raise when a key occurs twice; keys with a null count only with ``nulls``, for merges that match them."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    counted = F.lit(True) if nulls else reduce(and_, [F.col(k).isNotNull() for k in keys])
    most = counts.agg(F.max(F.when(counted, F.col("_n")))).first()[0] or 0
    if most > 1:
        raise DuplicateKeyError(f"a key of {keys} occurs {most} times in the merge source")


def new_rows(updates: DataFrame, target: DataFrame, keys: list[str], small: bool) -> DataFrame:
    """Updates whose key is not in the target.

    The target gives only the keys that the updates name. ``small`` says that the updates were measured small:
    then they are broadcast and the target is scanned without a shuffle.
    """
    wanted = updates.select(*keys)
    named = target.select(*keys).join(F.broadcast(wanted) if small else wanted, keys, "left_semi").distinct()
    return updates.join(named, keys, "left_anti")


def upsert(
    target: DataFrame,
    updates: DataFrame,
    keys: list[str],
    update_cols: list[str] | None = None,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Keep one current row per key: matched rows take ``update_cols`` (default: all), new keys are inserted.

    A null in a matched update wins. The batch is stored, so all passes see the same rows. One that was measured small is
    broadcast and the target is not shuffled; a large one goes through one full outer join.
    """
    rest = [c for c in target.columns if c not in keys]
    changed = set(rest if update_cols is None else update_cols)
    source = stored(updates.select(*target.columns), "updates")
    require_unique(source, keys)
    small = fits_broadcast(source, max_bytes)
    fresh = source.select(*keys, *[F.col(c).alias(f"_u_{c}") for c in rest], F.lit(True).alias("_in_u"))

    if small:
        merged = target.join(F.broadcast(fresh), keys, "left")
        kept = merged.select(
            *[
                c if c not in changed else F.when(F.col("_in_u"), F.col(f"_u_{c}")).otherwise(F.col(c)).alias(c)
                for c in target.columns
            ]
        )
        return kept.unionByName(new_rows(source, target, keys, True))

    both = target.withColumn("_in_t", F.lit(True)).join(fresh, keys, "full")
    taken = []
    for c in target.columns:
        from_update = F.col("_in_t").isNull() if c not in changed else F.col("_in_u").isNotNull()
        taken.append(c if c in keys else F.when(from_update, F.col(f"_u_{c}")).otherwise(F.col(c)).alias(c))
    return both.select(*taken)


def insert_only(target: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """Add the rows whose key is new; rows already there never change."""
    source = stored(updates, "updates")
    return target.unionByName(new_rows(source, target, keys, fits_broadcast(source.select(*keys))))


def conditional_update(df: DataFrame, where: Column, values: dict[str, Column]) -> DataFrame:
    """SQL UPDATE: new values where the condition is true, an unknown condition changes nothing."""
    hit = holds(where)
    return df.withColumns({
        c: F.when(hit, v).otherwise(F.col(c)).cast(df.schema[c].dataType) for c, v in values.items()
    })


def delete_where(df: DataFrame, where: Column) -> DataFrame:
    """SQL DELETE: rows with an unknown condition stay."""
    return df.filter(~holds(where))


def _any(column: str) -> Column:
    """The only value of a group that is not null."""
    return F.first(column, ignorenulls=True)


def change_feed(
    old: DataFrame, new: DataFrame, keys: list[str], version: int, committed: Column | None = None
) -> DataFrame:
    """Row changes that turn ``old`` into ``new``: insert, delete, update_preimage, update_postimage.

    A null is a key value like any other. Both sides go through one shuffle, as rows of one table that are grouped by key; the job
    that reads the feed stops at a key that repeats on either side.
    """
    rest = [c for c in new.columns if c not in keys]

    def side(df: DataFrame, mine: str, other: str) -> DataFrame:
        row = F.struct(*[F.col(c).cast(new.schema[c].dataType).alias(c) for c in rest])
        return df.select(*keys, row.alias(mine), F.lit(None).cast(df.select(row.alias("r")).schema["r"].dataType).alias(other))

    both = side(old, "_old", "_new").unionByName(side(new, "_new", "_old")).groupBy(*keys)
    paired = both.agg(*[f(c).alias(n) for c in ("_old", "_new") for f, n in ((_any, c), (F.count, f"{c}_n"))])
    most = F.greatest("_old_n", "_new_n")
    stop = F.raise_error(F.concat(F.lit(f"a key of {keys} occurs "), most.cast("string"), F.lit(" times on one side of a change feed")))
    paired = paired.filter(F.when(most <= 1, F.lit(True)).otherwise(stop.cast("boolean")))

    def change(kind: str, row: str) -> Column:
        return F.struct(F.lit(kind).alias("kind"), F.col(row).alias("row"))

    changes = (
        F.when(F.col("_old").isNull(), F.array(change("insert", "_new")))
        .when(F.col("_new").isNull(), F.array(change("delete", "_old")))
        .when(
            ~F.col("_old").eqNullSafe(F.col("_new")),
            F.array(change("update_preimage", "_old"), change("update_postimage", "_new")),
        )
    )
    return paired.select(*keys, F.explode(changes).alias("_c")).select(
        *keys,
        *[F.col("_c.row")[c].alias(c) for c in rest],
        F.col("_c.kind").alias(CHANGE_TYPE),
        F.lit(version).cast("long").alias(VERSION),
        (F.current_timestamp() if committed is None else committed).alias(COMMITTED),
    )


def as_of(log: DataFrame, keys: list[str], version: int | None = None, ts: Column | None = None) -> DataFrame:
    """Table content at a version or time, from the change log alone."""
    seen = log.filter(F.col(CHANGE_TYPE) != "update_preimage")
    if version is not None:
        seen = seen.filter(F.col(VERSION) <= version)
    if ts is not None:
        seen = seen.filter(F.col(COMMITTED) <= ts)
    return dedup(seen, keys, [VERSION]).filter(F.col(CHANGE_TYPE) != "delete").drop(*FEED_COLUMNS)


def commit(feed: DataFrame, root: str, keys: list[str], version: int, at: dt.datetime, every: int = 10) -> None:
    """Append a feed as a version of the table under ``root``, and every so many versions the whole content as a snapshot.

    ``root/log`` has one folder per version, ``root/snapshots`` one per snapshot, named by version and time. A commit done again replaces
    its own folders.
    """
    rows = feed.withColumns({VERSION: F.lit(version).cast("long"), COMMITTED: F.lit(at)})
    overwrite_partitions(rows, f"{root}/log", [VERSION], spread=False)
    if version % every == 0:
        content = _stored_content(feed.sparkSession, root, keys, version, None, below=version)
        content.write.mode("overwrite").parquet(f"{root}/snapshots/version={version}/at={_micros(at)}")


def _micros(at: dt.datetime) -> int:
    return (at.replace(tzinfo=None) - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)


def as_of_stored(spark: SparkSession, root: str, keys: list[str], version: int | None = None, at: dt.datetime | None = None) -> DataFrame:
    """Content at a version or time, from the last snapshot up to it and the log after that; the log before it is not read."""
    return _stored_content(spark, root, keys, version, at)


def _stored_content(spark: SparkSession, root: str, keys: list[str], version: int | None, at: dt.datetime | None, below: int | None = None) -> DataFrame:
    """``below``: only snapshots of earlier versions, for one that is about to be replaced."""
    start = None
    for folder in matching(spark, f"{root}/snapshots/version=*/at=*"):
        v, when = (int(p.split("=")[1]) for p in folder.rsplit("/", 2)[1:])
        known = exists(spark, f"{folder}/_SUCCESS") and (below is None or v < below) and (version is None or v <= version) and (at is None or when <= _micros(at))
        start = max(start or (v, folder), (v, folder)) if known else start
    log = spark.read.parquet(f"{root}/log")
    tail = log.filter(F.col(VERSION) > (start[0] if start else -1))
    tail = tail if version is None else tail.filter(F.col(VERSION) <= version)
    tail = tail if at is None else tail.filter(F.col(COMMITTED) <= F.lit(at))
    if start is None:
        return as_of(tail, keys)
    return apply_feed(spark.read.parquet(start[1]), tail, keys)


def apply_feed(table: DataFrame, feed: DataFrame, keys: list[str]) -> DataFrame:
    """Bring a copy of the old table forward by a change feed."""
    last = dedup(feed.filter(F.col(CHANGE_TYPE) != "update_preimage"), keys, [VERSION])
    untouched = table.join(feed.select(*keys).distinct(), keys, "left_anti")
    return untouched.unionByName(last.filter(F.col(CHANGE_TYPE) != "delete").drop(*FEED_COLUMNS))


def restore(log: DataFrame, current: DataFrame, keys: list[str], version: int, new_version: int) -> DataFrame:
    """Changes that bring the table back to an earlier version, to be appended as a new version."""
    return change_feed(current, as_of(log, keys, version=version), keys, new_version)


def history(log: DataFrame) -> DataFrame:
    """Versions with their commit time and row changes by kind."""
    def n(kind: str) -> Column:
        return F.count_if(F.col(CHANGE_TYPE) == kind)

    return log.groupBy(VERSION).agg(
        F.max(COMMITTED).alias(COMMITTED),
        n("insert").alias("inserted"),
        n("update_postimage").alias("updated"),
        n("delete").alias("deleted"),
    )


def repair_from(target: DataFrame, backup: DataFrame, keys: list[str], cols: list[str], where: Column) -> DataFrame:
    """Take ``cols`` from the backup for the rows that meet ``where``; only those rows are joined.

    A key that repeats in the backup raises :class:`DuplicateKeyError`.
    """
    require_unique(backup, keys)
    hit = holds(where)
    saved = backup.select(*keys, *[F.col(c).alias(f"_b_{c}") for c in cols], F.lit(True).alias("_in_b"))
    damaged = target.filter(hit).join(saved, keys, "left")
    fixed = damaged.select(
        *[
            F.when(F.col("_in_b"), F.col(f"_b_{c}")).otherwise(F.col(c)).alias(c) if c in cols else F.col(c)
            for c in target.columns
        ]
    )
    return target.filter(~hit).unionByName(fixed)


def reload_slice(
    fact: DataFrame, delta: DataFrame, slice_col: str, value: object, name: str = "reload_slice"
) -> tuple[DataFrame, DataFrame]:
    """Replace one slice of the fact by the delta's rows of that slice; running it twice changes nothing more.

    Returns the new fact and its one-row log.
    """
    here = F.col(slice_col) == F.lit(value)
    added = delta.filter(here).select(*fact.columns)
    new_fact = delete_where(fact, here).unionByName(added)
    sides = fact.filter(here).select(F.lit(1).alias("d"), F.lit(0).alias("i")).unionAll(
        added.select(F.lit(0), F.lit(1))
    )
    log = sides.agg(
        F.coalesce(F.sum("d"), F.lit(0)).alias("rows_deleted"), F.coalesce(F.sum("i"), F.lit(0)).alias("rows_inserted")
    ).select(
        F.current_timestamp().alias("log_ts"),
        F.lit(name).alias("proc_name"),
        F.lit(value).alias(slice_col),
        "rows_deleted",
        "rows_inserted",
        F.lit("SUCCESS").alias("status"),
        F.lit(None).cast("string").alias("message"),
    )
    return new_fact, log


LOG_SCHEMA = "proc_name string, slice string, rows_deleted long, rows_inserted long, status string, message string"


def run_slice_load(
    spark: SparkSession, fact_path: str, delta: DataFrame, slice_col: str, value: object, name: str = "load_slice"
) -> DataFrame:
    """Reload one partition of a fact folder that is partitioned by ``slice_col``; returns the log row.

    The delta is stored and both sides are counted first; the last step replaces the slice, so a failure leaves the fact as it
    was and logs zero rows with the message. An empty delta empties the slice.
    """
    def log(deleted: int, inserted: int, status: str, message: str | None) -> DataFrame:
        row = [(name, str(value), deleted, inserted, status, message)]
        return spark.createDataFrame(row, LOG_SCHEMA).withColumn("log_ts", F.current_timestamp())

    try:
        fact = spark.read.parquet(fact_path)
        here = F.col(slice_col) == F.lit(value)
        added = stored(delta.filter(here).select(*fact.columns), "slice")
        deleted, inserted = fact.filter(here).count(), added.count()
        replace_slice(added, fact_path, slice_col, value, spread=True)
    except Exception as problem:  # the run log must record any failure
        return log(0, 0, "FAILED", str(problem))
    return log(deleted, inserted, "SUCCESS", None)
