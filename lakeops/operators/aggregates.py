"""Grouped results beyond a plain ``groupBy``: pivot, top-k, per-key statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.operators.joins import fits_broadcast, join_salting_hot
from lakeops.session import stored


def pivot_counts(df: DataFrame, group: list[str], pivot_col: str, values: list[str]) -> DataFrame:
    """Row counts with one column per listed value, zero where a group has none.

    Named values spare the extra job that looks for them; the counts are pre-aggregated before the shuffle.
    """
    return df.groupBy(*group).pivot(pivot_col, values).agg(F.count(F.lit(1))).fillna(0, subset=values)


def top_k(df: DataFrame, group: list[str], measure: Column, name: str, k: int) -> DataFrame:
    """The ``k`` groups with the largest measure; equal measures are ordered by the group columns."""
    totals = df.groupBy(*group).agg(measure.alias(name))
    return totals.orderBy(F.desc(name), *group).limit(k)


def count_and_grade(df: DataFrame, by: list[str], count: str, grades: dict[int, str], grade: str, more: dict[str, Column] | None = None) -> DataFrame:
    """Rows per group with a grade by their number: the one with the highest least count that is reached."""
    counted = df.groupBy(*by).agg(F.count(F.lit(1)).alias(count), *[c.alias(n) for n, c in (more or {}).items()])
    reached = [F.when(F.col(count) >= least, name) for least, name in sorted(grades.items(), reverse=True)]
    return counted.withColumn(grade, F.coalesce(*reached))


def zscores(df: DataFrame, key: str, metrics: dict[str, str], hot_share: float = 0.01) -> DataFrame:
    """Distance of each reading from its key's own mean in sample standard deviations.

    ``metrics`` maps a column to the name of its score. A constant or single reading has no score (null).
    The statistics are combined map-side and stored once. Measured small they are broadcast and the readings
    are not shuffled; otherwise they tell which keys hold more than ``hot_share`` of the rows, and the
    readings of those keys are spread by a salt.
    """
    stats = stored(
        df.groupBy(key).agg(
            F.count(F.lit(1)).alias("_n"),
            *[f(m).alias(f"_{p}_{m}") for m in metrics for p, f in (("avg", F.avg), ("std", F.stddev_samp))],
        )
    )
    if fits_broadcast(stats):
        joined = df.join(F.broadcast(stats.drop("_n")), key)
    else:
        cut = stats.agg((F.sum("_n") * F.lit(hot_share)).alias("_cut")).scalar()
        joined = join_salting_hot(df, stats.drop("_n"), key, stats.filter(F.col("_n") > cut).select(key))
    scores = {
        score: F.try_divide(F.col(m) - F.col(f"_avg_{m}"), F.col(f"_std_{m}")) for m, score in metrics.items()
    }
    return joined.withColumns(scores).select(*df.columns, *metrics.values())


def anomalies(df: DataFrame, key: str, metrics: dict[str, str], threshold: float = 2.0) -> DataFrame:
    """Readings with any score above the threshold; an unknown score never flags."""
    scored = zscores(df, key, metrics)
    hit = F.lit(False)
    for score in metrics.values():
        hit = hit | F.coalesce(F.col(score) > threshold, F.lit(False))
    return scored.filter(hit)


def split_random(df: DataFrame, share: float, seed: int) -> tuple[DataFrame, DataFrame]:
    """Random split into a sample of about ``share`` and the rest."""
    first, second = df.randomSplit([share, 1.0 - share], seed=seed)
    return first, second


def split_stratified(df: DataFrame, label: str, unit: str, share: float, seed: int) -> tuple[DataFrame, DataFrame]:
    """Split by a hash of the row's own key, so each label is cut in the same share and re-runs agree."""
    slot = F.pmod(F.xxhash64(F.lit(seed), F.col(label), F.col(unit)), F.lit(10_000))
    cut = int(share * 10_000)
    return df.filter(slot < cut), df.filter(slot >= cut)


def split_exact(df: DataFrame, label: str, unit: str, share: float, seed: int) -> tuple[DataFrame, DataFrame]:
    """Split with ``share`` of every label to the row: ``floor(n * share + 1/2)`` of its n rows, those with the least hash of their unit.

    Two narrow passes find each label's last hash: counts per label and hash range tell in which of ``4096`` ranges the quota is met, and
    only that range is ordered. Rows then go by comparison with it, so the split does not depend on the partitioning and a re-run
    repeats it. ``unit`` is the rows' own key; rows that share one go together.
    """
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(unit).cast("string"), F.lit(""))))
    hashed = df.select(F.col(label).alias("_label"), digest.alias("_hash"), F.col(unit).alias("_unit")).withColumn("_range", F.substring("_hash", 1, 3))
    counts = hashed.groupBy("_label", "_range").agg(F.count(F.lit(1)).alias("_n"))
    each, upto = Window.partitionBy("_label"), Window.partitionBy("_label").orderBy("_range")
    quota = F.floor(F.sum("_n").over(each) * F.lit(share) + F.lit(0.5))
    met = counts.select("_label", "_range", "_n", F.sum("_n").over(upto).alias("_upto"), quota.alias("_quota"))
    met = stored(met.where("_upto >= _quota AND _upto - _n < _quota").select("_label", "_range", (F.col("_quota") - F.col("_upto") + F.col("_n")).alias("_need")), "ranges")
    same = F.col("_label").eqNullSafe(F.col("_l")) & (F.col("_range") == F.col("_r"))
    inside = hashed.join(met.select(F.col("_label").alias("_l"), F.col("_range").alias("_r"), "_need"), same)
    rank = F.row_number().over(Window.partitionBy("_label").orderBy("_hash", "_unit"))
    last = inside.withColumn("_rank", rank).where("_rank = _need").select(F.col("_label").alias("_l"), F.struct("_hash", "_unit").alias("_last"))
    last = stored(last, "thresholds")
    marked = df.join(last, df[label].eqNullSafe(last["_l"]), "left")
    first = F.coalesce(F.struct(digest.alias("_hash"), F.col(unit).alias("_unit")) <= F.col("_last"), F.lit(False))
    return marked.filter(first).select(*df.columns), marked.filter(~first).select(*df.columns)


def bitmaps(df: DataFrame, by: list[str], key: str) -> DataFrame:
    """The distinct values of a dense whole-number key per group, as bitmaps of 32,768 values each; null keys are left out.

    Keys that are no numbers take a surrogate first (:func:`lakeops.operators.ordered.surrogate_key`). Bits are set map-side, so a group of any size
    is shuffled as a few bitmaps per task.
    """
    rows = df.filter(F.col(key).isNotNull()).select(*by, F.bitmap_bucket_number(key).alias("bucket"), F.bitmap_bit_position(key).alias("bit"))
    return rows.groupBy(*by, "bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))


def rolled_up(maps: DataFrame, by: list[str]) -> DataFrame:
    """Bitmaps of coarser groups from those of finer ones; the rows are not read again."""
    return maps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def distinct_counts(maps: DataFrame, by: list[str], name: str) -> DataFrame:
    """Exact distinct counts of the groups the bitmaps are of."""
    return maps.groupBy(*by).agg(F.sum(F.bitmap_count("bits")).alias(name))


def moments(df: DataFrame, key: str, metrics: list[str]) -> DataFrame:
    """Number, mean and sum of squared distances from it, per key and metric; nulls are left out."""
    parts = [p for m in metrics for p in (F.count(m).alias(f"{m}_n"), F.avg(m).alias(f"{m}_mean"), (F.var_pop(m) * F.count(m)).alias(f"{m}_m2"))]
    return df.groupBy(key).agg(*parts)


def merged_moments(old: DataFrame, new: DataFrame, key: str, metrics: list[str]) -> DataFrame:
    """Moments of the rows of both, from the moments alone, by the pairwise update."""
    names = [f"{m}_{p}" for m in metrics for p in ("n", "mean", "m2")]
    a = old.select(F.col(key).alias("_a"), *[F.col(n).alias(f"a_{n}") for n in names])
    b = new.select(F.col(key).alias("_b"), *[F.col(n).alias(f"b_{n}") for n in names])
    out = [F.coalesce("_a", "_b").alias(key)]
    for m in metrics:
        (na, ma, sa), (nb, mb, sb) = ([F.coalesce(F.col(f"{s}_{m}_{p}"), F.lit(0)) for p in ("n", "mean", "m2")] for s in "ab")
        n, apart = na + nb, mb - ma
        mean = F.when(na == 0, F.col(f"b_{m}_mean")).when(nb == 0, F.col(f"a_{m}_mean")).otherwise(ma + apart * nb / n)
        spread = F.when(na == 0, F.col(f"b_{m}_m2")).when(nb == 0, F.col(f"a_{m}_m2")).otherwise(sa + sb + apart * apart * na * nb / n)
        out += [n.alias(f"{m}_n"), mean.alias(f"{m}_mean"), spread.alias(f"{m}_m2")]
    return a.join(b, F.col("_a").eqNullSafe(F.col("_b")), "full").select(*out)


def keep_moments(batch: DataFrame, root: str, number: int, key: str, metrics: list[str]) -> DataFrame:
    """Statistics of all batches up to this one, from the table kept after the one before and this batch's rows.

    One folder per batch under ``root``; a batch done again replaces its own. Earlier rows are not read.
    """
    spark, now = batch.sparkSession, moments(batch, key, metrics)
    if number:
        now = merged_moments(spark.read.parquet(f"{root}/batch={number - 1}"), now, key, metrics)
    now.write.mode("overwrite").parquet(f"{root}/batch={number}")
    return spark.read.parquet(f"{root}/batch={number}")


def moment_scores(df: DataFrame, stats: DataFrame, key: str, metrics: dict[str, str]) -> DataFrame:
    """Distances from the key's mean in sample standard deviations, as in :func:`zscores`, by kept statistics."""
    joined = df.join(stats, key)
    scores = {
        score: F.try_divide(F.col(m) - F.col(f"{m}_mean"), F.sqrt(F.try_divide(F.col(f"{m}_m2"), F.col(f"{m}_n") - 1))) for m, score in metrics.items()
    }
    return joined.withColumns(scores).select(*df.columns, *metrics.values())
