import datetime as dt

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from lakeops.operators import joins as j


def skewed(spark, n=2000):
    """Two thirds of the rows share one key, some have none."""
    key = F.when(F.col("id") % 3 > 0, 7).when(F.col("id") % 5 == 0, None).otherwise(F.col("id") % 50).cast("int")
    return spark.range(n).select("id", key.alias("k"))


def test_heavy_keys(spark):
    assert rows(j.heavy_keys(skewed(spark), "k", 0.3)) == [(7,)]


def test_salted_joins_equal_the_plain_join(spark):
    fact = skewed(spark)
    dim = spark.range(40).select(F.col("id").cast("int").alias("k"), (F.col("id") * 2).alias("v"))
    want = rows(fact.join(dim, "k"), "id", "k", "v")
    assert rows(j.salted_join(fact, dim, "k", 5), "id", "k", "v") == want
    hot = j.heavy_keys(fact, "k", 0.3)
    assert rows(j.join_salting_hot(fact, dim, "k", hot, 4), "id", "k", "v") == want
    left = rows(fact.join(dim, "k", "left"), "id", "k", "v")
    assert rows(j.join_salting_hot(fact, dim, "k", hot, 4, "left"), "id", "k", "v") == left


def test_salt_spreads_copies_and_repeats_itself(spark):
    copies = spark.range(0, 4000, 1, 40).select(F.lit(7).alias("k"))
    counted = [
        rows(copies.select(F.spark_partition_id().alias("p"), j.row_salt(copies, 8).alias("s")).groupBy("p", "s").count())
        for _ in range(2)
    ]
    assert counted[0] == counted[1] and len({s for _, s, _ in counted[0]}) > 4


def test_broadcast_only_when_measured_small(spark):
    fact, dim = skewed(spark), spark.range(40).select(F.col("id").cast("int").alias("k"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in plan(j.broadcast_join(fact, dim, "k"))
        assert "SortMergeJoin" in plan(j.broadcast_join(fact, dim, "k", max_bytes=10))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(100 * 1024 * 1024))
    assert j.measured_bytes(spark.range(10).toDF("n")) == 10 * 16
    wide = spark.sql("SELECT 'abc' AS t, CAST(NULL AS string) AS u, map('a', 1) AS m, array(1, 2) AS a")
    assert 8 + 11 + 8 + 2 * 10 < j.measured_bytes(wide) < 100


def test_dim_lookup_gives_unknown_member(spark):
    fact = spark.createDataFrame([("a",), ("z",), (None,)], "code string")
    dim = spark.createDataFrame([("a", 1)], "code string, sk int")
    assert rows(j.dim_lookup(fact, dim, "code", "sk")) == [("a", 1), ("z", -1), (None, -1)]


def day(n):
    return dt.date(2025, 1, 1) + dt.timedelta(days=n)


def stays(spark):
    data = [(1, 1, 0, 5), (2, 1, 5, 6), (3, 1, 36, 40), (4, 2, 0, 5), (5, 2, 36, 37), (6, 3, 3, 3), (7, None, 0, 1),
            (8, None, 2, 3), (9, 1, 41, 45)]
    return spark.createDataFrame(
        [(i, p, day(a), day(b)) for i, p, a, b in data], "id int, p int, admit date, discharge date"
    )


def test_followed_within_equals_the_self_join(spark):
    df = stays(spark)
    got = rows(j.followed_within(df, "p", "admit", "discharge", 30, "again"), "id", "again")
    plain = {r[0]: (r[1], r[2], r[3]) for r in df.collect()}
    want = sorted(
        (i, any(p is not None and q == p and 0 < (a - d).days <= 30 for q, a, _ in plain.values()))
        for i, (p, _, d) in plain.items()
    )
    assert got == want


def test_census_counts_half_open_days(spark):
    members = spark.createDataFrame([(1,), (2,), (9,)], "p int")
    first, last = F.lit(day(2)), F.lit(day(38))
    got = {(r.p, r.day): r.n for r in j.interval_census(
        stays(spark).filter("p IS NOT NULL"), members, "p", "admit", "discharge", first, last, "n").collect()}
    assert len(got) == 3 * 37
    for (p, d), n in got.items():
        inside = [r for r in stays(spark).filter(f"p = {p}").collect() if r.admit <= d < r.discharge] if p != 9 else []
        if d in (day(2), day(4), day(5), day(36), day(38)):
            assert n == len(inside), (p, d)


def test_salted_join_kinds(spark):
    fact, dim = spark.createDataFrame([(1, {"a": 1})], "k int, m map<string,int>"), spark.createDataFrame([(1, 1), (2, 2)], "k int, v int")
    hot = dim.select("k")
    for how in ("right", "full", "outer", "left_anti"):
        with pytest.raises(ValueError):
            j.join_salting_hot(fact, dim, "k", hot, 4, how)
    assert rows(j.join_salting_hot(fact, dim, "k", hot, 4), "k", "v") == [(1, 1)]
    assert rows(j.salted_join(fact, dim, "k", 4), "k", "v") == [(1, 1)]
