import datetime as dt
from decimal import Decimal

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakeops.operators import ordered as o

SCHEMA = "id int, k int, d date, v decimal(10,2)"


def plain(df):
    w = Window.partitionBy("k").orderBy("d", "id")
    total = F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0))
    return df.select("id", F.row_number().over(w).alias("n"), F.lag("v").over(w).alias("p"), total.alias("t"))


def cut(df, hot_rows):
    return o.windowed(df, ["k"], ["d", "id"], "n", {"p": "v"}, {"t": "v"}, hot_rows=hot_rows).select("id", "n", "p", "t")


@pytest.mark.parametrize("hot_rows", [None, 10**9, 200, 20])
def test_cut_windows_equal_plain_windows(spark, hot_rows):
    i = F.col("id")
    df = spark.range(3000).select(
        i.cast("int").alias("id"),
        F.when(i % 3 > 0, 1).when(i % 11 == 0, None).otherwise(i % 40).cast("int").alias("k"),
        F.when(i % 4 == 0, F.lit(dt.date(2025, 3, 1))).when(i % 17 == 0, None)
        .otherwise(F.date_add(F.lit(dt.date(2025, 1, 1)), (i * 7 % 300).cast("int"))).alias("d"),
        F.when(i % 13 != 0, (i * 31 % 1000) / 100).cast("decimal(10,2)").alias("v"),
    )
    if hot_rows == 20:
        blocks = o.cut_blocks(df, ["k"], ["d", "id"], hot_rows)
        largest = blocks.df.groupBy(*blocks.cols).count().agg(F.max("count")).first()[0]
        assert blocks.cols == ["_block"] and largest < 8 * hot_rows
    assert rows(cut(df, hot_rows)) == rows(plain(df))


row = st.tuples(
    st.sampled_from([None, 1, 1, 1, 2]),
    st.one_of(st.none(), st.integers(0, 6).map(lambda n: dt.date(2025, 1, 1) + dt.timedelta(days=n))),
    st.one_of(st.none(), st.integers(-500, 500).map(lambda n: Decimal(n) / 100)),
)


@settings(max_examples=8, deadline=None, derandomize=True, database=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row, min_size=1, max_size=60))
def test_cut_windows_on_any_rows(spark, data):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(data)], SCHEMA)
    assert rows(cut(df, 4)) == rows(plain(df))


def test_gaps(spark):
    days = [dt.date(2025, 1, 1), dt.date(2025, 1, 8), None, dt.date(2025, 1, 8)]
    df = spark.createDataFrame([(i, 1, d, None) for i, d in enumerate(days)], SCHEMA)
    got = o.sequence_and_gaps(df, ["k"], ["d", "id"], "d")
    assert rows(got, "id", "visit_number", "days_since_prev") == [(0, 2, None), (1, 3, 7), (2, 1, None), (3, 4, 0)]


@pytest.mark.parametrize("descending", [True, False])
@pytest.mark.parametrize("hot_rows", [None, 15])
def test_dense_rank_with_nulls(spark, descending, hot_rows):
    i = F.col("id")
    df = spark.range(400).select(
        i, (i % 3).alias("g"), F.when(i % 7 != 0, (i * 37 % 90)).cast("double").alias("m")
    )
    order = F.col("m").desc() if descending else F.col("m").asc()
    want = df.withColumn("r", F.dense_rank().over(Window.partitionBy("g").orderBy(order)))
    got = o.dense_rank_by(df, ["g"], "m", "r", descending, hot_rows)
    assert rows(got, "id", "r") == rows(want, "id", "r")


def test_surrogate_keys_are_dense_and_in_order(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("x"), F.concat(F.lit("c"), F.col("id") % 3).alias("s"))
    got = o.surrogate_key(df.repartition(6), ["s", "x"], "key")
    want = df.withColumn("key", F.row_number().over(Window.orderBy("s", "x")).cast("long"))
    assert rows(got) == rows(want)


def test_long_numbers_that_are_equal_as_doubles(spark):
    i = F.col("id")
    df = spark.range(600).select(
        (600 - i).cast("int").alias("id"), F.lit(1).alias("k"), (F.lit(2**60) + i).alias("d"),
        (i % 7).cast("decimal(10,2)").alias("v"),
    )
    assert rows(cut(df, 20)) == rows(plain(df))


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "double", "decimal(12,3)", "int"])
def test_order_types(spark, kind):
    """Close values, nulls and a repeated autumn hour (the session zone has one in this test)."""
    i = F.col("id")
    seconds = 1_761_436_800 + (i * 7919 % 500) * 30 + (i % 3) * 0.000001
    moment = F.timestamp_micros((seconds * 1_000_000).cast("long"))
    value = {
        "timestamp": moment, "timestamp_ntz": moment.cast("timestamp_ntz"), "double": (i * 31 % 97 - 48) / 7,
    }.get(kind, (i * 31 % 97 - 48).cast(kind))
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        df = spark.range(500).select(
            i.cast("int").alias("id"), F.lit(1).alias("k"), F.when(i % 9 != 0, value).alias("d"),
            (i % 7).cast("decimal(10,2)").alias("v"),
        )
        assert rows(cut(df, 25)) == rows(plain(df))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_text_order(spark):
    """Text with common heads, empty, null and non-ASCII values, as first and as second order column."""
    i = F.col("id")
    names = F.array(*[F.lit(x) for x in ("", "a", "shipment-1", "shipment-2", "zß", "é", "日本")])
    df = spark.range(700).select(
        i.cast("int").alias("id"), F.lit(1).alias("k"), F.when(i % 11 != 0, names[(i % 7).cast("int")]).alias("s"),
        F.when(i % 3 == 0, 5).otherwise(i % 40).alias("d"), (i % 13).cast("decimal(10,2)").alias("v"),
    )
    for order in (["s", "id"], ["d", "s", "id"]):
        w = Window.partitionBy("k").orderBy(*order)
        want = df.select("id", F.row_number().over(w).alias("n"), F.lag("v").over(w).alias("p"))
        blocks = o.cut_blocks(df, ["k"], order, 30)
        assert blocks.df.select(*blocks.cols).distinct().count() > 15
        got = o.windowed(df, ["k"], order, "n", {"p": "v"}, hot_rows=30)
        assert rows(got, "id", "n", "p") == rows(want)


def test_nested_order(spark):
    df = spark.range(60).select("id", F.array(F.col("id") % 7, F.col("id")).alias("a"), F.lit(1).alias("k"))
    want = df.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy("a")).cast("bigint"))
    assert rows(o.windowed(df, ["k"], ["a"], "n", hot_rows=5)) == rows(want)


def test_more_hot_keys_than_partitions(spark):
    """Many equal hot keys, text orders with a long common head, ties across the whole key."""
    i = F.col("id")
    df = spark.range(4000).select(
        i.cast("int").alias("id"), (i % 40).cast("int").alias("k"), F.concat(F.lit("ORDER#000000000"), F.lpad(i.cast("string"), 9, "0")).alias("d"),
        (i % 13).cast("decimal(10,2)").alias("v"),
    )
    blocks = o.cut_blocks(df, ["k"], ["d"], 25)
    sizes = blocks.df.groupBy("k", "_block").count().groupBy("k").agg(F.count(F.lit(1)).alias("blocks"), F.max("count").alias("most"))
    assert sizes.where("blocks < 3 OR most > 90").count() == 0
    w = Window.partitionBy("k").orderBy("d")
    total = F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0))
    want = df.select("id", F.row_number().over(w).alias("n"), F.lag("v").over(w).alias("p"), total.alias("t"))
    assert rows(o.windowed(df, ["k"], ["d"], "n", {"p": "v"}, {"t": "v"}, hot_rows=25).select("id", "n", "p", "t")) == rows(want)


def test_blocks_do_not_grow_with_small_hot_rows(spark):
    """The driver gets sampled rows and task results per block, so their number must not follow the rows."""
    df = spark.range(5000).select("id", F.lit(1).alias("k"))
    blocks = o.cut_blocks(df, ["k"], ["id"], 10)
    assert blocks.df.select(*blocks.cols).distinct().count() <= o.SMALL_BLOCKS
    got = o.windowed(df, ["k"], ["id"], "n", lags={"p": "id"}, hot_rows=10).select("id", "n", "p")
    assert rows(got) == sorted(((i, i + 1, i - 1 if i else None) for i in range(5000)), key=repr)


def test_numbers_are_long(spark):
    df = spark.range(50).select("id", F.lit(1).alias("k"))
    for hot in (None, 10):
        assert dict(o.windowed(df, ["k"], ["id"], "n", hot_rows=hot).dtypes)["n"] == "bigint"
        assert dict(o.dense_rank_by(df, ["k"], "id", "r", hot_rows=hot).dtypes)["r"] == "bigint"
