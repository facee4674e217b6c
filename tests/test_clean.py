from conftest import plan, rows
from pyspark.sql import functions as F

from lakeops.operators import clean


def test_dedup_keeps_the_named_end(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", 1, "q"), (None, 1, "n")],
                               "k string, t int, v string")
    assert rows(clean.dedup(df, ["k"], ["t", "v"]), "k", "v") == [("a", "z"), ("b", "q"), (None, "n")]
    assert rows(clean.dedup(df, ["k"], ["t", "v"], keep="first"), "k", "v") == [("a", "x"), ("b", "q"), (None, "n")]


def test_dedup_reduces_before_the_shuffle(spark):
    df = spark.range(10).select((F.col("id") % 3).alias("k"), "id")
    text = plan(clean.dedup(df, ["k"], ["id"]))
    assert text.count("WindowGroupLimit") == 2  # per map task, then per key
    assert text.rindex("WindowGroupLimit") > text.index("Exchange")


def test_repairs(spark):
    df = spark.createDataFrame([(-5, " north ", None), (3, "SOUTH", 1.0), (None, None, 2.0)], "n int, s string, d double")
    assert rows(clean.null_out(df, "n", F.col("n") < 0), "n") == [(3,), (None,), (None,)]
    assert rows(clean.repair_sign(df, "n"), "n") == [(3,), (5,), (None,)]
    assert rows(df.select(clean.tidy_name("s").alias("s"))) == [("North",), ("South",), (None,)]
    assert rows(df.filter(clean.non_blank("s")), "n") == [(-5,), (3,)]
    assert rows(clean.fill(df, {"s": "?"}, numeric=0), "n", "s", "d") == [(-5, " north ", 0.0), (0, "?", 2.0), (3, "SOUTH", 1.0)]
    assert clean.with_typed_null(df, "r", "double").schema["r"].dataType.simpleString() == "double"
