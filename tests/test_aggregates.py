from collections import Counter

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from lakeops.operators import aggregates as a
from lakeops.session import scratch
from lakeops.sources import readers


@pytest.mark.parametrize("share", [0.0, 0.5, 0.8, 1.0])
def test_split_to_the_row(spark, share):
    """Each label within a row of its share, the same rows whatever the partitioning; null labels and units are a label and a unit."""
    df = spark.range(5003).selectExpr("id", "CASE WHEN id % 11 > 0 THEN concat('L', CAST(sqrt(id) / 20 AS int)) END AS label", "1 AS _hash")
    tiny = spark.createDataFrame([(None, "alone", 1), (7, "pair", 1), (8, "pair", 1)], "id long, label string, _hash int")
    df = df.unionByName(tiny)
    first, rest = a.split_exact(df, "label", "id", share, 7)
    sizes = Counter(r.label for r in df.collect())
    taken = Counter(r.label for r in first.collect())
    assert all(taken[x] == int(n * share + 0.5) for x, n in sizes.items())
    assert rows(first.unionByName(rest)) == rows(df) and first.columns == df.columns
    again, _ = a.split_exact(df.repartition(13, "id"), "label", "id", share, 7)
    assert rows(again) == rows(first)


def test_split_of_nothing(spark):
    df = spark.createDataFrame([], "id long, label string")
    assert [x.collect() for x in a.split_exact(df, "label", "id", 0.5, 1)] == [[], []]


def test_distinct_counts_from_bitmaps(spark):
    keys = [0, 1, 32767, 32768, 32769, -1, -40000, 10**12, None]
    df = spark.createDataFrame([(d, g, k) for d in range(4) for g in "ab" for k in keys[d:]] * 2, "d int, g string, k long")
    daily = a.bitmaps(df, ["d", "g"], "k")
    want = df.groupBy("d", "g").agg(F.countDistinct("k").alias("n"))
    assert rows(a.distinct_counts(daily, ["d", "g"], "n")) == rows(want)
    whole = a.rolled_up(daily, ["g"])
    assert rows(a.distinct_counts(whole, ["g"], "n")) == rows(df.groupBy("g").agg(F.countDistinct("k").alias("n")))


def test_moments_kept_over_batches(spark):
    """Against all rows at once: new keys, keys that stop, nulls, constants far from zero, a batch done twice, an empty batch."""
    df = spark.range(900).selectExpr(
        "id % 3 AS part", "CASE WHEN id % 3 = 0 THEN id % 7 ELSE 3 + id % 9 END AS k", "CASE WHEN id % 4 > 0 THEN 1e9 + rand(3) END AS x", "CAST(5 AS double) AS c"
    )
    df = spark.createDataFrame(df.collect(), df.schema)
    root = scratch(spark, "moments")
    for n, part in ((0, 0), (1, 1), (1, 1), (2, 9), (3, 2)):
        kept = a.keep_moments(df.filter(F.col("part") == part), root, n, "k", ["x", "c"])
    want = {r.k: r for r in df.groupBy("k").agg(F.count("x").alias("n"), F.avg("x").alias("m"), F.stddev_samp("x").alias("s")).collect()}
    for r in kept.collect():
        assert r.x_n == want[r.k].n and abs(r.x_mean - want[r.k].m) < 1e-5 and abs((r.x_m2 / (r.x_n - 1)) ** 0.5 - want[r.k].s) < 1e-5
        assert (r.c_mean, r.c_m2) == (5.0, 0.0)
    scores = a.moment_scores(df, kept, "k", {"x": "z", "c": "flat"})
    plain = a.zscores(df, "k", {"x": "z"})
    pairs = list(zip(rows(scores, "k", "x", "z"), rows(plain, "k", "x", "z"), strict=True))
    assert all(p[:2] == q[:2] and (p[2] is q[2] or abs(p[2] - q[2]) < 1e-4) for p, q in pairs)
    assert scores.filter("flat IS NOT NULL").isEmpty()
    assert "batch=2" in plan(kept) or "batch=3" in plan(kept)


def test_count_and_grade(spark):
    df = spark.createDataFrame([("a",)] * 5 + [("b",)] * 2 + [("c",)], "k string")
    graded = a.count_and_grade(df, ["k"], "n", {5: "many", 2: "some"}, "grade")
    assert rows(graded) == [("a", 5, "many"), ("b", 2, "some"), ("c", 1, None)]


def test_drifting_lines(spark):
    landing = scratch(spark, "drift")
    lines = ['{"id": 1, "v": 2}', '{"id": 2, "v": "3", "more": {"x": [1, 2]}}', '{"id": "three", "v": 4.5}', "no json", " "]
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(landing)
    docs = readers.read_variant_lines(spark, landing)
    assert rows(docs.select("_corrupt_record").where("_corrupt_record IS NOT NULL")) == [("no json",)]
    assert readers.variant_schema(docs) == "OBJECT<id: VARIANT, more: OBJECT<x: ARRAY<BIGINT>>, v: VARIANT>"
    got = readers.variant_fields(docs, {"id": ("$.id", "int"), "v": ("$.v", "double"), "x": ("$.more.x[1]", "int"), "text": ("$.id", "string")})
    assert rows(got.where("doc IS NOT NULL"), "id", "v", "x", "text") == sorted([(1, 2.0, None, "1"), (2, 3.0, 2, "2"), (None, 4.5, None, "three")], key=repr)
