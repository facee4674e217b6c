"""Operators against brute force on generated rows."""

import datetime as dt
from collections import Counter

from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakeops.operators import changes, clean, joins, quality

FEW = settings(max_examples=6, deadline=None, derandomize=True, database=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
START = dt.date(2025, 1, 1)


def day(n):
    return None if n is None else START + dt.timedelta(days=n)


stay = st.tuples(st.sampled_from([None, 1, 1, 2]), st.integers(0, 90), st.integers(0, 12))


@FEW
@given(st.lists(stay, min_size=1, max_size=40), st.sampled_from([1, 7, 30]))
def test_followed_within(spark, data, days):
    table = [(i, k, day(a), day(a + n)) for i, (k, a, n) in enumerate(data)]
    df = spark.createDataFrame(table, "id int, k int, a date, b date")
    want = sorted(
        ((i, any(k is not None and k2 == k and 0 < (a2 - b).days <= days for _, k2, a2, _ in table)) for i, k, _, b in table),
        key=repr,
    )
    assert rows(joins.followed_within(df, "k", "a", "b", days, "f"), "id", "f") == want


@FEW
@given(st.lists(stay, min_size=1, max_size=40))
def test_census(spark, data):
    table = [(k, day(a), day(a + n)) for k, a, n in data if k is not None] or [(1, START, START)]
    df = spark.createDataFrame(table, "k int, a date, b date")
    members = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    got = joins.interval_census(df, members, "k", "a", "b", F.lit(day(10)), F.lit(day(60)), "n")
    want = [
        (m, day(n), sum(1 for k, a, b in table if k == m and a <= day(n) < b)) for m in (1, 2, 3) for n in range(10, 61)
    ]
    assert rows(got, "k", "day", "n") == sorted(want, key=repr)


version = st.dictionaries(st.integers(0, 9), st.one_of(st.none(), st.integers(0, 3)), max_size=10)


@FEW
@given(version, version, version)
def test_change_log(spark, first, second, third):
    schema = "id int, v int"
    tables = [spark.createDataFrame(sorted(t.items()), schema) for t in (first, second, third)]
    log = changes.change_feed(tables[0].limit(0), tables[0], ["id"], 0)
    for n in (1, 2):
        log = log.unionByName(changes.change_feed(tables[n - 1], tables[n], ["id"], n))
    for n, table in enumerate(tables):
        assert rows(changes.as_of(log, ["id"], version=n)) == rows(table)
    late = log.filter("_commit_version > 0")
    assert rows(changes.apply_feed(tables[0], late, ["id"])) == rows(tables[2])
    assert rows(changes.upsert(tables[0], tables[1], ["id"])) == sorted({**first, **second}.items(), key=repr)
    assert rows(changes.insert_only(tables[0], tables[1], ["id"])) == sorted({**second, **first}.items(), key=repr)


row = st.tuples(st.sampled_from([None, "a", "b"]), st.one_of(st.none(), st.integers(-2, 5)), st.one_of(st.none(), st.integers(0, 2)))


@FEW
@given(st.lists(row, min_size=1, max_size=30))
def test_split_and_dedup(spark, data):
    df = spark.createDataFrame(data, "k string, t int, v int")
    rules = {"k": F.col("k").isNotNull(), "t": F.col("t") > 0, "v": F.col("v").isin(0, 1)}
    valid, rejected = quality.quarantine(df, rules)
    both = valid.unionByName(rejected.drop(quality.REASON))
    assert Counter(rows(both)) == Counter(sorted(data, key=repr))
    assert all(k is not None and t is not None and t > 0 and v in (0, 1) for k, t, v in rows(valid))

    def low_null(value):
        return -10 if value is None else value

    best = {}
    for k, t, v in data:
        if k not in best or (low_null(t), low_null(v)) > (low_null(best[k][1]), low_null(best[k][2])):
            best[k] = (k, t, v)
    assert rows(clean.dedup(df, ["k"], ["t", "v"])) == sorted(best.values(), key=repr)


@FEW
@given(st.lists(st.sampled_from([None, 1, 1, 1, 2, 3, 4]), min_size=1, max_size=60))
def test_salted_joins(spark, keys):
    fact = spark.createDataFrame([(k, 0) for k in keys], "k int, copy int")  # the rows are copies of each other
    dim = spark.createDataFrame([(1, "x"), (2, "y"), (2, "z"), (5, "w")], "k int, n string")
    want = rows(fact.join(dim, "k"))
    assert rows(joins.salted_join(fact, dim, "k", 3)) == want
    hot = joins.heavy_keys(fact, "k", 0.3)
    share = Counter(keys)
    assert rows(hot) == sorted(((k,) for k, n in share.items() if n > 0.3 * len(keys)), key=repr)
    assert rows(joins.join_salting_hot(fact, dim, "k", hot, 3)) == want
