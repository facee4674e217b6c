import datetime as dt
import json

import pytest
from conftest import plan, rows
from pyspark.errors import AnalysisException
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.plans import visits
from lakeops.session import DROP_SHUFFLES, scratch, shared_root, shuffles_dropped
from lakeops.sources import files, readers, sinks

VISITS = """patient_id,visit_date,department,age,diagnosis_code
P1,2026-01-16,CARDIO,73,F32
P1,2026-01-16,CARDIO,73,F32
P2,NOT_A_DATE,CARDIO,45,I10
,2026-01-20,NEURO,50,E11
P3,2026-01-17,,-5,K21
P1,2026-01-30,ORTHO,74,M54
"""


def test_shared_folder_comes_from_the_session(spark):
    assert scratch(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")


def test_csv_typed_with_corrupt_rows(spark, tmp_path):
    (tmp_path / "v.csv").write_text(VISITS)
    good, bad = readers.read_csv_typed(spark, f"{tmp_path}/*.csv", visits.SCHEMA)
    assert (good.count(), bad.count()) == (5, 1)
    assert rows(bad, "patient_id", readers.CORRUPT) == [("P2", "P2,NOT_A_DATE,CARDIO,45,I10")]
    assert rows(bad.select(readers.CORRUPT)) == [("P2,NOT_A_DATE,CARDIO,45,I10",)]


def test_visits_from_file_to_rank(spark, tmp_path):
    (tmp_path / "v.csv").write_text(VISITS)
    marked = readers.read_csv_marked(spark, str(tmp_path / "v.csv"), visits.SCHEMA).drop(readers.CORRUPT)
    clean = visits.clean_visits(marked)
    assert rows(clean, "patient_id", "department", "age") == [
        ("P1", "CARDIO", 73), ("P1", "ORTHO", 74), ("P2", "CARDIO", 45), ("P3", "UNKNOWN", None),
    ]
    assert rows(visits.ranked_visits(clean, hot_rows=1)) == rows(visits.ranked_visits(clean))
    ranked = visits.ranked_visits(clean)
    assert rows(ranked, "patient_id", "visit_number", "days_since_prev", "dept_rank_by_age") == [
        ("P1", 1, None, 1), ("P1", 2, 14, 1), ("P2", 1, None, 2), ("P3", 1, None, 1),
    ]
    names = spark.createDataFrame([("CARDIO", "Cardiology")], "department string, department_name string")
    assert visits.enrich(clean, names).filter("department_name IS NULL").count() == 2


def test_csv_inferred(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,amount\n1,2.5\n2,3.5\n")
    assert readers.read_csv(spark, str(tmp_path / "a.csv")).dtypes == [("id", "int"), ("amount", "double")]


def test_json_document_and_flatten(spark, tmp_path):
    records = [
        {"patient_id": "P1", "insurance": {"provider": "X", "policy_no": "1"}, "procedures": ["MRI", "CT"]},
        {"patient_id": "P2", "insurance": {"provider": "Y", "policy_no": "2"}, "procedures": []},
        {"patient_id": "P3", "insurance": None, "procedures": ["XRAY"]},
    ]
    (tmp_path / "r.json").write_text(json.dumps(records, indent=2))
    for schema in (None, visits.INSURANCE_SCHEMA):
        flat = visits.insurance_rows(readers.read_json_document(spark, str(tmp_path / "r.json"), schema))
        assert rows(flat) == [("P1", "X", "1", "CT"), ("P1", "X", "1", "MRI"), ("P2", "Y", "2", None), ("P3", None, None, "XRAY")]
    seen = spark.createDataFrame([("P1",), ("P9",)], "patient_id string")
    assert rows(visits.uninsured(seen, flat)) == [("P9",)]


def test_lineage(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id\n1\n")
    out = readers.add_lineage(readers.read_csv(spark, str(tmp_path / "a.csv")), "2026-01-15").first()
    assert out._source_file.endswith("a.csv") and out._batch_date == "2026-01-15" and out._ingested_at is not None


def test_inline_rows(spark):
    schema = T.StructType([T.StructField("id", T.StringType(), False), T.StructField("ts", T.TimestampType())])
    typed = spark.createDataFrame([Row(id="T1", ts=dt.datetime(2026, 1, 5, 10, 15))], schema)
    assert typed.first().id == "T1"
    assert spark.createDataFrame([("a", 1)], ["k", "n"]).dtypes == [("k", "string"), ("n", "bigint")]
    assert spark.createDataFrame([], "k string, n long").isEmpty()


def test_payload_keeps_envelope(spark):
    df = spark.createDataFrame([(b'{"k": 1}', 7), (b"broken", 8)], "value binary, n int")
    schema = T.StructType([T.StructField("k", T.IntegerType())])
    assert rows(readers.parse_payload(df, "value", schema, "n")) == [(1, 7), (None, 8)]


def test_calendar(spark):
    bounds = spark.createDataFrame([(dt.date(2024, 1, 1), dt.date(2026, 12, 31))], "a date, b date")
    days = readers.calendar(bounds, "a", "b")
    assert days.count() == 1096
    first = days.orderBy("full_date").first()
    assert (first.date_key, first.month_name, first.day_name, first.is_weekend) == (20240101, "January", "Monday", False)
    assert days.filter("is_weekend").count() == 156 * 2  # 156 weeks and Monday to Thursday


def test_tables(spark):
    for name in ("probe_a", "lake.probe_b"):
        if "." in name:
            spark.sql("CREATE SCHEMA IF NOT EXISTS lake")
        sinks.overwrite_table(spark.range(3), name)
        sinks.overwrite_table(spark.range(5).withColumn("x", F.lit(1)), name)
        assert spark.table(name).columns == ["id", "x"] and spark.table(name).count() == 5
        sinks.reload_table(spark.range(2).select(F.lit(9).alias("x"), "id"), name)
        assert rows(spark.table(name)) == [(0, 9), (1, 9)]
        sinks.drop_table(spark, name)
        sinks.drop_table(spark, name)
        assert not spark.catalog.tableExists(name)


def test_table_created_once_and_persistent_view(spark):
    for _ in range(2):
        sinks.create_table_if_missing(spark, "daily", "department string, n bigint, visit_date date", ["visit_date"])
    spark.sql("INSERT INTO daily VALUES ('A', 70, DATE'2026-01-01')")
    spark.sql("CREATE OR REPLACE VIEW busy AS SELECT * FROM daily WHERE n >= 65")
    assert spark.table("busy").count() == 1
    sinks.drop_table(spark, "daily")


def test_merge_and_align(spark):
    path = scratch(spark, "m")
    sinks.append_merged(spark.range(2), path)
    sinks.append_merged(spark.range(1).withColumn("score", F.lit(0.5)), path)
    assert rows(readers.read_merged(spark, path)) == [(0, 0.5), (0, None), (1, None)]
    assert rows(sinks.append_aligned(spark.range(1).toDF("id"), spark.range(1).withColumn("s", F.lit(1)))) == [(0, 1), (0, None)]


def test_partition_overwrite_and_pruning(spark):
    path = scratch(spark, "p")
    sinks.write_partitioned(spark.range(10).select("id", (F.col("id") % 3).cast("int").alias("d")), path, ["d"])
    sinks.overwrite_partitions(spark.range(1).select("id", F.lit(1).alias("d")), path, ["d"])
    back = spark.read.parquet(path)
    assert rows(back.groupBy("d").count()) == [(0, 4), (1, 1), (2, 3)]
    assert "PartitionFilters: [isnotnull(d" in plan(back.filter("d = 1"))


def test_json_batches_keep_microseconds(spark):
    path = scratch(spark, "j")
    moment = dt.datetime(2026, 1, 1, 2, 3, 4, 567891)
    df = spark.createDataFrame([(moment, moment)], "a timestamp, b timestamp_ntz")
    sinks.write_json_batch(df, f"{path}/batch_000", files=1)
    assert rows(readers.read_json_nested(spark, path, df.schema)) == [(moment, moment)]
    assert readers.borrowed_schema(spark, f"{path}/batch_000").names == ["a", "b"]


def test_views(spark):
    sinks.publish_views(spark.range(3), "probe_view")
    sinks.publish_views(spark.range(4), "probe_shared", shared=True)
    assert spark.table("probe_view").count() == 3
    assert spark.newSession().table("global_temp.probe_shared").count() == 4


def test_run_log(spark):
    assert not sinks.already_done(spark, "ctl_probe", "2026-01-15", "gold")
    sinks.log_run(spark, "ctl_probe", "2026-01-15", "gold", "FAILED", 0)
    assert not sinks.already_done(spark, "ctl_probe", "2026-01-15", "gold")
    sinks.log_run(spark, "ctl_probe", "2026-01-15", "gold", "SUCCESS", 3)
    assert sinks.already_done(spark, "ctl_probe", "2026-01-15", "gold")
    assert spark.table("ctl_probe").count() == 2
    sinks.drop_table(spark, "ctl_probe")


def test_absent_folder(spark):
    assert readers.read_if_present(spark, scratch(spark, "none")) is None


@pytest.mark.parametrize("n", [0, 5])
def test_number_series(spark, n):
    assert rows(readers.number_series(spark, n)) == [(i,) for i in range(1, n + 1)]


def test_a_table_replaced_in_slices(spark):
    """Rows of a key stay together, rows without a key are kept, and a build that fails leaves the table as it was, and nothing beside it."""
    root = scratch(spark, "slices")
    df = spark.range(300).select(F.when(F.col("id") % 10 > 0, F.concat(F.lit("k"), F.col("id") % 70)).alias("k"), "id")
    counted = lambda part: part.groupBy("k").agg(F.count("id").alias("n"))
    assert len(sinks.key_slices(df, "k", 100)) == 3 and len(sinks.key_slices(df.limit(0), "k", 100)) == 1
    for _ in range(2):
        table = sinks.replaced_in_slices(df, f"{root}/t", "k", counted, 100, compression="zstd")
        assert rows(table) == rows(counted(df))
    with pytest.raises(AnalysisException):
        sinks.replaced_in_slices(df, f"{root}/t", "k", lambda part: part.select("absent"), 100)
    assert [f.rsplit("/", 1)[1] for f in files.matching(spark, f"{root}/*")] == ["t"] and rows(spark.read.parquet(f"{root}/t")) == rows(counted(df))
    assert sinks.replaced_in_slices(df.limit(0), f"{root}/t", "k", counted, 100).count() == 0


def test_shuffles_are_dropped_only_inside(spark):
    before = spark.conf.get(DROP_SHUFFLES)
    with pytest.raises(ZeroDivisionError), shuffles_dropped(spark):
        assert spark.conf.get(DROP_SHUFFLES) == "true"
        1 / 0  # noqa: B018
    assert spark.conf.get(DROP_SHUFFLES) == before
