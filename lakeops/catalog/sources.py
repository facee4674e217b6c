"""Reads and writes: each query writes a given table in some form to the shared folder and reads it back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.catalog.base import Tables, query
from lakeops.functions.scalars import money
from lakeops.operators.layout import compact, copy_table, with_z_order, zorder_write
from lakeops.session import scratch, stored
from lakeops.sources import readers, sinks

EVENT_ROWS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("day", T.DateType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("value", T.DoubleType()),
])


@query("csv_inferred_scan", "SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer")
def csv_inferred_scan(t: Tables):
    path = scratch(t.spark, "csv")
    t.customer.select("c_custkey", "c_name", "c_acctbal", "c_mktsegment").write.option("header", True).csv(path)
    return readers.read_csv(t.spark, path)


def _dirty_csv(t: Tables) -> str:
    """Events as CSV where error events carry a date that does not parse."""
    path = scratch(t.spark, "csv")
    day = F.when(F.col("event_type") == "error", "NOT_A_DATE").otherwise(F.date_format("ts", "yyyy-MM-dd"))
    t.events.select("event_id", day.alias("day"), "user_id", "value").write.option("header", True).csv(path)
    return path


@query(
    "csv_typed_rows",
    "SELECT event_id, cast(ts AS date) AS day, user_id, value FROM events WHERE event_type <> 'error'",
)
def csv_typed_rows(t: Tables):
    return readers.read_csv_typed(t.spark, _dirty_csv(t), EVENT_ROWS)[0]


@query(
    "csv_corrupt_rows",
    """SELECT event_id, cast(NULL AS date) AS day, user_id, value, concat_ws(',', event_id, 'NOT_A_DATE', user_id, value)
    AS _corrupt_record FROM events WHERE event_type = 'error'""",
)
def csv_corrupt_rows(t: Tables):
    return readers.read_csv_typed(t.spark, _dirty_csv(t), EVENT_ROWS)[1]


@query(
    "csv_bulk_load",
    """SELECT s_suppkey, s_name, count(*) AS copies FROM (SELECT * FROM supplier UNION ALL SELECT * FROM supplier) GROUP BY ALL""",
)
def csv_bulk_load(t: Tables):
    """Headed CSV appended twice to a staging folder."""
    source, staging = scratch(t.spark, "csv"), scratch(t.spark, "staging")
    t.supplier.select("s_suppkey", "s_name").write.option("header", True).csv(source)
    schema = T.StructType([T.StructField("s_suppkey", T.LongType()), T.StructField("s_name", T.StringType())])
    for _ in range(2):
        readers.read_csv_typed(t.spark, source, schema)[0].write.mode("append").parquet(staging)
    return t.spark.read.parquet(staging).groupBy("s_suppkey", "s_name").agg(F.count(F.lit(1)).alias("copies"))


@query(
    "dated_folder_scan",
    """SELECT cast(year(o_orderdate) AS bigint) AS order_year, count(*) AS n, cast(sum(cast(o_totalprice AS decimal(12,2))) AS double) AS total
    FROM orders WHERE year(o_orderdate) BETWEEN 1995 AND 1997 GROUP BY 1""",
)
def dated_folder_scan(t: Tables):
    """Folders per year, of which a glob takes some."""
    path = scratch(t.spark, "dated")
    rows = t.orders.withColumn("order_year", F.year("o_orderdate"))
    sinks.write_partitioned(rows, path, ["order_year"])
    part = t.spark.read.option("basePath", path).parquet(f"{path}/order_year=199[5-7]")
    return part.groupBy("order_year").agg(F.count(F.lit(1)).alias("n"), F.sum(money("o_totalprice")).alias("total"))


@query(
    "json_borrowed_schema",
    """SELECT kind, count(*) AS n, min(event_id) AS first_id, cast(sum(cast(value AS decimal(12,2))) AS double) AS total
    FROM (SELECT *, event_type AS kind FROM events) GROUP BY kind""",
)
def json_borrowed_schema(t: Tables):
    """JSON batches in nested folders, read with the schema of one of them."""
    path = scratch(t.spark, "json")
    rows = t.events.select("event_id", "user_id", "value", F.col("event_type").alias("kind"), "event_type")
    rows.write.partitionBy("event_type").json(path)
    schema = readers.borrowed_schema(t.spark, f"{path}/event_type=click")
    return readers.read_json_nested(t.spark, path, schema).groupBy("kind").agg(
        F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_id"), F.sum(money("value")).alias("total")
    )


@query("managed_table_scan", "SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand")
def managed_table_scan(t: Tables):
    """Table by name, replaced by a second write with another schema."""
    name = f"lakeops_{uuid.uuid4().hex}"
    path = scratch(t.spark, "table")
    sinks.overwrite_table(t.part.select("p_partkey"), name, path)
    sinks.overwrite_table(t.part.select("p_partkey", "p_brand"), name, path)
    rows = t.spark.table(name)
    sinks.drop_table(t.spark, name)  # the files stay, only the catalog entry goes
    return rows.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"))


@query(
    "created_table",
    "SELECT p_brand, cast(p_size AS bigint) AS p_size, count(*) AS n FROM part GROUP BY ALL",
)
def created_table(t: Tables):
    """Partitioned table declared by DDL, declared again without effect, loaded and reloaded."""
    name = f"lakeops_{uuid.uuid4().hex}"
    rows = t.part.groupBy(F.col("p_size").cast("bigint").alias("p_size"), "p_brand").agg(F.count(F.lit(1)).alias("n")).select("p_size", "n", "p_brand")
    sinks.create_table_if_missing(t.spark, name, "p_size bigint, n bigint, p_brand string", ["p_brand"])
    sinks.reload_table(rows.limit(1), name)
    sinks.create_table_if_missing(t.spark, name, "other int")
    sinks.reload_table(rows, name)
    saved = stored(t.spark.table(name), "created")
    sinks.drop_table(t.spark, name)
    return saved.select("p_brand", "p_size", "n")


@query(
    "append_schema_merge",
    """SELECT c_custkey, c_acctbal, cast(NULL AS double) AS risk_score FROM customer
    UNION ALL SELECT c_custkey, c_acctbal, 0.5::double FROM customer WHERE c_acctbal < 0""",
)
def append_schema_merge(t: Tables):
    """Second batch with a new column; earlier rows read it as null."""
    path = scratch(t.spark, "merge")
    base = t.customer.select("c_custkey", "c_acctbal")
    sinks.append_merged(base, path)
    sinks.append_merged(base.filter("c_acctbal < 0").withColumn("risk_score", F.lit(0.5)), path)
    return readers.read_merged(t.spark, path)


@query(
    "append_aligned_union",
    """SELECT c_custkey AS id, c_name AS name, cast(NULL AS varchar) AS kind FROM customer
    UNION ALL SELECT s_suppkey, s_name, 'supplier' FROM supplier""",
)
def append_aligned_union(t: Tables):
    """Union by name where one side lacks a column."""
    buyers = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    makers = t.supplier.select(
        F.lit("supplier").alias("kind"), F.col("s_name").alias("name"), F.col("s_suppkey").alias("id")
    )
    return sinks.append_aligned(buyers, makers)


@query(
    "partition_pruned_scan",
    """SELECT event_type, count(*) AS n FROM events WHERE cast(ts AS date) BETWEEN date '2024-01-05' AND date '2024-01-09'
    GROUP BY event_type""",
)
def partition_pruned_scan(t: Tables):
    """Date-partitioned write; the date filter reads only matching folders."""
    path = scratch(t.spark, "days")
    sinks.write_partitioned(t.events.withColumn("day", F.to_date("ts")), path, ["day"])
    days = t.spark.read.parquet(path).filter(F.col("day").between("2024-01-05", "2024-01-09"))
    return days.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query(
    "partition_overwrite",
    """SELECT cast(ts AS date) AS day, count(*) AS n, cast(sum(CASE WHEN day(ts) <= 3 THEN 2 ELSE 1 END *
    cast(value AS decimal(12,2))) AS double) AS total FROM events GROUP BY 1""",
)
def partition_overwrite(t: Tables):
    """Days one to three are replaced by doubled values, the other days stay."""
    path = scratch(t.spark, "replace")
    rows = t.events.select("event_id", money("value").alias("value"), F.to_date("ts").alias("day"))
    sinks.write_partitioned(rows, path, ["day"])
    early = rows.filter(F.dayofmonth("day") <= 3)
    doubled = early.withColumn("value", (F.col("value") * 2).cast("decimal(12,2)"))
    sinks.overwrite_partitions(doubled, path, ["day"])
    return t.spark.read.parquet(path).groupBy("day").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))


@query(
    "lineage_by_file",
    """SELECT 'lineitem.parquet' AS source, '2024-01-31' AS _batch_date, true AS stamped, count(*) AS n FROM lineitem""",
)
def lineage_by_file(t: Tables):
    """Rows per source file, with batch and ingest time."""
    lines = readers.add_lineage(t.lineitem, "2024-01-31")
    name = F.element_at(F.split("_source_file", "/"), -1)
    return lines.groupBy(name.alias("source"), "_batch_date").agg(
        F.bool_and(F.col("_ingested_at").isNotNull()).alias("stamped"), F.count(F.lit(1)).alias("n")
    )


@query(
    "self_insert_subset",
    "SELECT o_orderkey, count(*) AS copies FROM (SELECT o_orderkey FROM orders UNION ALL SELECT o_orderkey FROM orders "
    "WHERE o_totalprice > 400000) GROUP BY o_orderkey",
)
def self_insert_subset(t: Tables):
    """A folder that receives a subset of its own rows again."""
    path = scratch(t.spark, "self")
    t.orders.select("o_orderkey", "o_totalprice").write.parquet(path)
    stored = t.spark.read.parquet(path)
    stored.filter("o_totalprice > 400000").write.mode("append").parquet(path)
    return t.spark.read.parquet(path).groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("copies"))


@query("compacted_copy", "SELECT event_type, count(*) AS n, true AS fewer_files FROM events GROUP BY event_type")
def compacted_copy(t: Tables):
    """Many small files rewritten as few, then copied as a backup."""
    small, large, backup = (scratch(t.spark, x) for x in ("small", "large", "backup"))
    t.events.repartition(16).write.parquet(small)
    compact(t.spark, small, large)
    saved = copy_table(t.spark.read.parquet(large), backup)
    before, after = (len(t.spark.read.parquet(x).inputFiles()) for x in (small, backup))
    return saved.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.lit(after < before).alias("fewer_files"))


@query("zorder_layout", "SELECT l_orderkey, l_partkey, l_suppkey, l_quantity FROM lineitem")
def zorder_layout(t: Tables):
    """Rows clustered along a z-curve over two columns; the content is unchanged."""
    path = scratch(t.spark, "zorder")
    rows = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity")
    zorder_write(rows, path, ["l_partkey", "l_orderkey"])
    return t.spark.read.parquet(path)


@query(
    "zorder_curve",
    "SELECT count(*) AS n, true AS in_range, true AS balanced FROM lineitem",
)
def zorder_curve(t: Tables):
    """Curve positions lie on the curve, and quantile cuts keep them from collecting the rows."""
    curve = with_z_order(t.lineitem.select("l_partkey", "l_orderkey"), ["l_partkey", "l_orderkey"], bits=3)
    sizes = curve.groupBy("_z").agg(F.count(F.lit(1)).alias("_n"))
    return sizes.agg(
        F.sum("_n").alias("n"),
        F.bool_and(F.col("_z").between(0, 63)).alias("in_range"),
        (F.max("_n") < F.sum("_n") / 16).alias("balanced"),
    )


@query(
    "json_document_scan",
    """SELECT n_nationkey::bigint AS n_nationkey, r_name AS region, n_regionkey::bigint AS region_key, w.word FROM nation
    JOIN region ON n_regionkey = r_regionkey LEFT JOIN (VALUES (1, 'one'), (2, 'two')) AS w(i, word) ON w.i <= n_nationkey % 3""",
)
def json_document_scan(t: Tables):
    """One nested document per file, spread over many lines, then flattened; empty arrays keep their row."""
    path = scratch(t.spark, "documents")
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    words = F.slice(F.array(F.lit("one"), F.lit("two")), F.lit(1), F.col("n_nationkey") % 3)
    record = F.struct(
        "n_nationkey",
        F.struct(F.col("r_name").alias("name"), F.col("n_regionkey").alias("key")).alias("place"),
        words.alias("words"),
    )
    text = places.select("n_nationkey", F.to_json(record, {"pretty": "true"}).alias("value"))
    text.write.partitionBy("n_nationkey").text(path)
    documents = readers.read_json_document(t.spark, f"{path}/*/*.txt")
    return readers.flatten_json(documents, ["n_nationkey"], {"region": "place.name", "region_key": "place.key"}, "words", "word")


@query(
    "cross_database_reload",
    "SELECT s_nationkey::bigint AS s_nationkey, count(*) AS n FROM supplier GROUP BY s_nationkey",
)
def cross_database_reload(t: Tables):
    """Table in another schema, loaded twice by truncate and insert, read by its two-part name."""
    schema = f"lakeops_{uuid.uuid4().hex}"
    name, path = f"{schema}.suppliers", scratch(t.spark, "table")
    t.spark.sql(f"CREATE SCHEMA {schema} LOCATION '{scratch(t.spark, 'schema')}'")
    rows = t.supplier.select("s_suppkey", "s_nationkey")
    sinks.overwrite_table(rows.limit(0), name, path)
    for _ in range(2):
        sinks.reload_table(rows, name)
    loaded = t.spark.table(name)
    sinks.drop_table(t.spark, name)
    t.spark.sql(f"DROP SCHEMA {schema}")
    return loaded.groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("n"))


@query(
    "drifting_json",
    """SELECT event_id, cast(json_extract_string(props, '$.k') AS bigint) AS k, CASE WHEN event_id % 3 = 2 THEN event_type END AS kind,
    CASE WHEN event_id % 3 = 2 THEN value END AS value, true AS k_has_several_types FROM events""",
)
def drifting_json(t: Tables):
    """Three landings of one feed: a number, then the same field as text, then a nested field more; stored once as VARIANT and read by path."""
    landing, k = scratch(t.spark, "drift"), F.get_json_object("props", "$.k")
    landings = [
        F.struct("event_id", k.cast("long").alias("k")), F.struct("event_id", k.alias("k")),
        F.struct("event_id", k.alias("k"), F.struct(F.col("event_type").alias("kind"), (F.col("value") + 0.0).alias("value")).alias("seen")),
    ]
    for part, row in enumerate(landings):
        t.events.filter(F.col("event_id") % 3 == part).select(F.to_json(row)).write.text(f"{landing}/day={part}")
    bronze = stored(readers.read_variant_lines(t.spark, landing), "variants")
    found = readers.variant_schema(bronze)
    paths = {"event_id": ("$.event_id", "bigint"), "k": ("$.k", "bigint"), "kind": ("$.seen.kind", "string"), "value": ("$.seen.value", "double")}
    return readers.variant_fields(bronze, paths).select(*paths, F.lit("k: VARIANT" in found and "event_id: BIGINT" in found).alias("k_has_several_types"))
