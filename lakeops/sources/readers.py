"""Batch readers. File reads take globs, so one call covers a dated folder set."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """Headed CSV with inferred types; inference is one extra pass, so typed loads should name a schema."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def read_csv_typed(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Typed CSV split into parsed rows and rows that did not fit the schema.

    The corrupt-record field must be part of the schema, otherwise Spark drops the text.
    """
    rows = read_csv_marked(spark, path, schema)
    return rows.filter(F.col(CORRUPT).isNull()).drop(CORRUPT), rows.filter(F.col(CORRUPT).isNotNull())


def read_csv_marked(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Typed CSV with every row kept; the text of a row that did not fit is in ``_corrupt_record``."""
    wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    rows = (
        spark.read.schema(wide)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(path)
    )
    # Always true, but it names every field: Spark converts only the fields a query needs, and a row counts as
    # corrupt by the fields that were converted.
    empty = sum((F.col(c).isNull().cast("int") for c in schema.names), F.lit(0))
    return rows.filter(empty >= 0)


def read_json_document(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """JSON files that each hold one document spread over many lines. One file is one task: keep files moderate."""
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def borrowed_schema(spark: SparkSession, sample_path: str) -> T.StructType:
    """Schema inferred from one sample batch, to be used for the whole folder."""
    return spark.read.json(sample_path).schema


def read_json_nested(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON lines from a folder tree; sub-folders are only seen with recursive lookup."""
    return spark.read.schema(schema).option("recursiveFileLookup", True).json(path)


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """Parquet whose files were written with different column sets."""
    return spark.read.option("mergeSchema", True).parquet(path)


def read_if_present(spark: SparkSession, path: str) -> DataFrame | None:
    """Parquet folder, or None while nothing was written there."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet folder under a known schema; no rows while nothing was written there."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def read_variant_lines(spark: SparkSession, path: str, column: str = "doc") -> DataFrame:
    """JSON lines of a folder tree, each as one VARIANT value, so files whose fields come, go or change type are read as they are.

    A line that is no JSON is kept as text in ``_corrupt_record``.
    """
    lines = spark.read.option("recursiveFileLookup", True).text(path).filter(F.trim("value") != "")
    parsed = lines.select(F.try_parse_json("value").alias(column), "value")
    return parsed.withColumn(CORRUPT, F.when(F.col(column).isNull(), F.col("value"))).drop("value")


def variant_schema(df: DataFrame, column: str = "doc") -> str:
    """The one type that holds every row's value; a field seen with several types is itself VARIANT."""
    return df.agg(F.schema_of_variant_agg(column)).first()[0]


def variant_fields(df: DataFrame, fields: dict[str, tuple[str, str]], column: str = "doc") -> DataFrame:
    """Typed columns from paths into a VARIANT column, beside the others; a value that cannot be cast or is not there is null."""
    return df.withColumns({name: F.try_variant_get(column, path, kind) for name, (path, kind) in fields.items()})


def flatten_json(df: DataFrame, keep: list[str], struct_fields: dict[str, str], array_col: str, item: str) -> DataFrame:
    """Nested record to rows: struct fields become columns, the array one row per item (empty keeps a null row)."""
    fields = [F.col(path).alias(name) for name, path in struct_fields.items()]
    return df.select(*keep, *fields, F.explode_outer(array_col).alias(item))


def parse_payload(df: DataFrame, payload: str | Column, schema: T.StructType, *keep: str) -> DataFrame:
    """Message payload (binary or text JSON) to typed columns next to the kept envelope columns."""
    text = (F.col(payload) if isinstance(payload, str) else payload).cast("string")
    return df.select(F.from_json(text, schema).alias("data"), *keep).select("data.*", *keep)


def add_lineage(df: DataFrame, batch_date: str | None = None) -> DataFrame:
    """Ingest time, source file and, if given, the batch the rows belong to."""
    out = df.select("*", F.col("_metadata.file_path").alias("_source_file")).withColumn(
        "_ingested_at", F.current_timestamp()
    )
    return out if batch_date is None else out.withColumn("_batch_date", F.lit(batch_date))


def number_series(spark: SparkSession, count: int) -> DataFrame:
    """Numbers 1..count as column ``n``, generated in parallel."""
    return spark.range(1, count + 1).withColumnRenamed("id", "n")


def calendar(bounds: DataFrame, start: str, end: str) -> DataFrame:
    """One row per day between two date columns of a one-row table, both ends included."""
    days = bounds.select(F.explode(F.expr(f"sequence(`{start}`, `{end}`, interval 1 day)")).alias("full_date"))
    name = F.date_format("full_date", "EEEE")
    return days.select(
        (F.year("full_date") * 10000 + F.month("full_date") * 100 + F.dayofmonth("full_date")).alias("date_key"),
        "full_date",
        F.year("full_date").alias("year_num"),
        F.quarter("full_date").alias("quarter_num"),
        F.month("full_date").alias("month_num"),
        F.date_format("full_date", "MMMM").alias("month_name"),
        name.alias("day_name"),
        name.isin("Saturday", "Sunday").alias("is_weekend"),
    )


def day_bounds(df: DataFrame, first: str, last: str | None = None) -> DataFrame:
    """One row with the first and last day seen, to drive :func:`calendar`."""
    return df.agg(
        F.min(F.to_date(first)).alias("first_day"), F.max(F.to_date(last or first)).alias("last_day")
    )
