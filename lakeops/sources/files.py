"""Folders of the file system that Spark itself uses, whatever its scheme, and what a table's files say of its version."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.session import shared_root


def _at(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    folder, system = _at(spark, path)
    return system.exists(folder)


def plain_path(spark: SparkSession, path: str) -> str:
    """The path without its scheme and host."""
    return _at(spark, path)[0].toUri().getPath()


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern, sorted; none if there are none."""
    folder, system = _at(spark, pattern)
    return sorted(str(s.getPath().toString()) for s in (system.globStatus(folder) or []))


def bytes_of(spark: SparkSession, path: str) -> int:
    """Bytes of a file or of all files of a folder."""
    folder, system = _at(spark, path)
    return system.getContentSummary(folder).getLength()


def remove(spark: SparkSession, path: str) -> None:
    folder, system = _at(spark, path)
    system.delete(folder, True)


def move(spark: SparkSession, path: str, to: str) -> bool:
    """Rename within one file system; the target's folder is made if need be. Whether it worked."""
    folder, system = _at(spark, path)
    target, _ = _at(spark, to)
    system.mkdirs(target.getParent())
    return system.rename(folder, target)


def input_version(*tables: DataFrame) -> str:
    """Text that changes when a file that the tables are scanned from is added, removed or rewritten.

    Made of the files' paths, sizes and times, which a scan knows without reading a column; one row per file and task is shuffled.
    """
    name, size, time = (F.col(f"_metadata.file_{x}") for x in ("path", "size", "modification_time"))
    marks = [t.select(F.lit(i).alias("i"), name.alias("name"), size.alias("size"), time.alias("time")) for i, t in enumerate(tables)]
    files = reduce(DataFrame.unionByName, marks).distinct()
    row = files.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("i", "name", "size", "time").cast("decimal(38,0)")).alias("h")).first()
    return f"{row['n']}-{row['h']}"


def load_once(spark: SparkSession, name: str, inputs: list[DataFrame], write: Callable[[str], None]) -> str:
    """The folder that ``write`` filled from these inputs, under the shared folder.

    It is named by the version of the inputs: a rewritten input is another load, and a load that was swept away or never ended is
    done again.
    """
    path = f"{shared_root(spark)}/{name}-{input_version(*inputs)}"
    if not exists(spark, f"{path}/_SUCCESS"):
        write(path)
    return path
