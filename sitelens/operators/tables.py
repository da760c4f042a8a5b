"""Tables in folders: existence, and commit by a new location.

A folder's existence is decided by Spark's own error conditions: only a
missing path, or a folder without a single data file, means "no table".
Anything else (an unreadable file, missing permission, a storage error)
raises, so it can never be taken for an empty start.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from sitelens.session import dropping_shuffles


def data_files(spark: SparkSession, path: str) -> DataFrame:
    """path, length and modificationTime of the files below a folder or of a file (no content is read)."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
            .select("path", "length", "modificationTime"))


def read_if_exists(spark: SparkSession, path: str, schema=None) -> DataFrame | None:
    """The parquet table at ``path``, None if there is none; raises if it can't be read."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        table = reader.parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        if e.getCondition() == "UNABLE_TO_INFER_SCHEMA" and data_files(spark, path).isEmpty():
            return None
        raise
    return table


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def recover(spark: SparkSession, path: str) -> None:
    """Undo a replacement that was cut off between its two renames."""
    path = path.rstrip("/")
    fs, at = _file_system(spark, path)
    if not fs.exists(at(path)) and fs.exists(at(path + ".former")):
        fs.rename(at(path + ".former"), at(path))


def replace_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Write ``df`` to a new folder beside ``path``, then put it in the place of
    the former table by renames. Until then readers see the former table, which
    ``df`` itself may read; a failed write leaves it as it was."""
    spark, path = df.sparkSession, path.rstrip("/")
    recover(spark, path)
    new = f"{path}.new-{uuid.uuid4().hex[:12]}"
    writer = df.write.mode("errorifexists").option("compression", "zstd")
    with dropping_shuffles(spark):
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(new)
    fs, at = _file_system(spark, path)
    former = at(path + ".former")
    fs.delete(former, True)
    if fs.exists(at(path)) and not fs.rename(at(path), former):
        raise OSError(f"{path} could not be moved aside; the new table is {new}")
    if not fs.rename(at(new), at(path)):
        fs.rename(former, at(path))
        raise OSError(f"{new} could not be moved to {path}")
    fs.delete(former, True)


def remove_table(spark: SparkSession, path: str) -> None:
    fs, at = _file_system(spark, path)
    fs.delete(at(path), True)
