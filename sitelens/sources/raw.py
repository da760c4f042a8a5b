"""Readers for the two raw inputs when they exist as tables or files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from sitelens.schemas import ORG_RAW, TRAFFIC_RAW


def _read(spark: SparkSession, source: str, schema: StructType, fmt: str) -> DataFrame:
    """``source`` is a catalog table name or a path; a path is read with the fixed schema
    so no inference job runs and a drifting file fails fast."""
    if "/" not in source and spark.catalog.tableExists(source):
        df = spark.table(source)
    else:
        df = spark.read.schema(schema).format(fmt).load(source)
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"{source}: missing raw columns {missing}")
    return df.select(*[f.name for f in schema.fields])


def read_organizations(spark: SparkSession, source: str, fmt: str = "parquet") -> DataFrame:
    """Company directory scan."""
    return _read(spark, source, ORG_RAW, fmt)


def read_traffic(spark: SparkSession, source: str, fmt: str = "parquet") -> DataFrame:
    """Monthly traffic scan (S2). Files laid out as ``year=/month=`` are pruned by
    any month predicate downstream."""
    return _read(spark, source, TRAFFIC_RAW, fmt)
