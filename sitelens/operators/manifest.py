"""What a month-partitioned table holds, month by month, without reading it.

A fingerprint of a month is its number of rows, the most rows of one key, and
the exact sum of the keys' 64-bit hashes. A loader records the fingerprints of
the months it has just written, after the data, in a small side table (a row
for each month). Rows of a batch whose month has the recorded fingerprint are
all held, so only months that differ need a look at the table's keys.

A record that is missing or older than the data makes a month differ, which
costs a look and changes no result. (Two different sets of keys of one size
with equal sums of hashes would be taken for one another, by chance once in
about 2^64 comparisons.) The table must be written by the loader alone.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping
from decimal import Decimal
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitelens.operators.tables import read_if_exists
from sitelens.session import dropping_shuffles

Month = tuple[int, int]


class Fingerprint(NamedTuple):
    rows: int
    most: int  # rows of the most frequent key
    keys: Decimal


# In a folder Spark's file listing skips (leading underscore), so reading the table never sees it.
MANIFEST_DIR = "_month_manifest"
_SCHEMA = "year int, month int, rows long, most long, keys decimal(38,0), stamp string"


def fingerprints(df: DataFrame, key: str, year: str, month: str) -> dict[Month, Fingerprint]:
    """Of each month in ``df``. One aggregate per key and one per month, both
    combined in the tasks first; a row for each month reaches the driver."""
    with dropping_shuffles(df.sparkSession):
        per_key = df.groupBy(key, F.col(year).alias("_y"), F.col(month).alias("_m")).agg(F.count(F.lit(1)).alias("_n"))
        hashed = F.xxhash64(key).cast("decimal(20,0)") * F.col("_n").cast("decimal(18,0)")
        rows = per_key.groupBy("_y", "_m").agg(F.sum("_n").alias("n"), F.max("_n").alias("most"), F.sum(hashed).cast("decimal(38,0)").alias("k")).collect()
    return {(r["_y"], r["_m"]): Fingerprint(r["n"], r["most"], r["k"]) for r in rows}


def _rows(spark: SparkSession, path: str) -> list:
    table = read_if_exists(spark, f"{path.rstrip('/')}/{MANIFEST_DIR}", _SCHEMA)
    return [] if table is None else table.collect()


def recorded(spark: SparkSession, path: str) -> dict[Month, Fingerprint]:
    """The fingerprints recorded for the table at ``path`` (none if nothing is)."""
    return {(r["year"], r["month"]): Fingerprint(r["rows"], r["most"], r["keys"]) for r in _rows(spark, path)}


def stamps(spark: SparkSession, path: str) -> dict[Month, str]:
    """The stamps of the months' last writes."""
    return {(r["year"], r["month"]): r["stamp"] for r in _rows(spark, path)}


def record(spark: SparkSession, path: str, months: Mapping[Month, Fingerprint], written: Iterable[Month] | None = None) -> None:
    """Record ``months`` in place of what is recorded; those ``written`` (else all) get a new stamp."""
    stamp = uuid.uuid4().hex
    kept = {} if written is None else stamps(spark, path)
    fresh = set(months) if written is None else set(written)
    rows = [(*m, *f, stamp if m in fresh else kept.get(m, stamp)) for m, f in sorted(months.items())]
    spark.createDataFrame(rows, _SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{path.rstrip('/')}/{MANIFEST_DIR}")


def differing(found: Mapping[Month, Fingerprint], held: Mapping[Month, Fingerprint]) -> list[Month]:
    """The months of ``found`` that ``held`` does not have in the same form."""
    return sorted(m for m, f in found.items() if held.get(m) != f)
