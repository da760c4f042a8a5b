"""Small helpers shared by the text operators."""

from __future__ import annotations

import os
import re
import shutil
import site
import tempfile
import weakref
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitelens.operators.tables import remove_table
from sitelens.session import shared_table_path

#: A word is a run of bytes other than ASCII white space; ``bytes.split()`` cuts the same way.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text that a task turns into numpy arrays at once.
BLOCK_BYTES = 2 << 20
#: Bytes of one text that are cut into words at once.
SLAB_BYTES = 1 << 20
_BLANK = b" \t\n\v\f\r"


def as_bytes(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of an Arrow string column; null counts as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def as_strings(texts: list[bytes]) -> pa.Array:
    """UTF-8 bytes as an Arrow string column, as they are."""
    return pa.array(texts, pa.binary()).view(pa.string())


def word_slabs(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, those of about ``SLAB_BYTES`` at a time."""
    at = 0
    while at < len(text):
        end = at + SLAB_BYTES
        while end < len(text) and text[end] not in _BLANK:
            end += 1
        yield text[at:end].split()
        at = end


def blocks(sizes: list[int], limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive rows of at most ``limit`` bytes together (one row at least)."""
    at, total = 0, 0
    for i, n in enumerate(sizes):
        if i > at and total + n > limit:
            yield at, i
            at, total = i, 0
        total += n
    if at < len(sizes):
        yield at, len(sizes)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (xor-shift and multiply)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def remainder(id_col: str, modulus: int):
    """crc32 of the id as text, modulo ``modulus`` (a null id counts as an empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % modulus


def id_type(df: DataFrame, col: str) -> str:
    return df.schema[col].dataType.simpleString()


_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def staged(df: DataFrame, name: str, partition_by: list[str] | None = None, batch_rows: int | None = None) -> DataFrame:
    """Write ``df`` to a new table in shared storage and read it back (also if it is
    empty). Spark then drops the shuffle files that led to the table at once
    instead of when the driver next collects garbage. ``batch_rows`` bounds the
    rows that Python gets at a time meanwhile."""
    spark = df.sparkSession
    path = shared_table_path(spark, name)
    settings = {_CLEAN_UP: "true"} | ({_BATCH_ROWS: str(batch_rows)} if batch_rows else {})
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        df.write.option("compression", "zstd").partitionBy(*partition_by or []).parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    out = spark.read.schema(df.schema).parquet(path)
    _PATHS[id(out)] = (weakref.ref(out), path)
    return out


_PATHS: dict[int, tuple[weakref.ref, str]] = {}


def discard(*tables: DataFrame) -> None:
    """Remove ``staged`` tables that nothing will read any more."""
    for df in tables:
        ref, path = _PATHS.pop(id(df), (lambda: None, ""))
        if ref() is df:
            remove_table(df.sparkSession, path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let Spark send this package to the executors, once per application, unless
    their Python finds it anyway: it is installed, or a local master's workers find it
    where the driver does. A cluster's executors need not have the driver's PYTHONPATH or working folder."""
    package = Path(__file__).resolve().parents[1]
    root = str(package.parent)
    found = site.getsitepackages()
    if re.match(r"local(\[|$)", spark.sparkContext.master):
        found += [*os.environ.get("PYTHONPATH", "").split(os.pathsep), os.getcwd()]
    app = spark.sparkContext.applicationId
    if app in _SHIPPED or root in {os.path.realpath(p) for p in found if p}:
        return
    archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(), package.name), "zip", root, package.name)
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(app)
