"""Month-by-month loading of the enhanced traffic table.

``load_increment`` is one incremental run: month gate against the target's
high-water mark, per-row enhancement, merge on ``web_traffic_id``. The
target is a parquet table partitioned by (traffic_year, traffic_month).

* No error ever means "no target": only a missing path or a folder without
  data files does. The first write refuses an existing folder.
* A month the target does not hold yet is appended: its rows are written once
  and history is not read. Months it holds (reprocessed by
  ``lookback_months``, or left by a run that broke off before its mark was
  recorded) are read by literal partition filters, merged and replaced.
* ``full_refresh`` ignores the mark, builds the whole table at a new location
  and then puts it in the target's place.
* Rows the gate will never load are returned, not dropped silently. The
  fingerprints recorded for the target's months (``operators.manifest``) tell
  which months of the batch can have any; only those are compared with the
  target, by literal partition filters.
* Several rows may have one key (a site in several countries): they are
  loaded, and replaced, together. ``refuse_duplicates`` refuses them instead.

``start_stream`` is the same run driven by Structured Streaming: a file
source over arriving monthly extracts and ``foreachBatch`` with
``trigger(availableNow=True)``. The month gate is business time held in the
target, so it lives in ``foreachBatch`` rather than in a watermark. A batch that
Spark runs again after a failure has the effect of one run: the merge is by
key, its late rows have a folder of their own, and the last batch done is
recorded in the target.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from sitelens.operators import manifest
from sitelens.operators.quality import WatchedChecks
from sitelens.operators.tables import data_files, read_if_exists, recover, replace_table
from sitelens.operators.upsert import DuplicateKeyError, after, high_water_mark, in_months, late_rows, newer_than, upsert
from sitelens.plans.staging import stg_traffic
from sitelens.plans.traffic import enhance_traffic, with_traffic
from sitelens.schemas import TRAFFIC_RAW, check_same_schema
from sitelens.session import materialize, write_table

KEY = "web_traffic_id"
PARTITIONS = ["traffic_year", "traffic_month"]


class LoadResult(NamedTuple):
    """Rows written, their months, the batch's rows at or before the former
    mark that the target still does not hold (staged columns; None for a first load
    or a refresh), and how the rows went in: ``whole`` (a first load or a refresh),
    ``append`` (new months only), ``merge`` or ``nothing``."""

    loaded: int
    months: list[tuple[int, int]]
    late: DataFrame | None
    how: str = "nothing"


# The mark recorded at each commit, in a folder Spark's file listing skips
# (leading underscore), so reading the target never sees it.
MARK_DIR = "_high_water_mark"


def recorded_mark(spark: SparkSession, target_path: str) -> tuple[int, int] | None:
    """The (year, month) recorded at the target's last commit, if any (one-row read)."""
    marks = read_if_exists(spark, f"{target_path.rstrip('/')}/{MARK_DIR}", "traffic_year int, traffic_month int")
    row = None if marks is None else marks.first()
    return None if row is None else (row["traffic_year"], row["traffic_month"])


def _record_mark(spark: SparkSession, target_path: str, mark: tuple[int, int]) -> None:
    (spark.createDataFrame([mark], "traffic_year int, traffic_month int").coalesce(1)
     .write.mode("overwrite").parquet(f"{target_path.rstrip('/')}/{MARK_DIR}"))


def load_increment(spark: SparkSession, raw_batch: DataFrame, target_path: str, strict: bool = False,
                   lookback_months: int = 0, full_refresh: bool = False, refuse_duplicates: bool = False,
                   watch: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> LoadResult:
    """One incremental run into the table at ``target_path``. ``watch`` is applied
    to the rows of a whole or appending write, right before it.

    The high-water mark comes from the mark recorded at the last commit (a
    one-row read instead of touching every file of a large target); without
    one it is aggregated from the target. The mark is recorded after the data
    commit, so a crash in between leaves an older mark: the next run then
    merges rows it already holds, which the key merge makes harmless. The
    months' fingerprints are recorded between the two."""
    recover(spark, target_path)
    target = None if full_refresh else read_if_exists(spark, target_path)
    mark = None
    if target is not None:
        mark = recorded_mark(spark, target_path) or high_water_mark(target)
    staged = with_traffic(stg_traffic(raw_batch))
    gated = newer_than(staged, target, strict, lookback_months=lookback_months, known_mark=mark)
    batch = enhance_traffic(gated)
    if target is not None:
        check_same_schema(batch, target)
    found = manifest.fingerprints(gated, KEY, *PARTITIONS)
    rows, months = sum(f.rows for f in found.values()), sorted(found)
    if refuse_duplicates and any(f.most > 1 for f in found.values()):
        raise DuplicateKeyError(f"batch has duplicate {KEY} values")
    held = {} if full_refresh or target is None else manifest.recorded(spark, target_path)
    how = "nothing"
    if full_refresh:
        replace_table(watch(batch), target_path, PARTITIONS)
        how = "whole"
    elif target is None:
        mode = "errorifexists" if _missing(spark, target_path) else "append"  # an empty folder may stand there
        watch(batch).write.mode(mode).option("compression", "zstd").partitionBy(*PARTITIONS).parquet(target_path)
        how = "whole"
    elif rows:
        merged = _merge_months(spark, target, batch, months, target_path, watch)
        found |= merged
        how = "merge" if merged else "append"
    if rows:
        held |= found
        manifest.record(spark, target_path, held, found)
        _record_mark(spark, target_path, max(max(months), mark or max(months)))
    late = None
    if mark is not None:
        passed = manifest.fingerprints(staged.filter(~after(mark, *PARTITIONS)), KEY, *PARTITIONS)
        suspects = manifest.differing(passed, held)
        rows_late = late_rows(staged, spark.read.parquet(target_path), KEY, known_mark=mark, months=suspects)
        if suspects:  # written, so that the report outlives later runs
            late = spark.read.schema(rows_late.schema).parquet(write_table(rows_late, "late_traffic"))
        else:
            late = spark.createDataFrame([], rows_late.schema)
    return LoadResult(rows, months, late, how)


def known_unique(spark: SparkSession, target_path: str) -> bool:
    """Whether the records of a loaded table say that its key is unique (partition values are read, no data)."""
    held = manifest.recorded(spark, target_path)
    months = {tuple(r) for r in spark.read.parquet(target_path).select(*PARTITIONS).distinct().collect()}
    return all(m in held and held[m].most == 1 for m in months)


# ---------------------------------------------------------------- row checks
# Failures of each row check over the whole table, with the rows they were counted over.
CHECKS_DIR = "_row_checks"
_CHECKS_SCHEMA = "signature string, rows long, counts array<long>"


def load_checked(spark: SparkSession, raw_batch: DataFrame, target_path: str, checks: WatchedChecks, **options) -> tuple[LoadResult, list[int]]:
    """``load_increment``, and the row checks' failures over the whole table: those
    recorded at the last run and those that the write of new months counts.
    The table is scanned only after a merge, or where the record does not fit the
    rules or the table (as its manifest has it)."""
    held = read_if_exists(spark, f"{target_path.rstrip('/')}/{CHECKS_DIR}", _CHECKS_SCHEMA)
    last = None if held is None else held.first()
    before = sum(f.rows for f in manifest.recorded(spark, target_path).values())
    done = load_increment(spark, raw_batch, target_path, watch=checks.attach, **options)
    known = last is not None and last["signature"] == checks.signature and last["rows"] == before
    if done.how == "whole":
        counts = checks.counts()
    elif done.how == "append" and known:
        counts = [a + b for a, b in zip(last["counts"], checks.counts(), strict=True)]
    elif done.how == "nothing" and known:
        return done, list(last["counts"])
    else:
        counts = checks.scanned(spark.read.parquet(target_path))
    rows = sum(f.rows for f in manifest.recorded(spark, target_path).values())
    (spark.createDataFrame([(checks.signature, rows, counts)], _CHECKS_SCHEMA).coalesce(1)
     .write.mode("overwrite").parquet(f"{target_path.rstrip('/')}/{CHECKS_DIR}"))
    return done, counts


def _missing(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return True
        raise
    return False


def _merge_months(spark: SparkSession, target: DataFrame, batch: DataFrame, months: list[tuple[int, int]],
                  path: str, watch: Callable[[DataFrame], DataFrame]) -> dict[tuple[int, int], manifest.Fingerprint]:
    """Append the months the target lacks; merge and replace the others, whose
    fingerprints afterwards are returned. ``watch`` sees the rows if all are appended."""
    batch = batch.select(*target.columns)
    touched = target.filter(in_months(months, *PARTITIONS))
    held = sorted(tuple(r) for r in touched.select(*PARTITIONS).distinct().collect())  # partition values only
    new = [m for m in months if m not in set(held)]
    found = {}
    if held:
        merged = upsert(target.filter(in_months(held, *PARTITIONS)), batch.filter(in_months(held, *PARTITIONS)), KEY)
        merged = materialize(merged, "traffic_merged")  # it reads the partitions it will replace
        found = manifest.fingerprints(merged, KEY, *PARTITIONS)
        (merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
         .partitionBy(*PARTITIONS).parquet(path))
    if new:
        rows = batch.filter(in_months(new, *PARTITIONS))
        (rows if held else watch(rows)).write.mode("append").option("compression", "zstd").partitionBy(*PARTITIONS).parquet(path)
    return found


# ---------------------------------------------------------------- streaming
# The last batch that a stream has done with this target, in a folder of its own beside the mark.
STREAM_DIR = "_stream_batch"
_STREAM_SCHEMA = "stream string, batch_id long, refreshed boolean"


class RefreshRefused(ValueError):
    pass


def stream_id(spark: SparkSession, checkpoint_location: str) -> str | None:
    """The id that Spark gave the stream of a checkpoint when it began, None before."""
    try:
        return spark.read.text(f"{checkpoint_location.rstrip('/')}/metadata").first()["value"]
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _recorded_batch(spark: SparkSession, target_path: str):
    table = read_if_exists(spark, f"{target_path.rstrip('/')}/{STREAM_DIR}", _STREAM_SCHEMA)
    return None if table is None else table.first()


def _record_batch(spark: SparkSession, target_path: str, stream: str | None, batch_id: int, refreshed: bool) -> None:
    (spark.createDataFrame([(stream, batch_id, refreshed)], _STREAM_SCHEMA).coalesce(1)
     .write.mode("overwrite").parquet(f"{target_path.rstrip('/')}/{STREAM_DIR}"))


def start_stream(spark: SparkSession, source_dir: str, target_path: str, checkpoint_location: str,
                 strict: bool = False, lookback_months: int = 0, full_refresh: bool = False, late_path: str | None = None):
    """Process every raw monthly file that has arrived in ``source_dir`` and stop.

    Late rows of each batch go to ``late_path`` if given, to a folder for the
    stream and the batch, so a batch that runs again replaces them.

    With ``full_refresh`` the first batch of a stream replaces the target, also
    when it runs again after a failure. A checkpoint whose stream has gone on
    without a refresh is refused (``RefreshRefused``): the files it has passed
    would not come again, so the new table would lack their rows. Where its own
    first batch has made the refresh already, the flag is satisfied."""
    if full_refresh:
        stream = stream_id(spark, checkpoint_location)
        done = _recorded_batch(spark, target_path)
        mine = done is not None and done["stream"] == stream
        if _committed(spark, checkpoint_location) and not (mine and done["refreshed"]):
            raise RefreshRefused(f"the stream of {checkpoint_location} has passed files that a refresh would lose; "
                                 "start it with a new checkpoint")
    source = spark.readStream.schema(TRAFFIC_RAW).parquet(source_dir)

    def each(batch_df: DataFrame, batch_id: int) -> None:
        session = batch_df.sparkSession
        stream = stream_id(session, checkpoint_location)
        done = _recorded_batch(session, target_path)
        mine = done is not None and done["stream"] == stream
        if mine and done["batch_id"] >= batch_id:
            return  # it had ended, but for Spark's own record of it
        refresh = full_refresh and batch_id == 0
        load = load_increment(session, batch_df, target_path, strict, lookback_months, refresh)
        if late_path and load.late is not None:
            (load.late.write.mode("overwrite")
             .parquet(f"{late_path.rstrip('/')}/stream={_folder_of(stream)}/batch_id={batch_id}"))
        _record_batch(session, target_path, stream, batch_id, refresh or bool(mine and done["refreshed"]))

    return (source.writeStream.foreachBatch(each)
            .option("checkpointLocation", checkpoint_location)
            .trigger(availableNow=True).start())


def _folder_of(stream: str | None) -> str:
    """The stream's id as a folder name."""
    return hashlib.md5((stream or "").encode()).hexdigest()[:12]


def _committed(spark: SparkSession, checkpoint_location: str) -> bool:
    """Whether a stream of this checkpoint has ended a batch."""
    try:
        return not data_files(spark, f"{checkpoint_location.rstrip('/')}/commits").isEmpty()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


__all__ = ["LoadResult", "RefreshRefused", "known_unique", "load_checked", "load_increment", "start_stream"]
