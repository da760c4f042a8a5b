"""Incremental loading: high-water-mark filter and merge on a unique key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitelens.schemas import check_same_schema


class DuplicateKeyError(ValueError):
    pass


def high_water_mark(target: DataFrame, year: str = "traffic_year", month: str = "traffic_month"):
    """Largest (year, month) in the target, lexicographic; None if the target is empty.

    One aggregate over the target's two partition columns; only the single
    result row reaches the driver."""
    row = target.agg(F.max(F.struct(F.col(year).alias("y"), F.col(month).alias("m"))).alias("h")).first()
    return None if row is None or row["h"] is None else (row["h"]["y"], row["h"]["m"])


def after(hwm, year: str = "traffic_year", month: str = "traffic_month") -> Column:
    """Rows strictly after the mark. A literal predicate, so a month-partitioned
    source is pruned to the new partitions."""
    y, m = hwm
    return (F.col(year) > F.lit(y)) | ((F.col(year) == F.lit(y)) & (F.col(month) > F.lit(m)))


def months_back(hwm, n: int):
    """The (year, month) ``n`` months before ``hwm``."""
    y, m = hwm
    idx = y * 12 + (m - 1) - n
    return idx // 12, idx % 12 + 1


def newer_than(batch: DataFrame, target: DataFrame | None, strict: bool = False,
               year: str = "traffic_year", month: str = "traffic_month",
               lookback_months: int = 0, known_mark: tuple[int, int] | None = None) -> DataFrame:
    """Keep the batch rows after the target's high-water mark.

    No target: everything loads (first run). An empty target loads
    everything too, unless ``strict`` (then nothing loads - the NULL mark of
    the source rules compares false). ``lookback_months=n`` also reprocesses
    the last n loaded months, so late rows and corrections of those months
    are merged instead of being dropped. ``known_mark`` is a mark already
    known (e.g. recorded at the target's last commit), saving the aggregate."""
    if target is None:
        return batch
    hwm = known_mark if known_mark is not None else high_water_mark(target, year, month)
    if hwm is None:
        return batch.limit(0) if strict else batch
    if lookback_months:
        hwm = months_back(hwm, lookback_months)
    return batch.filter(after(hwm, year, month))


def in_months(months: Sequence[tuple[int, int]], year: str = "traffic_year", month: str = "traffic_month") -> Column:
    """Rows of the given (year, month) pairs, as literals: a month-partitioned
    table is pruned to these partitions before its files are listed."""
    by_year: dict[int, list[int]] = {}
    for y, m in months:
        by_year.setdefault(y, []).append(m)
    expr = F.lit(False)
    for y in sorted(by_year):
        expr = expr | ((F.col(year) == F.lit(y)) & F.col(month).isin(*sorted(by_year[y])))
    return expr


def late_rows(batch: DataFrame, target: DataFrame, key: str,
              year: str = "traffic_year", month: str = "traffic_month",
              known_mark: tuple[int, int] | None = None,
              months: Sequence[tuple[int, int]] | None = None) -> DataFrame:
    """Batch rows at or before the mark that the target does not hold: they
    will never be loaded by the month gate (reported, not dropped silently).
    The target is read up to the mark only, or, where the caller knows the
    ``months`` that can have such rows, in those months only (literal partition
    filters; none read if the list is empty)."""
    hwm = known_mark if known_mark is not None else high_water_mark(target, year, month)
    if hwm is None:
        return batch.limit(0)
    wanted = ~after(hwm, year, month)
    if months is not None:
        wanted = wanted & in_months(months, year, month)
    return batch.filter(wanted).join(target.filter(wanted).select(key), key, "left_anti")


def assert_unique(batch: DataFrame, key: str, year: str | None = None,
                  month: str | None = None):
    """Refuse a batch with duplicate keys (a merge would be ambiguous); return
    its row count, and with ``year``/``month`` also its newest (year, month).
    One grouped count (map-side combined), one result row."""
    per_key = [F.count(F.lit(1)).alias("n")]
    if year and month:
        per_key.append(F.max(F.struct(F.col(year).alias("y"), F.col(month).alias("m"))).alias("p"))
    totals = [F.sum("n").alias("rows"), F.max("n").alias("most")]
    if year and month:
        totals.append(F.max("p").alias("newest"))
    row = batch.groupBy(key).agg(*per_key).agg(*totals).first()
    if row["most"] is not None and row["most"] > 1:
        raise DuplicateKeyError(f"batch has duplicate {key} values")
    rows = int(row["rows"] or 0)
    if not (year and month):
        return rows
    newest = None if row["newest"] is None else (row["newest"]["y"], row["newest"]["m"])
    return rows, newest


def upsert(target: DataFrame, batch: DataFrame, key: str, check_schema: bool = True) -> DataFrame:
    """Merge: batch rows replace target rows with the same key, new keys are
    inserted. Where several rows have one key, all rows of the key are replaced
    together. A shuffle join on the key against the batch's keys only."""
    if check_schema:
        check_same_schema(batch, target)
    return target.join(batch.select(key), key, "left_anti").unionByName(batch)
