"""Aggregate helpers with deterministic tie rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sitelens.functions.periods import yyyymm


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dominant(c) -> Column:
    """Most frequent non-NULL value; the smallest value wins a tie.

    ``mode`` keeps a value->count map per group and merges partial maps, so a
    hot group is pre-aggregated on the map side like any other aggregate.
    """
    return F.mode(_col(c), deterministic=True)


def total(c, weight: str | None = None) -> Column:
    """Sum of a column; with ``weight`` each row counts that many times."""
    return F.sum(_col(c)) if weight is None else F.sum(_col(c) * F.col(weight))


def mean(c, weight: str | None = None) -> Column:
    """Mean of the non-NULL values; with ``weight`` each row counts that many times."""
    if weight is None:
        return F.avg(_col(c))
    return total(_col(c).cast("double"), weight) / F.nullif(F.sum(F.when(_col(c).isNotNull(), F.col(weight))), F.lit(0))


def rows_of(weight: str | None = None) -> Column:
    """Number of rows, each counting ``weight`` times."""
    return F.count(F.lit(1)) if weight is None else F.sum(weight)


def label_counts(column: str, labels: list[str], prefix: str, weight: str | None = None) -> list[Column]:
    """Rows of each label of a closed set: plain counts, so the mode of such a
    column needs no map of values in the aggregate."""
    if weight is None:
        return [F.count_if(F.col(column) == label).alias(f"{prefix}{i}") for i, label in enumerate(labels)]
    return [F.sum(F.when(F.col(column) == label, F.col(weight)).otherwise(0)).alias(f"{prefix}{i}") for i, label in enumerate(labels)]


def top_label(prefix: str, labels: list[str]) -> Column:
    """The label with the largest of its ``label_counts``; the first label wins a
    tie (give them sorted for the rule of ``dominant``), NULL without any."""
    counts = [F.col(f"{prefix}{i}") for i in range(len(labels))]
    top = F.greatest(*counts)
    expr = None
    for label, c in zip(labels, counts):
        cond = (c == top) & (c > 0)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr


def row_order(year: str, month: str, tie_breaker: str) -> Column:
    """Total order of traffic rows inside a company: (period, row key)."""
    return F.struct(yyyymm(year, month).alias("p"), F.col(tie_breaker).alias("k"))


def traffic_row_order(weight: str | None = None) -> Column:
    """Total order of traffic rows; where several rows have one key (they carry a
    ``weight``), those go by country and visits."""
    if weight is None:
        return row_order("traffic_year", "traffic_month", "web_traffic_id")
    return F.struct(yyyymm("traffic_year", "traffic_month").alias("p"), F.col("web_traffic_id").alias("k"),
                    F.col("site_country").alias("c"), F.col("total_visits").alias("v"))


def first_by(c, order: Column) -> Column:
    """Value at the smallest ``order`` (a NULL value there stays NULL)."""
    return F.min_by(_col(c), order)


def last_by(c, order: Column) -> Column:
    """Value at the largest ``order`` (a NULL value there stays NULL)."""
    return F.max_by(_col(c), order)


def first_row(cols: list[str], order: Column, name: str = "_first_row") -> Column:
    """Several columns of the first row as one struct: a single aggregate buffer
    instead of one (value, order key) buffer per column."""
    return F.min_by(F.struct(*[F.col(c) for c in cols]), order).alias(name)
