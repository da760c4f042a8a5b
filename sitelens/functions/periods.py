"""Month arithmetic on (year, month) pairs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def yyyymm(year, month) -> Column:
    """Integer period key ``year*100 + month``; sorts like the 'YYYYMM' text."""
    return _col(year) * 100 + _col(month)


def period_label(year, month) -> Column:
    """'YYYY-MM' text (NULL if either part is NULL)."""
    return F.concat(_col(year).cast("string"), F.lit("-"), F.lpad(_col(month).cast("string"), 2, "0"))


def period_ordinal(period: Column) -> Column:
    """Months since year 0 for an integer ``yyyymm`` key."""
    return F.floor(period / 100) * 12 + period % 100


def months_span(first_yyyymm, last_yyyymm) -> Column:
    """Inclusive number of calendar months between two ``yyyymm`` keys."""
    return (period_ordinal(_col(last_yyyymm)) - period_ordinal(_col(first_yyyymm)) + 1).cast("long")
