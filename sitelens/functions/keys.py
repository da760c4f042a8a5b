"""Surrogate keys (N10): md5 over '-'-joined string casts, NULL as a marker."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the text that stands in for NULL inside a surrogate key.
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*cols) -> Column:
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(SURROGATE_NULL))
             for c in cols]
    return F.md5(F.concat_ws("-", *parts))
