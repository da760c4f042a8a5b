"""Equi-join of companies to traffic rows on a normalised domain.

The company side is small after the country and domain filters, so it is
broadcast - but only after its row count has been measured against a byte
budget. Beyond the budget the join is a shuffle (sort-merge) join on the
precomputed key, in which domains that hold many traffic rows are measured
and dealt to several tasks (``operators.skew``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitelens.operators.skew import salted_join

MATCH_KEY = "_match_key"
#: How many rows a row stands for, in tables where keys repeat.
WEIGHT = "_weight"
DEFAULT_BROADCAST_BYTES = 256 * 1024 * 1024


#: Columns of traffic rows that tell those of one domain apart.
SPREAD_BY = ("web_traffic_id",)


def match_key(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.lower(F.trim(c))


def weight_of(df: DataFrame) -> str | None:
    """The weight column, if the table has one (else every row counts once)."""
    return WEIGHT if WEIGHT in df.columns else None


# Fixed per-value widths (bytes) of the hash-table row format; strings add their length.
_FIXED_WIDTH = {"long": 8, "double": 8, "int": 4, "boolean": 1, "timestamp_ntz": 8, "timestamp": 8,
                "date": 4, "string": 8}


def measure_bytes(df: DataFrame) -> int:
    """Rows x fixed widths + actual string bytes: one distributed aggregate
    (partial counts per task), only the single total reaches the driver."""
    fields = df.schema.fields
    fixed = 16 + sum(_FIXED_WIDTH.get(f.dataType.simpleString(), 16) for f in fields)
    strings = [F.coalesce(F.octet_length(F.col(f.name)), F.lit(0)).cast("long")
               for f in fields if f.dataType.simpleString() == "string"]
    text = sum(strings, F.lit(0).cast("long")) if strings else F.lit(0).cast("long")
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(text).alias("b")).first()
    return int(row["n"]) * fixed + int(row["b"] or 0)


def fits_broadcast(df: DataFrame, budget_bytes: int) -> bool:
    """Is the measured size of ``df`` within ``budget_bytes``?"""
    return measure_bytes(df) <= budget_bytes


def domain_join(small: DataFrame, small_domain, big: DataFrame, big_domain,
                budget_bytes: int = DEFAULT_BROADCAST_BYTES, how: str = "inner", spread_by=SPREAD_BY) -> DataFrame:
    """Join ``small`` and ``big`` on ``lower(trim(domain))`` of each side. ``spread_by``:
    columns of ``big`` that tell the rows of a hot domain apart."""
    s = small.withColumn(MATCH_KEY, match_key(small_domain))
    b = big.withColumn(MATCH_KEY, match_key(big_domain))
    if fits_broadcast(s, budget_bytes):
        return b.join(F.broadcast(s), MATCH_KEY, how).drop(MATCH_KEY)
    return salted_join(b, s, MATCH_KEY, spread_by, how).drop(MATCH_KEY)


def keep_matching(big: DataFrame, big_domain, keys: DataFrame,
                  budget_bytes: int = DEFAULT_BROADCAST_BYTES, spread_by=SPREAD_BY) -> DataFrame:
    """Rows of ``big`` whose ``lower(trim(domain))`` is one of ``keys[MATCH_KEY]``
    (a semi join: each row at most once, whatever the number of matching
    companies). The distinct keys are broadcast only after measuring them."""
    b = big.withColumn(MATCH_KEY, match_key(big_domain))
    k = keys.select(MATCH_KEY).distinct()
    if fits_broadcast(k, budget_bytes):
        return b.join(F.broadcast(k), MATCH_KEY, "left_semi")
    return salted_join(b, k, MATCH_KEY, spread_by, "left_semi")


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """The values of ``key`` that several rows have (one map-side combined count)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(key)


def keep_matching_by_key(big: DataFrame, matchable: DataFrame, big_domain, key: str, repeated: DataFrame,
                         keys: DataFrame, budget_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """``keep_matching`` followed by a join back to ``big`` on ``key``, where
    several rows may have one key, without forming the pairs.

    Of the n rows of a key that match domain d, each brings all rows of that key
    along: every row of the key comes once for d, with weight n. Rows whose key
    no other row has (all but those of ``repeated``) come as they are, with
    weight 1, and are neither counted nor joined on the key."""
    ids = repeated.select(key)
    if fits_broadcast(ids, budget_bytes):
        ids = F.broadcast(ids)
    single = keep_matching(matchable.join(ids, key, "left_anti"), big_domain, keys, budget_bytes)
    partners = (keep_matching(matchable.join(ids, key, "left_semi").select(key, big_domain), big_domain, keys, budget_bytes)
                .groupBy(key, MATCH_KEY).agg(F.count(F.lit(1)).alias(WEIGHT)))
    several = big.join(ids, key, "left_semi").join(partners, key)
    return (single.withColumn(WEIGHT, F.lit(1).cast("long"))
            .unionByName(several.select(*single.columns, WEIGHT)))
