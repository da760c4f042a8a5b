"""Lists and dictionaries given as tables of any size.

Both are broadcast when their measured size is within a budget. Beyond it,

* ``without_listed`` first asks a bit table of the list: one bit for the hash of each
  listed value, about ``BITS_A_VALUE`` times as many bits as values, kept in the rows of a small
  table (Spark's bitmap aggregates). A row whose bit is not set is certainly
  not listed and stays where it is; only the others, the listed rows and a few
  in a hundred besides, are joined with the list. The bit table is itself
  measured, and left out if it is too large;
* ``canonical_by_table`` joins by the dictionary's spellings.

Either join deals values that hold many rows to several tasks (``operators.skew``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitelens.operators.domain_match import DEFAULT_BROADCAST_BYTES, fits_broadcast
from sitelens.operators.skew import heavy_keys, salted_join
from sitelens.session import materialize

BITS_A_VALUE = 16
#: Bits in a row of Spark's bitmap aggregates (fixed value).
_ROW_BITS = 32768
_VALUE, _BIT, _ROW, _MAP = "_listed_value", "_bit", "_bit_row", "_bit_map"


def _bit_of(value: str, bits: int) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(bits))


def bit_table(values: DataFrame, bits: int) -> DataFrame:
    """(_bit_row, _bit_map): the bits of the hashes of ``_listed_value``, in rows of ``_ROW_BITS``."""
    placed = values.select(_bit_of(_VALUE, bits).alias(_BIT))
    row = F.floor(F.col(_BIT) / _ROW_BITS).cast("long")
    return placed.groupBy(row.alias(_ROW)).agg(F.bitmap_construct_agg(F.col(_BIT) % _ROW_BITS).alias(_MAP))


def _is_set(position: Column) -> Column:
    """The bit of ``_bit_map`` at a position: its byte, then the bit from the low end."""
    byte = F.conv(F.hex(F.substring(F.col(_MAP), (F.floor(position / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("long")
    return F.coalesce(F.floor(byte / F.pow(F.lit(2.0), position % 8)).cast("long") % 2 == 1, F.lit(False))


def without_listed(df: DataFrame, value: Column, listed: DataFrame, spread_by: Sequence[str],
                   budget_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Rows of ``df`` whose ``value`` is NULL or not in the single column of
    ``listed`` (its NULLs and repeats don't count)."""
    rows = df.withColumn(_VALUE, value)
    values = listed.toDF(_VALUE).filter(F.col(_VALUE).isNotNull()).distinct()
    if fits_broadcast(values, budget_bytes):
        return rows.join(F.broadcast(values), _VALUE, "left_anti").select(*df.columns)
    values = materialize(values, "listed_values")
    bits = max(_ROW_BITS, BITS_A_VALUE * values.count())
    if bits // 8 > max(budget_bytes, _ROW_BITS):
        return salted_join(rows, values, _VALUE, spread_by, "left_anti").select(*df.columns)
    table = materialize(bit_table(values, bits), "listed_bits")
    bit = _bit_of(_VALUE, bits)
    asked = (rows.withColumn(_BIT, bit).withColumn(_ROW, F.floor(F.col(_BIT) / _ROW_BITS).cast("long"))
             .join(F.broadcast(table), _ROW, "left").withColumn("_maybe", _is_set(F.col(_BIT) % _ROW_BITS) & F.col(_VALUE).isNotNull())
             .drop(_ROW, _BIT, _MAP))
    suspects = asked.filter("_maybe")
    clean = salted_join(suspects, values, _VALUE, spread_by, "left_anti")
    return asked.filter("NOT _maybe").select(*df.columns).unionByName(clean.select(*df.columns))


class AmbiguousVariant(ValueError):
    pass


def canonical_by_table(df: DataFrame, column: str, out: str, variants: DataFrame, spread_by: Sequence[str],
                       budget_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """``df`` with ``out``: the canonical name of ``column`` by a table (variant,
    canonical), matched in lower case; names that it lacks stay as they are. A
    spelling of several canonical names is refused."""
    spelled = variants.toDF("_variant", "_canonical").filter("_variant IS NOT NULL AND _canonical IS NOT NULL")
    table = materialize(spelled.groupBy(F.lower("_variant").alias(_VALUE)).agg(
        F.min("_canonical").alias("_canonical"), F.max("_canonical").alias("_other")), "variants")
    if not table.filter("_canonical <> _other").isEmpty():
        raise AmbiguousVariant(f"spellings of several names: {[r[0] for r in table.filter('_canonical <> _other').limit(5).collect()]}")
    table = table.drop("_other")
    rows = df.withColumn(_VALUE, F.lower(F.col(column)))
    if fits_broadcast(table, budget_bytes):
        joined = rows.join(F.broadcast(table), _VALUE, "left")
    else:
        joined = salted_join(rows, table, _VALUE, spread_by, "left", heavy_keys(rows, _VALUE))
    others = [c for c in df.columns if c != out]
    return joined.select(*others, F.coalesce("_canonical", F.col(column)).alias(out))
