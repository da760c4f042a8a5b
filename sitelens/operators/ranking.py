"""Row numbers inside very large groups without putting a group in one task.

``row_number() over (partition by g order by o)`` makes Spark gather each
group ``g`` into a single task. For groups such as "all sites of one month"
that is unbounded. Here the whole input is range-partitioned on ``(g, o)``
instead (Spark samples the keys, so every task gets a similar share even
when one group holds a third of all rows); each task numbers its rows in
order and a tiny per-(task, group) table of row counts supplies the offset
each task must add for the part of a group that earlier tasks hold.

Cost of ``grouped_row_number``: one range shuffle of the input, one shuffle keyed by (task, group)
whose keys each hold at most one range partition, and aggregates over a
table with at most (#groups + #partitions) rows. ``add_row_numbers`` exchanges the
rows once for any number of groupings, and only their keys otherwise.

The numbered rows are checkpointed or written (to the shared checkpoint
folder): range bounds come from a sample whose seed depends on the plan, so
both uses of the numbered rows (the per-task counts and the rows themselves)
must read one frozen copy - also when a lost executor forces recomputation.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitelens.session import ensure_checkpoint_dir, write_table

_IDX_BITS = 33  # monotonically_increasing_id(): partition id << 33 | row index


def grouped_row_number(df: DataFrame, group_cols: Sequence[str], order_by: Sequence[Column],
                       out_col: str, num_partitions: int | None = None) -> DataFrame:
    """Add ``out_col`` = 1-based position of each row inside its group.

    ``order_by`` must order rows totally inside a group (add a unique
    tie-breaker) so that re-executed tasks produce the same numbers.
    NULL group values form their own group, as in a window partition.
    """
    keys = [F.col(c) for c in group_cols]
    sort_keys = [k.asc_nulls_first() for k in keys] + list(order_by)
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ensure_checkpoint_dir(df.sparkSession)
    ranged = (df.repartitionByRange(n, *sort_keys)
              .sortWithinPartitions(*sort_keys)
              .withColumn("_rn_id", F.monotonically_increasing_id())
              .withColumn("_rn_task", F.shiftright("_rn_id", _IDX_BITS))
              .withColumn("_rn_pos", F.col("_rn_id").bitwiseAND(F.lit((1 << _IDX_BITS) - 1)))
              .checkpoint(eager=True))

    # One row per (task, group): where the group starts inside the task and
    # how many rows of the group earlier tasks hold.
    blocks = ranged.groupBy("_rn_task", *group_cols).agg(
        F.min("_rn_pos").alias("_rn_start"), F.count(F.lit(1)).alias("_rn_cnt"))
    before = Window.partitionBy(*group_cols).orderBy("_rn_task").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = blocks.select(
        F.col("_rn_task").alias("_o_task"),
        *[F.col(c).alias(f"_o_{i}") for i, c in enumerate(group_cols)],
        "_rn_start",
        F.coalesce(F.sum("_rn_cnt").over(before), F.lit(0)).alias("_rn_before"))

    cond = reduce(lambda a, b: a & b,
                  [F.col("_rn_task") == F.col("_o_task")]
                  + [F.col(c).eqNullSafe(F.col(f"_o_{i}")) for i, c in enumerate(group_cols)])
    joined = ranged.join(offsets, cond, "inner")
    number = F.col("_rn_pos") - F.col("_rn_start") + F.col("_rn_before") + F.lit(1)
    return joined.withColumn(out_col, number.cast("long")).drop(
        "_rn_id", "_rn_task", "_rn_pos", "_rn_start", "_rn_before", "_o_task",
        *[f"_o_{i}" for i in range(len(group_cols))])


def add_row_numbers(df: DataFrame, specs: Sequence[tuple[str, Sequence[str]]], order_by: Sequence[Column],
                    scratch: list[str] | None = None) -> DataFrame:
    """Add several row-number columns ``(out_col, group_cols)`` sharing one
    ordering, which must be total inside each group.

    The rows are written once; what is range-partitioned, on the columns that all
    groups share and the order, are only their ids and group columns. Each spec's
    groups lie in that order too, so one pass numbers the rows of all specs: a
    (task, group) begins with the rows that earlier tasks hold of the group, which
    one more row brings along. The rows themselves are exchanged once, to get their
    numbers by id. ``scratch`` gets the folders written, which the result reads."""
    if not specs:
        return df
    scratch = [] if scratch is None else scratch
    columns = list(dict.fromkeys(c for _, groups in specs for c in groups))
    shared = [c for c in columns if all(c in groups for _, groups in specs)]

    def written(rows: DataFrame, name: str) -> DataFrame:
        scratch.append(write_table(rows, name))
        return rows.sparkSession.read.schema(rows.schema).parquet(scratch[-1])

    rows = written(df.withColumn("_rn_row", F.monotonically_increasing_id()), "unnumbered")
    keys = [F.col(c).asc_nulls_first() for c in shared] + list(order_by)
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = written(
        rows.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
        .select("_rn_row", *columns, F.monotonically_increasing_id().alias("_rn_id"))
        .select("_rn_row", *columns, F.shiftright("_rn_id", _IDX_BITS).alias("_rn_task"),
                F.col("_rn_id").bitwiseAND(F.lit((1 << _IDX_BITS) - 1)).alias("_rn_pos")), "in_order")

    def counting(adds: Sequence[Column]) -> list[Column]:
        return [c.cast("long").alias(f"_rn_add_{i}") for i, c in enumerate(adds)]

    counted = ranged.select("*", *counting([F.lit(1)] * len(specs)))
    for i, (_, groups) in enumerate(specs):
        before = Window.partitionBy(*groups).orderBy("_rn_task").rowsBetween(Window.unboundedPreceding, -1)
        held = (ranged.groupBy("_rn_task", *groups).agg(F.count(F.lit(1)).alias("_rn_cnt"))
                .withColumn("_rn_before", F.sum("_rn_cnt").over(before)).filter("_rn_before > 0"))
        counted = counted.unionByName(held.select(
            "_rn_task", *groups, F.lit(-1).cast("long").alias("_rn_pos"),
            *counting([F.col("_rn_before") if j == i else F.lit(0) for j in range(len(specs))])), allowMissingColumns=True)
    numbers = counted.repartition("_rn_task").select("_rn_row", *[
        F.sum(f"_rn_add_{i}").over(Window.partitionBy("_rn_task", *groups).orderBy("_rn_pos")
                                   .rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias(out)
        for i, (out, groups) in enumerate(specs)]).filter(F.col("_rn_row").isNotNull())
    return rows.join(numbers, "_rn_row").drop("_rn_row")
