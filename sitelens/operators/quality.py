"""Declarative data-quality checks compiled to a few Spark aggregates (Q1-Q8).

All row-wise checks of one model (not_null, accepted_values,
accepted_range, expression, each with an optional ``where``) become one
``agg`` of ``count_if`` columns - a single scan with map-side partial
counts. ``unique`` is one grouped count per column and ``relationships`` a
grouped count per child key followed by an anti join of unique keys. The
result is a DataFrame, never collected here:
``(model, check_name, column_name, severity, failures)``.

``WatchedChecks`` counts a model's row checks while its rows are written, so
they cost no scan of the table (``DataFrame.observe``: the counts come with the
write's own tasks, each partition once).
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

ROW_KINDS = ("not_null", "accepted_values", "accepted_range", "expression")
RESULT_SCHEMA = "model string, check_name string, column_name string, severity string, failures bigint"


@dataclass(frozen=True)
class Check:
    kind: str
    column: str | None = None
    values: tuple = ()
    min_value: float | None = None
    max_value: float | None = None
    inclusive: bool = True
    expression: str | None = None
    where: str | None = None
    severity: str = "error"
    to_model: str | None = None
    field: str | None = None
    name: str | None = None

    @property
    def label(self) -> str:
        return self.name or self.kind


class CheckFailed(AssertionError):
    pass


def failing_rows(check: Check) -> Column:
    """Boolean column: the row fails ``check`` (a NULL outcome passes)."""
    c = F.col(check.column) if check.column else None
    if check.kind == "not_null":
        bad = c.isNull()
    elif check.kind == "accepted_values":
        bad = ~c.isin(*check.values)
    elif check.kind == "accepted_range":
        conds = []
        if check.min_value is not None:
            conds.append(c >= check.min_value if check.inclusive else c > check.min_value)
        if check.max_value is not None:
            conds.append(c <= check.max_value if check.inclusive else c < check.max_value)
        bad = ~reduce(lambda a, b: a & b, conds)
    elif check.kind == "expression":
        bad = ~F.expr(check.expression)
    else:
        raise ValueError(f"not a row check: {check.kind}")
    if check.where:
        bad = F.expr(check.where) & bad
    return F.coalesce(bad, F.lit(False))


def _result(model: str, check: Check, failures: Column) -> Column:
    return F.struct(F.lit(model).alias("model"), F.lit(check.label).alias("check_name"),
                    F.lit(check.column or "").alias("column_name"), F.lit(check.severity).alias("severity"),
                    failures.cast("long").alias("failures"))


def run_checks(model: str, df: DataFrame, checks: Sequence[Check],
               parents: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Failure counts of every check on ``df`` (one row per check)."""
    parts: list[DataFrame] = []
    row_checks = [c for c in checks if c.kind in ROW_KINDS]
    if row_checks:
        counts = df.agg(*[F.count_if(failing_rows(c)).alias(f"_c{i}") for i, c in enumerate(row_checks)])
        parts.append(counts.select(F.explode(F.array(*[
            _result(model, c, F.col(f"_c{i}")) for i, c in enumerate(row_checks)])).alias("r")).select("r.*"))
    for c in checks:
        if c.kind == "unique":
            dup = (df.filter(F.col(c.column).isNotNull()).groupBy(c.column).count()
                   .filter(F.col("count") > 1))
            parts.append(dup.agg(F.count(F.lit(1)).alias("n")).select(_result(model, c, F.col("n")).alias("r"))
                         .select("r.*"))
        elif c.kind == "relationships":
            # Count child rows per key first (map-side combined, so a key holding a
            # third of all rows is one row per task), then anti-join unique keys.
            parent = (parents or {})[c.to_model].select(F.col(c.field).alias("_parent_key"))
            per_key = (df.filter(F.col(c.column).isNotNull()).groupBy(c.column)
                       .agg(F.count(F.lit(1)).alias("_rows")))
            orphans = per_key.join(parent, F.col(c.column) == F.col("_parent_key"), "left_anti")
            parts.append(orphans.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("n"))
                         .select(_result(model, c, F.col("n")).alias("r")).select("r.*"))
        elif c.kind not in ROW_KINDS:
            raise ValueError(f"unknown check kind {c.kind}")
    if not parts:
        return df.sparkSession.createDataFrame([], RESULT_SCHEMA)
    return reduce(DataFrame.unionByName, parts)


class WatchedChecks:
    """The row-wise checks of one model, counted by the write of its rows: write
    ``attach(rows)`` as it is (nothing but the write may follow), once, then read ``counts``."""

    def __init__(self, model: str, checks: Iterable[Check]):
        self.model = model
        self.checks = [c for c in checks if c.kind in ROW_KINDS]
        self._seen = Observation(f"row checks {uuid.uuid4().hex}")

    def attach(self, rows: DataFrame) -> DataFrame:
        return rows.observe(self._seen, *[F.count_if(failing_rows(c)).alias(f"_c{i}") for i, c in enumerate(self.checks)]) if self.checks else rows

    def counts(self) -> list[int]:
        """Failures of each check; waits for the write."""
        found = self._seen.get if self.checks else {}
        return [found[f"_c{i}"] for i in range(len(self.checks))]

    def scanned(self, rows: DataFrame) -> list[int]:
        """The same counts by a scan (one aggregate)."""
        if not self.checks:
            return []
        return list(rows.agg(*[F.count_if(failing_rows(c)) for c in self.checks]).first())

    def results(self, spark, counts: Sequence[int]) -> DataFrame:
        rows = [(self.model, c.label, c.column or "", c.severity, n) for c, n in zip(self.checks, counts, strict=True)]
        return spark.createDataFrame(rows, RESULT_SCHEMA)

    @property
    def signature(self) -> str:
        """Changes with the rules."""
        return hashlib.md5(repr(self.checks).encode()).hexdigest()


def run_suite(models: Mapping[str, DataFrame], suite: Mapping[str, Iterable[Check]],
              kinds: Sequence[str] | None = None) -> DataFrame:
    """Run every model's checks (optionally only some kinds) as one DataFrame."""
    parts = []
    for model, checks in suite.items():
        selected = [c for c in checks if kinds is None or c.kind in kinds]
        if selected:
            parts.append(run_checks(model, models[model], selected, models))
    return reduce(DataFrame.unionByName, parts)


def raise_on_errors(results: DataFrame) -> DataFrame:
    """Raise if an error-severity check failed; warn-severity failures are only reported.

    The results table has one row per check (a few hundred rows at most),
    so bringing the failing ones to the driver is bounded."""
    failed = results.filter((F.col("failures") > 0) & (F.col("severity") == "error")).collect()
    if failed:
        raise CheckFailed("; ".join(f"{r.model}.{r.column_name} {r.check_name}: {r.failures}" for r in failed))
    return results
