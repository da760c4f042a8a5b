"""Scalar metric helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(num, den) -> Column:
    """Division that yields NULL for a zero denominator (ANSI mode would raise)."""
    return F.try_divide(_col(num).cast("double"), _col(den).cast("double"))


def ratio_if_positive(num, den) -> Column:
    """``num/den`` when ``den > 0``, else NULL."""
    den = _col(den)
    return F.when(den > 0, safe_div(num, den))


def mean_available(*cols) -> Column:
    """Mean of the non-NULL arguments; NULL when all are NULL."""
    cs = [_col(c) for c in cols]
    total = sum((F.coalesce(c, F.lit(0.0)) for c in cs), F.lit(0.0))
    present = sum((F.when(c.isNotNull(), 1).otherwise(0) for c in cs), F.lit(0))
    return safe_div(total, present)


def tier(value, thresholds: Sequence[tuple[float, str]], default: str,
         inclusive: bool = False, null_label: str | None = None) -> Column:
    """First label whose threshold the value exceeds (``>=`` when inclusive).

    ``null_label`` (if given) is returned for a NULL value; otherwise NULL
    falls through to ``default``.
    """
    v = _col(value)
    expr = None
    for bound, label in thresholds:
        cond = v >= F.lit(bound) if inclusive else v > F.lit(bound)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    if null_label is not None:
        expr = expr.when(v.isNotNull(), default).otherwise(null_label)
    else:
        expr = expr.otherwise(default)
    return expr


def argmax_label(pairs: Sequence[tuple[str, object]], fallback: str) -> Column:
    """Label of the largest value (NULL counts as 0); earlier labels win ties."""
    vals = [F.coalesce(_col(c).cast("double"), F.lit(0.0)) for _, c in pairs]
    top = F.greatest(*vals)
    expr = None
    for (label, _), v in zip(pairs, vals):
        expr = F.when(top == v, label) if expr is None else expr.when(top == v, label)
    return expr.otherwise(fallback)


def weighted_avg(value, weight, skip_null_weights: bool = False) -> Column:
    """Aggregate ``sum(value*weight)/sum(weight)`` when ``sum(weight) > 0``.

    As in the source rules, a NULL value drops out of the numerator while its
    weight stays in the denominator; ``skip_null_weights=True`` drops it from
    both.
    """
    v, wt = _col(value), _col(weight)
    w = F.sum(F.when(v.isNotNull(), wt)) if skip_null_weights else F.sum(wt)
    return F.when(w > 0, safe_div(F.sum(v * wt), w))


def clamp(c, lo: float, hi: float) -> Column:
    return F.least(F.lit(hi), F.greatest(F.lit(lo), _col(c)))
