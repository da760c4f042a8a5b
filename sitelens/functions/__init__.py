"""Column -> Column helpers. All are built from ``pyspark.sql.functions`` so
they stay inside whole-stage codegen; none is a Python UDF."""

from sitelens.functions.domains import root_domain, standardize_domain
from sitelens.functions.geo import CITY_VARIANTS, REGION_VARIANTS, canonical_city, canonical_region, canonicalize
from sitelens.functions.keys import SURROGATE_NULL, surrogate_key
from sitelens.functions.metrics import (
    argmax_label, clamp, mean_available, ratio_if_positive, safe_div, tier, weighted_avg,
)
from sitelens.functions.periods import months_span, period_label, period_ordinal, yyyymm

__all__ = [
    "standardize_domain", "root_domain", "canonicalize", "canonical_city", "canonical_region",
    "CITY_VARIANTS", "REGION_VARIANTS", "surrogate_key", "SURROGATE_NULL", "argmax_label", "clamp",
    "mean_available", "ratio_if_positive", "safe_div", "tier", "weighted_avg", "months_span",
    "period_label", "period_ordinal", "yyyymm",
]
