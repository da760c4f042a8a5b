"""Company time-series mart: first vs last month, peaks, growth and trend labels
(A8-A10, A19, F11, D1-D2, M13-M25). One row per company with >= 2 months."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelens.functions.metrics import clamp, safe_div, tier
from sitelens.functions.periods import months_span, yyyymm
from sitelens.operators.aggregates import first_row, label_counts, mean, top_label, traffic_row_order
from sitelens.operators.domain_match import MATCH_KEY, weight_of
from sitelens.operators.skew import ByKey, by_key
from sitelens.plans.company import period_text
from sitelens.plans.traffic import PLATFORM_LABELS, QUALITY_LABELS
from sitelens.schemas import MART_TIMESERIES, enforce

MIN_MONTHS = 2

GROUP_KEYS = ["organization_id", "organization_name", "organization_permalink", "organization_domain",
              "standardized_city", "standardized_region", "organization_country_code", "is_investor",
              "organization_created_at", "organization_updated_at"]
BOUNDARY_METRICS = {"total_visits": "visits", "overall_quality_score": "quality",
                    "site_global_rank": "global_rank", "site_country_rank": "country_rank",
                    "total_unique_visitors": "unique_visitors", "total_bounce_rate": "bounce_rate"}
PRESENCE = {"site_domain": "site_domain", "site_main_category": "industry_category",
            "site_category": "industry_subcategory", "site_country": "traffic_country",
            "match_confidence_score": "match_confidence_score"}
PRESENCE_TRAFFIC = ["site_domain", "site_main_category", "site_category", "site_country"]

# Trend bounds (strictly greater than) and labels.
GROWTH_TIERS = [(0.5, "High Growth"), (0.2, "Moderate Growth"), (-0.05, "Stable"), (-0.2, "Declining")]
QUALITY_TRENDS = [(0.1, "Quality Improving"), (-0.05, "Quality Stable")]
RANK_TRENDS = [(100, "Rank Significantly Improved"), (20, "Rank Improved"), (-20, "Rank Stable"),
               (-100, "Rank Declined")]
MOMENTUM_TIERS = [(0.9, "Near Peak Performance"), (0.7, "Strong Performance"), (0.5, "Moderate Performance")]
HEALTH_BASE, HEALTH_GROWTH_W, HEALTH_QUALITY_W = 50.0, 30.0, 20.0
HEALTH_GROWTH_ONLY_W, HEALTH_QUALITY_ONLY_W = 40.0, 30.0


def growth_health(g, q) -> F.Column:
    g, q = F.col(g), F.col(q)
    return (F.when(g.isNotNull() & q.isNotNull(),
                   clamp(F.lit(HEALTH_BASE) + g * HEALTH_GROWTH_W + q * HEALTH_QUALITY_W, 0.0, 100.0))
            .when(g.isNotNull(), clamp(F.lit(HEALTH_BASE) + g * HEALTH_GROWTH_ONLY_W, 0.0, 100.0))
            .when(q.isNotNull(), clamp(F.lit(HEALTH_BASE) + q * HEALTH_QUALITY_ONLY_W, 0.0, 100.0)))


def numeric_aggs(weight: str | None = None) -> list:
    """Aggregates with numeric buffers only (a hash aggregate without fallback);
    with ``weight`` a row counts as that many."""
    return [
        F.max("total_visits").alias("peak_visits"),
        F.min("site_global_rank").alias("best_global_rank"),
        F.max("overall_quality_score").alias("peak_quality_score"),
        mean("total_visits", weight).alias("avg_visits"),
        mean("overall_quality_score", weight).alias("avg_quality_score"),
        *label_counts("platform_preference", PLATFORM_LABELS, "_pp", weight),
        *label_counts("quality_tier", QUALITY_LABELS, "_qt", weight),
    ]


def period_aggs(order, period) -> list:
    """First and last row and months: a narrow aggregate of its own."""
    metrics = list(BOUNDARY_METRICS)
    return [
        first_row(PRESENCE_TRAFFIC, order, "_presence"),
        F.min(period).alias("_first"), F.max(period).alias("_last"),
        F.count_distinct(period).alias("months_available"),
        F.min_by(F.struct(*metrics), order).alias("_first_vals"),
        F.max_by(F.struct(*metrics), order).alias("_last_vals"),
    ]


def _boundary_columns(g: DataFrame) -> DataFrame:
    return g.select(
        *GROUP_KEYS,
        *[F.col("_presence")[src].alias(dst) for src, dst in PRESENCE.items() if src in PRESENCE_TRAFFIC],
        "match_confidence_score",
        period_text("_first").alias("first_month"), period_text("_last").alias("last_month"),
        "months_available", months_span("_first", "_last").alias("months_span"),
        top_label("_pp", PLATFORM_LABELS).alias("dominant_platform_preference"),
        top_label("_qt", QUALITY_LABELS).alias("dominant_quality_tier"), "avg_visits", "avg_quality_score",
        *[F.col("_first_vals")[m].alias(f"first_month_{n}") for m, n in BOUNDARY_METRICS.items()],
        *[F.col("_last_vals")[m].alias(f"last_month_{n}") for m, n in BOUNDARY_METRICS.items()],
        "peak_visits", "best_global_rank", "peak_quality_score",
    )


def timeseries_boundaries_by_domain(keyed_orgs: DataFrame, matched: DataFrame | ByKey,
                                    min_months: int = MIN_MONTHS) -> DataFrame:
    """Same boundaries without company x traffic pairs: aggregate matched traffic
    once per match key, keep keys with enough months, attach companies. The
    wide numeric columns and the boundary rows are two aggregates over the same
    partitioning, which traffic stored by key has already."""

    def results(rows: DataFrame) -> DataFrame:
        grouped, weight = rows.groupBy(MATCH_KEY), weight_of(rows)
        periods = (grouped.agg(*period_aggs(traffic_row_order(weight), yyyymm("traffic_year", "traffic_month")))
                   .filter(F.col("months_available") >= min_months))
        return grouped.agg(*numeric_aggs(weight)).join(periods, MATCH_KEY)

    per_key = by_key(matched, results)
    companies = keyed_orgs.select(*GROUP_KEYS, "match_confidence_score", MATCH_KEY)
    return _boundary_columns(companies.join(per_key, MATCH_KEY, "inner"))


def add_growth(b: DataFrame) -> DataFrame:
    fv, lv = F.col("first_month_visits"), F.col("last_month_visits")
    fq, lq = F.col("first_month_quality"), F.col("last_month_quality")
    span = F.col("months_span")
    both_q = fq.isNotNull() & lq.isNotNull()
    out = b.withColumns({
        "visits_growth_rate": F.when((fv > 0) & lv.isNotNull(), safe_div(lv - fv, fv)),
        "visits_monthly_growth_rate": F.when(
            (fv > 0) & lv.isNotNull() & (span > 1),
            F.pow(safe_div(lv, fv), F.lit(1.0) / (span - 1)) - 1),
        "visits_absolute_change": lv - fv,
        "quality_score_change": F.when(both_q, lq - fq),
        "quality_score_change_rate": F.when(both_q, safe_div(lq - fq, fq)),
        "global_rank_change": F.col("first_month_global_rank") - F.col("last_month_global_rank"),
        "country_rank_change": F.col("first_month_country_rank") - F.col("last_month_country_rank"),
        "current_vs_peak_visits_ratio": F.when((lv > 0) & (F.col("peak_visits") > 0),
                                               safe_div(lv, "peak_visits")),
        "current_vs_peak_quality_ratio": F.when(lq.isNotNull() & F.col("peak_quality_score").isNotNull(),
                                                safe_div(lq, "peak_quality_score")),
    })
    return out.withColumns({
        "growth_category": tier("visits_growth_rate", GROWTH_TIERS, "Significant Decline",
                                null_label="Insufficient Data"),
        "quality_trend": tier("quality_score_change", QUALITY_TRENDS, "Quality Declining",
                              null_label="Quality Unknown"),
        "ranking_trend": tier("global_rank_change", RANK_TRENDS, "Rank Significantly Declined",
                              null_label="Rank Unknown"),
        "performance_momentum": tier("current_vs_peak_visits_ratio", MOMENTUM_TIERS, "Below Peak Performance",
                                     null_label="Performance Unknown"),
        "growth_health_score": growth_health("visits_growth_rate", "quality_score_change"),
        "_mart_created_at": F.current_timestamp(),
    })


def company_timeseries_by_domain(keyed_orgs: DataFrame, matched: DataFrame | ByKey,
                                 min_months: int = MIN_MONTHS) -> DataFrame:
    return enforce(add_growth(timeseries_boundaries_by_domain(keyed_orgs, matched, min_months)),
                   MART_TIMESERIES)
