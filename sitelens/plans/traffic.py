"""Enhanced traffic: platform mix, quality scores and tiers, domains (M1-M9).

Every step is a per-row projection, so the model is one narrow, shuffle-free
stage over the staged rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitelens.functions.domains import root_domain, standardize_domain
from sitelens.functions.metrics import mean_available, safe_div, tier
from sitelens.schemas import TRAFFIC_ENHANCED, enforce

# Tier bounds and labels.
QUALITY_TIERS = [(0.8, "High-Quality"), (0.6, "Medium-Quality"), (0.4, "Low-Quality")]
QUALITY_UNKNOWN = "Unknown-Quality"
PAGES_FOR_FULL_SCORE = 10.0
SECONDS_FOR_FULL_SCORE = 300.0
DOMINANCE_FACTOR = 2
# Closed label sets, sorted so that ties of their modes go to the smallest label.
PLATFORM_LABELS = ["Balanced", "Desktop-Dominant", "Mixed", "Mobile-Dominant"]
QUALITY_LABELS = ["High-Quality", "Low-Quality", "Medium-Quality", "Unknown-Quality"]
LEADER_LABELS = ["Desktop-Better-Engagement", "Mobile-Better-Engagement", "Similar-Engagement"]
BALANCE_BAND = (3, 10)  # |m - d| <= 0.3 * max(m, d), kept in exact integer arithmetic


def platform_preference(mobile, desktop) -> Column:
    m, d = F.coalesce(mobile, F.lit(0)), F.coalesce(desktop, F.lit(0))
    return (F.when(m > d * DOMINANCE_FACTOR, "Mobile-Dominant")
            .when(d > m * DOMINANCE_FACTOR, "Desktop-Dominant")
            .when(F.abs(m - d) * BALANCE_BAND[1] <= F.greatest(m, d) * BALANCE_BAND[0], "Balanced")
            .otherwise("Mixed"))


def engagement_leader(mobile_bounce, desktop_bounce) -> Column:
    """Lower bounce rate wins; a missing rate counts as 0."""
    m, d = F.coalesce(mobile_bounce, F.lit(0.0)), F.coalesce(desktop_bounce, F.lit(0.0))
    return (F.when(m < d, "Mobile-Better-Engagement")
            .when(d < m, "Desktop-Better-Engagement")
            .otherwise("Similar-Engagement"))


def platform_ratio(part, other) -> Column:
    p, o = F.coalesce(part, F.lit(0)), F.coalesce(other, F.lit(0))
    return F.when(p + o > 0, safe_div(p, p + o))


def quality_components(df: DataFrame) -> DataFrame:
    b, p = F.col("total_bounce_rate"), F.col("total_pages_per_visit")
    s, v, u = F.col("total_visit_duration_seconds"), F.col("total_visits"), F.col("total_unique_visitors")
    return df.withColumns({
        "bounce_quality_score": F.when(b.between(0, 1), F.lit(1.0) - b),
        "pages_quality_score": F.when(p > 0, F.least(p / F.lit(PAGES_FOR_FULL_SCORE), F.lit(1.0))),
        "duration_quality_score": F.when(s > 0, F.least(s / F.lit(SECONDS_FOR_FULL_SCORE), F.lit(1.0))),
        "uniqueness_quality_score": F.when((v > 0) & (u > 0), F.least(safe_div(u, v), F.lit(1.0))),
    })


def enhance_traffic(stg: DataFrame) -> DataFrame:
    """Per-row enhancement of staged traffic rows (no filter)."""
    m, d = F.col("mobile_visits"), F.col("desktop_visits")
    with_platform = stg.withColumns({
        "mobile_traffic_ratio": platform_ratio(m, d),
        "desktop_traffic_ratio": platform_ratio(d, m),
        "platform_preference": platform_preference(m, d),
        "platform_engagement_leader": engagement_leader(F.col("mobile_bounce_rate"), F.col("desktop_bounce_rate")),
    })
    scored = quality_components(with_platform)
    scored = scored.withColumn("overall_quality_score", mean_available(
        "bounce_quality_score", "pages_quality_score", "duration_quality_score", "uniqueness_quality_score"))
    out = scored.withColumns({
        "quality_tier": tier("overall_quality_score", QUALITY_TIERS, QUALITY_UNKNOWN, inclusive=True),
        "standardized_domain": standardize_domain("site_domain"),
        "root_domain": root_domain("site_domain"),
        "_enhanced_at": F.current_timestamp(),
    })
    return enforce(out.filter(F.col("site_domain").isNotNull()), TRAFFIC_ENHANCED)


def with_traffic(stg: DataFrame) -> DataFrame:
    """Rows with positive visits (NULL visits are dropped too)."""
    return stg.filter(F.col("total_visits") > 0)


def traffic_enhanced(stg: DataFrame) -> DataFrame:
    """Full build of the enhanced traffic model."""
    return enhance_traffic(with_traffic(stg))
