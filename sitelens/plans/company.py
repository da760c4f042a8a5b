"""Company digital performance mart (A1-A7, M10-M12): one row per company."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelens.functions.metrics import argmax_label, ratio_if_positive
from sitelens.functions.periods import yyyymm
from sitelens.operators.domain_match import MATCH_KEY, weight_of
from sitelens.operators.aggregates import first_row, label_counts, mean, top_label, total, traffic_row_order
from sitelens.operators.skew import ByKey, by_key
from sitelens.plans.traffic import LEADER_LABELS, PLATFORM_LABELS, QUALITY_LABELS
from sitelens.schemas import MART_COMPANY, enforce

# Segment labels in tie-break order.
AGE_SEGMENTS = [("18-24", "age_18_24_share"), ("25-34", "age_25_34_share"), ("35-44", "age_35_44_share"),
                ("45-54", "age_45_54_share"), ("55-64", "age_55_64_share"), ("65+", "age_65_plus_share")]
GENDER_BAND = 0.1

COMPANY_ATTRS = ["organization_name", "organization_permalink", "organization_domain", "standardized_city",
                 "standardized_region", "organization_country_code", "is_investor",
                 "organization_created_at", "organization_updated_at"]
# Traffic attributes taken from the first row (any_value made deterministic).
FIRST_ROW_RENAMES = {"site_domain": "site_domain", "site_main_category": "industry_category",
                     "site_category": "industry_subcategory", "site_country": "traffic_country",
                     "match_confidence_score": "match_confidence_score"}
FIRST_ROW_TRAFFIC_ONLY = ["site_domain", "site_main_category", "site_category", "site_country"]
SUMMED = ["total_visits", "total_unique_visitors", "total_page_views", "desktop_visits", "mobile_visits",
          "desktop_direct_visits", "desktop_organic_search_visits", "desktop_paid_search_visits",
          "desktop_referral_visits", "desktop_social_visits", "desktop_display_visits", "desktop_email_visits"]
AVERAGED = ["mobile_traffic_ratio", "desktop_traffic_ratio", "total_pages_per_visit",
            "total_visit_duration_seconds", "total_bounce_rate", "desktop_bounce_rate", "mobile_bounce_rate",
            "age_18_24_share", "age_25_34_share", "age_35_44_share", "age_45_54_share", "age_55_64_share",
            "age_65_plus_share", "male_share", "female_share"]
RANKS = ["site_global_rank", "site_country_rank", "site_main_category_rank", "site_category_rank"]
CHANNEL_SHARES = [("desktop_direct_share", "desktop_direct_visits"),
                  ("desktop_organic_share", "desktop_organic_search_visits"),
                  ("desktop_paid_share", "desktop_paid_search_visits"),
                  ("desktop_referral_share", "desktop_referral_visits"),
                  ("desktop_social_share", "desktop_social_visits"),
                  ("desktop_display_share", "desktop_display_visits"),
                  ("desktop_email_share", "desktop_email_visits")]


def period_text(p) -> F.Column:
    """'YYYY-MM' from an integer yyyymm."""
    p = F.col(p) if isinstance(p, str) else p
    return F.concat((p / 100).cast("int").cast("string"), F.lit("-"),
                    F.lpad((p % 100).cast("string"), 2, "0"))


def gender_segment(male, female) -> F.Column:
    m, f = F.coalesce(F.col(male), F.lit(0.0)), F.coalesce(F.col(female), F.lit(0.0))
    return (F.when(m > f, "Male-Leaning").when(f > m, "Female-Leaning")
            .when(F.abs(m - f) <= GENDER_BAND, "Balanced").otherwise("Unknown"))


def age_segment(prefix: str = "") -> F.Column:
    return argmax_label([(label, prefix + col) for label, col in AGE_SEGMENTS], "Unknown")


def numeric_aggs(weight: str | None = None) -> list:
    """Aggregates with numeric buffers only (a hash aggregate without fallback);
    with ``weight`` a row counts as that many."""
    return (
        [F.min(c).alias(c) for c in RANKS]
        + [mean("overall_quality_score", weight).alias("digital_performance_score")]
        + label_counts("quality_tier", QUALITY_LABELS, "_qt", weight)
        + label_counts("platform_preference", PLATFORM_LABELS, "_pp", weight)
        + label_counts("platform_engagement_leader", LEADER_LABELS, "_el", weight)
        + [total(c, weight).alias(c) for c in SUMMED]
        + [mean(c, weight).alias(c) for c in AVERAGED]
    )


def period_aggs(order, period) -> list:
    """First row and months: a narrow aggregate of its own."""
    return [first_row(FIRST_ROW_TRAFFIC_ONLY, order, "_first_traffic"),
            F.min(period).alias("_first"), F.max(period).alias("_last"),
            F.count_distinct(period).alias("months_available")]


def _finish(g: DataFrame) -> DataFrame:
    out = g.select("*", *[F.col("_first_traffic")[src].alias(dst)
                          for src, dst in FIRST_ROW_RENAMES.items() if src in FIRST_ROW_TRAFFIC_ONLY])
    out = out.withColumns({
        "performance_tier": top_label("_qt", QUALITY_LABELS),
        "platform_preference": top_label("_pp", PLATFORM_LABELS),
        "platform_engagement_leader": top_label("_el", LEADER_LABELS),
        "period_start": period_text("_first"),
        "period_end": period_text("_last"),
        **{share: ratio_if_positive(num, "desktop_visits") for share, num in CHANNEL_SHARES},
        "primary_age_segment": age_segment(),
        "primary_gender_segment": gender_segment("male_share", "female_share"),
        "_mart_created_at": F.current_timestamp(),
    })
    return enforce(out, MART_COMPANY)


def company_performance_by_domain(keyed_orgs: DataFrame, matched: DataFrame | ByKey) -> DataFrame:
    """Same mart without forming company x traffic pairs.

    Every company's rows are exactly the traffic rows of its match key, so
    the per-company aggregate equals the per-key aggregate: aggregate the
    matched traffic once per key (map-side combined, skew-safe), then attach
    the companies to their key's single row. The wide numeric columns and the
    first row are two aggregates over the same partitioning, which traffic
    stored by key has already."""

    def results(rows: DataFrame) -> DataFrame:
        grouped, weight = rows.groupBy(MATCH_KEY), weight_of(rows)
        return (grouped.agg(*numeric_aggs(weight))
                .join(grouped.agg(*period_aggs(traffic_row_order(weight), yyyymm("traffic_year", "traffic_month"))), MATCH_KEY))

    per_key = by_key(matched, results)
    companies = keyed_orgs.select("organization_id", *COMPANY_ATTRS, "match_confidence_score", MATCH_KEY)
    return _finish(companies.join(per_key, MATCH_KEY, "inner"))
