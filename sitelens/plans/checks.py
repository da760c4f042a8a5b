"""The declared quality checks of every model (230 checks)."""

from __future__ import annotations

from sitelens.operators.quality import Check

# Accepted value lists.
MONTHS = tuple(range(1, 13))
COUNTRIES = ("DNK", "SWE", "NOR", "FIN", "ISL")
BOOLS = (True, False)
PLATFORM = ("Mobile-Dominant", "Desktop-Dominant", "Balanced", "Mixed")
LEADER = ("Mobile-Better-Engagement", "Desktop-Better-Engagement", "Similar-Engagement")
QUALITY = ("High-Quality", "Medium-Quality", "Low-Quality", "Unknown-Quality")
AGE = ("18-24", "25-34", "35-44", "45-54", "55-64", "65+", "Unknown")
GENDER = ("Male-Leaning", "Female-Leaning", "Balanced", "Unknown")
GROWTH = ("High Growth", "Moderate Growth", "Stable", "Declining", "Significant Decline", "Insufficient Data")
QTREND = ("Quality Improving", "Quality Stable", "Quality Declining", "Quality Unknown")
RTREND = ("Rank Significantly Improved", "Rank Improved", "Rank Stable", "Rank Declined",
          "Rank Significantly Declined", "Rank Unknown")
MOMENTUM = ("Near Peak Performance", "Strong Performance", "Moderate Performance", "Below Peak Performance",
            "Performance Unknown")
CONCENTRATION = ("Highly Concentrated", "Moderately Concentrated", "Somewhat Concentrated", "Fragmented")
SIZE = ("Large Market", "Medium Market", "Small Market", "Niche Market")


def nn(*cols):
    return [Check("not_null", c) for c in cols]


def uq(c):
    return [Check("unique", c)]


def av(c, values):
    return [Check("accepted_values", c, values=tuple(values))]


def rng(c, lo=None, hi=None, nullable=False):
    """accepted_range; ``nullable`` adds the ``c is not null`` row filter."""
    return [Check("accepted_range", c, min_value=lo, max_value=hi,
                  where=f"{c} is not null" if nullable else None)]


def unit(*cols):
    return [x for c in cols for x in rng(c, 0, 1, nullable=True)]


def expr(name, e, where=None, severity="error"):
    return [Check("expression", expression=e, where=where, severity=severity, name=name)]


def rel(c, to_model, field):
    return [Check("relationships", c, to_model=to_model, field=field)]


def _sum_check(name, cols, prefix=""):
    cs = [prefix + c for c in cols]
    return expr(name, " + ".join(cs) + " <= 1.05", " and ".join(f"{c} is not null" for c in cs), "warn")


_AGES = ["age_18_24_share", "age_25_34_share", "age_35_44_share", "age_45_54_share", "age_55_64_share",
         "age_65_plus_share"]

SUITE: dict[str, list[Check]] = {
    "organization_summary": uq("uuid") + nn("uuid", "name"),
    "global_growth": nn("site", "year", "month") + av("month", MONTHS),
    "stg_organizations": uq("organization_id") + nn(
        "organization_id", "organization_name", "organization_created_at", "organization_updated_at",
        "_loaded_at"),
    "stg_traffic": uq("web_traffic_id") + nn("web_traffic_id", "site_domain", "traffic_year", "traffic_month")
    + av("traffic_month", MONTHS) + nn("total_visits", "_loaded_at"),
    "organizations_enhanced": uq("organization_id") + nn(
        "organization_id", "organization_name", "standardized_city", "organization_country_code")
    + av("organization_country_code", COUNTRIES) + nn("is_investor") + av("is_investor", BOOLS)
    + nn("organization_created_at", "organization_updated_at", "_enhanced_at"),
    "traffic_enhanced": uq("web_traffic_id") + nn("web_traffic_id", "site_domain", "traffic_year", "traffic_month")
    + av("traffic_month", MONTHS) + av("platform_preference", PLATFORM)
    + av("platform_engagement_leader", LEADER) + av("quality_tier", QUALITY) + nn("total_visits", "_enhanced_at"),
    "company_web_bridge": uq("company_web_bridge_id") + nn("company_web_bridge_id", "organization_id")
    + rel("organization_id", "organizations_enhanced", "organization_id") + nn("web_traffic_id")
    + rel("web_traffic_id", "traffic_enhanced", "web_traffic_id")
    + nn("organization_name", "organization_domain", "organization_country_code")
    + av("organization_country_code", COUNTRIES) + nn("is_investor") + av("is_investor", BOOLS)
    + nn("organization_created_at", "organization_updated_at", "traffic_domain", "traffic_year", "traffic_month")
    + av("traffic_month", MONTHS) + nn("total_visits") + rng("total_visits", 1)
    + rng("overall_quality_score", 0, 1, nullable=True) + av("quality_tier", QUALITY)
    + av("platform_preference", PLATFORM) + nn("match_confidence_score") + rng("match_confidence_score", 0, 1)
    + nn("match_method") + av("match_method", ("exact_domain_match",)) + nn("is_domain_match")
    + av("is_domain_match", (True,)) + nn("_bridged_at"),
    "mart_company_performance":
        _sum_check("platform_ratios_sum_reasonable", ["mobile_traffic_ratio", "desktop_traffic_ratio"])
        + _sum_check("age_shares_sum_reasonable", _AGES)
        + _sum_check("gender_shares_sum_reasonable", ["male_share", "female_share"])
        + uq("organization_id") + nn("organization_id", "organization_name", "organization_domain",
                                     "organization_country_code")
        + av("organization_country_code", COUNTRIES) + nn("is_investor") + av("is_investor", BOOLS)
        + nn("organization_created_at", "organization_updated_at", "site_domain", "period_start", "period_end",
             "months_available") + rng("months_available", 1)
        + nn("match_confidence_score") + rng("match_confidence_score", 0, 1)
        + unit("digital_performance_score") + av("performance_tier", QUALITY)
        + unit("mobile_traffic_ratio", "desktop_traffic_ratio") + av("platform_preference", PLATFORM)
        + av("platform_engagement_leader", LEADER) + nn("total_visits") + rng("total_visits", 1)
        + rng("total_pages_per_visit", 0, nullable=True) + rng("total_visit_duration_seconds", 0, nullable=True)
        + unit("total_bounce_rate", "desktop_bounce_rate", "mobile_bounce_rate", "desktop_direct_share",
               "desktop_organic_share", "desktop_paid_share", "desktop_referral_share", "desktop_social_share",
               "desktop_display_share", "desktop_email_share", *_AGES, "male_share", "female_share")
        + nn("primary_age_segment") + av("primary_age_segment", AGE)
        + nn("primary_gender_segment") + av("primary_gender_segment", GENDER) + nn("_mart_created_at"),
    "mart_company_timeseries":
        expr("first_month_before_last_month", "first_month <= last_month")
        + expr("available_months_within_span", "months_available <= months_span")
        + expr("peak_visits_is_maximum", "peak_visits >= greatest(first_month_visits, last_month_visits)",
               "peak_visits is not null and first_month_visits is not null and last_month_visits is not null")
        + uq("organization_id") + nn("organization_id", "organization_name", "organization_domain",
                                     "organization_country_code")
        + av("organization_country_code", COUNTRIES) + nn("is_investor") + av("is_investor", BOOLS)
        + nn("organization_created_at", "organization_updated_at", "site_domain", "match_confidence_score")
        + rng("match_confidence_score", 0, 1) + nn("first_month", "last_month", "months_available")
        + rng("months_available", 2) + nn("months_span") + rng("months_span", 1)
        + av("dominant_platform_preference", PLATFORM) + av("dominant_quality_tier", QUALITY)
        + unit("avg_quality_score") + nn("first_month_visits") + rng("first_month_visits", 0)
        + unit("first_month_quality", "first_month_bounce_rate") + nn("last_month_visits")
        + rng("last_month_visits", 0) + unit("last_month_quality", "last_month_bounce_rate")
        + nn("peak_visits") + rng("peak_visits", 0) + unit("peak_quality_score")
        + rng("visits_growth_rate", -1, nullable=True) + rng("visits_monthly_growth_rate", -1, nullable=True)
        + unit("current_vs_peak_visits_ratio", "current_vs_peak_quality_ratio")
        + nn("growth_category") + av("growth_category", GROWTH) + nn("quality_trend") + av("quality_trend", QTREND)
        + nn("ranking_trend") + av("ranking_trend", RTREND) + nn("performance_momentum")
        + av("performance_momentum", MOMENTUM) + rng("growth_health_score", 0, 100, nullable=True)
        + nn("_mart_created_at"),
    "mart_category_insights":
        expr("investor_count_logical", "investor_companies <= total_companies")
        + _sum_check("category_platform_ratios_sum_reasonable", ["category_mobile_ratio", "category_desktop_ratio"])
        + _sum_check("category_age_shares_sum_reasonable", _AGES, "category_")
        + _sum_check("category_gender_shares_sum_reasonable", ["male_share", "female_share"], "category_")
        + expr("largest_company_above_average", "largest_company_visits >= avg_company_visits",
               "largest_company_visits is not null and avg_company_visits is not null")
        + expr("average_above_smallest_company", "avg_company_visits >= smallest_company_visits",
               "avg_company_visits is not null and smallest_company_visits is not null")
        + nn("main_category", "total_companies") + rng("total_companies", 1) + nn("investor_companies")
        + rng("investor_companies", 0) + unit("investor_ratio") + nn("unique_cities") + rng("unique_cities", 1)
        + nn("unique_regions") + rng("unique_regions", 1) + nn("total_category_visits")
        + rng("total_category_visits", 1) + unit("category_mobile_ratio", "category_desktop_ratio")
        + av("dominant_platform_preference", PLATFORM) + unit("category_avg_quality_score")
        + av("dominant_quality_tier", QUALITY) + rng("traffic_concentration_cv", 0, nullable=True)
        + unit("top_company_traffic_share") + rng("companies_per_million_visits", 0, nullable=True)
        + nn("market_concentration_tier") + av("market_concentration_tier", CONCENTRATION)
        + nn("market_size_tier") + av("market_size_tier", SIZE)
        + nn("largest_company_visits") + rng("largest_company_visits", 1)
        + nn("smallest_company_visits") + rng("smallest_company_visits", 1)
        + nn("avg_company_visits") + rng("avg_company_visits", 1)
        + unit(*["category_" + a for a in _AGES], "category_male_share", "category_female_share")
        + nn("primary_age_segment") + av("primary_age_segment", AGE)
        + nn("primary_gender_segment") + av("primary_gender_segment", GENDER)
        + unit("category_direct_share", "category_organic_share", "category_paid_share",
               "category_referral_share", "category_social_share")
        + nn("_mart_created_at"),
}


def suite_counts() -> dict[str, int]:
    out: dict[str, int] = {}
    for checks in SUITE.values():
        for c in checks:
            out[c.kind] = out.get(c.kind, 0) + 1
    return out
