"""Raw input schemas and the output contract (column order) of every model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

S, L, I, D, B = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType()
TS = T.TimestampNTZType()

# Company directory (19 columns).
ORG_RAW = T.StructType([
    T.StructField("uuid", S, False),
    T.StructField("name", S, False),
    T.StructField("type", S), T.StructField("permalink", S), T.StructField("cb_url", S),
    T.StructField("roles", S), T.StructField("short_description", S), T.StructField("logo_url", S),
    T.StructField("domain", S), T.StructField("homepage_url", S), T.StructField("facebook_url", S),
    T.StructField("linkedin_url", S), T.StructField("twitter_url", S),
    T.StructField("city", S), T.StructField("region", S), T.StructField("state_code", S),
    T.StructField("country_code", S),
    T.StructField("created_at", TS), T.StructField("updated_at", TS),
])

_DEVICE_COUNTS = ["estimated_visits", "estimated_page_views", "estimated_unique"]
_DEVICE_RATES = ["pages_per_visit", "bounce_rate", "visits_duration"]
CHANNELS = ["direct", "mail", "referrals", "social", "organic_search", "paid_search", "display"]
AGE_BANDS = ["18_to_24", "25_to_34", "35_to_44", "45_to_54", "55_to_64", "65_plus"]

# Monthly site traffic (45 columns).
TRAFFIC_RAW = T.StructType(
    [T.StructField("clean_site", S), T.StructField("site", S, False),
     T.StructField("site_category", S), T.StructField("main_category", S),
     T.StructField("global_rank", L), T.StructField("country_rank", L),
     T.StructField("main_category_rank", L), T.StructField("category_rank", L)]
    + [T.StructField(f"{dev}_{c}", L) for dev in ("desktop", "mobileweb") for c in _DEVICE_COUNTS]
    + [T.StructField(f"{dev}_{c}", D) for dev in ("desktop", "mobileweb") for c in _DEVICE_RATES]
    + [T.StructField(c, L) for c in ("total_estimated_visits", "total_estimated_pageviews",
                                     "total_estimated_unique", "deduplicated_audience")]
    + [T.StructField(c, D) for c in ("total_pages_per_visit", "total_bounce_rate", "total_visits_duration")]
    + [T.StructField(f"desktop_{ch}_estimated_visits", L) for ch in CHANNELS]
    + [T.StructField("total_males_share", D), T.StructField("total_females_share", D)]
    + [T.StructField(f"total_ages_{a}_share", D) for a in AGE_BANDS]
    + [T.StructField("country", S), T.StructField("year", I, False), T.StructField("month", I, False)]
)


def _cols(text: str) -> list[str]:
    return [c.strip() for c in text.split(",") if c.strip()]


# Names and order of the output columns.
STG_ORGANIZATIONS = _cols("""
organization_id, organization_name, organization_permalink, organization_domain, organization_type,
organization_roles, organization_description, organization_city, organization_region,
organization_state_code, organization_country_code, organization_homepage_url, organization_cb_url,
organization_facebook_url, organization_linkedin_url, organization_twitter_url, organization_logo_url,
organization_created_at, organization_updated_at, _loaded_at""")

STG_TRAFFIC = _cols("""
web_traffic_id, site_domain, cleaned_site_domain, traffic_year, traffic_month, site_main_category,
site_category, site_country, site_global_rank, site_country_rank, site_main_category_rank,
site_category_rank, desktop_visits, desktop_unique_visitors, desktop_page_views, desktop_pages_per_visit,
desktop_visit_duration_seconds, desktop_bounce_rate, desktop_direct_visits, desktop_organic_search_visits,
desktop_paid_search_visits, desktop_referral_visits, desktop_social_visits, desktop_display_visits,
desktop_email_visits, mobile_visits, mobile_unique_visitors, mobile_page_views, mobile_pages_per_visit,
mobile_visit_duration_seconds, mobile_bounce_rate, total_visits, total_unique_visitors, total_page_views,
total_pages_per_visit, total_visit_duration_seconds, total_bounce_rate, deduplicated_audience,
age_18_24_share, age_25_34_share, age_35_44_share, age_45_54_share, age_55_64_share, age_65_plus_share,
male_share, female_share, _loaded_at""")

ORGANIZATIONS_ENHANCED = _cols("""
organization_id, organization_name, organization_permalink, organization_type, organization_description,
organization_city, standardized_city, organization_region, standardized_region, organization_state_code,
organization_country_code, organization_domain, standardized_domain, root_domain, organization_roles,
is_investor, organization_homepage_url, organization_cb_url, organization_facebook_url,
organization_linkedin_url, organization_twitter_url, organization_logo_url, organization_created_at,
organization_updated_at, _enhanced_at""")

TRAFFIC_ENHANCED = _cols("""
web_traffic_id, site_domain, cleaned_site_domain, standardized_domain, root_domain, traffic_year,
traffic_month, site_main_category, site_category, site_country, site_global_rank, site_country_rank,
site_main_category_rank, site_category_rank, mobile_traffic_ratio, desktop_traffic_ratio,
platform_preference, platform_engagement_leader, overall_quality_score, quality_tier, bounce_quality_score,
pages_quality_score, duration_quality_score, uniqueness_quality_score, desktop_visits,
desktop_unique_visitors, desktop_page_views, desktop_pages_per_visit, desktop_visit_duration_seconds,
desktop_bounce_rate, desktop_direct_visits, desktop_organic_search_visits, desktop_paid_search_visits,
desktop_referral_visits, desktop_social_visits, desktop_display_visits, desktop_email_visits,
mobile_visits, mobile_unique_visitors, mobile_page_views, mobile_pages_per_visit,
mobile_visit_duration_seconds, mobile_bounce_rate, total_visits, total_unique_visitors, total_page_views,
total_pages_per_visit, total_visit_duration_seconds, total_bounce_rate, deduplicated_audience,
age_18_24_share, age_25_34_share, age_35_44_share, age_45_54_share, age_55_64_share, age_65_plus_share,
male_share, female_share, _enhanced_at""")

COMPANY_WEB_BRIDGE = _cols("""
company_web_bridge_id, organization_id, web_traffic_id, organization_name, organization_permalink,
organization_domain, standardized_city, standardized_region, organization_country_code, is_investor,
organization_created_at, organization_updated_at, traffic_domain, traffic_year, traffic_month,
site_main_category, site_category, traffic_country, site_global_rank, total_visits, total_unique_visitors,
overall_quality_score, quality_tier, platform_preference, match_confidence_score, match_method,
is_domain_match, _bridged_at""")

MART_COMPANY = _cols("""
organization_id, organization_name, organization_permalink, organization_domain, standardized_city,
standardized_region, organization_country_code, is_investor, organization_created_at,
organization_updated_at, site_domain, period_start, period_end, months_available, industry_category,
industry_subcategory, traffic_country, match_confidence_score, site_global_rank, site_country_rank,
site_main_category_rank, site_category_rank, digital_performance_score, performance_tier,
mobile_traffic_ratio, desktop_traffic_ratio, platform_preference, platform_engagement_leader,
total_visits, total_unique_visitors, total_page_views, desktop_visits, mobile_visits,
total_pages_per_visit, total_visit_duration_seconds, total_bounce_rate, desktop_bounce_rate,
mobile_bounce_rate, desktop_direct_share, desktop_organic_share, desktop_paid_share,
desktop_referral_share, desktop_social_share, desktop_display_share, desktop_email_share,
desktop_direct_visits, desktop_organic_search_visits, desktop_paid_search_visits, desktop_referral_visits,
desktop_social_visits, desktop_display_visits, desktop_email_visits, age_18_24_share, age_25_34_share,
age_35_44_share, age_45_54_share, age_55_64_share, age_65_plus_share, male_share, female_share,
primary_age_segment, primary_gender_segment, _mart_created_at""")

MART_TIMESERIES = _cols("""
organization_id, organization_name, organization_permalink, organization_domain, standardized_city,
standardized_region, organization_country_code, is_investor, organization_created_at,
organization_updated_at, site_domain, industry_category, industry_subcategory, traffic_country,
match_confidence_score, first_month, last_month, months_available, months_span,
dominant_platform_preference, dominant_quality_tier, avg_visits, avg_quality_score, first_month_visits,
first_month_quality, first_month_global_rank, first_month_country_rank, first_month_unique_visitors,
first_month_bounce_rate, last_month_visits, last_month_quality, last_month_global_rank,
last_month_country_rank, last_month_unique_visitors, last_month_bounce_rate, peak_visits,
best_global_rank, peak_quality_score, visits_growth_rate, visits_monthly_growth_rate,
visits_absolute_change, quality_score_change, quality_score_change_rate, global_rank_change,
country_rank_change, current_vs_peak_visits_ratio, current_vs_peak_quality_ratio, growth_category,
quality_trend, ranking_trend, performance_momentum, growth_health_score, _mart_created_at""")

MART_CATEGORY = _cols("""
main_category, total_companies, investor_companies, investor_ratio, unique_cities, unique_regions,
dominant_region, dominant_city, total_category_visits, total_category_unique_visitors,
total_category_page_views, total_desktop_visits, total_mobile_visits, category_mobile_ratio,
category_desktop_ratio, dominant_platform_preference, category_avg_quality_score, dominant_quality_tier,
traffic_concentration_cv, top_company_traffic_share, companies_per_million_visits,
market_concentration_tier, market_size_tier, largest_company_visits, smallest_company_visits,
avg_company_visits, category_age_18_24_share, category_age_25_34_share, category_age_35_44_share,
category_age_45_54_share, category_age_55_64_share, category_age_65_plus_share, category_male_share,
category_female_share, primary_age_segment, primary_gender_segment, category_direct_share,
category_organic_share, category_paid_share, category_referral_share, category_social_share,
_mart_created_at""")

AUDIT_COLUMNS = ("_loaded_at", "_enhanced_at", "_bridged_at", "_mart_created_at")


# A column has one type in every model; those not listed are strings.
LONG_COLUMNS = _cols("""
site_global_rank, site_country_rank, site_main_category_rank, site_category_rank, desktop_visits,
desktop_unique_visitors, desktop_page_views, desktop_direct_visits, desktop_organic_search_visits,
desktop_paid_search_visits, desktop_referral_visits, desktop_social_visits, desktop_display_visits,
desktop_email_visits, mobile_visits, mobile_unique_visitors, mobile_page_views, total_visits,
total_unique_visitors, total_page_views, deduplicated_audience, months_available, months_span,
first_month_visits, first_month_global_rank, first_month_country_rank, first_month_unique_visitors,
last_month_visits, last_month_global_rank, last_month_country_rank, last_month_unique_visitors,
peak_visits, best_global_rank, visits_absolute_change, global_rank_change, country_rank_change,
total_companies, investor_companies, unique_cities, unique_regions, total_category_visits,
total_category_unique_visitors, total_category_page_views, total_desktop_visits, total_mobile_visits,
largest_company_visits, smallest_company_visits""")
DOUBLE_COLUMNS = _cols("""
desktop_pages_per_visit, desktop_visit_duration_seconds, desktop_bounce_rate, mobile_pages_per_visit,
mobile_visit_duration_seconds, mobile_bounce_rate, total_pages_per_visit, total_visit_duration_seconds,
total_bounce_rate, age_18_24_share, age_25_34_share, age_35_44_share, age_45_54_share, age_55_64_share,
age_65_plus_share, male_share, female_share, mobile_traffic_ratio, desktop_traffic_ratio,
overall_quality_score, bounce_quality_score, pages_quality_score, duration_quality_score,
uniqueness_quality_score, match_confidence_score, digital_performance_score, desktop_direct_share,
desktop_organic_share, desktop_paid_share, desktop_referral_share, desktop_social_share,
desktop_display_share, desktop_email_share, avg_visits, avg_quality_score, first_month_quality,
first_month_bounce_rate, last_month_quality, last_month_bounce_rate, peak_quality_score,
visits_growth_rate, visits_monthly_growth_rate, quality_score_change, quality_score_change_rate,
current_vs_peak_visits_ratio, current_vs_peak_quality_ratio, growth_health_score, investor_ratio,
category_mobile_ratio, category_desktop_ratio, category_avg_quality_score, traffic_concentration_cv,
top_company_traffic_share, companies_per_million_visits, avg_company_visits, category_age_18_24_share,
category_age_25_34_share, category_age_35_44_share, category_age_45_54_share, category_age_55_64_share,
category_age_65_plus_share, category_male_share, category_female_share, category_direct_share,
category_organic_share, category_paid_share, category_referral_share, category_social_share""")
OTHER_TYPES = {"traffic_year": I, "traffic_month": I, "is_investor": B, "is_domain_match": B,
               "organization_created_at": TS, "organization_updated_at": TS,
               **{c: T.TimestampType() for c in AUDIT_COLUMNS}}


def column_type(name: str) -> T.DataType:
    if name in OTHER_TYPES:
        return OTHER_TYPES[name]
    return L if name in LONG_COLUMNS else D if name in DOUBLE_COLUMNS else S


def typed(contract: list[str]) -> T.StructType:
    """A contract as a schema: names, order and types."""
    return T.StructType([T.StructField(c, column_type(c)) for c in contract])


class SchemaDriftError(ValueError):
    """Raised when a batch does not have the columns of its target."""


def enforce(df: DataFrame, contract: list[str]) -> DataFrame:
    """Project ``df`` onto ``contract`` (exact column order); raise on missing
    columns and on columns of another type."""
    missing = [c for c in contract if c not in df.columns]
    if missing:
        raise SchemaDriftError(f"missing columns: {missing}")
    out = df.select(*contract)
    wrong = [f"{f.name}: {f.dataType.simpleString()} instead of {column_type(f.name).simpleString()}"
             for f in out.schema.fields if f.dataType != column_type(f.name)]
    if wrong:
        raise SchemaDriftError(f"columns of another type: {wrong}")
    return out


def check_same_schema(batch: DataFrame, target: DataFrame) -> None:
    """``on_schema_change='fail'``: the same column names with the same types
    (order aside: a month-partitioned table lists its partition columns last)."""
    a = {f.name: f.dataType.simpleString() for f in batch.schema.fields}
    b = {f.name: f.dataType.simpleString() for f in target.schema.fields}
    if a != b:
        diff = sorted(set(a.items()) ^ set(b.items()))
        raise SchemaDriftError(f"schema of batch differs from target: {diff}")


def without_audit(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in AUDIT_COLUMNS if c in df.columns])
