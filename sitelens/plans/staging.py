"""Staging models: rename raw columns, add keys, drop rows without a key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelens.functions.keys import surrogate_key
from sitelens.schemas import STG_ORGANIZATIONS, STG_TRAFFIC, enforce

# Raw column -> staged column.
ORG_RENAMES = {
    "uuid": "organization_id", "name": "organization_name", "permalink": "organization_permalink",
    "domain": "organization_domain", "type": "organization_type", "roles": "organization_roles",
    "short_description": "organization_description", "city": "organization_city",
    "region": "organization_region", "state_code": "organization_state_code",
    "country_code": "organization_country_code", "homepage_url": "organization_homepage_url",
    "cb_url": "organization_cb_url", "facebook_url": "organization_facebook_url",
    "linkedin_url": "organization_linkedin_url", "twitter_url": "organization_twitter_url",
    "logo_url": "organization_logo_url", "created_at": "organization_created_at",
    "updated_at": "organization_updated_at",
}

TRAFFIC_RENAMES = {
    "site": "site_domain", "year": "traffic_year", "month": "traffic_month",
    "main_category": "site_main_category", "site_category": "site_category",
    "clean_site": "cleaned_site_domain", "category_rank": "site_category_rank",
    "global_rank": "site_global_rank", "country_rank": "site_country_rank",
    "main_category_rank": "site_main_category_rank", "country": "site_country",
    "desktop_estimated_visits": "desktop_visits", "desktop_estimated_unique": "desktop_unique_visitors",
    "desktop_estimated_page_views": "desktop_page_views", "desktop_pages_per_visit": "desktop_pages_per_visit",
    "desktop_visits_duration": "desktop_visit_duration_seconds", "desktop_bounce_rate": "desktop_bounce_rate",
    "desktop_direct_estimated_visits": "desktop_direct_visits",
    "desktop_organic_search_estimated_visits": "desktop_organic_search_visits",
    "desktop_paid_search_estimated_visits": "desktop_paid_search_visits",
    "desktop_referrals_estimated_visits": "desktop_referral_visits",
    "desktop_social_estimated_visits": "desktop_social_visits",
    "desktop_display_estimated_visits": "desktop_display_visits",
    "desktop_mail_estimated_visits": "desktop_email_visits",
    "mobileweb_estimated_visits": "mobile_visits", "mobileweb_estimated_unique": "mobile_unique_visitors",
    "mobileweb_estimated_page_views": "mobile_page_views", "mobileweb_pages_per_visit": "mobile_pages_per_visit",
    "mobileweb_visits_duration": "mobile_visit_duration_seconds", "mobileweb_bounce_rate": "mobile_bounce_rate",
    "total_estimated_visits": "total_visits", "total_estimated_unique": "total_unique_visitors",
    "total_estimated_pageviews": "total_page_views", "total_pages_per_visit": "total_pages_per_visit",
    "total_visits_duration": "total_visit_duration_seconds", "total_bounce_rate": "total_bounce_rate",
    "deduplicated_audience": "deduplicated_audience",
    "total_ages_18_to_24_share": "age_18_24_share", "total_ages_25_to_34_share": "age_25_34_share",
    "total_ages_35_to_44_share": "age_35_44_share", "total_ages_45_to_54_share": "age_45_54_share",
    "total_ages_55_to_64_share": "age_55_64_share", "total_ages_65_plus_share": "age_65_plus_share",
    "total_males_share": "male_share", "total_females_share": "female_share",
}


def stg_organizations(raw: DataFrame) -> DataFrame:
    renamed = raw.select(*[F.col(src).alias(dst) for src, dst in ORG_RENAMES.items()])
    return enforce(renamed.filter(F.col("organization_id").isNotNull())
                   .withColumn("_loaded_at", F.current_timestamp()), STG_ORGANIZATIONS)


def stg_traffic(raw: DataFrame) -> DataFrame:
    renamed = raw.select(surrogate_key("site", "year", "month").alias("web_traffic_id"),
                         *[F.col(src).alias(dst) for src, dst in TRAFFIC_RENAMES.items()])
    kept = renamed.filter(F.col("site_domain").isNotNull() & F.col("traffic_year").isNotNull()
                          & F.col("traffic_month").isNotNull())
    return enforce(kept.withColumn("_loaded_at", F.current_timestamp()), STG_TRAFFIC)
