"""Named queries (Spark) and their oracle SQL texts (DuckDB).

``QUERIES[name](spark, sf_dir)`` returns a DataFrame over the whole test
tables; ``ORACLE[name]()`` returns the equivalent SQL text.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from sitelens import oracle
from sitelens.functions.domains import root_domain, standardize_domain
from sitelens.functions.geo import CITY_VARIANTS, REGION_VARIANTS
from sitelens.functions.metrics import safe_div, tier
from sitelens.functions.periods import months_span, period_label, yyyymm
from sitelens.operators.aggregates import first_by, last_by
from sitelens.operators.domain_match import MATCH_KEY, match_key
from sitelens.operators.lookup import canonical_by_table, without_listed
from sitelens.operators.quality import ROW_KINDS, WatchedChecks, run_suite
from sitelens.operators.skew import write_by_key
from sitelens.operators.tables import remove_table
from sitelens.operators.upsert import newer_than, upsert
from sitelens.plans.bridge import bridge_by_key, company_web_bridge, matchable_organizations, matchable_traffic, matched_by_key
from sitelens.plans.checks import SUITE
from sitelens.plans.company import company_performance_by_domain
from sitelens.plans.organizations import organizations_enhanced
from sitelens.plans.pipeline import models_for
from sitelens.plans.state import company_performance_from_state, company_timeseries_from_state, update_state
from sitelens.plans.timeseries import GROWTH_TIERS
from sitelens.plans.traffic import enhance_traffic, traffic_enhanced
from sitelens.schemas import AUDIT_COLUMNS, ORG_RAW, TRAFFIC_RAW
from sitelens.session import shared_table_path, write_table
from sitelens.sources.adapter import load_sources, read_table
from sitelens.streaming.incremental import load_increment

ROUND_BITS = oracle.ROUND_BITS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, Callable[[], str]] = {}


def round_double(c) -> F.Column:
    """Snap to a grid of ``2**-ROUND_BITS`` (~1e-6): ``round(x * 2^b) / 2^b``.

    Scaling by a power of two is exact, so both engines round the same
    binary value; a grid boundary is a dyadic rational that ratios of the
    test data practically never hit, unlike decimal boundaries such as
    0.4909375. The oracle applies the same arithmetic."""
    scale = float(2 ** ROUND_BITS)
    return F.round(c * F.lit(scale), 0) / F.lit(scale) + F.lit(0.0)  # + 0.0 turns -0.0 into 0.0


def comparable(df: DataFrame) -> DataFrame:
    """Drop audit timestamps and round DOUBLE columns for order-independent comparison."""
    out = df.drop(*[c for c in AUDIT_COLUMNS if c in df.columns])
    return out.select(*[round_double(F.col(f.name)).alias(f.name)
                        if isinstance(f.dataType, DoubleType) else F.col(f.name)
                        for f in out.schema.fields])


def register(name: str, sql: Callable[[], str] | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ------------------------------------------------------------ whole models
def _model(attr: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return getattr(models_for(spark, sf_dir), attr)
    return run


for _name, (_cte, _cols) in oracle.MODEL_CTES.items():
    register(_name, (lambda c, cols: (lambda: oracle.model_query(c, cols)))(_cte, _cols))(_model(_name))


# Sites with a row for each of several countries in a month: ``web_traffic_id`` is
# not unique, and the join back of bridge and traffic multiplies.
def _country_model(attr: str, columns: list[str] | None = None):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        found = getattr(models_for(spark, sf_dir, by_country=True), attr)
        return found if columns is None else found.select(*columns)
    return run


_COUNTRY_ROWS = ["organization_id", "web_traffic_id", "site_country", "traffic_year", "traffic_month", "total_visits",
                 "site_country_rank", "overall_quality_score", "match_confidence_score"]
for _name, _attr in (("several_countries_bridge", "company_web_bridge"), ("several_countries_company", "mart_company_performance"),
                     ("several_countries_timeseries", "mart_company_timeseries"), ("several_countries_category", "mart_category_insights")):
    _cte, _cols = oracle.MODEL_CTES[_attr]
    register(_name, (lambda c, cols: (lambda: oracle.model_query(c, cols, by_country=True)))(_cte, _cols))(_country_model(_attr))
register("several_countries_rows", lambda: oracle.model_query("ct", _COUNTRY_ROWS, by_country=True))(
    _country_model("company_traffic", _COUNTRY_ROWS))


# ------------------------------------------------------- column-level keys
_ORG_ATTRS = ["organization_name", "organization_permalink", "organization_domain", "standardized_city",
              "standardized_region", "organization_country_code", "is_investor", "organization_created_at",
              "organization_updated_at"]
_AGES = ["age_18_24_share", "age_25_34_share", "age_35_44_share", "age_45_54_share", "age_55_64_share",
         "age_65_plus_share"]
_CHANNEL_VISITS = ["desktop_direct_visits", "desktop_organic_search_visits", "desktop_paid_search_visits",
                   "desktop_referral_visits", "desktop_social_visits", "desktop_display_visits",
                   "desktop_email_visits"]
_BOUNDS = ["visits", "quality", "global_rank", "country_rank", "unique_visitors", "bounce_rate"]

# name -> (model, columns); the key column of the model comes first.
PROJECTIONS: dict[str, tuple[str, list[str]]] = {
    # filters / flags / normalizers on companies
    "nordic_filter": ("organizations_enhanced", ["organization_id", "organization_country_code"]),
    "investor_flag": ("organizations_enhanced", ["organization_id", "organization_roles", "is_investor"]),
    "canonical_city": ("organizations_enhanced", ["organization_id", "organization_city", "standardized_city"]),
    "canonical_region": ("organizations_enhanced", ["organization_id", "organization_region",
                                                    "standardized_region"]),
    "organization_domains": ("organizations_enhanced", ["organization_id", "organization_domain",
                                                        "standardized_domain", "root_domain"]),
    # traffic rows
    "traffic_positive": ("traffic_enhanced", ["web_traffic_id", "traffic_year", "traffic_month", "total_visits"]),
    "surrogate_key": ("stg_traffic", ["web_traffic_id", "site_domain", "traffic_year", "traffic_month"]),
    "traffic_domains": ("traffic_enhanced", ["web_traffic_id", "site_domain", "standardized_domain",
                                             "root_domain"]),
    "platform_ratios": ("traffic_enhanced", ["web_traffic_id", "mobile_traffic_ratio", "desktop_traffic_ratio"]),
    "platform_preference": ("traffic_enhanced", ["web_traffic_id", "mobile_visits", "desktop_visits",
                                                 "platform_preference"]),
    "engagement_leader": ("traffic_enhanced", ["web_traffic_id", "mobile_bounce_rate", "desktop_bounce_rate",
                                               "platform_engagement_leader"]),
    "quality_components": ("traffic_enhanced", ["web_traffic_id", "bounce_quality_score", "pages_quality_score",
                                                "duration_quality_score", "uniqueness_quality_score"]),
    "overall_quality": ("traffic_enhanced", ["web_traffic_id", "overall_quality_score"]),
    "quality_tier": ("traffic_enhanced", ["web_traffic_id", "overall_quality_score", "quality_tier"]),
    # bridge
    "domain_match": ("company_web_bridge", ["organization_id", "web_traffic_id", "organization_domain",
                                            "traffic_domain"]),
    "bridge_key": ("company_web_bridge", ["company_web_bridge_id", "organization_id", "web_traffic_id"]),
    "match_confidence": ("company_web_bridge", ["company_web_bridge_id", "match_confidence_score",
                                                "match_method", "is_domain_match"]),
    # company mart
    "company_dimensions": ("mart_company_performance", ["organization_id", *_ORG_ATTRS, "site_domain",
                                                        "industry_category", "industry_subcategory",
                                                        "traffic_country", "match_confidence_score"]),
    "company_volumes": ("mart_company_performance", ["organization_id", "total_visits", "total_unique_visitors",
                                                     "total_page_views", "desktop_visits", "mobile_visits"]),
    "company_engagement": ("mart_company_performance", [
        "organization_id", "digital_performance_score", "mobile_traffic_ratio", "desktop_traffic_ratio",
        "total_pages_per_visit", "total_visit_duration_seconds", "total_bounce_rate", "desktop_bounce_rate",
        "mobile_bounce_rate"]),
    "company_demographics": ("mart_company_performance", ["organization_id", *_AGES, "male_share",
                                                          "female_share"]),
    "company_best_ranks": ("mart_company_performance", ["organization_id", "site_global_rank",
                                                        "site_country_rank", "site_main_category_rank",
                                                        "site_category_rank"]),
    "company_period": ("mart_company_performance", ["organization_id", "period_start", "period_end",
                                                    "months_available"]),
    "dominant_value": ("mart_company_performance", ["organization_id", "performance_tier", "platform_preference",
                                                    "platform_engagement_leader"]),
    "channel_shares": ("mart_company_performance", [
        "organization_id", "desktop_visits", "desktop_direct_share", "desktop_organic_share",
        "desktop_paid_share", "desktop_referral_share", "desktop_social_share", "desktop_display_share",
        "desktop_email_share", *_CHANNEL_VISITS]),
    "primary_age_segment": ("mart_company_performance", ["organization_id", *_AGES, "primary_age_segment"]),
    "primary_gender_segment": ("mart_company_performance", ["organization_id", "male_share", "female_share",
                                                            "primary_gender_segment"]),
    # time-series mart
    "timeseries_boundaries": ("mart_company_timeseries", [
        "organization_id", *_ORG_ATTRS, "first_month", "last_month", "months_available",
        "dominant_platform_preference", "dominant_quality_tier", "avg_visits", "avg_quality_score"]),
    "first_last_month": ("mart_company_timeseries", ["organization_id", *[f"first_month_{b}" for b in _BOUNDS],
                                                     *[f"last_month_{b}" for b in _BOUNDS]]),
    "peak_metrics": ("mart_company_timeseries", ["organization_id", "peak_visits", "best_global_rank",
                                                 "peak_quality_score"]),
    "months_span": ("mart_company_timeseries", ["organization_id", "first_month", "last_month", "months_span"]),
    "growth_rates": ("mart_company_timeseries", ["organization_id", "visits_growth_rate",
                                                 "visits_monthly_growth_rate", "visits_absolute_change"]),
    "quality_change": ("mart_company_timeseries", ["organization_id", "quality_score_change",
                                                   "quality_score_change_rate"]),
    "rank_change": ("mart_company_timeseries", ["organization_id", "global_rank_change", "country_rank_change"]),
    "peak_ratios": ("mart_company_timeseries", ["organization_id", "current_vs_peak_visits_ratio",
                                                "current_vs_peak_quality_ratio"]),
    "growth_category": ("mart_company_timeseries", ["organization_id", "visits_growth_rate", "growth_category"]),
    "quality_trend": ("mart_company_timeseries", ["organization_id", "quality_score_change", "quality_trend"]),
    "ranking_trend": ("mart_company_timeseries", ["organization_id", "global_rank_change", "ranking_trend"]),
    "performance_momentum": ("mart_company_timeseries", ["organization_id", "current_vs_peak_visits_ratio",
                                                         "performance_momentum"]),
    "growth_health": ("mart_company_timeseries", ["organization_id", "visits_growth_rate", "quality_score_change",
                                                  "growth_health_score"]),
    # category mart
    "category_volumes": ("mart_category_insights", [
        "main_category", "total_category_visits", "total_category_unique_visitors", "total_category_page_views",
        "total_desktop_visits", "total_mobile_visits"]),
    "category_composition": ("mart_category_insights", [
        "main_category", "total_companies", "investor_companies", "investor_ratio", "unique_cities",
        "unique_regions", "dominant_region", "dominant_city"]),
    "category_ratios": ("mart_category_insights", ["main_category", "category_mobile_ratio",
                                                   "category_desktop_ratio", "dominant_platform_preference"]),
    "category_channel_mix": ("mart_category_insights", [
        "main_category", "category_direct_share", "category_organic_share", "category_paid_share",
        "category_referral_share", "category_social_share"]),
    "category_weighted_quality": ("mart_category_insights", ["main_category", "category_avg_quality_score",
                                                             "dominant_quality_tier"]),
    "category_weighted_demographics": ("mart_category_insights", [
        "main_category", *[f"category_{a}" for a in _AGES], "category_male_share", "category_female_share",
        "primary_age_segment", "primary_gender_segment"]),
    "category_extremes": ("mart_category_insights", ["main_category", "largest_company_visits",
                                                     "smallest_company_visits", "avg_company_visits"]),
    "category_concentration": ("mart_category_insights", [
        "main_category", "traffic_concentration_cv", "top_company_traffic_share", "companies_per_million_visits"]),
    "market_tiers": ("mart_category_insights", ["main_category", "top_company_traffic_share", "total_companies",
                                                "market_concentration_tier", "market_size_tier"]),
}


def _projection(model: str, cols: list[str]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return getattr(models_for(spark, sf_dir), model).select(*cols)
    return run


for _name, (_model_name, _cols) in PROJECTIONS.items():
    _cte = oracle.MODEL_CTES[_model_name][0]
    register(_name, (lambda c, cols: (lambda: oracle.model_query(c, cols)))(_cte, _cols))(
        _projection(_model_name, _cols))


# ---------------------------------------------------------- other keys


def _sql(body: str) -> Callable[[], str]:
    return lambda: oracle.pipeline_sql() + body


@register("scan_organizations", _sql(oracle.final_select("raw_orgs", [f.name for f in ORG_RAW.fields])))
def scan_organizations(spark, sf_dir):
    return load_sources(spark, sf_dir)[0]


@register("scan_traffic", _sql(oracle.final_select("raw_traffic", [f.name for f in TRAFFIC_RAW.fields])))
def scan_traffic(spark, sf_dir):
    return load_sources(spark, sf_dir)[1]


@register("standardize_domain", lambda: (
    f"SELECT page_id, url, {oracle.std_domain('url')} AS standardized_domain FROM pages"))
def q_standardize_domain(spark, sf_dir):
    return read_table(spark, sf_dir, "pages").select(
        "page_id", "url", standardize_domain("url").alias("standardized_domain"))


@register("root_domain", lambda: f"SELECT page_id, url, {oracle.root_dom('url')} AS root_domain FROM pages")
def q_root_domain(spark, sf_dir):
    return read_table(spark, sf_dir, "pages").select("page_id", "url", root_domain("url").alias("root_domain"))


@register("period_key", lambda: (
    "SELECT o_orderkey, CAST(year(o_orderdate) AS VARCHAR) || '-' || "
    "lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0') AS period, "
    "CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS yyyymm FROM orders"))
def q_period_key(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    y, m = F.year("o_orderdate"), F.month("o_orderdate")
    return o.select("o_orderkey", period_label(y, m).alias("period"), yyyymm(y, m).cast("int").alias("yyyymm"))


def _customer_growth_sql() -> str:
    return f"""
WITH cm AS (
  SELECT o_custkey, CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS ym,
         sum(o_totalprice) AS month_total, count(*) AS month_orders
  FROM orders GROUP BY 1, 2),
cg AS (
  SELECT o_custkey, min(ym) AS ym_first, max(ym) AS ym_last, count(*) AS months_available,
         first(month_total ORDER BY ym) AS first_month_total, first(month_total ORDER BY ym DESC) AS last_month_total,
         max(month_total) AS peak_month_total, CAST(sum(month_orders) AS BIGINT) AS orders
  FROM cm GROUP BY o_custkey),
cr AS (
  SELECT *, CAST((ym_last // 100 - ym_first // 100) * 12 + (ym_last % 100 - ym_first % 100) + 1 AS BIGINT) AS months_span,
         CASE WHEN first_month_total > 0 THEN (last_month_total - first_month_total) / first_month_total END AS growth_rate
  FROM cg)
SELECT o_custkey, ym_first AS first_month, ym_last AS last_month, months_available, months_span, orders,
       round(first_month_total * 1048576) / 1048576 + 0.0 AS first_month_total,
       round(last_month_total * 1048576) / 1048576 + 0.0 AS last_month_total,
       round(peak_month_total * 1048576) / 1048576 + 0.0 AS peak_month_total,
       round(growth_rate * 1048576) / 1048576 + 0.0 AS growth_rate,
       {oracle.sql_tier('growth_rate', oracle.GROWTH_TIERS, 'Significant Decline', null_label='Insufficient Data')} AS growth_category
FROM cr"""


@register("customer_growth", _customer_growth_sql)
def q_customer_growth(spark, sf_dir):
    """First/last month, span and growth reused on another table: monthly order
    totals per customer (one aggregate per level, both map-side combined)."""
    o = read_table(spark, sf_dir, "orders")
    ym = yyyymm(F.year("o_orderdate"), F.month("o_orderdate")).cast("int")
    monthly = o.groupBy("o_custkey", ym.alias("ym")).agg(
        F.sum("o_totalprice").alias("month_total"), F.count(F.lit(1)).alias("month_orders"))
    g = monthly.groupBy("o_custkey").agg(
        F.min("ym").alias("first_month"), F.max("ym").alias("last_month"),
        F.count(F.lit(1)).alias("months_available"),
        first_by("month_total", F.col("ym")).alias("first_month_total"),
        last_by("month_total", F.col("ym")).alias("last_month_total"),
        F.max("month_total").alias("peak_month_total"), F.sum("month_orders").alias("orders"))
    f, last = F.col("first_month_total"), F.col("last_month_total")
    g = g.withColumns({
        "months_span": months_span("first_month", "last_month"),
        "growth_rate": F.when(f > 0, safe_div(last - f, f)),
    })
    return g.withColumn("growth_category", tier("growth_rate", GROWTH_TIERS, "Significant Decline",
                                                null_label="Insufficient Data")).select(
        "o_custkey", "first_month", "last_month", "months_available", "months_span", "orders",
        "first_month_total", "last_month_total", "peak_month_total", "growth_rate", "growth_category")


@register("org_matchable_domains", _sql(oracle.final_select("m_orgs", ["organization_id", "standardized_domain"])))
def q_org_matchable(spark, sf_dir):
    return matchable_organizations(models_for(spark, sf_dir).organizations_enhanced).select(
        "organization_id", "standardized_domain")


@register("domain_match_fanout", _sql(
    "SELECT lower(trim(organization_domain)) AS match_domain, count(DISTINCT organization_id) AS organizations, "
    "count(DISTINCT web_traffic_id) AS traffic_rows, count(*) AS bridge_rows FROM bridge GROUP BY 1"))
def q_fanout(spark, sf_dir):
    """Companies, traffic rows and bridge rows per match domain, from one count
    per side (bridge rows = companies x traffic rows; no pairs are formed)."""
    m = models_for(spark, sf_dir)
    orgs = m.keyed_organizations.groupBy(MATCH_KEY).agg(F.count(F.lit(1)).alias("organizations"))
    rows = m.matched_traffic.groupBy(MATCH_KEY).agg(F.count(F.lit(1)).alias("traffic_rows"))
    return orgs.join(rows, MATCH_KEY, "inner").select(
        F.col(MATCH_KEY).alias("match_domain"), "organizations", "traffic_rows",
        (F.col("organizations") * F.col("traffic_rows")).alias("bridge_rows"))


# The domain match beyond the broadcast budget: hot domains dealt to several tasks,
# and traffic stored in buckets of the match key, which is not exchanged.
_MATCH_COLS = PROJECTIONS["domain_match"][1]


@register("domain_match_salted", lambda: oracle.model_query("bridge", _MATCH_COLS))
def q_domain_match_salted(spark, sf_dir):
    m = models_for(spark, sf_dir)
    return company_web_bridge(m.organizations_enhanced, m.traffic_enhanced, broadcast_budget=0).select(*_MATCH_COLS)


def _stored_by_key(spark, sf_dir):
    m = models_for(spark, sf_dir)
    keyed = matchable_traffic(m.traffic_enhanced).withColumn(MATCH_KEY, match_key("cleaned_site_domain"))
    return m, write_by_key(keyed, MATCH_KEY, int(spark.conf.get("spark.sql.shuffle.partitions")))


@register("domain_match_bucketed", lambda: oracle.model_query("bridge", _MATCH_COLS))
def q_domain_match_bucketed(spark, sf_dir):
    m, stored = _stored_by_key(spark, sf_dir)
    return bridge_by_key(m.organizations_enhanced, stored).select(*_MATCH_COLS)


@register("company_mart_bucketed", lambda: oracle.model_query("mart_company", oracle.MODEL_CTES["mart_company_performance"][1]))
def q_company_mart_bucketed(spark, sf_dir):
    m, stored = _stored_by_key(spark, sf_dir)
    return company_performance_by_domain(m.keyed_organizations, matched_by_key(m.keyed_organizations, stored, 0))


_CT_COLS = ["organization_id", "web_traffic_id", "site_domain", "traffic_year", "traffic_month", "total_visits",
            "overall_quality_score", "desktop_direct_visits", "age_18_24_share"]


@register("company_traffic_full", _sql(oracle.final_select("ct", _CT_COLS)))
def q_company_traffic(spark, sf_dir):
    return models_for(spark, sf_dir).company_traffic.select(*_CT_COLS)


_CCT_COLS = ["site_main_category", "organization_id", "web_traffic_id", "standardized_city",
             "standardized_region", "is_investor", "total_visits"]


@register("category_company_traffic", _sql(oracle.final_select("cct", _CCT_COLS)))
def q_category_company_traffic(spark, sf_dir):
    return models_for(spark, sf_dir).company_traffic.select(*_CCT_COLS)


_NULL_GROUP = ["main_category", "total_companies", "traffic_concentration_cv", "top_company_traffic_share",
               "companies_per_million_visits", "market_concentration_tier"]


@register("category_null_group", _sql(oracle.final_select("mart_category", _NULL_GROUP, "main_category IS NULL")))
def q_null_group(spark, sf_dir):
    return models_for(spark, sf_dir).mart_category_insights.filter(F.col("main_category").isNull()).select(
        *_NULL_GROUP)


@register("timeseries_min_periods", _sql(
    "SELECT organization_id, count(DISTINCT ym) AS months_available FROM ct GROUP BY organization_id "
    "HAVING count(DISTINCT ym) >= 2"))
def q_min_periods(spark, sf_dir):
    """Companies with at least two months: months counted once per match domain."""
    m = models_for(spark, sf_dir)
    per_key = (m.matched_traffic.groupBy(MATCH_KEY)
               .agg(F.count_distinct(yyyymm("traffic_year", "traffic_month")).alias("months_available"))
               .filter(F.col("months_available") >= 2))
    return m.keyed_organizations.select("organization_id", MATCH_KEY).join(per_key, MATCH_KEY).select(
        "organization_id", "months_available")


# Incremental scenario: the target already holds every month up to one year
# before the newest month of the source; the batch is the whole staged source.
def _incremental_parts(spark, sf_dir):
    m = models_for(spark, sf_dir)
    full = m.traffic_enhanced
    ym = yyyymm("traffic_year", "traffic_month")
    newest = full.agg(F.max(ym).alias("m")).first()["m"]
    target = full.filter(ym <= newest - 100)
    staged = m.stg_traffic.filter(F.col("total_visits") > 0)
    return m, target, staged


_INC_BASE = """,
inc_target AS (SELECT * FROM traffic_enh
               WHERE traffic_year * 100 + traffic_month <= (SELECT max(traffic_year * 100 + traffic_month) FROM traffic_enh) - 100),
inc_new AS (SELECT * FROM traffic_enh
            WHERE traffic_year * 100 + traffic_month > (SELECT max(traffic_year * 100 + traffic_month) FROM inc_target))
"""


def _inc_sql(select: str) -> Callable[[], str]:
    return lambda: oracle.pipeline_sql().rstrip() + _INC_BASE + select


@register("incremental_hwm", _inc_sql("SELECT web_traffic_id, traffic_year, traffic_month FROM inc_new"))
def q_incremental_hwm(spark, sf_dir):
    _, target, staged = _incremental_parts(spark, sf_dir)
    return newer_than(staged, target).select("web_traffic_id", "traffic_year", "traffic_month")


_UPSERT_COLS = ["web_traffic_id", "traffic_year", "traffic_month", "total_visits", "overall_quality_score",
                "quality_tier", "platform_preference"]


@register("incremental_upsert", _inc_sql(
    "SELECT web_traffic_id, traffic_year, traffic_month, total_visits, "
    "round(overall_quality_score * 1048576) / 1048576 + 0.0 AS overall_quality_score, quality_tier, platform_preference "
    "FROM (SELECT * FROM inc_target UNION ALL SELECT * FROM inc_new)"))
def q_incremental_upsert(spark, sf_dir):
    """Target + gated, enhanced batch merged on the key = the full build."""
    _, target, staged = _incremental_parts(spark, sf_dir)
    batch = enhance_traffic(newer_than(staged, target))
    return upsert(target, batch, "web_traffic_id").select(*_UPSERT_COLS)


# Late-arrival scenario: sites without a main category were onboarded late, so
# the target holds only categorized sites up to one year before the newest
# month; their earlier months arrive after the gate and are reported.
_LATE_SQL = """,
late_target AS (SELECT * FROM traffic_enh
                WHERE site_main_category IS NOT NULL
                  AND traffic_year * 100 + traffic_month <= (SELECT max(traffic_year * 100 + traffic_month) FROM traffic_enh) - 100)
SELECT s.web_traffic_id, s.traffic_year, s.traffic_month
FROM tr_pos s
WHERE s.traffic_year * 100 + s.traffic_month <= (SELECT max(traffic_year * 100 + traffic_month) FROM late_target)
  AND NOT EXISTS (SELECT 1 FROM late_target t WHERE t.web_traffic_id = s.web_traffic_id)"""


@register("incremental_late_rows", lambda: oracle.pipeline_sql().rstrip() + _LATE_SQL)
def q_incremental_late_rows(spark, sf_dir):
    """The late rows that a run of the loader reports."""
    raw = load_sources(spark, sf_dir)[1]
    ym = F.col("year") * 100 + F.col("month")
    newest = raw.filter("total_estimated_visits > 0").agg(F.max(ym).alias("m")).first()["m"]
    path = shared_table_path(spark, "incremental_late")
    load_increment(spark, raw.filter(F.col("main_category").isNotNull() & (ym <= newest - 100)), path)
    report = load_increment(spark, raw.filter(ym <= newest - 100), path)
    return report.late.select("web_traffic_id", "traffic_year", "traffic_month")


# The loader itself, over the derived source: a first load of all months but the
# newest year, then a run over the whole source; and a refresh that corrects an old month.
_LOADED_COLS = _UPSERT_COLS


@register("incremental_load", lambda: oracle.pipeline_sql().rstrip() + oracle.final_select("traffic_enh", _LOADED_COLS))
def q_incremental_load(spark, sf_dir):
    """Two runs of the loader equal the full build."""
    raw = load_sources(spark, sf_dir)[1]
    ym = F.col("year") * 100 + F.col("month")
    newest = raw.agg(F.max(ym).alias("m")).first()["m"]
    path = shared_table_path(spark, "incremental_load")
    load_increment(spark, raw.filter(ym <= newest - 100), path)
    load_increment(spark, raw, path)
    return spark.read.parquet(path).select(*_LOADED_COLS)


@register("incremental_full_refresh", lambda: oracle.pipeline_sql().rstrip() + oracle.final_select("traffic_enh", _LOADED_COLS))
def q_incremental_full_refresh(spark, sf_dir):
    """A target whose loaded months hold wrong visits is reloaded from the corrected source."""
    raw = load_sources(spark, sf_dir)[1]
    path = shared_table_path(spark, "incremental_refresh")
    load_increment(spark, raw.withColumn("total_estimated_visits", F.col("total_estimated_visits") * 2), path)
    load_increment(spark, raw, path, full_refresh=True)
    return spark.read.parquet(path).select(*_LOADED_COLS)


# Lists and dictionaries as tables, beyond the broadcast budget.
@register("block_list_pages", lambda: (
    f"WITH hosts AS (SELECT page_id, url, {oracle.std_domain('url')} AS host FROM pages), "
    "listed AS (SELECT host FROM hosts WHERE host IS NOT NULL GROUP BY host HAVING count(*) >= 3) "
    "SELECT page_id, url FROM hosts WHERE host IS NULL OR host NOT IN (SELECT host FROM listed)"))
def q_block_list_pages(spark, sf_dir):
    """Pages of hosts that are not on the list of those with three pages or more."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    host = standardize_domain("url")
    listed = pages.groupBy(host.alias("host")).agg(F.count(F.lit(1)).alias("n")).filter("n >= 3").select("host")
    return without_listed(pages, host, listed, ["page_id"], budget_bytes=0)


def _places(spark, variants):
    return spark.createDataFrame([(v, c) for c, vs in variants.items() for v in vs], "variant string, canonical string")


@register("canonical_places_by_table", lambda: oracle.model_query("orgs_enh", [
    "organization_id", "organization_city", "organization_region", "standardized_city", "standardized_region"]))
def q_canonical_places_by_table(spark, sf_dir):
    orgs = models_for(spark, sf_dir).organizations_enhanced.select("organization_id", "organization_city", "organization_region")
    for place, variants in (("city", CITY_VARIANTS), ("region", REGION_VARIANTS)):
        orgs = canonical_by_table(orgs, f"organization_{place}", f"standardized_{place}", _places(spark, variants), ["organization_id"], 0)
    return orgs


# The marts from monthly state: a load of all months but the newest year, then of
# the rest, the state brought up to date after each.
_STATES: dict[tuple[str, str], str] = {}


def _state(spark, sf_dir):
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _STATES:
        raw = load_sources(spark, sf_dir)[1]
        ym = F.col("year") * 100 + F.col("month")
        newest = raw.agg(F.max(ym).alias("m")).first()["m"]
        traffic, state = shared_table_path(spark, "state_traffic"), shared_table_path(spark, "domain_months")
        for batch in (raw.filter(ym <= newest - 100), raw):
            load_increment(spark, batch, traffic)
            update_state(spark, traffic, state)
        remove_table(spark, traffic)  # the marts read the state alone
        _STATES[key] = state
    return spark.read.parquet(_STATES[key])


@register("company_mart_from_state", lambda: oracle.model_query("mart_company", oracle.MODEL_CTES["mart_company_performance"][1]))
def q_company_from_state(spark, sf_dir):
    return company_performance_from_state(models_for(spark, sf_dir).keyed_organizations, _state(spark, sf_dir))


@register("timeseries_mart_from_state", lambda: oracle.model_query("mart_ts", oracle.MODEL_CTES["mart_company_timeseries"][1]))
def q_timeseries_from_state(spark, sf_dir):
    return company_timeseries_from_state(models_for(spark, sf_dir).keyed_organizations, _state(spark, sf_dir))


# ------------------------------------------------------------ quality checks
def check_models(spark, sf_dir) -> dict[str, DataFrame]:
    m = models_for(spark, sf_dir)
    raw_orgs, raw_traffic = load_sources(spark, sf_dir)
    out = {"organization_summary": raw_orgs, "global_growth": raw_traffic}
    for name in ("stg_organizations", "stg_traffic"):
        out[name] = getattr(m, name)  # views in the source project: checked as views
    for name in ("organizations_enhanced", "traffic_enhanced", "company_web_bridge", "mart_company_performance",
                 "mart_company_timeseries", "mart_category_insights"):
        out[name] = m.table(name)  # tables in the source project: checked after the build
    return out


for _kind in ("unique", "not_null", "accepted_values", "relationships", "accepted_range", "expression"):
    def _run(spark, sf_dir, kinds=(_kind,)):
        return run_suite(check_models(spark, sf_dir), SUITE, kinds)
    register(f"dq_{_kind}", (lambda k: (lambda: oracle.checks_query(SUITE, (k,))))(_kind))(_run)


# Row checks counted by the writes of the tables themselves.
_WATCHED = ["organizations_enhanced", "traffic_enhanced", "company_web_bridge", "mart_company_performance", "mart_company_timeseries",
            "mart_category_insights"]
_ROW_SUITE = {name: [c for c in SUITE[name] if c.kind in ROW_KINDS] for name in _WATCHED}


@register("dq_while_writing", lambda: oracle.checks_query(_ROW_SUITE, ROW_KINDS))
def q_dq_while_writing(spark, sf_dir):
    """The enhanced tables and the marts are written again, and nothing is read back for their row checks."""
    m = models_for(spark, sf_dir)
    rows = {"organizations_enhanced": organizations_enhanced(m.stg_organizations), "traffic_enhanced": traffic_enhanced(m.stg_traffic)}
    parts = []
    for name in _WATCHED:
        watched = WatchedChecks(name, SUITE[name])
        write_table(watched.attach(rows[name] if name in rows else getattr(m, name)), f"watched_{name}")
        parts.append(watched.results(spark, watched.counts()))
    return reduce(DataFrame.unionByName, parts)
