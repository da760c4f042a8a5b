"""Independent SQL formulation of every query, for DuckDB.

Used only as the correctness oracle: the driver registers the raw test
tables as views, so each text embeds the test-data rules and all model
layers as CTEs. It is written from the model rules directly (not generated
from the DataFrame code) with bounds and labels of its own, so a wrong bound
in the library shows; shared with it are only the city and region variants
and the output columns.

Oracle-side conventions (DuckDB 2.0): integer sums are cast back to BIGINT,
``/`` denominators that can be zero are wrapped in ``nullif``, ties of
``mode`` and first/last pick explicitly, and DOUBLE outputs are snapped to a
2**-20 grid on both sides by ``final_select`` as ``round(x * 2^20) / 2^20``
(floating-point sums depend on summation order).
"""

from __future__ import annotations

from sitelens.functions.geo import CITY_VARIANTS, REGION_VARIANTS
from sitelens.functions.keys import SURROGATE_NULL
from sitelens.schemas import (
    COMPANY_WEB_BRIDGE, MART_CATEGORY, MART_COMPANY, MART_TIMESERIES, ORGANIZATIONS_ENHANCED,
    STG_ORGANIZATIONS, STG_TRAFFIC, TRAFFIC_ENHANCED, AUDIT_COLUMNS, TRAFFIC_RAW,
)
from sitelens.schemas import DOUBLE_COLUMNS as MODEL_DOUBLES
from sitelens.sources.adapter import (
    CHANNEL_BY_PART_MOD7, CITY_BY_NATION_MOD13, COUNTRY_BY_NATION_MOD7, REGION_BY_NATION_MOD7,
)

ROUND_BITS = 20

# Every DOUBLE-typed output column: those of the models, of the raw traffic, and of single queries.
DOUBLE_COLUMNS = {*MODEL_DOUBLES, *(f.name for f in TRAFFIC_RAW.fields if f.dataType.simpleString() == "double"),
                  "quality_score", "avg_share", "weighted_quality", "value_share"}

# Fixed values of the model rules: (bound, label), in the order they are tried.
QUALITY_TIERS = [(0.8, "High-Quality"), (0.6, "Medium-Quality"), (0.4, "Low-Quality")]
GROWTH_TIERS = [(0.5, "High Growth"), (0.2, "Moderate Growth"), (-0.05, "Stable"), (-0.2, "Declining")]
QUALITY_TRENDS = [(0.1, "Quality Improving"), (-0.05, "Quality Stable")]
RANK_TRENDS = [(100, "Rank Significantly Improved"), (20, "Rank Improved"), (-20, "Rank Stable"), (-100, "Rank Declined")]
MOMENTUM_TIERS = [(0.9, "Near Peak Performance"), (0.7, "Strong Performance"), (0.5, "Moderate Performance")]
CONCENTRATION_TIERS = [(0.7, "Highly Concentrated"), (0.4, "Moderately Concentrated"), (0.2, "Somewhat Concentrated")]
SIZE_TIERS = [(10, "Large Market"), (5, "Medium Market"), (3, "Small Market")]


def q(s: str | None) -> str:
    return "NULL" if s is None else "'" + s.replace("'", "''") + "'"


def case_index(expr: str, values: list) -> str:
    return "CASE " + " ".join(f"WHEN {expr} = {i} THEN {q(v)}" for i, v in enumerate(values)) + " END"


def case_lookup(expr: str, variants: dict[str, list[str]]) -> str:
    arms = " ".join(f"WHEN lower({expr}) IN ({', '.join(q(v) for v in vs)}) THEN {q(canon)}"
                    for canon, vs in variants.items())
    return f"CASE {arms} ELSE {expr} END"


def sql_tier(expr: str, thresholds, default: str, inclusive: bool = False, null_label: str | None = None) -> str:
    """CASE over (bound, label) pairs; ``null_label`` for a NULL value, else ``default``."""
    op = ">=" if inclusive else ">"
    arms = " ".join(f"WHEN {expr} {op} {b} THEN {q(label)}" for b, label in thresholds)
    tail = (f"WHEN {expr} IS NOT NULL THEN {q(default)} ELSE {q(null_label)}" if null_label is not None
            else f"ELSE {q(default)}")
    return f"CASE {arms} {tail} END"


def final_select(cte: str, columns: list[str], extra_where: str = "") -> str:
    cols = [c for c in columns if c not in AUDIT_COLUMNS]
    scale = 2 ** ROUND_BITS
    sel = ", ".join(f"round({c} * {scale}) / {scale} + 0.0 AS {c}" if c in DOUBLE_COLUMNS else c for c in cols)
    return f"SELECT {sel} FROM {cte}{(' WHERE ' + extra_where) if extra_where else ''}"


def ck(expr: str) -> str:
    """Surrogate-key part: text cast with the NULL marker."""
    return f"coalesce(CAST({expr} AS VARCHAR), {q(SURROGATE_NULL)})"


def std_domain(c: str) -> str:
    inner = f"lower(regexp_replace(regexp_replace(trim({c}), '^(https?://)?(www\\.)?', ''), '/.*$', ''))"
    return f"(CASE WHEN {c} IS NULL OR trim({c}) = '' THEN NULL ELSE {inner} END)"


def root_dom(c: str) -> str:
    return f"regexp_replace({std_domain(c)}, '^[^.]*\\.', '')"


# ---------------------------------------------------------------- test data
_AGE_BANDS = ["18_to_24", "25_to_34", "35_to_44", "45_to_54", "55_to_64", "65_plus"]


def _adapter_ctes(by_country: bool = False) -> str:
    dev_cols = []
    for dev, cond in (("desktop", "NOT mob"), ("mobileweb", "mob")):
        dev_cols += [
            f"CAST(sum(CASE WHEN {cond} THEN q END) AS BIGINT) AS {dev}_estimated_visits",
            f"CAST(count(DISTINCT CASE WHEN {cond} THEN o END) AS BIGINT) AS {dev}_estimated_unique",
            f"CAST(sum(CASE WHEN {cond} THEN q * ln END) AS BIGINT) AS {dev}_estimated_page_views",
            f"sum(CASE WHEN {cond} THEN q * ln END) * CAST(1 AS DOUBLE) / nullif(sum(CASE WHEN {cond} THEN q END), 0) AS {dev}_pages_per_visit",
            f"sum(CASE WHEN {cond} THEN q END) * CAST(10 AS DOUBLE) / nullif(sum(CASE WHEN {cond} THEN 1 ELSE 0 END), 0) AS {dev}_visits_duration",
            f"sum(CASE WHEN {cond} THEN d END) / (nullif(sum(CASE WHEN {cond} THEN 1 ELSE 0 END), 0) * CAST(10 AS DOUBLE)) AS {dev}_bounce_rate",
        ]
    chan = [f"CAST(sum(CASE WHEN NOT mob AND p % 7 = {i} THEN q ELSE 0 END) AS BIGINT) AS desktop_{ch}_estimated_visits"
            for i, ch in enumerate(CHANNEL_BY_PART_MOD7)]
    ages = [f"sum(CASE WHEN p % 6 = {i} THEN q ELSE 0 END) * CAST(1 AS DOUBLE) / sum(q) AS total_ages_{b}_share"
            for i, b in enumerate(_AGE_BANDS)]
    ks = "CAST(k AS VARCHAR)"
    grouped = ",\n      ".join([
        f"CASE WHEN k % 17 = 5 THEN '' WHEN k % 13 = 0 THEN ' Supplier' || {ks} || '.EXAMPLE.com ' ELSE 'supplier' || {ks} || '.example.com' END AS clean_site",
        "site",
        f"'cat-' || CAST(k % 6 AS VARCHAR) || '/sub-' || CAST(k % 3 AS VARCHAR) AS site_category",
        f"CASE WHEN k % 23 = 7 THEN NULL ELSE 'cat-' || CAST(k % 6 AS VARCHAR) END AS main_category",
        *dev_cols,
        "CAST(CASE WHEN k % 19 = 3 AND m = 2 THEN 0 ELSE sum(q) END AS BIGINT) AS total_estimated_visits",
        "CAST(sum(q * ln) AS BIGINT) AS total_estimated_pageviews",
        "CASE WHEN k % 11 = 0 THEN NULL ELSE CAST(floor(sum(q) * (50 + k % 50) / CAST(100 AS DOUBLE)) AS BIGINT) END AS total_estimated_unique",
        "CAST(count(DISTINCT o) AS BIGINT) AS deduplicated_audience",
        "CASE WHEN k % 11 = 0 THEN NULL ELSE sum(ln) * (1 + k % 4) * CAST(1 AS DOUBLE) / (2 * count(*)) END AS total_pages_per_visit",
        "CASE WHEN k % 11 = 0 THEN CAST(1.5 AS DOUBLE) ELSE sum(d) / (count(*) * CAST(10 AS DOUBLE)) END AS total_bounce_rate",
        "CASE WHEN k % 11 = 0 THEN NULL ELSE sum(q) * 3 * (1 + k % 5) * CAST(1 AS DOUBLE) / count(*) END AS total_visits_duration",
        *chan,
        "CASE WHEN k % 5 = 0 THEN CAST(0.5 AS DOUBLE) ELSE sum(CASE WHEN o % 2 = 0 THEN q ELSE 0 END) * CAST(1 AS DOUBLE) / sum(q) END AS total_males_share",
        "CASE WHEN k % 5 = 0 THEN CAST(0.5 AS DOUBLE) ELSE sum(CASE WHEN o % 2 = 1 THEN q ELSE 0 END) * CAST(1 AS DOUBLE) / sum(q) END AS total_females_share",
        *ages,
        "'C' || CAST(c AS VARCHAR) AS country",
        "y AS year", "m AS month",
    ])
    ranks = ",\n      ".join(
        f"CAST(row_number() OVER (PARTITION BY {part} ORDER BY total_estimated_visits DESC, site, country) AS BIGINT) AS {name}"
        for name, part in (("global_rank", "year, month"), ("country_rank", "country, year, month"),
                           ("main_category_rank", "main_category, year, month"),
                           ("category_rank", "site_category, year, month")))
    sk = "CAST(sk AS VARCHAR)"
    country = "l_suppkey % 4"
    if by_country:
        country = f"CASE WHEN l_suppkey % 3 = 0 THEN (l_suppkey + l_orderkey % 2) % 4 ELSE {country} END"
    return f"""
li AS (
  SELECT l_suppkey AS k, l_orderkey AS o, l_partkey AS p, l_linenumber AS ln,
         CAST(l_quantity AS BIGINT) AS q, CAST(round(l_discount * 100) AS BIGINT) AS d,
         CAST(year(l_shipdate) AS INTEGER) AS y, CAST(month(l_shipdate) AS INTEGER) AS m,
         (l_linenumber + l_suppkey) % 7 < l_suppkey % 7 AS mob,
         CASE WHEN l_suppkey % 10 = 0 AND l_linenumber % 2 = 1
              THEN 'https://www.supplier' || CAST(l_suppkey AS VARCHAR) || '.example.com/shop'
              ELSE 'supplier' || CAST(l_suppkey AS VARCHAR) || '.example.com' END AS site,
         {country} AS c
  FROM lineitem),
tgrouped AS (
  SELECT {grouped}
  FROM li GROUP BY k, site, y, m, c),
raw_traffic AS (
  SELECT *,
      {ranks}
  FROM tgrouped),
sup AS (
  SELECT s_suppkey AS sk, s_name, s_nationkey AS nk, FALSE AS extra FROM supplier
  UNION ALL
  SELECT s_suppkey, s_name, s_nationkey, TRUE FROM supplier WHERE s_suppkey % 4 = 0),
raw_orgs AS (
  SELECT
    CASE WHEN extra THEN 'org-b-' ELSE 'org-' END || {sk} AS uuid,
    CASE WHEN extra THEN s_name || ' B' ELSE s_name END AS name,
    'organization' AS type,
    CASE WHEN extra THEN lower(s_name) || '-b' ELSE lower(s_name) END AS permalink,
    CAST(NULL AS VARCHAR) AS cb_url,
    CASE WHEN extra THEN 'investor' WHEN sk % 3 = 0 THEN 'company' WHEN sk % 3 = 1 THEN 'Investor,company' END AS roles,
    CAST(NULL AS VARCHAR) AS short_description, CAST(NULL AS VARCHAR) AS logo_url,
    CASE WHEN extra THEN 'supplier' || {sk} || '.example.com'
         WHEN sk % 6 = 0 THEN 'https://www.supplier' || {sk} || '.example.com/about'
         WHEN sk % 6 = 1 THEN 'supplier' || {sk} || '.example.com'
         WHEN sk % 6 = 2 THEN ' WWW.Supplier' || {sk} || '.example.com'
         WHEN sk % 6 = 3 THEN 'http://supplier' || {sk} || '.example.com'
         WHEN sk % 6 = 4 THEN 'www.supplier' || {sk} || '.example.com/'
         WHEN sk % 4 = 1 THEN 'linkedin.com' END AS domain,
    CAST(NULL AS VARCHAR) AS homepage_url, CAST(NULL AS VARCHAR) AS facebook_url,
    CAST(NULL AS VARCHAR) AS linkedin_url, CAST(NULL AS VARCHAR) AS twitter_url,
    CASE WHEN extra THEN 'Aarhus' ELSE {case_index('nk % 13', CITY_BY_NATION_MOD13)} END AS city,
    CASE WHEN extra THEN 'central jutland' ELSE {case_index('nk % 7', REGION_BY_NATION_MOD7)} END AS region,
    CAST(NULL AS VARCHAR) AS state_code,
    CASE WHEN extra THEN 'DNK' ELSE {case_index('nk % 7', COUNTRY_BY_NATION_MOD7)} END AS country_code,
    TIMESTAMP '2015-01-01 00:00:00' AS created_at,
    TIMESTAMP '2020-01-01 00:00:00' AS updated_at
  FROM sup)"""


# ---------------------------------------------------------------- models
def _model_ctes() -> str:
    quality_parts = ["bounce_quality_score", "pages_quality_score", "duration_quality_score",
                     "uniqueness_quality_score"]
    qsum = " + ".join(f"coalesce({c}, 0)" for c in quality_parts)
    qcnt = " + ".join(f"(CASE WHEN {c} IS NOT NULL THEN 1 ELSE 0 END)" for c in quality_parts)
    return f"""
stg_orgs AS (
  SELECT uuid AS organization_id, name AS organization_name, permalink AS organization_permalink,
         domain AS organization_domain, type AS organization_type, roles AS organization_roles,
         short_description AS organization_description, city AS organization_city,
         region AS organization_region, state_code AS organization_state_code,
         country_code AS organization_country_code, homepage_url AS organization_homepage_url,
         cb_url AS organization_cb_url, facebook_url AS organization_facebook_url,
         linkedin_url AS organization_linkedin_url, twitter_url AS organization_twitter_url,
         logo_url AS organization_logo_url, created_at AS organization_created_at,
         updated_at AS organization_updated_at
  FROM raw_orgs WHERE uuid IS NOT NULL),
stg_traffic AS (
  SELECT md5({ck('site')} || '-' || {ck('year')} || '-' || {ck('month')}) AS web_traffic_id,
         site AS site_domain, clean_site AS cleaned_site_domain, year AS traffic_year, month AS traffic_month,
         main_category AS site_main_category, site_category, country AS site_country,
         global_rank AS site_global_rank, country_rank AS site_country_rank,
         main_category_rank AS site_main_category_rank, category_rank AS site_category_rank,
         desktop_estimated_visits AS desktop_visits, desktop_estimated_unique AS desktop_unique_visitors,
         desktop_estimated_page_views AS desktop_page_views, desktop_pages_per_visit,
         desktop_visits_duration AS desktop_visit_duration_seconds, desktop_bounce_rate,
         desktop_direct_estimated_visits AS desktop_direct_visits,
         desktop_organic_search_estimated_visits AS desktop_organic_search_visits,
         desktop_paid_search_estimated_visits AS desktop_paid_search_visits,
         desktop_referrals_estimated_visits AS desktop_referral_visits,
         desktop_social_estimated_visits AS desktop_social_visits,
         desktop_display_estimated_visits AS desktop_display_visits,
         desktop_mail_estimated_visits AS desktop_email_visits,
         mobileweb_estimated_visits AS mobile_visits, mobileweb_estimated_unique AS mobile_unique_visitors,
         mobileweb_estimated_page_views AS mobile_page_views, mobileweb_pages_per_visit AS mobile_pages_per_visit,
         mobileweb_visits_duration AS mobile_visit_duration_seconds, mobileweb_bounce_rate AS mobile_bounce_rate,
         total_estimated_visits AS total_visits, total_estimated_unique AS total_unique_visitors,
         total_estimated_pageviews AS total_page_views, total_pages_per_visit,
         total_visits_duration AS total_visit_duration_seconds, total_bounce_rate, deduplicated_audience,
         total_ages_18_to_24_share AS age_18_24_share, total_ages_25_to_34_share AS age_25_34_share,
         total_ages_35_to_44_share AS age_35_44_share, total_ages_45_to_54_share AS age_45_54_share,
         total_ages_55_to_64_share AS age_55_64_share, total_ages_65_plus_share AS age_65_plus_share,
         total_males_share AS male_share, total_females_share AS female_share
  FROM raw_traffic
  WHERE site IS NOT NULL AND year IS NOT NULL AND month IS NOT NULL),
orgs_enh AS (
  SELECT *,
         {case_lookup('organization_city', CITY_VARIANTS)} AS standardized_city,
         {case_lookup('organization_region', REGION_VARIANTS)} AS standardized_region,
         coalesce(lower(organization_roles) LIKE '%investor%', FALSE) AS is_investor,
         {std_domain('organization_domain')} AS standardized_domain,
         {root_dom('organization_domain')} AS root_domain
  FROM stg_orgs WHERE organization_country_code IN ('DNK', 'SWE', 'NOR', 'FIN', 'ISL')),
tr_pos AS (SELECT * FROM stg_traffic WHERE total_visits > 0),
tr_q AS (
  SELECT *,
    CASE WHEN coalesce(desktop_visits, 0) + coalesce(mobile_visits, 0) > 0
         THEN coalesce(mobile_visits, 0) / (coalesce(desktop_visits, 0) + coalesce(mobile_visits, 0)) END AS mobile_traffic_ratio,
    CASE WHEN coalesce(desktop_visits, 0) + coalesce(mobile_visits, 0) > 0
         THEN coalesce(desktop_visits, 0) / (coalesce(desktop_visits, 0) + coalesce(mobile_visits, 0)) END AS desktop_traffic_ratio,
    CASE WHEN coalesce(mobile_visits, 0) > 2 * coalesce(desktop_visits, 0) THEN 'Mobile-Dominant'
         WHEN coalesce(desktop_visits, 0) > 2 * coalesce(mobile_visits, 0) THEN 'Desktop-Dominant'
         WHEN abs(coalesce(mobile_visits, 0) - coalesce(desktop_visits, 0))
              <= 0.3 * greatest(coalesce(mobile_visits, 0), coalesce(desktop_visits, 0)) THEN 'Balanced'
         ELSE 'Mixed' END AS platform_preference,
    CASE WHEN coalesce(mobile_bounce_rate, 0) < coalesce(desktop_bounce_rate, 0) THEN 'Mobile-Better-Engagement'
         WHEN coalesce(desktop_bounce_rate, 0) < coalesce(mobile_bounce_rate, 0) THEN 'Desktop-Better-Engagement'
         ELSE 'Similar-Engagement' END AS platform_engagement_leader,
    CASE WHEN total_bounce_rate BETWEEN 0 AND 1 THEN 1 - total_bounce_rate END AS bounce_quality_score,
    CASE WHEN total_pages_per_visit > 0 THEN least(total_pages_per_visit / 10.0, 1.0) END AS pages_quality_score,
    CASE WHEN total_visit_duration_seconds > 0 THEN least(total_visit_duration_seconds / 300.0, 1.0) END AS duration_quality_score,
    CASE WHEN total_visits > 0 AND total_unique_visitors > 0
         THEN least(total_unique_visitors / total_visits, 1.0) END AS uniqueness_quality_score
  FROM tr_pos),
tr_s AS (
  SELECT *, CAST(({qsum}) AS DOUBLE) / nullif({qcnt}, 0) AS overall_quality_score FROM tr_q),
traffic_enh AS (
  SELECT *,
    {sql_tier('overall_quality_score', QUALITY_TIERS, 'Unknown-Quality', inclusive=True)} AS quality_tier,
    {std_domain('site_domain')} AS standardized_domain,
    {root_dom('site_domain')} AS root_domain
  FROM tr_s WHERE site_domain IS NOT NULL),
m_orgs AS (
  SELECT * FROM orgs_enh
  WHERE standardized_domain IS NOT NULL AND trim(standardized_domain) <> ''
    AND lower(trim(standardized_domain)) NOT IN
        ('linkedin.com', 'facebook.com', 'twitter.com', 'gmail.com', 'yahoo.com', 'hotmail.com')),
m_traffic AS (
  SELECT * FROM traffic_enh
  WHERE cleaned_site_domain IS NOT NULL AND trim(cleaned_site_domain) <> '' AND total_visits > 0),
bridge AS (
  SELECT md5({ck('o.organization_id')} || '-' || {ck('t.web_traffic_id')}) AS company_web_bridge_id,
         o.organization_id, t.web_traffic_id, o.organization_name, o.organization_permalink,
         o.standardized_domain AS organization_domain, o.standardized_city, o.standardized_region,
         o.organization_country_code, o.is_investor, o.organization_created_at, o.organization_updated_at,
         t.cleaned_site_domain AS traffic_domain, t.traffic_year, t.traffic_month, t.site_main_category,
         t.site_category, t.site_country AS traffic_country, t.site_global_rank, t.total_visits,
         t.total_unique_visitors, t.overall_quality_score, t.quality_tier, t.platform_preference,
         CAST(0.95 AS DOUBLE) AS match_confidence_score, 'exact_domain_match' AS match_method,
         TRUE AS is_domain_match
  FROM m_orgs o JOIN m_traffic t
    ON lower(trim(o.standardized_domain)) = lower(trim(t.cleaned_site_domain))),
ct AS (
  SELECT b.organization_id, b.organization_name, b.organization_permalink, b.organization_domain,
         b.standardized_city, b.standardized_region, b.organization_country_code, b.is_investor,
         b.organization_created_at, b.organization_updated_at, b.match_confidence_score,
         t.*, t.traffic_year * 100 + t.traffic_month AS ym,
         lpad(CAST(t.traffic_year * 100 + t.traffic_month AS VARCHAR), 6, '0') || t.web_traffic_id || coalesce(t.site_country, '') AS rowkey
  FROM bridge b JOIN traffic_enh t ON b.web_traffic_id = t.web_traffic_id)"""


def _mode_cte(name: str, group: str, value: str, source: str = "ct") -> str:
    return (f"{name} AS (SELECT {group}, first(v ORDER BY n DESC, v) AS {value} FROM "
            f"(SELECT {group}, {value} AS v, count(*) AS n FROM {source} WHERE {value} IS NOT NULL "
            f"GROUP BY {group}, {value}) GROUP BY {group})")


_AGE_LABELS = [("18-24", "age_18_24_share"), ("25-34", "age_25_34_share"), ("35-44", "age_35_44_share"),
               ("45-54", "age_45_54_share"), ("55-64", "age_55_64_share"), ("65+", "age_65_plus_share")]


def age_case(prefix: str = "") -> str:
    vals = [f"coalesce({prefix}{c}, 0)" for _, c in _AGE_LABELS]
    top = "greatest(" + ", ".join(vals) + ")"
    arms = " ".join(f"WHEN {top} = {v} THEN '{label}'" for (label, _), v in zip(_AGE_LABELS, vals))
    return f"CASE {arms} ELSE 'Unknown' END"


def gender_case(m: str, f: str) -> str:
    return (f"CASE WHEN coalesce({m}, 0) > coalesce({f}, 0) THEN 'Male-Leaning' "
            f"WHEN coalesce({f}, 0) > coalesce({m}, 0) THEN 'Female-Leaning' "
            f"WHEN abs(coalesce({m}, 0) - coalesce({f}, 0)) <= 0.1 THEN 'Balanced' ELSE 'Unknown' END")


def _company_ctes() -> str:
    firsts = ["organization_name", "organization_permalink", "organization_domain", "standardized_city",
              "standardized_region", "organization_country_code", "is_investor", "organization_created_at",
              "organization_updated_at", "site_domain"]
    renamed_firsts = {"site_main_category": "industry_category", "site_category": "industry_subcategory",
                      "site_country": "traffic_country", "match_confidence_score": "match_confidence_score"}
    sums = ["total_visits", "total_unique_visitors", "total_page_views", "desktop_visits", "mobile_visits",
            "desktop_direct_visits", "desktop_organic_search_visits", "desktop_paid_search_visits",
            "desktop_referral_visits", "desktop_social_visits", "desktop_display_visits", "desktop_email_visits"]
    avgs = ["mobile_traffic_ratio", "desktop_traffic_ratio", "total_pages_per_visit",
            "total_visit_duration_seconds", "total_bounce_rate", "desktop_bounce_rate", "mobile_bounce_rate",
            "age_18_24_share", "age_25_34_share", "age_35_44_share", "age_45_54_share", "age_55_64_share",
            "age_65_plus_share", "male_share", "female_share"]
    sel = ",\n    ".join(
        [f"first({c} ORDER BY rowkey) AS {c}" for c in firsts]
        + [f"first({c} ORDER BY rowkey) AS {d}" for c, d in renamed_firsts.items()]
        + ["min(ym) AS ym_first", "max(ym) AS ym_last", "count(DISTINCT ym) AS months_available",
           "min(site_global_rank) AS site_global_rank", "min(site_country_rank) AS site_country_rank",
           "min(site_main_category_rank) AS site_main_category_rank",
           "min(site_category_rank) AS site_category_rank",
           "avg(overall_quality_score) AS digital_performance_score"]
        + [f"CAST(sum({c}) AS BIGINT) AS {c}" for c in sums]
        + [f"avg({c}) AS {c}" for c in avgs])
    shares = {"desktop_direct_share": "desktop_direct_visits", "desktop_organic_share": "desktop_organic_search_visits",
              "desktop_paid_share": "desktop_paid_search_visits", "desktop_referral_share": "desktop_referral_visits",
              "desktop_social_share": "desktop_social_visits", "desktop_display_share": "desktop_display_visits",
              "desktop_email_share": "desktop_email_visits"}
    share_sql = ",\n    ".join(f"CASE WHEN desktop_visits > 0 THEN {n} / desktop_visits END AS {s}"
                               for s, n in shares.items())
    return f"""
c_agg AS (
  SELECT organization_id,
    {sel}
  FROM ct GROUP BY organization_id),
{_mode_cte('c_tier', 'organization_id', 'quality_tier')},
{_mode_cte('c_pref', 'organization_id', 'platform_preference')},
{_mode_cte('c_lead', 'organization_id', 'platform_engagement_leader')},
mart_company AS (
  SELECT a.*,
    CAST(a.ym_first // 100 AS VARCHAR) || '-' || lpad(CAST(a.ym_first % 100 AS VARCHAR), 2, '0') AS period_start,
    CAST(a.ym_last // 100 AS VARCHAR) || '-' || lpad(CAST(a.ym_last % 100 AS VARCHAR), 2, '0') AS period_end,
    t.quality_tier AS performance_tier, p.platform_preference, l.platform_engagement_leader,
    {share_sql},
    {age_case('a.')} AS primary_age_segment,
    {gender_case('a.male_share', 'a.female_share')} AS primary_gender_segment
  FROM c_agg a
  LEFT JOIN c_tier t USING (organization_id)
  LEFT JOIN c_pref p USING (organization_id)
  LEFT JOIN c_lead l USING (organization_id))"""


TS_KEYS = ["organization_id", "organization_name", "organization_permalink", "organization_domain",
           "standardized_city", "standardized_region", "organization_country_code", "is_investor",
           "organization_created_at", "organization_updated_at"]


def _timeseries_ctes() -> str:
    keys = ", ".join(TS_KEYS)
    bounds = {"total_visits": "visits", "overall_quality_score": "quality", "site_global_rank": "global_rank",
              "site_country_rank": "country_rank", "total_unique_visitors": "unique_visitors",
              "total_bounce_rate": "bounce_rate"}
    fl = ",\n    ".join(
        [f"first({c} ORDER BY rowkey) AS first_month_{n}" for c, n in bounds.items()]
        + [f"first({c} ORDER BY rowkey DESC) AS last_month_{n}" for c, n in bounds.items()])
    join_on = " AND ".join(f"a.{k} IS NOT DISTINCT FROM x.{k}" for k in TS_KEYS)
    mode_src = "ct"
    return f"""
ts_agg AS (
  SELECT {keys},
    first(site_domain ORDER BY rowkey) AS site_domain,
    first(site_main_category ORDER BY rowkey) AS industry_category,
    first(site_category ORDER BY rowkey) AS industry_subcategory,
    first(site_country ORDER BY rowkey) AS traffic_country,
    first(match_confidence_score ORDER BY rowkey) AS match_confidence_score,
    min(ym) AS ym_first, max(ym) AS ym_last, count(DISTINCT ym) AS months_available,
    {fl},
    max(total_visits) AS peak_visits, min(site_global_rank) AS best_global_rank,
    max(overall_quality_score) AS peak_quality_score,
    avg(total_visits) AS avg_visits, avg(overall_quality_score) AS avg_quality_score
  FROM ct GROUP BY {keys}
  HAVING count(DISTINCT ym) >= 2),
{_mode_cte('ts_pref', keys, 'platform_preference', mode_src)},
{_mode_cte('ts_tier', keys, 'quality_tier', mode_src)},
ts_b AS (
  SELECT a.*,
    CAST(a.ym_first // 100 AS VARCHAR) || '-' || lpad(CAST(a.ym_first % 100 AS VARCHAR), 2, '0') AS first_month,
    CAST(a.ym_last // 100 AS VARCHAR) || '-' || lpad(CAST(a.ym_last % 100 AS VARCHAR), 2, '0') AS last_month,
    CAST((a.ym_last // 100 - a.ym_first // 100) * 12 + (a.ym_last % 100 - a.ym_first % 100) + 1 AS BIGINT) AS months_span,
    (SELECT x.platform_preference FROM ts_pref x WHERE {join_on}) AS dominant_platform_preference,
    (SELECT x.quality_tier FROM ts_tier x WHERE {join_on}) AS dominant_quality_tier
  FROM ts_agg a),
ts_g AS (
  SELECT *,
    CASE WHEN first_month_visits > 0 AND last_month_visits IS NOT NULL
         THEN (last_month_visits - first_month_visits) / first_month_visits END AS visits_growth_rate,
    CASE WHEN first_month_visits > 0 AND last_month_visits IS NOT NULL AND months_span > 1
         THEN power(last_month_visits / first_month_visits, 1.0 / (months_span - 1)) - 1 END AS visits_monthly_growth_rate,
    last_month_visits - first_month_visits AS visits_absolute_change,
    CASE WHEN first_month_quality IS NOT NULL AND last_month_quality IS NOT NULL
         THEN last_month_quality - first_month_quality END AS quality_score_change,
    CASE WHEN first_month_quality IS NOT NULL AND last_month_quality IS NOT NULL
         THEN (last_month_quality - first_month_quality) / nullif(first_month_quality, 0) END AS quality_score_change_rate,
    first_month_global_rank - last_month_global_rank AS global_rank_change,
    first_month_country_rank - last_month_country_rank AS country_rank_change,
    CASE WHEN last_month_visits > 0 AND peak_visits > 0 THEN last_month_visits / peak_visits END AS current_vs_peak_visits_ratio,
    CASE WHEN last_month_quality IS NOT NULL AND peak_quality_score IS NOT NULL
         THEN last_month_quality / nullif(peak_quality_score, 0) END AS current_vs_peak_quality_ratio
  FROM ts_b),
mart_ts AS (
  SELECT *,
    {sql_tier('visits_growth_rate', GROWTH_TIERS, 'Significant Decline', null_label='Insufficient Data')} AS growth_category,
    {sql_tier('quality_score_change', QUALITY_TRENDS, 'Quality Declining', null_label='Quality Unknown')} AS quality_trend,
    {sql_tier('global_rank_change', RANK_TRENDS, 'Rank Significantly Declined', null_label='Rank Unknown')} AS ranking_trend,
    {sql_tier('current_vs_peak_visits_ratio', MOMENTUM_TIERS, 'Below Peak Performance', null_label='Performance Unknown')} AS performance_momentum,
    CASE WHEN visits_growth_rate IS NOT NULL AND quality_score_change IS NOT NULL
           THEN least(100, greatest(0, 50 + visits_growth_rate * 30 + quality_score_change * 20))
         WHEN visits_growth_rate IS NOT NULL THEN least(100, greatest(0, 50 + visits_growth_rate * 40))
         WHEN quality_score_change IS NOT NULL THEN least(100, greatest(0, 50 + quality_score_change * 30))
    END AS growth_health_score
  FROM ts_g)"""


def _category_ctes() -> str:
    wavg = {"overall_quality_score": "category_avg_quality_score", "age_18_24_share": "category_age_18_24_share",
            "age_25_34_share": "category_age_25_34_share", "age_35_44_share": "category_age_35_44_share",
            "age_45_54_share": "category_age_45_54_share", "age_55_64_share": "category_age_55_64_share",
            "age_65_plus_share": "category_age_65_plus_share", "male_share": "category_male_share",
            "female_share": "category_female_share"}
    chans = {"desktop_direct_visits": "category_direct_share", "desktop_organic_search_visits": "category_organic_share",
             "desktop_paid_search_visits": "category_paid_share", "desktop_referral_visits": "category_referral_share",
             "desktop_social_visits": "category_social_share"}
    w = ",\n    ".join(f"CASE WHEN sum(total_visits) > 0 THEN sum({v} * total_visits) / sum(total_visits) END AS {o}"
                       for v, o in wavg.items())
    c = ",\n    ".join(f"CASE WHEN sum(desktop_visits) > 0 THEN sum({v}) / sum(desktop_visits) END AS {o}"
                       for v, o in chans.items())
    modes = [("cat_pref", "platform_preference", "dominant_platform_preference"),
             ("cat_tier", "quality_tier", "dominant_quality_tier"),
             ("cat_region", "standardized_region", "dominant_region"),
             ("cat_city", "standardized_city", "dominant_city")]
    mode_ctes = ",\n".join(_mode_cte(n, "site_main_category", v, "cct") for n, v, _ in modes)
    mode_sel = ",\n    ".join(
        f"(SELECT x.{v} FROM {n} x WHERE x.site_main_category IS NOT DISTINCT FROM a.main_category) AS {o}"
        for n, v, o in modes)
    return f"""
cct AS (
  SELECT t.site_main_category, b.organization_id, b.web_traffic_id, o.standardized_city, o.standardized_region, o.is_investor,
         t.total_visits, t.total_unique_visitors, t.total_page_views, t.desktop_visits, t.mobile_visits,
         t.platform_preference, t.overall_quality_score, t.quality_tier,
         t.age_18_24_share, t.age_25_34_share, t.age_35_44_share, t.age_45_54_share, t.age_55_64_share,
         t.age_65_plus_share, t.male_share, t.female_share, t.desktop_direct_visits,
         t.desktop_organic_search_visits, t.desktop_paid_search_visits, t.desktop_referral_visits,
         t.desktop_social_visits
  FROM bridge b JOIN traffic_enh t ON b.web_traffic_id = t.web_traffic_id
  JOIN orgs_enh o ON b.organization_id = o.organization_id),
cat_agg AS (
  SELECT site_main_category AS main_category,
    count(DISTINCT organization_id) AS total_companies,
    count(DISTINCT CASE WHEN is_investor THEN organization_id END) AS investor_companies,
    count(DISTINCT standardized_city) AS unique_cities,
    count(DISTINCT standardized_region) AS unique_regions,
    CAST(sum(total_visits) AS BIGINT) AS total_category_visits,
    CAST(sum(total_unique_visitors) AS BIGINT) AS total_category_unique_visitors,
    CAST(sum(total_page_views) AS BIGINT) AS total_category_page_views,
    CAST(sum(desktop_visits) AS BIGINT) AS total_desktop_visits,
    CAST(sum(mobile_visits) AS BIGINT) AS total_mobile_visits,
    CASE WHEN sum(total_visits) > 0 THEN sum(mobile_visits) / sum(total_visits) END AS category_mobile_ratio,
    CASE WHEN sum(total_visits) > 0 THEN sum(desktop_visits) / sum(total_visits) END AS category_desktop_ratio,
    {w},
    {c},
    max(total_visits) AS largest_company_visits, min(total_visits) AS smallest_company_visits,
    avg(total_visits) AS avg_company_visits
  FROM cct GROUP BY site_main_category),
conc AS (
  SELECT site_main_category,
    CASE WHEN count(DISTINCT organization_id) > 1 AND avg(total_visits) > 0
         THEN stddev_samp(total_visits) / avg(total_visits) END AS traffic_concentration_cv,
    CASE WHEN sum(total_visits) > 0 THEN max(total_visits) / sum(total_visits) END AS top_company_traffic_share,
    CASE WHEN sum(total_visits) > 0
         THEN count(DISTINCT organization_id) / (sum(total_visits) / 1000000.0) END AS companies_per_million_visits
  FROM cct GROUP BY site_main_category),
{mode_ctes},
mart_category AS (
  SELECT a.*,
    CASE WHEN a.total_companies > 0 THEN a.investor_companies / a.total_companies END AS investor_ratio,
    {mode_sel},
    m.traffic_concentration_cv, m.top_company_traffic_share, m.companies_per_million_visits,
    {sql_tier('m.top_company_traffic_share', CONCENTRATION_TIERS, 'Fragmented')} AS market_concentration_tier,
    {sql_tier('a.total_companies', SIZE_TIERS, 'Niche Market', inclusive=True)} AS market_size_tier,
    {age_case('a.category_')} AS primary_age_segment,
    {gender_case('a.category_male_share', 'a.category_female_share')} AS primary_gender_segment
  FROM cat_agg a LEFT JOIN conc m ON a.main_category = m.site_main_category
  WHERE a.total_companies >= 1)"""


def pipeline_sql(by_country: bool = False) -> str:
    return ("WITH" + _adapter_ctes(by_country) + "," + _model_ctes() + "," + _company_ctes() + ","
            + _timeseries_ctes() + "," + _category_ctes() + "\n")


def model_query(cte: str, columns: list[str], where: str = "", by_country: bool = False) -> str:
    return pipeline_sql(by_country) + final_select(cte, columns, where)


MODEL_CTES = {
    "stg_organizations": ("stg_orgs", STG_ORGANIZATIONS),
    "stg_traffic": ("stg_traffic", STG_TRAFFIC),
    "organizations_enhanced": ("orgs_enh", ORGANIZATIONS_ENHANCED),
    "traffic_enhanced": ("traffic_enh", TRAFFIC_ENHANCED),
    "company_web_bridge": ("bridge", COMPANY_WEB_BRIDGE),
    "mart_company_performance": ("mart_company", MART_COMPANY),
    "mart_company_timeseries": ("mart_ts", MART_TIMESERIES),
    "mart_category_insights": ("mart_category", MART_CATEGORY),
}


# Oracle CTE of each checked model (raw inputs included).
CHECK_CTES = {"organization_summary": "raw_orgs", "global_growth": "raw_traffic",
              "stg_organizations": "stg_orgs", "stg_traffic": "stg_traffic",
              "organizations_enhanced": "orgs_enh", "traffic_enhanced": "traffic_enh",
              "company_web_bridge": "bridge", "mart_company_performance": "mart_company",
              "mart_company_timeseries": "mart_ts", "mart_category_insights": "mart_category"}


def _lit(v) -> str:
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, (int, float)):
        return repr(v)
    return q(v)


def check_sql(model: str, c) -> str:
    """Failure count of one declared check, as SQL over the oracle CTEs."""
    cte = CHECK_CTES[model]
    head = (f"SELECT {q(model)} AS model, {q(c.label)} AS check_name, {q(c.column or '')} AS column_name, "
            f"{q(c.severity)} AS severity, ")
    if c.column in AUDIT_COLUMNS:  # audit timestamps are current_timestamp(): never NULL
        return head + "CAST(0 AS BIGINT) AS failures"
    if c.kind == "unique":
        return (head + f"CAST(count(*) AS BIGINT) AS failures FROM (SELECT {c.column} FROM {cte} "
                f"WHERE {c.column} IS NOT NULL GROUP BY {c.column} HAVING count(*) > 1)")
    if c.kind == "relationships":
        parent = CHECK_CTES[c.to_model]
        return (head + f"CAST(count(*) AS BIGINT) AS failures FROM {cte} x WHERE x.{c.column} IS NOT NULL "
                f"AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{c.field} = x.{c.column})")
    if c.kind == "not_null":
        bad = f"{c.column} IS NULL"
    elif c.kind == "accepted_values":
        bad = f"NOT ({c.column} IN ({', '.join(_lit(v) for v in c.values)}))"
    elif c.kind == "accepted_range":
        conds = []
        if c.min_value is not None:
            conds.append(f"{c.column} {'>=' if c.inclusive else '>'} {_lit(c.min_value)}")
        if c.max_value is not None:
            conds.append(f"{c.column} {'<=' if c.inclusive else '<'} {_lit(c.max_value)}")
        bad = "NOT (" + " AND ".join(conds) + ")"
    else:
        bad = f"NOT ({c.expression})"
    where = f"({c.where}) AND ({bad})" if c.where else bad
    return head + f"CAST(count(*) FILTER (WHERE coalesce({where}, FALSE)) AS BIGINT) AS failures FROM {cte}"


def checks_query(suite: dict, kinds: tuple[str, ...]) -> str:
    parts = [check_sql(m, c) for m, checks in suite.items() for c in checks if c.kind in kinds]
    return pipeline_sql() + "\nUNION ALL\n".join(parts)
