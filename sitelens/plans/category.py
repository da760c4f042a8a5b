"""Category insights mart (J3-J4, A11-A18, M26-M28): one row per main category.

The source rules aggregate the same rows by category twice (market
aggregates and concentration) and left-join the two. Here both come from one
aggregate: the concentration columns are NULLed for the NULL category,
which is exactly what the left join produced (a NULL key never matches).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelens.functions.metrics import ratio_if_positive, safe_div, tier
from sitelens.operators.aggregates import label_counts, rows_of, top_label, total
from sitelens.operators.domain_match import MATCH_KEY, weight_of
from sitelens.operators.skew import ByKey, by_key
from sitelens.plans.company import age_segment, gender_segment
from sitelens.plans.traffic import PLATFORM_LABELS, QUALITY_LABELS
from sitelens.schemas import MART_CATEGORY, enforce

# Tier bounds and labels.
CONCENTRATION_TIERS = [(0.7, "Highly Concentrated"), (0.4, "Moderately Concentrated"),
                       (0.2, "Somewhat Concentrated")]
SIZE_TIERS = [(10, "Large Market"), (5, "Medium Market"), (3, "Small Market")]
VISITS_PER_UNIT = 1000000.0

WEIGHTED = {"overall_quality_score": "category_avg_quality_score",
            "age_18_24_share": "category_age_18_24_share", "age_25_34_share": "category_age_25_34_share",
            "age_35_44_share": "category_age_35_44_share", "age_45_54_share": "category_age_45_54_share",
            "age_55_64_share": "category_age_55_64_share", "age_65_plus_share": "category_age_65_plus_share",
            "male_share": "category_male_share", "female_share": "category_female_share"}
CHANNELS = {"desktop_direct_visits": "category_direct_share",
            "desktop_organic_search_visits": "category_organic_share",
            "desktop_paid_search_visits": "category_paid_share",
            "desktop_referral_visits": "category_referral_share",
            "desktop_social_visits": "category_social_share"}
TOTALS = {"total_visits": "total_category_visits", "total_unique_visitors": "total_category_unique_visitors",
          "total_page_views": "total_category_page_views", "desktop_visits": "total_desktop_visits",
          "mobile_visits": "total_mobile_visits"}


def _finish(g: DataFrame) -> DataFrame:
    """Concentration columns (NULL for the NULL category, as its left join
    never matched in the source rules), ratios, tiers and segments."""
    has_key = F.col("main_category").isNotNull()
    out = g.withColumns({
        "traffic_concentration_cv": F.when(has_key, F.col("_cv")),
        "top_company_traffic_share": F.when(has_key, F.col("_top_share")),
        "companies_per_million_visits": F.when(has_key, F.col("_density")),
    }).withColumns({
        "investor_ratio": ratio_if_positive("investor_companies", "total_companies"),
        "market_concentration_tier": tier("top_company_traffic_share", CONCENTRATION_TIERS, "Fragmented"),
        "market_size_tier": tier("total_companies", SIZE_TIERS, "Niche Market", inclusive=True),
        "primary_age_segment": age_segment("category_"),
        "primary_gender_segment": gender_segment("category_male_share", "category_female_share"),
        "_mart_created_at": F.current_timestamp(),
    })
    return enforce(out, MART_CATEGORY)


def _weighted_mode(pairs: DataFrame, value: str, weight: str, out: str, distinct: str) -> DataFrame:
    """Per category, the non-NULL ``value`` with the largest total ``weight``
    (smallest value on a tie), and the number of distinct values: one small
    aggregate per (category, value) serves both."""
    totals = (pairs.filter(F.col(value).isNotNull()).groupBy("main_category", value)
              .agg(F.sum(weight).alias("_w")))
    return totals.groupBy("main_category").agg(
        F.min_by(F.col(value), F.struct((-F.col("_w")).alias("w"), F.col(value).alias("v"))).alias(out),
        F.count(F.lit(1)).alias(distinct))


def domain_categories(matched: DataFrame | ByKey) -> DataFrame:
    """Matched traffic aggregated once per (match key, category)."""
    return by_key(matched, _domain_categories)


def _domain_categories(matched: DataFrame) -> DataFrame:
    v, weight = F.col("total_visits"), weight_of(matched)
    cat = F.col("site_main_category").alias("main_category")
    squares = v.cast("decimal(38,0)") * v.cast("decimal(38,0)")
    if weight is not None:
        squares = squares * F.col(weight).cast("decimal(38,0)")
    return matched.groupBy(MATCH_KEY, cat).agg(
        rows_of(weight).alias("_n"),
        *[total(c, weight).alias(c) for c in list(TOTALS) + list(CHANNELS)],
        *[total(F.col(c) * v, weight).alias(f"_wx_{c}") for c in WEIGHTED],
        F.max(v).alias("_max"), F.min(v).alias("_min"),
        F.sum(squares).alias("_sq"),
        *label_counts("platform_preference", PLATFORM_LABELS, "_pp", weight),
        *label_counts("quality_tier", QUALITY_LABELS, "_qt", weight),
    )


def category_insights_by_domain(keyed_orgs: DataFrame, per_key: DataFrame) -> DataFrame:
    """The category mart from ``domain_categories`` rows, without forming
    company x traffic pairs.

    A traffic row of match key k stands for m_k pairs (m_k = companies with
    key k). Traffic is aggregated once per (key, category); sums, counts,
    label counts and the sum of squares (exact, DECIMAL) are scaled by m_k,
    and company-level figures come from (company, category) rows. All inputs
    of the joins here have one row per key, company or category."""
    m = keyed_orgs.groupBy(MATCH_KEY).agg(F.count(F.lit(1)).alias("_m"))
    weighted = per_key.join(m, MATCH_KEY, "inner")
    w = F.col("_m")

    def msum(c):
        return F.sum(F.col(c) * w)

    sum_v, sum_desk, n = msum("total_visits"), msum("desktop_visits"), msum("_n")
    market = weighted.groupBy("main_category").agg(
        *[msum(src).alias(dst) for src, dst in TOTALS.items()],
        F.when(sum_v > 0, safe_div(msum("mobile_visits"), sum_v)).alias("category_mobile_ratio"),
        F.when(sum_v > 0, safe_div(msum("desktop_visits"), sum_v)).alias("category_desktop_ratio"),
        *[F.when(sum_v > 0, safe_div(msum(f"_wx_{src}"), sum_v)).alias(dst) for src, dst in WEIGHTED.items()],
        *[F.when(sum_desk > 0, safe_div(msum(src), sum_desk)).alias(dst) for src, dst in CHANNELS.items()],
        F.max("_max").alias("largest_company_visits"), F.min("_min").alias("smallest_company_visits"),
        safe_div(sum_v, n).alias("avg_company_visits"),
        n.alias("_pairs"), sum_v.alias("_sum_v"),
        F.sum(F.col("_sq") * w.cast("decimal(38,0)")).alias("_sum_sq"),
        *[msum(f"_pp{i}").alias(f"_pp{i}") for i in range(len(PLATFORM_LABELS))],
        *[msum(f"_qt{i}").alias(f"_qt{i}") for i in range(len(QUALITY_LABELS))],
    )
    # Sample variance over the pairs from exact moments: (S2 - S1^2 / W) / (W - 1).
    s1 = F.col("_sum_v").cast("decimal(38,0)")
    var = (F.col("_sum_sq") - s1 * s1 / F.col("_pairs")) / (F.col("_pairs") - 1)
    market = market.withColumns({
        "dominant_platform_preference": top_label("_pp", PLATFORM_LABELS),
        "dominant_quality_tier": top_label("_qt", QUALITY_LABELS),
        "_std": F.when(F.col("_pairs") > 1, F.sqrt(var.cast("double"))),
    })

    # Company-level figures: one row per (company, category) with its pair count.
    comp = per_key.select(MATCH_KEY, "main_category", "_n").join(
        keyed_orgs.select(MATCH_KEY, "organization_id", "standardized_city", "standardized_region", "is_investor"),
        MATCH_KEY, "inner")
    companies = comp.groupBy("main_category").agg(
        F.count(F.lit(1)).alias("total_companies"),
        F.count_if(F.col("is_investor")).alias("investor_companies"),
    )
    region = _weighted_mode(comp, "standardized_region", "_n", "dominant_region", "unique_regions")
    city = _weighted_mode(comp, "standardized_city", "_n", "dominant_city", "unique_cities")

    def on_category(a: DataFrame, b: DataFrame, how: str) -> DataFrame:
        b = b.withColumnRenamed("main_category", "_c")
        return a.join(b, a["main_category"].eqNullSafe(b["_c"]), how).drop("_c")

    g = on_category(on_category(on_category(market, companies, "inner"), region, "left"), city, "left")
    g = g.filter(F.col("total_companies") >= 1).fillna(0, ["unique_cities", "unique_regions"])
    avg_v = F.col("avg_company_visits")
    companies_n = F.col("total_companies")
    g = g.withColumns({
        "_cv": F.when((companies_n > 1) & (avg_v > 0), safe_div(F.col("_std"), avg_v)),
        "_top_share": F.when(F.col("_sum_v") > 0, safe_div(F.col("largest_company_visits"), F.col("_sum_v"))),
        "_density": F.when(F.col("_sum_v") > 0,
                           safe_div(companies_n, F.col("_sum_v") / F.lit(VISITS_PER_UNIT))),
    })
    return _finish(g)
