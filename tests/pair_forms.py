"""The marts from company x traffic pairs, as the source rules state them: the
plain formulation that the library's per-domain forms must agree with."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelens.functions.metrics import safe_div, weighted_avg
from sitelens.functions.periods import yyyymm
from sitelens.operators.aggregates import dominant, first_row, traffic_row_order
from sitelens.plans import category, company, timeseries
from sitelens.plans.category import CHANNELS, TOTALS, VISITS_PER_UNIT, WEIGHTED
from sitelens.plans.company import COMPANY_ATTRS
from sitelens.plans.timeseries import GROUP_KEYS, MIN_MONTHS
from sitelens.schemas import MART_TIMESERIES, enforce


def company_performance(rows: DataFrame, order=None) -> DataFrame:
    order, period = traffic_row_order() if order is None else order, yyyymm("traffic_year", "traffic_month")
    g = rows.groupBy("organization_id").agg(
        first_row(COMPANY_ATTRS + ["match_confidence_score"], order, "_company"),
        *company.numeric_aggs(), *company.period_aggs(order, period))
    return company._finish(g.select("*", *[F.col("_company")[c].alias(c) for c in COMPANY_ATTRS + ["match_confidence_score"]]))


def company_timeseries(rows: DataFrame, min_months: int = MIN_MONTHS, order=None) -> DataFrame:
    order, period = traffic_row_order() if order is None else order, yyyymm("traffic_year", "traffic_month")
    g = rows.groupBy(*GROUP_KEYS).agg(first_row(["match_confidence_score"], order, "_conf"),
                                      *timeseries.numeric_aggs(), *timeseries.period_aggs(order, period))
    g = g.withColumn("match_confidence_score", F.col("_conf")["match_confidence_score"])
    b = timeseries._boundary_columns(g.filter(F.col("months_available") >= min_months))
    return enforce(timeseries.add_growth(b), MART_TIMESERIES)


def category_insights(rows: DataFrame) -> DataFrame:
    """``rows`` = company_traffic (company-month rows carry city/region/investor)."""
    v = F.col("total_visits")
    sum_v, sum_desk = F.sum(v), F.sum("desktop_visits")
    companies = F.count_distinct("organization_id")
    g = rows.groupBy(F.col("site_main_category").alias("main_category")).agg(
        companies.alias("total_companies"),
        F.count_distinct(F.when(F.col("is_investor"), F.col("organization_id"))).alias("investor_companies"),
        F.count_distinct("standardized_city").alias("unique_cities"),
        F.count_distinct("standardized_region").alias("unique_regions"),
        *[F.sum(src).alias(dst) for src, dst in TOTALS.items()],
        F.when(sum_v > 0, safe_div(F.sum("mobile_visits"), sum_v)).alias("category_mobile_ratio"),
        F.when(sum_v > 0, safe_div(F.sum("desktop_visits"), sum_v)).alias("category_desktop_ratio"),
        dominant("platform_preference").alias("dominant_platform_preference"),
        dominant("quality_tier").alias("dominant_quality_tier"),
        *[weighted_avg(src, "total_visits").alias(dst) for src, dst in WEIGHTED.items()],
        *[F.when(sum_desk > 0, safe_div(F.sum(src), sum_desk)).alias(dst) for src, dst in CHANNELS.items()],
        dominant("standardized_region").alias("dominant_region"),
        dominant("standardized_city").alias("dominant_city"),
        F.max(v).alias("largest_company_visits"),
        F.min(v).alias("smallest_company_visits"),
        F.avg(v).alias("avg_company_visits"),
        F.when((companies > 1) & (F.avg(v) > 0), safe_div(F.stddev_samp(v), F.avg(v))).alias("_cv"),
        F.when(sum_v > 0, safe_div(F.max(v), sum_v)).alias("_top_share"),
        F.when(sum_v > 0, safe_div(companies, sum_v / F.lit(VISITS_PER_UNIT))).alias("_density"),
    ).filter(F.col("total_companies") >= 1)

    return category._finish(g)
