"""Column helpers on inline edge rows."""

import hashlib

import pytest
from pyspark.sql import functions as F

from sitelens.functions import (
    SURROGATE_NULL,
    canonical_city, canonical_region, months_span, root_domain, standardize_domain, surrogate_key, tier,
    weighted_avg, yyyymm,
)
from sitelens.plans.company import age_segment, gender_segment
from sitelens.plans.organizations import investor_flag
from sitelens.plans.timeseries import GROWTH_TIERS, MOMENTUM_TIERS, QUALITY_TRENDS, RANK_TRENDS, growth_health
from sitelens.plans.traffic import QUALITY_TIERS, engagement_leader, platform_preference


def one_col(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_standardize_domain(spark):
    cases = {" https://www.blog.ex.com/p?q ": "blog.ex.com", "wwwx.com": "wwwx.com",
             "HTTP://WWW.Example.com/a": "http:", "www.ex.com:80": "ex.com:80", "ex.com?x=1": "ex.com?x=1",
             "": None, "  ": None, None: None, "https://": ""}
    assert one_col(spark, list(cases), standardize_domain) == list(cases.values())


def test_root_domain(spark):
    cases = {"blog.ex.com": "ex.com", "ex.com": "com", "localhost": "localhost"}
    assert one_col(spark, list(cases), root_domain) == list(cases.values())


def test_canonical_places(spark):
    cities = {"KØBENHAVN": "Copenhagen", "cph": "Copenhagen", "Århus": "Aarhus", "Oslo": "Oslo", None: None}
    assert one_col(spark, list(cities), canonical_city) == list(cities.values())
    regions = {"Hovedstaden": "Capital Region", "central jutland": "Central Denmark Region", "Uppsala": "Uppsala"}
    assert one_col(spark, list(regions), canonical_region) == list(regions.values())


def test_investor_flag(spark):
    assert one_col(spark, ["Investor,company", "company", None], investor_flag) == [True, False, False]


def test_surrogate_key(spark):
    df = spark.createDataFrame([("a", None)], "a string, b string")
    got = df.select(surrogate_key("a", "b")).first()[0]
    assert got == "6231b1e7ffe3b9d15edc44e40e6f694c"
    assert got == hashlib.md5(f"a-{SURROGATE_NULL}".encode()).hexdigest()


@pytest.mark.parametrize("m,d,expected", [
    (0, 0, "Balanced"), (None, None, "Balanced"), (21, 10, "Mobile-Dominant"), (20, 10, "Mixed"),
    (10, 7, "Balanced"), (10, 21, "Desktop-Dominant")])
def test_platform_preference(spark, m, d, expected):
    df = spark.createDataFrame([(m, d)], "m long, d long")
    assert df.select(platform_preference(F.col("m"), F.col("d"))).first()[0] == expected


@pytest.mark.parametrize("m,d,expected", [
    (None, 0.2, "Mobile-Better-Engagement"), (0.2, None, "Desktop-Better-Engagement"),
    (None, None, "Similar-Engagement")])
def test_engagement_leader(spark, m, d, expected):
    df = spark.createDataFrame([(m, d)], "m double, d double")
    assert df.select(engagement_leader(F.col("m"), F.col("d"))).first()[0] == expected


def test_quality_scores(spark):
    from sitelens.plans.traffic import enhance_traffic
    from sitelens.schemas import STG_TRAFFIC, column_type
    rows = [  # bounce, pages, seconds, uniques, visits -> score, tier
        (0.5, None, None, None, 10, 0.5, "Low-Quality"),
        (1.0, None, None, None, 10, 0.0, "Unknown-Quality"),
        (None, None, None, None, 10, None, "Unknown-Quality"),
        (1.5, 25.0, None, None, 10, 1.0, "High-Quality"),
        (None, None, 600.0, 20, 10, 1.0, "High-Quality"),
    ]
    base = spark.createDataFrame(
        [(str(i), "s.com", 2024, 1, b, p, s, u, v) for i, (b, p, s, u, v, _, _) in enumerate(rows)],
        "web_traffic_id string, site_domain string, traffic_year int, traffic_month int, total_bounce_rate double, "
        "total_pages_per_visit double, total_visit_duration_seconds double, total_unique_visitors long, "
        "total_visits long")
    for c in STG_TRAFFIC:
        if c not in base.columns:
            base = base.withColumn(c, F.lit(None).cast(column_type(c)))
    out = enhance_traffic(base).orderBy("web_traffic_id").select(
        "overall_quality_score", "quality_tier", "bounce_quality_score").collect()
    assert [(r[0], r[1]) for r in out] == [(e[5], e[6]) for e in rows]
    assert out[3][2] is None  # out-of-range bounce rate gives no component


def test_tier_edges(spark):
    def run(v, thresholds, default, **kw):
        df = spark.createDataFrame([(None if v is None else float(v),)], "x double")
        return df.select(tier("x", thresholds, default, **kw)).first()[0]
    assert [run(v, QUALITY_TIERS, "Unknown-Quality", inclusive=True) for v in (0.8, 0.6, 0.4)] == [
        "High-Quality", "Medium-Quality", "Low-Quality"]
    g = [run(v, GROWTH_TIERS, "Significant Decline", null_label="Insufficient Data")
         for v in (0.5, 0.2, -0.05, -0.2, None)]
    assert g == ["Moderate Growth", "Stable", "Declining", "Significant Decline", "Insufficient Data"]
    r = [run(v, RANK_TRENDS, "Rank Significantly Declined", null_label="Rank Unknown") for v in (100, 20, -20, -100)]
    assert r == ["Rank Improved", "Rank Stable", "Rank Declined", "Rank Significantly Declined"]
    assert run(0.9, MOMENTUM_TIERS, "Below Peak Performance", null_label="Performance Unknown") == "Strong Performance"
    assert run(0.1, QUALITY_TRENDS, "Quality Declining", null_label="Quality Unknown") == "Quality Stable"
    from sitelens.plans.category import CONCENTRATION_TIERS, SIZE_TIERS
    assert [run(v, CONCENTRATION_TIERS, "Fragmented") for v in (0.71, 0.41, 0.21, 0.2, None)] == [
        "Highly Concentrated", "Moderately Concentrated", "Somewhat Concentrated", "Fragmented", "Fragmented"]
    assert [run(v, SIZE_TIERS, "Niche Market", inclusive=True) for v in (10, 5, 3, 2)] == [
        "Large Market", "Medium Market", "Small Market", "Niche Market"]


def test_segments(spark):
    cols = ["age_18_24_share", "age_25_34_share", "age_35_44_share", "age_45_54_share", "age_55_64_share",
            "age_65_plus_share"]
    df = spark.createDataFrame([(None,) * 6, (0.1, 0.3, 0.3, 0.1, 0.1, 0.1)], ", ".join(f"{c} double" for c in cols))
    assert [r[0] for r in df.select(age_segment()).collect()] == ["18-24", "25-34"]
    g = spark.createDataFrame([(None, None), (0.52, 0.48)], "male_share double, female_share double")
    assert [r[0] for r in g.select(gender_segment("male_share", "female_share")).collect()] == [
        "Balanced", "Male-Leaning"]


def test_months_span(spark):
    df = spark.createDataFrame([(202311, 202402), (202405, 202405)], "a int, b int")
    assert [r[0] for r in df.select(months_span("a", "b")).collect()] == [4, 1]
    assert spark.range(1).select(yyyymm(F.lit(2024), F.lit(3))).first()[0] == 202403


def test_growth_health(spark):
    df = spark.createDataFrame([(0.5, 0.1), (3.0, 0.0), (-1.0, None), (None, 0.2), (None, None)], "g double, q double")
    got = [r[0] for r in df.select(growth_health("g", "q")).collect()]
    assert got[0] == pytest.approx(67.0) and got[1] == 100.0 and got[2] == pytest.approx(10.0)
    assert got[3] == pytest.approx(56.0) and got[4] is None


def test_weighted_avg(spark):
    df = spark.createDataFrame([(1.0, 1), (None, 3)], "v double, w long")
    assert df.agg(weighted_avg("v", "w")).first()[0] == pytest.approx(0.25)


def test_domain_options(spark):
    assert one_col(spark, ["HTTP://WWW.Example.com/a"], lambda c: standardize_domain(c, fold_case_first=True)) == [
        "example.com"]
    got = one_col(spark, ["blog.ex.com", "ex.com", "localhost"], lambda c: root_domain(c, keep_two_labels=True))
    assert got == ["ex.com", "ex.com", "localhost"]


def test_weighted_avg_skip_null_weights(spark):
    df = spark.createDataFrame([(1.0, 1), (None, 3)], "v double, w long")
    assert df.agg(weighted_avg("v", "w", skip_null_weights=True)).first()[0] == pytest.approx(1.0)
