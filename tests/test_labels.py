"""Every label of every tier, through the models' own functions on inline rows, and the bounds of the oracle."""

import pytest
from pyspark.sql import functions as F

from sitelens import oracle
from sitelens.plans import category, timeseries, traffic
from sitelens.schemas import MART_CATEGORY, STG_TRAFFIC, SchemaDriftError, column_type, enforce, typed


def test_library_bounds_equal_the_oracles():
    for module, names in ((timeseries, ["GROWTH_TIERS", "QUALITY_TRENDS", "RANK_TRENDS", "MOMENTUM_TIERS"]),
                          (category, ["CONCENTRATION_TIERS", "SIZE_TIERS"]), (traffic, ["QUALITY_TIERS"])):
        for name in names:
            assert getattr(module, name) == getattr(oracle, name), name


def test_every_timeseries_label(spark):
    # (first visits, last visits, first quality, last quality, first rank, last rank, peak) -> labels
    cases = [
        ((100, 151, 0.5, 0.7, 500, 399, 151), ("High Growth", "Quality Improving", "Rank Significantly Improved", "Near Peak Performance")),
        ((100, 150, 0.5, 0.6, 500, 400, 167), ("Moderate Growth", "Quality Stable", "Rank Improved", "Strong Performance")),
        ((100, 120, 0.5, 0.44, 500, 480, 200), ("Stable", "Quality Declining", "Rank Stable", "Moderate Performance")),
        ((100, 95, 0.5, 0.46, 500, 520, 190), ("Declining", "Quality Stable", "Rank Declined", "Below Peak Performance")),
        ((100, 80, 0.5, None, 500, 600, 88), ("Significant Decline", "Quality Unknown", "Rank Significantly Declined", "Near Peak Performance")),
        ((0, 80, None, 0.5, None, 600, 0), ("Insufficient Data", "Quality Unknown", "Rank Unknown", "Performance Unknown")),
    ]
    names = ("first_month_visits", "last_month_visits", "first_month_quality", "last_month_quality", "first_month_global_rank",
             "last_month_global_rank", "peak_visits")
    rows = [(i, *c) for i, (c, _) in enumerate(cases)]
    kinds = ", ".join(f"{n} {column_type(n).simpleString()}" for n in names)
    b = spark.createDataFrame(rows, f"i int, {kinds}").withColumns(
        {"first_month_country_rank": F.lit(1), "last_month_country_rank": F.lit(1), "peak_quality_score": F.lit(0.9), "months_span": F.lit(3)})
    got = {r["i"]: tuple(r[c] for c in ("growth_category", "quality_trend", "ranking_trend", "performance_momentum"))
           for r in timeseries.add_growth(b).collect()}
    assert got == {i: want for i, (_, want) in enumerate(cases)}
    for at, bounds in enumerate((oracle.GROWTH_TIERS, oracle.QUALITY_TRENDS, oracle.RANK_TRENDS, oracle.MOMENTUM_TIERS)):
        assert {label for _, label in bounds} <= {g[at] for g in got.values()}


def test_every_category_label(spark):
    cases = [("a", 0.71, 10, "Highly Concentrated", "Large Market"), ("b", 0.7, 9, "Moderately Concentrated", "Medium Market"),
             ("c", 0.4, 5, "Somewhat Concentrated", "Medium Market"), ("d", 0.2, 4, "Fragmented", "Small Market"),
             ("e", 0.1, 3, "Fragmented", "Small Market"), ("f", 0.1, 2, "Fragmented", "Niche Market"), (None, 0.9, 1, "Fragmented", "Niche Market")]
    g = spark.createDataFrame([(c, t, n) for c, t, n, _, _ in cases], "main_category string, _top_share double, total_companies long")
    g = g.withColumns({"_cv": F.lit(0.5), "_density": F.lit(1.0), "investor_companies": F.lit(1).cast("long")})
    derived = {"traffic_concentration_cv", "top_company_traffic_share", "companies_per_million_visits", "investor_ratio",
               "market_concentration_tier", "market_size_tier", "primary_age_segment", "primary_gender_segment", "_mart_created_at"}
    g = g.withColumns({f.name: F.lit(None).cast(f.dataType) for f in typed(MART_CATEGORY).fields
                       if f.name not in derived and f.name not in g.columns})
    got = {r["main_category"]: (r["market_concentration_tier"], r["market_size_tier"]) for r in category._finish(g).collect()}
    assert got == {c: (a, b) for c, _, _, a, b in cases}


def test_every_quality_and_platform_label(spark):
    scores = spark.createDataFrame([(0.8,), (0.6,), (0.4,), (0.39,), (None,)], "s double")
    got = [r[0] for r in scores.select(traffic.tier("s", traffic.QUALITY_TIERS, traffic.QUALITY_UNKNOWN, inclusive=True)).collect()]
    assert got == ["High-Quality", "Medium-Quality", "Low-Quality", "Unknown-Quality", "Unknown-Quality"]
    assert set(got) == set(traffic.QUALITY_LABELS)
    visits = spark.createDataFrame([(201, 100), (100, 201), (100, 70), (100, 69)], "m long, d long")
    got = [r[0] for r in visits.select(traffic.platform_preference(F.col("m"), F.col("d"))).collect()]
    assert got == ["Mobile-Dominant", "Desktop-Dominant", "Balanced", "Mixed"] and set(got) == set(traffic.PLATFORM_LABELS)


def test_contracts_hold_types(spark):
    good = spark.createDataFrame([], typed(STG_TRAFFIC))
    assert enforce(good, STG_TRAFFIC).schema == typed(STG_TRAFFIC)
    with pytest.raises(SchemaDriftError):
        enforce(good.withColumn("total_visits", F.lit("7")), STG_TRAFFIC)
