"""Invariants over many random rows (one Spark job per property)."""

import random

from pyspark.sql import functions as F

from conftest import SF_SMALL
from sitelens.functions import mean_available, tier
from sitelens.plans.traffic import QUALITY_TIERS, platform_ratio


def test_ratios_sum_to_one_and_scores_in_unit_range(spark):
    rnd = random.Random(11)
    rows = [(rnd.choice([None, rnd.randint(0, 50)]), rnd.choice([None, rnd.randint(0, 50)]),
             *[rnd.choice([None, rnd.random()]) for _ in range(4)]) for _ in range(2000)]
    df = spark.createDataFrame(rows, "m long, d long, a double, b double, c double, e double")
    out = df.select(platform_ratio(F.col("m"), F.col("d")).alias("mr"), platform_ratio(F.col("d"), F.col("m")).alias("dr"),
                    mean_available("a", "b", "c", "e").alias("q"))
    bad = out.filter((F.col("mr").isNotNull() & (F.abs(F.col("mr") + F.col("dr") - 1) > 1e-12))
                     | (F.col("q") < 0) | (F.col("q") > 1)).count()
    assert bad == 0


def test_tier_is_monotone(spark):
    order = {label: i for i, (_, label) in enumerate(QUALITY_TIERS)}
    order["Unknown-Quality"] = len(order)
    df = spark.range(0, 1001).select((F.col("id") / 1000.0).alias("x"))
    labels = [r[0] for r in df.orderBy(F.col("x").desc()).select(
        tier("x", QUALITY_TIERS, "Unknown-Quality", inclusive=True)).collect()]
    ranks = [order[v] for v in labels]
    assert ranks == sorted(ranks)


def test_mart_invariants_on_test_data(spark):
    from sitelens.plans.pipeline import lazy_models_for
    m = lazy_models_for(spark, SF_SMALL)
    ts = m.mart_company_timeseries
    assert ts.filter((F.col("first_month") > F.col("last_month"))
                     | (F.col("months_available") > F.col("months_span"))).count() == 0
    assert ts.groupBy("organization_id").count().filter("count > 1").count() == 0
    cat = m.mart_category_insights
    assert cat.filter(F.col("investor_companies") > F.col("total_companies")).count() == 0


def test_pair_and_per_domain_marts_agree(spark):
    from pair_forms import category_insights, company_performance, company_timeseries
    from sitelens.plans.pipeline import lazy_models_for
    from sitelens.registry import comparable
    m = lazy_models_for(spark, SF_SMALL)
    for by_pairs, by_domain in ((company_performance(m.company_traffic), m.mart_company_performance),
                                (company_timeseries(m.company_traffic), m.mart_company_timeseries),
                                (category_insights(m.company_traffic), m.mart_category_insights)):
        a, b = comparable(by_pairs), comparable(by_domain)
        assert a.count() == b.count() > 0
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
