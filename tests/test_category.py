"""Category mart edge rows: pair form and per-domain form agree; concentration rules."""

from pyspark.sql import functions as F

from sitelens.operators.domain_match import MATCH_KEY
from pair_forms import category_insights
from sitelens.plans.category import CHANNELS, TOTALS, WEIGHTED, category_insights_by_domain, domain_categories
from sitelens.registry import comparable

TRAFFIC_COLS = sorted(set(TOTALS) | set(CHANNELS) | {"total_visits"})
SHARE_COLS = sorted(c for c in WEIGHTED if c != "overall_quality_score")


def _frames(spark):
    # (key, category, visits, share) rows; key "a" has two companies (pairs double).
    rows = [("a", "cat-1", 100, 0.5), ("a", "cat-1", 300, None), ("a", None, 50, 0.2),
            ("b", "cat-1", 200, 0.4), ("c", "cat-2", 10, 0.1), ("c", "cat-2", 30, 0.3)]
    t = spark.createDataFrame(rows, f"{MATCH_KEY} string, site_main_category string, total_visits long, s double")
    for c in TRAFFIC_COLS:
        if c != "total_visits":
            t = t.withColumn(c, (F.col("total_visits") / 2).cast("long"))
    for c in SHARE_COLS:
        t = t.withColumn(c, F.col("s"))
    t = t.withColumns({"overall_quality_score": F.col("s"), "platform_preference": F.lit("Balanced"),
                       "quality_tier": F.when(F.col("s") > 0.3, "Low-Quality").otherwise("Unknown-Quality")})
    orgs = spark.createDataFrame(
        [("o1", "a", "Aarhus", "R1", True), ("o2", "a", "Odense", None, False), ("o3", "b", "Aarhus", "R1", False),
         ("o4", "c", None, "R2", True)],
        f"organization_id string, {MATCH_KEY} string, standardized_city string, standardized_region string, "
        "is_investor boolean")
    pairs = t.join(orgs, MATCH_KEY)
    return orgs, t, pairs


def test_category_forms_agree_and_edge_rules(spark):
    orgs, matched, pairs = _frames(spark)
    a = comparable(category_insights(pairs))
    b = comparable(category_insights_by_domain(orgs, domain_categories(matched))).select(*a.columns)
    assert a.count() == b.count() == 3
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    rows = {r["main_category"]: r for r in b.collect()}
    assert rows[None]["traffic_concentration_cv"] is None
    assert rows[None]["market_concentration_tier"] == "Fragmented"
    assert rows["cat-2"]["total_companies"] == 1 and rows["cat-2"]["traffic_concentration_cv"] is None
    assert rows["cat-1"]["total_companies"] == 3 and rows["cat-1"]["investor_companies"] == 1
    # pairs of key "a" count twice: (100+300)*2 + 200
    assert rows["cat-1"]["total_category_visits"] == 1000
    assert rows["cat-1"]["dominant_city"] == "Aarhus"
