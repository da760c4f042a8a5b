"""Keys that several traffic rows have: the join back of bridge and traffic
multiplies, and weights give the same results without its pairs."""

import pytest
from pyspark.sql import functions as F

import pair_forms
from conftest import SF_SMALL
from sitelens.operators.aggregates import label_counts, mean, total, traffic_row_order
from sitelens.operators.domain_match import MATCH_KEY, WEIGHT, repeated_keys
from sitelens.plans.bridge import company_traffic, company_traffic_rows, keyed_organizations, matched_traffic
from sitelens.plans.category import category_insights_by_domain, domain_categories
from sitelens.plans.company import company_performance_by_domain
from sitelens.plans.pipeline import build_models
from sitelens.plans.timeseries import company_timeseries_by_domain
from sitelens.registry import comparable
from sitelens.session import materialize
from sitelens.sources.adapter import load_sources


@pytest.fixture(scope="module")
def parts(spark):
    """Companies, and traffic of which some rows share a key: in a second country,
    there also under another company's domain, under none, or under a domain in capitals."""
    orgs, raw = load_sources(spark, SF_SMALL)
    k = F.regexp_extract("site", r"supplier(\d+)", 1).cast("int")
    more = [raw.filter(k % 3 == 0).withColumn("country", F.lit("X1")),
            raw.filter(k % 6 == 0).withColumns({"country": F.lit("X2"), "clean_site": F.lit("supplier1.example.com"), "total_estimated_visits": F.lit(7)}),
            raw.filter(k % 6 == 3).withColumns({"country": F.lit(None).cast("string"), "clean_site": F.lit(" ")}),
            raw.filter(k % 4 == 1).withColumns({"country": F.lit("X3"), "clean_site": F.upper("clean_site"), "main_category": F.lit("other")})]
    for m in more:
        raw = raw.unionByName(m)
    models = build_models(orgs, raw)
    traffic = materialize(models.traffic_enhanced, "multiplicity_traffic")
    companies = materialize(models.organizations_enhanced, "multiplicity_companies")
    return companies, traffic


def literal_rows(companies, traffic):
    """Bridge rows joined back to traffic on the key."""
    bridge = company_traffic(companies, traffic)
    own = [c for c in bridge.columns if c not in traffic.columns or c == "web_traffic_id"]
    return bridge.select(*own).join(traffic.drop("standardized_domain", "root_domain", "_enhanced_at"), "web_traffic_id")


def same(a, b):
    a = comparable(a)
    b = comparable(b).select(*a.columns)
    return a.count() == b.count() and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.mark.parametrize("budget", [256 << 20, 0])
def test_rows_equal_the_join_back(spark, parts, budget):
    companies, traffic = parts
    keyed = keyed_organizations(companies)
    repeated = repeated_keys(traffic, "web_traffic_id")
    matched = matched_traffic(keyed, traffic, budget, repeated)
    assert matched.groupBy().agg(F.max(WEIGHT)).first()[0] > 1
    want = literal_rows(companies, traffic)
    assert want.count() > company_traffic(companies, traffic).count()
    assert same(company_traffic_rows(keyed, matched, budget), want)


def test_marts_equal_those_of_the_join_back(spark, parts):
    companies, traffic = parts
    keyed = keyed_organizations(companies)
    matched = materialize(matched_traffic(keyed, traffic, repeated=repeated_keys(traffic, "web_traffic_id")), "multiplicity_matched")
    rows = materialize(literal_rows(companies, traffic), "multiplicity_rows")
    order = traffic_row_order(WEIGHT)
    assert same(company_performance_by_domain(keyed, matched), pair_forms.company_performance(rows, order))
    assert same(company_timeseries_by_domain(keyed, matched), pair_forms.company_timeseries(rows, order=order))
    assert same(category_insights_by_domain(keyed, domain_categories(matched)), pair_forms.category_insights(rows))


def test_a_build_counts_repeated_keys_and_the_records_spare_it(spark, scratch):
    import os

    from sitelens.plans.pipeline import run_pipeline
    from sitelens.streaming.incremental import known_unique
    orgs, raw = load_sources(spark, SF_SMALL, by_country=True)
    orgs.write.parquet(os.path.join(scratch, "orgs"))
    raw.write.parquet(os.path.join(scratch, "traffic"))
    out = os.path.join(scratch, "out")
    checks = run_pipeline(spark, os.path.join(scratch, "orgs"), os.path.join(scratch, "traffic"), out)
    assert not known_unique(spark, os.path.join(out, "traffic_enhanced"))
    models = build_models(orgs, raw)
    assert models.repeated_traffic is not None
    for name in ("mart_company_performance", "mart_category_insights"):
        assert same(spark.read.parquet(os.path.join(out, name)), getattr(models, name))
    failed = {(r["model"], r["check_name"], r["column_name"]) for r in checks.filter("failures > 0").collect()}
    assert ("traffic_enhanced", "unique", "web_traffic_id") in failed


def test_unique_keys_carry_no_weight(spark):
    orgs, raw = load_sources(spark, SF_SMALL)
    models = build_models(orgs, raw)
    assert models.repeated_traffic is None and WEIGHT not in models.matched_traffic.columns


def test_weighted_aggregates(spark):
    t = spark.createDataFrame([("a", 3, 1.0, 2), ("b", None, None, 5), ("a", 1, 4.0, 1)], f"l string, n long, x double, {WEIGHT} long")
    row = t.agg(total("n", WEIGHT).alias("t"), mean("x", WEIGHT).alias("m"), *label_counts("l", ["a", "b"], "_c", WEIGHT)).first()
    assert (row["t"], row["m"], row["_c0"], row["_c1"]) == (7, 2.0, 3, 5)
    assert t.filter("x IS NULL").agg(mean("x", WEIGHT)).first()[0] is None
    written = t.withColumn("_i", F.explode(F.sequence(F.lit(1), F.col(WEIGHT).cast("int"))))
    plain = written.agg(total("n").alias("t"), mean("x").alias("m"), *label_counts("l", ["a", "b"], "_c")).first()
    assert tuple(plain) == tuple(row)


def test_several_domains_of_one_key(spark):
    """n bridge rows of a domain and key meet all rows of the key, whichever domain those have."""
    traffic = spark.createDataFrame(
        [("k1", "a.com", 10), ("k1", "a.com", 20), ("k1", "b.com", 30), ("k1", None, 40), ("k2", "a.com", 50), ("k3", "z.com", 60)],
        "web_traffic_id string, cleaned_site_domain string, total_visits long")
    keyed = spark.createDataFrame([("a.com",), ("b.com",)], f"{MATCH_KEY} string")
    got = matched_traffic(keyed, traffic, repeated=repeated_keys(traffic, "web_traffic_id"))
    rows = sorted((r[MATCH_KEY], r["web_traffic_id"], r["total_visits"], r[WEIGHT]) for r in got.collect())
    assert rows == [("a.com", "k1", 10, 2), ("a.com", "k1", 20, 2), ("a.com", "k1", 30, 2), ("a.com", "k1", 40, 2), ("a.com", "k2", 50, 1),
                    ("b.com", "k1", 10, 1), ("b.com", "k1", 20, 1), ("b.com", "k1", 30, 1), ("b.com", "k1", 40, 1)]
