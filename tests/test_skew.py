"""Heavy keys: measured, dealt to several tasks, stored beside the buckets."""

import contextlib
import io
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from sitelens.operators.domain_match import MATCH_KEY, match_key
from sitelens.operators.skew import heavy_keys, read_by_key, salted_join, write_by_key
from sitelens.plans.bridge import bridge_by_key, company_traffic, company_web_bridge, keyed_organizations, matchable_traffic, matched_by_key, matched_traffic
from sitelens.plans.company import company_performance_by_domain
from sitelens.plans.pipeline import build_models, lazy_models_for
from sitelens.plans.timeseries import company_timeseries_by_domain
from sitelens.registry import comparable
from sitelens.session import materialize
from sitelens.sources.adapter import load_sources


@pytest.fixture
def shuffles_only(spark):
    """No broadcasts but stated ones, no re-planning at run time, 16 partitions."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def skewed(spark, rows=30_000):
    """A third of the rows has one key, a tenth has no key."""
    i = F.col("id")
    key = F.when(i % 3 == 0, "hot").when(i % 10 == 1, F.lit(None)).otherwise(F.concat(F.lit("k"), (i % 2003).cast("string")))
    return spark.range(rows).select(key.alias("k"), i.cast("string").alias("row"))


def same(a, b):
    a = comparable(a)
    b = comparable(b).select(*a.columns)
    return a.count() == b.count() and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_heavy_keys(spark):
    found = {r["k"]: r["_parts"] for r in heavy_keys(skewed(spark), "k", 1 / 32).collect()}
    assert list(found) == ["hot"] and found["hot"] in (11, 12)
    assert heavy_keys(skewed(spark).limit(0), "k", 0.1).isEmpty()
    with pytest.raises(ValueError):
        salted_join(skewed(spark), skewed(spark), "k", ["row"], "right")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_a_plain_one(spark, shuffles_only, how):
    big = skewed(spark, 6000)
    small = spark.createDataFrame([("hot", 1), ("hot", 2), ("k5", 3), ("k5", 3), (None, 4), ("absent", 5)], "k string, v int")
    got, want = salted_join(big, small, "k", ["row"], how), big.join(small, "k", how)
    assert got.columns == want.columns and same(got, want)


def test_hot_key_is_dealt_evenly(spark, shuffles_only):
    big = skewed(spark)
    small = big.filter("k IS NOT NULL").select("k").distinct().withColumn("v", F.length("k"))
    sizes = lambda df: sorted(r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect())
    plain, salted = sizes(big.join(small, "k")), sizes(salted_join(big, small, "k", ["row"]))
    assert plain[-1] > 6 * plain[len(plain) // 2]
    assert len(salted) == 16 and salted[-1] <= 3 * salted[len(salted) // 2] and sum(salted) == sum(plain)


@pytest.fixture(scope="module")
def parts(spark):
    """Companies and traffic of which one domain holds a third of the rows."""
    m = lazy_models_for(spark, SF_SMALL)
    site = F.when(F.xxhash64("web_traffic_id") % 3 == 0, F.lit("supplier4.example.com")).otherwise(F.col("cleaned_site_domain"))
    traffic = materialize(m.traffic_enhanced.withColumn("cleaned_site_domain", site), "skewed_traffic")
    return materialize(m.organizations_enhanced, "skewed_companies"), traffic


def stored(traffic, path=None, buckets=8):
    return write_by_key(matchable_traffic(traffic).withColumn(MATCH_KEY, match_key("cleaned_site_domain")), MATCH_KEY, buckets, path)


def test_stored_by_key(spark, scratch, parts):
    _, traffic = parts
    path = os.path.join(scratch, "t")
    table = stored(traffic, path)
    assert same(table.rows().drop(MATCH_KEY), matchable_traffic(traffic))
    heavy = {r[0] for r in table.heavy.select(MATCH_KEY).collect()}
    assert "supplier4.example.com" in heavy and {r[0] for r in table.hot.select(MATCH_KEY).distinct().collect()} == heavy
    assert len([f for f in os.listdir(os.path.join(path, "cold")) if f.startswith("part-")]) <= 8
    table.forget()
    again = read_by_key(spark, path)
    assert same(again.rows(), table.hot.unionByName(again.cold)) and again.key == MATCH_KEY
    assert "SelectedBucketsCount: 8 out of 8" in plan(again.cold.groupBy(MATCH_KEY).count())
    assert read_by_key(spark, os.path.join(scratch, "none")) is None
    with pytest.raises(ValueError):
        stored(traffic, None, 0)


def test_buckets_are_not_exchanged(spark, shuffles_only, parts):
    companies, traffic = parts
    table = stored(traffic)
    keyed = keyed_organizations(companies)
    by_domain = matched_by_key(keyed, table, 0)  # company keys are exchanged, traffic rows are not
    exchanged = lambda df: [line for line in plan(df).splitlines() if "Exchange " in line and "traffic" not in line]
    text = plan(by_domain.cold.groupBy(MATCH_KEY).agg(F.sum("total_visits")))
    side = text[:text.index("by_key_")]  # the branch of the plan that leads to the stored rows
    assert "Bucketed: true" in text and "Exchange" not in side and exchanged(by_domain.cold)
    text = plan(table.joined(keyed, ["web_traffic_id"]).cold)
    assert "Bucketed: true" in text and "Exchange" not in text[:text.index("by_key_")] and "Exchange" in text


def test_results_over_stored_traffic(spark, parts):
    companies, traffic = parts
    keyed, table = keyed_organizations(companies), stored(traffic)
    assert same(bridge_by_key(companies, table), company_web_bridge(companies, traffic))
    assert same(company_traffic(companies, traffic, 0), company_traffic(companies, traffic))
    plain = matched_traffic(keyed, traffic)
    for budget in (0, 256 << 20):
        by_key = matched_by_key(keyed, table, budget)
        assert same(by_key.rows(), plain)
        assert same(company_performance_by_domain(keyed, by_key), company_performance_by_domain(keyed, plain))
        assert same(company_timeseries_by_domain(keyed, by_key), company_timeseries_by_domain(keyed, plain))


def test_a_build_with_buckets(spark):
    orgs, raw = load_sources(spark, SF_SMALL)
    plain, by_key = build_models(orgs, raw), build_models(orgs, raw, materialize_tables=True, buckets=4)
    for name in ("mart_company_performance", "mart_category_insights"):
        assert same(getattr(by_key, name), getattr(plain, name))
    by_key.remove_scratch()
    assert not spark.catalog.tableExists(by_key.traffic_by_domain.name)
