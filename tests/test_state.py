"""Marts from monthly state equal those from all traffic rows."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from sitelens.plans.bridge import keyed_organizations
from sitelens.plans.pipeline import build_models, lazy_models_for
from sitelens.plans.state import company_performance_from_state, company_timeseries_from_state, update_state
from sitelens.registry import comparable
from sitelens.session import materialize
from sitelens.sources.adapter import load_sources
from sitelens.streaming.incremental import load_increment


def same(a, b):
    a = comparable(a)
    b = comparable(b).select(*a.columns)
    return a.count() == b.count() and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.mark.parametrize("by_country", [False, True])
def test_months_one_by_one_equal_all_rows(spark, scratch, by_country):
    orgs, raw = load_sources(spark, SF_SMALL, by_country)
    ym = F.col("year") * 100 + F.col("month")
    months = sorted(r[0] for r in raw.select(ym).distinct().collect())
    traffic, path = os.path.join(scratch, "t"), os.path.join(scratch, "s")
    load_increment(spark, raw.filter(ym <= months[-3]), traffic)
    assert len(update_state(spark, traffic, path)) == len(months) - 2
    load_increment(spark, raw.filter(ym <= months[-2]), traffic)
    assert update_state(spark, traffic, path) == [divmod(months[-2], 100)]  # the new month alone is read
    # Corrected values under the same keys: the rewritten months are derived again.
    wrong = raw.withColumn("total_estimated_visits", F.when(ym == months[-1], F.lit(1)).otherwise(F.col("total_estimated_visits")))
    load_increment(spark, wrong, traffic)
    update_state(spark, traffic, path)
    load_increment(spark, raw, traffic, lookback_months=1)
    assert update_state(spark, traffic, path) == [divmod(months[-1], 100)] and update_state(spark, traffic, path) == []
    models = build_models(orgs, raw, materialize_tables=True)
    state = spark.read.parquet(path)
    assert state.groupBy("_match_key", "traffic_year", "traffic_month").count().filter("count > 1").isEmpty()
    keyed = models.keyed_organizations
    assert same(company_performance_from_state(keyed, state), models.mart_company_performance)
    assert same(company_timeseries_from_state(keyed, state, budget=0), models.mart_company_timeseries)
    files = company_performance_from_state(keyed, state).inputFiles()
    assert not [f for f in files if "/t/" in f]


def test_a_refresh_without_some_months(spark, scratch):
    raw = load_sources(spark, SF_SMALL)[1]
    m = lazy_models_for(spark, SF_SMALL)
    companies = materialize(m.organizations_enhanced, "state_companies")
    ym = F.col("year") * 100 + F.col("month")
    months = sorted(r[0] for r in raw.select(ym).distinct().collect())
    traffic, path = os.path.join(scratch, "t"), os.path.join(scratch, "s")
    load_increment(spark, raw, traffic)
    update_state(spark, traffic, path)
    fewer = raw.filter(ym <= months[10])
    load_increment(spark, fewer, traffic, full_refresh=True)
    assert len(update_state(spark, traffic, path)) == 11
    models = build_models(load_sources(spark, SF_SMALL)[0], fewer)
    assert same(company_performance_from_state(keyed_organizations(companies), spark.read.parquet(path)), models.mart_company_performance)


def test_a_table_without_records_is_refused(spark, scratch):
    raw = load_sources(spark, SF_SMALL)[1]
    traffic, plain = os.path.join(scratch, "t"), os.path.join(scratch, "plain")
    load_increment(spark, raw, traffic)
    spark.read.parquet(traffic).write.partitionBy("traffic_year", "traffic_month").parquet(plain)
    with pytest.raises(ValueError):
        update_state(spark, plain, os.path.join(scratch, "s"))
