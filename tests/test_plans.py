"""Physical-plan properties of every registered query."""

import contextlib
import io

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from sitelens.registry import QUERIES

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas")


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cartesian_or_python_operators(spark, name):
    text = plan_text(E.queries()[name](spark, SF_SMALL))
    assert not [op for op in FORBIDDEN if op in text]


def test_filters_reach_the_scan(spark):
    from sitelens.plans.pipeline import lazy_models_for
    m = lazy_models_for(spark, SF_SMALL)
    orgs = plan_text(m.organizations_enhanced)
    assert "PushedFilters: [IsNotNull(uuid), In(country_code" in orgs
    bridge = plan_text(m.company_web_bridge)
    assert "GreaterThan(total_estimated_visits,0)" in bridge
    assert "BroadcastHashJoin" in bridge  # the measured company side is small


def test_mart_reads_only_needed_columns(spark):
    from sitelens.plans.pipeline import lazy_models_for
    text = plan_text(lazy_models_for(spark, SF_SMALL).mart_company_timeseries)
    scan = [line for line in text.splitlines() if line.startswith("ReadSchema") and "total_estimated_visits" in line]
    assert scan and "desktop_direct_estimated_visits" not in scan[0]
