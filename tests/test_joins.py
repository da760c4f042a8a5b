"""The domain join and the matched-traffic filter give the same rows with and
without broadcasting (the fallback beyond the size budget)."""

import contextlib
import io

from conftest import SF_SMALL
from sitelens.plans.bridge import company_traffic, keyed_organizations, matched_traffic
from sitelens.plans.pipeline import lazy_models_for
from sitelens.registry import comparable
from sitelens.session import scale_conf


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def same(a, b) -> bool:
    a, b = comparable(a), comparable(b).select(*comparable(a).columns)
    return a.count() == b.count() and a.exceptAll(b).count() == 0


def test_domain_join_without_broadcast(spark):
    m = lazy_models_for(spark, SF_SMALL)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        small = company_traffic(m.organizations_enhanced, m.traffic_enhanced, broadcast_budget=0)
        # Only the short list of hot domains is broadcast, for either side; companies are not.
        lines = plan(small).splitlines()
        broadcast = [lines[i + 1] for i, line in enumerate(lines) if "BroadcastExchange" in line]
        assert any("SortMergeJoin" in line for line in lines)
        assert len(broadcast) == 2 and all("_parts" in line and "organization" not in line for line in broadcast)
        assert same(small, company_traffic(m.organizations_enhanced, m.traffic_enhanced))
        keyed = keyed_organizations(m.organizations_enhanced)
        assert same(matched_traffic(keyed, m.traffic_enhanced, broadcast_budget=0),
                    matched_traffic(keyed, m.traffic_enhanced))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_scale_conf(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        n = scale_conf(spark, 100 * 2**40)  # 100 TB
        assert n == 100 * 2**40 // (128 * 2**20)
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == str(128 * 2**20)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
