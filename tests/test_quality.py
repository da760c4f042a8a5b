"""Declared checks: counts, seeded defects, severities."""

import pytest

from conftest import SF_SMALL
from sitelens.operators.quality import Check, CheckFailed, raise_on_errors, run_checks
from sitelens.plans.checks import SUITE, suite_counts


def test_declared_counts():
    assert suite_counts() == {"unique": 8, "not_null": 98, "accepted_values": 36, "relationships": 2,
                              "accepted_range": 74, "expression": 12}
    assert sum(len(v) for v in SUITE.values()) == 230


def test_seeded_defects_and_null_rules(spark):
    df = spark.createDataFrame([(1, "a", 0.5), (1, None, 1.5), (2, "z", None)], "k int, v string, r double")
    parent = spark.createDataFrame([(1,)], "k int")
    checks = [Check("unique", "k"), Check("not_null", "v"), Check("accepted_values", "v", values=("a",)),
              Check("accepted_range", "r", min_value=0, max_value=1),
              Check("expression", expression="r <= 1", severity="warn", name="r_le_1"),
              Check("relationships", "k", to_model="p", field="k")]
    got = {(r.check_name, r.column_name): r.failures for r in run_checks("m", df, checks, {"p": parent}).collect()}
    assert got == {("unique", "k"): 1, ("not_null", "v"): 1, ("accepted_values", "v"): 1,
                   ("accepted_range", "r"): 1, ("r_le_1", ""): 1, ("relationships", "k"): 1}


def test_warn_reported_not_raised(spark):
    df = spark.createDataFrame([(2.0,)], "r double")
    warn = run_checks("m", df, [Check("expression", expression="r <= 1", severity="warn")])
    assert raise_on_errors(warn).first().failures == 1
    err = run_checks("m", df, [Check("expression", expression="r <= 1")])
    with pytest.raises(CheckFailed):
        raise_on_errors(err)


def test_suite_on_test_data_finds_known_gaps(spark):
    from sitelens.registry import QUERIES
    res = {(r.model, r.check_name, r.column_name): r.failures
           for r in QUERIES["dq_not_null"](spark, SF_SMALL).collect()}
    # NULL cities pass through canonicalisation and NULL categories form a group.
    assert res[("organizations_enhanced", "not_null", "standardized_city")] >= 0
    assert res[("company_web_bridge", "not_null", "organization_id")] == 0


def test_known_failures_on_test_data(spark):
    """Defects the rules let through, found by the declared checks (sf0.01):
    the NULL category group of the category mart, and the out-of-range
    bounce rate (1.5) averaged into the company and time-series marts."""
    from sitelens.registry import QUERIES
    sf = "/root/testdata/sf0.01"
    failing = {(r.model, r.check_name, r.column_name): r.failures
               for kind in ("dq_not_null", "dq_accepted_range", "dq_unique", "dq_relationships",
                            "dq_accepted_values", "dq_expression")
               for r in QUERIES[kind](spark, sf).filter("failures > 0").collect()}
    assert failing == {
        ("mart_category_insights", "not_null", "main_category"): 1,
        ("mart_company_performance", "accepted_range", "total_bounce_rate"): 8,
        ("mart_company_timeseries", "accepted_range", "first_month_bounce_rate"): 8,
        ("mart_company_timeseries", "accepted_range", "last_month_bounce_rate"): 8,
    }


def test_checks_counted_while_writing(spark):
    from sitelens.operators.quality import ROW_KINDS, WatchedChecks
    from sitelens.session import write_table
    df = spark.createDataFrame([(1, "a", 0.5), (1, None, 1.5), (2, "z", None)], "k int, v string, r double").repartition(3)
    checks = [Check("unique", "k"), Check("not_null", "v"), Check("accepted_values", "v", values=("a",)),
              Check("accepted_range", "r", min_value=0, max_value=1), Check("expression", expression="r <= 1", severity="warn", name="r_le_1")]
    watched = WatchedChecks("m", checks)
    path = write_table(watched.attach(df), "watched")
    assert spark.read.parquet(path).count() == 3 and watched.counts() == [1, 1, 1, 1] == watched.scanned(df)
    rows = [c for c in checks if c.kind in ROW_KINDS]
    assert sorted(watched.results(spark, watched.counts()).collect()) == sorted(run_checks("m", df, rows).collect())
    empty = WatchedChecks("m", checks)
    write_table(empty.attach(df.limit(0)), "watched")
    assert empty.counts() == [0, 0, 0, 0]
    assert WatchedChecks("m", checks[:3]).signature != watched.signature
    assert WatchedChecks("m", checks[:1]).counts() == []


def test_row_checks_of_a_loaded_table_add_up(spark, scratch, monkeypatch):
    import os

    from pyspark.sql import functions as F

    from sitelens.operators.quality import WatchedChecks
    from sitelens.sources.adapter import load_sources
    from sitelens.streaming.incremental import load_checked
    raw = load_sources(spark, SF_SMALL)[1]
    ym = F.col("year") * 100 + F.col("month")
    months = sorted(r[0] for r in raw.select(ym).distinct().collect())
    target = os.path.join(scratch, "t")
    scans, plain = [], WatchedChecks.scanned
    rules = [*SUITE["traffic_enhanced"], Check("expression", expression="traffic_month % 2 = 0", name="even")]  # one that fails

    def spy(self, rows):
        scans.append(1)
        return plain(self, rows)

    monkeypatch.setattr(WatchedChecks, "scanned", spy)
    load = lambda rows, checks=rules, **kw: load_checked(
        spark, rows, target, WatchedChecks("traffic_enhanced", checks), **kw)
    right = lambda checks=rules: plain(WatchedChecks("t", checks), spark.read.parquet(target))
    done, counts = load(raw.filter(ym <= months[-4]))
    assert done.how == "whole" and counts == right() and sum(counts) > 0
    done, counts = load(raw.filter(ym <= months[-2]))
    assert done.how == "append" and counts == right() and not scans
    done, counts = load(raw.filter(ym <= months[-2]))
    assert done.how == "nothing" and counts == right() and not scans
    done, counts = load(raw, lookback_months=1)
    assert done.how == "merge" and counts == right() and len(scans) == 1
    fewer = rules[3:]
    assert load(raw, fewer)[1] == right(fewer) and len(scans) == 2  # other rules
    # A run that broke off after the data: the record is of fewer rows than the table.
    from sitelens.streaming.incremental import load_increment
    load(raw.filter(ym <= months[-3]), full_refresh=True)
    load_increment(spark, raw.filter(ym <= months[-2]), target)
    done, counts = load(raw)
    assert done.how == "append" and counts == right() and len(scans) == 3


def test_a_build_scans_no_table_for_row_checks(spark, scratch, monkeypatch):
    import os

    from sitelens.operators import quality
    from sitelens.plans import pipeline
    from sitelens.registry import QUERIES
    from sitelens.sources.adapter import load_sources
    orgs, raw = load_sources(spark, SF_SMALL)
    orgs.write.parquet(os.path.join(scratch, "orgs"))
    raw.write.parquet(os.path.join(scratch, "traffic"))
    seen, plain = {}, quality.run_checks

    def spy(model, df, checks, parents=None):
        seen[model] = {c.kind for c in checks}
        return plain(model, df, checks, parents)

    monkeypatch.setattr(quality, "run_checks", spy)
    results = pipeline.run_pipeline(spark, os.path.join(scratch, "orgs"), os.path.join(scratch, "traffic"), os.path.join(scratch, "out"))
    tables = ["traffic_enhanced", *pipeline.TABLE_MODELS]
    assert all(seen.get(t, set()) <= {"unique", "relationships"} for t in tables) and "not_null" in seen["stg_traffic"]
    key = lambda rows: sorted((r["model"], r["check_name"], r["column_name"], r["failures"]) for r in rows)
    want = [r for kind in ("unique", "not_null", "accepted_values", "relationships", "accepted_range", "expression")
            for r in QUERIES[f"dq_{kind}"](spark, SF_SMALL).collect()]
    assert key(results.collect()) == key(want) and len(want) == 230
