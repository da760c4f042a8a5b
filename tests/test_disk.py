"""What queries over traffic leave on disk, and hold there at once."""

import os
import time

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from sitelens import registry
from sitelens.operators import skew
from sitelens.plans import pipeline, state
from sitelens.plans.state import monthly_state, update_state, weighted_by_key
from sitelens.registry import comparable
from sitelens.session import write_table
from sitelens.sources.adapter import load_sources
from sitelens.streaming.incremental import load_increment
from test_adapter import held, shuffle_bytes
from test_skew import plan, skewed


def settled(spark, most):
    """Bytes of shuffle files, once Spark has had time to remove them in the background."""
    for _ in range(50):
        if shuffle_bytes(spark) <= most:
            break
        time.sleep(0.2)
    return shuffle_bytes(spark)


def test_state_in_several_passes_equals_one(spark, scratch, monkeypatch):
    raw = load_sources(spark, SF_SMALL, by_country=True)[1]
    traffic, one, several = (os.path.join(scratch, x) for x in ("t", "one", "several"))
    load_increment(spark, raw, traffic)
    months = update_state(spark, traffic, one)
    seen = []
    monkeypatch.setattr(state, "PASS_ROWS", 1)
    monkeypatch.setattr(state, "monthly_state", lambda rows: (seen.append(rows), monthly_state(rows))[1])
    before, folder = shuffle_bytes(spark), held(spark.sparkContext.getCheckpointDir())
    assert update_state(spark, traffic, several) == months
    assert 6 <= len(seen) <= 10
    assert settled(spark, before + 100_000) <= before + 100_000
    assert held(spark.sparkContext.getCheckpointDir()) <= folder + 20_000
    a, b = (comparable(spark.read.parquet(p)) for p in (one, several))
    assert a.count() == b.count() > 0 and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_passes_hold_their_share(monkeypatch):
    monkeypatch.setattr(state, "PASS_ROWS", 10)
    months = [(2020, m) for m in range(1, 13)]
    got = state._passes(months, {m: 20 for m in months})
    assert [m for some in got for m in some] == months and max(len(some) for some in got) == 1
    got = state._passes(months, {m: 3 for m in months})
    assert [m for some in got for m in some] == months and max(len(some) for some in got) == 3
    assert [some for some in state._passes(months, {months[3]: 1000, months[4]: 1}) if months[3] in some][0][-1] == months[3]
    assert state._passes(months, {}) == [months] and state._passes([], {}) == []


def test_unique_keys_are_not_joined(spark, scratch):
    traffic = os.path.join(scratch, "t")
    load_increment(spark, load_sources(spark, SF_SMALL)[1], traffic)
    rows = weighted_by_key(spark.read.parquet(traffic))
    assert "Join" not in plan(rows) and "Exchange" not in plan(rows)
    assert rows.filter("_weight <> 1").isEmpty()


def test_a_loaded_table_is_gone_once_its_state_is_kept(spark, monkeypatch):
    loaded = []
    monkeypatch.setattr(registry, "_STATES", {})
    monkeypatch.setattr(registry, "load_increment", lambda s, b, path, **o: (loaded.append(path), load_increment(s, b, path, **o))[1])
    rows = registry.QUERIES["company_mart_from_state"](spark, SF_SMALL)
    assert len(loaded) == 2 and not os.path.exists(loaded[0].removeprefix("file:"))
    assert rows.count() > 0


def test_buckets_written_in_passes_equal_one(spark, monkeypatch):
    rows = skewed(spark, 6000)
    before = shuffle_bytes(spark)
    one = skew.write_by_key(rows, "k", 12)
    monkeypatch.setattr(skew, "PASS_ROWS", 100)
    several = skew.write_by_key(rows, "k", 12)
    assert settled(spark, before + 100_000) <= before + 100_000
    for part in ("cold", "hot"):
        a, b = getattr(one, part), getattr(several, part)
        assert a.count() == b.count() > 0 and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    files = [f.rsplit("_", 1)[1].split(".")[0] for f in several.cold.inputFiles()]
    assert len(files) == len(set(files)) <= 12  # a file for each bucket, as from one pass
    assert len({r[0] for r in several.cold.select(F.regexp_extract(F.input_file_name(), "part-.....-(.{36})", 1)).distinct().collect()}) == 4
    assert "Exchange" not in plan(several.cold.groupBy("k").count())
    again = skew.read_by_key(spark, os.path.dirname(several.cold.inputFiles()[0].removeprefix("file://").rstrip("/")).removesuffix("/cold"))
    assert again.cold.count() == several.cold.count()


def test_repeated_keys_in_passes_equal_one(spark, monkeypatch):
    orgs, raw = load_sources(spark, SF_SMALL, by_country=True)
    one = pipeline.build_models(orgs, raw, materialize_tables=True)
    rows = one.matched_traffic
    monkeypatch.setattr(pipeline, "PASS_KEYS", 50)
    several = pipeline.build_models(orgs, raw, materialize_tables=True)
    written = []
    monkeypatch.setattr(pipeline, "write_table", lambda df, name, **o: (written.append((name, df)), write_table(df, name, **o))[1])
    a, b = comparable(rows), comparable(several.matched_traffic)
    parts = [df for name, df in written if name == "matched_traffic"]
    assert 2 < len(parts) <= 8 and len(several.scratch) == len(set(several.scratch))
    assert sum(df.count() for df in parts) == a.count() and max(df.count() for df in parts) < a.count() / 2
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty() and a.filter("_weight > 1").count() > 0
    assert sorted(map(str, comparable(one.mart_category_insights).collect())) == sorted(map(str, comparable(several.mart_category_insights).collect()))


@pytest.mark.parametrize("name", ["several_countries_bridge", "domain_match_salted", "engagement_leader", "overall_quality"])
def test_a_query_leaves_its_table_layers_only(spark, scratch, monkeypatch, name):
    """From the test tables on: no shuffle files, no checkpoints, no copies made on the way."""
    monkeypatch.setattr("sitelens.sources.adapter._MATERIALIZED", {})
    monkeypatch.setattr("sitelens.sources.adapter._derivation_key", lambda *_: f"test-{os.path.basename(scratch)}")
    monkeypatch.setattr(pipeline, "_BUILDS", {})
    folder = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    shuffles, before = shuffle_bytes(spark), set(os.listdir(f"{folder}/tables")) if os.path.isdir(f"{folder}/tables") else set()
    rdds = {d for d in os.listdir(folder) if d.startswith("rdd-")}
    assert registry.QUERIES[name](spark, SF_SMALL).count() > 0
    assert settled(spark, shuffles + 100_000) <= shuffles + 100_000
    assert {d for d in os.listdir(folder) if d.startswith("rdd-")} <= rdds
    layers = {d.rsplit("-", 1)[0] for d in set(os.listdir(f"{folder}/tables")) - before}
    assert layers <= {"organizations_enhanced", "traffic_enhanced", "key_counts"}
