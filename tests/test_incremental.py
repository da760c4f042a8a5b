"""High-water mark, upsert, month-by-month loads and the streaming form."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from sitelens.operators.upsert import DuplicateKeyError, assert_unique, late_rows, newer_than, upsert
from sitelens.plans.pipeline import lazy_models_for
from sitelens.registry import comparable
from sitelens.schemas import SchemaDriftError, without_audit
from sitelens.sources.adapter import load_sources
from sitelens.streaming.incremental import load_increment, start_stream


def _ym(df):
    return df.withColumn("p", F.col("traffic_year") * 100 + F.col("traffic_month"))


def test_high_water_mark_rules(spark):
    target = spark.createDataFrame([(2023, 12), (2023, 3)], "traffic_year int, traffic_month int")
    batch = spark.createDataFrame([(2023, 12), (2024, 1), (2023, 11)], "traffic_year int, traffic_month int")
    assert [tuple(r) for r in newer_than(batch, target).collect()] == [(2024, 1)]
    empty = target.limit(0)
    assert newer_than(batch, empty).count() == 3
    assert newer_than(batch, empty, strict=True).count() == 0
    assert newer_than(batch, None).count() == 3


def test_upsert_replaces_and_inserts(spark):
    t = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v long")
    b = spark.createDataFrame([("b", 20), ("c", 3)], "k string, v long")
    assert sorted(tuple(r) for r in upsert(t, b, "k").collect()) == [("a", 1), ("b", 20), ("c", 3)]
    with pytest.raises(DuplicateKeyError):
        assert_unique(spark.createDataFrame([("a", 1), ("a", 2)], "k string, v long"), "k")
    with pytest.raises(SchemaDriftError):
        upsert(t, b.withColumn("extra", F.lit(1)), "k")


def test_month_by_month_equals_full_build(spark, scratch):
    raw = load_sources(spark, SF_SMALL)[1]
    full = without_audit(lazy_models_for(spark, SF_SMALL).traffic_enhanced)
    months = sorted(tuple(r) for r in raw.select("year", "month").distinct().collect())
    target = os.path.join(scratch, "traffic")
    # First load: everything up to the middle month, then the remaining months one at a time.
    cut = months[len(months) // 2]
    load_increment(spark, raw.filter(F.col("year") * 100 + F.col("month") <= cut[0] * 100 + cut[1]), target)
    for y, m in months[len(months) // 2 + 1:len(months) // 2 + 4]:
        load_increment(spark, raw.filter((F.col("year") * 100 + F.col("month")) <= y * 100 + m), target)
    load_increment(spark, raw, target)
    loaded = without_audit(spark.read.parquet(target)).select(*full.columns)
    assert loaded.count() == full.count()
    assert loaded.exceptAll(full).count() == 0 and full.exceptAll(loaded).count() == 0
    # Re-running with the same input loads nothing.
    assert load_increment(spark, raw, target).loaded == 0


def test_late_rows_are_reported(spark):
    m = lazy_models_for(spark, SF_SMALL)
    full = _ym(m.traffic_enhanced)
    newest = full.agg(F.max("p")).first()[0]
    # Target missing one older site's rows: those rows are late forever.
    target = full.filter((F.col("p") < newest) & (F.col("site_domain") != "supplier1.example.com"))
    staged = m.stg_traffic.filter(F.col("total_visits") > 0)
    late = late_rows(staged, target, "web_traffic_id")
    expect = full.filter((F.col("p") < newest) & (F.col("site_domain") == "supplier1.example.com")).count()
    assert late.count() == expect > 0
    assert newer_than(staged, target).filter(F.col("site_domain") == "supplier1.example.com").count() <= 1


def test_streaming_available_now(spark, scratch):
    raw = load_sources(spark, SF_SMALL)[1]
    src = os.path.join(scratch, "incoming")
    first = raw.filter(F.col("year") < 1998)
    first.write.parquet(os.path.join(src, "part-a"))
    target = os.path.join(scratch, "target")
    q = start_stream(spark, src + "/*", target, os.path.join(scratch, "ckpt"))
    q.awaitTermination(300)
    assert spark.read.parquet(target).count() == first.filter(F.col("total_estimated_visits") > 0).count()
    raw.filter(F.col("year") >= 1998).write.parquet(os.path.join(src, "part-b"))
    q = start_stream(spark, src + "/*", target, os.path.join(scratch, "ckpt"))
    q.awaitTermination(300)
    assert spark.read.parquet(target).count() == raw.filter(F.col("total_estimated_visits") > 0).count()


def test_run_pipeline_end_to_end(spark, scratch):
    from sitelens.plans.pipeline import TABLE_MODELS, run_pipeline
    orgs, traffic = load_sources(spark, SF_SMALL)
    orgs.write.parquet(os.path.join(scratch, "orgs"))
    traffic.write.parquet(os.path.join(scratch, "traffic"))
    out = os.path.join(scratch, "out")
    res = run_pipeline(spark, os.path.join(scratch, "orgs"), os.path.join(scratch, "traffic"), out)
    assert res.count() == 230
    lazy = lazy_models_for(spark, SF_SMALL)
    for name in TABLE_MODELS + ["traffic_enhanced"]:
        built = comparable(spark.read.parquet(os.path.join(out, name)))  # floating sums: order-free view
        expect = comparable(getattr(lazy, name)).select(*built.columns)
        assert built.exceptAll(expect).count() == 0 and expect.exceptAll(built).count() == 0, name
    # A second run with no new months loads nothing new and rebuilds the same marts.
    run_pipeline(spark, os.path.join(scratch, "orgs"), os.path.join(scratch, "traffic"), out, run_checks=False)
    assert spark.read.parquet(os.path.join(out, "traffic_enhanced")).count() == lazy.traffic_enhanced.count()


def test_lookback_merges_late_rows(spark, scratch):
    from sitelens.operators.upsert import months_back
    assert months_back((2024, 2), 3) == (2023, 11) and months_back((2024, 1), 0) == (2024, 1)
    raw = load_sources(spark, SF_SMALL)[1]
    ym = F.col("year") * 100 + F.col("month")
    newest = raw.agg(F.max(ym)).first()[0]
    target = os.path.join(scratch, "t")
    # First load misses one site's rows of the newest month; they arrive late.
    late_site = "supplier1.example.com"
    load_increment(spark, raw.filter(~((ym == newest) & (F.col("site") == late_site))), target)
    before = spark.read.parquet(target).count()
    gated = load_increment(spark, raw, target)  # month gate: late rows stay out, and are reported
    assert gated.loaded == 0 and {r["site_domain"] for r in gated.late.collect()} == {late_site}
    again = load_increment(spark, raw, target, lookback_months=1)  # reprocess the newest month
    loaded = again.loaded
    assert again.late.count() == 0
    after = spark.read.parquet(target)
    expect = raw.filter((ym == newest) & (F.col("site") == late_site) & (F.col("total_estimated_visits") > 0)).count()
    assert after.count() == before + expect and loaded >= expect
    assert after.groupBy("web_traffic_id").count().filter("count > 1").count() == 0


def test_recorded_mark_missing_or_stale(spark, scratch):
    from sitelens.streaming.incremental import MARK_DIR, _record_mark, recorded_mark
    raw = load_sources(spark, SF_SMALL)[1]
    ym = F.col("year") * 100 + F.col("month")
    months = sorted(r[0] for r in raw.select(ym).distinct().collect())
    target = os.path.join(scratch, "t")
    load_increment(spark, raw.filter(ym <= months[-3]), target)
    assert recorded_mark(spark, target) == divmod(months[-3], 100)
    # A target written without a mark: the mark is aggregated from the data.
    plain = os.path.join(scratch, "plain")
    spark.read.parquet(target).write.partitionBy("traffic_year", "traffic_month").parquet(plain)
    assert load_increment(spark, raw, plain).loaded > 0
    assert recorded_mark(spark, plain) == divmod(months[-1], 100)
    # A stale mark (crash after the data commit): rows are re-merged, never duplicated.
    _record_mark(spark, target, divmod(months[-4], 100))
    load_increment(spark, raw, target)
    t = spark.read.parquet(target)
    assert t.count() == t.select("web_traffic_id").distinct().count()
    assert t.count() == spark.read.parquet(plain).count()
    assert MARK_DIR not in t.columns


def _small(spark):
    raw = load_sources(spark, SF_SMALL)[1]
    ym = F.col("year") * 100 + F.col("month")
    return raw, ym, sorted(r[0] for r in raw.select(ym).distinct().collect())


def test_an_unreadable_file_is_not_an_empty_target(spark, scratch):
    import glob
    raw, ym, months = _small(spark)
    target = os.path.join(scratch, "t")
    load_increment(spark, raw.filter(ym <= months[20]), target)
    files = sorted(glob.glob(f"{target}/*/*/*.parquet"))
    before = {f: open(f, "rb").read() for f in files}
    for damaged in files:  # whichever file Spark reads the schema from
        with open(damaged, "wb") as fh:
            fh.write(b"not parquet")
    with pytest.raises(Exception):
        load_increment(spark, raw.filter(ym == months[21]), target)
    for f, content in before.items():
        with open(f, "wb") as fh:
            fh.write(content)
    for f in glob.glob(f"{target}/*/*/.*.crc"):
        os.remove(f)
    spark.catalog.clearCache()
    spark.catalog.refreshByPath(target)
    assert sorted(glob.glob(f"{target}/*/*/*.parquet")) == files
    assert spark.read.parquet(target).filter(F.col("traffic_year") * 100 + F.col("traffic_month") <= months[20]).count() == raw.filter(
        (ym <= months[20]) & (F.col("total_estimated_visits") > 0)).count()


def test_an_unreadable_folder_raises(spark, scratch, monkeypatch):
    from pyspark.errors import AnalysisException

    from sitelens.operators import tables
    raw, ym, months = _small(spark)
    target = os.path.join(scratch, "t")
    load_increment(spark, raw.filter(ym <= months[3]), target)
    rows = spark.read.parquet(target).count()

    class Denied(AnalysisException):
        def __init__(self):
            Exception.__init__(self, "permission denied")

        def getCondition(self):
            return "FAILED_READ_FILE.NO_HINT"

    class Reader:
        def parquet(self, path):
            raise Denied()

    class Session:
        read = Reader()

    with pytest.raises(Denied):
        tables.read_if_exists(Session(), target)
    assert spark.read.parquet(target).count() == rows


def test_schema_drift_raises_both_ways(spark, scratch):
    raw, ym, months = _small(spark)
    good = os.path.join(scratch, "good")
    load_increment(spark, raw.filter(ym <= months[2]), good)
    t = spark.read.parquet(good)
    for name, changed in (("less", t.drop("male_share")), ("more", t.withColumn("surplus", F.lit(1))),
                          ("type", t.withColumn("total_visits", F.col("total_visits").cast("string")))):
        path = os.path.join(scratch, name)
        changed.write.partitionBy("traffic_year", "traffic_month").parquet(path)
        with pytest.raises(SchemaDriftError):
            load_increment(spark, raw.filter(ym == months[3]), path)
        assert spark.read.parquet(path).count() == t.count()


def test_new_months_are_written_once_and_history_stays(spark, scratch):
    import glob
    raw, ym, months = _small(spark)
    target = os.path.join(scratch, "t")
    load_increment(spark, raw.filter(ym <= months[-3]), target)
    before = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{target}/traffic_year=*/*/*.parquet")}
    done = load_increment(spark, raw.filter(ym <= months[-1]), target)
    assert [y * 100 + m for y, m in done.months] == months[-2:]
    after = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{target}/traffic_year=*/*/*.parquet")}
    assert before.items() <= after.items() and len(after) > len(before)


def test_the_merge_reads_touched_months_only(spark, scratch):
    from sitelens.operators.upsert import in_months
    raw, ym, months = _small(spark)
    target = os.path.join(scratch, "t")
    load_increment(spark, raw, target)
    plan = spark.read.parquet(target).filter(in_months([divmod(m, 100) for m in months[-2:]]))
    text = plan._jdf.queryExecution().executedPlan().toString()
    filters = text[text.index("PartitionFilters"):text.index("PushedFilters")]
    assert str(months[-1] // 100) in filters and len(plan.inputFiles()) >= 1


def test_full_refresh_reloads_old_months(spark, scratch):
    raw, ym, months = _small(spark)
    target = os.path.join(scratch, "t")
    wrong = raw.withColumn("total_estimated_visits", F.when(ym == months[0], F.col("total_estimated_visits") + 1000)
                           .otherwise(F.col("total_estimated_visits")))
    load_increment(spark, wrong, target)
    assert load_increment(spark, raw, target).loaded == 0
    done = load_increment(spark, raw, target, full_refresh=True)
    good = without_audit(lazy_models_for(spark, SF_SMALL).traffic_enhanced)
    now = without_audit(spark.read.parquet(target)).select(*good.columns)
    assert done.loaded == good.count() and now.exceptAll(good).count() == 0 and good.exceptAll(now).count() == 0
    assert not [d for d in os.listdir(scratch) if d != "t"]


def test_replaced_table_survives_a_broken_run(spark, scratch):
    from sitelens.operators.tables import recover, replace_table
    path = os.path.join(scratch, "t")
    replace_table(spark.range(5).toDF("x"), path)
    with pytest.raises(Exception):  # the write fails: the former table is untouched
        replace_table(spark.range(5).selectExpr("raise_error('x') AS x"), path)
    assert spark.read.parquet(path).count() == 5
    os.rename(path, path + ".former")  # as if killed between the two renames
    recover(spark, path)
    assert spark.read.parquet(path).count() == 5
    replace_table(spark.read.parquet(path).filter("x > 1"), path)  # may read what it replaces
    assert spark.read.parquet(path).count() == 3


def test_stream_reports_late_rows(spark, scratch):
    raw, ym, months = _small(spark)
    src, target, late = (os.path.join(scratch, x) for x in ("in", "t", "late"))
    site = "supplier1.example.com"
    raw.filter((ym <= months[5]) & (F.col("site") != site)).write.parquet(os.path.join(src, "a"))
    start_stream(spark, src + "/*", target, os.path.join(scratch, "c"), late_path=late).awaitTermination(300)
    raw.filter(ym <= months[6]).write.parquet(os.path.join(src, "b"))
    start_stream(spark, src + "/*", target, os.path.join(scratch, "c"), late_path=late).awaitTermination(300)
    expect = raw.filter((ym <= months[5]) & (F.col("site") == site) & (F.col("total_estimated_visits") > 0)).count()
    assert spark.read.parquet(late).count() == expect > 0


def _spied(monkeypatch):
    """Months and plan of every late report."""
    from sitelens.streaming import incremental
    seen, plain = [], incremental.late_rows

    def spy(*args, **kw):
        rows = plain(*args, **kw)
        seen.append((kw["months"], rows._jdf.queryExecution().executedPlan().toString()))
        return rows

    monkeypatch.setattr(incremental, "late_rows", spy)
    return seen


def test_manifest_follows_the_table(spark, scratch):
    from sitelens.operators import manifest
    raw, ym, months = _small(spark)
    target = os.path.join(scratch, "t")
    load_increment(spark, raw.filter(ym <= months[-4]), target)
    load_increment(spark, raw.filter(ym <= months[-2]), target)
    load_increment(spark, raw, target, lookback_months=3)
    table = spark.read.parquet(target)
    held = manifest.recorded(spark, target)
    assert held == manifest.fingerprints(table, "web_traffic_id", "traffic_year", "traffic_month")
    assert sum(f.rows for f in held.values()) == table.count() and {f.most for f in held.values()} == {1}
    least = table.agg(F.min("web_traffic_id")).first()[0]
    found = manifest.fingerprints(table.filter(F.col("web_traffic_id") != least), "web_traffic_id", "traffic_year", "traffic_month")
    assert len(manifest.differing(found, held)) == 1 and manifest.differing(held, held) == []


def test_late_report_reads_no_month_that_is_whole(spark, scratch, monkeypatch):
    raw, ym, months = _small(spark)
    target = os.path.join(scratch, "t")
    load_increment(spark, raw.filter(ym <= months[-3]), target)
    seen = _spied(monkeypatch)
    done = load_increment(spark, raw.filter(ym == months[-2]), target)  # one new month
    assert seen[-1][0] == [] and done.late.isEmpty() and done.loaded > 0
    done = load_increment(spark, raw, target)  # all history comes again, all of it is held
    assert seen[-1][0] == [] and done.late.isEmpty()


def test_late_report_reads_the_month_that_differs(spark, scratch, monkeypatch):
    raw, ym, months = _small(spark)
    target, site = os.path.join(scratch, "t"), "supplier1.example.com"
    gone = (ym == months[7]) & (F.col("site") == site)
    load_increment(spark, raw.filter((ym <= months[-3]) & ~gone), target)
    seen = _spied(monkeypatch)
    done = load_increment(spark, raw, target)
    late, plan = seen[-1]
    assert late == [divmod(months[7], 100)] and done.late.count() == raw.filter(gone).count() > 0
    filters = [part[:part.index("]")] for part in plan.split("PartitionFilters: ")[1:]]
    assert any(f"= {months[7] // 100})" in f for f in filters), filters  # the month itself is cut off in the plan's text
    # Without a record every month is looked at, with the same result.
    from sitelens.operators import manifest
    manifest.record(spark, target, {})
    done = load_increment(spark, raw, target)
    assert len(seen[-1][0]) == len(months) and done.late.count() == raw.filter(gone).count()


def test_several_rows_of_a_key_load_and_merge_together(spark, scratch):
    raw, ym, months = _small(spark)
    target = os.path.join(scratch, "t")
    two = raw.unionByName(raw.filter(F.col("site").endswith("3.example.com")).withColumn("country", F.lit("Elsewhere")))
    visited = two.filter("total_estimated_visits > 0")
    load_increment(spark, two.filter(ym <= months[-2]), target)
    done = load_increment(spark, two, target, lookback_months=2)
    table = spark.read.parquet(target)
    assert table.count() == visited.count() and done.late.isEmpty()
    assert table.groupBy("web_traffic_id", "site_country").count().filter("count > 1").isEmpty()
    # The corrected month has the site in one country only: both its rows go.
    load_increment(spark, raw, target, lookback_months=1)
    assert spark.read.parquet(target).filter(F.col("traffic_year") * 100 + F.col("traffic_month") == months[-1]).count() == raw.filter(
        (ym == months[-1]) & (F.col("total_estimated_visits") > 0)).count()
    with pytest.raises(DuplicateKeyError):
        load_increment(spark, two, os.path.join(scratch, "u"), refuse_duplicates=True)


def _commits(ckpt):
    return sorted((f for f in os.listdir(os.path.join(ckpt, "commits")) if f.isdigit()), key=int)


def _forget_last_commit(ckpt):
    """As if the driver had died before Spark noted the last batch as done."""
    last = _commits(ckpt)[-1]
    for f in (last, f".{last}.crc"):
        if os.path.exists(os.path.join(ckpt, "commits", f)):
            os.remove(os.path.join(ckpt, "commits", f))


@pytest.mark.parametrize("broken", ["before late rows", "before the record", "after all"])
def test_a_replayed_batch_counts_once(spark, scratch, monkeypatch, broken):
    from sitelens.streaming import incremental
    raw, ym, months = _small(spark)
    src, target, late, ckpt = (os.path.join(scratch, x) for x in ("in", "t", "late", "c"))
    site = F.col("site") == "supplier1.example.com"
    raw.filter((ym <= months[5]) & ~site).write.parquet(os.path.join(src, "a"))
    start_stream(spark, src + "/*", target, ckpt, late_path=late).awaitTermination(300)
    raw.filter(ym <= months[6]).write.parquet(os.path.join(src, "b"))

    if broken != "after all":
        name = "_folder_of" if broken == "before late rows" else "_record_batch"
        plain = getattr(incremental, name)

        def fail(*args):
            raise RuntimeError("driver lost")

        monkeypatch.setattr(incremental, name, fail)
        query = start_stream(spark, src + "/*", target, ckpt, late_path=late)
        with pytest.raises(Exception):
            query.awaitTermination(300)
        monkeypatch.setattr(incremental, name, plain)
    else:
        start_stream(spark, src + "/*", target, ckpt, late_path=late).awaitTermination(300)
        _forget_last_commit(ckpt)
    start_stream(spark, src + "/*", target, ckpt, late_path=late).awaitTermination(300)
    positive = F.col("total_estimated_visits") > 0
    assert spark.read.parquet(late).count() == raw.filter((ym <= months[5]) & site & positive).count() > 0
    table = spark.read.parquet(target)
    assert table.count() == table.select("web_traffic_id").distinct().count()
    assert table.count() == raw.filter(positive & (((ym <= months[5]) & ~site) | (ym == months[6]))).count()


def test_a_refresh_by_a_stream_is_kept_or_refused(spark, scratch, monkeypatch):
    from sitelens.streaming import incremental
    from sitelens.streaming.incremental import RefreshRefused
    raw, ym, months = _small(spark)
    src, target, ckpt = (os.path.join(scratch, x) for x in ("in", "t", "c"))
    wrong = raw.withColumn("total_estimated_visits", F.col("total_estimated_visits") * 2)
    load_increment(spark, wrong.filter(ym <= months[5]), target)
    raw.filter(ym <= months[5]).write.parquet(os.path.join(src, "a"))

    def fail(*args):
        raise RuntimeError("driver lost")

    plain = incremental._record_batch
    monkeypatch.setattr(incremental, "_record_batch", fail)
    with pytest.raises(Exception):
        start_stream(spark, src + "/*", target, ckpt, full_refresh=True).awaitTermination(300)
    monkeypatch.setattr(incremental, "_record_batch", plain)
    # The first batch runs again and is still a refresh.
    start_stream(spark, src + "/*", target, ckpt, full_refresh=True).awaitTermination(300)
    total = lambda: spark.read.parquet(target).agg(F.sum("total_visits")).first()[0]
    assert total() == raw.filter(ym <= months[5]).agg(F.sum("total_estimated_visits")).first()[0]
    # The same command again goes on with new files; the refresh is done.
    raw.filter(ym == months[6]).write.parquet(os.path.join(src, "b"))
    start_stream(spark, src + "/*", target, ckpt, full_refresh=True).awaitTermination(300)
    assert total() == raw.filter(ym <= months[6]).agg(F.sum("total_estimated_visits")).first()[0]
    # A stream that began without a refresh can't make one.
    other = os.path.join(scratch, "c2")
    start_stream(spark, src + "/*", target, other).awaitTermination(300)
    with pytest.raises(RefreshRefused):
        start_stream(spark, src + "/*", target, other, full_refresh=True)
