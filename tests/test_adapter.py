"""The derived raw tables: a hot supplier, missing values, and what stays on disk."""

import os
import time

import duckdb
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from sitelens.operators.ranking import add_row_numbers
from sitelens.registry import ORACLE, comparable
from sitelens.sources.adapter import load_sources, raw_traffic, read_table
from tools.check_oracle import canon, digest


def held(folder):
    total = 0
    for d, _, names in os.walk(str(folder).removeprefix("file:")):
        for name in names:
            try:
                total += os.lstat(f"{d}/{name}").st_size
            except FileNotFoundError:
                pass
    return total


def shuffle_bytes(spark):
    return sum(held(d) for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())


@pytest.fixture
def rewritten(spark, scratch):
    """sf0.001 with a third of all lines at one supplier, shifted orders elsewhere."""
    lines = read_table(spark, SF_SMALL, "lineitem")
    hot = F.when(F.col("l_orderkey") % 3 == 0, F.lit(3)).otherwise(F.col("l_suppkey"))
    lines.withColumn("l_suppkey", hot.cast("long")).write.parquet(f"{scratch}/lineitem.parquet")
    read_table(spark, SF_SMALL, "supplier").write.parquet(f"{scratch}/supplier.parquet")
    return scratch


@pytest.mark.parametrize("partitions", [1, 8, 64])
@pytest.mark.parametrize("by_country", [False, True])
def test_traffic_equals_the_sql_with_a_hot_supplier(spark, rewritten, partitions, by_country):
    con = duckdb.connect()
    for t in ("lineitem", "supplier"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{rewritten}/{t}.parquet/*.parquet')")
    sql = ORACLE["scan_traffic"]()
    if by_country:
        from sitelens import oracle
        from sitelens.schemas import TRAFFIC_RAW
        sql = oracle.pipeline_sql(by_country=True) + oracle.final_select("raw_traffic", [f.name for f in TRAFFIC_RAW.fields])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        s = canon(comparable(raw_traffic(read_table(spark, rewritten, "lineitem"), by_country)).toPandas())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    o = canon(con.execute(sql).df())
    assert list(s.columns) == list(o.columns) and len(s) == len(o) and digest(s) == digest(o)


def test_missing_line_numbers_and_parts(spark):
    """A line without a number is of the plain site; without a part, of no channel and no age."""
    lines = [(1, None, 10, None, 4.0, 0.02), (1, 7, 10, 1, 2.0, 0.02), (2, 7, 10, None, 1.0, None), (None, -3, 10, 2, 5.0, 0.01)]
    rows = spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_discount double")
    got = {r["site"]: r for r in raw_traffic(rows.withColumn("l_shipdate", F.lit("1996-02-29").cast("timestamp"))).collect()}
    assert set(got) == {"supplier10.example.com", "https://www.supplier10.example.com/shop"}
    plain = got["supplier10.example.com"]
    assert (plain["total_estimated_visits"], plain["deduplicated_audience"], plain["global_rank"], plain["month"]) == (10, 3, 1, 2)
    assert plain["total_ages_18_to_24_share"] == 0.0 and plain["total_ages_25_to_34_share"] == pytest.approx(0.1)


def test_the_derivation_leaves_only_its_tables(spark, monkeypatch, scratch):
    """No shuffle files, checkpoints or scratch tables of the derivation stay beside the raw tables."""
    monkeypatch.setattr("sitelens.sources.adapter._MATERIALIZED", {})
    monkeypatch.setattr("sitelens.sources.adapter._derivation_key", lambda *_: f"test-{os.path.basename(scratch)}")
    folder, shuffles = spark.sparkContext.getCheckpointDir(), shuffle_bytes(spark)
    before = held(folder)
    load_sources(spark, SF_SMALL)
    for _ in range(50):  # Spark removes files in the background
        if shuffle_bytes(spark) <= shuffles + 100_000:
            break
        time.sleep(0.2)
    assert shuffle_bytes(spark) <= shuffles + 100_000
    assert held(folder) <= before + 100_000


def test_row_numbers_exchange_the_rows_once(spark):
    df = spark.range(4000).select("id", (F.col("id") % 5).alias("g"), (F.col("id") % 3).alias("h"), F.lit(1).alias("one"),
                                  F.sha2(F.col("id").cast("string"), 256).alias("wide"))
    specs = [("r0", ["one"]), ("r1", ["g", "one"]), ("r2", ["h", "one"]), ("r3", [])]
    scratch = []
    out = add_row_numbers(df, specs, [F.col("wide")], scratch)
    rows = {r["id"]: r for r in out.collect()}
    order = sorted(rows.values(), key=lambda r: r["wide"])
    assert len(rows) == 4000 and len(scratch) == 2
    for name, groups in specs:
        seen = {}
        for r in order:
            at = tuple(r[g] for g in groups)
            seen[at] = seen.get(at, 0) + 1
            assert r[name] == seen[at]
    assert "wide" in spark.read.parquet(scratch[0]).columns and "wide" not in spark.read.parquet(scratch[1]).columns
