import math

import pytest
from conftest import AWKWARD
from pyspark.sql import functions as F

from sitelens.llm import mixture


def corpus(spark):
    rows = [(i, " ".join(["w"] * (1 + i * 7 % 50)), "abcde"[i % 5] if i % 3 else "a") for i in range(600)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_targets_are_met(spark):
    out = mixture.mixed(corpus(spark))
    got = out.groupBy("source").agg(F.sum("size").alias("size"), F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()
    assert sum(r["target"] for r in got) == pytest.approx(sum(r["size"] for r in got))
    for r in got:
        assert abs(r["taken"] - r["target"]) <= 1 and r["target"] <= 3 * r["size"]
    assert out.filter("taken > 3 * size").isEmpty()


def test_reshare_stops_at_the_cap(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 990), (None, 0)], "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixture.source_targets(sizes).collect()}
    assert got["a"] == 30.0 and got[None] == 0.0
    assert got["b"] == pytest.approx(1970 * 2 / 3) and got["c"] == pytest.approx(1970 / 3)


def test_positions_invert_the_schedule(spark):
    shares = [i / 200 for i in range(201)]
    frame = spark.createDataFrame([(s, k) for s in shares for k in range(3)], "s double, k int")
    for r in frame.withColumn("t", mixture.position(F.col("s"), F.col("k"))).collect():
        knots = mixture.SCHEDULES[r["k"]]
        area = 0.0
        for (t0, r0), (t1, r1) in zip(knots, knots[1:]):
            t = min(max(r["t"], t0), t1)
            area += (t - t0) * (r0 + r0 + (r1 - r0) * (t - t0) / (t1 - t0)) / 2
        assert area == pytest.approx(r["s"], abs=1e-9)


def test_order_and_reruns(spark):
    mix = mixture.mixed(corpus(spark))
    rows = mixture.training_order(mix).select("doc_id", "pass", "position", "words").collect()
    assert [r["position"] for r in rows] == sorted(r["position"] for r in rows)
    assert all(0 <= r["position"] <= 1 for r in rows)
    again = mixture.training_order(mixture.mixed(corpus(spark).repartition(7))).select("doc_id", "pass", "position", "words").collect()
    assert rows == again


def test_whole_documents(spark):
    mix = mixture.mixed(corpus(spark), cut=False, keep=["text"])
    assert mix.filter("size > 0 AND taken % size <> 0").isEmpty() and "text" in mix.columns


def test_awkward_rows(spark):
    rows = [(i, t, s) for i, t in AWKWARD for s in ("a", None)]
    out = mixture.mixed(spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit("own")))
    got = out.collect()
    assert len(got) == len(rows) and all(math.isfinite(r["target"]) for r in got)
    assert all(r["size"] == 0 for r in got if r["doc_id"] in (1, 2, 3))


def test_empty_and_wordless(spark):
    none = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixture.mixed(none).count() == 0 and mixture.training_order(mixture.mixed(none)).count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, " ", "b")], "doc_id long, text string, source string")
    assert [(r["size"], r["target"], r["taken"]) for r in mixture.mixed(blank).collect()] == [(0, 0.0, 0)] * 2


def test_query_rows_come_in_training_order(spark):
    from conftest import SF_SMALL

    from sitelens.llm.queries import QUERIES

    got = [r["doc_id"] for r in QUERIES["op2_mixture"](spark, SF_SMALL).collect()]
    mix = mixture.mixed(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))
    order = list(dict.fromkeys(r["doc_id"] for r in mixture.training_order(mix).select("doc_id").collect()))
    assert len(order) > 20 and got[:len(order)] == order
    assert sorted(got[len(order):]) == sorted(r["doc_id"] for r in mix.filter("size(uses) = 0").select("doc_id").collect())
