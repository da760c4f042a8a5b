"""Aggregate tie rules and the distributed row numbering."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from sitelens.operators.aggregates import dominant, first_by, label_counts, last_by, row_order, top_label
from sitelens.operators.ranking import add_row_numbers, grouped_row_number


def test_dominant_smallest_wins_tie(spark):
    df = spark.createDataFrame([(1, v) for v in ["b", "a", "a", "b", None, None, None]], "g int, v string")
    assert df.groupBy("g").agg(dominant("v")).first()[1] == "a"


def test_first_last_keep_null_and_break_ties(spark):
    rows = [("o", 2024, 1, "id2", 5), ("o", 2024, 1, "id1", None), ("o", 2024, 3, "id3", 7)]
    df = spark.createDataFrame(rows, "o string, y int, m int, id string, v long")
    order = row_order("y", "m", "id")
    r = df.groupBy("o").agg(first_by("v", order).alias("f"), last_by("v", order).alias("l")).first()
    assert r["f"] is None and r["l"] == 7


def _reference_numbers(df, groups, order):
    w = Window.partitionBy(*groups).orderBy(*order)
    return {(r["id"]): r["rn"] for r in df.withColumn("rn", F.row_number().over(w)).collect()}


def test_grouped_row_number_matches_window_with_hot_group(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        g = "hot" if i % 3 == 0 else (None if i % 17 == 0 else f"g{rnd.randint(0, 30)}")
        rows.append((i, g, rnd.randint(0, 50)))
    df = spark.createDataFrame(rows, "id long, g string, v long")
    order = [F.col("v").desc(), F.col("id").asc()]
    got = {r["id"]: r["rn"] for r in grouped_row_number(df, ["g"], order, "rn", num_partitions=7).collect()}
    assert got == _reference_numbers(df, ["g"], order)


def test_add_row_numbers_equals_windows(spark):
    rnd = random.Random(3)
    df = spark.createDataFrame([(i, f"c{i % 4}", i % 2, rnd.randint(0, 9)) for i in range(500)],
                               "id long, c string, y int, v long")
    order = [F.col("v").desc(), F.col("id")]
    got = add_row_numbers(df, [("r1", ["y"]), ("r2", ["c", "y"])], order).collect()
    assert {r["id"]: r["r1"] for r in got} == _reference_numbers(df, ["y"], order)
    assert {r["id"]: r["r2"] for r in got} == _reference_numbers(df, ["c", "y"], order)


def test_top_label_is_the_mode_of_a_closed_set(spark):
    rows = [(1, v) for v in ["b", "a", "a", "b", None]] + [(2, None), (3, "c")]
    df = spark.createDataFrame(rows, "g int, v string")
    labels = ["a", "b", "c"]
    got = df.groupBy("g").agg(*label_counts("v", labels, "n")).select("g", top_label("n", labels).alias("m"))
    want = df.groupBy("g").agg(dominant("v").alias("m"))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
