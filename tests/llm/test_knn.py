import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sitelens.llm import voronoi_knn


def expected(rows, k, scale):
    valid = [(i, v) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    dim = max((len(v) for _, v in valid), default=0)
    ints = [(i, np.floor(np.array([*v, *[0.0] * (dim - len(v))]) * scale).astype(int)) for i, v in valid]
    out, answered = [], set()
    for at, (q, v) in enumerate(ints):
        if q % 5 or (q, tuple(v)) in answered:
            continue
        answered.add((q, tuple(v)))
        best = sorted((-int(v @ w), i) for n, (i, w) in enumerate(ints) if n != at)[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("n,part,group", [(300, 4096, 512), (300, 20, 8), (12, 4096, 512)])
def test_join_equals_all_pairs(spark, monkeypatch, n, part, group):
    monkeypatch.setattr(voronoi_knn, "PART_ROWS", part)
    monkeypatch.setattr(voronoi_knn, "GROUP_ROWS", group)
    rng = random.Random(n + part)
    centres = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(6)]
    rows = [(i, [c + rng.gauss(0, 0.2) for c in rng.choice(centres)]) for i in range(n)]
    rows += [(n + i, rows[0][1]) for i in range(n // 3)]  # a vector that many rows repeat
    rows += [(5, rows[5][1]), (5, rows[6][1]), (None, rows[0][1]), (1000, None), (1005, [None] * 8), (1010, [float("nan")] * 8),
             (1015, [float("inf")] * 8), (1020, [1.0, 2.0]), (1025, [])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("cell", F.lit("own")).repartition(3)
    got = voronoi_knn.knn_join(frame, F.col("vec_id") % 5 == 0, k=4)
    assert sorted(tuple(r) for r in got.select("query_id", "rank", "vec_id", "score").collect()) == expected(rows, 4, 64)


def test_few_rows(spark):
    frame = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in voronoi_knn.knn_join(frame, F.col("vec_id") == 0).collect()] == [(0, 1, 1, 2048)]
    assert voronoi_knn.knn_join(frame.limit(0), F.col("vec_id") == 0).count() == 0
    assert voronoi_knn.knn_join(frame, F.col("vec_id") == 7).count() == 0


def test_large_components_stay_exact():
    q = np.array([[2 ** 30, -3]])
    x = np.array([[2 ** 31, 5], [1, 1]])
    assert voronoi_knn.products(q, x).tolist() == [[2 ** 61 - 15, 2 ** 30 - 3]]


def test_a_third_of_the_queries_in_one_cell(spark, monkeypatch):
    monkeypatch.setattr(voronoi_knn, "PART_ROWS", 64)
    monkeypatch.setattr(voronoi_knn, "GROUP_ROWS", 8)
    best = voronoi_knn.best_in_part

    def bounded(q, x, ids, count):
        assert len(q) <= 24
        return best(q, x, ids, count)

    monkeypatch.setattr(voronoi_knn, "best_in_part", bounded)
    rng = random.Random(4)
    rows = [(i, [1.0 + rng.gauss(0, 0.01)] * 4 if i % 3 == 0 else [rng.gauss(0, 3) for _ in range(4)]) for i in range(900)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = voronoi_knn.knn_join(frame, F.col("vec_id") % 5 == 0, k=4)
    assert sorted(tuple(r) for r in got.select("query_id", "rank", "vec_id", "score").collect()) == expected(rows, 4, 64)
