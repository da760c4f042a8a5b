"""Exact top-k inner-product search as a Voronoi join.

Pivots cut the space into cells; every vector belongs to its nearest pivot.
For each cell a summary holds its radius and the distances of its ``k + 1``
members nearest to the pivot. For a query q and a member x of the cell of
pivot p, q.p - |q| d(x, p) <= q.x <= q.p + |q| d(x, p), so the summaries give
a score that the query's k-th best cannot be below, and for each cell a score
no member can be above. Queries are grouped by the pivots nearest to them; a
cell's data is copied only to query groups with a query it may serve. Each
(query group, part of a cell) is solved on its own by a matrix product, and the
best of all parts are ranked.

Pivots are a bounded sample (at most ``MAX_PIVOTS`` vectors, the smallest by a
hash), so pivots and summaries fit any task; they change the work, not the
result. Cells and query groups are dealt to parts of bounded size by a hash of
the id, so a vector that a third of the rows repeat fills many parts.

Defined cases: vectors that are null or hold null or non-finite components,
and rows with a null id, take no part; shorter vectors are padded with zeros;
equal scores go to the smaller id; a query's own row is no candidate, other
rows with its id are; a query row that is repeated is answered once. An empty
table gives an empty result. Scores are exact while they fit 63 bits.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sitelens.session import materialize

MAX_PIVOTS = 1024
PART_ROWS = 4096
GROUP_ROWS = 512


def quantised(table: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(vec_id, v): floor(scale * component) of the valid vectors."""
    x = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    valid = F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & F.forall(
        x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return (table.filter(valid).select(F.col(id_col).cast("long").alias("vec_id"),
                                       F.transform(x, lambda c: F.floor(c * scale)).alias("v")))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of an Arrow list column, padded to ``dim``."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(sizes) and (sizes == dim).all():
        return flat.reshape(-1, dim)
    out = np.zeros((len(sizes), dim), np.int64)
    for i, (row, n) in enumerate(zip(np.split(flat, np.cumsum(sizes)[:-1]), sizes)):
        out[i, :n] = row
    return out


def _unpacked(column: pd.Series, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.int64).reshape(-1, dim)


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer inner products (by doubles where these are exact)."""
    most = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * q.shape[1]
    if most < 2 ** 53:
        return (q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    return q @ x.T


def assigned(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """(vec_id, v as bytes, cell, distance): every vector with its nearest pivot."""
    shared = vectors.sparkSession.sparkContext.broadcast(pivots)  # MAX_PIVOTS vectors at most
    dim = pivots.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = shared.value.astype(np.float64)
        norms = (p * p).sum(1)
        for b in batches:
            v = _matrix(b.column(1), dim)
            x = v.astype(np.float64)
            cell = np.concatenate([np.zeros(0, np.int64), *[(norms - 2 * x[i:i + 1024] @ p.T).argmin(1) for i in range(0, len(x), 1024)]])
            distance = np.sqrt(((x - p[cell]) ** 2).sum(1))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([r.tobytes() for r in v], pa.binary()), pa.array(cell.astype(np.int32)), pa.array(distance)],
                ["vec_id", "v", "cell", "distance"])

    return vectors.mapInArrow(run, "vec_id long, v binary, cell int, distance double")


def best_in_part(q: np.ndarray, x: np.ndarray, ids: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each query row the ``count`` best of x by (score, smaller id): query rows, x rows, scores."""
    scores = products(q, x)
    rows, cols = [], []
    for i, s in enumerate(scores):
        at = np.arange(len(s)) if len(s) <= count else np.flatnonzero(s >= np.partition(s, len(s) - count)[len(s) - count])
        at = at[np.lexsort((ids[at], -s[at]))[:count]]
        rows.append(np.full(len(at), i))
        cols.append(at)
    rows, cols = np.concatenate(rows), np.concatenate(cols)
    return rows, cols, scores[rows, cols]


def knn_join(table: DataFrame, is_query, k: int = 20, scale: int = 64, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best rows for each row that fits ``is_query`` (a condition on vec_id)."""
    spark = table.sparkSession
    vectors = quantised(table, id_col, vector_col, scale)
    total = vectors.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("dim"),
                        F.sum(is_query.cast("long")).alias("queries")).first()
    dim, n_queries = total["dim"] or 0, total["queries"] or 0
    n_pivots = max(1, min(MAX_PIVOTS, math.isqrt(total["n"]) // 2))
    picked = vectors.select("v", F.xxhash64("v").alias("h")).distinct().orderBy("h", "v").limit(n_pivots).collect()
    if not picked or not dim:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    pivots = np.array([list(r["v"]) + [0] * (dim - len(r["v"])) for r in picked], np.int64)
    p = pivots.astype(np.float64)

    placed = materialize(assigned(vectors, pivots), "knn_cells")
    near = Window.partitionBy("cell").orderBy("distance")
    part_of = F.pmod(F.xxhash64("vec_id"), F.lit(64)).cast("int")
    # The nearest members of a cell: of 64 parts of it first, then of the cell.
    nearest = (placed.select("cell", "distance", part_of.alias("deal"))
               .withColumn("r", F.row_number().over(Window.partitionBy("cell", "deal").orderBy("distance"))).filter(F.col("r") <= k + 1)
               .withColumn("r", F.row_number().over(near)).filter(F.col("r") <= k + 1)
               .groupBy("cell").agg(F.array_sort(F.collect_list("distance")).alias("nearest")))
    summary = placed.groupBy("cell").agg(F.max("distance").alias("radius"), F.count(F.lit(1)).alias("n")).join(nearest, "cell")
    cells = [(r["cell"], r["radius"], r["n"], r["nearest"]) for r in summary.collect()]  # MAX_PIVOTS rows at most
    cell_ids = np.array([c[0] for c in cells])
    radius = np.array([c[1] for c in cells])
    low_cell = np.concatenate([np.full(len(c[3]), i) for i, c in enumerate(cells)])
    low_distance = np.concatenate([np.array(c[3]) for c in cells])
    parts = np.array([max(1, -(-c[2] // PART_ROWS)) for c in cells])

    # Query groups: a few pivots lead, every cell's queries go with the leader nearest to its pivot.
    leaders = p[:max(1, min(len(p), n_queries // GROUP_ROWS))]
    leader = ((p[:, None, :] - leaders[None]) ** 2).sum(-1).argmin(1).astype(np.int32) if len(p) * len(leaders) * dim < 5e7 else np.array(
        [((leaders - row) ** 2).sum(1).argmin() for row in p], np.int32)
    book = spark.sparkContext.broadcast((p[cell_ids], radius, low_cell, low_distance, cell_ids, parts, leader))

    queries = placed.filter(is_query).select("vec_id", "v", "cell").distinct()
    # Every leader's queries are dealt to groups by their own number, so a cell with a third of them gives many groups.
    led = np.zeros(len(leaders), np.int64)
    for cell, n in queries.groupBy("cell").count().collect():  # MAX_PIVOTS rows at most
        led[leader[cell]] += n
    groups = F.element_at(F.create_map(*[F.lit(int(x)) for i, n in enumerate(led) for x in (i, max(1, -(-n // GROUP_ROWS)))]), F.col("leader"))

    def group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, _, _, _, _, _, leader = book.value
        for b in batches:
            g = leader[b.column(2).to_numpy()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(g)], ["query_id", "q", "leader"])

    deal = F.pmod(F.xxhash64("query_id", F.lit(1)), groups).cast("int")
    grouped = queries.mapInArrow(group, "query_id long, q binary, leader int").withColumn("deal", deal)
    grouped = materialize(grouped, "knn_queries")

    def needs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The (group, cell) pairs with a query whose k-th best could be beaten in the cell."""
        p, radius, low_cell, low_distance, cell_ids, _, _ = book.value
        for b in batches:
            q = np.frombuffer(b"".join(b.column(1).to_pylist()), np.int64).reshape(-1, dim).astype(np.float64)
            norm = np.sqrt((q * q).sum(1))[:, None]
            centre = q @ p.T
            lower = centre[:, low_cell] - norm * low_distance
            # One of the lower bounds may be the query's own, so the k-th best is judged by the one after.
            floor = np.partition(lower, -(k + 1), axis=1)[:, -(k + 1)] if lower.shape[1] > k else np.full(len(q), -np.inf)
            slack = 1e-6 * (1 + np.abs(floor))
            row, cell = np.nonzero(centre + norm * radius >= (floor - slack)[:, None])
            found = pd.DataFrame({"leader": b.column(2).to_numpy()[row], "deal": b.column(3).to_numpy()[row], "cell": cell_ids[cell]})
            yield pa.RecordBatch.from_pandas(found.drop_duplicates().astype("int32"), preserve_index=False)

    need = grouped.mapInArrow(needs, "leader int, deal int, cell int").distinct()
    cell_parts = F.element_at(F.create_map(*[F.lit(int(x)) for c, n in zip(cell_ids, parts) for x in (c, n)]), F.col("cell"))
    jobs = materialize(need.withColumn("parts", cell_parts).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))), "knn_jobs")
    keys = ["leader", "deal", "cell", "part"]
    dealt = placed.withColumn("part", F.pmod(F.xxhash64("vec_id", F.lit(2)), cell_parts).cast("int")).select("vec_id", "v", "cell", "part")
    data = dealt.join(jobs.select(*keys), ["cell", "part"])
    asked = grouped.join(jobs.select(*keys), ["leader", "deal"])

    def solve(q: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(x):
            return pd.DataFrame({"query_id": [], "q": [], "vec_id": [], "score": [], "own": []}).astype(
                {"query_id": "int64", "vec_id": "int64", "score": "int64", "own": "bool"})
        ids = x["vec_id"].to_numpy()
        own_id, vectors = q["query_id"].to_numpy(), x["v"].to_numpy()
        rows, cols, scores = best_in_part(_unpacked(q["q"], dim), _unpacked(x["v"], dim), ids, k + 1)
        asked_for = q["q"].to_numpy()
        own = [own_id[r] == ids[c] and asked_for[r] == vectors[c] for r, c in zip(rows, cols)]
        return pd.DataFrame({"query_id": own_id[rows], "q": asked_for[rows], "vec_id": ids[cols], "score": scores, "own": own})

    found = (asked.groupBy(*keys).cogroup(data.groupBy(*keys))
             .applyInPandas(solve, "query_id long, q binary, vec_id long, score long, own boolean"))
    # Its own row comes after equal ones, so that exactly one is taken out and ranks close up.
    best = Window.partitionBy("query_id", "q").orderBy(F.desc("score"), "vec_id", F.desc("own"))
    ranked = found.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= k + 1)
    first_own = F.min(F.when(F.col("own"), F.col("r"))).over(Window.partitionBy("query_id", "q"))
    ranked = ranked.withColumn("mine", F.coalesce(first_own, F.lit(k + 2))).filter(F.col("r") != F.col("mine"))
    return (ranked.withColumn("rank", (F.col("r") - (F.col("r") > F.col("mine")).cast("int")).cast("int")).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
