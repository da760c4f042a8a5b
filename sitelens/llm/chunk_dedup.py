"""Exact deduplication by content-defined chunk recipes.

Every text is cut where a rolling hash of the last 32 bytes meets a
condition, so equal stretches of different texts give equal chunks. The
distinct chunks are gathered once, grouped by digest *and* content: a digest
with two contents is a clash, and the identifiers of its chunks get an
ordinal. After that a chunk identifier stands for exactly one content, and
two texts are equal when their ordered identifier lists (recipes) are. Only
recipes, 16 bytes a chunk, are grouped and joined; the texts do not move again.

Defined cases: a null text counts as empty (recipe of no chunks). Of rows
with the same text the one with the largest id stays; a null id counts as
smallest; of rows with the same text and id exactly one stays. An empty
table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sitelens.llm.textops import as_bytes, id_type
from sitelens.session import materialize

WINDOW = 32
MIN_CHUNK, MEAN_BITS, MAX_CHUNK = 1 << 10, 12, 1 << 15
_GEAR = np.random.default_rng(20240229).integers(0, 1 << 32, 256, dtype=np.uint32)
_SLAB = 1 << 20


def strong_digest(chunk: bytes) -> bytes:
    return hashlib.blake2b(chunk, digest_size=16).digest()


def cut_candidates(text: bytes) -> list[int]:
    """Ends of chunks the rolling hash proposes, ascending (slab by slab, so
    that a very long text needs no array of its own length)."""
    found: list[int] = []
    for start in range(0, len(text), _SLAB):
        lead = min(start, WINDOW - 1)
        h = _GEAR[np.frombuffer(text, np.uint8, min(_SLAB, len(text) - start) + lead, start - lead)]
        for step in (1, 2, 4, 8, 16):
            h[step:] = h[step:] + (h[:-step] << np.uint32(step))
        hits = np.flatnonzero(h[lead:] >> np.uint32(32 - MEAN_BITS) == 0)
        found.extend((hits + (start + 1)).tolist())
    return found


def chunks(text: bytes) -> list[bytes]:
    """The content-defined chunks of a text, in order; joined they are the text."""
    if len(text) <= MIN_CHUNK:
        return [text] if text else []
    ends, at, out = cut_candidates(text), 0, []
    while at < len(text):
        i = bisect_left(ends, at + MIN_CHUNK)
        end = min(ends[i] if i < len(ends) else len(text), at + MAX_CHUNK, len(text))
        out.append(text[at:end])
        at = end
    return out


def recipes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            digest: Callable[[bytes], bytes] = strong_digest) -> DataFrame:
    """One row per document: id, its chunk digests concatenated, chunk count, sha256 of the text."""
    schema = f"doc_id {id_type(docs, id_col)}, recipe binary, n_chunks int, text_sha256 string"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = as_bytes(b.column(1))
            lists = [[digest(c) for c in chunks(t)] for t in texts]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([b"".join(x) for x in lists], pa.binary()),
                 pa.array([len(x) for x in lists], pa.int32()),
                 pa.array([hashlib.sha256(t).hexdigest() for t in texts])],
                ["doc_id", "recipe", "n_chunks", "text_sha256"])

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(cut, schema)


def chunk_occurrences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      digest: Callable[[bytes], bytes] = strong_digest) -> DataFrame:
    """One row per chunk occurrence: id, sha256 of its text, position, digest, content."""
    schema = f"doc_id {id_type(docs, id_col)}, text_sha256 string, pos int, digest binary, chunk binary"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, t in enumerate(as_bytes(b.column(1))):
                cs = chunks(t)
                if cs:
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).take(pa.array([i] * len(cs))),
                         pa.array([hashlib.sha256(t).hexdigest()] * len(cs)),
                         pa.array(range(len(cs)), pa.int32()),
                         pa.array([digest(c) for c in cs], pa.binary()), pa.array(cs, pa.binary())],
                        ["doc_id", "text_sha256", "pos", "digest", "chunk"])

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(cut, schema)


def chunk_store(docs: DataFrame, text_col: str = "text",
                digest: Callable[[bytes], bytes] = strong_digest) -> DataFrame:
    """The distinct (digest, content) pairs of all chunks. Chunks that repeat
    within a batch of rows leave their task once."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen = {(digest(c), c) for t in set(as_bytes(b.column(0))) for c in chunks(t)}
            yield pa.RecordBatch.from_arrays(
                [pa.array([d for d, _ in seen], pa.binary()), pa.array([c for _, c in seen], pa.binary())],
                ["digest", "chunk"])

    return docs.select(F.col(text_col)).mapInArrow(cut, "digest binary, chunk binary").distinct()


def verified_recipes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     digest: Callable[[bytes], bytes] = strong_digest) -> DataFrame:
    """``recipes`` with identifiers that stand for one content each."""
    store = chunk_store(docs, text_col, digest)
    clashes = materialize(store.groupBy("digest").count().filter("count > 1").select("digest"), "chunk_clashes")
    plain = recipes(docs, id_col, text_col, digest)
    if clashes.isEmpty():
        return plain
    ordinal = F.row_number().over(Window.partitionBy("digest").orderBy("chunk"))
    ordinals = store.join(clashes, "digest", "left_semi").withColumn("ordinal", ordinal)
    unit = F.concat("digest", F.to_binary(F.lpad(F.hex(F.coalesce("ordinal", F.lit(0))), 8, "0"), F.lit("hex")))
    exact = (chunk_occurrences(docs, id_col, text_col, digest).join(ordinals, ["digest", "chunk"], "left")
             .groupBy(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha"))
             .agg(F.array_sort(F.collect_set(F.struct("pos", unit.alias("unit")))).alias("units"))
             .select("_id", "_sha", F.aggregate("units", F.lit(b""), lambda a, x: F.concat(a, x["unit"])).alias("_exact")))
    return (plain.join(exact, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_sha256") == F.col("_sha")), "left")
            .select("doc_id", F.coalesce("_exact", "recipe").alias("recipe"), "n_chunks", "text_sha256"))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     digest: Callable[[bytes], bytes] = strong_digest) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, n_chunks.

    Rows are first counted by (recipe, id); a group's largest id and size are
    aggregated from these counts and joined back, a join that Spark may split
    where one group holds a large share of the rows.
    """
    per_id = (verified_recipes(docs, id_col, text_col, digest)
              .groupBy("recipe", "doc_id").agg(F.count(F.lit(1)).alias("_n"), F.min("text_sha256").alias("text_sha256"),
                                               F.min("n_chunks").alias("n_chunks")))
    per_id = materialize(per_id, "chunk_recipes")
    groups = per_id.groupBy("recipe").agg(F.max("doc_id").alias("keep_id"), F.sum("_n").alias("group_size"))
    copy = F.explode(F.sequence(F.lit(1), F.col("_n")))
    return (per_id.join(groups, "recipe").withColumn("_copy", copy)
            .select("doc_id", "keep_id", F.col("group_size").cast("long").alias("group_size"),
                    ((F.col("_copy") == 1) & F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
                    "text_sha256", "n_chunks"))
