"""Removal of long byte strings that occur more than once, by suffix arrays.

A byte goes if a string of ``width`` bytes that covers it also starts
anywhere else in the documents. Each string of ``width`` bytes (a window) is
dealt by its minimizer, the smallest hash of the 32-byte strings in it: equal
windows have equal minimizers, so they meet in one shard. Consecutive windows
with one minimizer travel as one stretch of text, of about ``1.4 * width`` bytes.

Minimizers that occur once need no more work. Stretches with equal content
are counted by a 128-bit digest; all windows of a stretch that occurs twice
repeat, and its text moves once. Different stretches with a common minimizer
can share a window only if they agree on half of what a window has besides
it, to its left or to its right; a hash of either side tells those that
cannot. What remains goes to shards of bounded size, whose suffix arrays
(induced sorting, permuted common prefixes) show which windows repeat.
A minimizer that more than ``HOT`` different stretches share would outgrow its
shard; its windows are counted one by one instead, by 128-bit digests with
partial sums, so a line in a third of all documents is spread over all tasks.

Defined cases: a null text counts as empty; a text shorter than ``width``
stays whole; rows with the same id and text are each other's copies; null ids
are ids; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelens.llm.suffix_array import repeated_starts
from sitelens.llm.textops import as_bytes, blocks, id_type, mix64, staged

WIDTH = 200
GRAM = 32
BLOCK = 1 << 17
SHARD_BYTES = 1 << 20
HOT = 4096
MAX_WINDOWS = 2048
_POS_BITS = np.uint64(22)
_BASE = 0x9E3779B97F4A7C15


def _sliding_minimum(x: np.ndarray, span: int) -> np.ndarray:
    """Minima of all ``span`` consecutive elements."""
    reach = 1
    while reach * 2 <= span:
        x = np.minimum(x[:-reach], x[reach:])
        reach *= 2
    return np.minimum(x[:len(x) - (span - reach)], x[span - reach:])


def _gram_hashes(buf: np.ndarray) -> np.ndarray:
    """64-bit hashes of all GRAM-byte strings."""
    with np.errstate(over="ignore"):
        h, reach, base = buf.astype(np.uint64) + np.uint64(1), 1, _BASE
        while reach < GRAM:
            h = h[:-reach] * np.uint64(base) + h[reach:]
            reach, base = reach * 2, base * base % (1 << 64)
        return mix64(h)


def stretches(texts: list[bytes], width: int) -> tuple[np.ndarray, ...]:
    """Stretches of windows with one minimizer in a block of texts: text number,
    start in the text, number of windows, minimizer, whether the minimizer comes
    up at two places in it (only then can a stretch repeat itself), and
    hashes of what is left and right of the minimizer, 0 where too little is there."""
    sizes = np.array([len(t) for t in texts], np.int64)
    buf = np.frombuffer(b"".join(texts), np.uint8)
    if len(buf) < width:
        return (np.zeros(0, np.int64),) * 7
    h = _gram_hashes(buf)
    packed = h >> _POS_BITS << _POS_BITS
    packed |= np.arange(len(h), dtype=np.uint64)
    least = _sliding_minimum(packed, width - GRAM + 1)
    value = least >> _POS_BITS
    # A run ends where the minimizer changes, and where windows begin or cease to lie in one text.
    ends = np.cumsum(sizes)
    new = np.append(True, value[1:] != value[:-1])
    edges = np.concatenate([ends - sizes, np.maximum(ends - width + 1, ends - sizes)])
    new[edges[edges < len(new)]] = True
    begin = np.flatnonzero(new)
    after = np.append(begin[1:], len(new))
    text = np.searchsorted(ends, begin, side="right")
    inside = np.flatnonzero(begin + width <= ends[text])
    if not len(inside):
        return (np.zeros(0, np.int64),) * 7
    begin, after, text = begin[inside], after[inside], text[inside]
    several = (least[begin] ^ least[after - 1]) & np.uint64((1 << 22) - 1) != 0
    # Long runs are cut.
    cuts = -(-(after - begin) // MAX_WINDOWS)
    run = np.repeat(np.arange(len(begin)), cuts)
    nth = np.arange(len(run)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
    first = begin[run] + nth * MAX_WINDOWS
    count = np.minimum(after[run] - first, MAX_WINDOWS)
    text, several = text[run], several[run]
    # Half of a window's bytes besides the minimizer, hashed by grams that cover them.
    half, last = (width - GRAM + 1) // 2, first + count + width - 1
    at = (least[first] & np.uint64((1 << 22) - 1)).astype(np.int64)
    sides = []
    for origin, there in ((at - half, at - half >= first), (at + GRAM, at + GRAM + half <= last)):
        steps = [*range(0, half - GRAM, GRAM), half - GRAM] if half >= GRAM else [0]
        side = np.zeros(len(first), np.uint64)
        with np.errstate(over="ignore"):
            for step in steps:
                side = mix64(side + h[np.clip(origin + step, 0, len(h) - 1)])
        sides.append(np.where(there if half >= GRAM else True, (side >> np.uint64(34)).astype(np.int64) + 1, 0))  # an int, 0 only where nothing is there
    return text, first - (ends - sizes)[text], count, value[first].astype(np.int64), several.astype(np.int64), *sides


def _segments(texts: list[bytes], width: int) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Blocks of texts; a long text is cut into pieces that overlap by width - 1 bytes."""
    rows, offsets, parts = [], [], []
    for i, t in enumerate(texts):
        for at in range(0, max(1, len(t) - width + 1), BLOCK):
            rows.append(i)
            offsets.append(at)
            parts.append(t[at:at + BLOCK + width - 1])
    for a, b in blocks([len(p) for p in parts], BLOCK):
        yield rows[a:b], offsets[a:b], parts[a:b]


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("body"), F.xxhash64(text_col).alias("text_hash"))


def minimizers(keyed: DataFrame, width: int) -> DataFrame:
    """(minimizer, n, several): occurrences in each task's blocks, combined."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, _, parts in _segments(as_bytes(b.column(0)), width):
                _, _, _, value, several, _, _ = stretches(parts, width)
                if len(value):
                    yield pa.RecordBatch.from_arrays([pa.array(value), pa.array(several)], ["minimizer", "several"])

    rows = keyed.select("body").mapInArrow(run, "minimizer long, several long")
    return rows.groupBy("minimizer").agg(F.count(F.lit(1)).alias("n"), F.max("several").alias("several"))


def all_stretches(keyed: DataFrame, width: int) -> DataFrame:
    """(doc_id, text_hash, minimizer, content, start, windows, several, before, after)."""
    schema = (f"doc_id {id_type(keyed, 'doc_id')}, text_hash long, minimizer long, content binary, start long, windows long, several long, "
              "before int, after int")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for rows, offsets, parts in _segments(as_bytes(b.column(1)), width):
                part, start, count, value, several, before, after = stretches(parts, width)
                if not len(part):
                    continue
                content = [hashlib.blake2b(parts[p][s:s + n + width - 1], digest_size=16).digest()
                           for p, s, n in zip(part.tolist(), start.tolist(), count.tolist())]
                own = pa.array(np.array(rows)[part])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(own), b.column(2).take(own), pa.array(value), pa.array(content, pa.binary()),
                     pa.array(start + np.array(offsets)[part]), pa.array(count), pa.array(several),
                     pa.array(before.astype(np.int32)), pa.array(after.astype(np.int32))],
                    ["doc_id", "text_hash", "minimizer", "content", "start", "windows", "several", "before", "after"])

    return keyed.select("doc_id", "body", "text_hash").mapInArrow(run, schema)


def _bodies(keyed: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """The bytes of the wanted stretches (doc_id, text_hash, minimizer, start, windows, copies)."""
    per_doc = (wanted.groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
               .agg(F.collect_list(F.struct("start", "windows", "minimizer", "copies")).alias("pieces")))
    rows = keyed.join(per_doc, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")))
    piece = F.explode("pieces").alias("p")
    return (rows.select("doc_id", "text_hash", "body", piece)
            .select("doc_id", "text_hash", "p.minimizer", "p.start", "p.windows", "p.copies",
                    F.substring(F.col("body"), (F.col("p.start") + 1).cast("int"), (F.col("p.windows") + width - 1).cast("int")).alias("bytes")))


def repeated_ranges(keyed: DataFrame, width: int) -> DataFrame:
    """(doc_id, text_hash, a, b): byte ranges of the documents to be removed (they may overlap)."""
    live = minimizers(keyed, width).filter("n > 1 OR several > 0").select("minimizer")
    found = staged(all_stretches(keyed, width).join(live, "minimizer", "left_semi"), "repeat_stretches", batch_rows=2000)
    contents = staged(found.groupBy("minimizer", "content").agg(
        F.count(F.lit(1)).alias("copies"), F.max("several").alias("self"), F.max("before").alias("before"), F.max("after").alias("after")),
        "repeat_contents")
    sides = contents.select("minimizer", "content", "copies", "self", F.explode(F.array(
        F.struct(F.lit(0).alias("which"), F.col("before").alias("side")), F.struct(F.lit(1).alias("which"), F.col("after").alias("side")))).alias("s"))
    agreeing = (sides.filter("s.side <> 0").groupBy("minimizer", "s.which", "s.side").agg(F.count(F.lit(1)).alias("kinds"))
                .filter("kinds > 1").select("minimizer", F.struct("which", "side").alias("s")))
    able = sides.join(agreeing, ["minimizer", "s"], "left_semi").select("minimizer", "content", "copies")
    copied = (found.join(contents.filter("copies > 1").select("minimizer", "content"), ["minimizer", "content"], "left_semi")
              .select("doc_id", "text_hash", F.col("start").alias("a"), (F.col("start") + F.col("windows") + width - 1).alias("b")))

    # Beside a stretch that may repeat itself, all others of its minimizer are compared.
    selves = contents.filter("self > 0").select("minimizer").distinct()
    able = able.unionByName(contents.join(selves, "minimizer", "left_semi").select("minimizer", "content", "copies")).distinct()
    kinds = able.groupBy("minimizer").agg(F.count(F.lit(1)).alias("kinds"))
    one = F.min(F.struct("doc_id", "text_hash", "start", "windows")).alias("one")
    wanted = (found.join(able.join(kinds, "minimizer"), ["minimizer", "content"])
              .groupBy("minimizer", "content", "copies", "kinds").agg(one)
              .select("minimizer", "copies", "kinds", "one.*"))
    wanted = staged(wanted, "repeat_wanted")
    amount = wanted.filter(F.col("kinds") <= HOT).agg(F.sum(F.col("windows") + width)).first()[0] or 0
    shards = max(1, -(-amount // SHARD_BYTES))
    shard = F.pmod(F.xxhash64("minimizer"), F.lit(shards))
    cold = _bodies(keyed, wanted.filter(F.col("kinds") <= HOT), width).withColumn("shard", shard)

    def sort(part: pd.DataFrame) -> pd.DataFrame:
        part = part.drop_duplicates(["doc_id", "text_hash", "start"])
        rows, starts, ends = [], [], []
        for i, (hit, copies) in enumerate(zip(repeated_starts(part["bytes"].tolist(), width), part["copies"])):
            if copies == 1 and len(hit):  # all windows of the others are known to repeat
                first = np.flatnonzero(np.append(True, np.diff(hit) > 1))
                rows += [i] * len(first)
                starts.append(hit[first])
                ends.append(hit[np.append(first[1:] - 1, len(hit) - 1)] + width)
        out = part.iloc[rows][["doc_id", "text_hash", "start"]].reset_index(drop=True)
        at = out.pop("start")
        out["a"] = at + (np.concatenate(starts) if starts else np.zeros(0, np.int64))
        out["b"] = at + (np.concatenate(ends) if ends else np.zeros(0, np.int64))
        return out

    ranges = f"doc_id {id_type(keyed, 'doc_id')}, text_hash long, a long, b long"
    sorted_out = cold.groupBy("shard").applyInPandas(sort, ranges)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, (body, n) in enumerate(zip(b.column(5).to_pylist(), b.column(4).to_pylist())):
                own = pa.array([i] * n)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(own), b.column(1).take(own), pa.array(np.arange(n) + b.column(2)[i].as_py()), b.column(3).take(own),
                     pa.array([hashlib.blake2b(body[j:j + width], digest_size=16).digest() for j in range(n)], pa.binary())],
                    ["doc_id", "text_hash", "a", "copies", "content"])

    hot = _bodies(keyed, wanted.filter(F.col("kinds") > HOT), width).select("doc_id", "text_hash", "start", "copies", "windows", "bytes")
    hot = staged(hot.mapInArrow(windows, f"doc_id {id_type(keyed, 'doc_id')}, text_hash long, a long, copies long, content binary"),
                      "repeat_hot_windows")
    again = hot.groupBy("content").agg(F.sum("copies").alias("n")).filter("n > 1").select("content")
    counted = (hot.filter("copies = 1").join(again, "content", "left_semi")
               .select("doc_id", "text_hash", "a", (F.col("a") + width).alias("b")))
    return copied.unionByName(sorted_out).unionByName(counted)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept (the remaining bytes)."""
    if width < GRAM:
        raise ValueError(f"width must be {GRAM} at least")
    keyed = _keyed(docs, id_col, text_col)
    going = (repeated_ranges(keyed, width).groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
             .agg(F.collect_list(F.struct("a", "b")).alias("ranges")))
    joined = keyed.join(going, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")), "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, removed, spans, kept = [], [], [], []
            for t, ranges in zip(as_bytes(batch.column(1)), batch.column(2)):
                out, at, n = [], 0, 0
                if ranges.is_valid and len(ranges):
                    pairs = ranges.values.flatten()
                    a, b = (np.asarray(x) for x in pairs)
                    order = np.argsort(a, kind="stable")
                    a, b = a[order], np.maximum.accumulate(b[order])
                    first = np.flatnonzero(np.append(True, a[1:] > b[:-1]))
                    for lo, hi in zip(a[first].tolist(), b[np.append(first[1:] - 1, len(b) - 1)].tolist()):
                        out.append(t[at:lo])
                        at, n = hi, n + 1
                out.append(t[at:])
                left = b"".join(out)
                sizes.append(len(t))
                removed.append(len(t) - len(left))
                spans.append(n)
                kept.append(left)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return joined.select("doc_id", "body", "ranges").mapInArrow(
        cut, f"doc_id {id_type(keyed, 'doc_id')}, n_bytes long, n_removed long, n_spans long, kept binary")
