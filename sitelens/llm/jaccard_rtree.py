"""N-gram Jaccard join by count vectors in R-trees.

A document is its set of distinct word shingles; two documents link when
100 * |intersection| >= threshold * |union|. The shingles are hashed into
groups, and a set's point holds how many of its shingles fall in each. A set
has 256 groups, or more if it is larger (one for each shingle or two), up to
``MOST_GROUPS``; groups are nested, so points of different size classes are
compared by adding up the finer one's groups. The coordinate minima of two points, summed, are an upper bound of the
intersection, of two bounding boxes' upper corners an upper bound for all
pairs in them: an R-tree over the points skips box pairs whose bound is too
low (with an eighth of the groups, for the largest sets half; the points then with all), and only surviving
pairs are compared shingle by shingle.

Which points meet in one tree: sets that can link share one of their rarest
shingles (a set's ``size - ceil(threshold * size) + 1`` rarest cannot all be missing from a
partner). Rarity is read from a table of ``FREQUENCIES`` hashed counts over
all documents, so a passage that a third of the documents share comes last
everywhere. This loses no link whatever the counts are, for all documents
use the same order.

Large groups of near copies: each set is first compared with one pivot, the
smallest holder of most of its rare shingles, then (where many
sets hold a shingle and are not yet connected) with a few other pivots drawn
by a hash, at most ``_STAR_PIVOTS`` a set. Sets that linked with most of these
are centres; the sets still not connected are compared with as many of them. A shingle whose holders are all in one component needs no more comparisons; the
trees only look for pairs between different components. A holder for which no
other is of a fitting size is left out. Shingles with very many holders are
dealt to several trees, a tree for each pair of parts.

Number of links (only where asked for): two linked sets are always of one component, so once the
components are known, each set is compared exactly with the sets of its
component. A task has the sets of some small components, or two parts of a
large one (its sets by bands of size, only equal and adjacent bands can link,
and by a hash within a band), and returns a number for each set, never pairs.
This takes the square of a component's sets, as the links themselves may.

Sets are known by 64 bits of a digest, checked against 64 other bits (a
clash raises; another ``salt`` avoids it). Shingles are compared as 64-bit hashes.

Defined cases: a null text or one without words has no shingles and links
with nothing (its component is its own id); a text with fewer words than a shingle
has one shingle, all its words; null ids are members but never a component's
id unless all are null; equal texts are one set. An empty table gives an
empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitelens.llm.graph import components
from sitelens.llm.textops import as_bytes, discard, id_type, mix64, staged

LEAST_GROUPS, MOST_GROUPS = 64, 8192
LEVELS = (MOST_GROUPS // LEAST_GROUPS).bit_length() - 1
#: Times the groups of a size class that its points have, up to ``MOST_GROUPS``; trees have half of the class's groups.
FINE = 4
FREQUENCIES = 1 << 16
LEAF = 32
_TREE_ROWS = 2000
#: About how many sets share a tree if their shingles have few holders.
_SHARED_ROWS = 1000
#: Pivots that a set is compared with in the second round, and the holders a shingle must have for it.
_STAR_PIVOTS, _STAR_HOLDERS = 5, 8
#: A set that links with so many of its pivots is a centre.
_CENTRE_LINKS = 3
#: Sets of a part of a component and, but for a single larger set, about how many shingles they have.
_PART_SETS, _PART_SHINGLES = 512, 1 << 20
_OVERLAP_COLUMNS = 4096


def shingles(text: bytes, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word shingles."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    span = min(width, len(h))
    n = len(h) - span + 1
    with np.errstate(over="ignore"):
        out = h[:n] + np.uint64(span)
        for i in range(1, span):
            out = out * np.uint64(0x9E3779B97F4A7C15)
            out += h[i:i + n]
        out = mix64(out)
    return np.unique(out)


def needed(sizes, threshold: int):
    """The least intersection of a set with any partner: ceil(threshold% of its size)."""
    return (threshold * sizes + 99) // 100


def first_of_smaller(sizes, threshold: int):
    """How many of its rarest shingles a set needs for partners that are not
    smaller; a shared shingle must be among these of the smaller set."""
    return sizes - (2 * threshold * sizes + 99 + threshold) // (100 + threshold) + 1


def ranks(frequencies: np.ndarray) -> np.ndarray:
    """The place of each hashed count among all, rarest first."""
    out = np.empty(len(frequencies), np.uint64)
    out[np.argsort(frequencies, kind="stable")] = np.arange(len(frequencies), dtype=np.uint64)
    return out


def rarest(grams: np.ndarray, rank: np.ndarray, threshold: int) -> np.ndarray:
    """The set's rarest shingles, rarest first, one of which every partner has.

    A shingle is shown as the rank of its hashed count followed by its other
    48 bits; its count is found by the lowest 16 bits, so nothing is lost."""
    n = len(grams) - needed(len(grams), threshold) + 1
    keys = rank[(grams & np.uint64(FREQUENCIES - 1)).astype(np.int64)] << np.uint64(48) | grams >> np.uint64(16)
    return np.sort(np.partition(keys, n - 1)[:n])


def level_of(n: int) -> int:
    """The size class of a set: the first whose largest size, 4 * LEAST_GROUPS << level, is not below it."""
    return min(LEVELS, ((max(n, 1) - 1) // (4 * LEAST_GROUPS)).bit_length())


def level_column(n: Column) -> Column:
    return sum(((n > (4 * LEAST_GROUPS << i)).cast("int") for i in range(LEVELS)), F.lit(0))


def groups_of(level: int) -> int:
    return min(FINE * LEAST_GROUPS << level, MOST_GROUPS)


def point(grams: np.ndarray) -> np.ndarray:
    groups = groups_of(level_of(len(grams)))
    return np.bincount((grams >> np.uint64(32)).astype(np.int64) % groups, minlength=groups).astype(np.int32)


def packed(counts: np.ndarray) -> bytes:
    """A point as bytes: two counts a byte where all are below 16, else four bytes a count."""
    if counts.max() > 15:
        return b"\1" + counts.astype(np.int32).tobytes()
    return b"\0" + (counts[::2] | counts[1::2] << 4).astype(np.uint8).tobytes()


def unpacked(counts: bytes) -> np.ndarray:
    if counts[0]:
        return np.frombuffer(counts, np.int32, offset=1)
    both = np.frombuffer(counts, np.uint8, offset=1)
    return np.stack([both & 15, both >> 4], 1).ravel().astype(np.int32)


def folded(counts: np.ndarray, groups: int) -> np.ndarray:
    """A point with its groups added up to ``groups``."""
    return counts.reshape(-1, groups).sum(0, dtype=np.int32)


def matrix(packed_points: list[bytes], groups: int, sizes: np.ndarray) -> np.ndarray:
    """Points as rows of ``groups`` counts, in integers that hold their sums."""
    out = np.empty((len(packed_points), groups), np.uint16 if sizes.max() < 1 << 16 else np.int32)
    kinds = np.array([len(p) if p[0] == 0 else 0 for p in packed_points])
    for kind in np.unique(kinds):
        rows = np.flatnonzero(kinds == kind)
        if kind:  # unpacked and folded together
            both = np.frombuffer(b"".join([packed_points[i] for i in rows]), np.uint8).reshape(len(rows), kind)[:, 1:]
            counts = np.empty((len(rows), 2 * both.shape[1]), np.uint8)
            counts[:, ::2], counts[:, 1::2] = both & 15, both >> 4
            out[rows] = counts.reshape(len(rows), -1, groups).sum(1, dtype=out.dtype) if counts.shape[1] > groups else counts
        else:
            for i in rows:
                out[i] = folded(unpacked(packed_points[i]), groups)
    return out


def document_sets(docs: DataFrame, id_col: str, text_col: str, width: int, salt: bytes) -> DataFrame:
    """Rows of documents (doc_id, n, sid, check, text_hash, counts), and after
    each task's documents its shingle counts (bucket, seen)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(FREQUENCIES, np.int64)
        names = ["doc_id", "text_hash", "n", "sid", "check", "counts", "bucket", "seen"]
        for b in batches:
            n, sid, check, counts, every = [], [], [], [], []
            for t in as_bytes(b.column(1)):
                g = shingles(t, width)
                d = hashlib.blake2b(g.tobytes(), digest_size=16, salt=salt).digest()
                n.append(len(g))
                sid.append(int.from_bytes(d[:8], "little", signed=True))
                check.append(int.from_bytes(d[8:], "little", signed=True))
                counts.append(packed(point(g)))
                every.append((g & np.uint64(FREQUENCIES - 1)).astype(np.int32))
            for g in every:
                seen += np.bincount(g, minlength=FREQUENCIES) if len(g) > 20000 else 0
            seen += np.bincount(np.concatenate([np.zeros(0, np.int32), *[g for g in every if len(g) <= 20000]]), minlength=FREQUENCIES)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(n, pa.int64()), pa.array(sid, pa.int64()), pa.array(check, pa.int64()),
                 pa.array(counts, pa.binary()), pa.nulls(len(n), pa.int32()),
                 pa.nulls(len(n), pa.int64())], names)
        at = np.flatnonzero(seen)
        none = [pa.nulls(len(at), f) for f in (id_arrow, pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())]
        yield pa.RecordBatch.from_arrays([*none, pa.array(at.astype(np.int32)), pa.array(seen[at])], names)

    from pyspark.sql.pandas.types import to_arrow_type

    id_arrow = to_arrow_type(docs.schema[id_col].dataType)
    rows = docs.select(F.col(id_col), F.col(text_col), F.xxhash64(F.col(text_col)))
    return rows.mapInArrow(run, f"doc_id {id_type(docs, id_col)}, text_hash long, n long, sid long, check long, counts binary, "
                                "bucket int, seen long")


def rare_rows(docs: DataFrame, text_col: str, width: int, threshold: int, salt: bytes, rank) -> DataFrame:
    """(key, sid, n, first): each set's rarest shingles, and whether the shingle is
    among those a partner that is not smaller must share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, sids, sizes, first = [], [], [], []
            for t in as_bytes(b.column(0)):
                g = shingles(t, width)
                if len(g):
                    d = hashlib.blake2b(g.tobytes(), digest_size=16, salt=salt).digest()
                    keys.append(rarest(g, rank.value, threshold))
                    sids.append(int.from_bytes(d[:8], "little", signed=True))
                    sizes.append(len(g))
                    first.append(np.arange(len(keys[-1])) < first_of_smaller(len(g), threshold))
            if keys:
                times = [len(k) for k in keys]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.repeat(np.array(sids, np.int64), times)),
                     pa.array(np.repeat(np.array(sizes, np.int64), times)), pa.array(np.concatenate(first))], ["key", "sid", "n", "first"])

    return docs.select(text_col).mapInArrow(run, "key long, sid long, n long, first boolean")


def shingle_store(texts: DataFrame, width: int) -> DataFrame:
    """(sid, text) -> (sid, grams): the sorted shingles as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([shingles(t, width).tobytes() for t in as_bytes(b.column(1))], pa.binary())],
                                             ["sid", "grams"])

    return texts.mapInArrow(run, "sid long, grams binary")


def within_bound(pairs: DataFrame, threshold: int) -> DataFrame:
    """Of (a, b, na, ca, nb, cb) the pairs whose sizes and summed coordinate minima allow a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for na, ca, nb, cb in zip(*(batch.column(i).to_pylist() for i in range(2, 6))):
                fits = 100 * min(na, nb) >= threshold * max(na, nb)
                if fits:
                    ca, cb = unpacked(ca), unpacked(cb)
                    groups = min(len(ca), len(cb))
                    shared = int(np.minimum(folded(ca, groups), folded(cb, groups)).sum())
                    fits = shared * (100 + threshold) >= (na + nb) * threshold
                keep.append(fits)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.select("a", "b", "na", "ca", "nb", "cb").mapInArrow(run, "a long, b long")


class Tree:
    """An R-tree over count vectors: boxes are halved by size while their sizes
    differ too much for a link, then along their widest coordinate, down to
    ``LEAF`` points."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray, threshold: int):
        self.points, self.sizes, self.threshold = points, sizes, threshold
        self.by_group = np.ascontiguousarray(points.T)
        self.boxes: list[tuple] = []  # (upper corner, least size, largest size, children or rows)
        self.root = self._build(np.arange(len(points)))

    def _build(self, rows: np.ndarray) -> int:
        part = self.points[rows]
        below: object = rows
        if len(rows) > LEAF:
            own = self.sizes[rows]
            if 100 * own.min() < self.threshold * own.max():  # sizes that can't link part first
                order = rows[np.argsort(own, kind="stable")]
            else:
                axis = np.argmax(part.max(0) - part.min(0))
                order = rows[np.argsort(part[:, axis], kind="stable")]
            below = (self._build(order[:len(rows) // 2]), self._build(order[len(rows) // 2:]))
        self.boxes.append((part.max(0), self.sizes[rows].min(), self.sizes[rows].max(), below))
        return len(self.boxes) - 1

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows (i, j) of point pairs whose bound allows a link."""
        todo, threshold = [(self.root, self.root)], self.threshold
        while todo:
            x, y = todo.pop()
            (hi_x, least_x, most_x, below_x), (hi_y, least_y, most_y, below_y) = self.boxes[x], self.boxes[y]
            if (np.minimum(hi_x, hi_y).sum(dtype=np.int64) * (100 + threshold) < (least_x + least_y) * threshold
                    or 100 * most_x < threshold * least_y or 100 * most_y < threshold * least_x):
                continue
            inner_x, inner_y = isinstance(below_x, tuple), isinstance(below_y, tuple)
            if x == y and inner_x:
                todo += [(below_x[0], below_x[0]), (below_x[0], below_x[1]), (below_x[1], below_x[1])]
            elif inner_x:
                todo += [(below_x[0], y), (below_x[1], y)]
            elif inner_y:
                todo += [(x, below_y[0]), (x, below_y[1])]
            else:
                a, b = self.sizes[below_x][:, None], self.sizes[below_y][None, :]
                shared = np.minimum(self.by_group[:, below_x, None], self.by_group[:, None, below_y]).sum(0, dtype=self.points.dtype).astype(np.int64)
                fits = ((shared * (100 + threshold) >= (a + b) * threshold)
                        & (100 * np.minimum(a, b) >= threshold * np.maximum(a, b)))
                i, j = np.nonzero(fits)
                i, j = below_x[i], below_y[j]
                keep = i < j if x == y else slice(None)
                yield i[keep], j[keep]


def tree_pairs(members: DataFrame, threshold: int) -> DataFrame:
    """(tree, level, sid, root, n, counts, trees) -> candidate pairs (a, b) of
    different roots, the smaller set being of the tree's level. Two sets often
    meet in many trees; the pair comes from the first of them."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.drop_duplicates("sid")
        sid, root, own = part["sid"].to_numpy(), part["root"].to_numpy(), part["own_level"].to_numpy()
        level, found = part["level"].iloc[0], [np.zeros((0, 2), np.int64)]
        if len(set(root)) > 1 and (own == level).any():
            sizes = part["n"].to_numpy()
            points = matrix(part["counts"].tolist(), groups_of(level), sizes)
            coarse = points.reshape(len(points), -1, LEAST_GROUPS // 2 << level).sum(1, dtype=points.dtype)
            here, trees = part["tree_a"].iloc[0], part["trees"].tolist()
            for i, j in Tree(coarse, sizes, threshold).pairs():
                keep = (root[i] != root[j]) & ((own[i] == level) | (own[j] == level))
                i, j = i[keep], j[keep]
                keep = np.minimum(points[i], points[j]).sum(1, dtype=np.int64) * (100 + threshold) >= (sizes[i] + sizes[j]) * threshold
                i, j = i[keep], j[keep]
                first = np.array([min(set(trees[x]) & set(trees[y])) == here for x, y in zip(i.tolist(), j.tolist())], bool)
                found.append(np.stack([sid[i][first], sid[j][first]], 1))
        both = np.concatenate(found)
        return pd.DataFrame({"a": np.minimum(both[:, 0], both[:, 1]), "b": np.maximum(both[:, 0], both[:, 1])})

    return members.groupBy("tree_a", "tree_b", "tree_c", "level").applyInPandas(run, "a long, b long")


def stored_sets(wanted: DataFrame, classes: DataFrame, docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """The wanted sets' (sid, grams); a set may come more than once."""
    holders = classes.join(wanted, "sid").select("sid", F.col("rep.doc_id").alias("_id"), F.col("rep.text_hash").alias("_hash"))
    texts = (docs.select(F.col(id_col), F.col(text_col), F.xxhash64(F.col(text_col)).alias("_own"))
             .join(holders, F.col(id_col).eqNullSafe(F.col("_id")) & (F.col("_own") == F.col("_hash"))).select("sid", text_col))
    return staged(shingle_store(texts, width), "jaccard_sets", batch_rows=1000)


def verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, id_col: str, text_col: str, width: int, threshold: int) -> DataFrame:
    """The pairs (a, b) that link, compared shingle by shingle."""
    pairs = staged(pairs, "jaccard_pairs")
    wanted = pairs.select(F.col("a").alias("sid")).union(pairs.select("b")).distinct()
    sets = stored_sets(wanted, classes, docs, id_col, text_col, width)
    store = sets.dropDuplicates(["sid"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y in zip(b.column(2), b.column(3)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * shared >= threshold * (len(x) + len(y) - shared))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = store.select(F.col("sid").alias("a"), F.col("grams").alias("x"))
    right = store.select(F.col("sid").alias("b"), F.col("grams").alias("y"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")
    links = staged(both.mapInArrow(run, "a long, b long"), "jaccard_links", batch_rows=1000)
    discard(pairs, sets)
    return links


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many shingles each set of ``left`` shares with each of ``right``."""
    known = np.intersect1d(np.unique(np.concatenate(left)), np.unique(np.concatenate(right)), assume_unique=True)
    out = np.zeros((len(left), len(right)), np.int64)

    def places(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        every, row = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        at = np.minimum(np.searchsorted(known, every), len(known) - 1)
        there = known[at] == every
        at, row = at[there], row[there]
        order = np.argsort(at, kind="stable")
        return at[order], row[order]

    def ones(at: np.ndarray, row: np.ndarray, rows: int, start: int, end: int) -> np.ndarray:
        a, b = np.searchsorted(at, (start, end))
        block = np.zeros((rows, end - start), np.float32)  # sums of up to _OVERLAP_COLUMNS ones are exact
        block[row[a:b], at[a:b] - start] = 1
        return block

    if len(known):
        of_left, of_right = places(left), places(right)
        for start in range(0, len(known), _OVERLAP_COLUMNS):
            end = min(start + _OVERLAP_COLUMNS, len(known))
            out += (ones(*of_left, len(left), start, end) @ ones(*of_right, len(right), start, end).T).astype(np.int64)
    return out


def link_counts(found: DataFrame, classes: DataFrame, docs: DataFrame, id_col: str, text_col: str, width: int, threshold: int) -> DataFrame:
    """(sid, links): for each set of a component (node, root) the documents whose sets link with it."""
    spread = max(math.log(100 / threshold) * (1 + 1e-9), 1e-9)  # sets of bands further apart than 1 differ too much in size
    members = staged(found.withColumnRenamed("node", "sid").join(classes.select("sid", "n", "copies"), "sid")
                     .withColumn("band", F.floor(F.log("n") / spread).cast("long")), "jaccard_component_sets")
    parts = F.greatest(F.ceil(F.count(F.lit(1)) / _PART_SETS), F.ceil(F.sum("n") / _PART_SHINGLES)).cast("int")
    large = members.groupBy("root").agg(parts.alias("parts")).filter("parts > 1").select("root")
    small = members.join(large, "root", "left_anti")
    blocks = small.agg(parts.alias("parts")).first()["parts"] or 1
    small = small.select(F.pmod(F.xxhash64("root"), F.lit(blocks)).alias("block"), F.lit(-1).cast("long").alias("at"), F.lit(0).alias("x"),
                         F.lit(0).alias("y"), F.lit(2).alias("side"), "root", "sid", "n", "copies")

    bands = Window.partitionBy("root").orderBy("band")
    cells = members.join(large, "root", "left_semi").groupBy("root", "band").agg(parts.alias("parts"))
    beside = lambda f, step: F.when(f("band").over(bands) == F.col("band") + step, f("parts").over(bands)).otherwise(0)
    cells = cells.select("root", "band", "parts", beside(F.lag, -1).alias("below"), beside(F.lead, 1).alias("above"))
    own = F.pmod(F.xxhash64("sid"), F.col("parts")).cast("int")

    def met(n: Column, at: Column, x, y, side) -> Column:
        """Places of the parts that a set's part meets; ``at`` is twice the lower band, and one more for parts of two bands."""
        every = F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1), lambda j: F.struct(
            at.alias("at"), x(j).alias("x"), y(j).alias("y"), side(j).cast("int").alias("side")))
        return F.slice(every, F.lit(1), n)

    part, zero, one = F.col("own"), F.lit(0), F.lit(1)
    meets = F.concat(
        met(F.col("parts"), 2 * F.col("band"), lambda j: F.least(part, j), lambda j: F.greatest(part, j),
            lambda j: F.when(j == part, 2).when(part < j, 0).otherwise(1)),
        met(F.col("above"), 2 * F.col("band") + 1, lambda j: part, lambda j: j, lambda j: zero),
        met(F.col("below"), 2 * F.col("band") - 1, lambda j: j, lambda j: part, lambda j: one))
    dealt = (members.join(cells, ["root", "band"]).withColumn("own", own).withColumn("m", F.explode(meets))
             .select(F.col("root").alias("block"), "m.at", "m.x", "m.y", "m.side", "root", "sid", "n", "copies"))

    def run(part: pd.DataFrame) -> pd.DataFrame:
        links, sizes, copies = np.zeros(len(part), np.int64), part["n"].to_numpy(), part["copies"].to_numpy()
        grams, side = [np.frombuffer(g, np.uint64) for g in part["grams"]], part["side"].to_numpy()
        for rows in part.groupby("root").indices.values():
            left, right = rows[side[rows] != 1], rows[side[rows] != 0]
            if len(left) and len(right):
                shared = overlaps([grams[i] for i in left], [grams[i] for i in right])
                holds = 100 * shared >= threshold * (sizes[left][:, None] + sizes[right][None, :] - shared)
                holds &= left[:, None] != right[None, :]
                links[left] += holds @ copies[right]
                if side[rows[0]] != 2:  # else both sides are the same sets
                    links[right] += copies[left] @ holds
        return pd.DataFrame({"sid": part["sid"], "links": links})

    sets = stored_sets(members.select("sid"), classes, docs, id_col, text_col, width)
    rows = small.unionByName(dealt).join(sets.dropDuplicates(["sid"]), "sid")
    counts = staged(rows.groupBy("block", "at", "x", "y").applyInPandas(run, "sid long, links long")
                    .groupBy("sid").agg(F.sum("links").alias("links")), "jaccard_link_counts")
    discard(members, sets)
    return counts


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, threshold: int = 85,
                       salt: bytes = b"", count_links: bool = False) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, n_links (with
    ``count_links``: all other documents it links with, copies too; this takes the
    square of a component), text_hash (xxhash64 of the text) and component (a
    number of the component, null without words)."""
    rows = staged(document_sets(docs, id_col, text_col, width, salt), "jaccard_documents", batch_rows=2000)
    sets = rows.filter("bucket IS NULL").drop("bucket", "seen")
    frequencies = np.zeros(FREQUENCIES, np.int64)
    for bucket, n in rows.filter("bucket IS NOT NULL").groupBy("bucket").agg(F.sum("seen")).collect():  # FREQUENCIES rows at most
        frequencies[bucket] = n
    spark = docs.sparkSession
    classes = staged(
        sets.filter("n > 0").groupBy("sid", "check", "n").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash")).alias("rep"),
                                                             F.first("counts").alias("counts"),
                                                             F.count(F.lit(1)).alias("copies")), "jaccard_classes")
    if not classes.groupBy("sid").count().filter("count > 1").isEmpty():
        raise ValueError("two different shingle sets have the same 64-bit digest; give another salt")

    rare = staged(rare_rows(docs, text_col, width, threshold, salt, spark.sparkContext.broadcast(ranks(frequencies))), "jaccard_rare",
                  batch_rows=2000)
    held = rare.groupBy("key").agg(F.min("sid").alias("pivot"), F.max("sid").alias("last"), F.max("first").alias("first"))
    held = held.filter("pivot < last AND first").select("key", "pivot")  # all holders have different sets
    shared = staged(rare.join(held, "key").distinct(), "jaccard_shared")
    discard(rare)
    left = classes.select(F.col("sid").alias("a"), F.col("n").alias("na"), F.col("counts").alias("ca"))
    right = classes.select(F.col("sid").alias("b"), F.col("n").alias("nb"), F.col("counts").alias("cb"))

    def linked(pairs: DataFrame) -> DataFrame:
        fitting = within_bound(pairs.join(left, "a").join(right, "b"), threshold)
        return verified(fitting, classes, docs, id_col, text_col, width, threshold)

    def rooted(links: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Shared shingles with the root of each holder's component, and the
        shingles whose holders are of several components."""
        found = components(links).withColumnRenamed("node", "sid")
        rows = staged(shared.join(found, "sid", "left").select("key", "sid", "n", "first", F.coalesce("root", "sid").alias("root")),
                      "jaccard_rooted")
        keys = rows.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count(F.lit(1)).alias("holders"))
        return rows, keys.filter("lo < hi").select("key", "holders")

    def pairs_of(x: str, y: str) -> list[Column]:
        return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]

    # The rounds with pivots only save work for the trees, so a set's most frequent pivot will do.
    pivots = shared.filter("sid <> pivot").groupBy("sid").agg(F.mode("pivot", deterministic=True).alias("pivot"))
    links = linked(pivots.select(*pairs_of("sid", "pivot")).distinct())
    first_rows, open_keys = rooted(links)
    seeds = range(_STAR_PIVOTS)

    def star(rows: DataFrame, heads: DataFrame) -> DataFrame:
        """(sid, a, b): sets with some of ``heads`` that hold a shingle of theirs and are of other components."""
        picks = heads.groupBy("key").agg(*[F.min(F.struct(F.xxhash64("sid", F.lit(i)), "sid", "root")).alias(f"pick{i}") for i in seeds])
        own = rows.join(picks, "key").groupBy("sid", "root").agg(*[
            F.min(F.when(F.col(f"pick{i}.root") != F.col("root"), F.col(f"pick{i}"))).alias(f"pick{i}") for i in seeds])
        picked = own.select("sid", F.explode(F.array(*[f"pick{i}" for i in seeds])).alias("pick")).filter("pick IS NOT NULL")
        return staged(picked.select("sid", *pairs_of("sid", "pick.sid")).distinct(), "jaccard_star")

    def many_held(rows: DataFrame, open_keys: DataFrame) -> DataFrame:
        return rows.join(open_keys.filter(F.col("holders") >= _STAR_HOLDERS).select("key"), "key")

    rows = many_held(first_rows, open_keys)
    drawn = star(rows, rows)
    second = linked(drawn.select("a", "b").distinct())
    centres = staged(drawn.join(second, ["a", "b"]).groupBy("sid").count().filter(F.col("count") >= _CENTRE_LINKS).select("sid"),
                     "jaccard_centres")
    discard(first_rows, drawn)
    both = staged(links.unionByName(second).distinct(), "jaccard_links")
    discard(links, second)
    links = both

    root_rows, open_keys = rooted(links)
    if not centres.isEmpty():
        rows = many_held(root_rows, open_keys)
        drawn = star(rows, rows.join(centres, "sid"))
        third = linked(drawn.select("a", "b").distinct())
        discard(root_rows, drawn)
        both = staged(links.unionByName(third).distinct(), "jaccard_links")
        discard(links, third)
        links = both
        root_rows, open_keys = rooted(links)
    discard(shared, centres)
    rows = root_rows.join(open_keys, "key")
    by_size = Window.partitionBy("key").orderBy("n")
    several = F.col("holders") > 2  # of two holders, the smaller one must have the shingle among its first

    def fits(other, first: Column) -> Column:
        n, its = other("n").over(by_size), F.coalesce(first, F.lit(False))
        equal_first = (n == F.col("n")) & (F.col("first") | F.coalesce(other("first").over(by_size), F.lit(False)))
        return F.coalesce((threshold * F.greatest("n", n) <= 100 * F.least("n", n)) & (several | its | equal_first), F.lit(False))

    few = (rows.filter(F.col("holders") <= _TREE_ROWS)
           .withColumn("fits", fits(F.lag, F.lag("first").over(by_size)) | fits(F.lead, F.col("first")))
           .filter("fits").drop("fits", "first"))
    stored = members = staged(few.unionByName(rows.filter(F.col("holders") > _TREE_ROWS).drop("first")), "jaccard_members")
    discard(root_rows)
    trees = max(1, -(-members.count() // _SHARED_ROWS))
    parts = F.ceil(F.col("holders") / _TREE_ROWS).cast("int")
    own = F.pmod(F.xxhash64("sid"), F.col("parts")).cast("int")
    # Small keys share trees; a key of several parts has a tree for each pair of its parts.
    members = (members.withColumn("parts", parts).withColumn("own", own)
               .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
               .withColumn("tree_a", F.when(F.col("parts") > 1, F.shiftrightunsigned("key", 1).bitwiseOR(F.lit(1 << 62)))
                           .otherwise(F.pmod("key", F.lit(trees))))
               .withColumn("tree_b", F.least("own", "other")).withColumn("tree_c", F.greatest("own", "other"))
               .withColumn("tree_b", F.when(F.col("parts") > 1, F.col("tree_b")).otherwise(-1))
               .select("tree_a", "tree_b", "tree_c", "sid", "root", "n"))
    # A set also goes to the trees of the next smaller size class if a partner may be of it.
    own_level = level_column(F.col("n"))
    below = level_column(F.ceil(F.col("n") * threshold / 100)) < F.col("own_level")
    levels = F.when(below, F.array(F.col("own_level"), F.col("own_level") - 1)).otherwise(F.array("own_level"))
    members = (members.withColumn("own_level", own_level).withColumn("level", F.explode(levels))
               .select("tree_a", "tree_b", "tree_c", "level", "sid", "root", "own_level").distinct())
    visited = members.groupBy("sid").agg(F.collect_set("tree_a").alias("trees"))
    described = classes.select("sid", "n", "counts").join(visited, "sid")
    candidates = tree_pairs(members.join(described, "sid"), threshold).distinct()
    more = verified(candidates, classes, docs, id_col, text_col, width, threshold)
    discard(stored)
    both = staged(links.unionByName(more).distinct(), "jaccard_links")
    discard(links, more)
    links = both

    of_set = classes.select("sid", F.col("rep.doc_id").alias("least_id"), "copies")
    found = staged(components(links), "jaccard_found")
    least = found.join(of_set.withColumnRenamed("sid", "node"), "node").groupBy("root").agg(F.min("least_id").alias("component"))
    named = found.join(least, "root").select(F.col("node").alias("sid"), "root", "component")
    answer = of_set.join(named, "sid", "left")
    if count_links:
        answer = answer.join(link_counts(found, classes, docs, id_col, text_col, width, threshold), "sid", "left")
    n_links = [(F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links")] if count_links else []
    answer = staged(answer.select("sid", F.coalesce("root", "sid").alias("root"), F.coalesce("component", "least_id").alias("component"), *n_links),
                    "jaccard_answer")
    discard(links, found, classes)
    return (sets.join(answer, "sid", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"),
                    *[F.coalesce("links", F.lit(0)).alias("n_links") for _ in n_links], "text_hash", F.col("root").alias("component")))
