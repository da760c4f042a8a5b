"""Cross-tokenizer alignment by merge-path partitioning.

Two tokenizers cut the same bytes; their tokens' byte ends are two ascending
lists. Merging the lists gives the alignment: between two neighbouring ends
lies one token of each side, which overlap there (a link), and where both lists
have an end, a group of tokens ends. The merge is a path through the grid of
both lists. A binary search along each of its evenly spaced diagonals finds
where the path crosses it, which cuts the merge into pieces of equal work,
wherever documents begin or end; an end that both lists have is never cut
apart. Pieces are merged independently of each other; a group that is open at
a piece's border goes on in the next one.

The texts of a chunk (some megabytes) are merged as one pair of lists: all
tokens of a document end where it ends on both sides, so nothing reaches
across. A chunk returns the alignments of its documents, and how often each pair
of ids is linked in it. Corpus-wide counts: chunks send their distinct pairs, packed, to
buckets of the pair's hash, which add them up and answer each chunk; a pair comes from a
chunk once, so a frequent pair is no hot key. The highest count of each id of
the second tokenizer is one row for each id of its vocabulary, so it can be
broadcast. A chunk then reads the counts off for the links of its documents,
which it kept as sorted codes of (document, pair).

The vocabulary files are read by the driver and broadcast (together at most
``MAX_FILES`` bytes), so tasks open no file. The first tokenizer is byte-level
BPE: its merges are in the order of the ids they make (checked), so they are
taken by rank, which is faster and gives the same ids.

Memory of a task: a chunk of ``CHUNK_BYTES`` of text, or one text if longer, and
about 50 bytes for each byte of it; then a bucket, about ``BUCKET_BYTES`` of text's pairs.

Defined cases: a null or empty text, or one whose tokens don't join to a blank
and the text (the second tokenizer may normalise; U+2581 reads as a blank), has
no tokens: all numbers are 0 and groups is ''; ids may repeat or be null; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from sitelens.llm.katz import pack_sorted, planes, unpack_sorted, unplanes
from sitelens.llm.textops import as_bytes, discard, id_type, mix64, staged

CHUNK_BYTES = 6 << 20
BUCKET_BYTES = 16 << 20
#: Steps of the merge path in a piece.
PIECE = 1 << 16
MAX_FILES = 64 << 20
DOCUMENT_ROWS, CHUNK_ROWS = 1000, 1


# ---------------------------------------------------------------- merge path
def path_cuts(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """Where the merge path of two ascending lists crosses every ``piece``-th diagonal:
    how many items of each list come before. Equal items stay together."""
    diagonal = np.append(np.arange(0, len(a) + len(b), piece), len(a) + len(b))
    low, high = np.maximum(diagonal - len(b), 0), np.minimum(diagonal, len(a))
    while (low < high).any():  # the first i for which a[i] comes after b[diagonal - 1 - i]
        middle = (low + high) // 2
        open_ = low < high
        take = open_ & (a[np.minimum(middle, len(a) - 1)] <= b[np.clip(diagonal - 1 - middle, 0, len(b) - 1)]) if len(a) and len(b) else open_ & False
        low, high = np.where(take, middle + 1, low), np.where(open_ & ~take, middle, high)
    i, j = low, diagonal - low
    if len(a) and len(b):
        apart = (i > 0) & (j < len(b))
        apart &= a[np.maximum(i - 1, 0)] == b[np.minimum(j, len(b) - 1)]
        j = j + apart
    return i, j


def merge_piece(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of two ascending lists of ends without repeats: for each different end in
    order, the places in both lists of the tokens that meet before it, and whether both end there."""
    in_b, in_a = np.searchsorted(b, a), np.searchsorted(a, b)
    both_a = b[np.minimum(in_b, len(b) - 1)] == a if len(b) else np.zeros(len(a), bool)
    own_b = np.flatnonzero(a[np.minimum(in_a, len(a) - 1)] != b) if len(a) else np.arange(len(b))
    in_a = in_a[own_b]
    # An end's place among the different ones: its place in its own list and the number of the other's before it.
    place_a = np.arange(len(a)) + in_b - np.cumsum(both_a) + both_a
    place_b = np.arange(len(own_b)) + in_a
    x, y, both = np.empty(n := len(a) + len(own_b), np.int64), np.empty(n, np.int64), np.zeros(n, bool)
    x[place_a], y[place_a], both[place_a] = np.arange(len(a)), in_b, both_a
    x[place_b], y[place_b] = in_a, own_b
    return x, y, both


def merged(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``merge_piece`` of whole lists, piece by piece."""
    i, j = path_cuts(a, b, piece)
    parts = []
    for i0, i1, j0, j1 in zip(i[:-1], i[1:], j[:-1], j[1:]):
        x, y, both = merge_piece(a[i0:i1], b[j0:j1])
        parts.append((x + i0, y + j0, both))
    none = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool))
    return tuple(np.concatenate(p) for p in zip(none, *parts))


# ---------------------------------------------------------------- tokenizers
def _byte_letters() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves, the others as the characters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(sorted(set(range(256)) - set(plain)))}


@dataclass
class Codec:
    """Both tokenizers, and their tokens' bytes by id."""

    first: object
    second: object
    spelled: tuple[list[bytes], list[bytes]]

    @classmethod
    def of(cls, vocabulary: bytes, model: bytes) -> Codec:
        import public_tokenizers
        import sentencepiece
        import tiktoken

        parsed = json.loads(vocabulary)
        letters, ids = _byte_letters(), parsed["model"]["vocab"]
        special = {t["id"] for t in parsed["added_tokens"]}
        made = [ids["".join(m)] if isinstance(m, list) else ids[m.replace(" ", "")] for m in parsed["model"]["merges"]]
        if made != sorted(made) or parsed["normalizer"] or parsed["pre_tokenizer"]["type"] != "ByteLevel":
            raise ValueError("not a byte-level BPE whose merges are in the order of their tokens' ids")
        spelled: list[bytes] = [b""] * (max(ids.values()) + 1)
        for token, i in ids.items():
            spelled[i] = b"" if i in special else bytes(letters[c] for c in token)
        first = tiktoken.Encoding("first", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                  mergeable_ranks={t: i for i, t in enumerate(spelled) if t})
        second = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces = [bytes([int(p[1:-1], 16)]) if second.is_byte(i) else p.replace("▁", " ").encode()
                  for i in range(second.get_piece_size()) for p in [second.id_to_piece(i)]]
        return cls(first, second, (spelled, pieces))

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        a = [np.asarray(self.first.encode_ordinary(" " + t), np.int64) for t in texts]
        return a, [np.asarray(ids, np.int64) for ids in self.second.encode(texts, num_threads=1)] if texts else []


_CODECS: dict[bytes, Codec] = {}


def _codec(files) -> Codec:
    """The worker's own codec; building it takes a while."""
    vocabulary, model = files.value
    key = hashlib.sha256(vocabulary + model).digest()
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec.of(vocabulary, model)
    return _CODECS[key]


def _joined(spelled: pa.Array, ids: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The ids' texts as one Arrow array, and where each begins in its data (one more at the end)."""
    taken = spelled.take(pa.array(ids))
    return taken, np.frombuffer(taken.buffers()[1], np.int32)[:len(ids) + 1] if len(ids) else np.zeros(1, np.int32)


class Aligner:
    def __init__(self, codec: Codec, piece: int = PIECE):
        self.codec, self.piece = codec, piece
        self.bytes = [pa.array(s, pa.binary()) for s in codec.spelled]
        self.widths = [np.array([len(t) for t in s], np.int64) for s in codec.spelled]
        self.n = [len(s) for s in codec.spelled]
        numbers = [[str(i).encode() for i in range(n)] for n in self.n]
        # The ids written out with what follows: a, or a| at a group's end, b, or b; or b at the text's end.
        self.written = pa.array([x + e for e in (b",", b"|") for x in numbers[0]] + [x + e for e in (b",", b";", b"") for x in numbers[1]], pa.binary())

    def align(self, texts: list[bytes]) -> Alignment:
        decoded = [t.decode("utf-8", "replace") for t in texts]
        sides = self.codec.encode(decoded)
        whole = [b" " + t for t in texts]
        same = np.array([len(t) > 0 for t in texts], bool)
        for rows, spelled in zip(sides, self.bytes):
            ends = np.cumsum([len(r) for r in rows])
            taken, at = _joined(spelled, np.concatenate([np.zeros(0, np.int64), *rows]))
            data = memoryview((taken.buffers()[2] if len(taken) else None) or b"").cast("B")
            for i, (t, n, e) in enumerate(zip(whole, map(len, rows), ends)):
                same[i] = same[i] and data[at[e - n]:at[e]] == t
        none = np.zeros(0, np.int64)
        rows = [[r if s else none for r, s in zip(side, same)] for side in sides]
        ids = [np.concatenate([none, *side]) for side in rows]
        counts = [np.array([len(r) for r in side], np.int64) for side in rows]
        ends = [np.cumsum(w[i]) for w, i in zip(self.widths, ids)]
        x, y, both = merged(*ends, self.piece)
        return Alignment(self, ids, counts, ends, x, y, both)


@dataclass
class Alignment:
    """Of a chunk's texts: ids, tokens of each text, byte ends; links as places in the ids, and whether a group ends with them."""

    aligner: Aligner
    ids: list[np.ndarray]
    counts: list[np.ndarray]
    ends: list[np.ndarray]
    x: np.ndarray
    y: np.ndarray
    both: np.ndarray

    def totals(self) -> tuple[np.ndarray, np.ndarray]:
        """Groups and links of each text."""
        last = np.cumsum(self.counts[0])
        before = np.searchsorted(self.x, last)  # a text's links are those of its tokens
        groups = np.append(0, np.cumsum(self.both))
        return np.diff(groups[before], prepend=0), np.diff(before, prepend=0)

    def pair_codes(self) -> np.ndarray:
        return self.ids[0][self.x] * self.aligner.n[1] + self.ids[1][self.y]

    def written(self) -> pa.Array:
        """Each text's groups: ids of both sides in order, as ``a1,a2|b1;a3|b2,b3``."""
        (a, b), (n_a, n_b) = self.ids, self.aligner.n
        stop_a, stop_b = self.x[self.both], self.y[self.both]  # last token of each group
        last_a, last_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        last_a[stop_a], last_b[stop_b] = 1, 1
        last_b[np.cumsum(self.counts[1])[self.counts[1] > 0] - 1] = 2
        size_a, size_b = np.diff(stop_a, prepend=-1), np.diff(stop_b, prepend=-1)
        codes = np.empty(len(a) + len(b), np.int64)
        codes[np.arange(len(a)) + np.repeat(np.cumsum(size_b) - size_b, size_a)] = a + last_a * n_a
        codes[np.arange(len(b)) + np.repeat(np.cumsum(size_a), size_b)] = 2 * n_a + b + last_b * n_b
        taken, at = _joined(self.aligner.written, codes)
        offsets = np.append(0, at[np.cumsum(self.counts[0] + self.counts[1])]).astype(np.int32)
        data = taken.buffers()[2] if len(taken) else None
        return pa.Array.from_buffers(pa.string(), len(self.counts[0]), [None, pa.py_buffer(offsets.tobytes()), data or pa.py_buffer(b"")])


# ---------------------------------------------------------------- corpus
@dataclass
class Tokenizers:
    """Both vocabulary files, broadcast, and how many ids the second tokenizer has."""

    files: object
    second: int


def read_tokenizers(spark, vocabulary_path: str, model_path: str) -> Tokenizers:
    files = tuple(Path(p).read_bytes() for p in (vocabulary_path, model_path))
    if sum(map(len, files)) > MAX_FILES:
        raise ValueError(f"vocabulary files of more than {MAX_FILES} bytes are not broadcast")
    return Tokenizers(spark.sparkContext.broadcast(files), len(Codec.of(*files).spelled[1]))


def _chunks(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[pa.Array, list[bytes]]]:
    """A task's rows in groups of about ``limit`` bytes of text: ids, texts."""
    ids, texts, size = [], [], 0
    for batch in batches:
        at = 0
        for i, t in enumerate(as_bytes(batch.column(1))):
            texts.append(t)
            size += len(t)
            if size >= limit:
                yield pa.concat_arrays([*ids, batch.column(0).slice(at, i + 1 - at)]), texts
                ids, texts, size, at = [], [], 0, i + 1
        if at < batch.num_rows:
            ids.append(batch.column(0).slice(at))
    if texts:
        yield pa.concat_arrays(ids), texts


def _packed(x: np.ndarray) -> bytes:
    return zstandard.compress(planes(x), 3)


def _unpacked(data: bytes, dtype) -> np.ndarray:
    return unplanes(zstandard.decompress(data), dtype)


def _bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (mix64(keys) % np.uint64(buckets)).astype(np.int64)


def bucket_count(docs: DataFrame, text_col: str = "text") -> int:
    return max(1, -(-(docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0) // BUCKET_BYTES))


def align(docs: DataFrame, tokenizers: Tokenizers, buckets: int, id_col: str = "doc_id", text_col: str = "text",
          chunk_bytes: int = CHUNK_BYTES, piece: int = PIECE) -> DataFrame:
    """Rows of documents: chunk, place (in the chunk), doc_id, n_a, n_b, n_groups,
    n_links and groups, the alignment written out. Besides, for ``link_counts``,
    rows (chunk, bucket, keys, n) of a chunk's distinct linked id pairs, and for each
    chunk one row of bucket -1 (chunk, keys, links of each text in n, codes of the links in links)."""
    files, arrow_id = tokenizers.files, to_arrow_type(docs.schema[id_col].dataType)
    schema = pa.schema([("chunk", pa.int64()), ("place", pa.int32()), ("doc_id", arrow_id), ("n_a", pa.int64()), ("n_b", pa.int64()),
                        ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups", pa.string()), ("bucket", pa.int64()),
                        ("keys", pa.binary()), ("n", pa.binary()), ("links", pa.binary())])

    def rows(count: int, /, **columns) -> pa.RecordBatch:
        arrays = [columns[f.name] if f.name in columns else pa.nulls(count, f.type) for f in schema]
        return pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x, f.type) for x, f in zip(arrays, schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        aligner, chunk = Aligner(_codec(files), piece), TaskContext.get().partitionId() << 32
        for ids, texts in _chunks(batches, chunk_bytes):
            found = aligner.align(texts)
            n_groups, n_links = found.totals()
            yield rows(len(ids), chunk=np.full(len(ids), chunk), place=np.arange(len(ids)), doc_id=ids.cast(arrow_id), n_a=found.counts[0],
                       n_b=found.counts[1], n_groups=n_groups, n_links=n_links, groups=found.written())
            keys, of, n = np.unique(found.pair_codes(), return_inverse=True, return_counts=True)
            codes = np.sort(np.repeat(np.arange(len(ids)), n_links) * len(keys) + of)
            keys = keys.astype(np.uint64)
            yield rows(1, chunk=[chunk], bucket=[-1], keys=[pack_sorted(keys)], n=[n_links.tobytes()], links=[_packed(np.diff(codes, prepend=0))])
            bucket = _bucket_of(keys, buckets)
            order = np.argsort(bucket, kind="stable")
            parts = np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1) if len(order) else []
            yield rows(len(parts), chunk=[chunk] * len(parts), bucket=[bucket[p[0]] for p in parts],
                       keys=[pack_sorted(keys[p]) for p in parts], n=[planes(n[p].astype(np.uint32)) for p in parts])
            chunk += 1

    kinds = {"chunk": "long", "place": "int", "doc_id": id_type(docs, id_col), "n_a": "long", "n_b": "long", "n_groups": "long",
             "n_links": "long", "groups": "string", "bucket": "long", "keys": "binary", "n": "binary", "links": "binary"}
    return docs.select(id_col, text_col).mapInArrow(run, ", ".join(f"{k} {v}" for k, v in kinds.items()))


def link_counts(aligned: DataFrame, tokenizers: Tokenizers, buckets: int) -> DataFrame:
    """``align``'s rows of documents (other columns kept) with n_best, the links whose
    pair is linked most often in the corpus among the pairs of its second id, and
    count_sum, the corpus-wide counts summed over the links. ``aligned`` must be a
    written table, made with as many ``buckets``."""
    second = tokenizers.second
    slices = aligned.filter("bucket >= 0").select("chunk", "bucket", "keys", "n")

    def add(part: pd.DataFrame) -> pd.DataFrame:
        keys = [unpack_sorted(k).astype(np.int64) for k in part["keys"]]
        every, of = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.zeros(len(every), np.int64)
        np.add.at(total, of, np.concatenate([unplanes(n, np.uint32) for n in part["n"]]).astype(np.int64))
        ends = np.cumsum([len(k) for k in keys])
        answers = [planes(total[of[e - len(k):e]]) for k, e in zip(keys, ends)]
        second_ids, at = np.unique(every % second, return_inverse=True)
        most = np.zeros(len(second_ids), np.int64)
        np.maximum.at(most, at, total)
        n = len(second_ids)
        return pd.DataFrame({"chunk": pd.array([*part["chunk"], *[None] * n], "Int64"), "bucket": pd.array([*part["bucket"], *[None] * n], "Int64"),
                             "total": [*answers, *[None] * n], "id": pd.array([*[None] * len(part), *second_ids], "Int64"),
                             "most": pd.array([*[None] * len(part), *most], "Int64")})

    answers = staged(slices.groupBy("bucket").applyInPandas(add, "chunk long, bucket long, total binary, id long, most long"), "alignment_counts")
    most = np.zeros(second, np.int64)
    for i, n in answers.filter("id IS NOT NULL").groupBy("id").agg(F.max("most")).collect():  # a row for each id of the vocabulary at most
        most[i] = n
    highest = aligned.sparkSession.sparkContext.broadcast(most)

    def evaluate(links: pd.DataFrame, totals: pd.DataFrame) -> pd.DataFrame:
        row = links.iloc[0]
        n_links = np.frombuffer(row["n"], np.int64)
        keys = unpack_sorted(row["keys"])
        total = np.zeros(len(keys), np.int64)
        if len(keys):
            by_bucket = dict(zip(totals["bucket"], totals["total"]))
            total[np.argsort(_bucket_of(keys, buckets), kind="stable")] = np.concatenate([unplanes(by_bucket[b], np.int64) for b in sorted(by_bucket)])
        keys = keys.astype(np.int64)
        best = (total == highest.value[keys % second]).astype(np.int64)
        pair = np.cumsum(_unpacked(row["links"], np.int64)) % max(1, len(keys))
        ends = np.append(0, np.cumsum(n_links))
        of_links = [np.diff(np.append(0, np.cumsum(x[pair]))[ends]) for x in (best, total)]
        return pd.DataFrame({"chunk": row["chunk"], "place": np.arange(len(n_links), dtype=np.int32), "n_best": of_links[0], "count_sum": of_links[1]})

    chunks = aligned.filter("bucket = -1").select("chunk", "keys", "n", "links")
    counted = staged(chunks.groupBy("chunk").cogroup(answers.filter("chunk IS NOT NULL").select("chunk", "bucket", "total").groupBy("chunk"))
                     .applyInPandas(evaluate, "chunk long, place int, n_best long, count_sum long"), "alignment_links", batch_rows=CHUNK_ROWS)
    discard(answers)
    return aligned.filter("bucket IS NULL").drop("bucket", "keys", "n", "links").join(counted, ["chunk", "place"]).drop("chunk", "place")
