"""Byte-level BPE encoding and decoding as recursive SQL inside each task.

A task splits its texts by the tokenizer's pattern and hands the distinct
pieces it has not met before to an in-memory DuckDB. There a piece is a set
of (piece, position, token) rows that starts with its bytes; each step of a
recursive query joins neighbouring rows with the merge table, contracts every
piece's leftmost pair of minimum rank, and ends where no pair is left. The
merge table holds, for each token, every way to cut it into two tokens, which
is the rule the public rank files are meant for: a pair may merge if its
bytes are a token, the lowest rank first. Decoding joins token rows with the
vocabulary and orders them by place; their bytes then stand one after the other.

A piece longer than ``LONG_PIECE`` bytes (a run of dashes, a word without
spaces) is first cut wherever two neighbouring bytes stand side by side in no
token: no merge ever joins across such a place, so the parts are merged each
for itself, with the same result. A word of 100 KB of random letters falls into
parts of a few bytes. A part that is still longer (one letter repeated, words run together)
takes the same steps in a loop of statements, each contracting all
occurrences of the pair of minimum rank from left to right, since a
recursive query keeps the rows of all its steps. Both end in the same
tokens: a contraction never makes a pair of lower rank in a vocabulary whose
every token encodes to itself.

The vocabulary (one line a token, at most ``MAX_VOCABULARY``) is read by the
driver and broadcast, so tasks open no file. Memory per task: blocks of 1 MB of text and
two generations of at most about ``CACHE`` pieces: when the younger is full the older is dropped.

Defined cases: null text counts as empty and has no tokens; an empty table
gives an empty result; ids may repeat or be null; other columns are not read.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitelens.llm.textops import as_bytes, blocks, id_type

MAX_VOCABULARY = 1_000_000
CACHE = 500_000
BLOCK = 1 << 20
LONG_PIECE = 64
_SPAN = 1 << 31  # rank and position share one integer: rank * _SPAN + position

_ENCODE = f"""
WITH RECURSIVE state(step, piece, pos, tok) AS (
    SELECT 0, piece, pos, tok FROM start
    UNION ALL (
    WITH pairs AS (
        SELECT l.piece, min(m.rank::BIGINT * {_SPAN} + l.pos) AS pick
        FROM state l JOIN state r ON r.piece = l.piece AND r.pos = l.pos + 1
             JOIN merges m ON m.a = l.tok AND m.b = r.tok
        GROUP BY l.piece)
    SELECT s.step + 1, s.piece,
           CASE WHEN s.pos > p.pick % {_SPAN} THEN s.pos - 1 ELSE s.pos END,
           CASE WHEN s.pos = p.pick % {_SPAN} THEN (p.pick // {_SPAN})::INTEGER ELSE s.tok END
    FROM state s JOIN pairs p ON p.piece = s.piece
    WHERE s.pos <> p.pick % {_SPAN} + 1))
SELECT s.piece, s.pos, s.tok FROM state s
JOIN (SELECT piece, max(step) AS step FROM state GROUP BY piece) last ON last.piece = s.piece AND last.step = s.step
ORDER BY s.piece, s.pos
"""

_LONG_STEP = """
CREATE OR REPLACE TABLE following AS
WITH pairs AS (
    SELECT l.piece, l.pos, m.rank FROM long_state l JOIN long_state r ON r.piece = l.piece AND r.pos = l.pos + 1
           JOIN merges m ON m.a = l.tok AND m.b = r.tok),
lowest AS (SELECT piece, pos, rank FROM pairs QUALIFY rank = min(rank) OVER (PARTITION BY piece)),
runs AS (SELECT *, pos - row_number() OVER (PARTITION BY piece ORDER BY pos) AS run FROM lowest),
taken AS (SELECT piece, pos, rank FROM runs QUALIFY (row_number() OVER (PARTITION BY piece, run ORDER BY pos)) % 2 = 1)
SELECT s.piece, (row_number() OVER (PARTITION BY s.piece ORDER BY s.pos) - 1)::INTEGER AS pos, coalesce(t.rank, s.tok) AS tok
FROM long_state s LEFT JOIN taken t ON t.piece = s.piece AND t.pos = s.pos
WHERE NOT EXISTS (SELECT 1 FROM taken x WHERE x.piece = s.piece AND x.pos = s.pos - 1)
"""

_DECODE = """
SELECT t.pos, v.bytes FROM tokens t JOIN vocabulary v ON v.tok = t.tok ORDER BY t.pos
"""


def read_vocabulary(path: str) -> dict[bytes, int]:
    """Tokens and ranks of a file with a base64 token and its rank on each line."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    if len(ranks) > MAX_VOCABULARY:
        raise ValueError(f"{path}: more than {MAX_VOCABULARY} tokens")
    return ranks


class Codec:
    """A vocabulary and pattern in a DuckDB of this process."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, cache: int = CACHE):
        import duckdb
        import regex

        self.split, self.limit = regex.compile(pattern).findall, cache
        self.young: dict[str, bytes] = {}  # pieces and their tokens, as int32
        self.old: dict[str, bytes] = {}
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"the vocabulary lacks {len(missing)} single bytes")
        self.byte_rank = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "256MB", "temp_directory": ""})
        cuts = [(ranks[t[:k]], ranks[t[k:]], r) for t, r in ranks.items() for k in range(1, len(t))
                if t[:k] in ranks and t[k:] in ranks]
        self._table("merges", ["a", "b", "rank"], [np.array(x, np.int32) for x in zip(*cuts)] or [np.zeros(0, np.int32)] * 3)
        self.beside = np.zeros((256, 256), bool)  # bytes that stand side by side in a token
        for t in ranks:
            inner = np.frombuffer(t, np.uint8)
            self.beside[inner[:-1], inner[1:]] = True
        self._table("vocabulary", ["tok", "bytes"], [np.array(list(ranks.values()), np.int32), pa.array(list(ranks), pa.binary())])

    def _table(self, name: str, columns: list[str], values: list) -> None:
        self.db.register("given", pa.table(dict(zip(columns, values))))
        self.db.execute(f"CREATE OR REPLACE TABLE {name} AS SELECT * FROM given")
        self.db.unregister("given")

    def _start(self, pieces: list[bytes]) -> pa.Table:
        sizes = np.array([len(p) for p in pieces])
        flat = np.frombuffer(b"".join(pieces), np.uint8)
        starts = np.cumsum(sizes) - sizes
        return pa.table({"piece": np.repeat(np.arange(len(pieces), dtype=np.int32), sizes),
                         "pos": (np.arange(len(flat)) - np.repeat(starts, sizes)).astype(np.int32),
                         "tok": self.byte_rank[flat]})

    def _merged(self, pieces: list[bytes], long: bool) -> list[bytes]:
        self.db.register("start", self._start(pieces))
        if long:
            self.db.execute("CREATE OR REPLACE TABLE long_state AS SELECT * FROM start")
            rows, last = self.db.execute("SELECT count(*) FROM long_state").fetchone()[0], -1
            while rows != last:
                self.db.execute(_LONG_STEP)
                self.db.execute("CREATE OR REPLACE TABLE long_state AS SELECT * FROM following")
                rows, last = self.db.execute("SELECT count(*) FROM long_state").fetchone()[0], rows
            got = self.db.execute("SELECT piece, pos, tok FROM long_state ORDER BY piece, pos").fetchnumpy()
        else:
            got = self.db.execute(_ENCODE).fetchnumpy()
        self.db.unregister("start")
        ends = (4 * np.cumsum(np.bincount(got["piece"], minlength=len(pieces)))).tolist()
        toks = np.asarray(got["tok"], np.int32).tobytes()
        return [toks[a:b] for a, b in zip([0, *ends], ends)]

    def learn(self, pieces: list[str]) -> None:
        """Put the tokens of these distinct pieces into the younger cache."""
        raw = {p: p.encode() for p in pieces}
        short = [p for p in pieces if len(raw[p]) <= LONG_PIECE]
        for a, b in blocks([len(raw[p]) for p in short], 1 << 18):
            self.young.update(zip(short[a:b], self._merged([raw[p] for p in short[a:b]], False)))
        if len(short) < len(pieces):
            parts = {p: self._parts(raw[p]) for p in pieces if len(raw[p]) > LONG_PIECE}
            distinct, merged = list(dict.fromkeys(chain.from_iterable(parts.values()))), {}
            for is_long in (False, True):
                group = [x for x in distinct if (len(x) > LONG_PIECE) == is_long]
                for a, b in blocks([len(x) for x in group], 1 << 18):
                    merged.update(zip(group[a:b], self._merged(group[a:b], is_long)))
            self.young.update((p, b"".join(map(merged.__getitem__, x))) for p, x in parts.items())

    def _parts(self, piece: bytes) -> list[bytes]:
        """The piece cut where no merge can join."""
        x = np.frombuffer(piece, np.uint8)
        cuts = (np.flatnonzero(~self.beside[x[:-1], x[1:]]) + 1).tolist()
        return [piece[a:b] for a, b in zip([0, *cuts], [*cuts, len(piece)])]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        cut = [self.split(t) for t in texts]
        new = set(chain.from_iterable(cut)) - self.young.keys()
        self.young.update({p: self.old[p] for p in new if p in self.old})
        self.learn([p for p in new if p not in self.young])
        out = [np.frombuffer(b"".join(map(self.young.__getitem__, c)), np.int32) for c in cut]
        if len(self.young) > self.limit:
            self.young, self.old = {}, self.young
        return out

    def decode(self, rows: list[np.ndarray]) -> list[bytes]:
        sizes = np.array([len(r) for r in rows], np.int64)
        flat = np.concatenate(rows) if rows else np.zeros(0, np.int32)
        self.db.register("tokens", pa.table({"pos": np.arange(len(flat), dtype=np.int64), "tok": flat.astype(np.int32)}))
        got = self.db.execute(_DECODE).to_arrow_table().combine_chunks()
        self.db.unregister("tokens")
        if not len(got):
            return [b""] * len(rows)
        column = got.column("bytes").chunk(0).cast(pa.large_binary())
        _, offsets, data = column.buffers()
        offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
        # An array's values stand one after the other: a row's bytes are those from its first token's to its last one's.
        at = offsets[np.searchsorted(got.column("pos").to_numpy(), np.concatenate([[0], np.cumsum(sizes)]))].tolist()
        data = memoryview(data)
        return [bytes(data[a:b]) for a, b in zip(at, at[1:])]


_CODECS: dict[tuple[int, str], tuple[object, Codec]] = {}


def _codec(shared, pattern: str, cache: int = CACHE) -> Codec:
    """This process's codec for a broadcast vocabulary. The entry keeps the
    broadcast alive, so its identity stands for no other one."""
    key = (id(shared), pattern)
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = (shared, Codec(shared.value, pattern, cache))
    return _CODECS[key][1]


def broadcast_vocabulary(spark: SparkSession, path: str):
    """The vocabulary for the tasks; at most ``MAX_VOCABULARY`` tokens."""
    return spark.sparkContext.broadcast(read_vocabulary(path))


def encode(docs: DataFrame, vocabulary, pattern: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False, cache: int = CACHE,
           keep_codec: bool = True) -> DataFrame:
    """One row per document: doc_id, token_ids array<int>; with ``decoded`` also
    the bytes that the tokens decode to, found by the same process. Without
    ``keep_codec`` a worker forgets its pieces after each task, which leaves
    its memory to other stages of a long job."""
    names = ["doc_id", "token_ids"] + ["decoded"] * decoded

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(vocabulary, pattern, cache)
        for b in batches:
            texts = as_bytes(b.column(1))
            for i, j in blocks([len(t) for t in texts], BLOCK):
                ids = codec.encode([t.decode("utf-8", "replace") for t in texts[i:j]])
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                columns = [b.column(0).slice(i, j - i), pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids), pa.int32()))]
                if decoded:
                    columns.append(pa.array(codec.decode(ids), pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names)
        if not keep_codec:
            codec.young, codec.old = {}, {}

    schema = f"doc_id {id_type(docs, id_col)}, token_ids array<int>" + ", decoded binary" * decoded
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)


def decode(encoded: DataFrame, vocabulary, pattern: str) -> DataFrame:
    """Rows of ``encode`` with ``decoded``, the bytes of their tokens in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(vocabulary, pattern)
        for b in batches:
            rows = [np.asarray(x.values, np.int32) if x.is_valid else np.zeros(0, np.int32) for x in b.column(1)]
            for i, j in blocks([4 * len(r) for r in rows], BLOCK):
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i), b.column(1).slice(i, j - i), pa.array(codec.decode(rows[i:j]), pa.binary())],
                    ["doc_id", "token_ids", "decoded"])

    return encoded.select("doc_id", "token_ids").mapInArrow(
        run, f"doc_id {id_type(encoded, 'doc_id')}, token_ids array<int>, decoded binary")


def token_digests(decoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, and sha256 of the ids joined by spaces and of the decoded bytes."""
    return decoded.select("doc_id", F.size("token_ids").cast("long").alias("n_tokens"),
                          F.sha2(F.array_join("token_ids", " ").cast("binary"), 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))
