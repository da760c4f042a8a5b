"""Katz backoff language model: Good-Turing discounted n-gram counts with
exactly normalised backoff weights, in partitioned tables.

P(w | h) = d(c) c(h w) / T(h) for a bigram the model holds, and
alpha(h) P(w) otherwise; P(w) = d(c) c(w) / N for a known word, and the rest
of the mass for the unknown word. d(c) is Good-Turing's discount for
counts up to ``MAX_DISCOUNTED`` (1 where it is not between 0 and 1), 1 above.
alpha(h) is what h's bigrams leave over, divided by what their words leave
over among the unigrams, so each distribution sums to 1. If nothing
would be left over, the denominator (N or T) is larger by one. Bigrams seen less than
``min_count`` times are left to the backoff; by default all are held, single ones by d(1).

Training and scoring work on chunks, some megabytes of whole documents whose
distinct n-grams a task finds with numpy. A chunk sends its n-grams, packed,
to buckets of the n-gram's hash; no n-gram comes from a chunk twice, so a
frequent one weighs no more in its bucket than a rare one. Buckets add up counts (training) or look
their keys up in the model's tables, which are partitioned by the same
buckets, and answer the chunks (scoring); a chunk then evaluates the
recursion for each of its tokens. Nothing whole passes through the driver but
sums: words, tokens, and numbers of n-grams for each count up to ``MAX_DISCOUNTED`` + 1.

Words are known by 64-bit hashes; a scored bigram is looked up by 64 mixed
bits of two of them.

Defined cases: a null text counts as empty and has one token, the end; an
empty training table gives a model in which every token is unknown, with
probability 1; ids may repeat or be null; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from sitelens.llm.textops import as_bytes, as_strings, discard, id_type, mix64, staged

MAX_DISCOUNTED = 5
MIN_COUNT = 1
CHUNK_BYTES = 4 << 20
BUCKET_BYTES = 8 << 20
#: Rows of documents, and of chunks with their answers, that a task's Python gets at a time.
DOCUMENT_ROWS, CHUNK_ROWS = 1000, 1
START = np.uint64(0x5B3C9D1E2F4A6B71)
END = np.uint64(0xA4D6E1F20B3C5D79)


@dataclass
class Katz:
    """words: (bucket, word, n, log_p, total, log_alpha); bigrams: (bucket, pairs,
    counts), a row for each bucket that holds its sorted keys and their counts
    packed; both partitioned by bucket. discounts: d(c) of words and of bigrams for c up
    to MAX_DISCOUNTED; over: what a word's discounted count is divided by."""

    words: DataFrame
    bigrams: DataFrame
    buckets: int
    tokens: int
    vocabulary: int
    log_unknown: float
    over: float
    word_discounts: list[float]
    discounts: list[float]


# ---------------------------------------------------------------- packing
def planes(x: np.ndarray) -> bytes:
    """Fixed-width integers with their bytes sorted by place: shuffles compress the empty places away."""
    return np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()


def unplanes(data: bytes, dtype) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    return np.frombuffer(data, np.uint8).reshape(width, -1).T.copy().reshape(-1).view(dtype)


def pack(x: np.ndarray) -> bytes:
    """``planes`` of integers from 0 up, without the places that none of them needs, after their number."""
    width = max(1, (int(x.max(initial=0)).bit_length() + 7) // 8)
    return bytes([width]) + np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.itemsize)[:, :width].T.tobytes()


def unpack(data: bytes, dtype) -> np.ndarray:
    width = data[0]
    out = np.zeros(((len(data) - 1) // width, np.dtype(dtype).itemsize), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8, offset=1).reshape(width, -1).T
    return out.reshape(-1).view(dtype)


def pack_sorted(keys: np.ndarray) -> bytes:
    return keys[:1].tobytes() + pack(np.diff(keys)) if len(keys) else b""


def unpack_sorted(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(0, np.uint64)
    return np.cumsum(np.append(np.frombuffer(data[:8], np.uint64), unpack(data[8:], np.uint64)), dtype=np.uint64)


def pair_key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix64(mix64(left) * np.uint64(0x9E3779B97F4A7C15) + right)


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Ascending with the key, so sorted keys come bucket by bucket."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _slices(sorted_keys: np.ndarray, buckets: int) -> list[tuple[int, int, int]]:
    of = bucket_of(sorted_keys, buckets)
    first = np.flatnonzero(np.append(True, of[1:] != of[:-1])) if len(of) else np.zeros(0, np.int64)
    return [(int(of[a]), a, b) for a, b in zip(first, np.append(first[1:], len(of)))]


# ---------------------------------------------------------------- chunks
@dataclass
class Chunk:
    vocabulary: np.ndarray  # sorted distinct words
    tokens: np.ndarray  # places in the vocabulary
    lengths: np.ndarray  # tokens of each document

    @classmethod
    def of(cls, texts: list[bytes]) -> Chunk:
        parts = pc.ascii_split_whitespace(pc.ascii_lower(as_strings(texts)))
        words = parts.flatten().dictionary_encode()
        known = words.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False)
        code, row = words.indices.to_numpy(), np.repeat(np.arange(len(texts)), parts.value_lengths().to_numpy())
        # Each distinct word is hashed once; words of one hash are one word.
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, known), np.uint64, len(known))
        blank = pc.index(words.dictionary, "").as_py()
        if blank >= 0:  # what the split finds beside white space at a text's ends
            code, row, hashes[blank] = code[code != blank], row[code != blank], END
        lengths = np.bincount(row, minlength=len(texts)) + 1
        del parts, words, known
        pa.default_memory_pool().release_unused()
        vocabulary, place = np.unique(np.append(hashes, END), return_inverse=True)
        tokens = np.full(len(code) + len(texts), place[-1], np.int32)
        tokens[np.arange(len(code)) + row] = place[code]
        return cls(vocabulary, tokens, lengths)

    def begin(self) -> np.ndarray:
        """The first token of each document."""
        return np.cumsum(self.lengths) - self.lengths

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct (context, word) as places in the vocabulary, -1 being the start, and for each token its pair."""
        base = len(self.vocabulary) + 1
        code = np.zeros(len(self.tokens), np.int64)
        code[1:] = self.tokens[:-1]
        code[1:] += 1
        code[self.begin()] = 0
        code *= base
        code += self.tokens
        order = np.argsort(code)
        code = code[order]
        new = np.append(True, code[1:] != code[:-1])
        of = np.empty(len(code), np.int32)
        of[order] = np.cumsum(new, dtype=np.int32) - 1
        del order
        code = code[new]
        return (code // base).astype(np.int32) - 1, (code % base).astype(np.int32), of

    def pair_keys(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``pairs`` sorted by key, with their keys before them."""
        left, right, of = self.pairs()
        known = np.append(self.vocabulary, START)  # -1 is the last place
        keys = pair_key(known[left], known[right])
        order = np.argsort(keys)
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order), dtype=np.int32)
        return keys[order], left[order], right[order], rank[of]


def _together(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """An order in which equal pairs of hashes are neighbours."""
    upper = (left >> np.uint64(32) << np.uint64(32)) | (right >> np.uint64(32))
    order = np.argsort(upper)
    x, y, z = upper[order], left[order], right[order]
    if ((x[1:] == x[:-1]) & ((y[1:] != y[:-1]) | (z[1:] != z[:-1]))).any():  # different pairs of the same upper halves
        return np.lexsort((right, left))
    return order


def _gathered(batches: Iterator[pa.RecordBatch], text_at: int) -> Iterator[tuple[list, list[bytes]]]:
    """Rows of a task in groups of about CHUNK_BYTES of text: Arrow slices of the ids, texts."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            b, at = batch.slice(start, 256), 0
            for i, t in enumerate(as_bytes(b.column(text_at))):
                texts.append(t)
                size += len(t)
                if size >= CHUNK_BYTES:
                    ids.append(b.column(0).slice(at, i + 1 - at))
                    yield ids, texts
                    ids, texts, size, at = [], [], 0, i + 1
            if at < b.num_rows:
                ids.append(b.column(0).slice(at))
    if texts:
        yield ids, texts


# ---------------------------------------------------------------- training
def _good_turing(kinds: dict[int, int], least: int) -> list[float]:
    """d(1..MAX_DISCOUNTED) from the numbers of n-grams of each count; 0 below ``least``."""
    n = [kinds.get(c, 0) for c in range(MAX_DISCOUNTED + 2)]
    tail = (MAX_DISCOUNTED + 1) * n[-1] / n[1] if n[1] else 1.0
    out = [0.0]
    for c in range(1, MAX_DISCOUNTED + 1):
        d = ((c + 1) * n[c + 1] / (c * n[c]) - tail) / (1 - tail) if n[c] and tail != 1 else 1.0
        out.append(0.0 if c < least else d if 0 < d <= 1 else 1.0)
    return out


def _discounted(count, discounts: list[float]):
    """d(c) c as a column."""
    expr = count.cast("double")
    for c in range(1, MAX_DISCOUNTED + 1):
        expr = F.when(count == c, F.lit(discounts[c] * c)).otherwise(expr)
    return expr


def train(docs: DataFrame, text_col: str = "text", min_count: int = MIN_COUNT) -> Katz:
    """The bigram model of the documents' texts."""
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    buckets = max(1, -(-size // BUCKET_BYTES))

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in _gathered(batches, 0):
            chunk = Chunk.of(texts)
            n = np.bincount(chunk.tokens, minlength=len(chunk.vocabulary))
            yield pa.RecordBatch.from_arrays([pa.array(chunk.vocabulary.view(np.int64)), pa.array(n)], ["word", "n"])

    texts = docs.select(text_col)
    counted = staged(texts.mapInArrow(words, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "katz_words",
                     batch_rows=DOCUMENT_ROWS)
    total = counted.agg(F.sum("n").alias("tokens"), F.count(F.lit(1)).alias("types")).first()
    tokens, types = total["tokens"] or 0, total["types"]
    starts = counted.filter(F.col("word") == int(END.view(np.int64))).agg(F.sum("n")).first()[0] or 0
    few = F.col("n") <= MAX_DISCOUNTED + 1
    kinds = {r["n"]: r["types"] for r in counted.filter(few).groupBy("n").agg(F.count(F.lit(1)).alias("types")).collect()}
    d1 = _good_turing(kinds, 1)
    used = tokens - sum(kinds.get(c, 0) * c * (1 - d1[c]) for c in range(1, MAX_DISCOUNTED + 1))
    over = tokens if used < tokens - 1e-9 else tokens + 1
    p_word = _discounted(F.col("n"), d1) / F.lit(float(over))

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in _gathered(batches, 0):
            chunk = Chunk.of(texts)
            keys, left, right, of = chunk.pair_keys()
            n = np.bincount(of, minlength=len(keys))
            cut = _slices(keys, buckets)
            known = np.append(chunk.vocabulary, START)
            left, right = known[left], known[right]
            del texts, chunk, keys, of
            book, lefts, rights = [], [], []
            for _, a, b in cut:
                own, at = np.unique(np.concatenate([left[a:b], right[a:b]]), return_inverse=True)
                book.append(pack_sorted(own))
                lefts.append(pack(at[:b - a]))
                rights.append(pack(at[b - a:]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([c[0] for c in cut], pa.int64()), pa.array(book, pa.binary()), pa.array(lefts, pa.binary()),
                 pa.array(rights, pa.binary()), pa.array([pack(n[a:b]) for _, a, b in cut], pa.binary())],
                ["bucket", "book", "context", "word", "n"])

    def add(part: pa.Table) -> pa.Table:
        bucket = part.column("bucket")[0].as_py()
        books = [unpack_sorted(x.as_py()) for x in part.column("book")]
        left = np.concatenate([b[unpack(x.as_py(), np.uint32)] for b, x in zip(books, part.column("context"))])
        right = np.concatenate([b[unpack(x.as_py(), np.uint32)] for b, x in zip(books, part.column("word"))])
        n = np.concatenate([unpack(x.as_py(), np.int64) for x in part.column("n")])
        del part, books
        order = _together(left, right)
        left, right = left[order], right[order]
        first = np.flatnonzero(np.append(True, (left[1:] != left[:-1]) | (right[1:] != right[:-1])))
        n = np.add.reduceat(n[order], first)
        left, right = left[first], right[first]
        keep = n >= min_count
        # Bigrams too rare to keep are told by their number alone.
        rare = np.bincount(n[~keep], minlength=min_count)
        rare_at = np.flatnonzero(rare)
        left, right, n = left[keep], right[keep], n[keep]
        rows = len(n) + len(rare_at)
        # The bucket's part of the model goes packed with its first row.
        keys = pair_key(left, right)
        order = np.argsort(keys)
        pa.default_memory_pool().release_unused()
        packed = [pa.concat_arrays([pa.array([x], pa.binary()), pa.nulls(rows - 1, pa.binary())])
                  for x in (pack_sorted(keys[order]), pack(n[order]))]
        del keys, order
        return pa.table({
            "bucket": np.full(rows, bucket),
            "context": np.append(left.view(np.int64), np.zeros(len(rare_at), np.int64)),
            "word": np.append(right.view(np.int64), np.zeros(len(rare_at), np.int64)),
            "n": np.append(n, rare_at), "kinds": np.append(np.ones(len(n), np.int64), rare[rare_at]),
            "pairs": packed[0], "counts": packed[1]})

    grams = (texts.mapInArrow(pairs, "bucket long, book binary, context binary, word binary, n binary").groupBy("bucket")
             .applyInArrow(add, "bucket long, context long, word long, n long, kinds long, pairs binary, counts binary"))
    grams = staged(grams, "katz_grams", batch_rows=DOCUMENT_ROWS)
    kinds = {r["n"]: r["kinds"] for r in grams.filter(few).groupBy("n").agg(F.sum("kinds").alias("kinds")).collect()}
    d2 = _good_turing(kinds, min_count)
    kept = grams.filter(F.col("n") >= min_count)
    mass = (kept.join(counted.select("word", p_word.alias("p")), "word")
            .groupBy("context").agg(F.sum(_discounted(F.col("n"), d2)).alias("held"), F.sum("p").alias("low")))
    total_of = F.when(F.col("context") == int(START.view(np.int64)), F.lit(starts)).otherwise(F.col("n")).cast("double")
    contexts = mass.join(counted.withColumnRenamed("word", "context"), "context", "left")
    total_of = F.when(F.col("held") < total_of * (1 - 1e-12), total_of).otherwise(total_of + 1)
    contexts = contexts.select(F.col("context").alias("word"), total_of.alias("total"),
                               F.log10((1 - F.col("held") / total_of) / (1 - F.col("low"))).alias("log_alpha"))
    bucket = F.lit(buckets)
    upper = F.shiftrightunsigned("word", 32)
    table = (counted.select("word", "n", F.log10(p_word).alias("log_p")).join(contexts, "word", "full_outer")
             .select(F.shiftright(upper * bucket, 32).alias("bucket"), "word", F.coalesce("n", F.lit(0)).alias("n"),
                     "log_p", "total", F.coalesce("log_alpha", F.lit(0.0)).alias("log_alpha")))
    words_table = staged(table.repartition("bucket"), "katz_unigrams", ["bucket"])
    pairs_table = staged(grams.filter("pairs IS NOT NULL").select("bucket", "pairs", "counts"), "katz_bigrams", ["bucket"])
    discard(counted, grams)
    return Katz(words_table, pairs_table, buckets, tokens, types, float(np.log10(1 - used / over)) if over else 0.0,
                float(over), d1, d2)


# ---------------------------------------------------------------- scoring
def score(docs: DataFrame, model: Katz, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_tokens, n_known, base_score, score."""
    arrow_id = to_arrow_type(docs.schema[id_col].dataType)
    buckets, tokens, vocabulary = model.buckets, model.tokens, model.vocabulary
    log_unknown, over, word_discounts, discounts = model.log_unknown, model.over, model.word_discounts, model.discounts

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId() << 32
        for i, (ids, texts) in enumerate(_gathered(batches, 1)):
            c = Chunk.of(texts)
            ids = pa.concat_arrays([x.cast(arrow_id) for x in ids])
            yield pa.RecordBatch.from_arrays(
                [pa.array([part + i]), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                 pa.array([c.lengths.tobytes()], pa.binary()), pa.array([pack(c.tokens)], pa.binary()),
                 pa.array([pack_sorted(c.vocabulary)], pa.binary())], ["chunk", "ids", "lengths", "tokens", "vocabulary"])

    chunks = staged(docs.select(F.col(id_col), F.col(text_col)).mapInArrow(
        cut, f"chunk long, ids array<{id_type(docs, id_col)}>, lengths binary, tokens binary, vocabulary binary"), "katz_chunks",
        batch_rows=DOCUMENT_ROWS)

    def unpacked(batch: pa.RecordBatch, i: int) -> Chunk:
        return Chunk(unpack_sorted(batch.column(4)[i].as_py()), unpack(batch.column(3)[i].as_py(), np.int32),
                     np.frombuffer(batch.column(2)[i].as_py(), np.int64))

    def asks(of_pairs: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for i in range(b.num_rows):
                    c = unpacked(b, i)
                    keys = c.pair_keys()[0] if of_pairs else np.sort(np.append(c.vocabulary, START))
                    parts = _slices(keys, buckets)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([p[0] for p in parts], pa.int64()), pa.array([b.column(0)[i].as_py()] * len(parts), pa.int64()),
                         pa.array([pack_sorted(keys[x:y]) for _, x, y in parts], pa.binary())], ["bucket", "chunk", "keys"])

        return chunks.mapInArrow(run, "bucket long, chunk long, keys binary")

    def found(table: np.ndarray, asked: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Places in the sorted table, and whether the key is there."""
        keys = unpack_sorted(asked)
        at = np.minimum(np.searchsorted(table, keys), max(0, len(table) - 1))
        return at, table[at] == keys if len(table) else np.zeros(len(keys), bool)

    def answer_pairs(asked: pd.DataFrame, table: pd.DataFrame) -> pd.DataFrame:
        own = np.concatenate([np.zeros(0, np.uint64), *map(unpack_sorted, table["pairs"])])
        n = np.concatenate([np.zeros(0, np.int64), *(unpack(x, np.int64) for x in table["counts"])])
        out = []
        for keys in asked["keys"]:
            at, there = found(own, keys)
            out.append(pack(np.where(there, n[at], 0) if len(n) else np.zeros(len(at), np.int64)))
        return pd.DataFrame({"chunk": asked["chunk"], "bucket": asked["bucket"], "n": out})

    def answer_words(asked: pd.DataFrame, table: pd.DataFrame) -> pd.DataFrame:
        table = table.iloc[np.argsort(table["word"].to_numpy().view(np.uint64))]
        own = table["word"].to_numpy().view(np.uint64)
        n, alpha = table["n"].to_numpy(), table["log_alpha"].to_numpy()
        # 0 or 1, but for the start; a word that is no context needs none.
        more = np.nan_to_num(table["total"].to_numpy().astype(float) - n).astype(np.int64)
        out: dict[str, list[bytes]] = {"n": [], "more": [], "log_alpha": []}
        for keys in asked["keys"]:
            at, there = found(own, keys)
            for c, column in (("n", n), ("more", more), ("log_alpha", alpha)):
                values = np.zeros(len(at), column.dtype)
                values[there] = column[at[there]]
                out[c].append(planes(values) if c == "log_alpha" else pack(values))
        return pd.DataFrame({"chunk": asked["chunk"], "bucket": asked["bucket"], **out})

    pair_answers = staged(asks(True).groupBy("bucket").cogroup(model.bigrams.groupBy("bucket"))
                          .applyInPandas(answer_pairs, "chunk long, bucket long, n binary"), "katz_pair_answers")
    word_answers = staged(asks(False).groupBy("bucket").cogroup(model.words.select("bucket", "word", "n", "total", "log_alpha").groupBy("bucket"))
                          .applyInPandas(answer_words, "chunk long, bucket long, n binary, more binary, log_alpha binary"),
                          "katz_word_answers")
    of_pairs = pair_answers.groupBy("chunk").agg(F.array_sort(F.collect_list(F.struct("bucket", "n"))).alias("pairs"))
    of_words = word_answers.groupBy("chunk").agg(
        F.array_sort(F.collect_list(F.struct("bucket", "n", "more", "log_alpha"))).alias("words"))
    rows = chunks.join(of_pairs, "chunk").join(of_words, "chunk").select("chunk", "ids", "lengths", "tokens", "vocabulary", "pairs", "words")

    def weighted(n: np.ndarray, d: list[float]) -> np.ndarray:
        """d(c) c of each count."""
        return np.where(n <= MAX_DISCOUNTED, np.array(d)[np.minimum(n, MAX_DISCOUNTED)] * n, n)

    def joined(cells: pa.StructArray, name: str, read, kind) -> np.ndarray:
        return np.concatenate([read(x.as_py(), kind) for x in cells.field(name)])

    def evaluate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                c = unpacked(b, i)
                _, left, right, of = c.pair_keys()
                held, words = joined(b.column(5)[i].values, "n", unpack, np.int64), b.column(6)[i].values
                count, more, log_alpha = (joined(words, *x) for x in (
                    ("n", unpack, np.int64), ("more", unpack, np.int64), ("log_alpha", unplanes, np.float64)))
                total = count + more
                # The place of each word, and of the start, in the answers.
                order = np.argsort(np.append(c.vocabulary, START))
                place = np.empty(len(order), np.int32)
                place[order] = np.arange(len(order), dtype=np.int32)
                word, context, own = place[:-1], place[left], place[right]
                del left, right, order
                # The recursion, once for each distinct bigram: its own estimate, or backoff to the word's.
                with np.errstate(divide="ignore", invalid="ignore"):
                    lower = np.where(count > 0, np.log10(weighted(count, word_discounts) / over), log_unknown)
                    upper = np.log10(weighted(held, discounts) / total[context])
                log_pair = np.where(held > 0, upper, log_alpha[context] + lower[own])
                del upper, held, context, own
                log_base = np.log10((count[word] + 0.5) / (tokens + 0.5 * (vocabulary + 1)))
                begin = c.begin()
                sums = [np.add.reduceat(x[at], begin) for x, at in (
                    ((count[word] > 0).astype(np.int64), c.tokens), (log_base, c.tokens), (log_pair, of))]
                yield pa.RecordBatch.from_arrays(
                    [b.column(1)[i].values, pa.array(c.lengths), *[pa.array(x) for x in sums]],
                    ["doc_id", "n_tokens", "n_known", "base_score", "score"])

    scores = staged(rows.mapInArrow(
        evaluate, f"doc_id {id_type(docs, id_col)}, n_tokens long, n_known long, base_score double, score double"),
        "katz_scores", batch_rows=CHUNK_ROWS)
    discard(chunks, pair_answers, word_answers)
    return scores
