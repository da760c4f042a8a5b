"""Periodic runs of words, found online on sparse diagonals.

A run is a stretch of consecutive words with smallest period q (words q apart
are the same) and a length of at least ``max(least_words, least_copies * q)``
that no neighbouring word extends. Such a run is a stretch of matches
``word[i] == word[i - q]`` on the diagonal with lag q, ``length - q`` long.

A text is read word by word; a word's earlier occurrences are the lags it
matches on, and each match adds one to its lag's match length. Two facts keep
the diagonals sparse, so a text of one word repeated a million times takes no
more than others do:

* Context. A run of lag q has more than q matches in a row (at least 16 where
  q is at most 16), so a word only counts as occurring earlier if the words
  before it agree too: 16 words for lags up to 16, else as many as the power of
  two L with L/2 < q <= L. Names of such contexts come from doubling: equal
  names of two neighbouring halves make equal names of the whole.
* Nearest occurrence. In a run of smallest period q, a context of q words or
  more stands exactly at distances that are multiples of q (a primitive word
  occurs in its own repetitions at multiples of its length only). So of all
  earlier occurrences of a context the nearest one has the run's lag, and any
  other lag is no smallest period. Each word has one active lag for each
  context length, and a diagonal ends, and emits its run if long enough, when
  the active lag changes.

This takes n words times the number of context lengths, which stops at the
first length that no context of the text has twice. Contexts of 16 words are
first compared by 64-bit hashes over a block of texts; only a text with equal
hashes goes on, with exact names.

Memory of a task: blocks of 2 MB of text, or one text if longer: the numbers
of its words and of their contexts (a few dozen bytes a word) and its distinct words.

Defined cases: a null, empty or blank text has no words and no runs, and its
collapsed text is empty; ids may repeat or be null; an empty table gives an
empty result; words are compared by their bytes; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitelens.llm.textops import as_bytes, as_strings, blocks, id_type, mix64, word_slabs

LEAST_WORDS, LEAST_COPIES = 24, 3
#: Words of the shortest context.
CONTEXT = 16


def numbered(text: bytes, numbers: dict[bytes, int]) -> np.ndarray:
    """The words of a text as numbers; ``numbers`` gets the new ones."""
    parts = [np.zeros(0, np.int64)]
    for words in word_slabs(text):
        for w in set(words).difference(numbers):
            numbers[w] = len(numbers)
        parts.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
    return np.concatenate(parts)


def recurring_contexts(texts: list[np.ndarray]) -> np.ndarray:
    """Whether a text may hold ``CONTEXT`` words in a row twice (by hashes, so never a false no)."""
    lengths = np.array([len(t) for t in texts], np.int64)
    out = np.zeros(len(texts), bool)
    if lengths.sum() <= CONTEXT:
        return out
    with np.errstate(over="ignore"):
        h = mix64(np.concatenate(texts).astype(np.uint64) + np.uint64(1))
        step = 1
        while step < CONTEXT:
            h = h[:-step] * np.uint64(0x9E3779B97F4A7C15) + h[step:]
            h ^= h >> np.uint64(29)
            step *= 2
        starts = np.cumsum(lengths) - lengths
        of = np.repeat(np.arange(len(texts)), lengths)
        inside = np.arange(len(h)) + CONTEXT <= (starts + lengths)[of[:len(h)]]
        of = of[:len(h)][inside]
        key = mix64(h[inside] + mix64(of.astype(np.uint64)))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    a, b = of[order[1:][same]], of[order[:-1][same]]
    out[a[a == b]] = True
    return out


def _lags(names: np.ndarray) -> np.ndarray:
    """The distance to the nearest earlier place of the same name, 0 if there is none."""
    order = np.argsort(names, kind="stable")
    lag = np.zeros(len(names), np.int64)
    same = names[order][1:] == names[order][:-1]
    lag[order[1:][same]] = (order[1:] - order[:-1])[same]
    return lag


def runs(words: np.ndarray, least_words: int = LEAST_WORDS, least_copies: int = LEAST_COPIES) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a numbered text, by start and then period."""
    if least_words < CONTEXT + CONTEXT // 2 or least_copies < 3:
        raise ValueError(f"a run needs at least {CONTEXT + CONTEXT // 2} words and 3 copies")
    found: list[tuple[int, int, int]] = []
    names, context = words, 1
    while context < CONTEXT:  # names[i] is the context of the words from i on
        names, context = _doubled(names, context), context * 2
    least_lag = 1
    while len(names):
        lag = _lags(names)
        if not lag.any():
            break
        # Stretches of one active lag; each place adds one to the match length, which begins with the context's.
        edge = np.flatnonzero(np.append(True, lag[1:] != lag[:-1]))
        end = np.append(edge[1:], len(lag))
        q = lag[edge]
        length = end - edge + context - 1 + q
        keep = (q >= least_lag) & (q <= context) & (length >= np.maximum(least_words, least_copies * q))
        found += zip((edge[keep] - q[keep]).tolist(), length[keep].tolist(), q[keep].tolist())
        least_lag, names, context = context + 1, _doubled(names, context), context * 2
    return sorted(found, key=lambda run: (run[0], run[2]))


def _doubled(names: np.ndarray, context: int) -> np.ndarray:
    if len(names) <= context:
        return names[:0]
    pairs = names[:-context] * np.int64(names.max() + 1) + names[context:]
    return np.unique(pairs, return_inverse=True)[1].astype(np.int64)


def kept_words(n: int, found: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of n words stay when each run keeps its first period only."""
    depth = np.zeros(n + 1, np.int64)
    for start, length, period in found:
        depth[start + period] += 1
        depth[start + length] -= 1
    return np.cumsum(depth[:-1]) == 0


def _joined(words: np.ndarray, spelled: list[bytes]) -> bytes:
    return b" ".join(map(spelled.__getitem__, words.tolist()))


Reorder = Callable[[object, int], "np.ndarray | None"]


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_words: int = LEAST_WORDS,
                  least_copies: int = LEAST_COPIES, reorder: Reorder | None = None) -> DataFrame:
    """One row per document: doc_id, n_words, runs (start, length, period; by start and
    then period) and collapsed, its text with one blank between words and each
    run cut to its first period. ``reorder`` may give, for an id and a number of
    words, which of the document's words stands at each place."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in batches:
            every = as_bytes(batch.column(1))
            ids = batch.column(0).to_pylist() if reorder else []
            for a, b in blocks([len(t) for t in every]):
                numbers: dict[bytes, int] = {}
                texts = [numbered(t, numbers) for t in every[a:b]]
                if reorder:
                    for i, t in enumerate(texts):
                        order = reorder(ids[a + i], len(t))
                        if order is not None:
                            texts[i] = t[order]
                spelled = list(numbers)
                may = recurring_contexts(texts)
                found = [runs(t, least_words, least_copies) if m else [] for t, m in zip(texts, may)]
                kept = [_joined(t[kept_words(len(t), r)] if r else t, spelled) for t, r in zip(texts, found)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array([len(t) for t in texts], pa.int64()),
                     pa.array([[dict(zip(("start", "length", "period"), run)) for run in r] for r in found], kind),
                     as_strings(kept)], ["doc_id", "n_words", "runs", "collapsed"])

    return docs.select(id_col, text_col).mapInArrow(
        find, f"doc_id {id_type(docs, id_col)}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def strongest(found: Column) -> Column:
    """The run with the greatest length / period, compared exactly; the first of several."""
    none = F.lit(None).cast("struct<start:long,length:long,period:long>")
    return F.aggregate(found, none, lambda best, run: F.when(
        best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"]), run).otherwise(best))


def listed(found: Column) -> Column:
    """Every run as a line ``start,length,period``."""
    return F.array_join(F.transform(found, lambda run: F.concat(
        F.concat_ws(",", run["start"].cast("string"), run["length"].cast("string"), run["period"].cast("string")), F.lit("\n"))), "")
