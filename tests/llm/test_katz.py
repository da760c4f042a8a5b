"""The Katz model against a direct evaluation in dictionaries."""

import math
import random
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from conftest import AWKWARD
from pyspark.sql import functions as F

from sitelens.llm import katz


def tokens(text):
    return [*(w for w in (text or "").encode().lower().split()), None]


class Direct:
    """The same model, from its definition."""

    def __init__(self, texts, min_count):
        self.words, self.pairs = Counter(), Counter()
        for t in texts:
            ts = tokens(t)
            self.words.update(ts)
            self.pairs.update(zip(["<s>", *ts], ts))
        self.starts, self.n, self.min_count = len(texts), sum(self.words.values()), min_count
        k = katz.MAX_DISCOUNTED
        self.d1 = self.discounts(Counter(self.words.values()), 1)
        self.d2 = self.discounts(Counter(self.pairs.values()), min_count)
        used = sum((self.d1[c] if c <= k else 1) * c for c in self.words.values())
        self.over = self.n if used < self.n - 1e-9 else self.n + 1
        self.unknown = 1 - used / self.over if self.n else 1.0

    @staticmethod
    def discounts(kinds, least):
        k = katz.MAX_DISCOUNTED
        tail = (k + 1) * kinds[k + 1] / kinds[1] if kinds[1] else 1.0
        out = {}
        for c in range(1, k + 1):
            d = ((c + 1) * kinds[c + 1] / (c * kinds[c]) - tail) / (1 - tail) if kinds[c] and tail != 1 else 1.0
            out[c] = 0.0 if c < least else d if 0 < d <= 1 else 1.0
        return out

    def p1(self, w):
        c = self.words[w]
        return self.d1.get(c, 1.0) * c / self.over if c else self.unknown

    def p2(self, h, w):
        seen = {x: c for (g, x), c in self.pairs.items() if g == h and c >= self.min_count}
        if not seen:
            return self.p1(w)
        total = self.starts if h == "<s>" else self.words[h]
        held = sum(self.d2.get(c, 1.0) * c for c in seen.values())
        total = total if held < total * (1 - 1e-12) else total + 1
        if w in seen:
            return self.d2.get(seen[w], 1.0) * seen[w] / total
        return (1 - held / total) / (1 - sum(self.p1(x) for x in seen)) * self.p1(w)


def corpus(seed, n=60):
    rng = random.Random(seed)
    vocabulary = ["w%d" % i for i in range(30)]
    return [" ".join(rng.choices(vocabulary, [1 / (i + 1) for i in range(30)], k=rng.randint(0, 40))) for _ in range(n)]


@pytest.mark.parametrize("seed,min_count", [(1, 2), (2, 1), (3, 3)])
def test_scores_equal_the_definition(spark, frame, seed, min_count, monkeypatch):
    monkeypatch.setattr(katz, "CHUNK_BYTES", 500)
    texts = corpus(seed)
    unseen = [*corpus(seed + 10, 10), "never seen words", "w1 other w2", None]
    model = katz.train(frame([(i, t) for i, t in enumerate(texts)]), min_count=min_count)
    direct = Direct(texts, min_count)
    rows = [(i, t) for i, t in enumerate(texts + unseen)]
    got = {r["doc_id"]: r for r in katz.score(frame(rows), model).collect()}
    assert len(got) == len(rows) and model.tokens == direct.n and model.vocabulary == len(direct.words)
    for i, t in rows:
        ts = tokens(t)
        want = sum(math.log10(direct.p2(h, w)) for h, w in zip(["<s>", *ts], ts))
        base = sum(math.log10((direct.words[w] + 0.5) / (direct.n + 0.5 * (len(direct.words) + 1))) for w in ts)
        assert got[i]["score"] == pytest.approx(want, abs=1e-8) and got[i]["base_score"] == pytest.approx(base, abs=1e-8)
        assert got[i]["n_tokens"] == len(ts) and got[i]["n_known"] == sum(direct.words[w] > 0 for w in ts)


def test_distributions_sum_to_one(spark, frame):
    texts = corpus(5)
    direct = Direct(texts, 2)
    for h in ["<s>", b"w0", b"w5", b"w29", b"unknown"]:
        assert sum(direct.p2(h, w) for w in [*direct.words, b"unknown word"]) == pytest.approx(1, abs=1e-12)


def test_awkward_rows(spark, frame):
    docs = frame(AWKWARD)
    got = katz.score(docs, katz.train(docs)).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(i) for i, _ in AWKWARD)
    assert all(math.isfinite(r["score"]) and r["n_known"] == r["n_tokens"] for r in got)
    by_id = {r["doc_id"]: r["n_tokens"] for r in got}
    assert by_id[1] == 1 and by_id[2] == 1 and by_id[3] == 1 and by_id[9] == 3001


def test_empty_tables(spark, frame):
    none = frame([])
    model = katz.train(none)
    assert katz.score(none, model).count() == 0
    only = katz.score(frame([(1, "a b")]), model).first()
    assert only["n_known"] == 0 and only["score"] == 0.0


def test_single_bigrams_are_held_by_default(spark, frame):
    texts = corpus(7, 30)
    direct = Direct(texts, 1)
    assert 0 < direct.d2[1] < 1
    got = {r["doc_id"]: r["score"] for r in katz.score(frame(list(enumerate(texts))), katz.train(frame(list(enumerate(texts))))).collect()}
    for i, t in enumerate(texts):
        assert got[i] == pytest.approx(sum(math.log10(direct.p2(h, w)) for h, w in zip(["<s>", *tokens(t)], tokens(t))), abs=1e-8)


def test_a_chunk_hashes_each_distinct_word_once(monkeypatch):
    real, hashed = katz.xxhash.xxh3_64_intdigest, []
    monkeypatch.setattr(katz.xxhash, "xxh3_64_intdigest", lambda w: hashed.append(w) or real(w))
    texts = [(t or "").encode() for _, t in AWKWARD] + [b" The cat\x0bthe CAT ", b"", b"the\r\nthe"] * 3
    chunk = katz.Chunk.of(texts)
    assert len(hashed) == len(set(hashed))
    rows = [[*map(real, t.lower().split()), int(katz.END)] for t in texts]
    assert chunk.lengths.tolist() == [len(r) for r in rows]
    assert chunk.vocabulary[chunk.tokens].tolist() == [h for r in rows for h in r]
    assert chunk.vocabulary.tolist() == sorted({h for r in rows for h in r})


def test_pairs_of_the_same_upper_halves_stand_together():
    left = np.array([1, 2, 1, 2, 1 << 40, 1], np.uint64)
    right = np.array([5, 5, 5, 5, 5, 6], np.uint64)
    order = katz._together(left, right)
    ordered = list(zip(left[order].tolist(), right[order].tolist()))
    assert [p for i, p in enumerate(ordered) if not i or ordered[i - 1] != p] == list(dict.fromkeys(ordered))


def test_packed_integers_come_back():
    for x in ([], [0], [0, 0, 255], [256, 3], [5, 1 << 62], [(1 << 63) - 1]):
        x = np.array(x, np.int64)
        back = katz.unpack(katz.pack(x), np.int64)
        assert back.dtype == x.dtype and back.tolist() == x.tolist()
        keys = x.view(np.uint64)
        back = katz.unpack_sorted(katz.pack_sorted(np.sort(keys)))
        assert back.dtype == keys.dtype and back.tolist() == sorted(keys.tolist())
    keys = np.array([0, (1 << 64) - 1], np.uint64)
    assert katz.unpack_sorted(katz.pack_sorted(keys)).tolist() == keys.tolist()
    assert len(katz.pack(np.full(100, 300, np.int64))) == 201


def test_cells_are_no_wider_than_their_numbers(spark, frame, monkeypatch):
    real, size = katz.staged, {}

    def staged(df, name, *args, **more):
        out = real(df, name, *args, **more)
        size.update({(name, c): out.agg(F.sum(F.octet_length(c))).first()[0] for c, kind in out.dtypes if kind == "binary"})
        return out

    monkeypatch.setattr(katz, "staged", staged)
    texts = corpus(8, 400)
    docs, direct = frame(list(enumerate(texts))).coalesce(1), Direct(texts, 1)
    assert katz.score(docs, katz.train(docs)).count() == 400
    # Bigram counts need two bytes here, words of the chunk one; with eight and four a large cell fills the executor.
    assert size["katz_bigrams", "counts"] <= 2 * len(direct.pairs) + 1
    assert size["katz_pair_answers", "n"] <= 2 * len(direct.pairs) + 1
    assert size["katz_chunks", "tokens"] <= direct.n + 1
    assert size["katz_word_answers", "n"] <= 2 * (len(direct.words) + 1) + 1


def test_a_chunk_needs_few_bytes_a_token():
    rng = np.random.default_rng(3)
    words = rng.zipf(1.3, 200_000) % 50_000
    chunk = katz.Chunk.of([" ".join(map(str, words[i:i + 100])).encode() for i in range(0, len(words), 100)])
    tracemalloc.start()
    chunk.pair_keys()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 45 * len(chunk.tokens)
