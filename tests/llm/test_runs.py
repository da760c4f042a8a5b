import hashlib
import random

import numpy as np
import pytest
from conftest import AWKWARD

from sitelens.llm import periodic_runs


def brute(w, least_words=24, least_copies=3):
    """Every lag's stretches of equal words; of equal stretches the smallest lag is the period."""
    found = {}
    for q in range(1, len(w) // least_copies + 1):
        i = q
        while i < len(w):
            j = i
            while j < len(w) and w[j] == w[j - q]:
                j += 1
            if j > i and j - i + q >= max(least_words, least_copies * q):
                found.setdefault((i - q, j - i + q), q)
            i = max(i + 1, j)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def collapsed(w, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return b" ".join(x for i, x in enumerate(w) if i not in gone)


def texts(seed, count):
    """Repetitions of short and long units, nested and broken off, among random words."""
    rng = random.Random(seed)
    for _ in range(count):
        n, letters, w = rng.choice([0, 23, 24, 30, 60, 100, 250]), rng.choice([1, 2, 3, 5]), []
        while len(w) < n:
            if rng.random() < .6:
                unit = [rng.randrange(letters) for _ in range(rng.choice([1, 1, 2, 3, 7, 8, 9, 15, 16, 17, 18, 31, 32, 33, 40]))]
                w += unit * rng.randrange(1, 8) + unit[:rng.randrange(len(unit))]
            else:
                w += [rng.randrange(letters + 3) for _ in range(rng.randrange(6))]
        yield w[:n]


@pytest.mark.parametrize("least_words,least_copies", [(24, 3), (24, 5), (40, 3)])
def test_runs_equal_every_lag(least_words, least_copies):
    seen = 0
    for w in texts(least_words + least_copies, 700):
        words, want = np.array(w, np.int64), brute(w, least_words, least_copies)
        assert periodic_runs.runs(words, least_words, least_copies) == want
        assert periodic_runs.recurring_contexts([words])[0] or not want
        seen += len(want)
    assert seen > 100


def test_one_word_many_times():
    assert periodic_runs.runs(np.zeros(300_000, np.int64)) == [(0, 300_000, 1)]


def test_contexts_do_not_cross_texts():
    part = np.arange(30, dtype=np.int64)
    assert periodic_runs.recurring_contexts([part, part]).tolist() == [False, False]
    assert periodic_runs.recurring_contexts([part, np.append(part, part), part]).tolist() == [False, True, False]


def test_bounds_that_contexts_cannot_serve():
    with pytest.raises(ValueError):
        periodic_runs.runs(np.zeros(30, np.int64), 10, 3)
    with pytest.raises(ValueError):
        periodic_runs.runs(np.zeros(30, np.int64), 24, 2)


def test_frames(spark, frame, monkeypatch):
    names = [f"w{i}" if i else "É 日" for i in range(10)]
    rows = [*AWKWARD, *((100 + i, " \n".join(names[x] for x in w)) for i, w in enumerate(texts(9, 120)))]
    got = periodic_runs.periodic_runs(frame(rows)).collect()
    want = []
    for i, t in rows:
        w = (t or "").encode().split()
        want.append((i, len(w), brute(w), collapsed(w, brute(w)).decode()))
    key = lambda r: str(r)
    assert sorted(((r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in got), key=key) == sorted(want, key=key)


def test_a_text_of_many_slabs(spark, frame):
    text = "lorem ipsum dolor sit amet " * 60_000
    row = periodic_runs.periodic_runs(frame([(1, text)])).first()
    assert [tuple(r) for r in row["runs"]] == [(0, 300_000, 5)] and row["collapsed"] == "lorem ipsum dolor sit amet"


def test_strongest_and_listing(spark, frame):
    from pyspark.sql import functions as F

    text = " ".join(["a"] * 30 + ["x", "y"] + ["b"] * 30 + ["z"] + ["c", "d"] * 40)
    found = periodic_runs.periodic_runs(frame([(1, text), (2, "none")]))
    rows = {r["doc_id"]: r for r in found.select("doc_id", periodic_runs.strongest(F.col("runs")).alias("best"),
                                                 periodic_runs.listed(F.col("runs")).alias("list")).collect()}
    assert tuple(rows[1]["best"]) == (63, 80, 2) and rows[1]["list"] == "0,30,1\n32,30,1\n63,80,2\n"
    assert rows[2]["best"] is None and rows[2]["list"] == ""


def test_reordered_words(spark, frame):
    row = periodic_runs.periodic_runs(frame([(1, "a b c d"), (2, "a b c d")]), reorder=lambda i, n: np.arange(n)[::-1] if i == 1 else None)
    assert {r["doc_id"]: r["collapsed"] for r in row.collect()} == {1: "d c b a", 2: "a b c d"}


def test_empty_table(spark, frame):
    assert periodic_runs.periodic_runs(frame([])).count() == 0


def test_hash_is_of_collapsed_text():
    w = [b"a"] * 40
    assert hashlib.sha256(collapsed(w, brute(w))).digest() == hashlib.sha256(b"a").digest()
