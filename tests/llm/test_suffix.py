import hashlib
import random

import numpy as np
import pytest
from conftest import AWKWARD

from sitelens.llm import suffix_array, suffix_dedup


@pytest.mark.parametrize("small", [suffix_array._SMALL_ALPHABET, 0])
def test_suffix_array(small, monkeypatch):
    monkeypatch.setattr(suffix_array, "_SMALL_ALPHABET", small)
    rng = random.Random(4)
    for k in (1, 2, 4, 255):
        for repeat in (1, 3):
            b = bytes(rng.randrange(k) for _ in range(rng.randint(0, 150))) * repeat
            s = [*(x + 1 for x in b), 0]
            assert suffix_array.suffix_array(np.array(s), 257).tolist() == sorted(range(len(s)), key=lambda i: s[i:])


def expected(texts, width):
    """Removed bytes by counting every window."""
    seen = {}
    for t in texts:
        for i in range(len(t) - width + 1):
            seen[t[i:i + width]] = seen.get(t[i:i + width], 0) + 1
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - width + 1):
            if seen[t[i:i + width]] > 1:
                gone[i:i + width] = True
        spans = int((np.diff(np.append(0, gone.astype(int))) == 1).sum())
        out.append((len(t), int(gone.sum()), spans, hashlib.sha256(bytes(np.frombuffer(t, np.uint8)[~gone])).hexdigest()))
    return out


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdeé", k=rng.randint(1, 6)))
    passages = [" ".join(word() for _ in range(40)) for _ in range(3)]
    texts = []
    for i in range(60):
        t = " ".join(word() for _ in range(rng.randint(0, 80)))
        if i % 4 == 0:
            t += rng.choice(passages)[rng.randint(0, 30):] + " " + word()
        if i % 7 == 0:
            t += "-" * rng.randint(20, 400) + word()
        texts.append(t)
    return [*texts, *texts[:5], texts[6][:-3] + "zz", "ab" * 300, None, ""]


@pytest.mark.parametrize("hot,block,windows", [(4096, 1 << 20, 2048), (1, 300, 10), (4096, 300, 50)])
def test_removal_equals_counting(spark, frame, monkeypatch, hot, block, windows):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    monkeypatch.setattr(suffix_dedup, "BLOCK", block)
    monkeypatch.setattr(suffix_dedup, "MAX_WINDOWS", windows)
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 2000)
    texts = corpus(hot)
    want = expected([(t or "").encode() for t in texts], 50)
    rows = suffix_dedup.remove_repeats(frame(list(enumerate(texts))), width=50).collect()
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept"]).hexdigest()) for r in rows}
    assert len(rows) == len(texts) and sum(w[1] for w in want) > 1000
    assert [got[i] for i in range(len(texts))] == want


def test_awkward_rows(spark, frame):
    rows = suffix_dedup.remove_repeats(frame(AWKWARD)).collect()
    assert len(rows) == len(AWKWARD)
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[8]["n_removed"] == 5000 and by_id[8]["n_spans"] == 1 and by_id[4]["n_removed"] == 0 and by_id[1]["n_bytes"] == 0


def test_empty_table(spark, frame):
    assert suffix_dedup.remove_repeats(frame([])).count() == 0


def test_a_side_is_zero_only_where_nothing_is_there(monkeypatch):
    import numpy as np

    plain = suffix_dedup.mix64
    monkeypatch.setattr(suffix_dedup, "mix64", lambda x: plain(x) | np.uint64(0xFFFFFFFE00000000))  # the largest side hash
    *_, before, after = suffix_dedup.stretches([bytes(random.Random(3).choices(range(97, 123), k=3000))], 200)
    for side in (before, after):
        assert (side > 0).any() and (((side & 0x7FFFFFFF) == 0) == (side == 0)).all() and side.max() < 1 << 31
