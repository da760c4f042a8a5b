import hashlib
import random

import pytest
from conftest import AWKWARD

from sitelens.llm import chunk_dedup


def corpus():
    rng = random.Random(3)
    long = "".join(rng.choices("abcdefgh ", k=60_000))
    texts = [long, long, long[:-1], long[:30_000] + "X" + long[30_000:], "short", "short", "x" * 100_000, "x" * 100_000, "x" * 99_999, "", None]
    return [(i, t) for i, t in enumerate(texts)] + AWKWARD


def expected(rows):
    out = []
    for text in {t or "" for _, t in rows}:
        ids = sorted((i for i, t in rows if (t or "") == text), key=lambda i: -1 if i is None else i)
        out += [(str(i), str(ids[-1]), len(ids), n == len(ids) - 1, hashlib.sha256(text.encode()).hexdigest()) for n, i in enumerate(ids)]
    return sorted(out)


@pytest.mark.parametrize("digest", [chunk_dedup.strong_digest, lambda c: bytes([len(c) % 3])])
def test_groups_equal_comparison(spark, frame, digest):
    got = chunk_dedup.exact_duplicates(frame(corpus()), digest=digest).collect()
    assert sorted((str(r["doc_id"]), str(r["keep_id"]), r["group_size"], r["kept"], r["text_sha256"]) for r in got) == expected(corpus())


def test_chunks_join_to_the_text_and_survive_an_insertion():
    rng = random.Random(9)
    text = bytes(rng.randrange(256) for _ in range(3_000_000))
    cut = chunk_dedup.chunks(text)
    assert b"".join(cut) == text and max(map(len, cut)) <= chunk_dedup.MAX_CHUNK
    other = chunk_dedup.chunks(text[:1_000_000] + b"!" + text[1_000_000:])
    assert len(set(cut) ^ set(other)) < 12


def test_empty_table(spark, frame):
    assert chunk_dedup.exact_duplicates(frame([])).count() == 0
