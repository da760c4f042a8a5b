import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from conftest import AWKWARD

from sitelens.llm import bpe_sql

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def peer():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe_sql.read_vocabulary(PATH), special_tokens={})


def texts():
    rng = random.Random(6)
    alphabet = "aaabcdeth  \n\t.-'123éñ日𝄞​\x00\x85"
    return [None, "", "<|endoftext|>", "it's we'll I'M", "-" * 3001, "a" * 2000, "ab" * 700, "ééé" * 300, "   \n\n x", "x  \x0b y\xa0z",
            "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=1500)), *("".join(rng.choices(alphabet, k=rng.randint(1, 120))) for _ in range(150))]


@pytest.mark.parametrize("cache", [bpe_sql.CACHE, 20])
def test_codec_equals_the_library(peer, cache):
    codec = bpe_sql.Codec(bpe_sql.read_vocabulary(PATH), public_tokenizers.PATTERN, cache)
    rows = [t or "" for t in texts()]
    for at in range(0, len(rows), 10):
        ids = codec.encode(rows[at:at + 10])
        assert [x.tolist() for x in ids] == [peer.encode_ordinary(t) for t in rows[at:at + 10]]
        assert codec.decode(ids) == [t.encode() for t in rows[at:at + 10]]


@pytest.mark.parametrize("word", ["random", "one letter", "base64", "repeated", "bytes"])
def test_long_words_end_and_equal_the_library(peer, word):
    import base64
    import time

    rng = random.Random(8)
    n = 100_000
    text = {"random": lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=n)), "one letter": lambda: "z" * n,
            "base64": lambda: base64.b64encode(rng.randbytes(3 * n // 4)).decode(), "repeated": lambda: "antidisestablishment" * (n // 20),
            "bytes": lambda: "".join(rng.choices("éüñ日本語𝄞ż", k=n // 3))}[word]()
    codec = bpe_sql.Codec(bpe_sql.read_vocabulary(PATH), public_tokenizers.PATTERN)
    began = time.time()
    ids = codec.encode([text])
    assert ids[0].tolist() == peer.encode_ordinary(text) and time.time() - began < 60


def test_frames(spark, frame, peer):
    rows = [*enumerate(texts(), 100), *AWKWARD]
    shared = bpe_sql.broadcast_vocabulary(spark, PATH)
    encoded = bpe_sql.encode(frame(rows), shared, public_tokenizers.PATTERN)
    got = bpe_sql.token_digests(bpe_sql.decode(encoded, shared, public_tokenizers.PATTERN)).collect()
    same = bpe_sql.token_digests(bpe_sql.encode(frame(rows), shared, public_tokenizers.PATTERN, decoded=True, cache=50,
                                               keep_codec=False)).collect()
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = sorted(str((i, len(e), sha(" ".join(map(str, e)).encode()), sha((t or "").encode()))) for i, t in rows
                  for e in [peer.encode_ordinary(t or "")])
    assert sorted(str(tuple(r)) for r in got) == want == sorted(str(tuple(r)) for r in same)


def test_empty_table(spark, frame):
    shared = bpe_sql.broadcast_vocabulary(spark, PATH)
    assert bpe_sql.encode(frame([]), shared, public_tokenizers.PATTERN, decoded=True).count() == 0


def test_a_vocabulary_must_have_all_bytes():
    with pytest.raises(ValueError):
        bpe_sql.Codec({b"a": 0}, public_tokenizers.PATTERN)


def test_rows_without_tokens_decode_to_nothing():
    codec = bpe_sql.Codec(bpe_sql.read_vocabulary(PATH), public_tokenizers.PATTERN)
    for rows in ([], [""], ["", "é\x00 a", "", "", "日本 語", ""]):
        assert codec.decode(codec.encode(rows)) == [t.encode() for t in rows]
