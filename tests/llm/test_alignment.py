import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from conftest import AWKWARD
from tokenizers import Tokenizer

from sitelens.llm import token_alignment
from sitelens.llm.textops import staged

PATHS = [public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "piece_bpe_32k.model")]


@pytest.fixture(scope="module")
def peers():
    first = Tokenizer.from_file(PATHS[0])
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=PATHS[1])


@pytest.fixture(scope="module")
def codec():
    return token_alignment.Codec.of(*(open(p, "rb").read() for p in PATHS))


def texts():
    rng = random.Random(12)
    alphabet = "aaabcdeth  \n\t.-'123éñ日𝄞​\x00\x85▁<0xA>|;ﬁ"
    return [None, "", " ", "<|endoftext|>", "<s> x </s><unk>", "<0x41>", "▁", "a▁b", "it's we'll I'M", "-" * 3001, "a" * 20_000, "   \n\n x",
            "日本語のテキスト", "𝄞 Zażółć", "one", "one two", "ﬁne", *("".join(rng.choices(alphabet, k=rng.randint(1, 90))) for _ in range(150)),
            *(" ".join("".join(rng.choices("abcdefgh", k=rng.randint(1, 9))) for _ in range(rng.randint(1, 60))) for _ in range(60))]


def brute(peers, rows):
    """The contract by plain loops: bytes of tokens, all overlapping pairs, groups between common ends."""
    first, second = peers
    letters = token_alignment._byte_letters()
    vocabulary = {i: t for t, i in first.get_vocab().items()}
    spell_b = lambda i: bytes([int(second.id_to_piece(i)[3:-1], 16)]) if second.is_byte(i) else second.id_to_piece(i).replace("▁", " ").encode()
    docs, counts = [], Counter()
    for doc, t in rows:
        t = t or ""
        a = first.encode(" " + t, add_special_tokens=False).ids if t else []
        b = second.encode(t) if t else []
        spelled = [[bytes(letters[c] for c in vocabulary[i]) for i in a], [spell_b(i) for i in b]]
        if any(b"".join(s) != (" " + t).encode() for s in spelled):
            a, b, spelled = [], [], [[], []]
        at = [0], [0]
        for s, x in zip(spelled, at):
            for w in s:
                x.append(x[-1] + len(w))
        links, y0 = [], 0
        for x in range(len(a)):
            while at[1][y0 + 1] <= at[0][x]:
                y0 += 1
            y = y0
            while y < len(b) and at[1][y] < at[0][x + 1]:
                links.append((a[x], b[y]))
                y += 1
        common = sorted(set(at[0][1:]) & set(at[1][1:]))
        groups, low = [], 0
        for c in common:
            groups.append(",".join(str(i) for i, e in zip(a, at[0][1:]) if low < e <= c) + "|" + ",".join(str(i) for i, e in zip(b, at[1][1:]) if low < e <= c))
            low = c
        counts.update(links)
        docs.append((doc, a, b, groups, links))
    most = Counter()
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    sha = lambda g: hashlib.sha256(";".join(g).encode()).hexdigest() if g else ""
    return [(d, len(a), len(b), len(g), len(k), sum(counts[p] == most[p[1]] for p in k), sum(counts[p] for p in k), sha(g)) for d, a, b, g, k in docs]


def test_first_tokenizer_equals_the_library(codec, peers):
    rows = [t or "" for t in texts()]
    assert [x.tolist() for x in codec.encode(rows)[0]] == [peers[0].encode(" " + t, add_special_tokens=False).ids for t in rows]


def test_merge_path_equals_a_plain_merge():
    rng = random.Random(3)
    for _ in range(800):
        a, b = (sorted(rng.sample(range(1, 60), rng.randint(0, 30))) for _ in range(2))
        x, y = np.array(a, np.int64), np.array(b, np.int64)
        want = [(sum(v < e for v in a), sum(v < e for v in b), e in a and e in b) for e in sorted({*a, *b})]
        for piece in (1, 3, 8, 1000):
            assert list(zip(*(v.tolist() for v in token_alignment.merged(x, y, piece)))) == want
            i, j = token_alignment.path_cuts(x, y, piece)
            assert (np.diff(i + j) <= piece + 1).all() and (i[-1], j[-1]) == (len(a), len(b))


def run(spark, docs, buckets, **sizes):
    from pyspark.sql import functions as F

    tokenizers = token_alignment.read_tokenizers(spark, *PATHS)
    digest = F.when(F.col("n_a") > 0, F.sha2(F.col("groups").cast("binary"), 256)).otherwise("").alias("sha")
    aligned = staged(token_alignment.align(docs, tokenizers, buckets, **sizes).select("*", digest), "test_alignments")
    found = token_alignment.link_counts(aligned, tokenizers, buckets)
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "sha"), found


@pytest.mark.parametrize("chunk,buckets,piece", [(token_alignment.CHUNK_BYTES, 3, token_alignment.PIECE), (200, 1, 5), (3000, 200, 64)])
def test_frames(spark, frame, peers, chunk, buckets, piece):
    rows = [*enumerate(texts(), 100), *AWKWARD]
    got = run(spark, frame(rows), buckets, chunk_bytes=chunk, piece=piece)[0].collect()
    assert sorted(str(tuple(r)) for r in got) == sorted(map(str, brute(peers, rows)))


def test_groups_written_out(spark, frame, codec):
    row = run(spark, frame([(1, "ab▁"), (2, "tokenizers differ")]), 2)[1].filter("doc_id = 2").first()
    groups = [[[int(i) for i in side.split(",")] for side in g.split("|")] for g in row["groups"].split(";")]
    for side in (0, 1):
        assert b"".join(codec.spelled[side][i] for g in groups for i in g[side]) == b" tokenizers differ"
    assert len(groups) == row["n_groups"]


def test_empty_table(spark, frame):
    assert run(spark, frame([]), 1)[0].count() == 0


def test_files_have_a_size_bound(spark, monkeypatch):
    monkeypatch.setattr(token_alignment, "MAX_FILES", 10)
    with pytest.raises(ValueError):
        token_alignment.read_tokenizers(spark, *PATHS)
