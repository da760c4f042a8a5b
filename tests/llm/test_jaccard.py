import random

import numpy as np
import pandas as pd
import pytest
from conftest import AWKWARD

from sitelens.llm import jaccard_rtree


def shingle_set(text, width):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i:i + width]) for i in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else [])


def expected(rows, width=4, threshold=85):
    sets = [shingle_set(t, width) for _, t in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= threshold * len(a | b):
                up[find(i)] = find(j)
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [d for k, (d, _) in enumerate(rows) if find(k) == find(i) and d is not None]
        out.append((str(doc), len(sets[i]), str(min(ids) if ids and sets[i] else doc)))
    return sorted(out)


def corpus(seed, n=150):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = rng.choices(vocabulary, k=60)
    texts = []
    for i in range(n):
        if i and rng.random() < 0.6:
            words = rng.choice(texts).split()
            for _ in range(rng.randint(0, 4)):
                if words:
                    words[rng.randrange(len(words))] = rng.choice(vocabulary)
        else:
            words = rng.choices(vocabulary, k=rng.randint(1, 200))
            if i % 3 == 0:
                words += passage
        texts.append(" ".join(words))
    return [(1000 - i, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("tree_rows,leaf", [(2000, 32), (10, 2)])
def test_components_equal_all_pairs(spark, frame, monkeypatch, tree_rows, leaf):
    monkeypatch.setattr(jaccard_rtree, "_TREE_ROWS", tree_rows)
    monkeypatch.setattr(jaccard_rtree, "LEAF", leaf)
    rows = corpus(tree_rows) + AWKWARD
    got = jaccard_rtree.jaccard_components(frame(rows)).collect()
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in got) == expected(rows)


def test_large_sets_and_other_parameters(spark, frame):
    rng = random.Random(8)
    base = [f"v{rng.randrange(5000)}" for _ in range(4000)]
    rows = []
    for i in range(12):
        words = list(base[:rng.choice([2100, 2300, 4000])])
        for _ in range(rng.randint(0, 60)):
            words[rng.randrange(len(words))] = "new"
        rows.append((i, " ".join(words)))
    for width, threshold in ((4, 85), (2, 95), (5, 80)):
        got = jaccard_rtree.jaccard_components(frame(rows), width=width, threshold=threshold).collect()
        assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in got) == expected(rows, width, threshold)


def test_tree_finds_all_pairs_within_the_bound():
    import numpy as np

    rng = np.random.default_rng(2)
    points = rng.poisson(3, (200, 32))
    points[100:] = points[:100] + rng.integers(0, 2, (100, 32)) * (rng.random((100, 32)) < 0.2)
    sizes = points.sum(1)
    got = {tuple(sorted(x)) for i, j in jaccard_rtree.Tree(points, sizes, 85).pairs() for x in zip(i.tolist(), j.tolist())}
    want = {(i, j) for i in range(200) for j in range(i + 1, 200)
            if 185 * np.minimum(points[i], points[j]).sum() >= 85 * (sizes[i] + sizes[j]) and 100 * min(sizes[i], sizes[j]) >= 85 * max(sizes[i], sizes[j])}
    assert got == want and len(want) > 50


def test_empty_table(spark, frame):
    assert jaccard_rtree.jaccard_components(frame([])).count() == 0


@pytest.mark.parametrize("part_sets", [512, 4])
def test_links_equal_all_pairs(spark, frame, monkeypatch, part_sets):
    monkeypatch.setattr(jaccard_rtree, "_PART_SETS", part_sets)
    monkeypatch.setattr(jaccard_rtree, "_OVERLAP_COLUMNS", 50)
    rng = random.Random(part_sets)
    base = [f"n{i}" for i in range(160)]
    near = []
    for i in range(60):  # one large group of near copies, of several sizes, and copies of some of them
        words = base[:rng.choice([110, 125, 140, 160])]
        words[rng.randrange(len(words))] = f"other{i}"
        near.append((5000 + i, " ".join(words)))
    rows = corpus(part_sets, 80) + near + [(6000 + i, near[i % 5][1]) for i in range(15)] + AWKWARD
    sets = [shingle_set(t, 4) for _, t in rows]
    want = [sum(1 for j, b in enumerate(sets) if i != j and a and b and 100 * len(a & b) >= 85 * len(a | b)) for i, a in enumerate(sets)]
    got = jaccard_rtree.jaccard_components(frame(rows), count_links=True).collect()
    assert sorted((str(r["doc_id"]), r["n_shingles"], r["n_links"]) for r in got) == sorted(
        (str(d), len(s), n) for (d, _), s, n in zip(rows, sets, want))
    assert max(want) > 20


def test_copies_around_a_centre_need_no_pairs(spark, frame, monkeypatch):
    """Copies of one text that link with it, but few with each other."""
    words = [f"v{i}" for i in range(150)]
    rows = [(0, " ".join(words))]
    for k in range(1, 101):
        own = list(words)
        at = 4 + 6 * (k % 23)  # two copies with other places share 135 of 159 shingles
        own[at], own[at + 2] = f"x{k}", f"y{k}"
        rows.append((k, " ".join(own)))
    compared, verified = [], jaccard_rtree.verified

    def counted(pairs, *args):
        compared.append(pairs.count())
        return verified(pairs, *args)

    monkeypatch.setattr(jaccard_rtree, "verified", counted)
    got = jaccard_rtree.jaccard_components(frame(rows)).select("doc_id", "component_id").collect()
    assert {tuple(r) for r in got} == {(k, 0) for k in range(101)}
    assert sum(compared) < 12 * len(rows), compared


def test_packed_points():
    for counts in (np.arange(64) % 16, np.arange(64), np.zeros(64, np.int64), np.full(8192, 70_000)):
        assert np.array_equal(jaccard_rtree.unpacked(jaccard_rtree.packed(counts.astype(np.int32))), counts)


def test_points_as_a_matrix():
    counts = [np.arange(64) % 16, np.arange(128) % 16, np.arange(64) * 30, np.arange(256) % 3]
    packed = [jaccard_rtree.packed(c.astype(np.int32)) for c in counts]
    for largest in (60_000, 70_000):
        got = jaccard_rtree.matrix(packed, 64, np.array([largest] * 4))
        assert [r.tolist() for r in got] == [jaccard_rtree.folded(c, 64).tolist() for c in counts]


def test_sets_below_the_threshold_are_no_candidates():
    """Sets of 180 shingles of which two share 163 are mostly told apart by their points."""
    rng = np.random.default_rng(5)
    common = rng.integers(0, 1 << 63, 163, dtype=np.uint64)
    counts = [jaccard_rtree.packed(jaccard_rtree.point(np.concatenate([common, rng.integers(0, 1 << 63, 17, dtype=np.uint64)])))
              for _ in range(60)]
    part = pd.DataFrame({"tree_a": 7, "tree_b": -1, "tree_c": 0, "level": 0, "sid": range(60), "root": range(60), "own_level": 0,
                         "n": 180, "counts": counts, "trees": [[7]] * 60})

    class Members:
        def groupBy(self, *keys):
            return self

        def applyInPandas(self, run, schema):
            return run(part)

    assert len(jaccard_rtree.tree_pairs(Members(), 85)) < 400  # of 1770
