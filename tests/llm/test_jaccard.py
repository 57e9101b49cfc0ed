import random
import re

import numpy as np
import pytest

from leafline.llm import jaccard
from leafline.llm.components import components
from leafline.llm.jaccard import CountVectorRTree, jaccard_classes

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sets(text, k):
    w = WORD.findall((text or "").translate(LOW))
    return {tuple(w)} if 0 < len(w) < k else {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def brute(rows, k, num, den):
    s = [sets(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if s[i] and s[j] and den * len(s[i] & s[j]) >= num * len(s[i] | s[j]):
                parent[root(i)] = root(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        low.setdefault(root(i), []).append(d)
    out = []
    for i, (d, _) in enumerate(rows):
        known = [x for x in low[root(i)] if x is not None]
        out.append((d, len(s[i]), min(known) if known else None))
    return sorted(out, key=str)


def near_copies(seed, groups=12, most=25):
    rng = random.Random(seed)
    rows = []
    for _ in range(groups):
        base = [f"w{rng.randrange(60)}" for _ in range(rng.choice([3, 8, 40, 120]))]
        for _ in range(rng.randrange(1, most)):
            copy = list(base)
            for _ in range(rng.randrange(0, 4)):
                copy[rng.randrange(len(copy))] = f"W{rng.randrange(60)}"
            rows.append((len(rows) * 3 + 1, " ".join(copy)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("seed", "k", "num", "block"), [(1, 3, 90, 1024), (2, 5, 80, 1024), (3, 3, 80, 7), (4, 2, 60, 16)])
def test_same_classes_as_brute_force(table, monkeypatch, seed, k, num, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rows = near_copies(seed)
    done = jaccard_classes(table(rows), k=k, num=num, den=100).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in done), key=str) == brute(rows, k, num, 100)


def test_awkward_rows(table, awkward):
    done = jaccard_classes(table(awkward), k=3, num=90, den=100).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in done), key=str) == brute(awkward, 3, 90, 100)


def test_empty_tables(table):
    assert jaccard_classes(table([])).collect() == []
    assert [tuple(r) for r in jaccard_classes(table([(1, None), (2, "")])).orderBy("doc_id").collect()] == [(1, 0, 1), (2, 0, 2)]


def test_tree_finds_all_that_the_bound_allows():
    rng = np.random.default_rng(0)
    points = rng.integers(0, 6, (3000, jaccard.GROUPS))
    points[1500:] = points[:1500] + rng.integers(0, 2, (1500, jaccard.GROUPS)) * (rng.random((1500, jaccard.GROUPS)) < 0.1)
    sizes = points.sum(axis=1)
    tree = CountVectorRTree(points, sizes)
    for i in range(0, 3000, 97):
        need = jaccard.overlap_needed(sizes, sizes[i], 90, 100)
        fits = (sizes * 90 <= sizes[i] * 100) & (sizes * 100 >= sizes[i] * 90) & (np.minimum(points, points[i]).sum(axis=1) >= need)
        assert sorted(tree.near(points[i], int(sizes[i]), 90, 100, np.ones(3000, bool))) == list(np.flatnonzero(fits))


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(200)] + [(500, 501), (7, 7)], "a bigint, b bigint")
    got = {(r["node"], r["component"]) for r in components(edges).collect()}
    assert got == {(i, 0) for i in range(201)} | {(500, 500), (501, 500)}
    assert components(edges.limit(0)).collect() == []
