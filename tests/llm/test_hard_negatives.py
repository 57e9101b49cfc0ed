import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from leafline.llm import hard_negatives as module
from leafline.llm.hard_negatives import PivotTable, build, mine, usable

SCHEMA = "vec_id bigint, embedding array<double>, label int, block string, at string, rows int, id int"


@pytest.fixture
def vectors(spark):
    def make(rows):
        return spark.createDataFrame([(i, v, y, "b", "a", 1, 2) for i, v, y in rows], SCHEMA)

    return make


def brute(rows, scale=256, every=50, n_pos=5, n_neg=3, margin=(50, 95)):
    """Every row against every anchor."""
    kept = []
    for i, v, y in rows:
        if y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(scale * x) for x in v], y))
    score = lambda a, b: sum(x * z for x, z in zip(a, b))
    order = lambda s, i: (-s, i is None, i or 0)
    out = []
    for n, (a, q, y) in enumerate(kept):
        if a is None or a % every:
            continue
        scored = [(score(q, v), i, z) for m, (i, v, z) in enumerate(kept) if m != n]
        for ps, p in sorted([(s, i) for s, i, z in scored if z == y], key=lambda x: order(*x))[:n_pos]:
            fits = [(s, i) for s, i, z in scored if z != y and margin[0] * ps <= 100 * s <= margin[1] * ps]
            out += [(a, p, k, i, ps, s) for k, (s, i) in enumerate(sorted(fits, key=lambda x: order(*x))[:n_neg], 1)]
    return sorted(map(str, out))


def clustered(n, width, labels, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, width))
    return [(i, [float(x) for x in centres[rng.integers(6)] + rng.normal(size=width) * 0.3], int(rng.integers(labels))) for i in range(n)]


@pytest.mark.parametrize(("block", "pack", "ranges", "group"), [(2048, 256, 1024, 8192), (16, 3, 4, 7)])
def test_rows_are_those_of_brute_force(vectors, monkeypatch, block, pack, ranges, group):
    for name, n in (("BLOCK", block), ("PACK", pack), ("RANGES", ranges), ("GROUP", group)):
        monkeypatch.setattr(module, name, n)
    rows = clustered(400, 8, 4) + [(1000 + i, [0.5] * 8, i % 2) for i in range(150)]  # and many copies of one vector
    got = mine(vectors(rows), every=25)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(str(tuple(r)) for r in got.collect()) == brute(rows, every=25)


def test_awkward_rows(vectors):
    inf, nan = float("inf"), float("nan")
    rows = clustered(60, 5, 2, seed=3) + [
        (100, None, 1), (150, [1.0] * 5, None), (None, [0.4] * 5, 1), (200, [], 0), (250, [0.3, 0.2], 0), (300, [0.1, None, 0.2], 1), (350, [inf, 0.0], 1), (400, [nan], 1),
        (450, [0.0] * 5, 1), (500, [0.25] * 5, 1), (501, [0.25] * 5, 1), (502, [0.2] * 5, 0), (502, [0.2] * 5, 0), (-50, [-0.5] * 5, 0), (550, [-0.5] * 5, 3), (-1, [1e3] * 5, 0),
    ]
    assert sorted(str(tuple(r)) for r in mine(vectors(rows)).collect()) == brute(rows)
    assert mine(vectors([])).collect() == []
    assert mine(vectors([(50, None, 1)])).collect() == []


def test_products_beyond_doubles_stay_exact(vectors):
    rows = [(i, [float(1e6 + 7 * i * i), float(9e5 - 11 * i), 1.0], i % 2) for i in range(120)]
    assert sorted(str(tuple(r)) for r in mine(vectors(rows), margin=(10, 100)).collect()) == brute(rows, margin=(10, 100))


def test_pivots_pass_over_most_rows_of_far_clusters(vectors):
    """Brackets hold every score, and between clusters that lie apart they leave little to check."""
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(8, 6)) * 20
    rows = [(i, [float(x) for x in centres[i % 8] + rng.normal(size=6) * 0.2], 0) for i in range(800)]
    table, _ = build(usable(vectors(rows), "vec_id", "embedding", F.col("label"), 256.0), 16)
    x = np.floor(np.array([v for _, v, _ in rows]) * 256)
    q = x[:50]
    far = table.distances(x)
    least, most = table.brackets(q, far, far)
    exact = q @ x.T
    assert (least <= exact).all() and (exact <= most).all()
    fifth = -np.sort(-exact, 1)[:, 4]
    assert (most >= fifth[:, None]).mean() < 0.5
    assert isinstance(table, PivotTable) and len(table.pivots) <= 16
