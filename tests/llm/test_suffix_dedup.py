import random
import tracemalloc

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from leafline.llm import suffix_dedup, wordhash
from leafline.llm.difference_cover import suffix_ranks
from leafline.llm.suffix_dedup import remove_repeats


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 4), max_size=60), st.integers(1, 60))
def test_ranks_order_suffixes(values, depth):
    rank = suffix_ranks(np.array(values, np.int64), depth)
    for i in range(len(values)):
        for j in range(len(values)):
            if values[i : i + depth] < values[j : j + depth]:
                assert rank[i] < rank[j]


def brute(rows, length):
    rows = [(i, (t or "").encode()) for i, t in rows]
    large = 1 << 62
    first = {}
    for i, b in rows:
        for p in range(len(b) - length + 1):
            w = b[p : p + length]
            first[w] = min(first.get(w, large + 1), large if i is None else i)
    out = []
    for i, b in rows:
        gone = [False] * len(b)
        for p in range(len(b) - length + 1):
            if first[b[p : p + length]] < (large if i is None else i):
                gone[p : p + length] = [True] * length
        spans = sum(g and (p == 0 or not gone[p - 1]) for p, g in enumerate(gone))
        out.append((i, len(b), spans, bytes(c for c, g in zip(b, gone) if not g)))
    return sorted(out, key=str)


def got(df):
    return sorted(((r["doc_id"], r["n_bytes"], len(r["span_starts"]), bytes(r["kept"])) for r in df.collect()), key=str)


@pytest.mark.parametrize(("seed", "alphabet", "length", "gram", "rank_bytes"), [(1, "ab", 9, 4, 1 << 18), (2, "abcdefgh ", 12, 5, 64), (3, "aé🙂", 10, 3, 1 << 18), (4, "abc", 50, 24, 64)])
def test_same_bytes_as_brute_force(table, monkeypatch, seed, alphabet, length, gram, rank_bytes):
    monkeypatch.setattr(suffix_dedup, "RANK_BYTES", rank_bytes)
    rng = random.Random(seed)
    passages = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(5, 90))) for _ in range(6)]
    rows = []
    for i in range(60):
        parts = [rng.choice(passages) if rng.random() < 0.5 else "".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 30))) for _ in range(rng.randrange(0, 5))]
        rows.append((rng.randrange(40), "".join(parts)))
    assert got(remove_repeats(table(rows), length, gram)) == brute(rows, length)


def test_awkward_rows(table, awkward):
    rows = [(i, t[:4000] if t else t) for i, t in awkward]
    assert got(remove_repeats(table(rows))) == brute(rows, 50)
    assert remove_repeats(table([])).collect() == []
    assert got(remove_repeats(table([(1, None), (2, "short")]))) == [(1, 0, 0, b""), (2, 5, 0, b"short")]


def test_kept_text_has_whole_characters(table):
    rows = [(1, "é" * 60), (2, "a" + "é" * 60)]
    done = {r["doc_id"]: r["kept"] for r in remove_repeats(table(rows), carry=("source",), as_text=True).collect()}
    assert done == {1: "é" * 60, 2: "a"}


def test_texts_are_hashed_in_little_memory():
    rng = np.random.default_rng(0)
    texts = [rng.integers(97, 123, 2000, dtype=np.uint8).tobytes() for _ in range(1000)]
    tracemalloc.start()
    try:
        for _, run in suffix_dedup._runs(texts):
            suffix_dedup.Regions(run, 50, 32)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 40 << 20


def test_bytes_are_copied_in_little_memory():
    buf, start, size = np.arange(256, dtype=np.uint8).repeat(1 << 13), np.arange(0, 1 << 20, 16), np.full(1 << 16, 64)
    tracemalloc.start()
    try:
        got_, _ = suffix_dedup._gather(buf, start, size)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 24 << 20
    assert (got_.reshape(-1, 64) == buf[start[:, None] + np.arange(64)]).all()
    some = np.array([5, 700_000, 3]), np.array([0, 600_000, 2])
    assert (suffix_dedup._gather(buf, *some)[0] == np.r_[buf[700_000:1_300_000], buf[3:5]]).all()


def test_a_long_text_leaves_no_long_powers():
    plain = np.multiply.accumulate(np.r_[np.uint64(1), np.full(wordhash.KEPT + 9, np.uint64(wordhash.BASE))])
    assert (wordhash._power("up", wordhash.BASE, wordhash.KEPT + 10) == plain).all()
    assert (wordhash._power("up", wordhash.BASE, 1000) == plain[:1000]).all()
    assert len(wordhash._powers["up"]) <= wordhash.KEPT
