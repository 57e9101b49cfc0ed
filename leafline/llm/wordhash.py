"""64-bit hashes of all words of many texts at once."""

from __future__ import annotations

import numpy as np

U = np.uint64
#: An odd multiplier and its inverse modulo 2**64; the finishing multipliers of a 64-bit mixer.
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)
MIX = (U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB))

#: Most powers that a worker keeps from one call to the next; for a longer text they are made anew.
KEPT = 1 << 20

_powers: dict[str, np.ndarray] = {"up": np.ones(1, U), "down": np.ones(1, U)}


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * MIX[0]
    x = (x ^ (x >> U(27))) * MIX[1]
    return x ^ (x >> U(31))


def _power(which: str, base: int, n: int) -> np.ndarray:
    if len(_powers[which]) < n:
        step = np.full(max(n, 1 << 16), U(base))
        step[0] = U(1)
        np.multiply.accumulate(step, out=step)
        if n > KEPT:
            return step[:n]
        _powers[which] = step
    return _powers[which][:n]


def split_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word in order, number of words of each text). Words are runs of bytes other than ASCII white space, A-Z taken as a-z."""
    buf = np.frombuffer(b" ".join(texts).lower() + b" ", np.uint8)
    space = (buf == 32) | ((buf >= 9) & (buf <= 13))
    edge = np.flatnonzero(np.diff(np.r_[True, space].astype(np.int8)))
    starts, ends = edge[0::2], edge[1::2]
    sums = np.zeros(len(buf) + 1, U)
    np.cumsum((buf.astype(U) + U(1)) * _power("up", BASE, len(buf)), out=sums[1:])
    h = (sums[ends] - sums[starts]) * _power("down", BASE_INVERSE, len(buf))[starts]
    h = mixed(h ^ ((ends - starts).astype(U) << U(48)))
    first = np.cumsum(np.r_[0, [len(t) + 1 for t in texts]])
    return h, np.diff(np.searchsorted(starts, first))


def batches(texts: list[str | None], most: int = 1 << 19):
    """Runs of texts as bytes, about `most` bytes each: (from, to, texts)."""
    at, size, run = 0, 0, []
    for i, t in enumerate(texts):
        b = (t or "").encode("utf-8", "replace")
        if run and size + len(b) > most:
            yield at, i, run
            at, size, run = i, 0, []
        run.append(b)
        size += len(b) + 1
    if run:
        yield at, at + len(run), run


def all_words(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """split_words() over any amount of text, with working memory for a run at a time."""
    parts = [split_words(run) for _, _, run in batches(texts)]
    if not parts:
        return np.zeros(0, U), np.zeros(0, np.int64)
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
