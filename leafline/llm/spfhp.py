"""Shortest-pack-first packing over a histogram of lengths."""

from __future__ import annotations

import dataclasses
import heapq


@dataclasses.dataclass(frozen=True)
class Pattern:
    """`count` sequences that hold the same run of lengths: (length, how many of it) from the start on."""

    runs: tuple[tuple[int, int], ...]
    count: int

    @property
    def used(self) -> int:
        return sum(length * n for length, n in self.runs)


def pack_histogram(histogram: dict[int, int], size: int) -> list[Pattern]:
    """Patterns that hold every length of the histogram exactly as often as it occurs.

    Lengths are placed longest first, each into the shortest packs begun so far if those have room, else into new
    ones; all packs of one pattern are treated at once, so work depends on the number of lengths, not of documents.
    """
    open_packs: list[tuple[int, int]] = []  # (used, serial); the shortest first
    held: dict[int, tuple[tuple[tuple[int, int], ...], int]] = {}
    serial = 0

    def begin(runs: tuple[tuple[int, int], ...], used: int, count: int) -> None:
        nonlocal serial
        serial += 1
        held[serial] = (runs, count)
        if used < size:
            heapq.heappush(open_packs, (used, serial))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        if not 0 < length <= size:
            raise ValueError(f"length {length} is not within 1 to {size}")
        while left:
            used, key = open_packs[0] if open_packs else (size, 0)
            if used + length > size:
                per = size // length  # new packs; whole ones are filled at once, as the shortest pack is always the newest
                full, rest = divmod(left, per)
                if full:
                    begin(((length, per),), length * per, full)
                if rest:
                    begin(((length, rest),), length * rest, 1)
                break
            heapq.heappop(open_packs)
            runs, count = held.pop(key)
            take = min(count, left)
            if take < count:
                begin(runs, used, count - take)
            grown = (*runs[:-1], (length, runs[-1][1] + 1)) if runs[-1][0] == length else (*runs, (length, 1))
            begin(grown, used + length, take)
            left -= take
    return [Pattern(runs, count) for runs, count in held.values()]
