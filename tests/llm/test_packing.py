import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from leafline.llm.packing import encoder, pack, placements
from leafline.llm.spfhp import pack_histogram

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 50), max_size=30))
def test_patterns_hold_the_histogram(histogram):
    patterns = pack_histogram(histogram, 64)
    held = defaultdict(int)
    for p in patterns:
        assert 0 < p.used <= 64
        for length, n in p.runs:
            held[length] += n * p.count
    assert dict(held) == histogram
    assert len(patterns) <= 3 * max(1, len(histogram))


def test_shortest_pack_comes_first():
    assert pack_histogram({6: 1, 5: 1, 3: 1}, 10)[-1].runs == ((5, 1), (3, 1))


def test_places_do_not_overlap():
    seen = set()
    for length, first, after, per, sequence, offset in placements({7: 13, 5: 9, 2: 40, 64: 3}, 64):
        for rank in range(first, after):
            s, o = sequence + (rank - first) // per, offset + (rank - first) % per * length
            cells = {(s, o + i) for i in range(length)}
            assert not cells & seen and o + length <= 64
            seen |= cells


def test_encoder_is_the_library():
    for t in ("Hello <|endoftext|> wörld", "", "日本語", "a" * 500):
        assert encoder(PATH).encode(t, allowed_special="all") == LIBRARY.encode(t, add_special_tokens=False).ids


def test_long_runs_are_encoded_as_the_library_does(table):
    n = 1_000_000
    texts = [" " * n + "a", " " * n, "\t" * n + "b", " \n" * (n // 2), "x" * n, "#" * n, "7" * 5000 + " " * 5000 + "é" * 5000, "\x1c" * 5000, "\u00a0" * 5000 + "a", "a b  c\n\n d " * 2000]
    rows = pack(table(list(enumerate(texts))), PATH, keep_ids=True).collect()
    for i, t in enumerate(texts):
        ids = [x for r in sorted((r["start"], r["ids"]) for r in rows if r["doc_id"] == i) for x in r[1]]
        assert ids == [*LIBRARY.encode(t, add_special_tokens=False).ids, 0]


def best_packing(lengths, size):
    """Fewest sequences that hold all lengths, by trying all ways."""
    best = len(lengths)

    def place(i, room):
        nonlocal best
        if len(room) >= best:
            return
        if i == len(lengths):
            best = len(room)
            return
        for r in {*room}:
            if r >= lengths[i]:
                k = room.index(r)
                place(i + 1, room[:k] + [r - lengths[i]] + room[k + 1 :])
        place(i + 1, [*room, size - lengths[i]])

    place(0, [])
    return best


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 12), min_size=1, max_size=7))
def test_near_the_best_packing_of_all(lengths):
    lengths = sorted(lengths, reverse=True)
    histogram = {n: lengths.count(n) for n in lengths}
    made = sum(p.count for p in pack_histogram(histogram, 12))
    assert best_packing(lengths, 12) <= made <= 2 * best_packing(lengths, 12)


def one_by_one(lengths, size):
    """The same rule by single packs: longest first, each into the shortest pack that was begun, if it has room."""
    packs = []
    for n in sorted(lengths, reverse=True):
        k = min(range(len(packs)), key=lambda k: sum(packs[k]), default=None)
        if k is None or sum(packs[k]) + n > size:
            packs.append([n])
        else:
            packs[k].append(n)
    return len(packs)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=60))
def test_as_many_sequences_as_packing_one_by_one(lengths):
    histogram = {n: lengths.count(n) for n in lengths}
    assert abs(sum(p.count for p in pack_histogram(histogram, 20)) - one_by_one(lengths, 20)) <= max(1, len(lengths) // 10)


def test_every_id_lies_in_one_piece(table, awkward):
    rows = pack(table(awkward), PATH, size=128, keep_ids=True).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] and len(r["ids"]) == r["length"]
        pieces[r["doc_id"], r["doc_tokens"]].append((r["start"], r["ids"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    whole = sorted(str(sorted(v)) for v in pieces.values())
    wanted = defaultdict(list)
    for i, t in awkward:
        ids = [*LIBRARY.encode(t or "", add_special_tokens=False).ids, 0]
        wanted[i, len(ids)] += [(s, ids[s : s + 128]) for s in range(0, len(ids), 128)]
    assert whole == sorted(str(sorted(v)) for v in wanted.values())
    for runs in sequences.values():
        at = 0
        for offset, length in sorted(runs):
            assert offset == at
            at += length
        assert at <= 128
    assert sorted(sequences) == list(range(len(sequences)))


def test_empty_table(table):
    assert pack(table([]), PATH).collect() == []
