"""Byte-level BPE encoding and decoding with a contiguous rank array per word.

A word's bytes are parts; `ranks[i]` is the merge rank of parts i and i+1. The smallest rank is found by a scan of
that array, its boundary is deleted and the two neighbouring ranks are looked up anew. Words over LONG_WORD bytes
use the same merges from a heap, as a scan per merge would be quadratic there.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafline.llm.storage import tune

#: The word pattern of byte-level BPE vocabularies.
WORDS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
NO_PAIR = 1 << 40
LONG_WORD = 400
CACHE_WORDS = 200_000


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary file, by rule: printable Latin-1 stands for itself, the rest from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class RankArrayBpe:
    """Encoder and decoder of one vocabulary file (JSON with vocab, merges and added tokens)."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        symbols = byte_symbols()
        vocab: dict[str, int] = spec["model"]["vocab"]
        self.byte_ids = [0] * 256
        for c, b in symbols.items():
            self.byte_ids[b] = vocab[c]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[vocab[a], vocab[b]] = (rank, vocab[a + b])
        self.pieces: dict[int, bytes] = {i: bytes(symbols[c] for c in s) for s, i in vocab.items() if all(c in symbols for c in s)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.pieces |= {i: s.encode() for s, i in self.special.items()}
        self.find_words = regex.compile(WORDS).findall
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")").split if self.special else None
        self.known: dict[str, tuple[int, ...]] = {}

    def word(self, word: str) -> tuple[int, ...]:
        parts = [self.byte_ids[b] for b in word.encode("utf-8", "replace")]
        if len(parts) > LONG_WORD:
            return tuple(self._long(parts))
        merges = self.merges
        found = [merges.get(p) for p in zip(parts, parts[1:])]
        ranks = [f[0] if f else NO_PAIR for f in found]
        while ranks:
            least = min(ranks)
            if least == NO_PAIR:
                break
            i = ranks.index(least)
            parts[i : i + 2] = [merges[parts[i], parts[i + 1]][1]]
            del ranks[i]
            if i < len(ranks):
                f = merges.get((parts[i], parts[i + 1]))
                ranks[i] = f[0] if f else NO_PAIR
            if i:
                f = merges.get((parts[i - 1], parts[i]))
                ranks[i - 1] = f[0] if f else NO_PAIR
        return tuple(parts)

    def _long(self, parts: list[int]) -> list[int]:
        n, merges = len(parts), self.merges
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = [(f[0], i, parts[i], parts[i + 1]) for i in range(n - 1) if (f := merges.get((parts[i], parts[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = right[i]
            if parts[i] != a or j < 0 or parts[j] != b:
                continue
            parts[i], parts[j] = merges[a, b][1], -1
            right[i] = right[j]
            if right[i] >= 0:
                left[right[i]] = i
            for k in (left[i], i):
                if k >= 0 and right[k] >= 0 and (f := merges.get((parts[k], parts[right[k]]))):
                    heapq.heappush(heap, (f[0], k, parts[k], parts[right[k]]))
        return [p for p in parts if p >= 0]

    def encode(self, text: str) -> list[int]:
        known, ids = self.known, []
        segments = self.split_special(text) if self.split_special else [text]
        for segment in segments:
            if segment in self.special:
                ids.append(self.special[segment])
                continue
            words = self.find_words(segment)
            for w in {*words}.difference(known):
                if len(known) >= CACHE_WORDS:
                    known.clear()
                    for again in {*words}:
                        known[again] = self.word(again)
                    break
                known[w] = self.word(w)
            for w in map(known.__getitem__, words):
                ids += w
        return ids

    def decode(self, ids: list[int]) -> str:
        """Bytes of the ids, joined; bytes that are no UTF-8 become U+FFFD, ids outside the vocabulary nothing."""
        return b"".join(map(self.pieces.get, ids, [b""] * len(ids))).decode("utf-8", "replace") if not all(map(self.pieces.__contains__, {*ids})) else b"".join(map(self.pieces.__getitem__, ids)).decode("utf-8", "replace")


_loaded: dict[str, RankArrayBpe] = {}


def tokenizer(path: str) -> RankArrayBpe:
    """One per worker process and file."""
    if path not in _loaded:
        _loaded[path] = RankArrayBpe(path)
    return _loaded[path]


def bpe_round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, ids array<int>, decoded string) of each row: its text's ids, and those ids decoded again.

    A null text counts as empty: no ids, decoded ''. Null ids of rows, repeated rows and ties give one row each, as
    they stand. An empty table gives none. Other columns are dropped. No shuffle: one pass over each partition.
    """
    tune(docs.sparkSession)
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                ids = [bpe.encode(t or "") for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array([bpe.decode(x) for x in ids], pa.string())], [id_col, "ids", "decoded"])

    return docs.select(id_col, F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"`{id_col}` {id_type}, ids array<int>, decoded string")
