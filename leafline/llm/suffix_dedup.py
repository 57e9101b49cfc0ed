"""Removal of repeated byte strings by distributed suffix ranks.

Each string of `length` bytes has an anchor: of the k-grams in it the one with the smallest hash, the leftmost of
equals. Neighbouring strings with one anchor form a region. Equal strings have equal anchors, so suffixes need be
sorted only among regions with the same anchor k-gram, which is how they are dealt out; regions whose anchor occurs in
one document alone have no repeated string, and equal regions, byte by byte, are one text. The texts of a bucket are joined and
their suffixes ranked by the difference-cover algorithm (leafline.llm.difference_cover); neighbours in that order
whose first `length` bytes agree are one string, and the smallest document of each is known.

Documents lie in chunks. A chunk asks which of its anchors repeat, then sends its distinct repeated regions, each with
its smallest document, and gets the smallest document of all for each string. So a string met in a third of all
documents is sent once per chunk. Nothing is dropped or capped.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafline.llm.blobs import bundles, pack, unbundled, unpack
from leafline.llm.difference_cover import suffix_ranks
from leafline.llm.storage import trim, tune, written
from leafline.llm.wordhash import BASE, BASE_INVERSE, U, _power, mixed

LENGTH, GRAM = 50, 32
CHUNK_ROWS, BUCKET_BYTES = 2000, 8 << 20
#: Bytes of text that are hashed at once (working memory is about a hundred times that), ranked at once, and copied at once.
RUN_BYTES, RANK_BYTES, COPY_BYTES = 1 << 18, 1 << 16, 1 << 18
#: Bytes of text for which there is one task after a shuffle.
TASK_BYTES = 10 << 20
NONE = np.iinfo(np.int64).max


def _sums(buf: np.ndarray) -> np.ndarray:
    s = np.zeros(len(buf) + 1, U)
    np.cumsum((buf.astype(U) + U(1)) * _power("up", BASE, len(buf)), out=s[1:])
    return s


def _span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    down = _power("down", BASE_INVERSE, len(sums))
    return mixed((sums[end] - sums[start]) * down[start] ^ ((end - start).astype(U) << U(40)))


class Regions:
    """The regions of some texts: start in the joined bytes, number of strings, key of the anchor, hash of the bytes, number of the text."""

    def __init__(self, texts: list[bytes], length: int, gram: int) -> None:
        self.buf = np.frombuffer(b"".join(texts), np.uint8)
        self.ends = np.cumsum([len(t) for t in texts])
        buf, n, span = self.buf, len(self.buf), length - gram + 1
        if n < length:
            self.start = self.count = self.text = np.zeros(0, np.int64)
            self.key = self.hash = np.zeros(0, U)
            return
        sums = _sums(buf)
        at = np.arange(n - gram + 1)
        grams = mixed((sums[gram:] - sums[: n - gram + 1]) * _power("down", BASE_INVERSE, n + 1)[: n - gram + 1])
        low = (grams & ~U((1 << 31) - 1)) | at.astype(U)
        width = 1
        while width * 2 <= span:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        if span > width:
            low = np.minimum(low[: n - length + 1], low[span - width : span - width + n - length + 1])
        anchor = (low & U((1 << 31) - 1)).astype(np.int64)
        inside = np.ones(n - length + 1, bool)
        out = (self.ends[:, None] - np.arange(1, length)).ravel()
        inside[out[(out >= 0) & (out < len(inside))]] = False
        at = np.flatnonzero(inside)
        anchor = anchor[at]
        new = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1)]) if len(at) else np.zeros(0, np.int64)
        self.start, self.count = at[new], np.diff(np.r_[new, len(at)])
        self.key = mixed(grams[anchor[new]] ^ U(0x5851F42D4C957F2D))  # the smallest hashes are not even, these are
        self.hash = _span_hash(sums, self.start, self.start + self.count + length - 1)
        self.text = np.searchsorted(self.ends, self.start, "right")

    def keep(self, some: np.ndarray) -> None:
        for name in ("start", "count", "key", "hash", "text"):
            setattr(self, name, getattr(self, name)[some])

    def bytes_of(self, rows: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        return _gather(self.buf, self.start[rows], self.count[rows] + length - 1)


def _changes(buf: np.ndarray, start: np.ndarray, size: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    """Of regions in order of keys, which differ from the one before, in a key or in their bytes."""
    new = np.ones(len(start), bool)
    if len(start):
        new[1:] = np.any([k[1:] != k[:-1] for k in (*keys, size)], axis=0)
        at = np.flatnonzero(~new)
        for i in range(0, len(at), 1 << 14):  # equal keys: the bytes decide
            k = at[i : i + (1 << 14)]
            a, n = _gather(buf, start[k], size[k])
            b, _ = _gather(buf, start[k - 1], size[k])
            new[k] = np.add.reduceat(a != b, np.cumsum(n) - n) > 0
    return new


def _gather(buf: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the joined bytes from each start on, their sizes)."""
    ends = np.cumsum(size)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    i = 0
    while i < len(start):  # about COPY_BYTES at a time, as places take eight bytes for each
        at = int(ends[i] - size[i])
        j = max(i + 1, int(np.searchsorted(ends, at + COPY_BYTES, "right")))
        n = size[i:j]
        out[at : ends[j - 1]] = buf[np.repeat(start[i:j] - (ends[i:j] - n - at), n) + np.arange(ends[j - 1] - at)]
        i = j
    return out, size


def _runs(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    at, size, run = 0, 0, []
    for i, t in enumerate(texts):
        if run and size + len(t) > RUN_BYTES:
            yield at, run
            at, size, run = i, 0, []
        run.append(t)
        size += len(t)
    if run:
        yield at, run


def _given_back(run: Callable[..., pa.Table]) -> Callable[..., pa.Table]:
    """run() of a group; what it worked with is given back to the machine before the next group, as the worker lives on."""

    def one(key: tuple, table: pa.Table) -> pa.Table:
        out = run(key, table)
        trim()
        return out

    def two(key: tuple, mine: pa.Table, got: pa.Table) -> pa.Table:
        out = run(key, mine, got)
        trim()
        return out

    return one if run.__code__.co_argcount == 2 else two


def _short(key: np.ndarray, bits: int) -> np.ndarray:
    """Bucket above 32 bits of key: what is sent of it. Keys that clash only bring regions to be compared in vain."""
    return ((key >> U(64 - bits)) << U(32)) | (key & U(0xFFFFFFFF))


def _by_bucket(keys: np.ndarray, bits: int) -> np.ndarray:
    return np.searchsorted(keys, np.arange((1 << bits) + 1, dtype=U) << U(32))


MESSAGE = "bucket bigint, chunk bigint, step int, data binary"


def _messages(rows: list[tuple[int, int, int, bytes]]) -> pa.Table:
    cols = list(zip(*rows)) if rows else [[], [], [], []]
    return pa.table({"bucket": pa.array(cols[0], pa.int64()), "chunk": pa.array(cols[1], pa.int64()), "step": pa.array(cols[2], pa.int32()), "data": pa.array(cols[3], pa.binary())})


def _ask_anchors(docs: DataFrame, bits: int, length: int, gram: int) -> DataFrame:
    def of(chunk: int, texts: list[bytes]) -> pa.Table:
        keys, owner = [], []
        for at, run in _runs(texts):
            r = Regions(run, length, gram)
            keys.append(_short(r.key, bits))
            owner.append(r.text + at)
        key, text = np.concatenate(keys), np.concatenate(owner)
        order = np.lexsort((text, key))
        key, text = key[order], text[order]
        new = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
        several = text[new] != text[np.r_[new[1:], len(key)] - 1] if len(key) else np.zeros(0, bool)
        key = key[new]
        cut = _by_bucket(key, bits)
        return _messages([(b, chunk, 1, pack(key[i:j].astype("<u4"), several[i:j])) for b, (i, j) in enumerate(zip(cut, cut[1:])) if j > i])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, texts = None, []
        for batch in batches:
            for chunk, text in zip(*(c.to_pylist() for c in batch.columns)):
                if texts and (chunk != held or len(texts) >= CHUNK_ROWS):
                    yield from of(held, texts).to_batches()
                    texts = []
                    trim()
                held = chunk
                texts.append((text or "").encode("utf-8", "replace"))
        if texts:
            yield from of(held, texts).to_batches()
        trim()

    return docs.select("chunk", "text").mapInArrow(run, MESSAGE)


def _answer_anchors(asked: DataFrame, tasks: int) -> DataFrame:
    """To each chunk, for its distinct anchors of a bucket in order, whether another document or chunk has it too."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        parts = [unpack(d, "<u4", "?") for d in table.column("data").to_pylist()]
        flat, several = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
        chunk = np.repeat(table.column("chunk").to_numpy(), [len(p[0]) for p in parts])
        order = np.lexsort((chunk, flat))
        flat, several, chunk = flat[order], several[order], chunk[order]
        new = np.flatnonzero(np.r_[True, flat[1:] != flat[:-1]])
        many = np.logical_or.reduceat(several, new) | (np.diff(np.r_[new, len(flat)]) > 1)
        many = np.repeat(many, np.diff(np.r_[new, len(flat)]))
        own = np.r_[True, (flat[1:] != flat[:-1]) | (chunk[1:] != chunk[:-1])]  # once per chunk
        flat, many, chunk = flat[own], many[own], chunk[own]
        order = np.argsort(chunk, kind="stable")
        chunk, many = chunk[order], many[order]
        new = np.flatnonzero(np.r_[True, chunk[1:] != chunk[:-1]])
        return _messages([(key[0].as_py(), int(chunk[i]), 1, pack(many[i:j])) for i, j in zip(new, np.r_[new[1:], len(chunk)])])

    return asked.repartition(tasks, "bucket").groupBy("bucket").applyInArrow(_given_back(run), MESSAGE)


class _Chunk:
    """The rows of a chunk in a fixed order, and their regions that may hold repeats, by bucket and hash."""

    def __init__(self, table: pa.Table, answers: pa.Table, bits: int, length: int, gram: int) -> None:
        ids, texts = table.column("id").to_pylist(), table.column("text").to_pylist()
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i], texts[i] or ""))
        self.order, self.ids = order, [ids[i] for i in order]
        texts = [(texts[i] or "").encode("utf-8", "replace") for i in order]
        self.runs = [(at, Regions(run, length, gram)) for at, run in _runs(texts)]
        del texts
        short = np.concatenate([_short(r.key, bits) for _, r in self.runs])
        self.got = {(s, b): d for s, b, d in zip(*(answers.column(c).to_pylist() for c in ("step", "bucket", "data")))}
        first = [b for b in range(1 << bits) if (1, b) in self.got]
        many = np.concatenate([unpack(self.got[1, b], "?")[0] for b in first]) if first else np.zeros(0, bool)
        repeated = np.unique(short)[many]
        del short
        for _, r in self.runs:
            key = _short(r.key, bits)
            r.keep(repeated[np.minimum(np.searchsorted(repeated, key), len(repeated) - 1)] == key if len(repeated) else np.zeros(len(key), bool))
        cat = lambda f: np.concatenate([f(k, at, r) for k, (at, r) in enumerate(self.runs)])
        self.short, self.hash = cat(lambda k, at, r: _short(r.key, bits)), cat(lambda k, at, r: r.hash)
        self.run = cat(lambda k, at, r: np.full(len(r.start), k, np.int32))
        self.row = cat(lambda k, at, r: np.arange(len(r.start), dtype=np.int32))
        self.count, self.text = cat(lambda k, at, r: r.count), cat(lambda k, at, r: r.text + at)
        for _, r in self.runs:
            del r.key, r.hash, r.text
        order = np.lexsort((self.text, self.hash, self.short))
        for name in ("short", "hash", "run", "row", "count", "text"):
            setattr(self, name, getattr(self, name)[order])
        buf = np.concatenate([r.buf for _, r in self.runs]) if self.runs else np.zeros(0, np.uint8)
        begin = np.cumsum([0, *(len(r.buf) for _, r in self.runs)])
        start = np.concatenate([r.start + b for (_, r), b in zip(self.runs, begin)])[order]
        self.new = np.flatnonzero(_changes(buf, start, self.count + length - 1, self.short, self.hash))
        self.doc = np.array([NONE if i is None else i for i in self.ids], np.int64)[self.text]


def _ask_regions(bundled: DataFrame, answers: DataFrame, bits: int, length: int, gram: int, tasks: int) -> DataFrame:
    """A chunk's distinct regions that may hold repeats: bytes, sizes, keys and smallest documents, by bucket."""

    def run(key: tuple, mine: pa.Table, got: pa.Table) -> pa.Table:
        chunk = mine.column("chunk")[0].as_py()
        c = _Chunk(unbundled(mine), got, bits, length, gram)
        if not len(c.new):
            return _messages([])
        low = np.minimum.reduceat(c.doc, c.new)
        size = c.count[c.new] + length - 1
        joined = np.empty(size.sum(), np.uint8)
        place = np.cumsum(size) - size
        for k, (_, r) in enumerate(c.runs):
            rows = np.flatnonzero(c.run[c.new] == k)
            data, n = r.bytes_of(c.row[c.new][rows], length)
            joined[np.repeat(place[rows] - (np.cumsum(n) - n), n) + np.arange(n.sum())] = data
        cut = _by_bucket(c.short[c.new], bits)
        ends = np.r_[place, len(joined)]
        return _messages([
            (b, chunk, 2, pack(joined[ends[i] : ends[j]], size[i:j].astype("<u2"), c.short[c.new][i:j].astype("<u4"), low[i:j]))
            for b, (i, j) in enumerate(zip(cut, cut[1:])) if j > i
        ])

    return bundled.repartition(tasks, "chunk").groupBy("chunk").cogroup(answers.repartition(tasks, "chunk").groupBy("chunk")).applyInArrow(_given_back(run), MESSAGE)


def lowest_documents(joined: np.ndarray, size: np.ndarray, key: np.ndarray, low: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(number of strings of each text, for each string of each text in order the smallest document that holds it), for distinct texts of one or more strings each with a key and its smallest document.

    Texts whose key no other has hold their strings alone; the others' suffixes are ranked, all texts of a key together
    and of as many keys as come to about RANK_BYTES.
    """
    size = size.astype(np.int64)
    count = size - length + 1
    out, start, first = np.repeat(low, count), np.cumsum(size) - size, np.cumsum(count) - count
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    shared = np.r_[False, same] | np.r_[same, False] if len(key) else np.zeros(0, bool)
    rows = order[shared]
    if not len(rows):
        return count, out
    new_key = np.flatnonzero(np.r_[True, key[rows][1:] != key[rows][:-1]])
    block = (np.cumsum(size[rows]) - size[rows])[new_key] // RANK_BYTES
    cuts = np.r_[new_key[np.flatnonzero(np.r_[True, block[1:] != block[:-1]])], len(rows)]
    for i, j in zip(cuts, cuts[1:]):
        part = rows[i:j]
        text, n = _gather(joined, start[part], size[part])
        where = np.repeat(first[part] - np.r_[0, np.cumsum(count[part])[:-1]], count[part]) + np.arange(count[part].sum())
        out[where] = _ranked_minimum(text, n, count[part], low[part], length)
    return count, out


def _ranked_minimum(text: np.ndarray, size: np.ndarray, count: np.ndarray, low: np.ndarray, length: int) -> np.ndarray:
    """The smallest document of each string of the joined texts, by the order of their suffixes."""
    rank = suffix_ranks(text.astype(np.int32) + 1, length)
    at = np.repeat(np.cumsum(size) - size - np.r_[0, np.cumsum(count)[:-1]], count) + np.arange(count.sum())
    order = np.argsort(rank[at])
    ordered = at[order]
    differ = np.ones(len(at), bool)
    for i in range(0, len(at) - 1, 1 << 13):
        b = ordered[i + 1 : i + 1 + (1 << 13)]
        a = ordered[i : i + len(b)]
        differ[i + 1 : i + 1 + len(b)] = (text[a[:, None] + np.arange(length)] != text[b[:, None] + np.arange(length)]).any(axis=1)
    new = np.flatnonzero(differ)
    least = np.minimum.reduceat(np.repeat(low, count)[order], new)
    found = np.empty(len(at), np.int64)
    found[order] = np.repeat(least, np.diff(np.r_[new, len(at)]))
    return found


def _answer_regions(asked: DataFrame, length: int, tasks: int) -> DataFrame:
    """To each chunk, for its regions of a bucket in order: whether one document is the smallest for all strings, that document, and else one for each string."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        parts = [unpack(d, "u1", "<u2", "<u4", "<i8") for d in table.column("data").to_pylist()]
        size, short, low = (np.concatenate([p[i] for p in parts]) for i in (1, 2, 3))
        size = size.astype(np.int64)
        joined = np.concatenate([p[0] for p in parts])
        start = np.cumsum(size) - size
        hashes = np.concatenate([_span_hash(_sums(p[0]), (s := np.cumsum(p[1].astype(np.int64)) - p[1]), s + p[1]) for p in parts])
        order = np.lexsort((hashes, short))
        new = _changes(joined, start[order], size[order], short[order], hashes[order])
        which = np.empty(len(order), np.int64)
        which[order] = np.cumsum(new) - 1
        one = order[new]
        least = np.minimum.reduceat(low[order], np.flatnonzero(new))
        text, n = _gather(joined, start[one], size[one])
        count, strings = lowest_documents(text, n, short[one], least, length)
        first = np.cumsum(count) - count
        flat = np.minimum.reduceat(strings, first) == np.maximum.reduceat(strings, first)
        at = 0
        rows = []
        trim()
        for chunk, p in zip(table.column("chunk").to_pylist(), parts):
            mine = which[at : at + len(p[1])]
            at += len(p[1])
            single = flat[mine]
            more = mine[~single]
            where = np.repeat(first[more] - np.r_[0, np.cumsum(count[more])[:-1]], count[more]) + np.arange(count[more].sum()) if len(more) else np.zeros(0, np.int64)
            rows.append((key[0].as_py(), chunk, 2, pack(single, strings[first[mine]], strings[where])))
        return _messages(rows)

    return asked.repartition(tasks, "bucket").groupBy("bucket").applyInArrow(_given_back(run), MESSAGE)


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text", chunk_col: str | None = None, carry: tuple[str, ...] = (), as_text: bool = False) -> DataFrame:
    """(id_col, n_bytes, span_starts, span_ends, kept) of each row: maximal runs of removed bytes of its text in UTF-8, and the bytes that stay.

    A byte goes if it lies in a string of `length` bytes that also starts in a row with a smaller id; all strings are
    judged on the input. A null text counts as empty; shorter texts keep all. A null id is larger than any other; rows
    with one id are not smaller than one another, so repeated rows keep or lose the same bytes. An empty table gives no
    rows; other columns are dropped. chunk_col, a long, names chunks of about CHUNK_ROWS rows that lie together where
    docs is read; without it rows are dealt by their id's hash. Columns
    named in carry go along. as_text: kept is a string, without bytes of characters that were cut.
    """
    tune(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"), *(F.col(x).alias(f"carry_{i}") for i, x in enumerate(carry)), *([F.col(chunk_col).alias("chunk")] if chunk_col else []))
    size = rows.agg(F.sum(F.octet_length("text")).alias("b"), F.count(F.lit(1)).alias("n")).first()
    if not chunk_col:
        rows = rows.withColumn("chunk", F.pmod(F.xxhash64("id"), F.lit(-(-size["n"] // CHUNK_ROWS) or 1)))
        asked = rows.repartition("chunk").sortWithinPartitions("chunk")
    else:
        asked = rows
    bits = max(3, ((size["b"] or 0) // BUCKET_BYTES).bit_length())
    tasks = max(8, (size["b"] or 0) // TASK_BYTES)  # tasks of one size, however much there is
    anchors = written(_answer_anchors(_ask_anchors(asked, bits, length, gram), tasks), "suffix-anchors")
    bundled = bundles(asked, CHUNK_ROWS)
    regions = written(_answer_regions(_ask_regions(bundled, anchors, bits, length, gram, tasks), length, tasks), "suffix-regions")
    answers = anchors.unionByName(regions)

    def run(key: tuple, mine: pa.Table, got: pa.Table) -> pa.Table:
        mine = unbundled(mine)
        c = _Chunk(mine, got, bits, length, gram)
        n_of = np.zeros(len(c.new), np.int64)
        singles, firsts, manys = [], [], []
        for b in sorted(b for s, b in c.got if s == 2):
            s, f, m = unpack(c.got[2, b], "?", "<i8", "<i8")
            singles.append(s), firsts.append(f), manys.append(m)
        lost = [np.zeros(len(r.buf) + 1, np.int32) for _, r in c.runs]
        if len(c.new):
            single, lowest, many = np.concatenate(singles), np.concatenate(firsts), np.concatenate(manys)
            count = c.count[c.new]
            n_of[~single] = count[~single]
            begin = np.cumsum(n_of) - n_of
            which = np.repeat(np.arange(len(c.new)), np.diff(np.r_[c.new, len(c.short)]))
            for k, (_, r) in enumerate(c.runs):
                own = np.flatnonzero(c.run == k)
                start, content, doc = r.start[c.row[own]], which[own], c.doc[own]
                whole = single[content] & (lowest[content] < doc)  # all strings go: one run
                np.add.at(lost[k], start[whole], 1)
                np.add.at(lost[k], start[whole] + c.count[own][whole] - 1 + length, -1)
                some = ~single[content]
                start, content, doc, size = start[some], content[some], doc[some], c.count[own][some]
                for i in range(int(size.max()) if len(size) else 0):
                    has = size > i
                    gone = start[has][many[begin[content[has]] + i] < doc[has]] + i
                    lost[k][gone] += 1
                    lost[k][gone + length] -= 1
        n_bytes, starts, ends, kept = [], [], [], []
        for (_, r), d in zip(c.runs, lost):
            gone = np.cumsum(d[:-1]) > 0
            for end, begin_ in zip(r.ends, np.r_[0, r.ends[:-1]]):
                part = gone[begin_:end]
                edge = np.flatnonzero(np.diff(np.r_[False, part, False].astype(np.int8)))
                n_bytes.append(int(end - begin_))
                starts.append(edge[0::2])
                ends.append(edge[1::2])
                kept.append(r.buf[begin_:end][~part].tobytes() if len(edge) else r.buf[begin_:end].tobytes())
        spans = pa.list_(pa.int64())
        trim()
        if as_text:
            kept = [k.decode("utf-8", "ignore") for k in kept]
        along = {x: mine.column(f"carry_{i}").take(pa.array(c.order, pa.int64())) for i, x in enumerate(carry)}
        return pa.table({id_col: pa.array(c.ids, pa.int64()), "n_bytes": pa.array(n_bytes, pa.int64()), "span_starts": pa.array(starts, spans), "span_ends": pa.array(ends, spans), "kept": pa.array(kept, pa.string() if as_text else pa.binary()), **along})

    return bundled.repartition(tasks, "chunk").groupBy("chunk").cogroup(answers.repartition(tasks, "chunk").groupBy("chunk")).applyInArrow(_given_back(run), f"`{id_col}` bigint, n_bytes bigint, span_starts array<bigint>, span_ends array<bigint>, kept {'string' if as_text else 'binary'}" + "".join(f", `{x}` {docs.schema[x].dataType.simpleString()}" for x in carry))
