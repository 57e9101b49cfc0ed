"""Language-model scores from a weighted backoff automaton.

States are the histories met in training: the root (no history), each word and, in a model of order n, each run of up
to n - 1 words; a text begins in the state of its start. A state has an arc for each word seen after it, with its
smoothed log10 probability, and a failure arc, with its backoff weight, to the state of its history without the first
word. Reading a word follows failure arcs until a state has an arc for it; the arc leads to the state of the longest
history met. Probabilities are smoothed level by level with Dirichlet priors around those of the shorter history, and
the root's by an absolute discount whose mass goes to the class of unknown words; so a state's arcs, with what its
failure arc leads to, sum to one.

The whole automaton is never in one place: a chunk of documents asks for the counts of the n-grams it holds, builds
the states and arcs that its texts can reach, and reads all its texts from left to right, each carrying its state.
N-grams travel as sorted 64-bit hashes, cut into buckets by their first bits; each bucket sums the counts of all
chunks and answers each chunk in the order in which it asked. From three words on a chunk asks only for n-grams whose
first and last n - 1 words are both met in other chunks; what is met in no other chunk it has counted whole. Nothing is
dropped, and no n-gram is hot, as a chunk names it once.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.group_ops import PandasCogroupedOps

from leafline.llm.blobs import bundles, from_planes, pack, planes, unbundled, unpack
from leafline.llm.storage import place_in_files, remove, trim, tune, written
from leafline.llm.wordhash import U, all_words, mixed

#: Hashes of the start and the end of a text; an odd multiplier.
START, END, STEP = U(0x51A7), U(0xE9D), U(0xD6E8FEB86659FD93)
#: Weight of the shorter history's distribution in a state, in observations, by the words of its history; discount of the root.
#: Chosen within the training fold of sf0.1, rows of remainder 2 by those of 0, 3 and 4: log10 a token of -3.056; -3.078 at
#: (1000, 10), -3.051 at (10000, 10), -3.247 at (300, 300), and -3.355 without histories of two words.
PRIORS, DISCOUNT = (3000.0, 10.0), 0.5
#: Bytes of text of a chunk, about, and its most documents; bytes of text for which there is one bucket.
CHUNK_BYTES, CHUNK_ROWS, BUCKET_BYTES = 6 << 20, 3000, 4 << 20
#: Bytes of text for which there is one task after a shuffle.
TASK_BYTES = 10 << 20
#: Words that a text is read in one stretch.
STRETCH = 1000
ANSWER = "chunk bigint, n int, bucket bigint, data binary, types bigint, total bigint"
ASKED = "bucket bigint, chunk bigint, n int, data binary"


def sequences(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token hashes of all texts, each with a start before and an end behind; their places in their text; numbers of tokens, the end counted and the start not)."""
    words, n = all_words(texts)
    first = np.cumsum(n + 2) - (n + 2)
    toks = np.empty(len(words) + 2 * len(n), U)
    is_word = np.ones(len(toks), bool)
    is_word[first] = is_word[first + n + 1] = False
    toks[is_word], toks[first], toks[first + n + 1] = words, START, END
    return toks, np.arange(len(toks)) - np.repeat(first, n + 2), n + 1


def grams(toks: np.ndarray, order: int) -> list[np.ndarray]:
    """Hash of the 1 to `order` tokens that end at each place; places nearer to the start have none of that length."""
    out = [toks]
    for _ in range(order - 1):
        before = np.empty(len(toks), U)
        before[:1], before[1:] = 0, out[-1][:-1]
        out.append(mixed(before * STEP + (toks ^ (toks >> U(17)))))
    return out


def _counted(keys: np.ndarray, trained: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, how often each is trained on, and the number of each key given."""
    distinct, which = np.unique(keys, return_inverse=True)
    return distinct, np.bincount(which, weights=trained, minlength=len(distinct)).astype(np.int64), which


def _messages(rows: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[], [], [], []]
    return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int32()), pa.array(cols[3], pa.binary())], ["bucket", "chunk", "n", "data"])


def _by_bucket(chunk: int, n: int, keys: np.ndarray, counts: np.ndarray, bits: int) -> list[tuple[int, int, int, bytes]]:
    cut = np.r_[0, np.searchsorted(keys, np.arange(1, 1 << bits, dtype=U) << U(64 - bits)), len(keys)]
    return [(b, chunk, n, pack(planes(np.diff(keys[i:j], prepend=U(0))), planes(counts[i:j]))) for b, (i, j) in enumerate(zip(cut, cut[1:])) if j > i]


def _ask_short(docs: DataFrame, bits: int) -> DataFrame:
    """The n-grams of one and two tokens of each chunk that fall into a bucket, with their trained counts."""

    def of(chunk: int, texts: list, train: list) -> pa.RecordBatch:
        toks, place, n = sequences(texts)
        trained = np.repeat(np.array(train, float), n + 1)
        out = []
        for i, keys in enumerate(grams(toks, 2)):
            keys, counts, _ = _counted(keys[place > 0], trained[place > 0])
            out += _by_bucket(chunk, i + 1, keys, counts, bits)
        return _messages(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, texts, train = None, [], []
        for batch in batches:
            for chunk, text, learn in zip(*(c.to_pylist() for c in batch.columns)):
                if texts and (chunk != held or len(texts) >= CHUNK_ROWS):
                    yield of(held, texts, train)
                    texts, train = [], []
                held = chunk
                texts.append(text)
                train.append(learn)
        if texts:
            yield of(held, texts, train)
        trim()

    return docs.select("chunk", "text", "train").mapInArrow(run, ASKED)


def _answer(asked: DataFrame, tasks: int) -> DataFrame:
    """For each chunk the trained counts of its n-grams in a bucket, in order, and whether another chunk has them; and with chunk null the bucket's number of trained n-grams and their sum."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        bucket, n = (k.as_py() for k in key)
        parts = [unpack(d, "u1", "u1") for d in table.column("data").to_pylist()]
        keys = [np.cumsum(from_planes(p[0])) for p in parts]
        flat = np.concatenate(keys)
        order = np.argsort(flat, kind="stable")
        new = np.r_[True, flat[order][1:] != flat[order][:-1]]
        starts = np.flatnonzero(new)
        sums = np.add.reduceat(np.concatenate([from_planes(p[1]) for p in parts])[order].astype(np.int64), starts)
        chunks = table.column("chunk").to_numpy()
        owner = np.repeat(chunks, [len(k) for k in keys])[order]
        several = np.minimum.reduceat(owner, starts) != np.maximum.reduceat(owner, starts)
        which = np.empty(len(flat), np.int64)
        which[order] = np.cumsum(new) - 1
        cuts = np.cumsum([0, *(len(k) for k in keys)])
        rows: dict[int, list[np.ndarray]] = {}
        for c, i, j in zip(chunks.tolist(), cuts, cuts[1:]):
            rows.setdefault(c, []).append(which[i:j])
        replies = []
        for mine in rows.values():  # a chunk's rows may come in several runs
            at = mine[0] if len(mine) == 1 else np.unique(np.concatenate(mine))
            replies.append(pack(planes(sums[at]), several[at]))
        trim()
        k = len(rows)
        return pa.table({
            "chunk": pa.array([*rows, None], pa.int64()), "n": pa.array([n] * (k + 1), pa.int32()), "bucket": pa.array([bucket] * (k + 1), pa.int64()), "data": pa.array([*replies, None], pa.binary()),
            "types": pa.array([None] * k + [int((sums > 0).sum())], pa.int64()), "total": pa.array([None] * k + [int(sums.sum())], pa.int64()),
        })

    return asked.repartition(tasks, "bucket", "n").groupBy("bucket", "n").applyInArrow(run, ANSWER)


class Counts:
    """Of each length, a chunk's n-grams in order, their trained counts, whether other chunks may have them, and which of them ends at each place (-1: none)."""

    def __init__(self, texts: list[str | None], train: list[bool], answers: pa.Table, order: int) -> None:
        self.toks, self.place, self.n = sequences(texts)
        trained = np.repeat(np.array(train, float), self.n + 1)
        got: dict[int, list[tuple[int, bytes]]] = {}
        for n, bucket, data in zip(*(answers.column(c).to_pylist() for c in ("n", "bucket", "data"))):
            got.setdefault(n, []).append((bucket, data))
        self.keys, self.count, self.asks, self.at = [], [], [], []
        shared = np.zeros(0, bool)
        for n, hashes in enumerate(grams(self.toks, order), 1):
            inside = np.flatnonzero(self.place >= max(n - 1, 1))
            keys, count, which = _counted(hashes[inside], trained[inside])
            at = np.full(len(hashes), -1)
            at[inside] = which
            if n < 3:
                asks = np.ones(len(keys), bool)
            else:
                asks = np.zeros(len(keys), bool)
                asks[which] = shared[inside - 1] & shared[inside]
            several = np.zeros(len(keys), bool)
            if n in got:
                replies = [unpack(d, "u1", "?") for _, d in sorted(got[n])]
                count[asks] = np.concatenate([from_planes(r[0]) for r in replies]).astype(np.int64)
                several[asks] = np.concatenate([r[1] for r in replies])
            shared = np.zeros(len(hashes), bool)
            shared[inside] = several[which]
            self.keys.append(keys), self.count.append(count), self.at.append(at), self.asks.append(asks)


def _by_chunk(bundled: DataFrame, answers: DataFrame, tasks: int) -> PandasCogroupedOps:
    """Each chunk's rows with its answers."""
    return bundled.repartition(tasks, "chunk").groupBy("chunk").cogroup(answers.select("chunk", "n", "bucket", "data").repartition(tasks, "chunk").groupBy("chunk"))


def _ask_long(bundled: DataFrame, answers: DataFrame, n: int, bits: int, tasks: int) -> DataFrame:
    """The n-grams of n tokens of each chunk that other chunks may have, with the chunk's own trained counts."""

    def run(key: tuple, mine: pa.Table, got: pa.Table) -> pa.Table:
        rows = unbundled(mine)
        c = Counts(rows.column("text").to_pylist(), rows.column("train").to_pylist(), got, n)
        asks = c.asks[-1]
        out = pa.Table.from_batches([_messages(_by_bucket(key[0].as_py(), n, c.keys[-1][asks], c.count[-1][asks], bits))])
        trim()
        return out

    return _by_chunk(bundled, answers, tasks).applyInArrow(run, ASKED)


class Automaton:
    """States, arcs and failure arcs over the words numbered 0 to n_words - 1; state 0 is the root.

    An arc is found by its state and word in one sorted array; all arrays are flat, so many texts are read at once.
    """

    def __init__(self, fail: np.ndarray, fail_weight: np.ndarray, keys: np.ndarray, weight: np.ndarray, target: np.ndarray, root: np.ndarray) -> None:
        self.fail, self.fail_weight, self.root, self.n_words = fail, fail_weight, root, len(root)
        order = np.argsort(keys)
        self.keys, self.weight, self.target = np.r_[keys[order], np.iinfo(np.int64).max], np.r_[weight[order], 0.0], np.r_[target[order], 0]

    def step(self, state: np.ndarray, word: np.ndarray, home: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(log10 weight, next state) of each state that reads a word; `home` is the state of each word as a history of its own."""
        weight, nxt, failed = self.root[word], home[word], np.zeros(len(state))  # what the root's arcs give
        left = np.flatnonzero(state)
        at = state[left]
        while len(left):
            key = at * self.n_words + word[left]
            arc = self.keys.searchsorted(key)
            hit = self.keys[arc] == key
            done, arc, miss = left[hit], arc[hit], ~hit
            weight[done], nxt[done] = self.weight[arc], self.target[arc]
            left, at = left[miss], at[miss]
            failed[left] += self.fail_weight[at]
            at = self.fail[at]
            left, at = left[at > 0], at[at > 0]
        return weight + failed, nxt

    def read(self, words: np.ndarray, first: np.ndarray, n: np.ndarray, begin: int, home: np.ndarray, history: int) -> np.ndarray:
        """Summed log10 weights of texts, n words each from words[first] on, read from the state `begin`, all texts one word at a time.

        A text of more than STRETCH words is read in stretches side by side: the last `history` words alone decide the
        state, so each reads as many words before its own to come into the state in which the one before ends.
        """
        parts = -(-n // STRETCH)
        text = np.repeat(np.arange(len(n)), parts)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(parts) - parts, parts)
        before = np.where(nth > 0, history, 0)
        size = np.minimum(n[text] - nth * STRETCH, STRETCH) + before
        order = np.argsort(-size, kind="stable")
        start, size, before = (first[text] + nth * STRETCH - before)[order], size[order], before[order]
        total, state = np.zeros(len(size)), np.where(before > 0, 0, begin)
        active = np.searchsorted(-size, -np.arange(int(size[0]) if len(size) else 0), "left")
        for t, k in enumerate(active.tolist()):
            weight, state[:k] = self.step(state[:k], words[start[:k] + t], home)
            total[:k] += weight if t >= history else np.where(before[:k] > t, 0.0, weight)
        return np.bincount(text[order], weights=total, minlength=len(n))


def automaton(c: Counts, n_types: int, total: int, n_texts: int, priors: Sequence[float], order: int) -> tuple[Automaton, np.ndarray, int, np.ndarray]:
    """(the part of the automaton that a chunk's texts can reach, its words at each place, the state texts begin in, each word's own state)."""
    n_words = len(c.keys[0]) + 1  # the start is the last one
    word = np.where(c.place > 0, c.at[0], n_words - 1)
    known = np.r_[c.count[0] > 0, False]
    root = np.log10(np.where(known, np.r_[c.count[0], 0] - DISCOUNT, DISCOUNT * n_types) / total) if total else np.zeros(n_words)
    history = np.r_[c.count[0], n_texts]  # what is trained on with each state as its history
    # level 1: a state for each trained word and for the start
    state_of = np.where(history > 0, np.cumsum(history > 0), 0)
    home = state_of.copy()
    fails, fail_weights, keys, weights, targets = [np.zeros(1 + (history > 0).sum(), np.int64)], [np.zeros(1)], [], [], []
    fail_weights.append(np.log10(priors[0] / (history[history > 0] + priors[0])))
    p_short = 10.0**root  # of the last word after the history without its first word, by number at the level
    last_at = word  # number of the n-gram of the level below at each place
    for n in range(2, order + 1):
        at, count, prior = c.at[n - 1], c.count[n - 1], priors[n - 2]
        spot = np.zeros(len(count), np.int64)  # a place where each n-gram ends
        inside = np.flatnonzero(at >= 0)
        spot[at[inside]] = inside
        seen = np.flatnonzero(count > 0)
        where = spot[seen]
        before, short = last_at[where - 1], last_at[where]
        held = history[before]
        p = (count[seen] + prior * p_short[short]) / (held + prior)
        keys.append(state_of[before] * n_words + word[where])
        weights.append(np.log10(p))
        # the next level's probabilities need one for each n-gram, seen or not
        p_all = prior / (history[last_at[spot - 1]] + prior) * p_short[last_at[spot]] if n < order else None
        if n < order:
            p_all[seen] = p
            begun = sum(map(len, fail_weights))
            state = np.zeros(len(count), np.int64)
            state[seen] = begun + np.arange(len(seen))
            targets.append(state[seen])
            fails.append(state_of[short])
            fail_weights.append(np.log10(priors[n - 1] / (count[seen] + priors[n - 1])))
            state_of, history, p_short, last_at = state, count, p_all, np.where(at >= 0, at, 0)
        else:
            targets.append(state_of[short])
    cat = lambda parts, kind: np.concatenate(parts).astype(kind) if parts else np.zeros(0, kind)
    made = Automaton(cat(fails, np.int64), cat(fail_weights, float), cat(keys, np.int64), cat(weights, float), cat(targets, np.int64), root)
    return made, word, int(home[n_words - 1]), home


def score(docs: DataFrame, train_col: str = "train", id_col: str = "doc_id", text_col: str = "text", order: int = 3, priors: Sequence[float] = PRIORS) -> DataFrame:
    """(id_col, train, n_tokens, n_known, train_tokens, base_score, score) of each row, by a model of `order` words (2 or more) with a prior for each length of history.

    Counts come from the rows whose train_col is true. A null text counts as empty: one token, the end. Null ids of
    rows, repeated rows and ties are scored row by row; with no training rows every token is of the unknown class. An
    empty table gives no rows; other columns are dropped. Rows that lie together in the files of docs form a chunk;
    where docs reads no files, rows are dealt by their hash.
    """
    if order < 2 or len(priors) < order - 1:
        raise ValueError("order is 2 or more, with a prior for each length of history")
    tune(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.coalesce(F.col(train_col), F.lit(False)).alias("train"))
    size = rows.agg(F.sum(F.octet_length("text")).alias("b"), F.count(F.lit(1)).alias("n"), F.count_if("train").alias("t")).first()
    n_bytes, n_rows = size["b"] or 0, size["n"]
    per = max(1, min(CHUNK_ROWS, CHUNK_BYTES * n_rows // max(n_bytes, 1)))
    place = place_in_files(rows, per)
    if place is None:
        rows = rows.withColumn("chunk", F.pmod(F.xxhash64("id", "text"), F.lit(-(-n_rows // per) or 1)))
        rows = rows.repartition("chunk").sortWithinPartitions("chunk")
    else:
        rows = rows.withColumn("chunk", place)
    bits = max(3, (n_bytes // BUCKET_BYTES).bit_length())
    tasks = max(8, n_bytes // TASK_BYTES)  # tasks of one size, however much there is
    parts = [written(_answer(_ask_short(rows, bits), tasks), "lm-answers")]
    bundled = bundles(rows, CHUNK_ROWS)
    answers = parts[0].filter("chunk is not null")
    for n in range(3, order + 1):
        parts.append(written(_answer(_ask_long(bundled, answers, n, bits, tasks), tasks), "lm-answers"))
        answers = answers.unionByName(parts[-1].filter("chunk is not null"))
    seen = parts[0].filter("chunk is null and n = 1").agg(F.sum("types").alias("v"), F.sum("total").alias("n")).first()
    n_types, total, n_texts = seen["v"] or 0, seen["n"] or 0, size["t"]

    def run(key: tuple, mine: pa.Table, got: pa.Table) -> pa.Table:
        mine = unbundled(mine)
        c = Counts(mine.column("text").to_pylist(), mine.column("train").to_pylist(), got, order)
        made, word, begin, home = automaton(c, n_types, total, n_texts, priors, order)
        first = np.cumsum(c.n + 1) - (c.n + 1) + 1
        scores = made.read(word, first, c.n, begin, home, order - 1)
        count = c.count[0][word[c.place > 0]]
        base = np.log10((count + 0.5) / (total + 0.5 * (n_types + 1)))
        cuts = np.cumsum(c.n) - c.n
        trim()
        return pa.table({
            id_col: mine.column("id"), "train": mine.column("train"), "n_tokens": pa.array(c.n, pa.int64()), "n_known": pa.array(np.add.reduceat((count > 0).astype(np.int64), cuts), pa.int64()),
            "train_tokens": pa.array([total] * len(c.n), pa.int64()), "base_score": pa.array(np.add.reduceat(base, cuts)), "score": pa.array(scores),
        })

    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {id_type}, train boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    return _by_chunk(bundled, answers, tasks).applyInArrow(run, schema)
