"""N-gram Jaccard join over count vectors.

A text's shingles are hashed into GROUPS groups; the counts per group are its point. Of two sets the overlap is at
most the sum of the smaller counts, group by group, so an R-tree over points bounds it for whole nodes: a node's
largest counts stand for its points. Sets that can be similar enough share one of their first shingles in a common
order (the prefix that must hold a shared one), very common shingles last; each such shingle's block has its own
R-tree. Pairs that survive the bound are grouped, and within a group the sets themselves decide.

Texts with equal sets are one representative before. Within blocks and groups, pairs already connected are passed over,
so groups of many near copies cost little more than their size; blocks over BLOCK members are split into pairs of
parts. All links between representatives count, none is capped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leafline.llm.components import components
from leafline.llm.storage import likely, salted_join, trim, tune, without, written
from leafline.llm.wordhash import U, all_words, mixed

GROUPS = 64
#: Groups of large sets, a multiple of GROUPS: the bound of few groups says little of these.
FINE = 512
#: Members of a block or group that one task compares with one another.
BLOCK = 1024
#: Share of documents from which a shingle counts as common, and documents looked at together to find it.
COMMON, LOOK = 0.001, 2000
#: Points of an R-tree's leaf, and leaves of a node.
FAN = 32


def shingles(texts: list[str | None], k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each shingle, its text's number), in order of position, repeats included; a text of fewer than k words has one, none if it has no words."""
    words, n = all_words(texts)
    owner = np.repeat(np.arange(len(n)), n)
    first = np.cumsum(n) - n
    place = np.arange(len(words)) - first[owner]
    size = np.minimum(n, k)[owner]
    at = np.flatnonzero(place + size <= n[owner])
    h = np.full(len(at), U(k))
    for i in range(k):
        inside = size[at] > i
        nxt = words[np.minimum(at + i, max(len(words) - 1, 0))]
        h = np.where(inside, mixed(h * U(0x9E3779B97F4A7C15) + nxt + U(i + 1)), h)
    return h, owner[at]


def overlap_needed(a: np.ndarray, b: np.ndarray, num: int, den: int) -> np.ndarray:
    """Least intersection of sets of sizes a and b with den * intersection >= num * union."""
    return -(-num * (a + b) // (num + den))


class CountVectorRTree:
    """Points packed into leaves in order of size, and leaves into nodes; a node keeps its points' largest counts and its sizes' range."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray) -> None:
        self.order = np.argsort(sizes, kind="stable")
        self.points, self.sizes = points[self.order], sizes[self.order]
        self.levels = []
        high, low_n, high_n = self.points, self.sizes, self.sizes
        while len(high) > FAN:
            cut = np.arange(0, len(high), FAN)
            high, low_n, high_n = np.maximum.reduceat(high, cut), np.minimum.reduceat(low_n, cut), np.maximum.reduceat(high_n, cut)
            self.levels.append((high, low_n, high_n))

    def near(self, point: np.ndarray, size: int, num: int, den: int, among: np.ndarray) -> np.ndarray:
        """Numbers of the points that may be similar enough, of those with `among` (by number)."""
        open_ = None
        for high, low_n, high_n in reversed(self.levels):
            nodes = np.arange(len(high)) if open_ is None else open_
            nodes = nodes[(low_n[nodes] * num <= size * den) & (high_n[nodes] * den >= size * num)]
            least = overlap_needed(np.maximum(low_n[nodes], -(-size * num // den)), size, num, den)
            nodes = nodes[np.minimum(high[nodes], point).sum(axis=1) >= least]
            below = len(self.points) if high is self.levels[0][0] else len(self.levels[[lv[0] is high for lv in self.levels].index(True) - 1][0])
            open_ = (nodes[:, None] * FAN + np.arange(FAN)).ravel()
            open_ = open_[open_ < below]
        rows = np.arange(len(self.points)) if open_ is None else open_
        rows = rows[among[self.order[rows]]]
        n = self.sizes[rows]
        rows = rows[(n * num <= size * den) & (n * den >= size * num)]
        rows = rows[np.minimum(self.points[rows], point).sum(axis=1) >= overlap_needed(self.sizes[rows], size, num, den)]
        return self.order[rows]


def spanning(n: int, neighbours) -> Iterator[tuple[int, int]]:
    """Edges that connect 0..n-1 as neighbours(i, unseen mask) does; each node is asked once, and only for nodes not reached yet."""
    unseen = np.ones(n, bool)
    for seed in range(n):
        if not unseen[seed]:
            continue
        unseen[seed] = False
        todo = [seed]
        while todo:
            i = todo.pop()
            found = neighbours(i, unseen)
            unseen[found] = False
            for j in found.tolist():
                yield i, j
                todo.append(j)


def _looks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[str | None]]:
    """Texts of LOOK rows at a time."""
    held: list[str | None] = []
    for batch in batches:
        held += batch.column(0).to_pylist()
        while len(held) >= LOOK:
            yield held[:LOOK]
            held = held[LOOK:]
    yield held


def common_shingles(docs: DataFrame, k: int, n_docs: int) -> np.ndarray:
    """Shingles met in about COMMON of all documents or more: found in at least twice that share of some LOOK rows. At most a document's mean number of shingles divided by COMMON, whatever the number of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _looks(batches):
            if part:
                h = np.sort(shingles(part, k)[0])
                new = np.flatnonzero(np.r_[True, h[1:] != h[:-1]]) if len(h) else np.zeros(0, np.int64)
                count = np.diff(np.r_[new, len(h)])
                often = count >= max(4, 2 * COMMON * len(part))
                yield pa.RecordBatch.from_arrays([pa.array(h[new[often]].astype(np.int64)), pa.array(count[often].astype(np.int64))], ["h", "n"])
        trim()

    found = docs.select("text").mapInArrow(run, "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n")).filter(F.col("n") >= max(8, COMMON * n_docs))
    return np.sort(np.array([r["h"] for r in found.select("h").collect()], np.int64).astype(U))


def sets(docs: DataFrame, k: int, num: int, den: int, common: np.ndarray) -> DataFrame:
    """(at, n, sig_a, sig_b, vec, prefix) of each row (at, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(common)  # bounded, see common_shingles
    large = fine_from(num, den)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = shared.value
        for batch in batches:
            for start in range(0, batch.num_rows, LOOK):
                part = batch.slice(start, LOOK)
                h, owner = shingles(part.column(1).to_pylist(), k)
                order = np.lexsort((h, owner))
                h, owner = h[order], owner[order]
                keep = np.r_[True, (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])] if len(h) else np.zeros(0, bool)
                h, owner = h[keep], owner[keep]
                n = np.bincount(owner, minlength=part.num_rows)
                first = np.cumsum(n) - n
                vec = np.bincount(owner * FINE + (h >> U(64 - FINE.bit_length() + 1)).astype(np.int64), minlength=part.num_rows * FINE).reshape(-1, FINE)
                some = n > 0
                sig = [np.zeros(part.num_rows, U) for _ in range(2)]
                if len(h):
                    for s, c in zip(sig, (1, 0x2545F4914F6CDD1D)):
                        s[some] = np.add.reduceat(mixed(h ^ U(c)), first[some])
                    last = np.zeros(len(h), bool)
                    if len(often):
                        spot = np.minimum(np.searchsorted(often, h), len(often) - 1)
                        last = often[spot] == h
                    order = np.lexsort((h, last, owner))
                    place = np.arange(len(h)) - first[owner]
                    h = h[order][place < (n - -(-num * n // den) + 1)[owner]]
                ends = np.cumsum(np.where(some, n - -(-num * n // den) + 1, 0))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n, pa.int64()), pa.array(sig[0].astype(np.int64)), pa.array(sig[1].astype(np.int64)), pa.array(_packed(vec, n, large), pa.binary()),
                     pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), pa.array(h.astype(np.int64)))],
                    ["at", "n", "sig_a", "sig_b", "vec", "prefix"],
                )
        trim()

    return docs.select("at", "text").mapInArrow(run, "at bigint, n bigint, sig_a bigint, sig_b bigint, vec binary, prefix array<bigint>")


def in_parts(df: DataFrame, key: str, order: list[str], block: int, least: int = 1) -> DataFrame:
    """df with `part`, `i` and `j`: rows of one key in parts of `block` rows by order; each row is given to every pair (i, j) of parts with its own. Keys with fewer rows than `least` go."""
    w = f"partition by `{key}`"
    numbered = df.withColumn("part", F.expr(f"(row_number() over ({w} order by {', '.join(order)}) - 1) div {block}")).withColumn("rows_", F.expr(f"count(*) over ({w})")).filter(F.col("rows_") >= least)
    other = numbered.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(rows_ - 1) div {block}"))))
    return other.withColumn("i", F.least("part", "other")).withColumn("j", F.greatest("part", "other")).drop("rows_", "other")


def in_hashed_parts(df: DataFrame, key: str, spread: str, block: int) -> DataFrame:
    """in_parts() without an order: rows of one key in parts of about `block` rows by the hash of `spread`, so no task has a whole key's rows."""
    n = df.groupBy(key).agg(F.count(F.lit(1)).alias("rows_"))
    numbered = salted_join(df, n, key, spread).withColumn("parts_", F.expr(f"(rows_ + {block - 1}) div {block}"))
    numbered = numbered.withColumn("part", F.when(F.col("parts_") == 1, F.lit(0).cast("bigint")).otherwise(F.pmod(F.xxhash64(spread, F.lit(11)), F.col("parts_"))))
    other = numbered.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts_") - 1)))
    return other.withColumn("i", F.least("part", "other")).withColumn("j", F.greatest("part", "other")).drop("rows_", "parts_", "other")


def fine_from(num: int, den: int) -> int:
    """Size from which sets have FINE groups: up to it, unrelated sets of that size differ over GROUPS groups by 1.5 times what similar ones may.

    Counts of a group differ by 1.128 times the root of their mean for unrelated sets; similar sets differ in all by
    2 (1 - t) / (1 + t) of their size.
    """
    t = num / den
    return int(GROUPS * (1.128 / (1.5 * 2 * (1 - t) / (1 + t))) ** 2) if t < 1 else 1 << 62


def _packed(fine: np.ndarray, n: np.ndarray, large: int) -> list[bytes]:
    """Counts of each set in its number of groups, as bytes, or as four bytes each where one needs more."""
    coarse = fine.reshape(-1, GROUPS, FINE // GROUPS).sum(axis=2)
    rows = [f if k >= large else c for f, c, k in zip(fine, coarse, n)]
    return [r.astype("u1" if r.max() < 256 else "<u4").tobytes() for r in rows]


class _Points:
    """Count vectors in GROUPS groups, and in FINE ones for the sets that have them."""

    def __init__(self, vecs: list[bytes]) -> None:
        kinds = {GROUPS: "u1", 4 * GROUPS: "<u4", FINE: "u1", 4 * FINE: "<u4"}
        rows = [np.frombuffer(v, kinds[len(v)]) for v in vecs]
        large = np.array([len(r) == FINE for r in rows], bool)
        self.fine = np.array([r for r in rows if len(r) == FINE], np.int32).reshape(-1, FINE)
        self.place = np.where(large, np.cumsum(large) - 1, -1)
        self.coarse = np.empty((len(rows), GROUPS), np.int32)
        self.coarse[large] = self.fine.reshape(-1, GROUPS, FINE // GROUPS).sum(axis=2)
        self.coarse[~large] = np.array([r for r in rows if len(r) == GROUPS], np.int32).reshape(-1, GROUPS)

    def fits(self, a: np.ndarray, b: np.ndarray, needed: np.ndarray) -> np.ndarray:
        """Of pairs of rows that pass in GROUPS groups, those that do in FINE ones too, where both sets have them."""
        pa_, pb = self.place[a], self.place[b]
        out = np.ones(len(a), bool)
        both = np.flatnonzero((pa_ >= 0) & (pb >= 0))
        for i in range(0, len(both), 2048):
            k = both[i : i + 2048]
            out[k] = np.minimum(self.fine[pa_[k]], self.fine[pb[k]]).sum(axis=1) >= needed[k]
        return out


def _edge_table(pairs: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    a = np.concatenate([p[0] for p in pairs]) if pairs else np.zeros(0, np.int64)
    b = np.concatenate([p[1] for p in pairs]) if pairs else np.zeros(0, np.int64)
    both = np.unique(np.c_[np.minimum(a, b), np.maximum(a, b)], axis=0) if len(a) else np.zeros((0, 2), np.int64)
    return pa.RecordBatch.from_arrays([pa.array(both[:, 0], pa.int64()), pa.array(both[:, 1], pa.int64())], ["a", "b"])


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[dict[str, np.ndarray | list]]:
    """Stretches of rows in which no key is cut in two, from rows in order of keys; small keys come many at a time."""
    held: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        if held.num_rows < 4096:
            continue
        columns = [held.column(k).to_numpy() for k in keys]
        changes = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0))
        if len(changes):
            yield held.slice(0, changes[-1] + 1)
            held = held.slice(changes[-1] + 1).combine_chunks()
    if held is not None and held.num_rows:
        yield held


def candidates(postings: DataFrame, points: DataFrame, num: int, den: int) -> DataFrame:
    """Edges (a, b) that connect, in each block (h) of postings (h, at, n), the points (at, vec) that may be similar enough."""
    # a member whose neighbours in order of size are too small and too large has none to be compared with
    w = W.partitionBy("h").orderBy("n", "at")
    n = F.col("n").cast("bigint")
    met = postings.withColumn("smaller", F.lag(n).over(w)).withColumn("larger", F.lead(n).over(w)).filter((F.col("smaller") * den >= n * num) | (n * den >= F.col("larger") * num)).select("h", "at", "n")
    rows = in_parts(met, "h", ["n", "at"], BLOCK, least=2).join(points, "at").select("h", "i", "j", "part", "at", "n", "vec").repartition("h", "i", "j").sortWithinPartitions("h", "i", "j", "n", "at")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches, ["h", "i", "j"]):
            at, n, part = (table.column(c).to_numpy().astype(np.int64) for c in ("at", "n", "part"))
            points = _Points(table.column("vec").to_pylist())
            vec = points.coarse
            ids = np.cumsum(np.r_[0, np.any([np.diff(table.column(c).to_numpy()) != 0 for c in ("h", "i", "j")], axis=0)])
            size = np.bincount(ids)
            found = []
            small = size[ids] <= 8
            for lag in range(1, 8):  # all pairs of small blocks, many blocks at once
                l = np.flatnonzero((ids[lag:] == ids[:-lag]) & small[lag:])
                r = l + lag
                ok = n[r] * num <= n[l] * den
                l, r = l[ok], r[ok]
                needed = overlap_needed(n[l], n[r], num, den)
                ok = np.minimum(vec[l], vec[r]).sum(axis=1) >= needed
                l, r, needed = l[ok], r[ok], needed[ok]
                ok = points.fits(l, r, needed)
                found.append((at[l[ok]], at[r[ok]]))
            start = np.cumsum(size) - size
            for b in np.flatnonzero(size > 8):
                s = slice(start[b], start[b] + size[b])
                tree = CountVectorRTree(vec[s], n[s])
                p, q, m, base = vec[s], part[s], n[s], start[b]
                crossing = q.min() != q.max()

                def ask(i: int, unseen: np.ndarray) -> np.ndarray:
                    near = tree.near(p[i], int(m[i]), num, den, unseen & (q != q[i]) if crossing else unseen)
                    return near[points.fits(np.full(len(near), base + i), base + near, overlap_needed(m[near], m[i], num, den))]

                e = np.array(list(spanning(size[b], ask)), np.int64).reshape(-1, 2)
                found.append((at[s][e[:, 0]], at[s][e[:, 1]]))
            yield _edge_table(found)
        trim()

    return rows.mapInArrow(run, "a bigint, b bigint").distinct()


def verified(grouped: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """Edges (a, b) that connect the rows (component, at, n, text) of each component whose sets are similar enough."""
    rows = in_hashed_parts(grouped, "component", "at", BLOCK).select("component", "i", "j", "part", "at", "text")

    def run(key: tuple, table: pa.Table) -> pa.Table:
        at, part = table.column("at").to_numpy(), table.column("part").to_numpy()
        h, owner = shingles(table.column("text").to_pylist(), k)
        _, h = np.unique(h, return_inverse=True)
        flat = np.unique(owner * (h.max() + 1 if len(h) else 1) + h)
        owner, h = np.divmod(flat, h.max() + 1 if len(h) else 1)
        n = np.bincount(owner, minlength=len(at))
        first = np.cumsum(n) - n
        trim()
        mark = np.zeros(h.max() + 1 if len(h) else 1, bool)
        crossing = part.min() != part.max()

        def ask(i: int, unseen: np.ndarray) -> np.ndarray:
            others = np.flatnonzero((unseen & (part != part[i]) if crossing else unseen) & (n * num <= n[i] * den) & (n * den >= n[i] * num))
            if not len(others):
                return others
            own = h[first[i] : first[i] + n[i]]
            mark[own] = True
            where = np.repeat(first[others] - np.r_[0, np.cumsum(n[others])[:-1]], n[others]) + np.arange(n[others].sum())
            overlap = np.add.reduceat(mark[h[where]].astype(np.int64), np.cumsum(n[others]) - n[others])
            mark[own] = False
            return others[den * overlap >= num * (n[others] + n[i] - overlap)]

        e = np.array(list(spanning(len(at), ask)), np.int64).reshape(-1, 2)
        return pa.Table.from_batches([_edge_table([(at[e[:, 0]], at[e[:, 1]])])])

    # as many tasks as set, whatever their bytes: comparing costs more than reading
    tasks = int(grouped.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(tasks, "component", "i", "j").groupBy("component", "i", "j").applyInArrow(run, "a bigint, b bigint").distinct()


def row_key(doc_id: Column, text: Column) -> Column:
    """A long that stands for a row; rows of equal id and text have the same."""
    return F.xxhash64(doc_id, text.cast("string"))


def _classes(docs: DataFrame, k: int, num: int, den: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(id, at, n, component_id, kept_at) of each row, kept_at the key of the row that stays of its group, null without shingles; and the keys (at) of rows that repeat."""
    tune(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).withColumn("at", row_key(F.col("id"), F.col("text")))
    n_docs = rows.count()
    made = written(sets(rows, k, num, den, common_shingles(rows, k, n_docs)), "jaccard-sets")
    ids = written(rows.select("id", "at"), "jaccard-ids")
    # `at` stands for a row; one row stands for all with its set
    every = ids.join(made.select("at", "n", "sig_a", "sig_b").dropDuplicates(["at"]), "at")
    lowest = every.filter("n > 0").groupBy("n", "sig_a", "sig_b").agg(F.min("id").alias("low"), F.min_by("at", F.coalesce(F.col("id").cast("bigint"), F.lit((1 << 63) - 1))).alias("rep"))
    lowest = written(lowest, "jaccard-representatives")
    copies = every.join(lowest, ["n", "sig_a", "sig_b"]).filter("at <> rep").select("at")
    repeated = ids.groupBy("at").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("at")
    copies, repeated = written(copies, "jaccard-copies"), written(repeated, "jaccard-repeated")
    of = lambda *columns: without(made.filter("n > 0").select("at", *columns), copies, ["at"], checked=repeated)
    postings = of("n", "prefix").select(F.explode("prefix").alias("h"), "at", F.col("n").cast("int").alias("n"))
    maybe = written(components(candidates(postings, of("vec"), num, den)).withColumnRenamed("node", "at"), "jaccard-groups")
    texts = likely(rows.select("at", "text"), maybe, ["at"]).join(maybe, "at").join(of("n"), "at").dropDuplicates(["at"])
    linked = components(verified(texts, k, num, den))
    linked = linked.select(F.col("node").alias("rep"), F.col("component"))
    labelled = lowest.join(linked, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    least = labelled.groupBy("component").agg(F.min("low").alias("component_id"), F.min_by("rep", F.struct(F.col("low").isNull(), "low", "rep")).alias("kept_at"))
    named = written(salted_join(labelled, least, "component", "rep").select("n", "sig_a", "sig_b", "component_id", "kept_at"), "jaccard-named")
    return every.join(named, ["n", "sig_a", "sig_b"], "left").select("id", "at", "n", F.coalesce("component_id", F.col("id")).alias("component_id"), "kept_at"), repeated


def jaccard_classes(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_shingles, component_id) of each row: sets of k-word shingles, linked when den * intersection >= num * union; component_id is the smallest id reachable by links.

    Words are runs of characters other than ASCII white space, A-Z taken as a-z. A text of fewer than k words is one
    shingle; a null, empty or blank one has none and is linked with nothing, its component_id its own id. Rows without
    id count as larger than any other; repeated rows are linked like copies. An empty table gives no rows; other
    columns are dropped. Links rest on 64-bit hashes of words.
    """
    found, _ = _classes(docs, k, num, den, id_col, text_col)
    return found.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")


def jaccard_copies(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Keys (`at`, see row_key) of the rows that do not stay, one row staying of each group that jaccard_classes links: that with the smallest id; and the keys of rows that repeat whole.

    Rows without id stay only where their group has no id; of several rows with the smallest id one stays.
    """
    found, repeated = _classes(docs, k, num, den, id_col, text_col)
    return found.filter("at <> kept_at").select("at"), repeated
