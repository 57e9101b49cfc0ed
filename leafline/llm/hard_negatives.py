"""Hard negatives by largest inner product, over a pivot table.

Vectors are augmented by one coordinate, sqrt(top - |x|^2), where top is the largest squared length; a query gets 0
there. Then |q - x|^2 = |q|^2 + top - 2 q.x, so the largest inner products are the smallest distances. The distances of
every row to a few pivots are stored; by the triangle inequality they bracket a row's distance to a query and so its
score. Rows whose bracket can't reach what is wanted are passed over, all others are checked exactly.

Rows lie in blocks by their nearest pivot and the distance to it. A block has the range of its distances to each pivot,
so whole blocks are passed over in the same way. A query is first answered within its own block, which sets the least
score that another block must be able to reach.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leafline.llm.storage import tune, written

#: Rows of a block; queries handled together; blocks whose ranges are looked through together; queries of one task's group.
BLOCK, PACK, RANGES, GROUP = 2048, 256, 1024, 8192
#: Rows that pivots are chosen from: those with the least hashes of their id.
SAMPLE = 2048
#: Below this squared length products of whole numbers are exact in doubles.
EXACT = float(1 << 53)
NONE = 1 << 62

ROWS = pa.schema([("at", pa.int64()), ("id", pa.int64()), ("label", pa.int64()), ("vec", pa.list_(pa.int64())), ("far", pa.list_(pa.float64()))])
WANTS = "array<struct<nth: int, low: bigint, high: bigint>>"
ASKED = f"at bigint, home bigint, id bigint, label bigint, vec array<bigint>, wants {WANTS}"
FOUND = "at bigint, nth int, score bigint, other_at bigint, other_id bigint"


def _bytes(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="lz4")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _table(raw: bytes) -> pa.Table:
    return pa.ipc.open_stream(raw).read_all()


def _matrix(col: pa.ChunkedArray | pa.Array, width: int, kind: type = np.float64) -> np.ndarray:
    flat = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    return flat.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(flat), width)


def _one(table: pa.Table) -> pa.RecordBatch:
    return table.combine_chunks().to_batches()[0]


@dataclasses.dataclass(frozen=True)
class PivotTable:
    """The pivots (a bounded number), the largest squared length and the vectors' width."""

    pivots: np.ndarray
    top: float
    width: int

    def rest(self, x: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(self.top - (x * x).sum(1), 0.0))

    def _to(self, x: np.ndarray, rest: np.ndarray, own: np.ndarray) -> np.ndarray:
        apart = (x * x).sum(1)[:, None] + (rest * rest)[:, None] + (self.pivots**2).sum(1) + own * own - 2 * (x @ self.pivots.T + np.outer(rest, own))
        return np.sqrt(np.maximum(apart, 0.0))

    def distances(self, x: np.ndarray) -> np.ndarray:
        """Of rows to the pivots."""
        return self._to(x, self.rest(x), self.rest(self.pivots))

    def query_distances(self, q: np.ndarray) -> np.ndarray:
        return self._to(q, np.zeros(len(q)), self.rest(self.pivots))

    def scores(self, q: np.ndarray, near: np.ndarray, far: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest scores that distances between near and far leave room for, a little widened as doubles are rounded."""
        both, slack = ((q * q).sum(1) + self.top)[:, None], 1e-7 * self.top + 1.0
        return (both - far * far) / 2 - slack, (both - near * near) / 2 + slack

    def brackets(self, q: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest scores of queries with rows whose distances to the pivots lie between low and high."""
        own = self.query_distances(q)
        near, far = np.zeros((len(q), len(low))), np.full((len(q), len(low)), np.inf)
        for p in range(own.shape[1]):
            d = own[:, p][:, None]
            np.maximum(near, np.maximum(d - high[:, p], low[:, p] - d), out=near)
            np.minimum(far, d + high[:, p], out=far)
        return self.scores(q, near, far)


def _pivots(sample: np.ndarray, n: int, top: float, width: int) -> np.ndarray:
    """Each next pivot lies farthest from those chosen before."""
    chosen = [0]
    for _ in range(min(n, len(sample)) - 1):
        d = PivotTable(sample[chosen], top, width).distances(sample).min(1)
        if d.max() <= 0:
            break
        chosen.append(int(d.argmax()))
    return sample[chosen]


def usable(df: DataFrame, id_col: str, vec_col: str, label: Column, scale: float) -> DataFrame:
    """(id, label, vec of whole numbers) of rows with a label and a vector of finite components."""
    fine = F.forall(vec_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), label.cast("bigint").alias("label"), F.when(fine, F.col(vec_col)).alias("raw"))
    vec = F.transform("raw", lambda x: F.floor(x.cast("double") * scale))
    return rows.filter(F.col("label").isNotNull() & F.col("raw").isNotNull()).select("id", "label", vec.alias("vec"))


def build(rows: DataFrame, n_pivots: int) -> tuple[PivotTable, DataFrame] | None:
    """The pivot table of rows (id, label, vec) and its blocks (block, low, high, rows); None without rows."""
    length = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    known = rows.agg(F.max(length).alias("top"), F.max(F.size("vec")).alias("width")).first()
    if known["top"] is None:
        return None
    top, width = float(known["top"]), max(1, known["width"])
    padded = F.concat("vec", F.array_repeat(F.lit(0).cast("bigint"), F.lit(width) - F.size("vec")))
    rows = rows.select("id", "label", padded.alias("vec"))
    sample = rows.orderBy(F.xxhash64("id"), "id", "vec").limit(SAMPLE).select("vec").collect()
    table = PivotTable(_pivots(np.array([r["vec"] for r in sample], np.float64), n_pivots, top, width), top, width)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                d = table.distances(_matrix(b["vec"], width))
                far = pa.ListArray.from_arrays(pa.array(np.arange(0, d.size + 1, d.shape[1], dtype=np.int32)), pa.array(d.ravel()))
                yield pa.RecordBatch.from_arrays([b["id"], b["label"], b["vec"], far, pa.array(d.argmin(1).astype(np.int32)), pa.array(d.min(1))], ["id", "label", "vec", "far", "cell", "near"])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, nth, held = TaskContext.get().partitionId() << 33, 0, None

        def block(t: pa.Table) -> pa.RecordBatch:
            at = pa.array((first + nth) * BLOCK + np.arange(t.num_rows))
            own = _one(pa.table([at, t["id"], t["label"], t["vec"], t["far"]], schema=ROWS))
            d = _matrix(own["far"], len(table.pivots))
            return pa.RecordBatch.from_arrays([pa.array([first + nth]), pa.array([d.min(0).tolist()]), pa.array([d.max(0).tolist()]), pa.array([_bytes(own)])], ["block", "low", "high", "rows"])

        for b in batches:
            t = pa.Table.from_batches([b])
            held = t if held is None else pa.concat_tables([held, t])
            while held.num_rows >= BLOCK:
                yield block(held.slice(0, BLOCK))
                held, nth = held.slice(BLOCK), nth + 1
        if held is not None and held.num_rows:
            yield block(held)

    tune(rows.sparkSession)
    far = rows.mapInArrow(measured, "id bigint, label bigint, vec array<bigint>, far array<double>, cell int, near double")
    order = ["cell", "near", "id", "label"]
    sorted_rows = far.repartitionByRange(*order).sortWithinPartitions(*order)
    blocks = sorted_rows.mapInArrow(packed, "block bigint, low array<double>, high array<double>, rows binary")
    return table, written(blocks, "pivot-blocks")


def _members(blocks: DataFrame, every: int) -> DataFrame:
    """Rows of the blocks whose id is divisible by `every`, as queries without wants."""

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for home, raw in zip(b["block"].to_pylist(), b["rows"]):
                t = _table(raw.as_buffer())
                ids = t["id"].to_numpy(zero_copy_only=False)
                t = t.filter(pa.array((ids % every == 0) & ~np.isnan(ids.astype(float))))
                if t.num_rows:
                    yield _one(pa.table([t["at"], pa.array(np.full(t.num_rows, home)), t["id"], t["label"], t["vec"]], ["at", "home", "id", "label", "vec"]))

    return blocks.select("block", "rows").mapInArrow(chosen, "at bigint, home bigint, id bigint, label bigint, vec array<bigint>")


def _wants(asked: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Flat: which query, its want's number, least and largest score."""
    col = asked["wants"].combine_chunks()
    n = np.diff(col.offsets.to_numpy())
    flat = col.flatten()
    return np.repeat(np.arange(len(col)), n), *(flat.field(f).to_numpy(zero_copy_only=False) for f in ("nth", "low", "high"))


def _answered(table: PivotTable, asked: pa.Table, rows: pa.Table, k: int, same: bool) -> pa.Table:
    """The k best rows of a block for each want of each query: highest scores, then smallest ids (null last), then place."""
    q, x = _matrix(asked["vec"], table.width), _matrix(rows["vec"], table.width)
    far = _matrix(rows["far"], len(table.pivots))
    least, most = table.brackets(q, far, far)
    like = asked["label"].to_numpy()[:, None] == rows["label"].to_numpy()[None, :]
    open_ = (like if same else ~like) & (asked["at"].to_numpy()[:, None] != rows["at"].to_numpy()[None, :])
    who, nth, low, high = _wants(asked)
    alive = open_[who] & (most[who] >= low[:, None]) & (least[who] <= high[:, None])
    w, j = np.nonzero(alive)
    out = {f: [] for f in ("at", "nth", "score", "other_at", "other_id")}
    if len(w):
        if table.top < EXACT:
            cols = np.unique(j)
            score = np.rint(q @ x[cols].T).astype(np.int64)[who[w], np.searchsorted(cols, j)]
        else:  # too long for doubles: whole numbers of any size
            qi, xi = (_matrix(t["vec"], table.width, np.int64).astype(object) for t in (asked, rows))
            score = np.array([min(max(int(qi[who[a]] @ xi[b]), -NONE), NONE) for a, b in zip(w, j)], np.int64)
        fits = (score >= low[w]) & (score <= high[w])
        w, j, score = w[fits], j[fits], score[fits]
        ids = rows["id"].combine_chunks()
        no_id, number = np.asarray(ids.is_null()), ids.fill_null(0).to_numpy()
        at = rows["at"].to_numpy()
        order = np.lexsort((at[j], number[j], no_id[j], -score, w))
        w, j, score = w[order], j[order], score[order]
        begins = np.flatnonzero(np.r_[True, w[1:] != w[:-1]]) if len(w) else np.zeros(0, int)
        first = np.arange(len(w)) - np.repeat(begins, np.diff(np.r_[begins, len(w)])) < k
        w, j, score = w[first], j[first], score[first]
        out = {"at": asked["at"].to_numpy()[who[w]], "nth": nth[w], "score": score, "other_at": at[j], "other_id": ids.take(pa.array(j))}
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
    return pa.table([v if isinstance(v, pa.Array) else pa.array(v, t) for v, t in zip(out.values(), kinds)], names=list(out))


def _visited(table: PivotTable, blocks: DataFrame, visits: DataFrame, k: int, same: bool) -> DataFrame:
    """Answers of the visits (block, salt, asked: packed queries), each block going to the groups of queries that visit it."""

    def group(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = _table(right["rows"][0].as_buffer()) if right.num_rows else None
        parts = [_answered(table, _table(raw.as_buffer()), rows, k, same) for raw in left["asked"]] if rows is not None else []
        return pa.concat_tables(parts) if parts else pa.table([pa.array([], t) for t in (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())], names=["at", "nth", "score", "other_at", "other_id"])

    visits = written(visits, "pivot-visits")
    to = visits.select(F.col("block").alias("to_block"), F.col("salt").alias("to_salt")).distinct()
    gone_to = blocks.select(F.col("block").alias("to_block"), "rows").join(to, "to_block")
    return visits.groupBy("block", "salt").cogroup(gone_to.groupBy("to_block", "to_salt")).applyInArrow(group, FOUND)


def _packed(asked: DataFrame) -> DataFrame:
    """(home, pack) of neighbouring queries, all of one home."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            home = b["home"].to_numpy()
            ends = [0, *(np.flatnonzero(home[1:] != home[:-1]) + 1), len(home)] if len(home) else [0]
            for i, j in zip(ends, ends[1:]):
                for a in range(i, j, PACK):
                    yield pa.RecordBatch.from_arrays([pa.array([home[a]]), pa.array([_bytes(_one(pa.Table.from_batches([b.slice(a, min(PACK, j - a))])))])], ["home", "asked"])

    return asked.mapInArrow(pack, "home bigint, asked binary")


def _others(table: PivotTable, blocks: DataFrame, asked: DataFrame, n_asked: int) -> DataFrame:
    """Visits (block, salt, asked) of queries to blocks other than their own whose brackets reach what they want.

    Queries and the blocks' ranges meet pack by pack: this is the stated query set against all blocks.
    """
    salts = n_asked // GROUP + 1
    places = blocks.select("block", "low", "high")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, nth = TaskContext.get().partitionId() << 33, 0
        for b in batches:
            for a in range(0, b.num_rows, RANGES):
                yield pa.RecordBatch.from_arrays([pa.array([first + nth]), pa.array([_bytes(_one(pa.Table.from_batches([b.slice(a, RANGES)])))])], ["part", "ranges"])
                nth += 1

    parts = written(places.mapInArrow(pack, "part bigint, ranges binary"), "pivot-ranges")
    numbers = [r["part"] for r in parts.select("part").collect()]  # one for RANGES blocks
    all_parts = F.explode(F.split(F.lit(",".join(map(str, numbers))), ",").cast("array<bigint>"))
    left = _packed(asked).withColumn("salt", F.pmod(F.xxhash64("asked"), F.lit(salts))).withColumn("part", all_parts)
    right = parts.select(F.col("part").alias("to_part"), "ranges", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))).alias("to_salt"))

    def group(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple[int, bytes]] = []
        for raw in right["ranges"]:
            r = _table(raw.as_buffer())
            low, high, block = _matrix(r["low"], len(table.pivots)), _matrix(r["high"], len(table.pivots)), r["block"].to_numpy()
            for packed in left["asked"]:
                t = _table(packed.as_buffer())
                least, most = table.brackets(_matrix(t["vec"], table.width), low, high)
                who, _, lowest, highest = _wants(t)
                reach = np.zeros(least.shape, bool)
                np.logical_or.at(reach, who, (most[who] >= lowest[:, None]) & (least[who] <= highest[:, None]))
                reach &= t["home"].to_numpy()[:, None] != block
                out += [(int(block[b]), _bytes(_one(t.filter(pa.array(reach[:, b]))))) for b in np.flatnonzero(reach.any(0))]
        salt = key[1].as_py() if hasattr(key[1], "as_py") else key[1]
        return pa.table([pa.array([b for b, _ in out], pa.int64()), pa.array([salt] * len(out), pa.int64()), pa.array([x for _, x in out], pa.binary())], names=["block", "salt", "asked"])

    return left.groupBy("part", "salt").cogroup(right.groupBy("to_part", "to_salt")).applyInArrow(group, "block bigint, salt bigint, asked binary")


def _best(found: DataFrame, k: int) -> DataFrame:
    place = F.row_number().over(W.partitionBy("at", "nth").orderBy(F.desc("score"), F.asc_nulls_last("other_id"), "other_at"))
    return found.withColumn("rank", place).filter(F.col("rank") <= k)


def search(table: PivotTable, blocks: DataFrame, asked: DataFrame, k: int, same: bool, name: str) -> DataFrame:
    """FOUND and rank: for each want (nth, low, high) of each query the k rows of the same or of other labels with the highest scores from low to high."""
    asked = written(asked, f"{name}-asked")
    n_asked = asked.count()
    at_home = _packed(asked.repartition("home").sortWithinPartitions("home")).select(F.col("home").alias("block"), F.lit(0).cast("bigint").alias("salt"), "asked")
    home = written(_visited(table, blocks, at_home, k, same), f"{name}-home")
    kth = home.groupBy("at", "nth").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least")).filter(F.col("n") >= k)
    reached = kth.groupBy("at").agg(F.map_from_entries(F.collect_list(F.struct("nth", "least"))).alias("least"))  # a line per want of one query
    raised = F.transform("wants", lambda w: F.struct(w["nth"].alias("nth"), F.greatest(w["low"], F.get(F.transform(F.array(w["nth"]), lambda n: F.try_element_at("least", n)), F.lit(0))).alias("low"), w["high"].alias("high")))
    again = asked.join(reached, "at", "left").withColumn("wants", raised).select(*asked.columns)
    others = _visited(table, blocks, _others(table, blocks, again, n_asked), k, same)
    return _best(home.unionByName(others), k)


def mine(
    df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label: Column | None = None, scale: float = 256.0,
    every: int = 50, n_positives: int = 5, n_negatives: int = 3, margin: tuple[int, int] = (50, 95), n_pivots: int = 16,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for every anchor and positive.

    Anchors are rows whose id is divisible by `every`; scores are inner products of floor(scale * component). An
    anchor's positives are its n_positives other rows of its label with the highest scores; a positive's negatives the
    n_negatives rows of other labels with the highest scores among those from margin[0] to margin[1] hundredths of the
    positive's. Ties go to the smaller id, null last, then to the row that lies first.

    Rows without a label or vector or with a null or non-finite component take no part. A null id is no anchor but may
    be found. Repeated rows are rows of their own, so one can be the other's positive. A shorter vector counts as
    followed by zeros, an empty one is all zeros. Scores have to lie within 62 bits. Anchors
    without positives, and positives without negatives, give no rows, and so does an empty table. Other columns are dropped.
    The result is exact; pivots come from at most SAMPLE rows and only say how much is passed over.
    """
    built = build(usable(df, id_col, vec_col, F.col("label") if label is None else label, scale), n_pivots)
    out = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    if built is None:
        return df.sparkSession.createDataFrame([], out)
    table, blocks = built
    anchors = written(_members(blocks, every), "pivot-anchors")
    any_score = F.array(F.struct(F.lit(0).alias("nth"), F.lit(-NONE).alias("low"), F.lit(NONE).alias("high"))).cast(WANTS)
    positives = written(search(table, blocks, anchors.withColumn("wants", any_score), n_positives, True, "positives"), "positives")
    exact = F.col("score").cast("decimal(20,0)")  # hundredths of whole numbers, without doubles
    low, high = F.ceil(exact * F.lit(margin[0]) / F.lit(100)), F.floor(exact * F.lit(margin[1]) / F.lit(100))
    windows = positives.select("at", F.struct(F.col("rank").cast("int").alias("nth"), low.cast("bigint").alias("low"), high.cast("bigint").alias("high")).alias("want")).filter("want.low <= want.high")
    asked = anchors.join(windows.groupBy("at").agg(F.collect_list("want").cast(WANTS).alias("wants")), "at").select(*anchors.columns, "wants")  # n_positives wants at most
    negatives = search(table, blocks, asked, n_negatives, False, "negatives")
    of = positives.select("at", F.col("rank").cast("int").alias("nth"), F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score"))
    met = negatives.select("at", "nth", F.col("rank").cast("int").alias("rank"), F.col("other_id").alias("negative_id"), F.col("score").alias("negative_score")).join(of, ["at", "nth"])
    return met.join(anchors.select("at", F.col("id").alias("anchor_id")), "at").select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
