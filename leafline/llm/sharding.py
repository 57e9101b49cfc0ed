"""Shards by sampled splitters.

Groups of equal texts are ordered by the hash of the text. A size-weighted sample of these keys gives quantile
boundaries; groups are dealt into the ranges between them; ranges found overfull are cut again at further sample points.
Running sums of size over the ranges, then within each range, place every group whole.
"""

from __future__ import annotations

import heapq
import itertools
import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leafline.llm.storage import written

#: Expected number of sampled keys for each range; the sample has at most that many times `ranges` rows and a few, whatever the input's size.
PER_RANGE = 16
#: A group of more than 1/LARGE of a shard's share is placed on its own.
LARGE = 256
#: Pieces of a shard's size that a group larger than a shard is cut into; rows of a large group that are numbered together.
PIECES = 16
PIECE_ROWS = 500_000


def _cut(points: list[tuple[int, int]], n: int) -> list[tuple[int, int]]:
    return sorted({points[len(points) * i // n] for i in range(1, n)}) if points else []


def _range_of(cuts: list[tuple[int, int]]) -> Column:
    """How many boundaries are at or below a row's (key, tie), by halving: as many looks as the number of boundaries has digits in base two."""
    if not cuts:
        return F.lit(0)
    bounds = F.from_json(F.lit(json.dumps([{"key": a, "tie": b} for a, b in cuts])), "array<struct<key: bigint, tie: bigint>>")
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(cuts).bit_length()))])
    own = F.struct("key", "tie")
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(bounds, at + step - 1) <= own, at + step).otherwise(at))


def _greedy(big: list[tuple], n_shards: int) -> dict[int, list]:
    """Large units (weight, name), largest first, each to the lightest shard."""
    heap = [(0, s) for s in range(n_shards)]
    out: dict[int, list] = {s: [] for s in range(n_shards)}
    for w, at in sorted(big, key=lambda x: (-x[0], x[1])):
        load, s = heapq.heappop(heap)
        out[s].append(at)
        heapq.heappush(heap, (load + w, s))
    return out


def shard(docs: DataFrame, n_shards: int = 16, law: str = "bytes", ranges: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, size, text_crc32, law, shard, slot) of each row.

    law `bytes`: shards' summed sizes (UTF-8 bytes plus 1) are near equal and equal texts lie in one shard, unless they
    outweigh a shard: only such a group is cut, into PIECES pieces for each shard that it would fill. law `rows`: counts
    differ by one at most, so each row is dealt by itself and a boundary can part equal texts.
    What is dealt (a group or a row) and weighs more than 1/LARGE of a shard is one of LARGE * n_shards at most; these go
    one by one to the lightest shard. All others are range-partitioned, each shard taking what it has room for, so its
    weight is within 1/LARGE of its share unless one that can't be cut weighs more. A null text has size 1 and the
    checksum of no bytes. Null and repeated ids and repeated rows are rows like others. An empty table gives no rows.
    ranges: 256, and one for each half a million rows, 8192 at most. Shuffles carry keys and sizes only; the driver gets
    the sample, the large groups' pieces of PIECE_ROWS rows, and a line per range.
    """
    if law not in ("bytes", "rows"):
        raise ValueError(f"unknown law {law!r}")
    spark, text, whole = docs.sparkSession, F.col(text_col).cast("string"), law == "bytes"
    size = (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint")
    rows = docs.select(
        F.col(id_col).alias("id"), size.alias("size"), F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64(F.coalesce(text, F.lit(""))).alias("key"), F.xxhash64(F.col(id_col), F.lit(1)).alias("own"), F.monotonically_increasing_id().alias("at"),
    )
    none = F.lit(0).cast("bigint")
    group, order = ["key", "tie", "nth"], ["own", "id", "at"]
    rows = rows.withColumn("tie", none if whole else F.col("own")).withColumn("nth", none if whole else F.col("at"))
    rows = written(rows.withColumn("weight", F.col("size") if whole else F.lit(1).cast("bigint")), "shard-rows")
    groups = written(rows.groupBy(*group).agg(F.sum("weight").alias("w"), F.count(F.lit(1)).alias("n")), "shard-groups")
    summed = groups.agg(F.sum("w").alias("w"), F.sum("n").alias("n")).first()
    total = summed["w"] or 0
    ranges = ranges or max(256, min(8192, (summed["n"] or 0) // 500_000))
    is_big = F.col("w") * n_shards * LARGE > total
    over = F.when((F.col("w") * n_shards > total) & (F.col("n") > 1), F.ceil(F.col("w") * (n_shards * PIECES) / F.lit(max(total, 1)))).otherwise(1)
    big = groups.filter(is_big).select(*group, (over > 1).alias("cut"), F.greatest(over, F.ceil(F.col("n") / PIECE_ROWS)).cast("bigint").alias("n_pieces"))  # at most LARGE * n_shards lines
    of_big = rows.join(F.broadcast(big), group).withColumn("piece", F.pmod(F.xxhash64("own", "at", F.lit(11)), F.col("n_pieces")))
    pieces = of_big.groupBy(*group, "cut", "piece").agg(F.sum("weight").alias("w"), F.count(F.lit(1)).alias("n")).collect()
    units: dict[tuple, list] = {}
    for r in sorted(pieces, key=lambda r: tuple(r[c] for c in (*group, "piece"))):
        units.setdefault((*(r[c] for c in group), r["piece"] if r["cut"] else -1), []).append(r)
    weight_of = {u: sum(r["w"] for r in parts) for u, parts in units.items()}
    dealt = _greedy([(w, u) for u, w in weight_of.items()], n_shards)
    room = [max(0.0, total / n_shards - sum(map(weight_of.__getitem__, dealt[s]))) for s in range(n_shards)]
    rest = total - sum(weight_of.values())
    ends = [x * rest / sum(room) if sum(room) else 0.0 for x in itertools.accumulate(room)][:-1]
    small = groups.filter(~is_big)
    chance = (F.pmod(F.xxhash64(*group, F.lit(7)), F.lit(1 << 40)) + 0.5) / float(1 << 40)
    sample = small.filter(chance * float(max(rest, 1)) < F.col("w") * float(ranges * PER_RANGE)).select("key", "tie")
    points = sorted((r["key"], r["tie"]) for r in sample.collect())
    cuts = _cut(points, ranges)
    loads = small.groupBy(_range_of(cuts).alias("range")).agg(F.sum("w").alias("w")).collect()
    first_cuts = cuts
    for r, parts in {r["range"]: -(-r["w"] * ranges // rest) for r in loads if r["w"] * ranges > 2 * rest}.items():  # overfull
        inside = [p for p in points if (r == 0 or p >= first_cuts[r - 1]) and (r == len(first_cuts) or p < first_cuts[r])]
        cuts = cuts + _cut(inside, parts)
    small = small.withColumn("range", _range_of(sorted({*cuts})))
    before = W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)  # one line per range
    starts = small.groupBy("range").agg(F.sum("w").alias("w_")).select("range", F.coalesce(F.sum("w_").over(before), F.lit(0)).alias("w0"))
    inside = W.partitionBy("range").orderBy(*group)
    begins = F.col("w0") + F.sum("w").over(inside.rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("w") / 2
    placed = small.join(F.broadcast(starts), "range").withColumn("middle", begins)  # at most a few times `ranges` lines
    placed = written(placed.select(*group, "n", "range", F.size(F.filter(F.lit(ends), lambda e: e <= F.col("middle"))).alias("shard")), "shard-placed")
    lines = placed.groupBy("shard", "range").agg(F.sum("n").alias("n")).collect()  # at most one more a shard than there are ranges
    held, firsts = dict.fromkeys(range(n_shards), 0), []
    for r in sorted(lines, key=lambda r: (r["shard"], r["range"])):
        firsts.append((r["shard"], r["range"], held[r["shard"]]))
        held[r["shard"]] += r["n"]
    earlier = W.partitionBy("shard", "range").orderBy(*group).rowsBetween(W.unboundedPreceding, W.currentRow)
    at_first = F.broadcast(spark.createDataFrame(firsts, "shard int, range int, first bigint"))
    of_group = placed.withColumn("before_", F.sum("n").over(earlier) - F.col("n")).join(at_first, ["shard", "range"]).select(*group, "shard", (F.col("first") + F.col("before_")).alias("base"))
    slots = []
    for s, own in dealt.items():
        for r in (r for u in own for r in units[u]):
            slots.append((*(r[c] for c in group), r["piece"], s, held[s]))
            held[s] += r["n"]
    bases = F.broadcast(spark.createDataFrame(slots, "key bigint, tie bigint, nth bigint, piece bigint, shard int, base bigint"))  # a line for each collected piece
    shown = lambda df, keys: df.select("id", "size", "text_crc32", "shard", (F.col("base") + F.row_number().over(W.partitionBy(*keys).orderBy(*order)) - 1).cast("bigint").alias("slot"))
    out = shown(rows.join(of_group, group), group).unionByName(shown(of_big.join(bases, [*group, "piece"]), [*group, "piece"]))
    return out.select(F.col("id").alias(id_col), "size", "text_crc32", F.lit(law).alias("law"), "shard", "slot")
