"""Keyed, anti, spatial and nearest joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leafline.functions import boxes


def lookup(left: DataFrame, right: DataFrame, keys: list[str], error: str) -> DataFrame:
    """Left join with `error` set (to that code) on rows without partner; Spark broadcasts the right side where its size allows."""
    met = left.join(right.withColumn("met_", F.lit(True)), keys, "left")
    return met.withColumn("error", F.when(F.col("met_").isNull(), F.lit(error))).drop("met_")


def uncovered(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Keys on one side only, with `side` left or right."""
    a, b = left.select(*keys).distinct(), right.select(*keys).distinct()
    return a.join(b, keys, "left_anti").withColumn("side", F.lit("left")).unionByName(b.join(a, keys, "left_anti").withColumn("side", F.lit("right")))


def coverage(returned: DataFrame, expected: DataFrame, keys: list[str]) -> DataFrame:
    """One row: how many keys are missing and unexpected, and whether the sets are equal."""
    a = returned.select(*keys).distinct().withColumn("r_", F.lit(1))
    b = expected.select(*keys).distinct().withColumn("e_", F.lit(1))
    both = a.join(b, keys, "full_outer")
    return both.agg(F.count_if(F.col("r_").isNull()).alias("missing"), F.count_if(F.col("e_").isNull()).alias("unexpected")).withColumn("covered", (F.col("missing") == 0) & (F.col("unexpected") == 0))


def overlapping(left: DataFrame, right: DataFrame, keys: list[str], box: str, measure, least: float, cell: float, keep: Column | None = None) -> DataFrame:
    """Pairs of equal keys whose boxes (column `box` and `<box>_2`) have measure(a, b) over `least`, with `overlap`.

    Boxes meet in the cells of a grid of that size; a pair counts in its smallest shared cell only. `right` has its
    columns named with _2 but for the keys. So only near boxes are compared, however many lie on a page.
    """
    a = left.withColumn("cell_", F.explode(boxes.cells(F.col(box), cell)))
    b = right.withColumn("cell_", F.explode(boxes.cells(F.col(f"{box}_2"), cell)))
    met = a.join(b, [*keys, "cell_"]) if keep is None else a.join(b, [*keys, "cell_"]).filter(keep)
    at = lambda i: F.floor(F.greatest(F.get(F.col(box), F.lit(i)), F.get(F.col(f"{box}_2"), F.lit(i))) / cell)
    met = met.filter((F.col("cell_.cx") == at(0)) & (F.col("cell_.cy") == at(1)))
    return met.withColumn("overlap", measure(F.col(box), F.col(f"{box}_2"))).filter(F.col("overlap") > least).drop("cell_")


def nearest_around(rows: DataFrame, keys: list[str], order: list[str], is_slot: Column, value: str, before: str = "before", after: str = "after") -> DataFrame:
    """Slot rows with the nearest earlier and later value of other rows of the same keys."""
    other = F.when(~is_slot, F.col(value))
    w = W.partitionBy(*keys).orderBy(*order)
    out = rows.withColumn(before, F.last(other, ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, -1))).withColumn(after, F.first(other, ignorenulls=True).over(w.rowsBetween(1, W.unboundedFollowing)))
    return out.filter(is_slot)


def printed_context(slots: DataFrame, blocks: DataFrame, page: str = "page", strip: float = 40.0) -> DataFrame:
    """Each slot (slot_id, page, box) with the last 48 characters of the printed block just left of it and the first 48 of the one right of it.

    Left: ends at most 8 beyond the slot's start, the rightmost; right: starts at least 8 before its end, the
    leftmost; both centred within max(18, 0.6 of the slot's height) of the slot's centre. blocks: (page, text, block_box)
    and optionally block_ord; of blocks that end or start alike the one with the largest block_ord, without it the largest text.
    Blocks without text are passed over; a slot without page or place stays, with nothing around it.
    Both meet in strips of that height: a slot looks into those that its band touches, a block lies in that of its centre.
    Blocks are ranked within their page first, so a pair is two numbers whose maximum is kept and no pair is sorted or
    written; texts are joined back by rank.
    """
    s, b = F.col("box"), F.col("block_box")
    place = lambda y: F.floor(y / strip)
    tie = [F.asc(c) for c in ("block_ord", "text") if c in blocks.columns]
    rank = lambda at: F.row_number().over(W.partitionBy(page).orderBy(at, *tie))
    ranked = blocks.filter(F.col("text").isNotNull()).select(page, "text", boxes.center_y(b).alias("b_y"), F.get(b, F.lit(0)).alias("b_1"), F.get(b, F.lit(2)).alias("b_2"), *[c for c in ("block_ord",) if c in blocks.columns])
    ranked = ranked.withColumn("left_", rank(F.asc("b_2"))).withColumn("right_", rank(F.desc("b_1")))
    looking = slots.select("slot_id", page, boxes.center_y(s).alias("s_y"), F.get(s, F.lit(0)).alias("s_1"), F.get(s, F.lit(2)).alias("s_2"), F.greatest(F.lit(18.0), boxes.height(s) * 0.6).alias("band_"))
    looking = looking.withColumn("strip_", F.explode_outer(F.sequence(place(F.col("s_y") - F.col("band_")), place(F.col("s_y") + F.col("band_")))))
    rows = looking.join(ranked.drop("text", "block_ord").withColumn("strip_", place(F.col("b_y"))), [page, "strip_"], "left")
    same_row = F.abs(F.col("s_y") - F.col("b_y")) <= F.col("band_")
    left = F.when(same_row & (F.col("b_2") <= F.col("s_1") + 8), F.col("left_"))
    right = F.when(same_row & (F.col("b_1") >= F.col("s_2") - 8), F.col("right_"))
    best = rows.groupBy("slot_id", page).agg(F.max(left).alias("left_"), F.max(right).alias("right_"))
    before, after = ranked.select(page, "left_", F.right("text", F.lit(48)).alias("before")), ranked.select(page, "right_", F.left("text", F.lit(48)).alias("after"))
    return best.join(before, [page, "left_"], "left").join(after, [page, "right_"], "left").select("slot_id", page, "before", "after")


def first_of(base: DataFrame, others: list[DataFrame], keys: list[str], column: str) -> DataFrame:
    """base with `column` from the first of several tables that has a value for the keys."""
    names = []
    for i, other in enumerate(others):
        names.append(f"from_{i}_")
        base = base.join(other.select(*keys, F.col(column).alias(names[-1])), keys, "left")
    return base.withColumn(column, F.coalesce(*names)).drop(*names)
