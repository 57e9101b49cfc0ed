"""One-to-one assignment, alignment and clustering within one page or item."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafline.functions import boxes


def best_assignment(scores: np.ndarray) -> list[tuple[int, int]]:
    """Pairs (row, column) of largest summed score, only positive ones; rows and columns may stay free.

    Pairs grow one by one along the alternating path that gains most, found for all columns at once; no path gains any
    more after at most as many steps as the shorter side has members.
    """
    if scores.shape[0] > scores.shape[1]:
        return sorted((i, j) for j, i in best_assignment(scores.T))
    gain = np.where(scores > 0, scores, -np.inf)
    taken, holder = np.full(gain.shape[0], -1), np.full(gain.shape[1], -1)  # a row's column, a column's row
    while True:
        at_row = np.where(taken < 0, 0.0, -np.inf)  # gain of the best path that ends with the row free
        at_column, by = np.full(gain.shape[1], -np.inf), np.full(gain.shape[1], -1)
        while True:
            paths = at_row[:, None] + gain
            row = paths.argmax(axis=0)
            value = np.take_along_axis(paths, row[None], axis=0)[0]
            better = value > at_column + 1e-12
            at_column[better], by[better] = value[better], row[better]
            moved = np.flatnonzero(better & (holder >= 0))
            freed = at_column[moved] - gain[holder[moved], moved]
            worth = freed > at_row[holder[moved]] + 1e-12
            if not worth.any():
                break
            at_row[holder[moved[worth]]] = freed[worth]
        open_ = np.flatnonzero(holder < 0)
        if not len(open_) or at_column[open_].max() <= 1e-12:
            return [(i, int(j)) for i, j in enumerate(taken) if j >= 0]
        column = open_[at_column[open_].argmax()]
        while column >= 0:
            row = by[column]
            holder[column] = row
            taken[row], column = column, taken[row]


def greedy_places(score: np.ndarray, row: np.ndarray, column: np.ndarray, larger_first: bool = False) -> list[int]:
    """Numbers of the pairs taken by falling score, each row and column once; equals by smaller rows and columns, or larger ones."""
    sign = -1 if larger_first else 1
    left = np.lexsort((sign * column, sign * row, -score))
    out = []
    while len(left):
        out.append(int(left[0]))
        left = left[(row[left] != row[left[0]]) & (column[left] != column[left[0]])]
    return out


def greedy(scored: list[tuple[float, int, int]], larger_first: bool = False) -> list[tuple[int, int]]:
    """Pairs (row, column) as greedy_places() takes them from (score, row, column)."""
    score, row, column = (np.array(x) for x in zip(*scored)) if scored else (np.zeros(0),) * 3
    return [(int(row[i]), int(column[i])) for i in greedy_places(score, row, column, larger_first)]


def monotone_alignment(cost: np.ndarray) -> list[tuple[int, int]]:
    """Cheapest alignment in order of all of the shorter side to the longer one's members; of equal ones that whose last members lie latest."""
    if cost.shape[0] > cost.shape[1]:
        return [(i, j) for j, i in monotone_alignment(cost.T)]
    n, m = cost.shape
    least = np.zeros(m + 1)  # of aligning the first i of the shorter side within the first j of the longer one
    taken = np.zeros((n, m), bool)
    for i in range(n):
        met = least[:-1] + cost[i]
        met[:i] = np.inf  # a band: each member needs one of its own, and the later ones theirs
        met[m - n + i + 1 :] = np.inf
        least = np.r_[np.inf, np.minimum.accumulate(met)]
        taken[i] = met <= least[:-1]
    out, j = [], m
    for i in range(n - 1, -1, -1):
        j -= 1
        while not taken[i, j]:
            j -= 1
        out.append((i, j))
    return out[::-1]


def match_cost(box: Column, reference: Column, same_page: Column, width: Column, height: Column, confidence: Column, alike: Column) -> Column:
    """Cost of taking a candidate slot for a reference: distance of centres in widths and heights, .4 for unlike text before it, .3 for lack of confidence.

    Another page costs 2 and the lack of confidence, a side without a box the lack alone. alike: similarity of the
    texts before both, null where one has none.
    """
    lack = 1 - F.coalesce(confidence, F.lit(0.5))
    middle = lambda b, i: (F.get(b, F.lit(i)) + F.get(b, F.lit(i + 2))) / 2
    near = F.abs(middle(box, 1) - middle(reference, 1)) / F.greatest(F.lit(1.0), height) + F.abs(middle(box, 0) - middle(reference, 0)) / F.greatest(F.lit(1.0), width)
    boxed = (F.size(box) == 4) & (F.size(reference) == 4)
    return F.when(~same_page, 2 + lack).when(~F.coalesce(boxed, F.lit(False)), lack).otherwise(near + 0.4 * (1 - F.coalesce(alike, F.lit(1.0))) + 0.3 * lack)


def aligned(costs: DataFrame, item: str, row: str, column: str, cost: str) -> DataFrame:
    """(item, row, column, cost) of the cheapest alignment in order of each item's rows and columns, all of the shorter side.

    costs has a line for each row and column of an item, whose slots are bounded by paper. Sorted items go through
    Python many a batch.
    """
    names = [item, row, column, cost]
    schema = ", ".join(f"`{n}` {costs.schema[n].dataType.simpleString()}" for n in names)

    def solved(rows: pd.DataFrame) -> pd.DataFrame:
        key = rows[item].to_numpy()
        ends = np.r_[np.flatnonzero(key[1:] != key[:-1]) + 1, len(key)] if len(key) else []
        out, begin = [], 0
        for end in ends:
            n = len(np.unique(rows[row].to_numpy()[begin:end]))
            table = rows[cost].to_numpy()[begin:end].reshape(n, -1)
            out += [begin + i * table.shape[1] + j for i, j in monotone_alignment(table)]
            begin = end
        return rows.iloc[out]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for rows in batches:
            rows = rows if held is None else pd.concat([held, rows], ignore_index=True)
            last = (rows[item] == rows[item].iloc[-1]) if len(rows) else pd.Series([], dtype=bool)
            held = rows[last].reset_index(drop=True)  # its rows may go on in the next batch
            yield solved(rows[~last].reset_index(drop=True))
        if held is not None and len(held):
            yield solved(held)

    return costs.select(*names).repartition(item).sortWithinPartitions(item, row, column).mapInPandas(run, schema)


def contiguous_parts(transitions: list[float], k: int, join_cost: float = 0.03) -> list[int]:
    """Starts of k runs of len(transitions) + 1 members with the least sum of inner transitions and join_cost times squared joins."""
    n = len(transitions) + 1
    k = max(1, min(k, n))
    summed = np.r_[0.0, np.cumsum(transitions)]
    price = lambda a, b: summed[b - 1] - summed[a] + join_cost * (b - a - 1) ** 2
    total, start = np.full((k + 1, n + 1), np.inf), np.zeros((k + 1, n + 1), int)
    total[0, 0] = 0
    for p in range(1, k + 1):
        for b in range(p, n + 1):
            total[p, b], start[p, b] = min((total[p - 1, a] + price(a, b), a) for a in range(p - 1, b))
    out, b = [], n
    for p in range(k, 0, -1):
        b = int(start[p, b])
        out.append(b)
    return out[::-1]


def merged_boxes(boxes: list[list[float]], least: float = 0.3) -> list[list[float]]:
    """Boxes by top and left, each joined to the last one if their intersection over union is above `least`."""
    out: list[list[float]] = []
    for b in sorted(boxes, key=lambda b: (b[1], b[0])):
        if out:
            a = out[-1]
            common = max(0, min(a[2], b[2]) - max(a[0], b[0])) * max(0, min(a[3], b[3]) - max(a[1], b[1]))
            union = (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - common
            if common / max(1, union) > least:
                out[-1] = [min(a[0], b[0]), min(a[1], b[1]), max(a[2], b[2]), max(a[3], b[3])]
                continue
        out.append(list(b))
    return out


def merged(rows: DataFrame, keys: list[str], box: str, ties: list[str], least: float = 0.3) -> DataFrame:
    """(keys, place, box): merged_boxes() of each key's boxes, places from 1. A key's boxes are one array, bounded by paper."""
    own = rows.filter(F.size(box) == 4)
    order = F.struct(F.get(box, F.lit(1)).alias("top_"), F.get(box, F.lit(0)).alias("left_"), *ties, F.col(box).alias("box_"))
    listed = own.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(order)), lambda r: r["box_"]).alias("all_"))

    def join(done: Column, b: Column) -> Column:
        last = F.element_at(done, -1)
        both = F.concat(F.slice(F.zip_with(last, b, lambda x, y: F.least(x, y)), 1, 2), F.slice(F.zip_with(last, b, lambda x, y: F.greatest(x, y)), 3, 2))
        return F.when(boxes.iou(last, b) > least, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(both))).otherwise(F.concat(done, F.array(b)))

    first = F.slice("all_", 1, 1)
    out = F.aggregate(F.slice("all_", 2, F.greatest(F.size("all_") - 1, F.lit(0))), first, join)
    return listed.select(*keys, F.posexplode(out).alias("n_", box)).select(*keys, (F.col("n_") + 1).alias("place"), box)


def assign(scores: DataFrame, group: str, row: str, column: str, score: str, method: str = "best") -> DataFrame:
    """(group, row, column, score) of the pairs chosen in each group: `best` in sum or `greedy`. Groups are pages or items, bounded by paper."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        (r, rows), (c, columns) = pd.factorize(pdf[row], sort=True), pd.factorize(pdf[column], sort=True)
        if method == "best":
            table = np.zeros((len(rows), len(columns)))
            table[r, c] = pdf[score]
            pairs = np.array(best_assignment(table), int).reshape(-1, 2)
            values = table[pairs[:, 0], pairs[:, 1]]
        else:
            some = np.flatnonzero(pdf[score].to_numpy() > 0)
            at = some[greedy_places(pdf[score].to_numpy()[some], r[some], c[some])]
            pairs, values = np.c_[r[at], c[at]], pdf[score].to_numpy()[at]
        return pd.DataFrame({group: [pdf[group].iloc[0]] * len(pairs), row: rows[pairs[:, 0]], column: columns[pairs[:, 1]], score: values})

    names = [group, row, column, score]
    schema = ", ".join(f"`{n}` {scores.schema[n].dataType.simpleString()}" for n in names)
    return scores.select(*names).groupBy(group).applyInPandas(run, schema)
