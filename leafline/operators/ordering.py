"""Best rows, batches, reading order and columns of a page."""

from __future__ import annotations

import bisect

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T


def best(rows: DataFrame, keys: list[str], score: Column, ties: list[Column | str]) -> DataFrame:
    """The row of each key with the highest score, the first by ties of equals."""
    return rows.withColumn("rank_", F.row_number().over(W.partitionBy(*keys).orderBy(score.desc(), *ties))).filter("rank_ = 1").drop("rank_")


def first_by(rows: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The first row of each key by an order."""
    return rows.withColumn("rank_", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).filter("rank_ = 1").drop("rank_")


def top(rows: DataFrame, keys: list[str], order: list[Column], k: int) -> DataFrame:
    """The first k rows of each key with their `rank`."""
    return rows.withColumn("rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).filter(F.col("rank") <= k)


def with_margin(rows: DataFrame, keys: list[str], score: str, ties: list[str], least: float, lead: float) -> DataFrame:
    """The best row of each key if it scores at least `least` and leads the second by `lead`."""
    w = W.partitionBy(*keys).orderBy(F.col(score).desc(), *ties)
    ranked = rows.withColumn("rank_", F.row_number().over(w)).withColumn("next_", F.lead(score).over(w)).filter("rank_ = 1")
    return ranked.filter((F.col(score) >= least) & (F.col(score) - F.coalesce("next_", F.lit(float("-inf"))) >= lead)).drop("rank_", "next_")


def batches(rows: DataFrame, keys: list[str], order: list[str], size: int = 12) -> DataFrame:
    """rows with `batch` from 0, of at most `size` rows of one key."""
    return rows.withColumn("batch", F.floor((F.row_number().over(W.partitionBy(*keys).orderBy(*order)) - 1) / size))


class _Lines:
    """Lines of a page as boxes join them: the usual centre and height of each line's boxes."""

    def __init__(self) -> None:
        self.centre, self.height = np.zeros(0), np.zeros(0)
        self._sorted: list[tuple[list[float], list[float]]] = []

    def join(self, centre: float, height: float) -> int:
        """Number of the line that the box joins: the nearest within reach, the first of equals, or a new one."""
        away = np.abs(self.centre - centre)
        away[away > 0.45 * np.minimum(self.height, height)] = np.inf
        if not np.isfinite(away).any():
            self._sorted.append(([], []))
            self.centre, self.height, away = np.r_[self.centre, centre], np.r_[self.height, height], np.r_[away, 0.0]
        line = int(np.argmin(away))
        for known, value in zip(self._sorted[line], (centre, height)):
            bisect.insort(known, value)
        self.centre[line], self.height[line] = ((v[(len(v) - 1) // 2] + v[len(v) // 2]) / 2 for v in self._sorted[line])
        return line


def _as_array(boxes: list[list[float] | None]) -> np.ndarray:
    """(n, 4) numbers; a box that is missing or has not four numbers is a row of NaN."""
    return np.array([b if b is not None and len(b) == 4 else [np.nan] * 4 for b in boxes], float).reshape(-1, 4)


def rows_in_order(boxes: list[list[float] | None]) -> list[int]:
    """Reading order of boxes: lines of near centres from the top, each from the left; those without box last, as given.

    From the top left on, a box joins the line whose median centre is nearest, if within 0.45 of the lesser of its
    height and the line's median height, else it begins a line.
    """
    x, top, _, bottom = table = _as_array(boxes).T
    lines, line, turn = _Lines(), np.zeros(len(x), int), np.arange(len(x))
    given = np.flatnonzero(~np.isnan(table).any(axis=0))
    given = given[np.lexsort((x[given], top[given]))]
    turn[given] = np.arange(len(given))
    for i in given:
        line[i] = lines.join((top[i] + bottom[i]) / 2, max(1.0, bottom[i] - top[i]))
    height_on_page = np.full(len(x), np.inf)
    height_on_page[given] = lines.centre[line[given]]
    return np.lexsort((turn, np.nan_to_num(x), line, height_on_page)).tolist()


#: Where gutters are looked for, in parts of the width; half their breadth; least blocks beside one, least characters of a block that counts as text.
GUTTERS, CLEAR, BESIDE, WORDY = (0.5, 0.45, 0.55, 0.4, 0.6), 0.015, 3, 8


def column_split(boxes: list[list[float] | None], texts: list[str], width: float) -> list[list[int]]:
    """Groups of blocks to be read one after another: what crosses, the left and the right column; one group without a clear gutter.

    Of GUTTERS the first with BESIDE blocks on either side clear of it, as many with WORDY characters, sides that stand
    beside one another for four usual heights, and no block across that ends more than a usual height below where they begin to.
    """
    x0, top, x1, bottom = table = _as_array(boxes).T
    given = ~np.isnan(table).any(axis=0)
    if given.sum() < 2 * BESIDE:
        return [list(range(len(boxes)))]
    usual = np.median(np.maximum(1, (bottom - top)[given]))
    wordy = np.array([len((t or "").strip()) >= WORDY for t in texts])
    gutter = np.array(GUTTERS)[:, None] * width
    side = np.stack([x1 < gutter - CLEAR * width, x0 > gutter + CLEAR * width])  # which side, gutter, block; NaN is on neither
    begin = np.where(side, top, np.inf).min(axis=2).max(axis=0)
    stop = np.where(side, bottom, -np.inf).max(axis=2).min(axis=0)
    across = given & ~side.any(axis=0)
    low = np.where(across, bottom, -np.inf).max(axis=1)
    fits = (side.sum(axis=2) >= BESIDE).all(axis=0) & ((side & wordy).sum(axis=2) >= BESIDE).all(axis=0) & (low <= begin + usual)
    fits &= np.where(fits, stop, 0) - np.where(fits, begin, 0) >= 4 * usual
    if not fits.any():
        return [list(range(len(boxes)))]
    g = int(np.argmax(fits))
    return [np.flatnonzero(m).tolist() for m in (across[g], side[0, g], side[1, g])]


def reading_order(blocks: DataFrame, page: list[str], box: str, text: str, width: float) -> DataFrame:
    """blocks with `place` from 1 in their page: by columns, then rows. A page is one group in a task; its size is bounded by paper."""
    names = [*blocks.columns, "place"]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(page + [c for c in pdf.columns if c not in (box, text, *page)], kind="stable").reset_index(drop=True)
        boxes, texts = [None if b is None else list(b) for b in pdf[box]], list(pdf[text])
        order = [g[i] for g in column_split(boxes, texts, width) for i in rows_in_order([boxes[j] for j in g])]
        pdf.loc[order, "place"] = range(1, len(order) + 1)
        return pdf.assign(place=pdf["place"].astype("int64"))[names]

    schema = T.StructType([*blocks.schema.fields, T.StructField("place", T.LongType())])
    return blocks.groupBy(*page).applyInPandas(run, schema)
