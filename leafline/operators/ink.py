"""Ink as runs: a row of pixels from x0 up to x1, x1 not included. Sheets are joined, voted on and subtracted by sweeping over the runs' ends.

A line of a page has as many rows as runs, not as pixels; each step is one window over the ends of a line, bounded by paper.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def runs_of(pixels: DataFrame, line: list[str], x: str = "x") -> DataFrame:
    """(line, x0, x1) of the pixels of each line that stand side by side; repeated pixels count once."""
    rows = pixels.select(*line, F.col(x).cast("bigint").alias("x_")).distinct()
    place = F.col("x_") - F.row_number().over(W.partitionBy(*line).orderBy("x_"))
    return rows.withColumn("island_", place).groupBy(*line, "island_").agg(F.min("x_").alias("x0"), (F.max("x_") + 1).alias("x1")).drop("island_")


def _swept(ends: DataFrame, line: list[str], counts: list[str]) -> DataFrame:
    """(line, x0, x1, counts) of the stretches between neighbouring ends (line, at, counts: changes), stretches of equal counts that touch being one."""
    at = ends.groupBy(*line, "at").agg(*[F.sum(c).alias(c) for c in counts])
    w = W.partitionBy(*line).orderBy("at")
    level = at.select(*line, "at", F.lead("at").over(w).alias("to"), *[F.sum(c).over(w.rowsBetween(W.unboundedPreceding, W.currentRow)).alias(c) for c in counts])
    state = F.struct(*counts)
    begins = level.withColumn("new_", ~F.coalesce(F.lag(state).over(w) == state, F.lit(False)))
    stretch = begins.filter("to is not null or new_").withColumn("n_", F.count_if("new_").over(w.rowsBetween(W.unboundedPreceding, W.currentRow)))
    return stretch.filter("to is not null").groupBy(*line, "n_", *counts).agg(F.min("at").alias("x0"), F.max("to").alias("x1")).drop("n_")


def _ends(runs: DataFrame, line: list[str], counts: dict[str, int]) -> DataFrame:
    """Two rows a run: what changes where it begins and where it ends. Runs without length are none."""
    end = lambda x, sign: F.struct(F.col(x).cast("bigint").alias("at"), *[F.lit(sign * v).alias(c) for c, v in counts.items()])
    return runs.filter("x0 < x1").select(*line, F.inline(F.array(end("x0", 1), end("x1", -1))))


def united(runs: DataFrame, line: list[str]) -> DataFrame:
    """Runs (line, x0, x1) of a line made one where they touch or lie on one another."""
    swept = _swept(_ends(runs, line, {"n": 1}), line, ["n"]).filter("n > 0")
    w = W.partitionBy(*line).orderBy("x0")
    apart = swept.withColumn("new_", ~F.coalesce(F.lag("x1").over(w) == F.col("x0"), F.lit(False))).withColumn("k_", F.count_if("new_").over(w))
    return apart.groupBy(*line, "k_").agg(F.min("x0").alias("x0"), F.max("x1").alias("x1")).drop("k_")


def voted(runs: DataFrame, sheets: DataFrame, page: list[str], share: float = 0.70, at_least: int = 2) -> DataFrame:
    """(page, y, x0, x1, votes, stable): how many sheets have ink on each stretch of a line, and whether enough have: at_least and that share of the page's.

    runs: (page, sheet, y, x0, x1); sheets: (page, n).
    """
    line = [*page, "y"]
    votes = _swept(_ends(united(runs, [*page, "sheet", "y"]), line, {"votes": 1}), line, ["votes"]).filter("votes > 0")
    needed = F.greatest(F.lit(at_least), F.ceil(F.col("n") * share))
    return votes.join(sheets.select(*page, "n"), page).select(*line, "x0", "x1", "votes", (F.col("votes") >= needed).alias("stable"))


def without(runs: DataFrame, printed: DataFrame, line: list[str], sheet: list[str]) -> DataFrame:
    """(sheet, line, x0, x1): what is left of each sheet's runs where the printed runs (line, x0, x1) have no ink: the writing."""
    own, key = united(runs, [*sheet, *line]), [*sheet, *line]
    lines = own.select(*key).distinct()
    other = lines.join(united(printed, line), line)  # printed lines that a sheet writes on
    ends = _ends(own, key, {"own": 1, "print": 0}).unionByName(_ends(other, key, {"own": 0, "print": 1}))
    return _swept(ends, key, ["own", "print"]).filter("own > 0 and print = 0").select(*key, "x0", "x1")


def ink_share(runs: DataFrame, page: list[str], width: Column) -> DataFrame:
    """(page, pixels, share): how many pixels of a page have ink, and what share of its widest line that is a line."""
    rows = runs.groupBy(*page).agg(F.sum(F.col("x1") - F.col("x0")).alias("pixels"), F.countDistinct("y").alias("lines_"))
    return rows.select(*page, "pixels", (F.col("pixels") / (F.col("lines_") * width)).alias("share"))
