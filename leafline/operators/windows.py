"""Sequence operators: gaps, islands, corridors, continuations, placeholders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def numbering_gaps(rows: DataFrame, keys: list[str], order: list[str], number: str) -> DataFrame:
    """(keys, after, before, missing) of neighbours in order whose numbers leave some out; null numbers are passed over, restarts and repeats leave none out."""
    w = W.partitionBy(*keys).orderBy(*order)
    seen = rows.filter(F.col(number).isNotNull()).withColumn("prev_", F.lag(number).over(w)).filter(F.col("prev_") < F.col(number) - 1)
    return seen.select(*keys, F.col("prev_").alias("after"), F.col(number).alias("before"), F.sequence(F.col("prev_") + 1, F.col(number) - 1).alias("missing"))


def order_faults(rows: DataFrame, keys: list[str], order: list[str], number: str) -> DataFrame:
    """(keys, falls, gap): how often a number is below the one before, and whether the distinct numbers leave any out."""
    w = W.partitionBy(*keys).orderBy(*order)
    marked = rows.withColumn("fall_", F.coalesce(F.lag(number).over(w) > F.col(number), F.lit(False)))
    return marked.groupBy(*keys).agg(F.count_if("fall_").alias("falls"), (F.max(number) - F.min(number) + 1 != F.countDistinct(number)).alias("gap"))


def islands(rows: DataFrame, keys: list[str], order: list[str], position: Column, gap: float) -> DataFrame:
    """rows with `island`, from 0: a new one where the position is more than gap beyond the row before."""
    w = W.partitionBy(*keys).orderBy(*order)
    far = F.coalesce((position - F.lag(position).over(w) > gap).cast("int"), F.lit(0))
    return rows.withColumn("far_", far).withColumn("island", F.sum("far_").over(w.rowsBetween(W.unboundedPreceding, W.currentRow))).drop("far_")


def streak(rows: DataFrame, keys: list[str], order: list[str], position: Column, gap: float) -> DataFrame:
    """Rows before the first gap."""
    return islands(rows, keys, order, position, gap).filter("island = 0").drop("island")


def continuation(rows: DataFrame, keys: list[str], order: list[str], text: str, speaker: str) -> DataFrame:
    """rows with `continues`: the row before has the same speaker, or ends without a full stop while this one begins in lower case."""
    w = W.partitionBy(*keys).orderBy(*order)
    before, who = F.lag(text).over(w), F.lag(speaker).over(w)
    open_ = ~F.rtrim(before).rlike("[.!?]$") & F.ltrim(F.col(text)).rlike("^[a-z]")
    return rows.withColumn("continues", F.coalesce((who == F.col(speaker)) | open_, F.lit(False)))


def corridors(rows: DataFrame, keys: list[str], order: list[str], top: Column, bottom: Column, end: Column, margin: float = 8.0) -> DataFrame:
    """rows with `corridor_top` and `corridor_bottom`: from the top to the next one's top less the margin, the last to the end, never above its own bottom."""
    nxt = F.lead(top).over(W.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("corridor_top", top).withColumn("corridor_bottom", F.when(nxt.isNull(), end).otherwise(F.greatest(bottom, nxt - margin)))


def bands(rows: DataFrame, keys: list[str], order: list[str], low: Column, high: Column, first: Column, last: Column) -> DataFrame:
    """rows with disjoint `band_low` and `band_high`: half-way to the neighbours, the outer ones to first and last."""
    w = W.partitionBy(*keys).orderBy(*order)
    before, after = F.lag(high).over(w), F.lead(low).over(w)
    return rows.withColumn("band_low", F.coalesce((before + low) / 2, first)).withColumn("band_high", F.coalesce((high + after) / 2, last))


def spans(rows: DataFrame, keys: list[str], order: list[str], is_marker: Column) -> DataFrame:
    """rows with `span`: the number of markers up to and with the row; 0 before the first."""
    w = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    return rows.withColumn("span", F.sum(F.coalesce(is_marker.cast("int"), F.lit(0))).over(w))


def rising_prefix(rows: DataFrame, keys: list[str], order: list[str], number: str) -> DataFrame:
    """Rows up to the first whose number is not above the one before."""
    w = W.partitionBy(*keys).orderBy(*order)
    stop = F.coalesce((F.lag(number).over(w) >= F.col(number)).cast("int"), F.lit(0))
    marked = rows.withColumn("stop_", stop).withColumn("stops_", F.sum("stop_").over(w.rowsBetween(W.unboundedPreceding, W.currentRow)))
    return marked.filter("stops_ = 0").drop("stop_", "stops_")


def contiguous(rows: DataFrame, keys: list[str], number: str) -> DataFrame:
    """(keys, contiguous): whether the numbers are 1, 2, 3 and so on."""
    n = F.row_number().over(W.partitionBy(*keys).orderBy(number))
    return rows.withColumn("n_", n).groupBy(*keys).agg(F.bool_and(F.col("n_") == F.col(number)).alias("contiguous"))


def placeholders(rows: DataFrame, expected: DataFrame, keys: list[str], number: str, count: str) -> DataFrame:
    """(keys, number) of those from 1 to the expected count that are missing among rows."""
    all_ = expected.filter(F.col(count) >= 1).select(*keys, F.explode(F.sequence(F.lit(1), F.col(count).cast("int"))).alias(number))
    return all_.join(rows.select(*keys, number), [*keys, number], "left_anti")


def phase_seconds(events: DataFrame, keys: list[str], at: str, started: Column) -> DataFrame:
    """Rows that end a phase with the seconds since the row before, if that one started it."""
    w = W.partitionBy(*keys).orderBy(at)
    return events.withColumn("start_", F.when(F.lag(started).over(w), F.lag(at).over(w))).filter(F.col("start_").isNotNull() & ~started).withColumn("seconds", F.unix_micros(F.col(at).cast("timestamp")) / 1e6 - F.unix_micros(F.col("start_").cast("timestamp")) / 1e6).drop("start_")
