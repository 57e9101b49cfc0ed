"""Automatic repair: which items to try once more, which tries to adopt, and a table of results kept by version."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafline import store
from leafline.functions import boxes
from leafline.operators import joins
from leafline.operators.aggregates import improved

#: Faults that a retry can mend; those of the place of an answer, which it can mend only where nothing is aligned yet; those that it can mend whatever was tried before.
REPAIRABLE = ("PRINTED_STEM_CONTAMINATION", "ANCHOR_NOT_FOUND", "FORMULA_DISAGREEMENT", "FORMULA_STRUCTURE_DISAGREEMENT", "REGISTRATION_LOW", "PAGE_ID_MISMATCH", "JSON_SCHEMA_ERROR")
OF_PLACE = ("ANCHOR_NOT_FOUND", "REGISTRATION_LOW", "PAGE_ID_MISMATCH", "JSON_SCHEMA_ERROR")
BEYOND_BUDGET = ("PRINTED_STEM_CONTAMINATION", "FORMULA_DISAGREEMENT", "FORMULA_STRUCTURE_DISAGREEMENT", "RECOGNITION_DISAGREEMENT", "JSON_SCHEMA_ERROR", "PAGE_ID_MISMATCH")
ALIGNED = ("ALIGNED", "ALIGNED_WITH_WARNING")
#: Share of the smaller box beyond which a retried slot may not lie on another.
OVERLAP = 0.4


def states(slots: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, aligned, recognized, issues, reasons) of slots (keys, geometry_status, box, content_status, text, issues array)."""
    is_aligned = F.col("geometry_status").isin(*ALIGNED) & (F.size("box") == 4)
    read = (F.col("content_status") == "RECOGNIZED") & (F.trim(F.coalesce("text", F.lit(""))) != "")
    return slots.groupBy(*keys).agg(
        F.count_if(is_aligned).alias("aligned"), F.count_if(read).alias("recognized"), F.sum(F.size(F.coalesce("issues", F.array()))).alias("issues"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.coalesce("issues", F.array()))))).alias("reasons"),
    )


def to_retry(reasons: Column, aligned: Column, attempts: Column, tried: Column) -> tuple[Column, Column]:
    """(reasons that can be mended, in order; whether to retry): an item is retried once."""
    of = lambda names: F.array(*[F.lit(n) for n in names])
    known = F.array_sort(F.array_intersect(reasons, of(REPAIRABLE)))
    lost = F.arrays_overlap(known, of(OF_PLACE)) & (aligned == 0)
    return known, (F.size(known) > 0) & (F.arrays_overlap(known, of(BEYOND_BUDGET)) | (lost & (attempts < 2))) & ~F.coalesce(tried, F.lit(False))


def _yielding(pdf: pd.DataFrame) -> pd.DataFrame:
    """Of pairs (place, other) on one page, other < place: the places that lie on one that stays, looked at in order."""
    gone: set[int] = set()
    for place, other in sorted(zip(pdf["place"], pdf["other"])):
        if other not in gone:
            gone.add(place)
    return pd.DataFrame({"page": pdf["page"].iloc[0], "place": np.array(sorted(gone), np.int64)})


def free_places(retried: DataFrame, occupied: DataFrame, cell: float = 250.0) -> DataFrame:
    """retried (page, place, box) with `conflict`: it lies by more than OVERLAP on a box of occupied (page, box), or on a retried one of lower place that itself stays.

    Boxes meet in grid cells. Only pairs of retried slots of one page that lie on one another come together in a group.
    """
    share = lambda a, b: boxes.intersection(a, b) / F.greatest(F.lit(1.0), F.least(boxes.area(a), boxes.area(b)))
    others = occupied.filter(F.size("box") == 4).select("page", F.col("box").alias("box_2"))
    placed = retried.filter(F.size("box") == 4).select("page", "place", "box")
    taken = joins.overlapping(placed, others, ["page"], "box", share, OVERLAP, cell).select("page", "place").distinct()
    left = placed.join(taken, ["page", "place"], "left_anti")
    earlier = left.select("page", F.col("place").alias("other"), F.col("box").alias("box_2"))
    pairs = joins.overlapping(left, earlier, ["page"], "box", share, OVERLAP, cell, keep=F.col("other") < F.col("place")).select("page", "place", "other")
    yields = pairs.groupBy("page").applyInPandas(_yielding, retried.select("page", "place").schema)
    return retried.join(taken.unionByName(yields).withColumn("conflict", F.lit(True)), ["page", "place"], "left").fillna(False, ["conflict"])


STATE = ("aligned", "recognized", "issues")


def _measure(prefix: str) -> list[Column]:
    return [F.col(f"{prefix}{STATE[0]}"), F.col(f"{prefix}{STATE[1]}"), -F.col(f"{prefix}{STATE[2]}")]


def latest(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The row of the highest version of each key."""
    value = [c for c in rows.columns if c not in keys and c != "version"]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*value), "version").alias("r_"), F.max("version").alias("version")).select(*keys, "r_.*", "version")


def current(spark, folder: str, schema: str, keys: list[str], below: int | None = None) -> DataFrame:
    """The results of all versions that were written to their end, or of those below a number."""
    names = [p for p in store.parts(spark, folder) if below is None or int(p.split("=")[1]) < below]
    return latest(store.get(spark, folder, schema, names), keys)


def adopt(revised: DataFrame, folder: str, version: int, keys: list[str]) -> DataFrame:
    """The decisions about revised (keys, aligned, recognized, issues, ...), whose adopted rows become that version of the results.

    `decision`: NEW without an earlier result, ADOPTED_IMPROVEMENT if (aligned, recognized, -issues) got better by order
    and neither of the first two worse, else RETAINED_PREVIOUS_RESULT; `auto_reject` if neither the result that stays nor
    the try has a slot that is aligned. A version is decided against those below it and replaces itself: one whose
    writing was broken off does not count, and a repeated one has the same result. A key's rows of one version have to be one.
    """
    spark = revised.sparkSession
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in revised.schema) + ", version int"
    before = current(spark, folder, schema, keys, below=version)
    old = before.select(*keys, *[F.col(c).alias(f"old_{c}") for c in STATE], F.col("version").alias("old_version"))
    met = revised.join(old, keys, "left")
    decision = F.when(F.col("old_version").isNull(), "NEW").when(improved(_measure("old_"), _measure("")), "ADOPTED_IMPROVEMENT").otherwise("RETAINED_PREVIOUS_RESULT")
    met = met.withColumn("decision", decision)
    store.put(met.filter("decision <> 'RETAINED_PREVIOUS_RESULT'").select(*revised.columns, F.lit(version).alias("version")), folder, f"version={version}")
    stays = F.when(F.col("decision") == "RETAINED_PREVIOUS_RESULT", F.col("old_aligned")).otherwise(F.col("aligned"))
    return met.select(*keys, "decision", (stays == 0).alias("auto_reject"), "old_version", F.lit(version).alias("version"))
