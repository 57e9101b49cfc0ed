"""Quality of answers, items and slots, and what a cohort and telemetry say of them."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leafline.functions import boxes


def assessed(text: Column, kind: Column, confidence: Column) -> Column:
    """struct(confidence, quality, text, corrected, needs_review) of an answer by its kind, length and recognition's confidence.

    Choices: one letter, several, or a mark are certain; a letter with a stop is corrected. Filled blanks: the shorter
    the surer. All else, and what fits no form, is for review. A null text counts as empty.
    """
    t = F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)^\s+|\s+$", "")
    choice = kind == "choice"
    fixed = F.when(choice & t.rlike(r"^[A-Ha-h]\s*[.、]?$"), F.upper(F.substring(t, 1, 1))).otherwise(t)
    n, above = F.char_length(fixed), lambda least: F.coalesce(confidence > least, F.lit(False))
    cases = [
        (choice & fixed.rlike("^[A-H]$"), F.when(above(0.8), 0.95).otherwise(0.85), "high", F.lit(False)),
        (choice & fixed.rlike("^[A-H]{2,4}$"), F.when(above(0.7), 0.90).otherwise(0.75), "high", F.lit(False)),
        (choice & fixed.rlike("^[✓✔√☑勾]$"), F.when(F.coalesce(confidence >= 0.65, F.lit(True)), 0.85).otherwise(0.75), "high", F.lit(False)),
        (choice, F.lit(0.30), "low", F.lit(True)),
        (n == 0, F.lit(0.0), "low", F.lit(True)),
        ((kind == "fill_blank") & (n <= 3) & above(0.7), F.lit(0.85), "high", F.lit(False)), ((kind == "fill_blank") & (n <= 3), F.lit(0.70), "medium", F.lit(True)),
        ((kind == "fill_blank") & (n <= 10), F.when(above(0.6), 0.75).otherwise(0.60), "medium", ~above(0.6)), (kind == "fill_blank", F.lit(0.50), "medium", F.lit(True)),
    ]
    sure, grade, review = F.when(F.lit(False), 0.0), F.when(F.lit(False), ""), F.when(F.lit(False), True)
    for c, s, g, r in cases:
        sure, grade, review = sure.when(c, s), grade.when(c, g), review.when(c, r)
    return F.struct(sure.otherwise(F.when(above(0.5), 0.60).otherwise(0.40)).alias("confidence"), grade.otherwise("medium").alias("quality"), fixed.alias("text"), (fixed != t).alias("corrected"), review.otherwise(F.lit(True)).alias("needs_review"))


def slot_faults(slots: DataFrame, teacher: bool = False) -> DataFrame:
    """(item_id, slot_idx, level, code): reasons and warnings of slots (item_id, slot_idx, geometry, content, status, blank_confirmed, text)."""
    g, c, missing = F.col("geometry"), F.col("content"), F.col("geometry") == "MISSING"
    blank = (c == "BLANK") & F.coalesce("blank_confirmed", F.lit(False))
    line = lambda level, code: F.struct(F.lit(level).alias("level"), F.lit(code).alias("code"))
    place = (
        F.when(missing & blank, line("warning", "BLANK_WITHOUT_PIXELS")).when(missing, line("reason", "NOT_FOUND")).when(g.isin("FAILED", "UNCERTAIN"), line("reason", "GEOMETRY_OPEN"))
        .when(g == "ALIGNED_WITH_WARNING", line("warning", "GEOMETRY_WARNING")).when(F.col("status") == "ANOMALY_ESCALATED", line("reason", "ESCALATED"))
    )
    lacking = (F.col("status") == "TEACHER_ANSWER_NEEDS_REVIEW") | (F.coalesce("text", F.lit("")) == "")
    found = F.array_compact(F.array(F.when(F.lit(teacher) & lacking, line("reason", "TEACHER_ANSWER_MISSING")), place, F.when(c.isin("OCR_UNCERTAIN", "VLM_UNCERTAIN"), line("warning", "CONTENT_UNCERTAIN"))))
    return slots.select("item_id", "slot_idx", F.inline(found))


def item_quality(items: DataFrame, faults: DataFrame, overlaps: DataFrame) -> DataFrame:
    """(item_id, status, reasons, warnings, regions, overlaps) of items (item_id, regions): NEED_REVIEW with any reason or overlap. overlaps: a row (item_id) for each other item's answer that one overlaps."""
    per = faults.groupBy("item_id").agg(F.count_if(F.col("level") == "reason").alias("reasons"), F.count_if(F.col("level") == "warning").alias("warnings"))
    over = overlaps.groupBy("item_id").agg(F.count(F.lit(1)).alias("overlaps"))
    out = items.join(per, "item_id", "left").join(over, "item_id", "left").fillna(0, ["reasons", "warnings", "overlaps"])
    return out.select("item_id", F.when((F.col("reasons") > 0) | (F.col("overlaps") > 0), "NEED_REVIEW").otherwise("OK").alias("status"), "reasons", "warnings", F.size(F.coalesce("regions", F.lit([]).cast("array<array<double>>"))).alias("regions"), "overlaps")


def telemetry(events: DataFrame) -> DataFrame:
    """Sums per operation of events (operation, duration_seconds, image_count, image_bytes, attempts, status, cache_hit), and of all under a null operation."""
    n = F.count(F.lit(1))
    return events.rollup("operation").agg(
        n.alias("request_count"), F.round(F.sum("duration_seconds"), 4).alias("duration_seconds"), F.sum("image_count").alias("image_count"), F.sum("image_bytes").alias("image_bytes"), F.sum("attempts").alias("attempts"),
        F.count_if(F.col("status") != "SUCCESS").alias("failures"), F.count_if("cache_hit").alias("cache_hits"), F.round(F.count_if("cache_hit") / F.greatest(F.lit(1), n), 4).alias("cache_hit_rate"),
    )


def cohort_support(uses: DataFrame, keys: list[str], slot: str, used: str, least_samples: int = 2, least_share: float = 0.20) -> DataFrame:
    """(keys, slots, samples): how many slots a cohort uses, from rows of one sheet and slot each, `used` null for a sheet that could not be read; null slots with fewer samples than enough."""
    per = uses.groupBy(*keys, slot).agg(F.count(used).alias("n_"), F.count_if(F.col(used)).alias("k_"))
    share = F.coalesce(F.round(F.try_divide(F.col("k_"), F.col("n_")), 4), F.lit(0.0))
    out = per.groupBy(*keys).agg(F.count_if(share >= least_share).alias("slots"), F.max("n_").alias("samples"))
    return out.withColumn("slots", F.when(F.col("samples") >= least_samples, F.col("slots")))


def line_clusters(rows: DataFrame, keys: list[str], box: str, order: list[str], across: float = 50.0, down: float = 30.0) -> DataFrame:
    """rows with `cluster` from 0: in order of centres, a box goes on with the cluster of the one before if it begins less than `across` behind its end and their centres differ by less than `down`."""
    b = F.col(box)
    cx, cy = (F.get(b, F.lit(0)) + F.get(b, F.lit(2))) / 2, boxes.center_y(b)
    marked = rows.withColumn("cx_", cx).withColumn("cy_", cy)
    w = W.partitionBy(*keys).orderBy("cy_", "cx_", *order)
    far = ~((F.get(b, F.lit(0)) - F.lag(F.get(b, F.lit(2))).over(w) < across) & (F.abs(F.col("cy_") - F.lag("cy_").over(w)) < down))
    marked = marked.withColumn("far_", F.coalesce(far.cast("int"), F.lit(0)))
    return marked.withColumn("cluster", F.sum("far_").over(w.rowsBetween(W.unboundedPreceding, W.currentRow))).drop("cx_", "cy_", "far_")


def renumbered(slots: DataFrame, item: str, place: list[str], expected: DataFrame) -> DataFrame:
    """(item, slot_idx, filled): an item's slots numbered from 1 by place, and blank ones up to the expected count of expected (item, expected)."""
    own = slots.select(item, F.row_number().over(W.partitionBy(item).orderBy(*place)).alias("slot_idx"))
    n = own.groupBy(item).agg(F.max("slot_idx").alias("n_"))
    more = expected.join(n, item, "left").withColumn("n_", F.coalesce("n_", F.lit(0))).filter(F.col("expected") > F.col("n_"))
    blank = more.select(item, F.explode(F.sequence(F.col("n_") + 1, F.col("expected").cast("int"))).alias("slot_idx"), F.lit(False).alias("filled"))
    return own.withColumn("filled", F.lit(True)).unionByName(blank)


def natural_key(name: Column) -> Column:
    """A name's parts for sorting: runs of digits as numbers, all else in lower case."""
    parts = F.regexp_extract_all(F.coalesce(name, F.lit("")), F.lit(r"([0-9]+|[^0-9]+)"), F.lit(1))
    return F.transform(parts, lambda p: F.struct(F.coalesce(p.try_cast("decimal(38,0)"), F.lit(-1).cast("decimal(38,0)")).alias("number"), F.when(p.rlike("^[0-9]"), "").otherwise(F.lower(p)).alias("text")))


def page_sizes(slots: DataFrame, pages: DataFrame) -> DataFrame:
    """slots (page_index, box) with the width and height of their page (page_index, width, height), the default page's where unknown, and whether their box lies in it."""
    met = slots.join(pages, "page_index", "left")
    return met.withColumn("valid", boxes.valid_box(F.col("box"), F.col("width"), F.col("height"))).withColumn("width", F.coalesce("width", F.lit(boxes.PAGE_WIDTH))).withColumn("height", F.coalesce("height", F.lit(boxes.PAGE_HEIGHT)))


@F.pandas_udf(T.StringType())
def transposed_tree(tree: pd.Series) -> pd.Series:
    """JSON in which every array of four numbers under a name with bbox has its sides swapped in pairs, at any depth. Python, as depth is open."""

    def turn(value, name: str):
        if isinstance(value, dict):
            return {k: turn(v, k) for k, v in value.items()}
        if isinstance(value, list):
            if "bbox" in name and len(value) == 4 and all(isinstance(v, (int, float)) for v in value):
                return [value[i] for i in (1, 0, 3, 2)]
            return [turn(v, name) for v in value]
        return value

    return tree.map(lambda t: None if t is None else json.dumps(turn(json.loads(t), ""), ensure_ascii=False))
