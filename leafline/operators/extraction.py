"""From recorded page answers of a model to slots, parts, items and a document's readiness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafline.operators.aggregates import inclusion_status, item_status, ratio

REGION = "struct<answer_bbox: array<double>, transcription: string, legible: boolean, content_kind: string, confidence: double>"
SLOT = f"struct<index: int, label: string, anchor_before: string, anchor_after: string, regions: array<{REGION}>, confidence: double>"
ITEM = f"struct<item_id: string, page_index: int, answer_layout: string, slots: array<{SLOT}>, confidence: double>"
RESPONSE = f"struct<items: array<{ITEM}>>"
#: Fixed values of the answers' format.
LAYOUTS = ("horizontal", "vertical", "single", "mixed")
LABELS = ("choice_response", "blank_response", "formula_response", "short_response", "working_response", "proof_response", "drawing_response", "answer_part")
KINDS = ("handwriting", "printed_answer", "mixed", "blank", "uncertain")
SINGLE = "choice|large_writing|solve|proof|essay|calculation"


def items_of(pages: DataFrame) -> DataFrame:
    """(document_id, page_index, width, height, item_ord, item) of pages with a JSON `response`; page_index is the page's own."""
    rows = pages.withColumn("r_", F.from_json("response", RESPONSE))
    return rows.select("document_id", "page_index", "width", "height", F.posexplode("r_.items").alias("item_ord", "item"))


def _share(c: Column) -> Column:
    return F.coalesce(c.between(0.0, 1.0) & ~F.isnan(c), F.lit(False))


def _box_fault(b: Column) -> Column:
    """Boxes are four whole numbers of thousandths, in order."""
    at = [F.get(b, F.lit(i)) for i in range(4)]
    return ~F.coalesce((F.size(b) == 4) & (at[0] >= 0) & (at[0] < at[2]) & (at[2] <= 1000) & (at[1] >= 0) & (at[1] < at[3]) & (at[3] <= 1000), F.lit(False))


def item_faults(items: DataFrame, expected: DataFrame) -> DataFrame:
    """items with `fault`, the first rule broken or null; expected: (document_id, item_id, item_type, expected_slot_count)."""
    it = F.col("item")
    rows = items.withColumn("item_id", it["item_id"]).join(expected.select("document_id", "item_id", F.lower("item_type").alias("kind_"), F.col("expected_slot_count").alias("n_")), ["document_id", "item_id"], "left")
    slots, n = it["slots"], F.size(it["slots"])
    any_slot = lambda test: F.exists(slots, test)
    any_region = lambda test: F.exists(slots, lambda s: F.exists(s["regions"], test))
    bad_region = lambda r: (
        r["transcription"].isNull() | r["legible"].isNull() | ~F.coalesce(r["content_kind"].isin(*KINDS), F.lit(False)) | ~_share(r["confidence"])
    )
    fault = (
        F.when(F.col("kind_").isNull(), "UNKNOWN_VISUAL_ITEM")
        .when(~F.coalesce(it["answer_layout"].isin(*LAYOUTS), F.lit(False)), "INVALID_VISUAL_ANSWER_LAYOUT")
        .when(~_share(it["confidence"]), "INVALID_VISUAL_ITEM_CONFIDENCE")
        .when(slots.isNull() | (n < 1), "INVALID_VISUAL_SLOT_COUNT")
        .when((F.coalesce("n_", F.lit(0)) > 0) & (n != F.col("n_")), "TEACHER_TOPOLOGY_CONFLICT")
        .when(F.col("kind_").rlike(SINGLE) & (n != 1), "SINGLE_RESPONSE_REQUIRED")
        .when(F.exists(F.zip_with(slots, F.sequence(F.lit(1), n), lambda s, i: ~s["index"].eqNullSafe(i)), lambda x: x), "INVALID_VISUAL_SLOT_ORDER")
        .when(any_slot(lambda s: ~F.coalesce(s["label"].isin(*LABELS), F.lit(False))), "INVALID_VISUAL_SLOT_LABEL")
        .when(any_slot(lambda s: s["anchor_before"].isNull() | s["anchor_after"].isNull()), "INVALID_VISUAL_SLOT_ANCHORS")
        .when(any_slot(lambda s: ~_share(s["confidence"])), "INVALID_VISUAL_SLOT_CONFIDENCE")
        .when(any_slot(lambda s: s["regions"].isNull() | (F.size(s["regions"]) > 10)), "INVALID_VISUAL_SLOT_REGIONS")
        .when(any_region(lambda r: _box_fault(r["answer_bbox"])), "INVALID_VISUAL_BOX")
        .when(any_region(bad_region), "INVALID_VISUAL_REGION_VALUE")
    )
    return rows.withColumn("fault", fault).drop("kind_", "n_")


def parts_of(items: DataFrame) -> DataFrame:
    """One row per region of each slot, one for a slot without: ids, page box in pixels, text, content and geometry status, warnings."""
    slots = items.select("document_id", "page_index", "width", "height", "item_ord", F.col("item.item_id").alias("item_id"), F.explode("item.slots").alias("s"))
    rows = slots.select("*", F.posexplode_outer("s.regions").alias("region_ord", "r"))
    none = F.col("r").isNull()
    sure = F.least(F.col("s.confidence"), F.col("r.confidence"))
    text = F.trim(F.coalesce(F.col("r.transcription"), F.lit("")))
    kind = F.col("r.content_kind")
    warnings = F.array_compact(F.array(
        F.when(none, "NO_VISIBLE_ANSWER_REGION"), F.when(sure < 0.60, "LOW_VLM_GEOMETRY_CONFIDENCE"), F.when(kind.isin("mixed", "uncertain"), F.concat(F.lit("VLM_CONTENT_KIND_"), F.upper(kind))),
    ))
    blank = none | ((kind == "blank") & (text == ""))
    content = F.when(blank, "BLANK").when(F.col("r.legible") & (text != ""), "RECOGNIZED").otherwise("VLM_UNCERTAIN")
    side = lambda i: F.bround(F.get(F.col("r.answer_bbox"), F.lit(i)) * F.col("width" if i % 2 == 0 else "height") / 1000)
    return rows.select(
        "document_id", "item_id", "item_ord", F.concat("item_id", F.lit(":slot:"), "s.index").alias("slot_id"), F.col("s.index").alias("slot_idx"), F.coalesce("region_ord", F.lit(0)).alias("region_ord"), "page_index",
        F.when(~none, F.array(*[side(i) for i in range(4)])).alias("box"), F.when(content == "RECOGNIZED", text).alias("text"), content.alias("content_status"),
        F.when(none, "MISSING").when(F.size(warnings) > 0, "ALIGNED_WITH_WARNING").otherwise("ALIGNED").alias("geometry_status"), none.alias("blank_confirmed"), warnings.alias("warnings"),
    )


def merged_parts(parts: DataFrame) -> DataFrame:
    """One row per logical slot: texts of its regions joined in order of page and region, null and UNRESOLVED if one of several is null; geometry BAD if any region's is."""
    rows = parts.groupBy("document_id", "item_id", "slot_id").agg(
        F.min("slot_idx").alias("slot_idx"), F.count(F.lit(1)).alias("n_regions"), F.array_sort(F.collect_list(F.struct("page_index", "region_ord", "text"))).alias("t_"),
        F.bool_or(F.col("text").isNull()).alias("null_"), F.max(F.struct(F.col("content_status") != "BLANK", "content_status"))["content_status"].alias("one_"),
        F.when(F.bool_and((F.col("geometry_status") != "MISSING") | ((F.col("content_status") == "BLANK") & F.col("blank_confirmed"))), "ALIGNED").otherwise("FAILED").alias("geometry"),
    )
    status = F.when(~F.col("null_"), "RECOGNIZED").when(F.col("n_regions") > 1, "UNRESOLVED").when(F.col("one_") == "BLANK", "BLANK").otherwise("UNRESOLVED")
    return rows.select("document_id", "item_id", "slot_id", "slot_idx", "n_regions", F.when(~F.col("null_"), F.array_join(F.transform("t_", lambda x: x["text"]), "\n")).alias("text"), status.alias("status"), "geometry", F.lit(True).alias("blank_confirmed"))


def answers(merged: DataFrame) -> DataFrame:
    """(document_id, item_id, answer): the ordered texts of an item's slots, nulls kept."""
    rows = merged.groupBy("document_id", "item_id").agg(F.array_sort(F.collect_list(F.struct("slot_idx", "slot_id", "text"))).alias("a_"))
    return rows.select("document_id", "item_id", F.transform("a_", lambda a: a["text"]).alias("answer"))


def readiness(pages: DataFrame, expected: DataFrame) -> DataFrame:
    """One row per document: counts of logical slots, stage statuses and whether it is production-ready.

    Ready: all expected items came back without fault, and all are complete.
    """
    checked = item_faults(items_of(pages), expected)
    good = checked.filter("fault is null")
    parts = parts_of(good)
    merged = merged_parts(parts).join(expected.select("document_id", "item_id", "expected_slot_count"), ["document_id", "item_id"], "left")
    items = item_status(merged, ["document_id", "item_id"], "expected_slot_count")
    stages = parts.groupBy("document_id").agg(
        F.count(F.lit(1)).alias("physical_regions"), inclusion_status(F.col("geometry_status"), ("ALIGNED", "ALIGNED_WITH_WARNING")).alias("geometry_status"), inclusion_status(F.col("content_status"), ("RECOGNIZED", "BLANK")).alias("content_status"),
    )
    summed = items.groupBy("document_id").agg(
        *[F.sum(c).alias(c) for c in ("expected_slots", "recognized_slots", "blank_slots", "unresolved_slots")],
        F.count(F.lit(1)).alias("items"), F.count_if(F.col("answer_status") == "COMPLETE").alias("items_complete"),
    )
    asked = expected.groupBy("document_id").agg(F.count(F.lit(1)).alias("items_expected"))
    faults = checked.groupBy("document_id").agg(F.array_sort(F.collect_set("fault")).alias("faults"))
    out = asked.join(summed, "document_id", "left").join(stages, "document_id", "left").join(faults, "document_id", "left")
    ready = (F.col("items_complete") == F.col("items_expected")) & (F.size("faults") == 0) & (F.col("geometry_status") == "COMPLETE") & (F.col("content_status") == "COMPLETE")
    done = F.col("recognized_slots") + F.col("blank_slots")
    return out.withColumn("completion_rate", ratio(done, F.col("expected_slots"))).withColumn("production_ready", F.coalesce(ready, F.lit(False)))


def answer_summary(parts: DataFrame) -> DataFrame:
    """(document_id, total_logical_slots, answers_extracted, blank_slots, unresolved_slots, content): per slot by the set of its regions' statuses, fragments not counted twice."""
    slot = parts.groupBy("document_id", "item_id", "slot_id").agg(F.bool_and(F.col("content_status") == "RECOGNIZED").alias("r"), F.bool_and(F.col("content_status") == "BLANK").alias("b"))
    counts = slot.groupBy("document_id").agg(F.count(F.lit(1)).alias("total_logical_slots"), F.count_if("r").alias("answers_extracted"), F.count_if("b").alias("blank_slots"), F.count_if(~F.col("r") & ~F.col("b")).alias("unresolved_slots"))
    kinds = parts.groupBy("document_id", "content_status").agg(F.count(F.lit(1)).alias("n"))
    kinds = kinds.groupBy("document_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("content_status", "n")))).alias("content"))
    return counts.join(kinds, "document_id")


def retry_plan(checked: DataFrame, expected: DataFrame, pages: DataFrame) -> DataFrame:
    """(document_id, item_id, reason, mode) of what to ask for again: items with a fault or missing; the whole page if over half of a document's items are, else each alone."""
    bad = checked.filter("fault is not null").select("document_id", "item_id", F.col("fault").alias("reason"))
    missing = expected.select("document_id", "item_id").join(checked.select("document_id", "item_id"), ["document_id", "item_id"], "left_anti").withColumn("reason", F.lit("MISSING_VISUAL_ITEMS"))
    again = bad.unionByName(missing).join(pages.select("document_id").distinct(), "document_id", "left_semi")
    share = again.groupBy("document_id").agg(F.count(F.lit(1)).alias("k_")).join(expected.groupBy("document_id").agg(F.count(F.lit(1)).alias("n_")), "document_id")
    return again.join(share, "document_id").select("document_id", "item_id", "reason", F.when(F.col("k_") * 2 > F.col("n_"), "page").otherwise("item").alias("mode"))
