"""Asking a model for a document's items page by page, and again only for what is still open.

A ladder has four kinds of rungs: a page is asked up to a bounded number of times, each time told the reason of the last
failure; a page that failed is asked item by item; items that came back without an answer are asked alone once more.
Attempts are kept in a store, a part per rung, known by their key, so a run that was broken off, or is begun again, asks
only what has no recorded answer. Of an item's accepted answers the one of the highest rung counts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leafline import store
from leafline.operators.extraction import ITEM, RESPONSE, item_faults

ATTEMPTS = "key string, document_id string, page_index int, rung int, mode string, asked array<string>, status string, reason string, response string"
#: Labels of long answers: if all their regions are blank, the item is asked once more. Fixed values.
LONG = ("working_response", "proof_response", "formula_response", "short_response")
Ask = Callable[[DataFrame], DataFrame]


def requests(targets: DataFrame, expected: DataFrame, rung: int, mode: str) -> DataFrame:
    """(key, document_id, page_index, rung, mode, asked, prompt) of targets (document_id, page_index, reason), whole pages, or with item_id, single items.

    The prompt is a JSON object of the page, the items asked for, in order, and the reason of the failure before.
    """
    on = ["document_id", "page_index", *(["item_id"] if "item_id" in targets.columns else [])]
    item = F.struct("item_ord", "item_id", "item_type", "expected_slot_count")
    rows = targets.select(*on, "reason").join(expected, on).groupBy("document_id", "page_index", *on[2:], "reason").agg(F.array_sort(F.collect_list(item)).alias("items"))
    key = F.concat_ws("/", "document_id", "page_index", F.lit(rung), *on[2:])
    prompt = F.to_json(F.struct("document_id", "page_index", F.lit(mode).alias("mode"), "items", "reason"))
    return rows.select(key.alias("key"), "document_id", "page_index", F.lit(rung).alias("rung"), F.lit(mode).alias("mode"), F.transform("items", lambda i: i["item_id"]).alias("asked"), prompt.alias("prompt"))


def _empty(item: Column) -> Column:
    """Whether a slot has no region, or is a long answer whose regions are all blank."""
    blank = lambda r: (r["content_kind"] == "blank") & (F.trim(F.coalesce(r["transcription"], F.lit(""))) == "")
    return F.exists(item["slots"], lambda s: (F.size(s["regions"]) == 0) | (s["label"].isin(*LONG) & F.forall(s["regions"], blank)))


def outcomes(asked: DataFrame, answers: DataFrame, expected: DataFrame) -> DataFrame:
    """ATTEMPTS of requests and the answers (key, status, response) of a model.

    The first reason that applies: no answer, one that is no object with items, the first item in order that breaks a
    rule (one that was not asked for or came before, another page, then the rules of item_faults), items that are
    missing. An answer to an empty item without a region again has the status EMPTY.
    """
    met = asked.join(answers.select("key", F.col("status").alias("answered"), "response").dropDuplicates(["key"]), "key", "left").withColumn("r_", F.from_json("response", RESPONSE))
    items = met.select("key", "document_id", "page_index", "asked", F.posexplode("r_.items").alias("item_ord", "item"))
    kinds = expected.select("document_id", "item_id", "item_type", "expected_slot_count").distinct()
    rows = item_faults(items, kinds).withColumn("again_", F.row_number().over(W.partitionBy("key", "item_id").orderBy("item_ord")) > 1)
    fault = (
        F.when(~F.coalesce(F.array_contains("asked", F.col("item_id")), F.lit(False)) | F.col("again_"), "UNKNOWN_OR_DUPLICATE_VISUAL_ITEM")
        .when(~F.col("item.page_index").eqNullSafe(F.col("page_index")), "VISUAL_PAGE_ID_MISMATCH").otherwise(F.col("fault"))
    )
    first = F.min(F.when(fault.isNotNull(), F.struct("item_ord", fault.alias("fault"))))["fault"]
    of_key = rows.groupBy("key").agg(first.alias("fault_"), F.count(F.lit(1)).alias("n_"))
    reason = (
        F.when(~F.col("answered").eqNullSafe(F.lit("OK")), "VISUAL_EXTRACTION_BACKEND_ERROR").when(F.col("r_.items").isNull(), "INVALID_VISUAL_EXTRACTION_RESPONSE")
        .when(F.col("fault_").isNotNull(), F.col("fault_")).when(F.coalesce("n_", F.lit(0)) < F.size("asked"), "MISSING_VISUAL_ITEMS")
    )
    none = ~F.exists("r_.items", lambda i: F.exists(i["slots"], lambda s: F.size(s["regions"]) > 0))
    status = F.when(F.col("reason").isNotNull(), "FAILED").when((F.col("mode") == "empty_region_focus_retry") & none, "EMPTY").otherwise("ACCEPTED")
    out = met.join(of_key, "key", "left").withColumn("reason", reason).withColumn("status", status)
    return out.select("key", "document_id", "page_index", "rung", "mode", "asked", "status", "reason", "response")


def accepted(attempts: DataFrame) -> DataFrame:
    """(document_id, page_index, item_id, rung, item) of the highest rung at which each item was accepted."""
    rows = attempts.filter("status = 'ACCEPTED'").select("document_id", "page_index", "rung", F.explode(F.from_json("response", RESPONSE)["items"]).alias("item"))
    best = rows.groupBy("document_id", "page_index", F.col("item.item_id").alias("item_id")).agg(F.max("rung").alias("rung"), F.max_by("item", "rung").alias("item"))
    return best.withColumn("item", F.col("item").cast(ITEM))


def climb(expected: DataFrame, ask: Ask, folder: str, page_attempts: int = 2) -> DataFrame:
    """ATTEMPTS of a whole ladder over expected (document_id, page_index, item_id, item_ord, item_type, expected_slot_count); `ask` answers requests (key, prompt).

    page_attempts is kept within 1 and 3. Every rung is written before the next is looked at, which reads it back.
    """
    spark, n = expected.sparkSession, max(1, min(3, page_attempts))
    mode_of = {**{r: "page" for r in range(1, n + 1)}, n + 1: "item_focus_retry", n + 2: "empty_region_focus_retry"}
    pages = expected.select("document_id", "page_index").distinct().withColumn("reason", F.lit(None).cast("string"))
    done = store.get(spark, folder, ATTEMPTS, [])
    for rung, mode in mode_of.items():
        if mode == "page":
            last = done.filter(F.col("rung") == rung - 1)
            targets = pages if rung == 1 else last.filter("status = 'FAILED'").select("document_id", "page_index", "reason")
        elif mode == "item_focus_retry":
            failed = done.filter((F.col("rung") == n) & (F.col("status") == "FAILED")).select("document_id", "page_index", "reason")
            targets = failed.join(expected.select("document_id", "page_index", "item_id"), ["document_id", "page_index"])
        else:
            targets = accepted(done).filter(_empty(F.col("item"))).select("document_id", "page_index", "item_id", F.lit("EMPTY_VLM_ANSWER_REGION").alias("reason"))
        asked, part = requests(targets, expected, rung, mode), f"rung={rung}"
        known = [p for p in store.parts(spark, folder) if p.split(".")[0] == part]
        recorded = store.get(spark, folder, ATTEMPTS, known).dropDuplicates(["key"])
        open_ = asked.join(recorded.select("key"), "key", "left_anti") if known else asked
        if not open_.isEmpty():
            store.put(outcomes(open_, ask(open_.select("key", "prompt")), expected), folder, f"{part}.{len(known)}")
        names = [p for p in store.parts(spark, folder) if int(p.split(".")[0].split("=")[1]) <= rung]
        done = store.get(spark, folder, ATTEMPTS, names).dropDuplicates(["key"])
    return done


def page_statuses(attempts: DataFrame, expected: DataFrame) -> DataFrame:
    """(document_id, page_index, status, calls, retries, items, accepted_items): ACCEPTED with all items of a page, PARTIAL with some, UNRESOLVED with none."""
    on = ["document_id", "page_index"]
    wanted = expected.groupBy(*on).agg(F.count(F.lit(1)).alias("items"))
    made = attempts.groupBy(*on).agg(F.count(F.lit(1)).alias("calls"), F.count_if(F.col("rung") > 1).alias("retries"))
    got = accepted(attempts).groupBy(*on).agg(F.count(F.lit(1)).alias("accepted_items"))
    out = wanted.join(made, on, "left").join(got, on, "left").fillna(0, ["calls", "retries", "accepted_items"])
    status = F.when(F.col("accepted_items") == 0, "UNRESOLVED").when(F.col("accepted_items") < F.col("items"), "PARTIAL").otherwise("ACCEPTED")
    return out.withColumn("status", status)


def calls(attempts: DataFrame) -> DataFrame:
    """One row: page_calls, page_retries and failed attempts of all rungs, and how often each was accepted."""
    return attempts.agg(
        F.count(F.lit(1)).alias("page_calls"), F.count_if(F.col("rung") > 1).alias("page_retries"), F.count_if(F.col("status") == "FAILED").alias("failed"),
        F.count_if(F.col("status") == "EMPTY").alias("empty"), F.count_if(F.col("status") == "ACCEPTED").alias("accepted"),
    )
