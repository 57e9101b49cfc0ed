"""Extraction held against truth: slots matched by identity and overlap, answers, recall and precision."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leafline.functions import boxes, text
from leafline.operators.aggregates import ratio

MATCHES = "case_id string, item_id string, slot_id string, truth_ord int, overlap double, text_exact boolean"


def _matched(rows: pd.DataFrame) -> pd.DataFrame:
    """Rows of whole keys, sorted by key, true and found place: for each true slot the free found one with the largest overlap."""
    out: list[int] = []
    columns = [rows[c].to_numpy() for c in ("case_id", "item_id", "slot_id", "truth_ord", "pred_ord", "overlap")]
    key, at, best, used = None, None, -1, set()
    for i, (*k, t, p, o) in enumerate(zip(*columns)):
        if (k, t) != (key, at):
            if best >= 0:
                out.append(best)
                used.add(columns[4][best])
            used = used if k == key else set()
            key, at, best = k, t, -1
        if p not in used and (best < 0 or o > columns[5][best]):
            best = i
    return rows.iloc[[*out, best] if best >= 0 else out].drop(columns="pred_ord")


def match_slots(truth: DataFrame, predicted: DataFrame) -> DataFrame:
    """(case_id, item_id, slot_id, truth_ord, overlap, text_exact): for each true slot in order the predicted one of its id and page with the largest overlap, each used once, the first of equals.

    truth and predicted: (case_id, item_id, slot_id, page_index, ord, box, text). Boxes without four sides do not
    match. Ids that one true and one found slot have, as they should, need no choice; only the others go, sorted and
    many ids a batch, through Python.
    """
    t = truth.select("case_id", "item_id", "slot_id", "page_index", F.col("ord").alias("truth_ord"), F.col("box").alias("truth_box"), F.col("text").alias("truth_text"))
    p = predicted.filter(F.size("box") == 4).select("case_id", "item_id", "slot_id", "page_index", F.col("ord").alias("pred_ord"), "box", F.col("text").alias("pred_text"))
    exact = F.coalesce(text.compact(F.col("pred_text")) == text.compact(F.col("truth_text")), F.lit(False)) & F.col("pred_text").isNotNull() & F.col("truth_text").isNotNull()
    key = ["case_id", "item_id", "slot_id"]
    pairs = t.join(p, [*key, "page_index"]).select(*key, "truth_ord", "pred_ord", boxes.iou(F.col("box"), F.col("truth_box")).alias("overlap"), exact.alias("text_exact"))
    pairs = pairs.withColumn("n_", F.count(F.lit(1)).over(W.partitionBy(*key)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for rows in batches:
            rows = rows if held is None else pd.concat([held, rows], ignore_index=True)
            last = (rows[key] == rows[key].iloc[-1]).all(axis=1) if len(rows) else pd.Series([], dtype=bool)
            held = rows[last].reset_index(drop=True)  # its key may go on in the next batch
            yield _matched(rows[~last].reset_index(drop=True))
        if held is not None and len(held):
            yield _matched(held)

    many = pairs.filter("n_ > 1").drop("n_").repartition(*key).sortWithinPartitions(*key, "truth_ord", "pred_ord")
    one = pairs.filter("n_ = 1").select(*key, "truth_ord", "overlap", "text_exact")
    return one.unionByName(many.mapInPandas(run, MATCHES))


def counts(true_questions: DataFrame, questions: DataFrame, true_items: DataFrame, items: DataFrame, true_slots: DataFrame, slots: DataFrame) -> DataFrame:
    """Counts per case. questions: (case_id, question_id); items: (case_id, item_id, answer array<string>); slots as in match_slots().

    Of predicted items with one id the last by `ord` counts. All predicted slots count, those of unknown items too.
    """
    key = ["case_id"]
    last = items.groupBy("case_id", "item_id").agg(F.max_by("answer", "ord").alias("given"))
    met = true_items.join(last, ["case_id", "item_id"], "left")
    by = [
        true_questions.join(questions.distinct().withColumn("found_", F.lit(1)), ["case_id", "question_id"], "left").groupBy(*key).agg(F.count(F.lit(1)).alias("questions_expected"), F.count("found_").alias("questions_found")),
        met.groupBy(*key).agg(F.count(F.lit(1)).alias("answers_expected"), F.count_if(text.equal_answers(F.col("given"), F.col("answer"))).alias("answers_exact")),
        true_slots.groupBy(*key).agg(F.count(F.lit(1)).alias("slots_expected")),
        slots.groupBy(*key).agg(F.count(F.lit(1)).alias("slots_predicted")),
        match_slots(true_slots, slots).groupBy(*key).agg(F.count_if(F.col("overlap") >= 0.5).alias("slots_matched"), F.count_if("text_exact").alias("slot_text_exact"), F.avg("overlap").alias("mean_matched_pair_iou"), F.count_if((F.col("overlap") >= 0.5) & F.col("text_exact")).alias("localized_text_exact")),
    ]
    out = by[0]
    for other in by[1:]:
        out = out.join(other, key, "full_outer")
    zero = [c for c in out.columns if c not in ("case_id", "mean_matched_pair_iou")]
    return out.fillna(0, zero)


def metrics(counted: DataFrame) -> DataFrame:
    """Ratios of counts(), null where there is nothing to count."""
    r = lambda a, b: ratio(F.col(a), F.col(b))
    return counted.select(
        "*", r("questions_found", "questions_expected").alias("question_recall"), r("answers_exact", "answers_expected").alias("answer_exact_match"), r("slots_matched", "slots_expected").alias("slot_recall_iou50"),
        r("slots_matched", "slots_predicted").alias("slot_precision_iou50"), r("slot_text_exact", "slots_expected").alias("slot_text_exact_match"), r("localized_text_exact", "slots_matched").alias("transcription_exact_given_localized"),
    )


def by_dataset(cases: DataFrame, counted: DataFrame) -> DataFrame:
    """(label, case_count, counts, ratios) under subject, layout, pages and cohort_samples of cases (case_id, those); cases without counts are `failed` in number on each label."""
    from leafline.operators.aggregates import by_dimension

    names = ["questions_expected", "questions_found", "answers_expected", "answers_exact", "slots_expected", "slots_predicted", "slots_matched"]
    rows = by_dimension(cases.join(counted, "case_id"), ["subject", "layout", "pages", "cohort_samples"], {n: F.col(n) for n in names})
    r = lambda a, b: ratio(F.col(a), F.col(b))
    return rows.select("*", r("questions_found", "questions_expected").alias("question_recall"), r("answers_exact", "answers_expected").alias("answer_exact_match"), r("slots_matched", "slots_expected").alias("slot_recall_iou50"), r("slots_matched", "slots_predicted").alias("slot_precision_iou50"))


def context_recall(true_slots: DataFrame, contexts: DataFrame) -> DataFrame:
    """(case_id, annotated_regions, context_contains_answer): true slots of which 95 % lies in a search context of their item and page. contexts: (case_id, item_id, page_index, context_box)."""
    keys = ["case_id", "item_id", "page_index"]
    met = true_slots.join(contexts, keys, "left").withColumn("in_", boxes.containment(F.col("box"), F.col("context_box")) >= 0.95)
    slot = met.groupBy("case_id", "item_id", "slot_id", "page_index", "ord").agg(F.coalesce(F.bool_or("in_"), F.lit(False)).alias("in_"))
    return slot.groupBy("case_id").agg(F.count(F.lit(1)).alias("annotated_regions"), F.count_if("in_").alias("context_contains_answer"))
