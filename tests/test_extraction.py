import json

from leafline.operators import evaluation, extraction

EXPECTED = "document_id string, item_id string, item_type string, expected_slot_count int"
PAGES = "document_id string, page_index int, width int, height int, response string"


def region(text="x", kind="handwriting", legible=True, confidence=0.9, box=(0, 0, 500, 100)):
    return {"answer_bbox": list(box), "transcription": text, "legible": legible, "content_kind": kind, "confidence": confidence}


def slot(index, *regions, label="blank_response", confidence=0.9):
    return {"index": index, "label": label, "anchor_before": "", "anchor_after": "", "regions": list(regions), "confidence": confidence}


def item(name, *slots, layout="single", confidence=0.9):
    return {"item_id": name, "page_index": 1, "answer_layout": layout, "slots": list(slots), "confidence": confidence}


def page(doc, *items, index=1):
    return (doc, index, 1001, 2000, json.dumps({"items": list(items)}))


def test_faults_in_order(spark):
    expected = spark.createDataFrame([("d", n, "fill", c) for n, c in (("ok", 1), ("layout", 1), ("count", 2), ("order", 1), ("box", 1), ("kind", 1), ("none", 0))] + [("d", "one", "choice", None)], EXPECTED)
    pages = spark.createDataFrame([page(
        "d", item("ok", slot(1, region())), item("layout", slot(1), layout="odd"), item("count", slot(1)), item("order", slot(2)), item("box", slot(1, region(box=(5, 5, 5, 9)))),
        item("kind", slot(1, region(kind="odd"))), item("none"), item("one", slot(1), slot(2)), item("other", slot(1)),
    )], PAGES)
    got = {r["item_id"]: r["fault"] for r in extraction.item_faults(extraction.items_of(pages), expected).collect()}
    assert got == {
        "ok": None, "layout": "INVALID_VISUAL_ANSWER_LAYOUT", "count": "TEACHER_TOPOLOGY_CONFLICT", "order": "INVALID_VISUAL_SLOT_ORDER", "box": "INVALID_VISUAL_BOX",
        "kind": "INVALID_VISUAL_REGION_VALUE", "none": "INVALID_VISUAL_SLOT_COUNT", "one": "SINGLE_RESPONSE_REQUIRED", "other": "UNKNOWN_VISUAL_ITEM",
    }


def test_parts_and_merging(spark):
    pages = spark.createDataFrame([
        page("d", item("a", slot(1, region("one", box=(0, 0, 500, 100))), slot(2)), item("b", slot(1, region(" ", kind="blank")))),
        page("d", item("a", slot(1, region("two", confidence=0.5))), item("c", slot(1, region("?", legible=False))), index=2),
    ], PAGES)
    parts = extraction.parts_of(extraction.items_of(pages))
    got = {(r["slot_id"], r["page_index"]): (r["content_status"], r["geometry_status"], r["box"]) for r in parts.collect()}
    assert got[("a:slot:1", 1)] == ("RECOGNIZED", "ALIGNED", [0, 0, 500, 200])  # 500.5 to even
    assert got[("a:slot:2", 1)][:2] == ("BLANK", "MISSING")
    assert got[("a:slot:1", 2)][1] == "ALIGNED_WITH_WARNING"
    assert got[("b:slot:1", 1)][0] == "BLANK" and got[("c:slot:1", 2)][0] == "VLM_UNCERTAIN"
    merged = {r["slot_id"]: (r["text"], r["status"]) for r in extraction.merged_parts(parts).collect()}
    assert merged == {"a:slot:1": ("one\ntwo", "RECOGNIZED"), "a:slot:2": (None, "BLANK"), "b:slot:1": (None, "BLANK"), "c:slot:1": (None, "UNRESOLVED")}
    assert {r["item_id"]: r["answer"] for r in extraction.answers(extraction.merged_parts(parts)).collect()}["a"] == ["one\ntwo", None]
    summary = extraction.answer_summary(parts).first()
    assert (summary["total_logical_slots"], summary["answers_extracted"], summary["blank_slots"], summary["unresolved_slots"]) == (4, 1, 2, 1)
    assert summary["content"] == {"BLANK": 2, "RECOGNIZED": 2, "VLM_UNCERTAIN": 1}


def test_readiness_and_retries(spark):
    expected = spark.createDataFrame([("good", "a", "fill", 1), ("short", "a", "fill", 1), ("short", "b", "fill", 1), ("bad", "a", "fill", 1), ("none", "a", "fill", 1)], EXPECTED)
    pages = spark.createDataFrame([page("good", item("a", slot(1, region()))), page("short", item("a", slot(1, region()))), page("bad", item("a", slot(1), layout="odd"))], PAGES)
    out = {r["document_id"]: r for r in extraction.readiness(pages, expected).collect()}
    assert {k: r["production_ready"] for k, r in out.items()} == {"good": True, "short": False, "bad": False, "none": False}
    assert out["good"]["completion_rate"] == 1.0 and out["bad"]["faults"] == ["INVALID_VISUAL_ANSWER_LAYOUT"]
    plan = extraction.retry_plan(extraction.item_faults(extraction.items_of(pages), expected), expected, pages)
    assert {(r["document_id"], r["item_id"], r["reason"], r["mode"]) for r in plan.collect()} == {("short", "b", "MISSING_VISUAL_ITEMS", "item"), ("bad", "a", "INVALID_VISUAL_ANSWER_LAYOUT", "page")}


def test_evaluation(spark):
    slots = "case_id string, item_id string, slot_id string, page_index int, ord int, box array<double>, text string"
    box, half = [0.0, 0.0, 10.0, 10.0], [0.0, 0.0, 10.0, 4.0]
    truth = spark.createDataFrame([("c", "i", "s", 1, 0, box, "A"), ("c", "i", "s", 1, 1, box, "B"), ("c", "i", "t", 7, 2, box, "x")], slots)
    found = spark.createDataFrame([("c", "i", "s", 1, 0, half, "a"), ("c", "i", "s", 1, 1, box, " A"), ("c", "i", "t", 1, 2, box, "x"), ("c", "z", "u", 1, 0, None, None)], slots)
    got = {r["truth_ord"]: (round(r["overlap"], 3), r["text_exact"]) for r in evaluation.match_slots(truth, found).collect()}
    assert got == {0: (1.0, True), 1: (0.4, False)}
    q = spark.createDataFrame([("c", "q1"), ("c", "q2")], "case_id string, question_id string")
    items = spark.createDataFrame([("c", "i", 0, ["a"]), ("c", "i", 1, ["A "])], "case_id string, item_id string, ord int, answer array<string>")
    true_items = spark.createDataFrame([("c", "i", ["A"]), ("c", "j", None)], "case_id string, item_id string, answer array<string>")
    counted = evaluation.counts(q, q.limit(1), true_items, items, truth, found)
    m = evaluation.metrics(counted).first()
    assert (m["question_recall"], m["answer_exact_match"], m["slots_predicted"], m["slots_matched"]) == (0.5, 0.5, 4, 1)
    cases = spark.createDataFrame([("c", "math", None, 2, 3)], "case_id string, subject string, layout string, pages int, cohort_samples int")
    assert {r["label"] for r in evaluation.by_dataset(cases, counted).collect()} == {"subject=math", "layout=None", "pages=2", "cohort_samples=3"}
    contexts = spark.createDataFrame([("c", "i", 1, [0.0, 0.0, 100.0, 100.0])], "case_id string, item_id string, page_index int, context_box array<double>")
    assert tuple(evaluation.context_recall(truth, contexts).first()) == ("c", 3, 2)
    empty = evaluation.metrics(evaluation.counts(q.limit(0), q.limit(0), true_items.limit(0), items.limit(0), truth.limit(0), found.limit(0)))
    assert empty.collect() == []
