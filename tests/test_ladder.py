import json

import pytest
from pyspark.sql import functions as F

from leafline import store
from leafline.operators import ladder
from leafline.sources import providers

EXPECTED = "document_id string, page_index int, item_id string, item_ord int, item_type string, expected_slot_count int"


def region(text="x", kind="handwriting", box=(0, 0, 500, 100)):
    return {"answer_bbox": list(box), "transcription": text, "legible": True, "content_kind": kind, "confidence": 0.9}


def item(item_id, page=1, regions=None, label="answer_part", layout="single", count=1, **other):
    slots = [{"index": i + 1, "label": label, "anchor_before": "", "anchor_after": "", "regions": [region()] if regions is None else regions, "confidence": 0.9} for i in range(count)]
    return {"item_id": item_id, "page_index": page, "answer_layout": layout, "slots": slots, "confidence": 0.9} | other


@pytest.fixture
def asked(spark):
    rows = [("d", 1, "a", 0, "fill", 1), ("d", 1, "b", 1, "fill", 2), ("d", 2, "c", 2, "essay", None), ("e", 1, "a", 0, "fill", 1)]
    return spark.createDataFrame(rows, EXPECTED)


class Model:
    """Recorded answers, and the keys that were asked for in order."""

    def __init__(self, spark, answers):
        self.keys = []
        self.table = spark.createDataFrame([(k, None if v is None else v if isinstance(v, str) else json.dumps({"items": v})) for k, v in answers.items()], "key string, response string")

    def __call__(self, requests):
        self.keys.append(sorted(r["key"] for r in requests.collect()))
        return providers.replayed(requests, self.table)


def test_each_rung_asks_for_what_is_open(spark, asked, tmp_path):
    folder = f"file://{tmp_path}/ladder"
    answers = {
        "d/1/1": [item("a")],  # lacks b
        "d/1/2": [item("a"), item("b")],  # b has one slot of two
        "d/1/3/a": [item("a", regions=[])],
        "d/1/3/b": "no json",
        "d/2/1": [item("c", page=2, label="proof_response", regions=[region("", "blank")])],
        "d/1/4/a": [item("a", regions=[region("late")])],
        "d/2/4/c": [item("c", page=2, regions=[])],
        "e/1/2": [item("a")],
    }
    model = Model(spark, answers)
    done = ladder.climb(asked, model, folder)
    assert model.keys == [["d/1/1", "d/2/1", "e/1/1"], ["d/1/2", "e/1/2"], ["d/1/3/a", "d/1/3/b"], ["d/1/4/a", "d/2/4/c"]]
    got = {r["key"]: (r["status"], r["reason"]) for r in done.collect()}
    assert got == {
        "d/1/1": ("FAILED", "MISSING_VISUAL_ITEMS"), "d/1/2": ("FAILED", "TEACHER_TOPOLOGY_CONFLICT"), "d/1/3/a": ("ACCEPTED", None), "d/1/3/b": ("FAILED", "INVALID_VISUAL_EXTRACTION_RESPONSE"),
        "d/2/1": ("ACCEPTED", None), "d/1/4/a": ("ACCEPTED", None), "d/2/4/c": ("EMPTY", None), "e/1/1": ("FAILED", "VISUAL_EXTRACTION_BACKEND_ERROR"), "e/1/2": ("ACCEPTED", None),
    }
    best = {(r["document_id"], r["item_id"]): (r["rung"], [x["transcription"] for s in r["item"]["slots"] for x in s["regions"]]) for r in ladder.accepted(done).collect()}
    assert best == {("d", "a"): (4, ["late"]), ("d", "c"): (1, [""]), ("e", "a"): (2, ["x"])}
    pages = {(r["document_id"], r["page_index"]): (r["status"], r["calls"], r["retries"]) for r in ladder.page_statuses(done, asked).collect()}
    assert pages == {("d", 1): ("PARTIAL", 5, 4), ("d", 2): ("ACCEPTED", 2, 1), ("e", 1): ("ACCEPTED", 2, 1)}
    again = Model(spark, {"d/1/1": [item("a"), item("b")]})
    assert sorted(map(str, ladder.climb(asked, again, folder).collect())) == sorted(map(str, done.collect()))
    assert again.keys == []
    assert ladder.calls(done).first().asDict() == {"page_calls": 9, "page_retries": 6, "failed": 4, "empty": 1, "accepted": 4}


def test_a_run_broken_off_goes_on(spark, asked, tmp_path):
    folder = f"file://{tmp_path}/ladder"
    answers = {"d/1/1": [], "d/1/2": [item("a"), item("b", count=2)], "d/2/1": [item("c", page=2)], "e/1/1": [item("a")]}

    class Broken(Exception):
        pass

    first = Model(spark, answers)

    def breaking(requests):
        if first.keys:
            raise Broken
        return first(requests)

    with pytest.raises(Broken):
        ladder.climb(asked, breaking, folder)
    second = Model(spark, answers)
    done = ladder.climb(asked, second, folder)
    assert second.keys == [["d/1/2"]]
    assert {r["status"] for r in ladder.page_statuses(done, asked).collect()} == {"ACCEPTED"}
    more = asked.unionByName(spark.createDataFrame([("f", 1, "z", 0, "fill", 1)], EXPECTED))
    third = Model(spark, {"f/1/1": [item("z")]})
    ladder.climb(more, third, folder)
    assert third.keys == [["f/1/1"]]  # new work alone


@pytest.mark.parametrize(("found", "reason"), [
    ([item("a"), item("a"), item("b", count=2)], "UNKNOWN_OR_DUPLICATE_VISUAL_ITEM"), ([item("zz")], "UNKNOWN_OR_DUPLICATE_VISUAL_ITEM"), ([item("a", page=3)], "VISUAL_PAGE_ID_MISMATCH"),
    ([item("a", layout="round"), item("zz")], "INVALID_VISUAL_ANSWER_LAYOUT"), ([item("a", regions=[region(box=(9, 0, 1, 1))])], "INVALID_VISUAL_BOX"), ([item("a"), item("b", count=2, confidence=7)], "INVALID_VISUAL_ITEM_CONFIDENCE"),
    ("[]", "INVALID_VISUAL_EXTRACTION_RESPONSE"), (None, "VISUAL_EXTRACTION_BACKEND_ERROR"),
])
def test_the_first_reason_counts(spark, asked, found, reason):
    page = asked.filter("document_id = 'd' and page_index = 1").select("document_id", "page_index").distinct().withColumn("reason", F.lit(None).cast("string"))
    requests = ladder.requests(page, asked, 1, "page")
    assert json.loads(requests.first()["prompt"])["items"][1]["expected_slot_count"] == 2
    assert ladder.outcomes(requests, Model(spark, {"d/1/1": found})(requests), asked).first()["reason"] == reason


def test_parts_count_once_they_are_written(spark, tmp_path):
    folder = f"file://{tmp_path}/parts"
    store.put(spark.range(3), folder, "one")
    (tmp_path / "parts" / "two").mkdir()
    assert store.parts(spark, folder) == ["one"]
    assert store.get(spark, folder, "id bigint").count() == 3
    assert store.get(spark, f"{folder}/none", "id bigint").count() == 0
