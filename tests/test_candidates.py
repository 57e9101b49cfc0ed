import json
import math
import random

import pytest
from pyspark.sql import functions as F

from leafline import run as runs
from leafline.operators import candidates
from leafline.plans import catalog


def test_contexts():
    assert candidates.answer_contexts("The sum is ____ and (  ) more.", 3) == [("The sum is", "and (  ) more."), ("The sum is ____ and", "more."), ("The sum is ____ and (  ) more.", "")]
    assert candidates.answer_contexts(None, 1) == [("", "")]


def test_clusters():
    boxes = [[0, 0, 10, 10], [20, 0, 30, 10], [0, 15, 10, 25], [500, 500, 510, 510]]
    assert candidates.writing_clusters(boxes, 10) == [[0, 1, 2], [3]]
    ranked = candidates.ranked_clusters([(b, 0.5) for b in boxes], [0, 0, 30, 30], 10)
    assert ranked[0][1:] == ([0, 0, 30, 25], [0, 1, 2])
    assert candidates.writing_clusters([], 10) == []


def test_scored_candidates(spark):
    slots = spark.createDataFrame([("s", 1, [100.0, 100.0, 200.0, 120.0], [0.0, 0.0, 400.0, 400.0], None, "fill", False, False)], "slot_id string, page int, proposal array<double>, domain array<double>, stem array<double>, kind string, multi_line boolean, broad_hint boolean")
    blocks = spark.createDataFrame([
        (1, 0, [100.0, 100.0, 200.0, 120.0], "answer", 0.9, False, False, 0.0), (1, 1, [110.0, 100.0, 130.0, 120.0], "1.", None, False, False, 0.0), (1, 2, [900.0, 900.0, 910.0, 910.0], "far", 0.9, False, False, 0.0),
        (1, 3, [150.0, 100.0, 190.0, 120.0], "A. option", 0.9, True, True, 0.5),
    ], "page int, block_ord int, block_box array<double>, text string, confidence double, printed boolean, foreign_printed boolean, excluded double")
    got = {r["block_ord"]: r for r in candidates.scored_candidates(slots, blocks).collect()}
    assert set(got) == {0, 1, 3} and got[0]["eligible"]
    assert got[0]["score"] == pytest.approx(0.50 + 0.22 + 0.18 * 0.9 + 0.10 + 0.10 * 150 / 400, abs=1e-4)
    assert got[1]["rejection_reasons"] == ["STRUCTURAL_MARKER"]
    assert got[3]["rejection_reasons"] == ["OTHER_ITEM_PRINTED_TEXT", "PRINTED_OPTION_FOR_OTHER_ITEM", "PRINTED_EXCLUSION_OVERLAP"]
    merged = candidates.scored_candidates(slots, blocks.withColumn("merged", F.col("block_ord") == 0)).filter("block_ord = 0").first()
    assert merged["rejection_reasons"] == ["MERGED_PRINTED_AND_ANSWER_OCR_BOX"] and not merged["eligible"]
    both = candidates.scored_candidates(slots, blocks).join(slots.select("slot_id", "proposal"), "slot_id")
    assert candidates.best_clusters(both, 10.0).first()["block_ords"] == [0]


def test_scored_candidates_query(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, i % 3, [rng.uniform(-0.9, 0.9) for _ in range(2)] + [rng.uniform(-0.5, 0.5) for _ in range(2)]) for i in range(90)]
    spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    rows = [tuple(r) for r in spark.read.parquet(f"{tmp_path}/embeddings.parquet").collect()]
    found = {}
    for i, label, v in rows:
        a, b, c, d = (round(abs(x) * 1000, 3) for x in v)
        found[i] = (label, [a, b, a + c + 1, b + d + 1])
    area = lambda q: max(0, q[2] - q[0]) * max(0, q[3] - q[1])
    inside = lambda q, r: area([max(q[0], r[0]), max(q[1], r[1]), min(q[2], r[2]), min(q[3], r[3])]) / max(1, area(q))
    want = {}
    for s, (page, p) in found.items():
        w, h = p[2] - p[0], p[3] - p[1]
        for k, (other, q) in found.items():
            cx, cy = (q[0] + q[2]) / 2, (q[1] + q[3]) / 2
            near, holds, centred = inside(q, [p[0] - w, p[1] - h, p[2] + w, p[3] + h]), inside(q, p), p[0] <= cx <= p[2] and p[1] <= cy <= p[3]
            if page != other or near < 0.15 or inside(q, [0, 0, 1654, 2338]) < 0.40 or cx > 1654 or cy > 2338 or not (centred or holds >= 0.08):
                continue
            far = math.hypot(cx - (p[0] + p[2]) / 2, cy - (p[1] + p[3]) / 2) / max(1, math.hypot(w, h))
            score = 0.50 * min(1, holds) + 0.22 * max(0, 1 - far) + 0.18 * 0.9 + 0.10 * centred + 0.10 * min(1, cx / 1654) - 0.22 * (k % 9 == 0)
            want[str(s), k] = (page, score, not ((q[2] - q[0]) / 1654 > 0.70 and holds < 0.35))
    got = catalog.QUERIES["q57_scored_candidates"](spark, str(tmp_path)).collect()
    assert {int(r["slot_id"]) for r in got} == set(found) and len(got) == len(want)
    assert {(r["slot_id"], r["block_ord"]): (r["page"], r["score"], r["eligible"]) for r in got} == {k: (v[0], pytest.approx(v[1], abs=1e-4), v[2]) for k, v in want.items()}


def test_votes(spark):
    pixels = spark.createDataFrame([(1, s, x, 0, 10.0 * s, x == 0 or s == 1) for s in range(1, 5) for x in (0, 1)], "page int, sheet int, x int, y int, value double, ink boolean")
    assert {r["x"]: (r["votes"], r["stable"], r["brightness"]) for r in candidates.cohort_votes(pixels).collect()} == {0: (4, True, 32.5), 1: (1, False, 32.5)}
    assert [r[0] for r in spark.createDataFrame([(0,), (1,), (9,)], "n int").select(candidates.cohort_confidence(F.col("n"))).collect()] == [0.0, pytest.approx(0.64), 0.95]


def test_run(spark, tmp_path):
    region = {"answer_bbox": [0, 0, 10, 10], "transcription": "x", "legible": True, "content_kind": "handwriting", "confidence": 0.9}
    slot = {"index": 1, "label": "answer_part", "anchor_before": "", "anchor_after": "", "regions": [region], "confidence": 0.9}
    response = json.dumps({"items": [{"item_id": "a", "page_index": 1, "answer_layout": "single", "slots": [slot], "confidence": 0.9}]})
    spark.createDataFrame([("d1", 1, 100, 100, response), ("d2", 1, 100, 100, response)], "document_id string, page_index int, width int, height int, response string").write.parquet(f"{tmp_path}/pages")
    spark.createDataFrame([("m", "d1", "a", "fill", 1), ("m", "d2", "a", "fill", 1), ("m", "d2", "b", "fill", 1), ("x", "d3", "a", "fill", 1)], "subject string, document_id string, item_id string, item_type string, expected_slot_count int").write.parquet(f"{tmp_path}/expected")
    config = runs.RunConfig(f"{tmp_path}/pages", f"{tmp_path}/expected", f"{tmp_path}/out", subject="m", fail_on_review=True)
    row = runs.run(spark, config)
    assert (row["documents"], row["ready"], row["failed"], row["needing_review"]) == (2, 1, 0, 1)
    assert runs.exit_status(row, config) == 2
    with pytest.raises(Exception):
        runs.run(spark, config)
    everything = runs.RunConfig(config.pages, config.expected, config.out, overwrite=True)
    assert runs.exit_status(runs.run(spark, everything), everything) == 1
    with pytest.raises(ValueError):
        runs.RunConfig("", "", "", limit=0)
    assert set(runs.doctor()) >= {"cv2", "numpy"}


def test_eligible_is_told_without_the_list_of_reasons(spark):
    slots = spark.createDataFrame([("s", 1, [0.0, 0.0, 50.0, 20.0], [0.0, 0.0, 200.0, 200.0], None, "fill", False, False)], "slot_id string, page int, proposal array<double>, domain array<double>, stem array<double>, kind string, multi_line boolean, broad_hint boolean")
    rows = [(1, n, [5.0, 2.0, 30.0, 18.0], text, 0.9, False, None, 0.0) for n, text in enumerate(["x", "3.", "A. x"])]
    blocks = spark.createDataFrame(rows, "page int, block_ord int, block_box array<double>, text string, confidence double, printed boolean, foreign_printed boolean, excluded double")
    out = candidates.scored_candidates(slots, blocks)
    assert {r["block_ord"]: (r["eligible"], r["rejection_reasons"]) for r in out.collect()} == {0: (True, []), 1: (False, ["STRUCTURAL_MARKER"]), 2: (False, ["PRINTED_OPTION_FOR_OTHER_ITEM"])}
    assert "STRUCTURAL_MARKER" not in out.select("slot_id", "block_ord", "eligible")._jdf.queryExecution().optimizedPlan().toString()
