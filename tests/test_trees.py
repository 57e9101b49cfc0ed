import difflib
import re

import pytest
from pyspark.sql import functions as F

from leafline.functions import boxes, parsing, text
from leafline.operators import ordering, trees
from leafline.sources import stores


def values(spark, column, *rows):
    df = spark.createDataFrame([(i, *(r if isinstance(r, tuple) else (r,))) for i, r in enumerate(rows)], "i int, a string" + ", b string" * isinstance(rows[0], tuple))
    return [r["out"] for r in df.withColumn("out", column).orderBy("i").collect()]


def test_normal_forms(spark):
    rows = ["Ａ－b × ß", "\\frac{a}{b}", None, "日本 語"]
    assert values(spark, text.folded("a"), *rows) == ["abxß", "fracab", "", "日本語"]
    assert values(spark, text.casefolded("a"), *rows) == ["abss", "fracab", "", "日本語"]
    assert values(spark, text.formula_key("a"), *rows) == ["abß", "ab", "", "日本語"]


def test_fractions(spark):
    rows = ["\\frac{1}{2}", "\\frac{1}", "\\frac{}{2}", "\\dfrac{a+b}{c} - \\tfrac {1}\n{2}", "\\frac{\\frac{1}{2}}{3}", "\\frac{{x}}{y}", "", None]
    got = values(spark, parsing.whole_fractions("a"), *rows)
    assert got == [True, False, False, False, False, True, True, True]  # a command inside another's group counts as broken, as does one that the pattern of cut commands meets


def test_structural_similarity(spark):
    rows = [("5. ", "5、"), ("(1)", "（1）"), ("abcdefgh", "xx abcdefgh"), ("ab", "ab"), ("hello there", "hello where"), ("", "x"), (None, "x"), ("abc", "zabc")]
    got = values(spark, parsing.structural_similarity(F.col("a"), F.col("b")), *rows)
    assert got == [0.92, 0.90, 1.0, 0.0, difflib.SequenceMatcher(None, "hellothere", "hellowhere").ratio(), 0.0, 0.0, 3 / 8]


def test_answer_contexts(spark):
    df = spark.createDataFrame([("a ____ b ( ) c", 3), (None, 1), ("x", 0)], "t string, n int")
    got = [[tuple(x) for x in r["c"]] for r in df.select(parsing.answer_contexts("t", "n").alias("c")).collect()]
    assert got == [[("a", "b ( ) c"), ("a ____ b", "c"), ("a ____ b ( ) c", "")], [("", "")], []]


def test_anchor_scores_by_hand(spark):
    items = [(1, "q1", 3, "The value of x is"), (1, "q2", 4, "Draw a line"), (2, "q1", 3, "Nothing"), (2, "q3", 1, None)]
    blocks = [(1, 0, "3. The value of x is ___"), (1, 1, "4) Draw a lime"), (1, 2, ""), (2, 0, "something else"), (3, 0, "The value")]
    scores = trees.anchor_scores(spark.createDataFrame(items, "page int, item_id string, number int, text string"), spark.createDataFrame(blocks, "page int, block_ord int, text string"), 0.1)
    letters = lambda t: re.sub(r"[\W_]+", "", (t or "").lower())
    want = set()
    for page, item, number, t in items:
        for p, k, b in blocks:
            q, x = letters(t), letters(b)
            if p == page and q and x:
                alike = max(difflib.SequenceMatcher(None, q[:120], x[:120]).ratio(), float(q[:8] in x or x[:8] in q))
                m = re.match(r"\s*(\d{1,3})\s*[.)]", b)
                score = round(0.65 * alike + 0.35 * bool(m and int(m[1]) == number), 6)
                want |= {(page, item, k, score)} if score >= 0.1 else set()
    assert {tuple(r) for r in scores.collect()} == want
    chosen = {(r["page"], r["item_id"], r["block_ord"]) for r in trees.anchored(scores).collect()}
    assert {(1, "q1", 0), (1, "q2", 1)} <= chosen


def test_reading_order_of_many_boxes():
    """A line takes the boxes whose centres are near its own, whatever order they come in; lines go down, boxes to the right."""
    page = [[x * 50, 100 * y + x % 3, x * 50 + 40, 100 * y + 20 + x % 3] for y in (3, 0, 2, 1) for x in (4, 1, 3, 0, 2)]
    order = ordering.rows_in_order([*page, None, [1, 2, 3]])
    assert [tuple(page[i][:1]) + (page[i][1] // 100,) for i in order[:20]] == [(x * 50, y) for y in range(4) for x in range(5)]
    assert order[20:] == [20, 21]
    assert ordering.column_split([], [], 100) == [[]] and ordering.column_split([None] * 7, [""] * 7, 100) == [list(range(7))]


def test_hard_gate_of_a_box_that_is_none(spark):
    df = spark.createDataFrame([(None,), ([1.0, 2.0],), ([5.0, 5.0, 6.0, 6.0],)], "b array<double>")
    got = [r[0] for r in df.select(boxes.hard_gate(F.col("b"), F.lit("fill"), F.lit(100.0), F.lit(100.0))).collect()]
    assert got == [["invalid_or_out_of_bounds"], ["invalid_or_out_of_bounds"], []]


def test_empty_trees(spark):
    empty = lambda schema: spark.createDataFrame([], schema)
    parts = [empty("section_id int, ord int"), empty("section_id int, question_id int, number int, ord int"), empty("question_id int, item_id string, ord int, kind string, expected int, localized int, anchor array<double>, anchor_page int, decision string"), empty("item_id string, slot_idx int, anchor_before string, anchor_after string")]
    report = trees.tree_report(*parts, strict=True)
    assert report.collect() == []
    ready = trees.lock_readiness(report, parts[2].withColumn("semantics", F.lit("ACCEPTED")), parts[3], "COMPLETE").first()
    assert (ready["status"], ready["issues"], ready["ready_to_lock"]) == ("VALID", [], True)


def test_stored_trees(tmp_path):
    path = str(tmp_path / "math_1.json")
    tree = {"subject": "math 1", "sections": [{"section_id": "é"}], "created_at": "now"}
    assert stores.save_tree(tree, path, [], ["STRUCTURE_INCOMPLETE"])["state"] == "DRAFT"
    with pytest.raises(ValueError, match="not locked"):
        stores.load_tree(path)
    assert stores.load_tree(path, draft=True)["subject"] == "math 1"
    saved = stores.save_tree(tree, path, [], [])
    assert saved["state"] == "LOCKED" and stores.load_tree(path, "math 1") == saved
    assert stores.tree_path(str(tmp_path), "math 1") == stores.tree_path(path, "other") and stores.tree_path(str(tmp_path), "art") is None
    with pytest.raises(ValueError, match="not art"):
        stores.load_tree(path, "art")
    stores.write_json(saved | {"sections": []}, path)
    with pytest.raises(ValueError, match="changed"):
        stores.load_tree(path)
    with pytest.raises(ValueError, match="errors"):
        stores.save_tree(tree, path, ["x"], [])


def test_templates_events_and_settings(spark, tmp_path):
    stores.write_template([{"page": 1}, {"page": 2, "t": "é"}], str(tmp_path / "t.json"), "hand")
    assert [r["page"] for r in stores.read_template(spark, str(tmp_path / "t.json")).orderBy("place").collect()] == ['{"page": 1}', '{"page": 2, "t": "é"}']
    (tmp_path / "bad.json").write_text("[]")
    for name in ("bad.json", "none.json"):
        with pytest.raises(ValueError, match="template"):
            stores.read_template(spark, str(tmp_path / name))
    import sqlite3

    with sqlite3.connect(tmp_path / "e.db") as c:
        c.execute("CREATE TABLE hitl_audit_events (item_id TEXT, delta_x REAL, delta_y REAL, delta_w REAL, delta_h REAL)")
        c.executemany("INSERT INTO hitl_audit_events VALUES (?, ?, ?, ?, ?)", [("a", 1, 200, 0, 0), ("a", 3, 200, 0, 4), ("b", 1, 1, 1, 1)])
    profiles = stores.feedback(stores.read_events(spark, str(tmp_path / "e.db")))
    assert {r["item_id"]: (r["delta_x"], r["delta_y"], r["samples"]) for r in profiles.collect()} == {"a": (2.0, 200.0, 2), "b": (1.0, 1.0, 1)}
    assert stores.read_events(spark, str(tmp_path / "none.db")).collect() == []
    slots = spark.createDataFrame([("a", [0.0, 0.0, 10.0, 10.0]), ("z", [0.0, 0.0, 1.0, 1.0])], "item_id string, box array<double>")
    assert {r["item_id"]: r["box"] for r in stores.with_feedback(slots, profiles).collect()} == {"a": [2.0, 80.0, 12.0, 92.0], "z": [0.0, 0.0, 1.0, 1.0]}
    file = tmp_path / "env"
    file.write_text("# NAME=no\nNAME='x'\nOTHER=1\n")
    file.chmod(0o600)
    assert stores.settings(("NAME", "KEY"), str(file), {"KEY": "k", "OTHER": "2"}) == {"NAME": "x", "KEY": "k"}
    file.chmod(0o644)
    with pytest.raises(PermissionError):
        stores.settings(("NAME",), str(file), {})


def test_evaluate_command(spark, tmp_path):
    from leafline import evaluate

    for name in ("truth", "predicted"):
        spark.createDataFrame([("c", "q")], "case_id string, question_id string").write.parquet(f"{tmp_path}/{name}/questions")
        items = spark.createDataFrame([("c", "i", ["A"])], "case_id string, item_id string, answer array<string>")
        (items if name == "truth" else items.withColumn("ord", F.lit(0))).write.parquet(f"{tmp_path}/{name}/items")
        spark.createDataFrame([("c", "i", "s", 1, 0, [0.0, 0.0, 9.0, 9.0], "A")], "case_id string, item_id string, slot_id string, page_index int, ord int, box array<double>, text string").write.parquet(f"{tmp_path}/{name}/slots")
    spark.createDataFrame([("c", "math", "one", 2, 3), ("d", "math", "one", 2, 3)], "case_id string, subject string, layout string, pages int, cohort_samples int").write.parquet(f"{tmp_path}/cases")
    assert evaluate.main(["--truth", f"{tmp_path}/truth", "--predicted", f"{tmp_path}/predicted", "--out", f"{tmp_path}/out", "--cases", f"{tmp_path}/cases"]) == 1
    row = spark.read.json(f"{tmp_path}/out/cases").first()
    assert (row["question_recall"], row["answer_exact_match"], row["slot_recall_iou50"]) == (1.0, 1.0, 1.0)
    assert spark.read.json(f"{tmp_path}/out/groups").count() == 4
