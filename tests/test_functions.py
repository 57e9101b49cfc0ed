import pytest
from pyspark.sql import functions as F

from leafline.functions import boxes, text


def one(spark, *columns):
    row = spark.range(1).select(*columns).first()
    return row[0] if len(columns) == 1 else tuple(row)


def box(*v):
    return F.array(*[F.lit(None if x is None else float(x)) for x in v]).cast("array<double>")


def test_iou_and_parts(spark):
    a, b = box(0, 0, 10, 20), box(5, 0, 15, 20)
    assert one(spark, boxes.iou(a, b)) == pytest.approx(100 / 300)
    assert one(spark, boxes.overlap_of_smaller(a, b)) == 0.5
    assert one(spark, boxes.containment(box(1, 1, 2, 2), a)) == 1
    assert one(spark, boxes.iou(box(0, 0, 0.1, 0.1), box(0, 0, 0.1, 0.1))) == pytest.approx(0.01)  # union at least 1


@pytest.mark.parametrize(("values", "valid"), [((0, 0, 10, 20), True), ((0, 0, 10), False), ((5, 0, 5, 9), False), ((0, 0, float("nan"), 9), False), ((0, 0, 1655, 9), False), ((-1, 0, 5, 9), False), ((None, 0, 5, 9), False), ((0, 0, float("inf"), 9), False)])
def test_valid_boxes(spark, values, valid):
    assert one(spark, boxes.valid_box(box(*values))) is valid


def test_missing_box(spark):
    assert one(spark, boxes.valid_box(F.lit(None).cast("array<double>"))) is False


def test_nulls_stay_null(spark):
    none = F.lit(None).cast("array<double>")
    assert one(spark, boxes.iou(none, box(0, 0, 1, 1)), boxes.containment(box(0, 0, 1, 1), none), boxes.clamped(F.lit(None).cast("double"), 80.0)) == (None, None, None)


def test_region_reasons_come_in_order(spark):
    w, h = F.lit(100.0), F.lit(100.0)
    assert one(spark, boxes.region_reasons(box(0, 0, 101, 90), F.lit("b"), F.lit("a"), w, h)) == ["WRONG_PAGE", "TOO_LARGE", "OUT_OF_BOUNDS"]
    assert one(spark, boxes.region_reasons(F.lit(None).cast("array<double>"), F.lit("a"), F.lit("a"), w, h)) == ["INVALID_BOX"]
    assert one(spark, boxes.slot_reasons(box(0, 0, 40, 40), F.lit("choice"), w, h)) == ["TOO_WIDE", "TOO_LARGE"]


def test_scaling_rounds_half_to_even(spark):
    size = (F.lit(2.0), F.lit(2.0))
    assert one(spark, boxes.scaled(box(1, 3, 5, 7), size, (F.lit(1.0), F.lit(1.0)))) == [0, 2, 2, 4]


def test_feedback_is_clamped(spark):
    assert one(spark, boxes.shifted(box(0, 0, 10, 10), F.lit(100.0), F.lit(-100.0), F.lit(1.0), F.lit(0.0))) == [80, -80, 91, -70]


@pytest.mark.parametrize(("raw", "want"), [("（ a ）", "A"), ("b、", "B"), ("A,c", "AC"), ("abcd", "ABCD"), ("✔", "✓"), ("Tick", "✓"), ("z", "z"), (None, ""), ("a b", "AB")])
def test_choices(spark, raw, want):
    assert one(spark, text.choice(F.lit(raw).cast("string"))) == want


@pytest.mark.parametrize(("raw", "want"), [("answer: b", "B"), ("A or B", None), ("C)", "C"), ("", None), (None, None), ("√", "✓")])
def test_found_choice(spark, raw, want):
    assert one(spark, text.found_choice(F.lit(raw).cast("string"))) == want


@pytest.mark.parametrize(("raw", "want"), [("page_12.jpg", 12), ("scan-7.png", 7), ("p3", 3), ("x9y2z", 2), ("none", 999999), (None, 999999)])
def test_page_numbers(spark, raw, want):
    assert one(spark, text.page_number(F.lit(raw).cast("string"))) == want


def test_normalisers_differ(spark):
    t = F.lit(" Ａ−１ （题）_ß ")
    assert one(spark, text.compact(t)) == "Ａ-１(题)_ß"
    assert one(spark, text.letters(t)) == "ａ１题ß"
    assert one(spark, text.folded(t)) == "a1题ß"
    assert one(spark, text.ascii_key(F.lit("Q12-b"))) == "12b"
    assert one(spark, text.squeezed(F.lit(" A b\n"))) == "ab"
    assert one(spark, text.answer_key(F.lit("3.0 × 4。"))) == "3*4"
    assert one(spark, text.comparable(F.lit("$\\left( x \\right)$"), F.lit(True))) == "(x)"


def test_balance_similarity_and_answers(spark):
    assert one(spark, text.balanced(F.lit(r"\( ([a]{b}) ")), text.balanced(F.lit("([)]")), text.balanced(F.lit(None).cast("string"))) == (True, False, True)
    assert one(spark, text.similarity(F.lit("abcd"), F.lit("bcde"))) == 0.75
    a = lambda *v: F.array(*[F.lit(x) for x in v]).cast("array<string>")
    assert one(spark, text.equal_answers(a("x ", "（1"), a("x", "(1")), text.equal_answers(a("x", None), a("x", None)), text.equal_answers(a("x"), a("x", "y"))) == (True, False, False)
    assert one(spark, text.overlap(a(), a("x"))) is None
    assert one(spark, text.score_points(F.lit("作文（ 5.5 分）")), text.score_points(F.lit("none"))) == (5.5, None)
    assert one(spark, text.safe_id(F.lit("/a b:c/"))) == "a_b_c"
    assert one(spark, F.size(text.ngrams(F.lit("abcabca"), 4)), F.size(text.ngrams(F.lit("ab"), 4))) == (3, 0)


def test_issues(spark):
    assert one(spark, text.content_issues(F.lit(""), F.lit(0.1), F.lit("fill"), F.lit(""))) == ["EMPTY", "LOW_CONFIDENCE"]
    assert one(spark, text.content_issues(F.lit("printed question…"), F.lit(0.9), F.lit("choice"), F.lit("a printed question… b"))) == ["INVALID_CHOICE", "STEM_TEXT", "TRUNCATED"]
    assert one(spark, text.content_issues(F.lit("(1)"), F.lit(0.9), F.lit("fill"), F.lit("x"))) == ["MARKER_ONLY"]
