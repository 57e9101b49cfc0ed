import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from leafline.functions import boxes
from leafline.operators import aggregates, assignment, joins, ordering, structure, windows


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_null_in_the_middle_breaks_joined_parts(spark):
    df = spark.createDataFrame([("i", 2, "b"), ("i", 1, "a"), ("j", 1, "x"), ("j", 2, None), ("k", 1, None)], "item string, ord int, text string").repartition(3)
    assert rows(aggregates.joined_parts(df, ["item"], ["ord"], "text"), "item") == [("i", 2, "a\nb", "RECOGNIZED"), ("j", 2, None, "UNRESOLVED"), ("k", 1, None, "UNRESOLVED")]


def test_score_levels_fall_back_to_the_declared(spark):
    items = spark.createDataFrame([("q1", 2.0), ("q1", 3.0), ("q2", None)], "q string, score double")
    questions = spark.createDataFrame([("q1", 4.0), ("q2", 7.0), ("q3", None)], "q string, points double")
    out = rows(aggregates.balanced_level(items, questions, "q", "score", "points").select("q", "points", "declared", "repaired"), "q")
    assert out == [("q1", 5.0, 4.0, True), ("q2", 7.0, 7.0, False), ("q3", None, None, False)]


def test_inclusion_status(spark):
    df = spark.createDataFrame([(1, "A"), (1, "B"), (2, "A"), (2, "x"), (3, None), (3, "x")], "k int, s string")
    assert rows(df.groupBy("k").agg(aggregates.inclusion_status(F.col("s"), ("A", "B"))), "k") == [(1, "COMPLETE"), (2, "PARTIAL"), (3, "UNRESOLVED")]


def test_item_status(spark):
    schema = "item string, status string, geometry string, blank_confirmed boolean, text string, expected int"
    df = spark.createDataFrame([
        ("a", "RECOGNIZED", "ALIGNED", None, "x", 1), ("b", "BLANK", "MISSING", True, None, 1), ("c", "BLANK", "MISSING", None, None, 1),
        ("d", "RECOGNIZED", "ALIGNED", None, "x", 3), ("e", "UNRESOLVED", "ALIGNED", None, None, None),
    ], schema)
    out = {r["item"]: (r["answer_status"], r["unresolved_slots"], r["completion_rate"]) for r in aggregates.item_status(df, ["item"], "expected").collect()}
    assert out == {"a": ("COMPLETE", 0, 1.0), "b": ("COMPLETE", 0, 1.0), "c": ("UNRESOLVED", 0, 1.0), "d": ("PARTIAL", 2, pytest.approx(1 / 3)), "e": ("UNRESOLVED", 1, 0.0)}


def test_dimensions_count_each_case_once_per_label(spark):
    df = spark.createDataFrame([("m", None, 1), ("m", "x", 2)], "subject string, layout string, n int")
    assert rows(aggregates.by_dimension(df, ["subject", "layout"], {"n": F.col("n")}), "label") == [("layout=None", 1, 1), ("layout=x", 1, 2), ("subject=m", 2, 3)]


def test_consensus(spark):
    df = spark.createDataFrame([(2, 2, 2), (2, 2, 3), (None, 2, 2), (0, 2, 3), (1, None, 1), (None, None, None)], "a int, b int, c int")
    decision, n = aggregates.consensus(F.col("a"), F.col("b"), F.col("c"))
    assert [tuple(r) for r in df.select(decision, n).collect()] == [("CONSENSUS", 2), ("CONFLICT", None), ("CONSENSUS_TWO_WAY", 2), ("CONFLICT", None), ("INSUFFICIENT", None), ("INSUFFICIENT", None)]


def test_gaps_restart_and_pass_over_nulls(spark):
    df = spark.createDataFrame([("s", i, n) for i, n in enumerate([1, 3, None, 1, 2, 5])], "sec string, ord int, n int").repartition(4)
    assert rows(windows.numbering_gaps(df, ["sec"], ["ord"], "n"), "after") == [("s", 1, 3, [2]), ("s", 2, 5, [3, 4])]


def test_islands_streak_and_prefix(spark):
    df = spark.createDataFrame([("k", i, p) for i, p in enumerate([0, 5, 100, 101, 300])], "k string, ord int, p int")
    assert [r["island"] for r in windows.islands(df, ["k"], ["ord"], F.col("p"), 50).orderBy("ord").collect()] == [0, 0, 1, 1, 2]
    assert windows.streak(df, ["k"], ["ord"], F.col("p"), 50).count() == 2
    fall = spark.createDataFrame([("k", i, n) for i, n in enumerate([1, 2, 2, 9])], "k string, ord int, n int")
    assert [r["n"] for r in windows.rising_prefix(fall, ["k"], ["ord"], "n").orderBy("ord").collect()] == [1, 2]


def test_corridors_bands_placeholders(spark):
    df = spark.createDataFrame([("k", 0.0, 5.0), ("k", 50.0, 55.0)], "k string, top double, bottom double")
    out = windows.corridors(df, ["k"], ["top"], F.col("top"), F.col("bottom"), F.lit(100.0))
    assert rows(out.select("corridor_top", "corridor_bottom"), "corridor_top") == [(0.0, 42.0), (50.0, 100.0)]
    out = windows.bands(df, ["k"], ["top"], F.col("top"), F.col("bottom"), F.lit(-1.0), F.lit(99.0))
    assert rows(out.select("band_low", "band_high"), "band_low") == [(-1.0, 27.5), (27.5, 99.0)]
    expected = spark.createDataFrame([("k", 3), ("z", 0), ("n", None)], "k string, n int")
    assert rows(windows.placeholders(spark.createDataFrame([("k", 2)], "k string, slot int"), expected, ["k"], "slot", "n"), "slot") == [("k", 1), ("k", 3)]


def test_overlapping_finds_each_pair_once_in_any_grid(spark):
    rng = random.Random(1)
    data = [(i, i % 2, [x, y, x + rng.random() * 90 + 1, y + rng.random() * 90 + 1]) for i in range(60) for x, y in [(rng.random() * 200, rng.random() * 200)]]
    df = spark.createDataFrame(data, "id int, page int, box array<double>")
    other = df.select("page", F.col("id").alias("id_2"), F.col("box").alias("box_2"))

    def iou(a, b):
        i = max(0, min(a[2], b[2]) - max(a[0], b[0])) * max(0, min(a[3], b[3]) - max(a[1], b[1]))
        return i / max(1, (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - i)

    want = sorted((a[0], b[0]) for a, b in itertools.combinations(data, 2) if a[1] == b[1] and iou(a[2], b[2]) > 0.1)
    for cell in (7.0, 64.0, 1000.0):
        got = joins.overlapping(df, other, ["page"], "box", boxes.iou, 0.1, cell, keep=F.col("id") < F.col("id_2"))
        assert rows(got.select("id", "id_2"), "id", "id_2") == want


def test_printed_context(spark):
    slots = spark.createDataFrame([("s", 1, [100.0, 0.0, 150.0, 20.0]), ("t", 2, [0.0, 0.0, 1.0, 1.0])], "slot_id string, page int, box array<double>")
    blocks = spark.createDataFrame([(1, "far left", [0.0, 0.0, 30.0, 20.0]), (1, "near left", [40.0, 2.0, 105.0, 22.0]), (1, "right", [145.0, 0.0, 300.0, 20.0]), (1, "below", [40.0, 200.0, 99.0, 220.0])], "page int, text string, block_box array<double>")
    assert rows(joins.printed_context(slots, blocks).select("slot_id", "before", "after"), "slot_id") == [("s", "near left", "right"), ("t", None, None)]


def test_coverage_and_lookup(spark):
    a, b = spark.createDataFrame([(1,), (2,), (2,)], "k int"), spark.createDataFrame([(2,), (3,)], "k int")
    assert rows(joins.coverage(a, b, ["k"]), "missing") == [(1, 1, False)]
    assert rows(joins.coverage(a.limit(0), b.limit(0), ["k"]), "missing") == [(0, 0, True)]
    assert rows(joins.uncovered(a, b, ["k"]), "k") == [(1, "left"), (3, "right")]
    assert rows(joins.lookup(a.distinct(), b, ["k"], "MISSING"), "k") == [(1, "MISSING"), (2, None)]


def test_best_margin_batches(spark):
    df = spark.createDataFrame([("a", 1, 0.9), ("a", 2, 0.9), ("b", 1, 0.8), ("b", 2, 0.1), ("c", 1, 0.3)], "k string, i int, s double")
    assert rows(ordering.best(df, ["k"], F.col("s"), ["i"]).select("k", "i"), "k") == [("a", 1), ("b", 1), ("c", 1)]
    assert rows(ordering.with_margin(df, ["k"], "s", ["i"], 0.5, 0.05).select("k", "i"), "k") == [("b", 1)]
    assert [r["batch"] for r in ordering.batches(spark.range(5), [], ["id"], 2).orderBy("id").collect()] == [0, 0, 1, 1, 2]


def test_reading_order():
    page = [[50, 2, 60, 12], None, [0, 0, 10, 10], [0, 30, 10, 40], [20, 33, 30, 43]]
    assert ordering.rows_in_order(page) == [2, 0, 3, 4, 1]
    assert ordering.rows_in_order([]) == []
    two = [[0, y, 40, y + 10] for y in range(0, 100, 20)] + [[60, y, 100, y + 10] for y in range(0, 100, 20)]
    assert [len(g) for g in ordering.column_split(two, ["long enough"] * 10, 100)] == [0, 5, 5]
    assert len(ordering.column_split(two, ["short"] * 10, 100)) == 1


def test_best_assignment_is_the_best_of_all():
    rng = np.random.default_rng(0)
    for _ in range(60):
        n, m = rng.integers(1, 5, 2).tolist()
        s = np.round(rng.random((n, m)) - 0.3, 2)
        got = sum(s[i, j] for i, j in assignment.best_assignment(s))
        best = max(sum(max(0, s[i, j]) for i, j in enumerate(p) if j < m) for p in itertools.permutations(range(m + n), n))
        assert got == pytest.approx(best)


def test_greedy_ties():
    tied = [(0.5, 0, 0), (0.5, 0, 1), (0.5, 1, 0), (0.4, 1, 1)]
    assert assignment.greedy(tied) == [(0, 0), (1, 1)]
    assert assignment.greedy(tied, larger_first=True) == [(1, 0), (0, 1)]


def test_alignment_parts_merge():
    assert assignment.monotone_alignment(np.array([[5, 1, 9], [9, 9, 0]])) == [(0, 1), (1, 2)]
    assert assignment.monotone_alignment(np.array([[5, 1, 9], [9, 9, 0]]).T) == [(1, 0), (2, 1)]
    assert assignment.contiguous_parts([0.1, 9.0, 0.1], 2) == [0, 2]
    assert assignment.contiguous_parts([], 3) == [0]
    assert assignment.merged_boxes([[0, 0, 10, 10], [1, 0, 11, 10], [50, 0, 60, 10]]) == [[0, 0, 11, 10], [50, 0, 60, 10]]


def test_local_ids(spark):
    df = spark.createDataFrame([("d", 1, 0, 1), ("d", 1, 1, 2), ("d", 2, 2, 1), ("d", 2, 3, 1)], "doc string, sec int, ord int, n int").repartition(3)
    assert [r["local_id"] for r in structure.local_ids(df, ["doc"], "sec", ["ord"], "n").orderBy("ord").collect()] == ["s1_q1", "q2", "s2_q1", "s2_q1_2"]


def test_structure_rules(spark):
    items = spark.createDataFrame([("q", 1, "choice", "A", ["r1"]), ("q", 2, "choice", "B", ["r1", "r2"]), ("p", 1, "fill", "A", [])], "q string, ord int, kind string, label string, refs array<string>")
    assert rows(structure.collapsed_choices(items, ["q"], "ord", "kind", "label", "refs"), "q") == [("p", 1, []), ("q", 1, ["r1", "r2"])]
    df = spark.createDataFrame([('{"k": 1}',), ('{"k": "x"}',), ('{"k": 1, "z": 2}',), ("{}",), ("[1]",), (None,)], "j string")
    assert [r[0] for r in df.select(structure.json_audit(F.col("j"), ["k"], {"k": "int"})).collect()] == [None, "WRONG_TYPE", "UNKNOWN_KEY", "MISSING_KEY", "NOT_OBJECT", "NOT_OBJECT"]


def test_improvement(spark):
    c = lambda *v: [F.lit(x) for x in v]
    out = spark.range(1).select(aggregates.improved(c(1, 2, -3), c(1, 2, -2)), aggregates.improved(c(1, 2, -3), c(2, 1, 0)), aggregates.improved(c(1, 2, -3), c(1, 2, -3))).first()
    assert tuple(out) == (True, False, False)


def test_empty_tables(spark):
    e = spark.createDataFrame([], "k string, ord int, n int, text string")
    for df in (windows.numbering_gaps(e, ["k"], ["ord"], "n"), windows.islands(e, ["k"], ["ord"], F.col("n"), 1), aggregates.joined_parts(e, ["k"], ["ord"], "text"), ordering.best(e, ["k"], F.col("n"), ["ord"])):
        assert df.collect() == []


def test_printed_context_keeps_numbers_of_pairs_and_settles_ties(spark):
    slots = spark.createDataFrame([("s", 1, [100.0, 0.0, 120.0, 20.0]), ("none", 2, [0.0, 0.0, 9.0, 9.0])], "slot_id string, page int, box array<double>")
    rows = [(1, n, f"t{n}", [50.0, 0.0, 90.0, 20.0]) for n in (10, 9)] + [(1, n, f"t{n}", [130.0, 1.0, 140.0, 20.0]) for n in (20, 3)] + [(1, 1, "far", [50.0, 200.0, 99.0, 220.0])]
    blocks = spark.createDataFrame(rows, "page int, block_ord int, text string, block_box array<double>")
    out = joins.printed_context(slots, blocks)
    assert sorted((r["slot_id"], r["before"], r["after"]) for r in out.collect()) == [("none", None, None), ("s", "t10", "t20")]
    assert joins.printed_context(slots, blocks.drop("block_ord")).filter("slot_id = 's'").first()["before"] == "t9"
    assert "SortAggregate" not in out._jdf.queryExecution().toString()  # which sorts, and spills, all pairs


def test_printed_context_keeps_slots_without_place_and_passes_over_blocks_without_text(spark):
    slots = spark.createDataFrame([("s", 1, [100.0, 0.0, 120.0, 20.0]), ("no box", 1, None), ("empty", 1, []), ("short", 1, [100.0, 0.0]), ("no width", 1, [100.0, 0.0, None, 20.0]), ("no page", None, [100.0, 0.0, 120.0, 20.0])], "slot_id string, page int, box array<double>")
    rows = [(1, 1, "t1", [50.0, 0.0, 90.0, 20.0]), (1, 2, None, [50.0, 0.0, 95.0, 20.0]), (1, 3, None, [130.0, 0.0, 140.0, 20.0]), (1, 4, "t4", [135.0, 0.0, 140.0, 20.0]), (1, 5, "t5", None), (1, 6, "t6", [50.0, 0.0])]
    out = joins.printed_context(slots, spark.createDataFrame(rows, "page int, block_ord int, text string, block_box array<double>"))
    none = [(k, None, None) for k in ("empty", "no box", "no page", "short")]
    assert sorted((r["slot_id"], r["before"], r["after"]) for r in out.collect()) == sorted([*none, ("no width", "t1", None), ("s", "t1", "t4")])
