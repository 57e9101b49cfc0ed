import itertools
import random

import duckdb
import numpy as np
import pytest

import __spark_entry__
from leafline.operators import assignment, evaluation, merging, variants

QUESTIONS = "document string, record int, ord int, title string, number int, pages array<int>, items array<struct<label: string, pages: array<int>>>"


def test_questions_of_one_number_that_share_pages_or_sections_are_one(spark, tmp_path):
    rows = [
        ("d", 1, 0, "Part A", 1, [1], [("(1)", [1]), ("(2)", [1])]), ("d", 1, 1, "Part A", 2, [1], [("", [1])]),
        ("d", 2, 0, "part a.", 2, [2], [("x", [2]), ("(9)", [2])]),  # the section's spelling differs
        ("d", 2, 1, "Part B", 1, [1, 2], [("（2）", [2]), ("(7)", [2]), ("(8)", [2])]),  # a page is shared
        ("d", 3, 0, "Part C", 1, [9], [("(1)", [9])]), ("d", 3, 1, None, 2, [], None), ("e", 1, 0, "Part A", 1, [1], []),
    ]
    out = merging.merged_topologies(spark.createDataFrame(rows, QUESTIONS), f"file://{tmp_path}/m")
    got = sorted((r["document"], r["section"], r["title"] or "", r["question"], r["number"], r["pages"], [(i["label"], i["pages"]) for i in r["items"]], r["sources"]) for r in out.collect())
    assert got == [
        ("d", 1, "Part A", 1, 1, [1, 2], [("(1)", [1]), ("(2)", [1, 2]), ("(8)", [2])], 2),
        ("d", 1, "Part A", 2, 2, [1, 2], [("", [1, 2]), ("(9)", [2])], 2), ("d", 3, "Part C", 1, 1, [9], [("(1)", [9])], 1), ("d", 4, "", 1, 2, [], [], 1), ("e", 1, "Part A", 1, 1, [1], [], 1),
    ]


def test_labels_spread_to_the_fixed_point(spark, tmp_path):
    rng = random.Random(1)
    members = [(i, f"c{i}") for i in range(60)] + [(i + 1, f"c{i}") for i in range(59)]  # one long chain
    members += [(100 + rng.randrange(80), f"k{rng.randrange(40)}") for _ in range(90)] + [(500, "lone")]
    of = {}
    for n, k in members:
        of.setdefault(n, {n})
    changed = True
    while changed:
        changed = False
        for (a, k), (b, j) in itertools.product(members, members):
            if k == j and of[a] is not of[b]:
                both = of[a] | of[b]
                for x in both:
                    of[x] = both
                changed = True
    got = {r["node"]: r["label"] for r in merging.smallest_linked(spark.createDataFrame(members, "node bigint, key string"), f"file://{tmp_path}/l").collect()}
    assert got == {n: min(s) for n, s in of.items()}


def test_last_reason_of_a_page(spark):
    rows = [("d", 1, 0, "original", 3, "cover"), ("d", 2, 0, "original", 3, "blank"), ("d", 1, 0, "template", 3, "t")]
    got = merging.last_reasons(spark.createDataFrame(rows, "document string, record int, ord int, source string, page_index int, reason string"))
    assert sorted((r["source"], r["reason"]) for r in got.collect()) == [("original", "blank"), ("template", "t")]


def test_alignment_is_the_cheapest_of_all_in_order(spark):
    rng = np.random.default_rng(0)
    rows, want = [], {}
    for item in range(120):
        n, m = rng.integers(1, 6, 2)
        cost = rng.integers(0, 4, (n, m)).astype(float)
        rows += [(item, int(i), int(j), float(cost[i, j])) for i in range(n) for j in range(m)]
        short, long = min(n, m), max(n, m)
        table = cost if n <= m else cost.T
        ways = [(sum(table[i, j] for i, j in enumerate(js)), tuple(-j for j in reversed(js))) for js in itertools.combinations(range(long), short)]
        best = [-j for j in reversed(min(ways)[1])]
        want[item] = [(i, j) if n <= m else (j, i) for i, j in enumerate(best)]
        assert assignment.monotone_alignment(cost) == want[item]
    got = {}
    for r in assignment.aligned(spark.createDataFrame(rows, "item int, a int, b int, cost double").repartition(5), "item", "a", "b", "cost").collect():
        got.setdefault(r["item"], []).append((r["a"], r["b"]))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    assert assignment.aligned(spark.createDataFrame([], "item int, a int, b int, cost double"), "item", "a", "b", "cost").collect() == []


def test_slots_with_repeated_ids_are_matched_in_order(spark):
    rng = random.Random(3)
    schema = "case_id string, item_id string, slot_id string, page_index int, ord int, box array<double>, text string"
    make = lambda n: [("c", "i", f"s{rng.randrange(5)}", rng.randrange(2), k, [x := rng.uniform(0, 50), 0.0, x + 40, 20.0], rng.choice(["A", " a", None])) for k in range(n)]
    truth, found = make(40), [*make(40), ("c", "i", "s0", 0, 99, [1.0], "A")]

    def iou(a, b):
        w = max(0, min(a[2], b[2]) - max(a[0], b[0])) * 20
        return w / max(1, 1600 - w)

    want, used = {}, set()
    for t in truth:
        near = [(-iou(t[5], p[5]), p[4]) for p in found if p[:4] == t[:4] and len(p[5]) == 4 and p[4] not in used]
        if near:
            best = min(near)
            used.add(best[1])
            want[t[4]] = round(-best[0], 6)
    got = evaluation.match_slots(spark.createDataFrame(truth, schema), spark.createDataFrame(found, schema))
    assert {r["truth_ord"]: round(r["overlap"], 6) for r in got.collect()} == want


def test_nested_json_against_a_closed_schema(spark, tmp_path):
    schema = {"a": "int", "b": [{"c": "string", "d?": ["number"]}], "e": "any"}
    texts = [
        '{"a":1,"b":[],"e":{"x":[1]}}', '{"a":1,"b":[{"c":"x","d":[1,2.5]},{"c":null}],"e":null}', '{"a":1.5,"b":[{"d":[true],"z":{"deep":1}}]}', "[1]", "{", None, '{"a":"1","b":{"c":"x"},"e":0,"f":0}',
    ]
    want = [
        [], [("$.b[1].c", "WRONG_TYPE")], [("$.a", "WRONG_TYPE"), ("$.b[0].c", "MISSING_KEY"), ("$.b[0].d[0]", "WRONG_TYPE"), ("$.b[0].z", "UNKNOWN_KEY"), ("$.e", "MISSING_KEY")],
        [("$", "WRONG_TYPE")], [("$", "NOT_JSON")], [("$", "NOT_JSON")], [("$.a", "WRONG_TYPE"), ("$.b", "WRONG_TYPE"), ("$.f", "UNKNOWN_KEY")],
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, j string")
    out = variants.closed_world_faults(df, ["id"], "j", schema, f"file://{tmp_path}/n").collect()
    assert [sorted((r["path"], r["fault"]) for r in out if r["id"] == i) for i in range(len(texts))] == want
    deep = spark.createDataFrame([(1, "[" * 6 + "]" * 6)], "id int, j string")
    assert variants.json_nodes(deep, ["id"], "j", f"file://{tmp_path}/d").count() == 6
    with pytest.raises(ValueError, match="levels"):
        variants.json_nodes(deep, ["id"], "j", f"file://{tmp_path}/e", most_levels=3)
    with pytest.raises(ValueError, match="kind"):
        variants.patterns({"a": "date"})


def test_merged_boxes_of_many_pages(spark):
    rng = random.Random(8)
    rows = [(p, i, [x := rng.uniform(0, 60), y := rng.uniform(0, 30), x + 40, y + 20]) for p in range(6) for i in range(p * 7)] + [(9, 1, [1.0, 2.0])]
    got = {}
    for r in assignment.merged(spark.createDataFrame(rows, "page int, n int, box array<double>"), ["page"], "box", ["n"]).collect():
        got.setdefault(r["page"], []).append((r["place"], r["box"]))
    want = {p: list(enumerate(assignment.merged_boxes([b for q, _, b in rows if q == p]), 1)) for p in range(1, 6)}
    assert {p: sorted(v) for p, v in got.items()} == want


def _held_against_sql(spark, tmp_path, name, tables):
    """(rows of a query, rows of its SQL) on these tables, both sorted."""
    for table, df in tables.items():
        df.coalesce(1).write.parquet(f"{tmp_path}/{table}.parquet")
    got = __spark_entry__.queries()[name](spark, str(tmp_path))
    con = duckdb.connect()
    for table in tables:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{tmp_path}/{table}.parquet/*.parquet')")
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({__spark_entry__.oracle_sql()[name]})").fetchall()
    order = lambda rows: sorted(map(tuple, rows), key=str)
    return order(got.collect()), order(want)


def test_short_beginnings_count_as_in_sql(spark, tmp_path):
    texts = ["Of. The rest", "a ... b", "12 apples", "(3) pears", "", "...", "Word by word"]
    rows = spark.createDataFrame([(i, x) for n, x in enumerate(texts) for i in range(3 * n, 3 * n + 3)], "item_id bigint, text string")
    got, want = _held_against_sql(spark, tmp_path, "q133_structural_similarity", {"benchmark": rows})
    assert got == want
    assert (0, 0.25) in got and (3, 0.125) in got


def _merging_tables(spark, customers, suppliers):
    """Customers whose lines name some suppliers twice, some unknown to their nation, and one customer without orders."""
    lines = [(c, (c * 7 + i * i) % (suppliers + 2), i + 1, float((c + 3 * i) % 50)) for c in range(customers - 1) for i in range(12)]
    return {
        "customer": spark.createDataFrame([(c, f"c{c}", c % 7) for c in range(customers)], "c_custkey bigint, c_name string, c_nationkey int"),
        "supplier": spark.createDataFrame([(s, f"s{s}", s % 5) for s in range(suppliers)], "s_suppkey bigint, s_name string, s_nationkey int"),
        "orders": spark.createDataFrame([(c, c) for c in range(customers - 1)], "o_orderkey bigint, o_custkey bigint"),
        "lineitem": spark.createDataFrame(lines, "l_orderkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double"),
    }


def _plan(df):
    return df._jdf.queryExecution().toString()


@pytest.mark.parametrize("name", ["q127_inherited_items", "q128_inherited_packages"])
def test_inherited_items_meet_by_a_join(spark, tmp_path, name):
    got, want = _held_against_sql(spark, tmp_path, name, _merging_tables(spark, 40, 60))
    assert got == want
    plan = _plan(__spark_entry__.queries()[name](spark, str(tmp_path)))
    assert "map_from_entries" not in plan and "Generate explode" in plan  # no search through a student's items for each of the teacher's


def test_closed_world_is_checked_where_the_rows_lie(spark, tmp_path):
    rows = [(o, n, float((o * 5 + n * 11) % 50)) for o in range(70) for n in range(1, 1 + o % 4 + 1)]
    tables = {"lineitem": spark.createDataFrame(rows, "l_orderkey bigint, l_linenumber int, l_quantity double")}
    got, want = _held_against_sql(spark, tmp_path, "q131_closed_world", tables)
    assert got == want and len(got) > 30
    one = spark.createDataFrame([(1, '{"a":[{"b":null},[2],{"b":3}]}')], "id int, j string")
    out = variants.closed_world_faults(one, ["id"], "j", {"a": [{"b": "int"}]})  # no folder: no level is written
    assert sorted((r["path"], r["fault"]) for r in out.collect()) == [("$.a[0].b", "WRONG_TYPE"), ("$.a[1]", "WRONG_TYPE")]
    assert "Join" not in _plan(out) and "Exchange" not in _plan(out)
