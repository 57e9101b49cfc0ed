import random

import pytest

from leafline.operators import ink


def as_pixels(rows):
    return {(*r[:-2], x) for r in rows for x in range(r[-2], r[-1])}


def islands(pixels):
    out = []
    for p in sorted(pixels):
        if out and out[-1][:-2] == p[:-1] and out[-1][-1] == p[-1]:
            out[-1] = (*out[-1][:-1], p[-1] + 1)
        else:
            out.append((*p, p[-1] + 1))
    return out


@pytest.fixture(scope="module")
def made():
    rng = random.Random(6)
    return [(p, s, y, x := rng.randrange(-3, 40), x + rng.randrange(0, 9)) for p in "ab" for s in range(5) for y in range(6) for _ in range(rng.randrange(0, 7))]


RUNS = "page string, sheet int, y int, x0 int, x1 int"
got = lambda df, *names: sorted(tuple(r[n] for n in names) for r in df.collect())


def test_runs_and_pixels_say_the_same(spark, made):
    pixels = as_pixels(made)
    want = islands(pixels)
    df = spark.createDataFrame(made, RUNS)
    assert got(ink.united(df, ["page", "sheet", "y"]), "page", "sheet", "y", "x0", "x1") == want
    twice = spark.createDataFrame([*pixels, *pixels], "page string, sheet int, y int, x int")
    assert got(ink.runs_of(twice, ["page", "sheet", "y"]), "page", "sheet", "y", "x0", "x1") == want
    assert len(want) < len(pixels) / 3


def test_votes_are_those_of_pixels(spark, made):
    votes = {}
    for p, s, y, x in as_pixels(made):
        votes.setdefault((p, y, x), set()).add(s)
    sheets = spark.createDataFrame([("a", 5), ("b", 2)], "page string, n int")
    out = ink.voted(spark.createDataFrame(made, RUNS), sheets, ["page"])
    rows = got(out, "page", "y", "x0", "x1", "votes", "stable")
    assert {(p, y, x): v for p, y, a, b, v, _ in rows for x in range(a, b)} == {k: len(s) for k, s in votes.items()}
    assert all(stable == (v >= (4 if p == "a" else 2)) for p, _, _, _, v, stable in rows)
    for a, b in zip(rows, rows[1:]):  # stretches of equal votes that touch are one
        assert not (a[:2] == b[:2] and a[3] == b[2] and a[4] == b[4])


def test_writing_is_what_the_print_leaves(spark, made):
    printed = [("a", y, x, x + 3) for y in range(5) for x in range(0, 40, 8)] + [("a", 99, 0, 50), ("a", 1, 4, 4)]
    gone = as_pixels(printed)
    want = islands({(p, s, y, x) for p, s, y, x in as_pixels(made) if (p, y, x) not in gone})
    out = ink.without(spark.createDataFrame(made, RUNS), spark.createDataFrame(printed, "page string, y int, x0 int, x1 int"), ["page", "y"], ["sheet"])
    assert got(out, "page", "sheet", "y", "x0", "x1") == want


def test_nothing(spark):
    empty = spark.createDataFrame([], RUNS)
    assert ink.united(empty, ["page", "sheet", "y"]).collect() == []
    assert ink.voted(empty, spark.createDataFrame([("a", 1)], "page string, n int"), ["page"]).collect() == []
    assert ink.without(empty, empty.drop("sheet"), ["page", "y"], ["sheet"]).collect() == []
