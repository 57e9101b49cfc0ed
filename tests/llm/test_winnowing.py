import pytest
from pyspark.sql import functions as F

from leafline.llm import winnowing
from leafline.llm.winnowing import fingerprints_with_next, hashes, positions, winnow


@pytest.mark.parametrize(("k", "width"), [(3, 4), (8, 24), (1, 1), (5, 3)])
def test_choices_are_the_rightmost_minima_of_all_windows(spark, awkward, k, width):
    texts = [(i, t) for i, t in enumerate([t for _, t in awkward] + ["abababababababab" * 3, "a" * 40, "abc", "\n\r\n x y"])]
    df = winnow(spark.createDataFrame(texts, "i int, t string"), "t", "out", k, width).select("i", "t", hashes(F.col("out")).alias("h"), positions(F.col("out")).alias("p"))
    grams = spark.createDataFrame([(g,) for g in {t[p : p + k] for _, t in texts if t for p in range(max(1, len(t) - k + 1))}], "g string")
    made = winnowing.rolling(grams.withColumn("h", winnowing.points(F.col("g"))), "h", k)
    of = {r["g"]: (r["h"][0] + (1 << 31)) % (1 << 32) - (1 << 31) for r in made.collect()}
    for r in df.collect():
        t = r["t"]
        want = []
        if t:
            values = [of[t[p : p + k]] for p in range(max(1, len(t) - k + 1))]
            for s in range(max(1, len(values) - width + 1)):
                p = min(range(s, min(s + width, len(values))), key=lambda p: (values[p], -p))
                if not want or want[-1] != (values[p], p):
                    want.append((values[p], p))
        assert list(zip(r["h"], r["p"])) == want


def test_hashes_are_those_that_roll(spark):
    """Each hash from the one before: the first code point taken out, the next one taken in."""
    k, texts = 8, ["the quick brown fox jumps over 🙂 the lazy dög", "12345678", "aaaaaaaaaaaaaaaa"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("p", winnowing.points(F.col("t"))).withColumn("h", F.col("p"))
    for r in winnowing.rolling(df, "h", k).collect():
        assert len(r["p"]) == len(r["t"])
        h, want = 0, []
        for i, c in enumerate(r["p"]):
            out = r["p"][i - k] << (k - 1) if i >= k else 0
            h = (((h ^ out) << 1) ^ c) % (1 << 64)
            want += [h] * (i >= k - 1)
        assert [x % (1 << 64) for x in r["h"]] == want


@pytest.mark.parametrize("bucket", [2000, 2, 1])
def test_next_by_descending_id(table, monkeypatch, bucket):
    monkeypatch.setattr(winnowing, "BUCKET_ROWS", bucket)
    rows = [(i * i - 50, f"text {i} é" * (i % 7)) for i in range(40)]
    done = fingerprints_with_next(table(rows)).cache()
    order = sorted(rows, reverse=True)
    want = {}
    for n, (i, t) in enumerate(order):
        half = len(t) // 2
        want[i] = t[: len(t) - half] + order[(n + 1) % len(order)][1][:half]
    assert {r["doc_id"]: r["edited"] for r in done.collect()} == want
    again = {r["doc_id"]: r["again"] for r in winnow(table(list(want.items())), "text", "again").select("doc_id", "again").collect()}
    assert {r["doc_id"]: r["edited_chosen"] for r in done.collect()} == again


def test_awkward_rows(table, awkward):
    done = fingerprints_with_next(table(awkward)).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in done) == sorted((str(i), t or "") for i, t in awkward)
    same = {}
    for r in done:
        assert same.setdefault(r["text"], r["chosen"]) == r["chosen"]
    assert fingerprints_with_next(table([])).collect() == []
    one = fingerprints_with_next(table([(1, "abcd")])).collect()
    assert [r["edited"] for r in one] == ["abab"]
