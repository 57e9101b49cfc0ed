import collections
import hashlib
import math
import re
import zlib

import pytest

from leafline.llm import resample as module
from leafline.llm.resample import Law, resample


def brute(rows, target, law):
    """Sorted (id, n_features, weight, score, rank) by the definition, one text at a time."""

    def features(text):
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        return len(ws), [" ".join(ws[i : i + n]) for n in range(1, law.max_n + 1) for i in range(len(ws) - n + 1)]

    def bucket(f):
        return zlib.crc32(f.encode()) % law.buckets

    corpus, aim = (collections.Counter(bucket(f) for t in texts for f in features(t)[1]) for texts in ([t for _, t in rows], target))
    s_all, t_all = sum(corpus.values()), sum(aim.values())
    gain = {b: math.floor(1000 * math.log((aim[b] + 1) * (s_all + law.buckets) / ((corpus[b] + 1) * (t_all + law.buckets)))) for b in range(law.buckets)}
    out, able = [], []
    for i, t in rows:
        n_words, fs = features(t)
        weight = sum(gain[bucket(f)] for f in fs) // len(fs) if fs else 0
        h = int(hashlib.sha256(f"{law.seed}:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(fs), weight, score, None])
        if n_words >= law.least_words:
            able.append((-score, i is None, i or 0, hashlib.sha256((t or "").encode()).hexdigest(), len(out) - 1))
    for k, x in enumerate(sorted(able)[: len(able) * law.percent // 100], 1):
        out[x[-1]][-1] = k
    return sorted(map(str, out))


@pytest.mark.parametrize("law", [Law(), Law(max_n=3, buckets=37, least_words=2, percent=50, seed="x"), Law(least_words=0, percent=100)])
def test_rows_are_those_of_the_definition(spark, table, awkward, law):
    rows = awkward + [(100 + i, f"Alpha{i % 9} beta-{i % 5} GAMMA, delta{i % 3} " * (i % 13)) for i in range(150)] + [(1000 + i, "the hot text of many " * 9) for i in range(80)]
    target = ["alpha1 beta gamma", None, "", "Alpha3 gamma delta1 one two three"]
    aims = spark.createDataFrame([(t,) for t in target], "text string")
    done = resample(table(rows), aims, law)
    assert done.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(str(list(r)) for r in done.collect()) == brute(rows, target, law)


def test_hot_texts_are_joined_back_like_others(table, awkward, monkeypatch, spark):
    aims = spark.createDataFrame([("one two",)], "text string")
    rows = awkward + [(100 + i, "one two three") for i in range(50)]
    for hot in (1, 3, 10**6):
        monkeypatch.setattr(module, "HOT", hot)
        assert sorted(str(list(r)) for r in resample(table(rows), aims, Law(least_words=1, percent=70)).collect()) == brute(rows, ["one two"], Law(least_words=1, percent=70))


def test_empty_tables(spark, table, awkward):
    aims = spark.createDataFrame([], "text string")
    assert resample(table([]), aims).collect() == []
    assert sorted(str(list(r)) for r in resample(table(awkward), aims).collect()) == brute(awkward, [], Law())


def test_ranks_run_on_over_ranges(spark):
    df = spark.range(5000).selectExpr("id", "id % 7 AS score").repartition(9)
    got = {r["id"]: r["rank"] for r in module.numbered(df, df["score"].desc(), df["id"], name="ranks").collect()}
    assert got == {i: k for k, i in enumerate(sorted(range(5000), key=lambda i: (-(i % 7), i)), 1)}
