import zlib

import pytest
from pyspark.sql import functions as F

from leafline.llm import sharding
from leafline.llm.sharding import shard


@pytest.mark.parametrize(("law", "large"), [("bytes", 256), ("rows", 256), ("bytes", 2), ("rows", 2)])
def test_shards_are_even(spark, table, monkeypatch, law, large):
    monkeypatch.setattr(sharding, "LARGE", large)
    rows = [(i, "same text" if i % 30 == 0 else "x" * (i * 37 % 101) + str(i)) for i in range(3000)]
    done = shard(table(rows), n_shards=16, law=law, ranges=32).toPandas()
    assert sorted(done["doc_id"]) == list(range(3000))
    for _, g in done.groupby("shard"):
        assert sorted(g["slot"]) == list(range(len(g)))
    sums = done.groupby("shard")["size"].sum() if law == "bytes" else done.groupby("shard")["size"].count()
    if law == "rows" and large == 256:
        assert sums.max() - sums.min() <= 1
    else:
        assert sums.max() - sums.min() <= sums.mean() * 0.02 + 110 * (law == "bytes") + (1010 if large == 2 and law == "bytes" else 0)
    assert len(sums) == 16
    if law == "bytes":
        assert done[done["doc_id"] % 30 == 0]["shard"].nunique() == 1


@pytest.mark.parametrize("pieces", [500_000, 7])
def test_equal_texts_lie_in_one_shard_unless_they_outweigh_it(spark, table, monkeypatch, pieces):
    monkeypatch.setattr(sharding, "PIECE_ROWS", pieces)
    rows = [(i, f"group {i % 90} " + "z" * (i % 90)) for i in range(900)] + [(2000 + i, "the largest group " * 5) for i in range(700)] + [(5000 + i, None) for i in range(60)] + [(6000 + i, "") for i in range(9)]
    done = shard(table(rows), n_shards=4).toPandas()
    text = dict(rows)
    assert sorted(done["doc_id"]) == sorted(text)
    done["text"] = [text[i] or "" for i in done["doc_id"]]
    spread = done.groupby("text")["shard"].nunique()
    assert {t: n for t, n in spread.items() if n > 1}.keys() == {"the largest group " * 5}
    sums = done.groupby("shard")["size"].sum()
    assert sums.max() - sums.min() <= sums.mean() * 0.03
    for _, g in done.groupby("shard"):
        assert sorted(g["slot"]) == list(range(len(g)))


def test_awkward_rows(table, awkward):
    done = shard(table(awkward), n_shards=4).collect()
    want = sorted((str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in awkward)
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in done) == want
    assert shard(table([])).collect() == []


def test_unknown_law(table):
    with pytest.raises(ValueError):
        shard(table([]), law="other")


@pytest.mark.parametrize(("law", "n_shards", "ranges"), [("bytes", 4, 8), ("rows", 3, 5), ("bytes", 16, 64)])
def test_groups_lie_where_sorting_them_all_puts_them(spark, table, law, n_shards, ranges):
    """Each group's shard, and each row's slot, from one sorted list: the order of keys, the room that the large groups leave, the middles of the rest."""
    rows = [(i, "x" * (i * 7919 % 400) + str(i % 90)) for i in range(700)] + [(1000 + i, "y" * 6000 + str(i)) for i in range(3)]
    df = table(rows)
    keys = {r["doc_id"]: (r["k"], r["t"]) for r in df.select("doc_id", F.xxhash64("text").alias("k"), F.xxhash64("doc_id", F.lit(1)).alias("t")).collect()}
    weight = {i: len(t.encode()) + 1 if law == "bytes" else 1 for i, t in rows}
    group_of = {i: t if law == "bytes" else i for i, t in rows}
    members = {}
    for i in sorted(group_of, key=lambda i: (keys[i][1], i)):
        members.setdefault(group_of[i], []).append(i)
    heavy = {g: sum(weight[i] for i in own) for g, own in members.items()}
    total = sum(weight.values())
    big = {g for g in members if heavy[g] * n_shards * sharding.LARGE > total}
    assert not any(heavy[g] * n_shards > total for g in big if len(members[g]) > 1)
    done = {r["doc_id"]: (r["shard"], r["slot"]) for r in sharding.shard(df, n_shards, law, ranges).collect()}
    assert len(done) == len(rows)
    for g, own in members.items():
        assert len({done[i][0] for i in own}) == 1
    load = [sum(heavy[g] for g in big if done[members[g][0]][0] == s) for s in range(n_shards)]
    assert not big or max(load) - min(load) <= max(heavy[g] for g in big)
    room = [max(0.0, total / n_shards - x) for x in load]
    rest = total - sum(load)
    ends, at = [], 0.0
    for x in room[:-1]:
        at += x * rest / sum(room) if sum(room) else 0
        ends.append(at)
    begin, held = 0, [0] * n_shards
    for g in sorted((g for g in members if g not in big), key=lambda g: (keys[members[g][0]] if law == "rows" else (keys[members[g][0]][0], 0), members[g][0])):
        s = sum(e <= begin + heavy[g] / 2 for e in ends)
        for i in members[g]:
            assert done[i] == (s, held[s])
            held[s] += 1
        begin += heavy[g]
    for s in range(n_shards):
        slots = sorted(done[i][1] for g in big for i in members[g] if done[i][0] == s)
        assert slots == list(range(held[s], held[s] + len(slots)))


def test_ranges_by_halving(spark):
    cuts = sorted({(i * 37 % 101 - 50, i % 3) for i in range(90)})
    probes = [(k, t) for k in range(-55, 56, 5) for t in range(4)]
    df = spark.createDataFrame(probes, "key bigint, tie bigint")
    for n in (0, 1, 2, 3, 7, 8, len(cuts)):
        got = {(r["key"], r["tie"]): r["n"] for r in df.withColumn("n", sharding._range_of(cuts[:n])).collect()}
        assert got == {p: sum(c <= p for c in cuts[:n]) for p in probes}
