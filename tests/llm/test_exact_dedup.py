from collections import defaultdict
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from leafline.llm import exact_dedup as module
from leafline.llm.exact_dedup import exact_dedup, exact_dedup_batch
from leafline.llm.exact_dedup import sha256 as column_sha256

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def expected(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(LOW)].append(i)
    out = []
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        out += [(i, max(known) if known else None, len(ids), sha256(t.encode()).hexdigest()) for i in ids]
    return sorted(out, key=str)


def got(df):
    return sorted([(r["doc_id"], r["keep_id"], r["group_size"], r["digest"]) for r in df.collect()], key=str)


def test_groups_and_keeps_one_row(table, awkward):
    done = exact_dedup(table(awkward)).cache()
    assert got(done) == expected(awkward)
    assert done.filter("kept").groupBy("digest").count().filter("count <> 1").count() == 0
    assert done.filter("kept").select("digest").distinct().count() == done.select("digest").distinct().count()


def test_full_bytes_are_compared_when_digests_collide(table, awkward):
    done = exact_dedup(table(awkward), digest=lambda t: F.char_length(t).cast("string"))
    groups = {(a, b, n) for a, b, n, _ in got(done)}
    assert groups == {(a, b, n) for a, b, n, _ in expected(awkward)}


def test_empty_table(table):
    assert exact_dedup(table([])).collect() == []


@pytest.mark.parametrize("digest", [column_sha256, lambda t: F.char_length(t).cast("string")])
def test_later_batches_against_earlier_ones(spark, table, awkward, tmp_path, digest):
    """Each batch's rows are grouped with all rows seen so far; with digests that collide the bytes still decide."""
    batches, seen = [awkward, [(1, "aA"), (20, "one TWO three"), (21, "new"), (None, "new"), (0, "xyz")], [], [(99, "NEW"), (3, "É"), (98, "xyz")]], []
    for rows in batches:
        seen += rows
        groups = {}
        for i, t in seen:
            groups.setdefault((t or "").translate(LOW), []).append(i)
        best = lambda ids: max((i for i in ids if i is not None), default=None)
        done = exact_dedup_batch(table(rows), f"file://{tmp_path}/state", digest=digest)
        got = sorted(((r["doc_id"], r["keep_id"], r["group_size"]) for r in done.collect()), key=str)
        assert got == sorted(((i, best(g), len(g)) for i, t in rows for g in [groups[(t or "").translate(LOW)]]), key=str)
        assert all(r["doc_id"] == r["keep_id"] for r in done.filter("kept").collect())


class Broken(Exception):
    pass


#: Steps of a batch after which a run is broken off: by the folder that was written last, or the micro-batch's end.
STEPS = ["contents", "keys", "begun", "groups", "collided"]


@pytest.mark.parametrize("step", STEPS)
def test_a_batch_broken_off_after_any_step_is_added_once(spark, table, tmp_path, monkeypatch, step):
    state, low = f"file://{tmp_path}/state", [(1, "a"), (2, "B")]
    sizes = lambda df: sorted((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in df.collect())
    assert sizes(exact_dedup_batch(table(low), state)) == [(1, 1, 1, True), (2, 2, 1, True)]
    second = table([(3, "A"), (4, "c")])
    known = module._written_out

    def breaking(s, path):  # what is asked for next tells that the step before is written
        after = {"contents": "keys", "keys": "begun", "begun": "ended", "groups": "begun/00000002", "collided": None}[step]
        if after and f"/{after}" in path and ("00000001" in path or "begun/00000002" == after and path.endswith(after)):
            if after != "ended" or path.endswith("ended/00000001"):
                raise Broken
        return known(s, path)

    if step == "collided":
        monkeypatch.setattr(module, "written", lambda df, name, w=module.written: (_ for _ in ()).throw(Broken) if name == "dedup-batch" else w(df, name))
    else:
        monkeypatch.setattr(module, "_written_out", breaking)
    with pytest.raises(Broken):
        exact_dedup_batch(second, state)
    monkeypatch.undo()
    want = [(3, 3, 2, True), (4, 4, 1, True)]
    with pytest.raises(ValueError, match="other rows"):
        exact_dedup_batch(table([(3, "A"), (4, "d")]), state)
    assert sizes(exact_dedup_batch(second, state)) == want
    assert sizes(exact_dedup_batch(second, state, batch=1)) == want  # and given again
    assert sizes(exact_dedup_batch(table([(0, "a"), (9, "C")]), state)) == [(0, 3, 3, False), (9, 9, 2, True)]
    assert sizes(exact_dedup_batch(second, state, batch=1)) == want
    with pytest.raises(ValueError, match="not ended"):
        exact_dedup_batch(second, state, batch=7)


def test_part_written_contents_are_no_batch(spark, table, tmp_path):
    state = f"file://{tmp_path}/state"
    folder = tmp_path / "state" / "contents" / "00000000"
    folder.mkdir(parents=True)
    spark.createDataFrame([(9, "zzz")], "id bigint, text string").coalesce(1).write.parquet(f"file://{tmp_path}/other")
    for f in (tmp_path / "other").glob("*.parquet"):
        (folder / f.name).write_bytes(f.read_bytes())
    assert [(r["doc_id"], r["group_size"]) for r in exact_dedup_batch(table([(1, "zzz")]), state).collect()] == [(1, 1)]


def test_a_table_goes_through_several_micro_batches(spark, table, monkeypatch):
    seen = []
    monkeypatch.setattr(module, "_latest", lambda s, paths, schema, f=module._latest: seen.append(len(paths)) or f(s, paths, schema))
    rows = [(i, f"text {i % 7}") for i in range(100)]
    assert got(exact_dedup(table(rows).repartition(6))) == expected(rows)
    assert seen == [2]
