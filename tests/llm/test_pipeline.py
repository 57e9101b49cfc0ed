import os
import zlib
from collections import Counter, defaultdict

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from leafline.llm.spfhp import pack_histogram
from leafline.llm.storage import documents, shared_dir
from leafline.llm.toxicity import fit

SF = "/root/testdata/sf0.001"


def test_stages_one_by_one(spark, tmp_path):
    docs = documents(spark, SF)
    was = {r["doc_id"]: r["text"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == list(corpus_pipeline.COLUMNS)
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        now = {r["doc_id"]: r["text"] for r in docs.collect()}
        assert set(now) <= set(was) and len(now) > len(was) * 0.5
        if name == "exact_dedup":
            low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
            best = {}
            for i, t in was.items():
                best[t.translate(low)] = max(best.get(t.translate(low), i), i)
            assert set(now) == set(best.values())
        if name == "jaccard_join":
            from test_jaccard import brute

            keep = {i for i, _, c in brute(sorted(was.items()), 5, 80, 100) if i == c}
            assert set(now) == keep
        if name == "suffix_dedup":
            from test_suffix_dedup import brute as bytes_of

            assert {i: b.decode("utf-8", "ignore") for i, _, _, b in bytes_of(sorted(was.items()), 50)} == now
        else:
            assert all(was[i] == t for i, t in now.items())
        was = now
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF).toPandas()
    assert set(pieces["doc_id"]) == set(was)
    assert (pieces.groupby("sequence_id")["length"].sum() <= 1024).all()


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0


def rows_of(df):
    return sorted((str(r["doc_id"]), r["text"]) for r in df.collect())


def test_exact_by_row(spark, table):
    kept = lambda rows: rows_of(corpus_pipeline.exact(spark, table(rows), SF))
    assert kept([(None, "a"), (None, "b"), (1, "A")]) == [("1", "A"), ("None", "b")]
    assert kept([(None, "a"), (None, "a"), (None, "b"), (None, "")]) == [("None", ""), ("None", "a"), ("None", "b")]
    assert kept([(5, "a"), (5, "b"), (9, "a")]) == [("5", "b"), ("9", "a")]
    assert kept([(5, "a"), (5, "a"), (5, "b"), (3, "b")]) == [("5", "a"), ("5", "b")]


def test_near_by_row(spark, table):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    kept = lambda rows: rows_of(corpus_pipeline.near(spark, table(rows), SF))
    assert kept([(3, a), (5, a + " x"), (5, b)]) == [("3", a), ("5", b)]
    assert kept([(None, a), (1, a + " x"), (None, b), (None, c), (2, "")]) == sorted([("1", a + " x"), ("None", b), ("None", c), ("2", "")])
    assert len(kept([(None, a), (None, a + " x"), (None, b), (None, b), (None, "")])) == 3
    got = kept([(5, a), (5, a + " x"), (5, b), (9, b)])
    assert len(got) == 2 and ("5", b) in got


def test_toxicity_by_hand(spark):
    """The documents that stay are those that a model fitted on all labelled rows outside the fold scores below the cut."""
    rows = [(r["doc_id"], r["text"]) for r in documents(spark, SF).collect()]
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    known = [(t, labels[i]) for i, t in rows if i in labels and zlib.crc32(str(i).encode()) % 4 != 2]
    one = fit([(t, y, 1.0) for t, y in known]).scorer()  # fewer than the sample takes: every row stands for itself
    got = {r["doc_id"] for r in corpus_pipeline.toxicity(spark, documents(spark, SF), SF).collect()}
    assert got == {i for i, t in rows if one(t) < 0.3}


def test_packing_by_hand(spark, table, awkward):
    rows = [*awkward, (50, " " * 1_000_000 + "a"), (51, "x" * 100_000), (None, "#" * 5000)]
    library = Tokenizer.from_file(corpus_pipeline.VOCABULARY)
    ids = [(i, [*library.encode(t or "", add_special_tokens=False).ids, 0]) for i, t in rows]
    want = Counter((i, k, len(x[k : k + 1024]), zlib.crc32(np.array(x[k : k + 1024], "<u4").tobytes()), len(x)) for i, x in ids for k in range(0, len(x), 1024))
    pieces = corpus_pipeline.packing(spark, table(rows), SF).collect()
    assert Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in pieces) == want
    lengths = Counter(k[2] for k in want.elements())
    assert len({r["sequence_id"] for r in pieces}) == sum(p.count for p in pack_histogram(lengths, 1024))
    held = defaultdict(list)
    for r in pieces:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    assert all([a + b for a, b in sorted(v)][:-1] == [a for a, _ in sorted(v)][1:] and sorted(v)[0][0] == 0 for v in held.values())


def test_awkward_and_empty_tables_through_all_stages(spark, table, awkward, tmp_path):
    """Nulls, empty, blank, long and repeated texts, null and repeated ids: no stage fails, and none but the first two and the near one loses a row."""
    for n, rows in enumerate(([*awkward, (70, " " * 300_000 + "a"), (70, "other")], [])):
        docs, before = table(rows).select(*corpus_pipeline.COLUMNS), None
        for name, stage in corpus_pipeline.STAGES:
            docs.write.parquet(f"{tmp_path}/{n}-{name}")
            docs = stage(spark, spark.read.parquet(f"{tmp_path}/{n}-{name}"), SF) if rows or name != "toxicity" else docs
            count = len({(r["doc_id"], r["doc_tokens"], r["ids_crc32"]) if name == "packing" else i for i, r in enumerate(docs.collect()) if name != "packing" or r["start"] == 0})
            if name == "suffix_dedup":
                assert count == before
            before = count
        assert bool(before) == bool(rows)


def test_run_leaves_only_what_its_result_reads(spark):
    folder = shared_dir(spark).removeprefix("file://")
    before = set(os.listdir(folder))
    made = corpus_pipeline.run(spark, SF)
    assert made.count() > 0
    left = {p.split("-")[1] for p in set(os.listdir(folder)) - before}
    assert left <= {"pipeline", "pack"}
