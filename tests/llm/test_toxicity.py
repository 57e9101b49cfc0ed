import math
import random

from leafline.llm import toxicity
from leafline.llm.toxicity import fit, sample_labelled, score


def corpus(seed, n):
    rng = random.Random(seed)
    syllables = ["an", "the", "ti", "on", "re", "or", "ou", "st", "nd", "er"]
    bad = ["vorkul", "zmagg", "plithry", "quobbex"]
    rows = []
    for i in range(n):
        words = ["".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(5, 120))]
        toxic = i % 6 == 0
        for _ in range(4 * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(bad))
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_held_out_accuracy(spark, table):
    model = fit([(t, y, 1.0) for _, t, y in corpus(1, 600)])
    rows = corpus(2, 400)
    got = {r["doc_id"]: r for r in score(table([(i, t) for i, t, _ in rows]), model).collect()}
    right = [got[i]["predicted"] == y for i, _, y in rows]
    assert sum(right) / len(right) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got.values())


def test_awkward_rows(table, awkward):
    model = fit([(t, y, 1.0) for _, t, y in corpus(1, 200)])
    done = score(table(awkward), model).collect()
    assert sorted((str(r["doc_id"]), str(r["text"])) for r in done) == sorted((str(i), str(t)) for i, t in awkward)
    assert all(0 <= r["score"] <= 1 for r in done)
    assert score(table([]), model).collect() == []


def test_one_sided_or_no_labels(table):
    for labels in ([], [("a", 0, 1.0)], [("a", 1, 2.0)]):
        assert 0 <= score(table([(1, "a b")]), fit(labels)).first()["score"] <= 1


def test_a_word_met_in_ordinary_text_still_tells(table):
    """One ordinary document that quotes every insult does not take them from the dictionary."""
    rows = corpus(1, 600)
    quoting = (10_000, "vorkul zmagg plithry quobbex the on and", 0)
    model = fit([(t, y, 1.0) for _, t, y in [*rows, quoting]])
    assert all(w in model.toxic for w in (b"vorkul", b"zmagg", b"plithry", b"quobbex"))
    test = corpus(2, 400)
    got = {r["doc_id"]: r["predicted"] for r in score(table([(i, t) for i, t, _ in test]), model).collect()}
    assert sum(got[i] == y for i, _, y in test) / len(test) > 0.95


def phrases(seed, n):
    """Texts of the same words, each as frequent in either kind; only in toxic ones do some pairs follow upon one another."""
    rng = random.Random(seed)
    vocabulary = [a + b + c for a in ("br", "st", "kl", "gr", "pl", "tr", "sn", "fl") for b in ("ax", "eno", "ilu", "orm", "umpy", "yth") for c in ("an", "el", "ot", "um", "ix")]
    pairs = [(vocabulary[i], vocabulary[-1 - i]) for i in range(0, 60, 15)]
    rows = []
    for i in range(n):
        text = [rng.choice(vocabulary) for _ in range(rng.randrange(30, 90))]
        for _ in range(6):
            a, b = rng.choice(pairs)
            at = rng.randrange(len(text))
            if i % 4 == 0:
                text[at:at] = [a, b]
            else:
                text.insert(at, a)
                text.insert(rng.randrange(len(text)), b)
        rows.append((i, " ".join(text), int(i % 4 == 0)))
    return rows


def test_learns_where_no_single_word_tells(table):
    model = fit([(t, y, 1.0) for _, t, y in phrases(1, 900)])
    rows = phrases(2, 300)
    got = {r["doc_id"]: r["score"] for r in score(table([(i, t) for i, t, _ in rows]), model).collect()}
    toxic, clean = ([got[i] for i, _, y in rows if y == k] for k in (1, 0))
    area = sum((a > b) + (a == b) / 2 for a in toxic for b in clean) / (len(toxic) * len(clean))
    assert area > 0.65


def test_both_dictionaries_are_trained_alike():
    model = fit([(t, y, 1.0) for _, t, y in corpus(1, 600)])
    assert 0 < len(model.toxic) <= toxicity.DICTIONARY_BYTES and 0 < len(model.ordinary) <= toxicity.DICTIONARY_BYTES


def test_scores_equal_compression_lengths_by_hand(table):
    """Each score from zstandard itself: windows compressed one by one with either dictionary before the base, their differences, the curve."""
    import zstandard

    model = fit([(t, y, 1.0) for _, t, y in corpus(1, 200)])

    def length(window, dictionary):
        content = dictionary + model.base
        p = zstandard.ZstdCompressionParameters.from_level(12, source_size=48, dict_size=len(content), write_checksum=False, write_content_size=False, write_dict_id=False)
        d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(compression_params=p)
        return len(zstandard.ZstdCompressor(dict_data=d, compression_params=p).compress(window))

    for i, t, _ in (rows := corpus(3, 20)):
        ws = t.lower().encode().split()
        cut = [b" " + b" ".join(ws[k : k + 6]) + b" " for k in range(0, len(ws), 6)]
        g = sorted((length(w, model.ordinary) - length(w, model.toxic) for w in cut), reverse=True)
        over = [[v for v in g if v >= k] for k in (1, 2, 3)]
        x = [g[0], sum(g[:3]) / 3, sum(g) / len(g), math.log1p(len(g)), len(over[0]) / len(g), len(over[1]) / len(g), *(math.log1p(sum(o)) for o in over)]
        z = model.weights[0] + sum(a * b for a, b in zip(model.weights[1:], x))
        rows[i] = (i, t, 1 / (1 + math.exp(-max(-30, min(30, z)))))
    done = {r["doc_id"]: r["score"] for r in score(table([(i, t) for i, t, _ in rows]), model).collect()}
    assert all(abs(done[i] - want) < 1e-9 for i, _, want in rows)


def test_sample(spark, table, monkeypatch):
    docs = table([(1, "x"), (1, "y"), (2, None), (2, None), (3, "z")])  # of a repeated id one text counts
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (3, None), (9, 0), (None, 1)], "doc_id bigint, toxic int")
    assert sorted(sample_labelled(docs, labels)) in ([("", 0, 1.0), ("x", 1, 1.0)], [("", 0, 1.0), ("y", 1, 1.0)])
    monkeypatch.setattr(toxicity, "MOST_BYTES", 4 * 100)  # 300 ordinary bytes, 100 toxic ones
    docs = table([(i, "y" * (500 if i == 3 else 20)) for i in range(12)])
    labels = spark.createDataFrame([(i, 1) for i in range(12)], "doc_id bigint, toxic int")
    assert sample_labelled(docs, labels) == [("y" * 20, 1, 12 / 5)] * 5  # the long one is passed over, the others stand for all
