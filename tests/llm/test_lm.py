import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from leafline.llm import lm

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
START, END, NEW = "<s>", "</s>", object()


class Model:
    """The same probabilities by their definition, word by word, with no states."""

    def __init__(self, texts, order, priors):
        self.order, self.priors, self.count, self.history = order, priors, Counter(), Counter()
        for t in texts:
            run = (START, *t)
            for n in range(1, order + 1):
                for i in range(max(n - 1, 1), len(run)):
                    self.count[run[i - n + 1 : i + 1]] += 1
                    self.history[run[i - n + 1 : i]] += 1
        self.words = {g[0] for g in self.count if len(g) == 1}
        self.total = self.history[()]

    def p(self, word, history):
        if not history:
            if not self.total:
                return 1.0
            return (self.count[(word,)] - 0.5) / self.total if word in self.words else 0.5 * len(self.words) / self.total
        prior = self.priors[len(history) - 1]
        return (self.count[(*history, word)] + prior * self.p(word, history[1:])) / (self.history[history] + prior)

    def score(self, tokens):
        run = (START, *tokens)
        return sum(math.log10(self.p(run[i], run[max(0, i - self.order + 1) : i])) for i in range(1, len(run)))


def tokens(t):
    return [*WORD.findall((t or "").translate(LOW)), END]


@pytest.mark.parametrize(("order", "priors", "per"), [(2, (20.0,), 3000), (3, (20.0, 5.0), 3000), (3, (20.0, 5.0), 4), (4, (9.0, 4.0, 2.0), 5)])
def test_scores_equal_the_model_by_definition(table, awkward, monkeypatch, order, priors, per):
    monkeypatch.setattr(lm, "CHUNK_ROWS", per)
    monkeypatch.setattr(lm, "STRETCH", 1000 if per == 3000 else 3)
    rows = awkward * (2 if per == 3000 else 1) + [(100 + i, "a b c d e " * (i % 5) + f"n{i} a b c") for i in range(50)]
    df = table(rows).withColumn("train", F.coalesce(F.col("doc_id") % 5 != 1, F.lit(False)))
    model = Model([tokens(t) for i, t in rows if i is not None and i % 5 != 1], order, priors)
    for h in [(), ("a",), ("a", "b"), (START,), ("unseen", "b"), (START, "a")]:
        assert abs(sum(model.p(w, h[-order + 1 :]) for w in [*model.words, NEW]) - 1) < 1e-9
    done = sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], r["train_tokens"], round(r["score"], 4), round(r["base_score"], 4)) for r in lm.score(df, order=order, priors=priors).collect())
    n, v = model.total, len(model.words)
    base = lambda x: sum(math.log10((model.count[(w,)] + 0.5) / (n + 0.5 * (v + 1))) for w in x)
    want = sorted((str(i), len(x), sum(w in model.words for w in x), n, round(model.score(x), 4), round(base(x), 4)) for i, x in ((i, tokens(t)) for i, t in rows))
    assert done == want


def test_states_and_arcs():
    """Every trained history is a state with an arc for each word seen after it and a failure arc to its shorter one."""
    texts = ["a b a b c", "a b c", "c c"]
    c = lm.Counts(texts, [True, True, True], lm.pa.table({k: [] for k in ("n", "bucket", "data")}), 3)  # one chunk: its own counts are all
    made, word, begin, home = lm.automaton(c, 4, 13, 3, (20.0, 5.0), 3)
    model = Model([tokens(t) for t in texts], 3, (20.0, 5.0))
    histories = {h for h in model.history if h[-1:] != (END,)}
    two = {g for g in model.count if len(g) == 2}
    assert len(made.fail) == 1 + len({h for h in model.history if len(h) == 1} | {(END,)}) + len(two)
    assert {h for h in histories if len(h) == 2} <= two
    assert len(made.keys) - 1 == sum(len(g) > 1 for g in model.count)
    assert made.fail[0] == 0 and (made.fail[1:] < np.arange(1, len(made.fail))).all()
    state, total = np.array([begin]), 0.0
    for w in word[1 : c.n[0] + 1]:  # one text by hand
        weight, state = made.step(state, np.array([w]), home)
        total += weight[0]
    assert abs(total - model.score(tokens(texts[0]))) < 1e-9


def test_counts_beyond_32_bits():
    big = np.array([1, 1 << 33, (1 << 62) + 5], np.int64)
    assert (lm.from_planes(lm.unpack(lm.pack(lm.planes(big)), "u1")[0]).astype(np.int64) == big).all()


def test_no_training_rows_and_empty_table(table):
    df = table([(1, "a b"), (2, None)]).withColumn("train", F.lit(False))
    assert [(r["n_tokens"], r["n_known"], r["score"]) for r in lm.score(df).orderBy("doc_id").collect()] == [(3, 0, 0.0), (1, 0, 0.0)]
    assert lm.score(df.limit(0)).collect() == []
    with pytest.raises(ValueError, match="order"):
        lm.score(df, order=1)
