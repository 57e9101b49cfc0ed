import hashlib
import random
import re

import numpy as np
import pytest

from leafline.llm import pii, queries

PATTERNS = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text):
    """The contract's patterns as they stand."""
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            sums = [sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits))]
            if kind == 0 or kind == 1 and all(int(p) <= 255 for p in m.group().split(".")) or kind == 2 and 14 <= len(digits) <= 19 and sum(sums) % 10 == 0 or kind == 3 and 10 <= len(digits) <= 15:
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def test_base_spans_are_those_of_the_patterns():
    rng = random.Random(5)
    parts = ["1", "25", "0", ".", "@", "a", "b.", "+", "-", " ", "(", ")", "é", "x@y.z", "4111 1111 1111 1111", "+1 (234) 555-1234", "1.2.3.4", "٣", "\n"]
    for _ in range(20000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))
        assert pii.base_spans(text) == plain(text), text


@pytest.mark.parametrize("text", ["9" * 300_000, "a" * 300_000 + "@", "@" * 100_000, "+1" + "(" * 300_000, "1." * 150_000, "a." * 100_000 + "@a.", "1 " * 100_000, "(at)" * 50_000, "x" * 500_000 + "1"])
def test_long_texts_take_time_in_proportion(text):
    pii.mentions(text)


def emails(rng):
    return f"{rng.choice(['kim', 'lee', 'ada'])}.{rng.randint(10, 99)}@mail{rng.randint(1, 9)}.example.com"


def phones(rng):
    return f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}"


def corpus(n=200):
    rng = random.Random(2)
    made = []
    for i in range(n):
        kind = [emails, phones, lambda r: ".".join(str(r.randint(1, 255)) for _ in range(4)), lambda r: "4111 1111 1111 1111"][i % 4](rng)
        made.append((i, f"filler words of document number-{'x' * (i % 7)} {kind} and other words " + "lorem ipsum dolor sit " * 8 + f"{kind} end of it, serial {rng.randint(10**11, 10**12)} version 4.0."))
    return made


FIRST = "Ring +1 (487) 555-7209 or write Jo.90@mail3.example.com, host 97.51.17.173, card 4845168114407329. " + "lorem ipsum dolor sit " * 12
LATER = [
    ("487-555-7209", 3), ("4875557209", 3), ("555-7209", 3), ("0014875557209", 3), ("jo.90 at mail3 dot example dot com", 0), ("JO.90 (at) mail3.example.com", 0), ("jo.90@mail3", 0),
    ("97-51-17-173", 1), ("97[.]51[.]17[.]173", 1), ("4845.1681.1440.7329", 2),
    ("9807915762804490", None), ("2024-05-06", None), ("487 555 7210", None), ("97.51.17", None), ("ann.90@mail4", None), ("version 4.0", None),
]


def test_mentions_like_a_base_one_get_its_label(table):
    rows = corpus() + [(1000 + i, FIRST + f"see {form} today") for i, (form, _) in enumerate(LATER)] + [(2000 + i, f"lorem ipsum {form} dolor") for i, (form, _) in enumerate(LATER) if "(at)" not in form]
    got = {r["doc_id"]: r for r in pii.find(table(rows)).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        base = [(s["start"], s["kind"], s["end"]) for s in got[i]["base"]]
        spans = [(s["start"], s["kind"], s["end"]) for s in got[i]["spans"]]
        assert base == plain(t) and set(base) <= set(spans) and spans == sorted(spans)
        added = [(k, t[a:b]) for a, k, b in spans if (a, k, b) not in base]
        form, kind = LATER[i % 1000] if i >= 1000 else (None, None)
        assert added == ([(kind, form)] if i in range(1000, 2000) and kind is not None else []), t


def marginals(field, found):
    """By summing over all labellings."""
    import itertools

    chain, alike = pii.links(found)
    total = np.zeros((len(found), pii.LABELS))
    for labels in itertools.product(range(pii.LABELS), repeat=len(found)):
        if any(m[2] >= 0 and y != m[2] + 1 for m, y in zip(found, labels)):
            continue
        s = sum(field.own[pii._columns(pii.shape(m[3])), y].sum() for m, y in zip(found, labels) if m[2] < 0)
        s += sum(field.chain[labels[i], labels[j]] for i, j in chain) + sum(field.alike[labels[i], labels[j]] for i, j in alike)
        total[np.arange(len(found)), labels] += np.exp(s)
    return total / total.sum(1, keepdims=True)


def test_messages_give_exact_shares_on_trees_and_near_ones_on_loops():
    rng = np.random.default_rng(0)
    sym = lambda t: (t + t.T) / 2
    field = pii.Field(rng.normal(size=(pii.WIDTH, pii.LABELS)), sym(rng.normal(size=(5, 5))), sym(rng.normal(size=(5, 5))))
    far = " " + "x " * 40
    tree = pii.mentions("a12 b34" + far + "+1 (487) 555-7209" + far + "487-555-7209 c56")
    loop = pii.mentions("555-7210 zz 4875557211" + far + "555-7210 zz 4875557211")
    for found, limit in ((tree, 1e-3), (loop, 0.25)):
        assert len(found) >= 4
        got = pii.shares(field, [found, [], found])
        assert np.abs(got[0] - marginals(field, found)).max() < limit
        assert np.allclose(got[0], got[2]) and got[1].shape[0] == 0


def test_awkward_rows(table, awkward):
    rows = awkward + [(50, "a@b.c"), (50, "a@b.c"), (51, "1.2.3.4 " * 3000), (52, "@"), (53, "+"), (54, "no digits at all. dot")]
    got = pii.find(table(rows))
    assert got.columns == ["doc_id", "base", "spans"]
    key = lambda i, s: (str(i), str([(x[0], x[1], x[2]) for x in s]))
    assert sorted(key(r["doc_id"], r["base"]) for r in got.collect()) == sorted(key(i, plain(t or "")) for i, t in rows)
    assert pii.find(table([])).collect() == []
    nothing = pii.find(table([(1, "abc 123"), (2, None)])).collect()
    assert [r["spans"] for r in nothing] == [[], []]


def test_query_columns(spark):
    got = queries.op13_pii(spark, "/root/testdata/sf0.001")
    assert got.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    for r in got.collect():
        base = plain(texts[r["doc_id"]])
        line = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in base)
        assert r["base_sha256"] == hashlib.sha256(line.encode()).hexdigest()
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [sum(k == n for _, k, _ in base) for n in range(4)]
        assert set(line.split(",")) - {""} <= set(r["spans"].split(","))
