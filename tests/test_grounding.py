import difflib
import random
import re
import unicodedata
from collections import Counter

import pytest
from pyspark.sql import functions as F

from leafline.functions.text import alike_from
from leafline.operators import grounding

Q = "document string, question_ord int, question_id string, number int, text string, refs array<struct<page_index: int, anchor: string>>"
I = "document string, question_id string, item_ord int, item_id string, label string, text string, refs array<struct<page_index: int, anchor: string>>"  # noqa: E741
B = "document string, page_index int, col int, place int, x double, text string"
P = "document string, page_index int, page_ord int"


def norm(t):
    t = unicodedata.normalize("NFKC", t or "").translate(str.maketrans({"−": "-", "–": "-", "—": "-", "×": "x"}))
    return re.sub(r"[\W_]+", "", t).lower()


def number(pattern, t):
    m = re.search(pattern, t or "")
    return int(m.group(1)) if m else None


def similarity(a, b):
    x, y = norm(a), norm(b)
    if not x or not y:
        return 0.0
    low = min(len(x), len(y))
    for pattern, sure in ((grounding.LEADING, 0.92), (grounding.BRACKETED, 0.90)):
        if low <= 3 and number(pattern, a) is not None and number(pattern, a) == number(pattern, b):
            return sure
    if low < 3:
        return 0.0
    return min(1.0, low / 8) if x in y or y in x else difflib.SequenceMatcher(None, x, y).ratio()


def expected(questions, items, blocks, pages):
    """The rules one question, item and block after another, every pair aligned."""
    out = []
    for d in sorted({p[0] for p in pages}):
        own = [b for b in blocks if b[0] == d]
        page_ord = {p[1]: p[2] for p in pages if p[0] == d}
        left = {}
        for b in own:
            left[b[1], b[2]] = min(left.get((b[1], b[2]), 1e9), b[4])
        num = {b[1:4]: number(grounding.NUMBER, b[5]) if b[4] <= left[b[1], b[2]] + 1654 * 0.12 else None for b in own}
        evidence, covered, positions = {k for k, n in num.items() if n is not None}, {}, []
        for _, _, qid, n, text, refs in sorted((q for q in questions if q[0] == d), key=lambda q: q[1]):
            domains = {}
            for at, (page, anchor) in enumerate(refs):
                here = sorted((b for b in own if b[1] == page), key=lambda b: b[2:4])
                mine = [b for b in here if num[b[1:4]] == n]
                scored = sorted(((-(similarity(anchor, b[5]) + (0.12 if number(grounding.LEADING, anchor) == n == number(grounding.LEADING, b[5]) else 0.0)), b[2], b[3], b) for b in (mine if at == 0 and mine else here)), key=lambda s: s[:3])
                if not scored or not (-scored[0][0] >= 0.45 or len(mine) == 1 and at == 0) or len(scored) > 1 and -scored[0][0] - -scored[1][0] < 0.05:
                    out.append((d, "QUESTION_ANCHOR_UNRESOLVED", qid, page))
                    continue
                best = scored[0][3]
                ends = [k[2] for k in evidence if k[:2] == best[1:3] and k[2] > best[3]]
                domains[page] = [b for b in here if b[2] == best[2] and b[3] >= best[3] and (not ends or b[3] < min(ends))]
                if num[best[1:4]] == n:
                    covered.setdefault(best[1:4], []).append(qid)
                elif at == 0:
                    out.append((d, "QUESTION_NUMBER_UNCONFIRMED", qid, page))
                if at == 0:
                    positions.append((page_ord[page], best[2], best[3]))
            of_q = sorted((i for i in items if i[0] == d and i[1] == qid), key=lambda i: i[2])
            starts = {}
            for _, _, _, iid, _, itext, irefs in of_q:
                for page, anchor in irefs:
                    area = domains.get(page, [])
                    scored = sorted(((-similarity(anchor, b[5]), b[3]) for b in area))
                    short = number(grounding.BRACKETED, anchor) is not None and scored and -scored[0][0] >= 0.86
                    if len(of_q) == 1 and area and similarity(itext, area[0][5]) >= 0.45:
                        place = area[0][3]
                    elif not scored or -scored[0][0] < 0.45 and not short or len(scored) > 1 and -scored[0][0] - -scored[1][0] < 0.05 and not short:
                        out.append((d, "ITEM_ANCHOR_UNRESOLVED", iid, page))
                        continue
                    else:
                        place = scored[0][1]
                    if place in starts.get(page, []):
                        out.append((d, "SHARED_ITEM_OCR_ANCHOR", iid, page))
                    starts.setdefault(page, []).append(place)
            out += [(d, "ITEM_READING_ORDER_CONFLICT", qid, page) for page, s in starts.items() if s != sorted(s)]
            area = [b[5] for v in domains.values() for b in v]
            subs, labels = {m.group(1) for t in area for m in [re.match(r"^\s*[（(](\d{1,2})[）)]", t)] if m}, {m.group(1) for i in of_q for m in [re.search(r"[（(](\d{1,2})[）)]", i[4])] if m}
            seen, known = {m for t in area for m in re.findall(r"(?:^|\s)([A-H])[.、．)]", t)}, {m for t in [text, *[i[5] for i in of_q]] for m in re.findall(r"(?:^|\s)([A-H])[.、．)]", t)}
            for code, got, have in (("SUBQUESTION_COVERAGE_CONFLICT", subs, labels), ("OPTION_COVERAGE_CONFLICT", seen, known)):
                if len(got) >= 2 and not got <= have:
                    out.append((d, code, f"{qid}:{','.join(sorted(got - have))}", None))
        out += [(d, "DUPLICATE_QUESTION_ANCHOR", q, k[0]) for k, qs in covered.items() for q in sorted(qs)[1:]]
        out += [(d, "OCR_QUESTION_NOT_COVERED", str(num[k]), k[0]) for k in evidence - covered.keys()]
        out += [(d, "READING_ORDER_CONFLICT", None, None)] if positions != sorted(positions) else []
        out += [(d, "NO_OCR_NUMBER_EVIDENCE", None, None)] if not evidence else []
    return sorted(map(str, out))


def made(seed, documents):
    """Papers with numbered questions in two columns and proposals that misname, misplace, repeat and leave out."""
    rng = random.Random(seed)
    words = [a + b for a in ("ka", "lo", "mi", "nu", "pe") for b in ("ran", "tol", "sib", "gug", "vex")]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    qs, its, bs, ps = [], [], [], []
    for d in range(documents):
        doc, n = f"d{d}", 0
        for page in (1, 2):
            ps.append((doc, page, page))
            for col in (0, 1):
                place = 0
                for _ in range(rng.randrange(1, 4)):
                    n += 1
                    title, subs = say(5), [say(6) for _ in range(rng.randrange(0, 4))]
                    lines = [f"{n}. {title}" if d % 7 else title, *[f"（{k}）{s}" for k, s in enumerate(subs, 1)]]
                    if rng.random() < 0.4:
                        lines.append("A. " + say(2) + " B. " + say(2))
                    for t in lines:
                        bs.append((doc, page, col, place, 100.0 + 900 * col + (5 if t[0].isdigit() else 30), t))
                        place += 1
                    if rng.random() < 0.1:
                        continue
                    blur = lambda t: "".join(c for c in t if rng.random() > 0.15) if rng.random() < 0.5 else t
                    number = n if rng.random() < 0.9 else n + 1
                    qid = f"{doc}q{n}"
                    refs = [(page, rng.choice([f"{n}. {blur(title)}", blur(title), say(4), f"{n}."]))] + ([(3 - page, say(3))] if rng.random() < 0.1 else [])
                    qs.append((doc, n if rng.random() < 0.9 else n - 2, qid, number, title + rng.choice(["", " A. x B. y"]), refs))
                    order = list(enumerate(subs, 1))
                    if rng.random() < 0.2:
                        rng.shuffle(order)
                    kept = order[: len(order) - (rng.random() < 0.2)] or [(0, title)]
                    for k, (label, s) in enumerate(kept):
                        its.append((doc, qid, k, f"{qid}i{k}", f"({label})", s, [(page, rng.choice([f"（{label}）{blur(s)}", blur(s), f"({label})", say(3)]))]))
    seen = set()
    qs = [q for q in qs if (q[0], q[1]) not in seen and not seen.add((q[0], q[1]))]
    known = {q[2] for q in qs}
    return qs, [i for i in its if i[1] in known], bs, ps


def test_issues_are_those_of_all_pairs(spark):
    tables = made(1, 24)
    want = expected(*tables)
    out = grounding.text_issues(*[spark.createDataFrame(r, s) for r, s in zip(tables, (Q, I, B, P))])
    assert out.columns == ["document", "code", "owner", "page_index"]
    assert sorted(str(tuple(r)) for r in out.collect()) == want
    codes = {w.split("'")[3] for w in want}
    assert codes == {
        "QUESTION_ANCHOR_UNRESOLVED", "QUESTION_NUMBER_UNCONFIRMED", "DUPLICATE_QUESTION_ANCHOR", "ITEM_ANCHOR_UNRESOLVED", "SHARED_ITEM_OCR_ANCHOR", "ITEM_READING_ORDER_CONFLICT", "SUBQUESTION_COVERAGE_CONFLICT",
        "OPTION_COVERAGE_CONFLICT", "READING_ORDER_CONFLICT", "OCR_QUESTION_NOT_COVERED", "NO_OCR_NUMBER_EVIDENCE",
    }


@pytest.mark.parametrize("least", [0.0, 0.28, 0.45, 0.585])
def test_the_bound_loses_no_pair(spark, monkeypatch, least):
    rng = random.Random(2)
    texts = ["".join(rng.choice("abcdeé") for _ in range(rng.randrange(0, 30))) for _ in range(60)] + [None]
    pairs = [(a, b) for a in texts for b in texts[::3]]
    df = spark.createDataFrame(pairs, "a string, b string")
    got = [r[0] for r in df.select(alike_from("a", "b", F.lit(least))).collect()]
    exact = [difflib.SequenceMatcher(None, a, b).ratio() if a and b else 0.0 for a, b in pairs]
    assert got == [x if x >= least else 0.0 for x in exact]
    if least >= 0.45:
        bound = [2 * sum((Counter(a) & Counter(b)).values()) / (len(a) + len(b)) for a, b in pairs if a and b]
        assert sum(x >= least for x in bound) < len(bound) * 0.95  # some pairs are never aligned


def test_templates_and_empty_tables(spark):
    empty = [spark.createDataFrame([], s) for s in (Q, I, B, P)]
    other = spark.createDataFrame([("d", 3, "supplementary_template", "sheet"), ("d", 4, "original", "cover")], "document string, page_index int, source string, reason string")
    assert [tuple(r) for r in grounding.text_issues(*empty, other).collect()] == [("d", "SUPPLEMENTARY_TEMPLATE_EXCLUDED", "sheet", 3)]
