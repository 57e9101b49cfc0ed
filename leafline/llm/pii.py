"""Personal data: base patterns, and a skip-chain conditional random field that finds further mentions.

The variables are a document's mentions: what a base pattern finds, whose labels are known, and other tokens with digits
or the shape of an address, whose labels are inferred: none, email, ip, card or phone. Neighbouring mentions are linked
as a chain; distant ones that repeat one another, or are alike in one of their keys (the digits whatever stands between
them, the last ten or seven digits of a telephone number, an address spelled out or its local part), share a potential.
Loopy message passing over each document makes the labels of linked mentions agree.

Weights are fitted by pseudo-likelihood on the mentions of all documents, counted by pattern of features: base mentions,
tokens linked to none, and base mentions rewritten in forms that the base patterns miss, once linked to their original
and once alone.
"""

from __future__ import annotations

import dataclasses
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafline.llm.storage import tune, written

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
#: Labels: none, then the kinds.
LABELS = 1 + len(KINDS)
#: Patterns of features that weights are fitted on, most frequent first; shares that a label needs to be given; rounds of messages.
MOST_PATTERNS = 50_000
SURE = 0.6
ROUNDS = 25
#: Mentions that lie at most so many characters apart are linked as a chain.
NEAR = 40

# Fixed values. Possessive repeats give the same matches in a time that grows with the text's length only.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_DIGIT = re.compile(r"[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_MARKED = re.compile(r"[0-9@]\S*+")
_SPELLED = re.compile(r"(?:\(at\)|\[at\]|\{at\}|(?<=\s)at(?=\s))", re.IGNORECASE)
_AFTER = re.compile(r"\s?([\w-]++(?:(?:\.|\s?\(dot\)\s?|\s?\[dot\]\s?|\s?\{dot\}\s?|\sdot\s)[\w-]++)++)", re.IGNORECASE)
_DOTS = re.compile(r"\s?(?:\(dot\)|\[dot\]|\{dot\})\s?|\sdot\s", re.IGNORECASE)
_ATS = re.compile(r"\s?(?:\(at\)|\[at\]|\{at\})\s?|\sat\s", re.IGNORECASE)
_NUMERIC = re.compile(r"[0-9()+./\-]++")
_EDGE = "\"'`,;:!?<>[]{}|*#$&%=~^_.-/\\"

Mention = tuple[int, int, int, str]  # start, end, kind or -1, the text


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(2 * int(d) - 9 * (d > "4") for d in even)) % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of what the base patterns find, in order: leftmost matches of each kind that do not overlap, those that fail its test dropped."""
    out, done = [], 0
    for m in _DOMAIN.finditer(text) if "@" in text else ():
        start = m.start()
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            out.append((start, EMAIL, m.end()))
            done = m.end()
    if _DIGIT.search(text):
        out += [(m.start(), IP, m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m.group().split("."))]
        for kind, pattern, least, most in ((CARD, _CARD, 14, 19), (PHONE, _PHONE, 10, 15)):
            for m in pattern.finditer(text):
                digits = _NOT_DIGIT.sub("", m.group())
                if least <= len(digits) <= most and (kind == PHONE or luhn(digits)):
                    out.append((m.start(), kind, m.end()))
    return sorted(out)


def _trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    while start < end and text[start] in _EDGE:
        start += 1
    while start < end and text[end - 1] in _EDGE:
        end -= 1
    if text[start:end].count("(") > text[start:end].count(")") and text[start] == "(":
        start += 1
    if text[start:end].count(")") > text[start:end].count("(") and text[end - 1] == ")":
        end -= 1
    return start, end


def mentions(text: str) -> list[Mention]:
    """The base mentions and all other tokens that may be mentions, by place.

    Neighbouring tokens of digits and separators, of at most eight digits each and nineteen in all, are one mention.
    """
    base = base_spans(text)
    out = [(a, b, k, text[a:b]) for a, k, b in base]
    taken, at = sorted((a, b) for a, _, b in base), 0
    tokens: list[tuple[int, int]] = []
    done = 0

    def free(a: int, b: int) -> bool:
        nonlocal at
        while at < len(taken) and taken[at][1] <= a:
            at += 1
        return not any(x < b for x, _ in taken[at : at + 4])

    for m in _MARKED.finditer(text):
        start = m.start()
        while start > done and not text[start - 1].isspace():
            start -= 1
        done = m.end()
        if free(start, m.end()):
            a, b = _trimmed(text, start, m.end())
            if a < b:
                tokens.append((a, b))
    merged: list[tuple[int, int, int, bool]] = []  # with the number of digits and whether the next token may be joined
    for a, b in tokens:
        n = len(_NOT_DIGIT.sub("", text[a:b]))
        short = n <= 8 and _NUMERIC.fullmatch(text[a:b]) is not None
        if short and merged and merged[-1][3] and merged[-1][1] + 1 == a and text[a - 1] == " " and merged[-1][2] + n <= 19:
            merged[-1] = (merged[-1][0], b, merged[-1][2] + n, True)
        else:
            merged.append((a, b, n, short))
    at, spelled = 0, []
    for m in _SPELLED.finditer(text):
        after = _AFTER.match(text, m.end())
        start = m.start() - (m.start() > 0 and text[m.start() - 1].isspace())
        end = start
        while start > 0 and text[start - 1] in _LOCAL:
            start -= 1
        if after and start < end and free(start, after.end()):
            spelled.append((start, after.end()))
    within = lambda a, b: any(x < b and a < y for x, y in spelled)  # noqa: E731  few are spelled out
    out += [(a, b, -1, text[a:b]) for a, b, _, _ in merged if not within(a, b)] + [(a, b, -1, text[a:b]) for a, b in spelled]
    return sorted(out)


def keys(form: str) -> list[str]:
    """What likens a mention to others."""
    if not _MARKED.search(form) and not _SPELLED.search(form):
        return []
    flat = _DOTS.sub(".", _ATS.sub("@", form)).lower()
    digits, out = _NOT_DIGIT.sub("", form), []
    local, _, domain = flat.partition("@")
    if domain:
        out += [f"m{flat}", f"l{local}"] if len(local) >= 4 else [f"m{flat}"]
        out.append(f"m{local}@{domain.rpartition('.')[0] or domain}")
    elif not flat.isdigit() and any(c.isalpha() for c in flat):
        return [f"l{flat}"] if len(flat) >= 4 and len(digits) < len(flat) else []
    else:
        groups = _DIGIT.search(form) and re.findall(r"[0-9]+", form) or []
        if len(groups) == 4 and all(len(g) <= 3 and int(g) <= 255 for g in groups):
            out.append("i" + ".".join(groups))
        if len(digits) >= 7:
            out.append(f"d{digits.removeprefix('00')}")
        if 10 <= len(digits) <= 15:
            out += [f"t{digits[-10:]}", f"s{digits[-7:]}"]
        if len(digits) == 7:
            out.append(f"s{digits}")
    return out


def shape(form: str) -> tuple[int, ...]:
    """Features of a mention by itself: how `at` is written, how many digits and groups of them, and yes or no for a valid checksum, a leading plus, four parts of at most 255, letters; the label that a base pattern gives it when it stands alone."""
    at = 1 if "@" in form else 0 if not (m := _SPELLED.search(form)) else 2 if m.group()[0] in "([{" else 3
    groups = re.findall(r"[0-9]+", form)
    digits = "".join(groups)
    size = next((i for i, n in enumerate((0, 3, 6, 7, 9, 10, 13, 15, 16, 19)) if len(digits) <= n), 10)
    four = len(groups) == 4 and all(len(g) <= 3 and int(g) <= 255 for g in groups)
    whole = next((k + 1 for a, k, b in base_spans(form) if (a, b) == (0, len(form))), 0)
    return at, size, min(len(groups), 5), int(14 <= len(digits) <= 19 and luhn(digits)), int(form.startswith("+")), int(four), int(any(c.isalpha() for c in form)), whole


#: How many values each feature of shape() has.
SIZES = (4, 11, 6, 2, 2, 2, 2, 5)
WIDTH = 1 + sum(SIZES)


def _columns(s: tuple[int, ...]) -> list[int]:
    out, before = [0], 1
    for v, n in zip(s, SIZES):
        out.append(before + v)
        before += n
    return out


def links(found: list[Mention]) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Pairs of a document's mentions that are neighbours, and pairs that are alike: each with the base mention met first under a common key, else with the one before it."""
    chain = [(i, i + 1) for i in range(len(found) - 1) if found[i + 1][0] - found[i][1] <= NEAR]
    first: dict[str, int] = {}
    own = [keys(m[3]) for m in found]
    for i, m in enumerate(found):
        for k in own[i] if m[2] >= 0 else ():
            first.setdefault(k, i)
    alike: dict[tuple[int, int], None] = {}
    last: dict[str, int] = {}
    for i in range(len(found)):
        for k in own[i]:
            j = first.get(k, last.get(k))
            if j is not None and j != i:
                alike[min(i, j), max(i, j)] = None
            last[k] = i
    return chain, list(alike)


def rewritten(kind: int, form: str) -> list[str]:
    """Forms of a base mention that the base patterns may miss."""
    digits = _NOT_DIGIT.sub("", form)
    if kind == EMAIL:
        local, _, domain = form.partition("@")
        return [f"{local}{at}{dot.join(domain.split('.'))}" for at, dot in ((" at ", " dot "), (" at ", "."), ("(at)", "(dot)"), (" [at] ", "."))] + [f"{local}@{domain.rpartition('.')[0]}", local]
    if kind == IP:
        return [s.join(form.split(".")) for s in ("-", "[.]", " ", "/")]
    if kind == CARD:
        return [s.join(digits[i : i + 4] for i in range(0, len(digits), 4)) for s in (".", "/")]
    own = digits[-10:]
    return [digits, f"00{digits}", own] + [s.join((own[:3], own[3:6], own[6:])) for s in (".", "-", " ", "/")] + [f"({own[:3]}) {own[3:6]}-{own[6:]}", f"{own[3:6]}-{own[6:]}", own[3:]]


#: Shape, labels beside, labels of those alike, label, and where the example is from: its label's base mentions (or, for none, other tokens), or their rewritten forms, linked or alone.
Pattern = tuple[tuple[int, ...], tuple[int, ...], tuple[int, ...], int, str]


def patterns(found: list[Mention]) -> Iterator[Pattern]:
    """A document's examples."""
    chain, alike = links(found)
    label = [m[2] + 1 for m in found]
    beside: list[list[int]] = [[] for _ in found]
    like: list[list[int]] = [[] for _ in found]
    for pairs, into in ((chain, beside), (alike, like)):
        for i, j in pairs:
            into[i].append(label[j])
            into[j].append(label[i])
    for i, m in enumerate(found):
        near, far = tuple(sorted(beside[i])), tuple(sorted(like[i])[-3:])
        if label[i] == 0:
            if not any(far):
                yield shape(m[3]), near, far, 0, "met"
            continue
        yield shape(m[3]), near, far, label[i], f"base {label[i]}"
        own = {*keys(m[3])}
        for form in rewritten(m[2], m[3]):
            other = mentions(form)
            if len(other) == 1 and other[0][2] < 0 and own.intersection(keys(other[0][3])):
                s = shape(other[0][3])
                yield s, near, (label[i],), label[i], f"linked {label[i]}"
                yield s, near, (), label[i] if s[0] == 2 else 0, f"alone {label[i]}"


@dataclasses.dataclass(frozen=True)
class Field:
    """Weights of a mention's own features, of neighbours and of those alike; tables of labels by labels are symmetric."""

    own: np.ndarray
    chain: np.ndarray
    alike: np.ndarray


def fit(counted: list[tuple[Pattern, int]]) -> Field:
    """Weights with the largest pseudo-likelihood of counted patterns by Newton steps with a ridge; examples of each origin weigh the same in all, so only shares of the counts matter."""
    x, y = np.zeros((len(counted), WIDTH + 2 * LABELS)), np.zeros(len(counted), int)
    weight = np.array([n for _, n in counted], float)
    origin = np.array([p[4] for p, _ in counted])
    for i, ((s, near, far, label, _), _) in enumerate(counted):
        x[i, _columns(s)] = 1
        for k in near:
            x[i, WIDTH + k] += 1
        for k in far:
            x[i, WIDTH + LABELS + k] += 1
        y[i] = label
    for o in {*origin}:
        weight[origin == o] *= 1000 / weight[origin == o].sum()
    d = x.shape[1]
    w = np.zeros((LABELS, d))
    for _ in range(25):
        z = x @ w.T
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        slope = np.zeros((LABELS, d))
        curve = np.eye(LABELS * d)
        for a in range(LABELS):
            slope[a] = x.T @ (weight * (p[:, a] - (y == a))) + w[a]
            for b in range(LABELS):
                h = weight * p[:, a] * ((a == b) - p[:, b])
                curve[a * d : (a + 1) * d, b * d : (b + 1) * d] += (x * h[:, None]).T @ x
        step = np.linalg.solve(curve, slope.ravel()).reshape(w.shape)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    both = lambda t: (t + t.T) / 2
    return Field(w[:, :WIDTH].T.copy(), both(w[:, WIDTH : WIDTH + LABELS]), both(w[:, WIDTH + LABELS :]))


def shares(field: Field, documents: list[list[Mention]]) -> list[np.ndarray]:
    """Each mention's share of each label after message passing, document by document; known labels are certain."""
    begins = np.cumsum([0, *map(len, documents)])
    flat = [m for found in documents for m in found]
    known = np.array([m[2] + 1 for m in flat], int)
    own = np.array([field.own[_columns(shape(m[3]))].sum(0) if m[2] < 0 else np.zeros(LABELS) for m in flat]).reshape(len(flat), LABELS)
    a: list[int] = []
    b: list[int] = []
    kind: list[int] = []
    for begin, found in zip(begins, documents):
        for t, pairs in enumerate(links(found)):
            for i, j in pairs:
                i, j = i + begin, j + begin
                if known[i] and known[j]:
                    continue
                if known[i] or known[j]:  # a known neighbour is a constant
                    i, j = (i, j) if known[j] else (j, i)
                    own[i] += (field.chain, field.alike)[t][known[j]]
                else:
                    a += [i, j]
                    b += [j, i]
                    kind += [t, t]
    if a:
        source, target = np.array(a), np.array(b)
        table = np.stack([field.chain, field.alike])[np.array(kind)]
        sent = np.zeros((len(a), LABELS))
        back = np.arange(len(a)) ^ 1
        for _ in range(ROUNDS):
            belief = own.copy()
            np.add.at(belief, target, sent)
            z = (belief[source] - sent[back])[:, :, None] + table
            top = z.max(1)
            new = top + np.log(np.exp(z - top[:, None, :]).sum(1))
            new -= new.max(1, keepdims=True)
            moved = np.abs(new - sent).max()
            sent = (sent + new) / 2
            if moved < 1e-4:
                break
        belief = own.copy()
        np.add.at(belief, target, sent)
    else:
        belief = own
    p = np.exp(belief - belief.max(1, keepdims=True)) if len(flat) else belief
    p = p / p.sum(1, keepdims=True) if len(flat) else p
    p[known > 0] = np.eye(LABELS)[known[known > 0]]
    return [p[i:j] for i, j in zip(begins, begins[1:])]


MENTIONS = "array<struct<start: bigint, end: bigint, kind: int, form: string>>"
SPANS = "array<struct<start: bigint, kind: int, end: bigint>>"


def find_mentions(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, mentions) of each row."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.int32()), ("form", pa.string())]))
        for b in batches:
            found = [[dict(zip(("start", "end", "kind", "form"), m)) for m in mentions(t or "")] for t in b["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([b["id"], pa.array(found, kind)], ["id", "mentions"])

    known = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    tune(docs.sparkSession)
    return known.mapInArrow(of, f"id {known.schema['id'].dataType.simpleString()}, mentions {MENTIONS}")


def _of(row: list[dict] | None) -> list[Mention]:
    return [(m["start"], m["end"], m["kind"], m["form"]) for m in row or []]


def count_patterns(found: DataFrame) -> list[tuple[Pattern, int]]:
    """Patterns of all documents and how often each is met, at most MOST_PATTERNS of them: they are told apart by a few features of few values."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = Counter(repr(p) for row in b["mentions"].to_pylist() for p in patterns(_of(row)))
            yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64())], ["pattern", "n"])

    import ast

    lines = found.select("mentions").filter(F.size("mentions") > 0).mapInArrow(counted, "pattern string, n bigint").groupBy("pattern").agg(F.sum("n").alias("n"))
    return [(ast.literal_eval(r["pattern"]), r["n"]) for r in lines.orderBy(F.desc("n"), "pattern").limit(MOST_PATTERNS).collect()]


def label_mentions(found: DataFrame, field: Field | None) -> DataFrame:
    """(id, base, spans): what the base patterns found and that with what the field adds, by start and kind."""

    def labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))
        as_row = lambda spans: [dict(zip(("start", "kind", "end"), s)) for s in sorted(spans)]
        for b in batches:
            rows = [_of(r) for r in b["mentions"].to_pylist()]
            base = [[(m[0], m[2], m[1]) for m in found if m[2] >= 0] for found in rows]
            spans = [list(s) for s in base]
            asked = [i for i, s in enumerate(base) if len(s) < len(rows[i])] if field is not None else []
            for i, p in zip(asked, shares(field, [rows[i] for i in asked])) if asked else ():
                best = p.argmax(1)
                spans[i] += [(m[0], int(k) - 1, m[1]) for m, k, s in zip(rows[i], best, p.max(1)) if m[2] < 0 and k and s >= SURE]
            yield pa.RecordBatch.from_arrays([b["id"], pa.array([as_row(s) for s in base], kind), pa.array([as_row(s) for s in spans], kind)], ["id", "base", "spans"])

    return found.mapInArrow(labelled, f"id {found.schema['id'].dataType.simpleString()}, base {SPANS}, spans {SPANS}")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, base, spans) of each row; a span has start and end in code points, end exclusive, and its kind's place in KINDS.

    Null and empty texts have no spans. Null and repeated ids, ties and repeated rows are rows like others; each is its
    own document. Texts of any length are read whole. An empty table gives no rows; without any base mention nothing is
    added. Other columns are dropped. Mentions are written once; statistics and inference read those, not the texts.
    """
    found = written(find_mentions(docs, id_col, text_col), "pii-mentions")
    counted = count_patterns(found)
    field = fit(counted) if any(p[3] for p, _ in counted) else None
    return label_mentions(found, field).withColumnRenamed("id", id_col)


def as_text(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
