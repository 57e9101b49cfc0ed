"""Answers, formulas, numbers and slot counts read out of text."""

from __future__ import annotations

import base64
import difflib
import hashlib
import json
import re
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leafline.functions import text as texts

#: Patterns of fractions, scripts, signs without operand, and commands that lost their beginning.
FRACTION = re.compile(r"\\(?:d?frac|tfrac)")
OPEN_SCRIPT = r"[\^_](?:$|\{\}|[)\]}=+\-*/^_])"
NO_OPERAND = r"(?:[=+\-*/]|\\times|\\div)\s*[)\]}]"
CUT_COMMAND = r"(?<![A-Za-z])(?:rac\}|xt\})"
#: Printed option lines; signs of places to answer at: quoted labels, labels before a colon, blanks.
OPTION_LINE = r"^\s*[A-Ha-h]\s*[.、．:：)）]"
QUOTED = r"[“\"‘'][^”\"’'\n]{1,24}[”\"’']\s*(?:[:：=]|(?i:is)\b|是)"
LABELLED = r"(?m)(?:^|[\s,，;；])[^\s,，;；:：=]{1,12}\s*[:：=](?!=)"
BLANK = r"_{2,}|\.{4,}|…{2,}|[\(（\[]\s*[_·.\s]*[\)）\]]"
#: Kinds by which an answer is one choice; parts of a tree that do not make it another.
CHOICE_ITEMS = ("choice", "single", "mcq")
VOLATILE = ("fingerprint", "validation", "created_at", "updated_at", "state", "provenance")


def parsed_answer(text: Column, slot_kind: Column, item_kind: Column) -> tuple[Column, Column]:
    """(answer, method): nothing of blank text, the one choice of a choice slot or item, else the text without white space around."""
    t = F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)^\s+|\s+$", "")
    is_choice = F.coalesce(F.contains(F.lower(slot_kind), F.lit("choice")), F.lit(False)) | F.coalesce(item_kind.isin(*CHOICE_ITEMS), F.lit(False))
    return F.when(t != "", F.when(is_choice, texts.found_choice(t)).otherwise(t)), F.when(t == "", "empty_input").when(is_choice, "choice").otherwise("verbatim_transcription")


def fill_answer(text: Column) -> Column:
    """A filled blank without numbering and the words for answer and solution; null if nothing stays."""
    return _without(text, (r"^[\d一二三四五六七八九十]+[.、．）)]", r"答[:：]?", r"解[:：]?"))


def essay_answer(text: Column) -> Column:
    """A long answer without numbering and an opening word for answer, solution or proof; null if nothing stays."""
    return _without(text, (r"^[\d一二三四五六七八九十]+[.、．）)]", r"^(答|解|证明|证)[:：]?"))


def _without(text: Column, patterns: tuple[str, ...]) -> Column:
    cleaned = reduce(lambda t, p: F.regexp_replace(t, p, ""), patterns, text)
    return F.nullif(F.regexp_replace(cleaned, r"(?U)^\s+|\s+$", ""), F.lit(""))


@F.pandas_udf(T.StringType())
def without_fragment(text: pd.Series, question: pd.Series) -> pd.Series:
    """The text without its longest run of characters that the question has too, if longer than 15. Python, as Spark has no common substring."""

    def one(t: str | None, q: str | None) -> str | None:
        if not t or not q:
            return t
        m = difflib.SequenceMatcher(None, t, q, autojunk=False).find_longest_match()
        return (t[: m.a] + t[m.a + m.size :]).strip() if m.size > 15 else t

    return pd.Series([one(t, q) for t, q in zip(text, question)], dtype="object")


def _closings(t: str) -> dict[int, int]:
    """Where each curly bracket that is closed has its end."""
    open_, out = [], {}
    for i, c in enumerate(t):
        if c == "{":
            open_.append(i)
        elif c == "}" and open_:
            out[open_.pop()] = i
    return out


def _whole_fractions(t: str | None) -> bool:
    """Whether every fraction command has two groups that hold something; one inside another's groups counts as broken."""
    t = t or ""
    ends, at, whole = _closings(t), 0, 0
    while m := FRACTION.search(t, at):
        place, groups = m.end(), []
        for _ in range(2):
            place += len(t[place:]) - len(t[place:].lstrip())
            if place not in ends:
                break
            groups.append(t[place + 1 : ends[place]])
            place = ends[place] + 1
        if len(groups) == 2 and all(groups):
            whole, at = whole + 1, place
        else:
            at = max(m.start() + 5, place + 1)
    return whole == len(FRACTION.findall(t)) and not re.search(r"(?<!\\)frac\s*[({]", t)


@F.pandas_udf(T.BooleanType())
def whole_fractions(text: pd.Series) -> pd.Series:
    return text.map(_whole_fractions)


def formula_issues(text: Column) -> Column:
    """Ordered faults of a formula's form: brackets, scripts, fractions, operands, cut commands."""
    return F.get(F.transform(F.array(F.struct(F.trim(text).alias("raw"), texts.compact(text).alias("t"), texts.balanced(text).alias("even"), whole_fractions(text).alias("whole"))), lambda x: F.array_compact(F.array(
        F.when(~x["even"], "UNBALANCED_EXPRESSION"), F.when(x["t"].rlike(OPEN_SCRIPT), "INCOMPLETE_SCRIPT"), F.when(~x["whole"], "MALFORMED_FRACTION"),
        F.when(x["t"].rlike(NO_OPERAND), "MISSING_OPERAND"), F.when(x["t"].rlike(CUT_COMMAND), "MALFORMED_FORMULA"),
    ))), F.lit(0))


def formula_signature(text: Column, issues: Column) -> Column:
    """What a formula's transcription is made of: whole brackets, fractions, scripts and operands, and its minus signs."""
    has = lambda code: ~F.array_contains(issues, code)
    minus = F.regexp_count(texts.compact(text), F.lit("-"))
    return F.struct(
        has("UNBALANCED_EXPRESSION").alias("balanced_delimiters"), has("MALFORMED_FRACTION").alias("fractions_complete"), has("INCOMPLETE_SCRIPT").alias("scripts_complete"),
        has("MISSING_OPERAND").alias("operands_complete"), minus.alias("minus_count"), (minus > 0).alias("has_minus_sign"),
    )


def number_in_text(text: Column) -> Column:
    """A number of up to three digits that a stop, bracket or the end follows; null without."""
    return F.nullif(F.regexp_extract(F.coalesce(text, F.lit("")), r"(?:^|[^0-9])([0-9]{1,3})(?:\s*[.、．:：)]|$)", 1), F.lit("")).try_cast("int")


def number_in_id(text: Column) -> Column:
    """A number of up to three digits that an underscore or the end follows; null without."""
    return F.nullif(F.regexp_extract(F.coalesce(text, F.lit("")), r"(?:^|[^0-9])([0-9]{1,3})(?:_|$)", 1), F.lit("")).try_cast("int")


def safe_float(text: Column) -> Column:
    return F.nullif(text, F.lit("")).try_cast("double")


def positive_int(text: Column) -> Column:
    value = F.trim(text).try_cast("int")
    return F.when(value > 0, value)


def printed_option(text: Column) -> Column:
    """Whether a line begins as a printed option does."""
    return F.coalesce(text.rlike(OPTION_LINE), F.lit(False))


def _printed(value: str, reference: str) -> bool:
    return len(value) >= 3 and bool(reference) and (value in reference or difflib.SequenceMatcher(None, value, reference).ratio() > 0.82)


@F.pandas_udf(T.BooleanType())
def resembles_print(value: pd.Series, references: pd.Series) -> pd.Series:
    """Whether a text, of three characters or more, lies in one of the references or is nearly one. Both are taken as texts.casefolded() makes them."""
    return pd.Series([any(_printed(v or "", r or "") for r in (rs if rs is not None else ())) for v, rs in zip(value, references)], dtype="bool")


def anchor_count(text: Column) -> Column:
    """How many places to answer at the form of a text tells of, from two on; else null."""
    t = F.coalesce(text, F.lit(""))
    n = F.greatest(*[F.regexp_count(t, F.lit(p)) for p in (QUOTED, LABELLED, BLANK)])
    return F.when(n >= 2, n)


def answer_parts(answer: Column) -> Column:
    """The parts of a written answer, which full-width semicolons divide."""
    return F.coalesce(F.transform(F.split(answer, "；"), F.trim), F.lit([]).cast("array<string>"))


def slot_count(declared: Column, kind: Column, answer: Column, text: Column) -> tuple[Column, Column]:
    """(count, source) of an item's slots: declared, one for a choice or long text, the parts of a filled answer, else the form of the text."""
    given = F.when(answer.isNotNull(), F.when(kind.isin("fill", "grid"), F.greatest(F.lit(1), F.size(answer_parts(answer)))).otherwise(1))
    options = [(declared > 0, declared, "vlm"), (kind == "essay", F.lit(1), "logical_free_response"), (kind == "choice", F.lit(1), "logical_choice_response"), (given > 0, given, "teacher_standard_answer"), (anchor_count(text).isNotNull(), anchor_count(text), "anonymous_layout_anchor")]
    chain = lambda at: reduce(lambda c, o: c.when(F.coalesce(o[0], F.lit(False)), o[at]), options, F.when(F.lit(False), options[0][at] if at == 1 else F.lit("")))
    return chain(1), chain(2)


def answer_for_marker(answer: Column, marker: Column) -> Column:
    """The part of a JSON answer for a sub-number: by its key in an object, with or without brackets; by place in a list; a single value for the first."""
    m, kind = marker.cast("string"), F.substring(F.trim(answer), 1, 1)
    by_key = F.from_json(answer, "map<string,string>")
    keys = [F.try_element_at(by_key, k) for k in (m, F.concat(F.lit("("), m, F.lit(")")), F.concat(F.lit("（"), m, F.lit("）")))]
    return F.when(kind == "{", F.coalesce(*keys)).when(kind == "[", F.try_element_at(F.from_json(answer, "array<string>"), marker.cast("int"))).when(marker == 1, answer)


def data_url(content: Column, mime: str = "image/png") -> Column:
    return F.concat(F.lit(f"data:{mime};base64,"), F.translate(F.base64(content), "\r\n", ""))


def timestamp_text(at: Column) -> Column:
    """ISO 8601 to the second, with the session's offset."""
    return F.date_format(at, "yyyy-MM-dd'T'HH:mm:ssxxx")


def hash_of(tree: dict) -> str:
    """SHA-256 over an object's canonical form: keys in order, no spaces, characters as they are, without the volatile keys."""
    value = {k: v for k, v in tree.items() if k not in VOLATILE}
    return "sha256:" + hashlib.sha256(json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":")).encode()).hexdigest()


@F.pandas_udf(T.StringType())
def canonical_hash(tree: pd.Series) -> pd.Series:
    """hash_of() a JSON object. Python, as to_json keeps order and drops nulls."""
    return tree.map(lambda t: None if t is None else hash_of(json.loads(t)))


#: A leading number however it goes on; a number in brackets.
LEADING = r"^\s*(?:第\s*)?([0-9]{1,3})\s*[.、．:：)）]?"
BRACKETED = r"[（(\[]\s*([0-9]{1,2})\s*[）)\]]"


def number_of(c: Column, pattern: str) -> Column:
    """The number that a pattern's group finds, null without."""
    return F.nullif(F.regexp_extract(F.coalesce(c, F.lit("")), pattern, 1), F.lit("")).try_cast("int")


def label_similarity(a: Column, b: Column, raw_a: Column, raw_b: Column, least: float, shortest: int = 3) -> Column:
    """Similarity of an anchor and a block, both given folded and raw: equal numbers make short labels nearly certain, texts of fewer letters than `shortest` are unlike, a text within the other counts by its length, all else is aligned."""
    low = F.least(F.char_length(a), F.char_length(b))
    return (
        F.when((a == "") | (b == ""), 0.0).when((number_of(raw_a, LEADING) == number_of(raw_b, LEADING)) & (low <= 3), 0.92).when((number_of(raw_a, BRACKETED) == number_of(raw_b, BRACKETED)) & (low <= 3), 0.90)
        .when(low < shortest, 0.0).when(F.contains(a, b) | F.contains(b, a), F.least(F.lit(1.0), low / 8.0)).otherwise(texts.alike_from(a, b, F.lit(least)))
    )


def structural_similarity(text: Column, block: Column) -> Column:
    """How alike a text and a block are by their letters, from 0 to 1; equal numbers or sub-numbers make a short label nearly certain, and one inside the other counts by its length."""
    return label_similarity(F.coalesce(texts.folded(text), F.lit("")), F.coalesce(texts.folded(block), F.lit("")), text, block, 0.0)


@F.pandas_udf(T.StringType())
def without_geometry(tree: pd.Series, names: pd.Series) -> pd.Series:
    """JSON without the members, at any depth, whose lower-case name holds one of the names. Python, as depth is open."""

    def strip(value, drop):
        if isinstance(value, dict):
            return {k: strip(v, drop) for k, v in value.items() if not any(d in k.lower() for d in drop)}
        return [strip(v, drop) for v in value] if isinstance(value, list) else value

    return pd.Series([None if t is None else json.dumps(strip(json.loads(t), list(n)), ensure_ascii=False) for t, n in zip(tree, names)], dtype="object")


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("before", T.StringType()), T.StructField("after", T.StringType())])))
def answer_contexts(text: pd.Series, count: pd.Series) -> pd.Series:
    """The 48 characters before and after each of the first `count` places to answer at, and the end of the text where there are fewer. Python, as Spark gives no places of matches."""
    from leafline.operators.candidates import answer_contexts as one

    return pd.Series([[{"before": b, "after": a} for b, a in one(t, int(n))] for t, n in zip(text, count)])


def decoded(data: str) -> bytes:
    """What a data URL holds."""
    return base64.b64decode(data.split(",", 1)[1])
