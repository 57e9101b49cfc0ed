"""Text normalisation, parsing and similarity. Each normaliser feeds another comparison; they are kept apart."""

from __future__ import annotations

import difflib
import re
import unicodedata
from collections import Counter

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Signs that mark a choice without naming it.
CHOICE_MARKS = ("✓", "✔", "√", "☑", "勾", "check", "tick")
NOT_WORD = r"(?U)[\W_]+"


def compact(text: Column) -> Column:
    """Without white space, minus sign and full-width brackets in ASCII, case kept; null is empty."""
    return F.translate(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)\s+", ""), "−（）", "-()")


def comparable(text: Column, formula: Column) -> Column:
    """compact(), for formulas without dollar signs, \\left and \\right."""
    plain = compact(text)
    return F.when(formula, F.replace(F.replace(F.replace(plain, F.lit("$"), F.lit("")), F.lit("\\left"), F.lit("")), F.lit("\\right"), F.lit(""))).otherwise(plain)


def squeezed(text: Column) -> Column:
    """Without white space, lower case; null is empty."""
    return F.lower(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)\s+", ""))


def letters(text: Column) -> Column:
    """Letters and digits of any script in lower case."""
    return F.lower(F.regexp_replace(F.coalesce(text, F.lit("")), NOT_WORD, ""))


def ascii_key(text: Column) -> Column:
    """ASCII letters and digits in lower case, without a leading q before digits."""
    return F.regexp_replace(F.lower(F.regexp_replace(F.coalesce(text, F.lit("")), "[^0-9A-Za-z]+", "")), "^q(?=[0-9])", "")


def answer_key(text: Column) -> Column:
    """Answers for comparing: no white space, × ÷ and dashes in ASCII, .0 dropped, punctuation dropped, lower case."""
    t = F.translate(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)\s+", ""), "×÷−–—", "*/---")
    return F.lower(F.regexp_replace(F.regexp_replace(t, r"\.0+\b", ""), "[,.;:，。；：、]", ""))


def _by_nfkc(change, finish):
    """A normaliser of NFKC forms to letters and digits. Python, as Spark has no NFKC."""

    @F.pandas_udf(T.StringType())
    def run(text: pd.Series) -> pd.Series:
        return text.map(lambda t: finish(re.sub(r"[\W_]+", "", change(unicodedata.normalize("NFKC", t or "")))))

    return run


#: LaTeX commands that do not count in a comparison; dashes and signs and what stands for them.
COMMANDS = re.compile(r"\\(?:frac|sqrt|left|right|mathrm|text|square)")
DASHES = str.maketrans({"−": "-", "–": "-", "—": "-", "×": "x"})

#: Letters and digits of the NFKC form: × taken as x, in lower case; in case-folded form; without LaTeX commands, in lower case.
folded = _by_nfkc(lambda t: t.translate(DASHES), str.lower)
casefolded = _by_nfkc(str, str.casefold)
formula_key = _by_nfkc(lambda t: COMMANDS.sub("", t), str.lower)


def choice(text: Column) -> Column:
    """An observed choice: ✓ for marks; A to H from a letter or listed letters, with brackets or stops around; else compact()."""
    t = F.translate(compact(text), "［］", "[]")
    one = r"^[(\[]?([A-Ha-h])[)\]]?[.。、]?$"
    many = r"^[(\[]?([A-Ha-h](?:[,，、/][A-Ha-h])+)[)\]]?$"
    return (
        F.when(F.lower(t).isin(*CHOICE_MARKS), "✓")
        .when(t.rlike(one), F.upper(F.regexp_extract(t, one, 1)))
        .when(t.rlike(many), F.regexp_replace(F.upper(F.regexp_extract(t, many, 1)), "[^A-H]", ""))
        .when(t.rlike("^[A-Ha-h]{2,8}$"), F.upper(t))
        .otherwise(t)
    )


def found_choice(text: Column) -> Column:
    """The one letter A to H that a text names, null if none or several: letters alone first, then with a stop, then any."""
    t = F.trim(text)
    alone = F.regexp_extract_all(t, F.lit(r"(?iU)\b([A-H])\b"), F.lit(1))
    stopped = F.regexp_extract_all(t, F.lit(r"(?i)([A-H])[.、)）]"), F.lit(1))
    any_ = F.regexp_extract_all(t, F.lit(r"(?i)([A-H])"), F.lit(1))
    seen = F.array_distinct(F.transform(F.when(F.size(alone) > 0, alone).when(F.size(stopped) > 0, stopped).otherwise(any_), F.upper))
    return F.when(F.lower(t).isin(*CHOICE_MARKS), "✓").when(F.size(seen) == 1, F.get(seen, F.lit(0)))


def number_in(text: Column) -> Column:
    """First digits as a number, null without."""
    return F.regexp_extract(F.coalesce(text, F.lit("")), "([0-9]+)", 1).try_cast("bigint")


def page_number(name: Column) -> Column:
    """Number of a page from its name: after page or p, after a dash or underscore at the end, a name of digits, else the last digits; 999999 without."""
    n = F.lower(F.coalesce(name, F.lit("")))
    parts = [F.nullif(F.regexp_extract(n, p, 1), F.lit("")) for p in (r"page[ _-]*([0-9]+)", r"\bp([0-9]+)\b", r"[_-]([0-9]+)(?:\.[a-z]+)?$", r"([0-9]+)[^0-9]*$")]
    return F.coalesce(*[p.try_cast("bigint") for p in parts], F.lit(999999))


def score_points(text: Column) -> Column:
    """Points in brackets, as （5分）; null without."""
    return F.nullif(F.regexp_extract(F.coalesce(text, F.lit("")), r"[（(]\s*([0-9]+(?:\.[0-9]+)?)\s*分\s*[)）]", 1), F.lit("")).try_cast("double")


def safe_id(text: Column) -> Column:
    """Runs of other than word characters, dots and dashes as one underscore, none at the ends."""
    return F.regexp_replace(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)[^\w.-]+", "_"), "^_+|_+$", "")


def ngrams(text: Column, n: int = 4) -> Column:
    """Distinct runs of n characters."""
    last = F.char_length(text) - n
    return F.when(last < 0, F.lit([]).cast("array<string>")).otherwise(F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(last + 1, F.lit(1))), lambda i: F.substring(text, i, F.lit(n)))))


def overlap(a: Column, b: Column) -> Column:
    """Share of the distinct elements of a that b has; null for an empty a."""
    return F.try_divide(F.size(F.array_intersect(a, b)).cast("double"), F.size(F.array_distinct(a)).cast("double"))


def equal_answers(a: Column, b: Column) -> Column:
    """Whether two arrays of answers are equal part by part by compact(); nulls equal nothing. Never null."""
    pairs = F.zip_with(a, b, lambda x, y: x.isNotNull() & y.isNotNull() & (compact(x) == compact(y)))
    return F.coalesce((F.size(a) == F.size(b)) & F.forall(pairs, lambda p: F.coalesce(p, F.lit(False))), F.lit(False))


def kind(text: Column, named: Column) -> Column:
    """Kind of an item from its declared name, else from signs in its text."""
    n, t = F.lower(F.coalesce(named, F.lit(""))), F.coalesce(text, F.lit(""))
    return (
        F.when(n.rlike("choice|single|judg|选择|判断"), "choice")
        .when(n.rlike("fill|blank|填空"), "fill")
        .when(n.rlike("essay|composition|作文"), "essay")
        .when(F.regexp_count(t, F.lit(r"\b[A-D][.、)]")) >= 2, "choice")
        .when(t.rlike("_{2,}|（ *）|\\( *\\)"), "fill")
        .when(F.char_length(t) > 400, "essay")
        .otherwise("short")
    )


@F.pandas_udf(T.DoubleType())
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """difflib's ratio of matching blocks. Python: no built-in function is this metric."""
    return pd.Series([None if x is None or y is None else difflib.SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def alike_from(a: pd.Series, b: pd.Series, least: pd.Series) -> pd.Series:
    """difflib's ratio where it is `least` or more, else nought: texts whose letters alone rule that out are not aligned."""
    counts: dict[str, Counter] = {}
    of = lambda t: counts.setdefault(t, Counter(t))
    matcher, seen = difflib.SequenceMatcher(None), None
    out = []
    for x, y, m in zip(a, b, least):
        if not x or not y:
            out.append(0.0)
            continue
        total = len(x) + len(y)
        if 2 * min(len(x), len(y)) < m * total or 2 * (of(x) & of(y)).total() < m * total:
            out.append(0.0)
            continue
        if y != seen:
            matcher.set_seq2(y)
            seen = y
        matcher.set_seq1(x)
        r = matcher.ratio()
        out.append(r if r >= m else 0.0)
    return pd.Series(out, dtype="float64")


@F.pandas_udf(T.BooleanType())
def balanced(text: pd.Series) -> pd.Series:
    """Whether round, square and curly brackets nest, those after a backslash apart."""
    closes = {")": "(", "]": "[", "}": "{"}

    def one(t: str | None) -> bool:
        open_: list[str] = []
        for c in re.sub(r"\\.", "", t or "", flags=re.S):
            if c in closes.values():
                open_.append(c)
            elif c in closes and (not open_ or open_.pop() != closes[c]):
                return False
        return not open_

    return text.map(one)


def content_issues(text: Column, confidence: Column, kind_: Column, stem: Column) -> Column:
    """Ordered issues of a transcription: empty, low confidence, invalid choice, text of the question, cut off, a bare mark."""
    return F.get(F.transform(F.array(compact(text)), lambda t: F.array_compact(F.array(  # the compact text is made once
        F.when(t == "", "EMPTY"),
        F.when(F.coalesce(confidence, F.lit(0.0)) < 0.65, "LOW_CONFIDENCE"),
        F.when((t != "") & (kind_ == "choice") & ~choice(text).rlike("^([A-H]{1,8}|✓)$"), "INVALID_CHOICE"),
        F.when((F.char_length(t) >= 8) & F.contains(compact(stem), t), "STEM_TEXT"),
        F.when(t.rlike(r"(\.\.\.|…)$"), "TRUNCATED"),
        F.when((F.char_length(t) <= 5) & t.rlike(r"^[(\[]?[0-9]{1,2}[)\].、]?$") & (kind_ != "choice"), "MARKER_ONLY"),
    ))), F.lit(0))
