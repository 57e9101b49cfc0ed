"""Rules of a document's tree, merging of pages into it, and its joins with what was found on pages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leafline.functions import boxes, text
from leafline.operators.aggregates import reports
from leafline.operators.assignment import greedy_places

#: Kinds that an item may have; ends of a text that goes on; words that go on from the page before.
ITEM_KINDS = ("choice", "fill", "short", "essay", "solve", "grid", "reading", "composite", "other")
OPEN_END = r"[，,:：；;、—=+×÷<≥≤/\\-]$|(且|而|又|并且|由于|若|因为|所以|如图|可知|即|则|求|试求|解得|证明|满足)$"
GOES_ON = r"^(解得|综上所述|综上|故：|故|证明：|证明|如图|代入得|又因为|所以)"
NUMBERED = r"(?:^|[^0-9])[0-9]{1,3}[.、．:：)]"


def tree_report(sections: DataFrame, questions: DataFrame, items: DataFrame, slots: DataFrame, strict: bool = False, width: float = boxes.PAGE_WIDTH, height: float = boxes.PAGE_HEIGHT) -> DataFrame:
    """Distinct (rule, level, key) that a tree breaks; the key names the section, question, item or item and slot.

    sections (section_id, ord), questions (section_id, question_id, number, ord), items (question_id, item_id, ord, kind,
    expected, localized, anchor, anchor_page, decision), slots (item_id, slot_idx, anchor_before, anchor_after). Blank and
    null ids are missing; of a repeated id each row after the first breaks the rule.
    """
    blank = lambda c: F.coalesce(F.trim(F.col(c).cast("string")) == "", F.lit(True))
    nth = lambda key, *order: F.row_number().over(W.partitionBy(key).orderBy(*order))
    order = W.partitionBy("section_id").orderBy("ord")
    numbered = questions.withColumn("fall_", F.lag("number").over(order) > F.col("number"))
    per_section = numbered.groupBy("section_id").agg(F.count(F.lit(1)).alias("n_"), (F.count("number") > F.countDistinct("number")).alias("repeated_"), F.bool_or("fall_").alias("falls_"))
    s = sections.withColumn("nth_", nth("section_id", "ord")).join(per_section, "section_id", "left")
    has_items = items.groupBy("question_id").agg(F.count(F.lit(1)).alias("n_"))
    q = questions.withColumn("nth_", nth("question_id", "section_id", "ord")).join(has_items, "question_id", "left")
    in_slots = slots.groupBy("item_id").agg(F.count(F.lit(1)).alias("slots_"), F.countDistinct("slot_idx").alias("distinct_"), F.min("slot_idx").alias("low_"), F.max("slot_idx").alias("high_"))
    i = items.withColumn("nth_", nth("item_id", "question_id", "ord")).join(in_slots, "item_id", "left").withColumn("slots_", F.coalesce("slots_", F.lit(0)))
    at = lambda k: F.get("anchor", F.lit(k))
    shaped = (F.size("anchor") == 4) & (at(2) > at(0)) & (at(3) > at(1))
    counts = "error" if strict else "warning"
    item_rules = [
        ("MISSING_ITEM_ID", "error", blank("item_id")), ("DUPLICATE_ITEM_ID", "error", ~blank("item_id") & (F.col("nth_") > 1)), ("UNKNOWN_KIND", "warning", ~F.coalesce("kind", F.lit("other")).isin(*ITEM_KINDS)),
        ("COUNT_RANGE", "error", ~F.col("expected").between(1, 100)), ("SLOTS_NOT_CONTIGUOUS", "error", (F.col("slots_") > 0) & ((F.col("low_") != 1) | (F.col("high_") != F.col("slots_")) | (F.col("distinct_") != F.col("slots_")))),
        ("COUNT_MISMATCH", counts, (F.col("expected") != 0) & (F.col("expected") != F.col("slots_"))),
        ("INVALID_ANCHOR_BOX", "error", F.col("anchor").isNotNull() & ~F.coalesce(shaped, F.lit(False))), ("ANCHOR_OUTSIDE_CANVAS", "error", shaped & ((at(0) < 0) | (at(1) < 0) | (at(2) > width) | (at(3) > height))),
        ("ANCHOR_PAGE", "error", F.col("anchor").isNotNull() & (F.coalesce("anchor_page", F.lit(0)) < 1)),
    ]
    if strict:
        item_rules += [
            ("MISSING_LOCALIZED_COUNT", "error", F.col("localized").isNull() | (F.col("localized") < 0)), ("LOCALIZED_MISMATCH", "error", (F.col("localized") >= 0) & (F.col("expected") != 0) & (F.col("localized") != F.col("expected"))),
            ("EMPTY_BLUEPRINT", "error", F.col("slots_") == 0), ("COUNT_CONFLICT", "error", F.col("decision") == "CONFLICT"), ("MISSING_ANCHOR", "error", F.col("anchor").isNull()),
        ]
    out = [
        reports(s, F.col("section_id"), [("MISSING_SECTION_ID", "error", blank("section_id")), ("DUPLICATE_SECTION_ID", "error", ~blank("section_id") & (F.col("nth_") > 1)), ("SECTION_WITHOUT_QUESTIONS", "error", F.col("n_").isNull()), ("REPEATED_NUMBERS", "warning", F.col("repeated_")), ("NUMBERS_OUT_OF_ORDER", "warning", F.col("falls_"))]),
        reports(q, F.col("question_id"), [("MISSING_QUESTION_ID", "error", blank("question_id")), ("DUPLICATE_QUESTION_ID", "error", ~blank("question_id") & (F.col("nth_") > 1)), ("INVALID_NUMBER", "error", F.col("number").isNull() | (F.col("number") < 1)), ("QUESTION_WITHOUT_ITEMS", "error", F.col("n_").isNull())]),
        reports(i, F.col("item_id"), item_rules),
    ]
    if strict:
        out.append(reports(slots, F.concat_ws("/", "item_id", "slot_idx"), [("SLOT_WITHOUT_ANCHOR", "error", blank("anchor_before") & blank("anchor_after"))]))
    return reduce(DataFrame.unionByName, out).distinct()


def lock_readiness(report: DataFrame, items: DataFrame, slots: DataFrame, coverage: str | None) -> DataFrame:
    """One row (status, issues, ready_to_lock): VALID without errors; ready if also the structure is covered, every item has slots, accepted semantics and no conflict. items: (item_id, semantics, decision)."""
    errors = report.agg(F.count_if(F.col("level") == "error").alias("errors"))
    met = items.join(slots.groupBy("item_id").agg(F.count(F.lit(1)).alias("n_")), "item_id", "left")
    open_ = met.agg(
        F.count_if(F.col("semantics").isNotNull() & (F.col("semantics") != "ACCEPTED")).alias("SLOT_SEMANTICS_UNRESOLVED"), F.count_if(F.col("n_").isNull()).alias("SLOTS_UNRESOLVED"), F.count_if(F.col("decision") == "CONFLICT").alias("SLOT_COUNT_CONFLICT")
    )
    both = errors.withColumn("one_", F.lit(1)).join(open_.withColumn("one_", F.lit(1)), "one_")  # one row each
    names = ["SLOT_SEMANTICS_UNRESOLVED", "SLOTS_UNRESOLVED", "SLOT_COUNT_CONFLICT"]
    issues = F.array_compact(F.array(F.when(F.lit(coverage != "COMPLETE"), "STRUCTURE_INCOMPLETE"), *[F.when(F.col(n) > 0, n) for n in names]))
    return both.select(F.when(F.col("errors") == 0, "VALID").otherwise("INVALID").alias("status"), issues.alias("issues")).withColumn("ready_to_lock", (F.col("status") == "VALID") & (F.size("issues") == 0))


def topology_issues(questions: DataFrame, items: DataFrame, pages: DataFrame, other_pages: DataFrame) -> DataFrame:
    """(code, owner, page_index) of a proposed structure held against its pages.

    questions (question_id, text, pages array in order), items (question_id, item_id, label, kind, text, pages), pages
    (page_index), other_pages (page_index): those that are said to hold no question. Owners without a page and pages
    without an owner are null.
    """
    known = pages.select(F.col("page_index").alias("page_")).distinct().withColumn("known_", F.lit(True))

    def references(rows: DataFrame, key: str) -> DataFrame:
        r = rows.select(F.col(key).cast("string").alias("owner"), F.posexplode("pages").alias("at_", "page_")).join(known, "page_", "left")
        broken = r.groupBy("owner").agg((F.count("page_") != F.countDistinct("page_")).alias("twice"), F.bool_or(F.col("known_").isNull()).alias("unknown"), F.array_sort(F.collect_list(F.struct("at_", "page_"))).alias("p"))
        falls = F.exists(F.sequence(F.lit(1), F.size("p")), lambda k: F.coalesce(F.get(F.col("p"), k - 1)["page_"] > F.get(F.col("p"), k)["page_"], F.lit(False)))
        return broken.select(F.inline(F.array_compact(F.array(*[F.when(c, F.struct(F.lit(code).alias("code"), F.col("owner"), F.lit(None).cast("int").alias("page_index"))) for code, c in (("INVALID_PAGE_REFERENCES", F.col("twice") | F.col("unknown")), ("PAGE_ORDER_CONFLICT", falls))]))))

    empty = lambda c: F.trim(F.coalesce(c, F.lit(""))) == ""
    per = items.groupBy("question_id").agg(F.count(F.lit(1)).alias("n"), F.bool_and(F.col("kind") == "choice").alias("choices"), F.bool_or(F.col("label").rlike(r"^\s*[A-H][.、．)]?\s*$")).alias("lettered"), F.array_distinct(F.flatten(F.collect_list("pages"))).alias("item_pages"))
    q = questions.join(per, "question_id", "left")
    outside = items.join(questions.select("question_id", F.col("pages").alias("own_")), "question_id").filter(F.size(F.array_except("pages", "own_")) > 0)
    line = lambda df, code, owner, page=None: df.select(F.lit(code).alias("code"), owner.cast("string").alias("owner"), (F.lit(None) if page is None else page).cast("int").alias("page_index"))
    used = questions.select(F.explode("pages").alias("page_index")).unionByName(items.select(F.explode("pages").alias("page_index"))).distinct()
    bare = q.select("question_id", F.explode(F.array_except("pages", F.coalesce("item_pages", F.lit([]).cast("array<int>")))).alias("page_index"))
    out = [
        references(questions, "question_id"), references(items, "item_id"),
        line(questions.filter(empty(F.col("text"))), "EMPTY_QUESTION_TEXT", F.col("question_id")), line(items.filter(empty(F.col("text"))), "EMPTY_ITEM_TEXT", F.col("item_id")),
        line(q.filter("n > 1 and choices and lettered"), "OPTIONS_ARE_NOT_SUBQUESTIONS", F.col("question_id")), line(outside, "ITEM_OUTSIDE_QUESTION_PAGES", F.col("item_id")),
        line(bare, "QUESTION_PAGE_WITHOUT_ITEM", F.col("question_id"), F.col("page_index")), line(other_pages.join(used, "page_index", "left_semi"), "INVALID_NON_QUESTION_PAGE", F.lit(None), F.col("page_index")),
        line(pages.select("page_index").distinct().join(used, "page_index", "left_anti").join(other_pages.select("page_index"), "page_index", "left_anti"), "UNEXPLAINED_PAGE", F.lit(None), F.col("page_index")),
    ]
    return reduce(DataFrame.unionByName, out)


def label_coverage(declared: Column, observed: Column, least: int = 2) -> Column:
    """Labels that were observed on the page and not declared, in order, if at least that many were observed; else none."""
    seen = F.array_distinct(observed)
    return F.when(F.size(seen) >= least, F.array_sort(F.array_except(seen, declared))).otherwise(F.lit([]).cast("array<string>"))


def attached(rows: DataFrame, document: list[str], order: list[str], question: str, number: str, title: str) -> DataFrame:
    """rows with `owner`, the question they belong to, and `cross_page`.

    A row without number or title belongs to the question that was last begun before it, and is dropped if none was;
    one whose question was begun before continues it. A question is begun by its first row.
    """
    sound = F.coalesce((F.col(number) > 0) & (F.trim(F.coalesce(F.col(title), F.lit(""))) != ""), F.lit(False))
    w = W.partitionBy(*document).orderBy(*order)
    marked = rows.withColumn("sound_", sound)
    begins = F.col("sound_") & (F.row_number().over(W.partitionBy(*document, "sound_", question).orderBy(*order)) == 1)
    marked = marked.withColumn("begins_", begins)
    last = F.last(F.when(F.col("begins_"), F.col(question)), ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, W.currentRow))
    return marked.withColumn("owner", F.when(F.col("sound_"), F.col(question)).otherwise(last)).withColumn("cross_page", ~F.col("begins_")).filter("owner is not null").drop("sound_", "begins_")


def merged_items(rows: DataFrame, keys: list[str], order: list[str], regions: str, answer: str) -> DataFrame:
    """One row per item: its regions of all pages without repeats, and its answers joined by line ends; an answer equal to all that was gathered so far is not joined."""
    r = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*order, F.col(regions).alias("r_"), F.col(answer).alias("a_")))).alias("rows_"))
    join = lambda acc, x: F.when((F.coalesce(x["a_"], F.lit("")) == "") | (x["a_"] == acc), acc).otherwise(F.regexp_replace(F.concat(acc, F.lit("\n"), x["a_"]), r"(?U)^\s+|\s+$", ""))
    joined = F.aggregate("rows_", F.lit(""), join)
    return r.select(*keys, F.array_distinct(F.flatten(F.transform("rows_", lambda x: x["r_"]))).alias(regions), F.nullif(joined, F.lit("")).alias(answer), (F.size("rows_") > 1).alias("cross_page"))


def incomplete_end(last: Column, title: Column, n_items: Column) -> Column:
    """Whether a page ends within a question: by the last text's end, or fewer items than its title counts in brackets."""
    counted = F.array_max(F.transform(F.regexp_extract_all(F.coalesce(title, F.lit("")), F.lit(r"[(（]([0-9]+)[)）]"), F.lit(1)), lambda x: x.try_cast("int")))
    return F.coalesce(F.trim(last).rlike(OPEN_END), F.lit(False)) | (F.coalesce(counted, F.lit(0)) > n_items)


def stitched(pages: DataFrame, document: list[str], order: list[str], number: str, title: str, incomplete: str) -> DataFrame:
    """pages (first question's number and title, last question's number `last_<number>` and whether the page ends incomplete) with `continues`: the page goes on with the question of the one before."""
    w = W.partitionBy(*document).orderBy(*order)
    before, open_, t = F.lag(f"last_{number}").over(w), F.coalesce(F.lag(incomplete).over(w), F.lit(False)), F.trim(F.coalesce(F.col(title), F.lit("")))
    sub = F.nullif(F.regexp_extract(t, r"^[（(]([0-9]+)[）)]", 1), F.lit("")).try_cast("int")
    goes_on = F.when(F.coalesce(before, F.lit(0)) == 0, False).when(F.col(number) == before, True).when(sub.isNotNull() & ((sub > 1) | open_), True).when(open_ & t.rlike(GOES_ON), True).otherwise(open_ & ~t.rlike(NUMBERED))
    return pages.withColumn("continues", F.coalesce(goes_on, F.lit(False)))


def by_key(left: DataFrame, right: DataFrame, id_: str, key=text.ascii_key) -> DataFrame:
    """left with the columns of the rows of right whose normalised ids are equal, null without; right's id is `<id>_2`."""
    r = right.withColumnRenamed(id_, f"{id_}_2").withColumn("key_", key(F.col(f"{id_}_2").cast("string")))
    return left.withColumn("key_", key(F.col(id_).cast("string"))).join(r, "key_", "left").drop("key_")


def zipped(blueprint: DataFrame, found: DataFrame, item: str, place: str, order: list[str], value: str) -> DataFrame:
    """blueprint with the `value` of the found slot of the same place in order, where an item has as many found slots as it should; else null."""
    n = F.count(F.lit(1)).over(W.partitionBy(item))
    a = blueprint.withColumn("n_", n).withColumn("k_", F.row_number().over(W.partitionBy(item).orderBy(place)))
    b = found.select(item, F.row_number().over(W.partitionBy(item).orderBy(*order)).alias("k_"), n.alias("m_"), F.col(value))
    return a.join(b, [item, "k_"], "left").withColumn(value, F.when(F.col("n_") == F.col("m_"), F.col(value))).drop("k_", "n_", "m_")


def foreign_texts(items: DataFrame, page: list[str], item: str, value: str) -> DataFrame:
    """(page, item, foreign): for each item the distinct texts of the other items of its page, in order. A page's items are one group, bounded by paper."""
    on_page = items.groupBy(*page).agg(F.collect_set(F.struct(F.col(item).alias("i"), F.col(value).alias("v"))).alias("all_"))
    own = items.select(*page, item).distinct().join(on_page, page)
    return own.select(*page, item, F.array_sort(F.array_distinct(F.transform(F.filter("all_", lambda x: (x["i"] != F.col(item)) & x["v"].isNotNull()), lambda x: x["v"]))).alias("foreign"))


def anchor_scores(items: DataFrame, blocks: DataFrame, least: float = 0.38) -> DataFrame:
    """(page, item_id, block_ord, score) of items (page, item_id, number, text) and recognised blocks (page, block_ord, text) that are alike enough.

    0.65 of the similarity of their first 120 letters, or of one holding the other's beginning, and 0.35 for a block
    that begins with the item's number. Items and blocks of one page meet: both are bounded by paper. Only pairs whose
    letters, whatever their order, let them be alike enough are aligned.
    """
    q, b = F.col("query_"), F.col("block_")
    rows = items.select("page", "item_id", "number", text.letters(F.col("text")).alias("query_")).join(blocks.select("page", "block_ord", F.col("text").alias("raw_"), text.letters(F.col("text")).alias("block_")), "page").filter((q != "") & (b != ""))
    held = F.contains(b, F.left(q, F.lit(8))) | F.contains(q, F.left(b, F.lit(8)))
    number = F.nullif(F.regexp_extract("raw_", r"^\s*([0-9]{1,3})\s*[.、．:：)]", 1), F.lit("")).try_cast("int")
    bonus = F.when(F.coalesce(number == F.col("number"), F.lit(False)), 0.35).otherwise(0.0)
    aligned = text.alike_from(F.when(~held, F.left(q, F.lit(120))), F.left(b, F.lit(120)), (F.lit(least) - bonus) / 0.65 - 1e-5)
    scored = rows.withColumn("score", F.round(0.65 * F.when(held, 1.0).otherwise(aligned) + bonus, 6))
    return scored.filter(F.col("score") >= least).select("page", "item_id", "block_ord", "score")


def anchored(scores: DataFrame) -> DataFrame:
    """anchor_scores() of which each item and each block of a page has one, by falling score, larger items and blocks first of equals."""
    import numpy as np
    import pandas as pd

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        (r, _), (c, _) = pd.factorize(pdf["item_id"], sort=True), pd.factorize(pdf["block_ord"], sort=True)
        return pdf.iloc[greedy_places(pdf["score"].to_numpy(), np.asarray(r), np.asarray(c), larger_first=True)]

    return scores.groupBy("page").applyInPandas(run, scores.schema)


def question_order(questions: DataFrame, regions: DataFrame, document: list[str], question: str, number: str) -> DataFrame:
    """questions with `place` from 1: by the top of their highest region, those without any last, then by number; the page does not count."""
    top = regions.filter(F.size("box") >= 4).groupBy(*document, question).agg(F.min(F.get("box", F.lit(1))).alias("top_"))
    met = questions.join(top, [*document, question], "left").withColumn("top_", F.coalesce("top_", F.lit(float("inf"))))
    return met.withColumn("place", F.row_number().over(W.partitionBy(*document).orderBy("top_", number, question))).drop("top_")


def nested(items: DataFrame, document: list[str]) -> DataFrame:
    """One row per document with its sections, questions and items as nested arrays, and metadata: the total score, nought if none is known; the student's total, null if nought.

    items: (document, section_id, question_id, item_id, score, student_score, total_score, box) with box [y1, x1, y2, x2].
    """
    item = F.struct("item_id", "score", boxes.transposed(F.col("box")).alias("box"))
    q = items.groupBy(*document, "section_id", "question_id").agg(F.array_sort(F.collect_list(item)).alias("items"), F.sum("student_score").alias("s_"), F.max("total_score").alias("t_"))
    s = q.groupBy(*document, "section_id").agg(F.array_sort(F.collect_list(F.struct("question_id", "items"))).alias("questions"), F.sum("s_").alias("s_"), F.max("t_").alias("t_"))
    d = s.groupBy(*document).agg(F.array_sort(F.collect_list(F.struct("section_id", "questions"))).alias("sections"), F.sum("s_").alias("s_"), F.max("t_").alias("t_"))
    return d.select(*document, "sections", F.coalesce("t_", F.lit(0.0)).alias("total_score"), F.nullif(F.coalesce("s_", F.lit(0.0)), F.lit(0.0)).alias("student_total_score"))


def workspace(items: DataFrame, pages: int) -> DataFrame:
    """One row per slot of items (item_id, item_name, slots array<struct<slot_idx, page_index, status, expected, handwriting, text>>) for people to review.

    A slot's box is that of the writing, else the expected one, as [y1, x1, y2, x2]; an item without slots is one row
    to be reviewed, without a box.
    """
    rows = items.select("item_id", "item_name", F.explode_outer("slots").alias("s"))
    none = F.col("s").isNull()
    box = F.when(F.size(F.coalesce("s.handwriting", F.lit([]).cast("array<double>"))) > 0, F.col("s.handwriting")).otherwise(F.coalesce("s.expected", F.lit([]).cast("array<double>")))
    label = F.concat(F.coalesce("item_name", "item_id"), F.lit(" · 槽位 "), F.col("s.slot_idx"), F.lit(" ["), F.coalesce("s.status", F.lit("PENDING")), F.lit("]"))
    return rows.select(
        F.when(none, F.col("item_id")).otherwise(F.concat("item_id", F.lit("__slot_"), F.col("s.slot_idx"))).alias("item_id"), F.when(~none, F.col("item_id")).alias("parent_item_id"), F.when(none, F.col("item_name")).otherwise(label).alias("item_name"),
        F.when(none, "MISSING_SLOT_COORDINATES").otherwise(F.coalesce("s.status", F.lit("PENDING"))).alias("slot_status"), F.when(none, "HITL_REQUIRED").otherwise("PENDING").alias("review_status"),
        F.when(F.size(box) == 4, boxes.transposed(box)).alias("box"), F.col("s.page_index").between(1, pages).alias("page_known"), F.coalesce("s.text", F.lit("")).alias("recognized_text"),
    )


def evidence(pages: DataFrame, document: list[str], order: str, first: str, second: str) -> DataFrame:
    """(document, text, pages_total, dual_source_pages, fallback_pages): the pages' texts under headings, in order; how many have both sources and how many the second alone."""
    some = lambda c: F.trim(F.coalesce(F.col(c), F.lit(""))) != ""
    page = F.concat(F.lit("=== "), F.col(order), F.lit(" ===\n"), F.coalesce(F.nullif(F.col(first), F.lit("")), F.lit("[fallback]")))
    rows = pages.groupBy(*document).agg(
        F.array_sort(F.collect_list(F.struct(F.col(order), page.alias("t_")))).alias("p_"), F.count(F.lit(1)).alias("pages_total"), F.count_if(some(first) & some(second)).alias("dual_source_pages"), F.count_if(~some(first) & some(second)).alias("fallback_pages")
    )
    return rows.select(*document, F.array_join(F.transform("p_", lambda x: x["t_"]), "\n\n").alias("text"), "pages_total", "dual_source_pages", "fallback_pages")


def result_faults(result: Column, role: str) -> Column:
    """Faults of a JSON result in order: its type, no array of questions, questions without id, items without the role's answer (a key that is there, whatever its value)."""
    required = "standard_answer" if role == "teacher" else "answer"
    questions = F.from_json(F.get_json_object(result, "$.questions"), "array<string>")
    keys = lambda j: F.coalesce(F.json_object_keys(j), F.lit([]).cast("array<string>"))
    given = lambda q, k: F.coalesce(F.get_json_object(q, f"$.{k}") != "", F.lit(False))
    items = lambda q: F.coalesce(F.from_json(F.get_json_object(q, "$.items"), "array<string>"), F.array(q))

    def of(q: Column, i: Column) -> Column:
        lacking = F.transform(items(q), lambda it, k: F.when(~F.array_contains(keys(it), required) & ~F.array_contains(keys(q), required), F.concat(F.lit("questions["), i, F.lit("].items["), k, F.lit(f"].{required}"))))
        return F.concat(F.array(F.when(~given(q, "id") & ~given(q, "question_id"), F.concat(F.lit("questions["), i, F.lit("].id")))), lacking)

    head = F.array(F.when(~F.coalesce(F.get_json_object(result, "$.document_type") == role, F.lit(False)), "document_type"), F.when(questions.isNull(), "questions"))
    return F.array_compact(F.concat(head, F.coalesce(F.flatten(F.transform(questions, of)), F.lit([]).cast("array<string>"))))


def counters(rows: DataFrame, conditions: dict[str, Column], keys: list[str] = ()) -> DataFrame:
    """How many rows of each key meet each condition, and how many there are (`rows`)."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(c).alias(n) for n, c in conditions.items()])
