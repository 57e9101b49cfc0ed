"""A proposed structure held against the recognised text of its pages: anchors, domains, coverage and reading order.

An anchor meets only blocks of its page that can be alike: the bound is the number of letters both have, whatever their
order, which no alignment of the two exceeds. A pair below the bound counts as unlike without being aligned, one above
it is aligned exactly, so no decision depends on the bound.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leafline.functions import text
from leafline.functions.parsing import BRACKETED, LEADING, label_similarity
from leafline.functions.parsing import number_of as _int

#: The similarity an anchor needs, the lead over the second, what an equal number adds, a sub-number's certainty; the share of the width within which a column's numbers stand.
LEAST, LEAD, NUMBERED, SHORT, MARGIN = 0.45, 0.05, 0.12, 0.86, 0.12
NUMBER = r"^\s*(?:第\s*)?([0-9]{1,3})\s*[.、．:：)）]"


def numbered(blocks: DataFrame, width: float) -> DataFrame:
    """blocks (document, page_index, col, place, x, text) with `number`, that of a block which begins with one at the margin of its column, and `folded`."""
    left = F.min("x").over(W.partitionBy("document", "page_index", "col"))
    return blocks.withColumn("number", F.when(F.col("x") <= left + width * MARGIN, _int(F.col("text"), NUMBER))).withColumn("folded", text.folded(F.col("text")))


def _chosen(scored: DataFrame, keys: list[str]) -> DataFrame:
    """The best block of each key with the lead over the second."""
    w = W.partitionBy(*keys).orderBy(F.desc("score"), "col", "place")
    return scored.withColumn("k_", F.row_number().over(w)).withColumn("lead", F.col("score") - F.lead("score").over(w)).filter("k_ = 1").drop("k_")


def question_anchors(questions: DataFrame, blocks: DataFrame) -> DataFrame:
    """(document, question_id, number, ref_ord, page_index, col, place, end, anchored, by_number) of each reference of each question.

    questions: (document, question_id, number, refs array<struct<page_index, anchor>>); blocks as numbered() gives them.
    The first reference looks among the blocks of its number, if the page has any, all else among all blocks of the
    page. A block is taken if it is alike enough, or the only one of the number, and leads the second. `end` is the
    place of the next numbered block of the column: until there the question goes.
    """
    refs = questions.select("document", "question_id", "number", F.posexplode("refs").alias("ref_ord", "r")).select("*", "r.page_index", F.col("r.anchor").alias("anchor"), text.folded(F.col("r.anchor")).alias("a_")).drop("r")
    b = blocks.select("document", "page_index", "col", "place", F.col("text").alias("b_raw"), F.col("folded").alias("b_"), F.col("number").alias("b_number"))
    own = W.partitionBy("document", "question_id", "ref_ord")
    met = refs.join(b, ["document", "page_index"]).withColumn("mine_", F.coalesce(F.col("b_number") == F.col("number"), F.lit(False))).withColumn("n_mine", F.count_if("mine_").over(own))
    among = (F.col("ref_ord") == 0) & (F.col("n_mine") > 0)
    met = met.filter(~among | F.col("mine_"))
    # what decides lies at LEAST less the lead and the number's worth or above
    alike = label_similarity(F.col("a_"), F.col("b_"), F.col("anchor"), F.col("b_raw"), LEAST - LEAD - NUMBERED)
    bonus = F.when((_int(F.col("anchor"), LEADING) == F.col("number")) & (_int(F.col("b_raw"), LEADING) == F.col("number")), NUMBERED).otherwise(0.0)
    best = _chosen(met.withColumn("score", alike + bonus), ["document", "question_id", "ref_ord"])
    sure = ((F.col("score") >= LEAST) | ((F.col("n_mine") == 1) & (F.col("ref_ord") == 0))) & F.coalesce(F.col("lead") >= LEAD, F.lit(True))
    taken = best.filter(sure).select("document", "question_id", "ref_ord", "col", "place", F.col("mine_").alias("by_number"))
    heads = blocks.filter("number is not null").select("document", "page_index", "col", F.col("place").alias("next_"))
    at = refs.select("document", "question_id", "number", "ref_ord", "page_index").join(taken, ["document", "question_id", "ref_ord"], "left")
    later = at.join(heads, ["document", "page_index", "col"]).filter("next_ > place").groupBy("document", "question_id", "ref_ord").agg(F.min("next_").alias("end"))
    return at.join(later, ["document", "question_id", "ref_ord"], "left").withColumn("anchored", F.col("place").isNotNull())


def item_anchors(items: DataFrame, anchors: DataFrame, blocks: DataFrame) -> DataFrame:
    """(document, question_id, item_id, item_ord, page_index, domain, place, score, anchored) of each reference of each item within its question's domain.

    items: (document, question_id, item_id, item_ord, text, refs). An item that is alone in its question and alike its
    first block stands there. A short label with a number in brackets needs no lead.
    """
    alone = F.count(F.lit(1)).over(W.partitionBy("document", "question_id")) == 1
    refs = items.withColumn("alone", alone).select("document", "question_id", "item_id", "item_ord", "alone", "text", F.explode("refs").alias("r")).select("*", "r.page_index", F.col("r.anchor").alias("anchor"), text.folded(F.col("r.anchor")).alias("a_"), text.folded(F.col("text")).alias("t_")).drop("r")
    domain = anchors.filter("anchored").groupBy("document", "question_id", "page_index").agg(F.max_by(F.struct("col", "place", "end"), "ref_ord").alias("d"))
    met = refs.join(domain, ["document", "question_id", "page_index"], "left")
    b = blocks.select("document", "page_index", "col", F.col("place").alias("place"), F.col("text").alias("b_raw"), F.col("folded").alias("b_"))
    inside = met.filter("d is not null").select("*", "d.col", F.col("d.place").alias("from_"), F.col("d.end").alias("end_")).join(b, ["document", "page_index", "col"]).filter((F.col("place") >= F.col("from_")) & (F.col("end_").isNull() | (F.col("place") < F.col("end_"))))
    floor = LEAST - LEAD
    inside = inside.withColumn("score", label_similarity(F.col("a_"), F.col("b_"), F.col("anchor"), F.col("b_raw"), floor))
    key = ["document", "question_id", "item_id", "page_index"]
    first = inside.filter("alone and place = from_").withColumn("like_", label_similarity(F.col("t_"), F.col("b_"), F.col("text"), F.col("b_raw"), LEAST)).filter(F.col("like_") >= LEAST).select(*key, F.col("place").alias("first_"))
    best = _chosen(inside, key).join(first, key, "left")
    short = _int(F.col("anchor"), BRACKETED).isNotNull() & (F.col("score") >= SHORT)
    sure = F.col("first_").isNotNull() | short | ((F.col("score") >= LEAST) & F.coalesce(F.col("lead") >= LEAD, F.lit(True)))
    taken = best.filter(sure).select(*key, F.coalesce("first_", "place").alias("place"), F.when(F.col("first_").isNotNull(), F.greatest(F.lit(0.8), "score")).otherwise(F.col("score")).alias("score"))
    out = met.select(*key, "item_ord", F.col("d").isNotNull().alias("domain")).join(taken, key, "left")
    return out.withColumn("anchored", F.col("place").isNotNull())


def _labels(c: Column, pattern: str) -> Column:
    return F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(pattern), F.lit(1))


def text_issues(questions: DataFrame, items: DataFrame, blocks: DataFrame, pages: DataFrame, other_pages: DataFrame | None = None, width: float = 1654.0) -> DataFrame:
    """(document, code, owner, page_index) of a proposed structure held against recognised text.

    questions: (document, question_ord, question_id, number, text, refs array<struct<page_index, anchor>>); items:
    (document, question_id, item_ord, item_id, label, text, refs); blocks: (document, page_index, col, place, x, text) in
    reading order within columns; pages: (document, page_index, page_ord); other_pages: (document, page_index, source,
    reason), of which those of a supplementary template are noted. Codes of labels name what is missing in `owner`, after
    a colon. Page structure itself is trees.topology_issues()'s.
    """
    b = numbered(blocks, width)
    q = question_anchors(questions, b)
    i = item_anchors(items, q, b)
    none = F.lit(None)
    line = lambda df, code, owner, page: df.select("document", F.lit(code).alias("code"), owner.cast("string").alias("owner"), page.cast("int").alias("page_index"))
    qid, iid, page = F.col("question_id"), F.col("item_id"), F.col("page_index")
    covered = q.filter("by_number").select("document", "question_id", "page_index", "number", "col", "place")
    twice = covered.withColumn("k_", F.row_number().over(W.partitionBy("document", "page_index", "col", "place").orderBy("question_id"))).filter("k_ > 1")
    evidence = b.filter("number is not null").select("document", "page_index", "number", "col", "place")
    starts = q.filter("ref_ord = 0 and anchored").join(pages, ["document", "page_index"]).join(questions.select("document", "question_id", "question_ord"), ["document", "question_id"])
    before = F.lag(F.struct("page_ord", "col", "place")).over(W.partitionBy("document").orderBy("question_ord"))
    disordered = starts.withColumn("falls", before > F.struct("page_ord", "col", "place")).filter("falls").select("document").distinct()
    at = W.partitionBy("document", "question_id", "page_index")
    placed = i.filter("anchored")
    shared = placed.withColumn("k_", F.row_number().over(W.partitionBy("document", "question_id", "page_index", "place").orderBy("item_ord"))).filter("k_ > 1")
    falling = placed.withColumn("falls", F.lag("place").over(at.orderBy("item_ord")) > F.col("place")).filter("falls").select("document", "question_id", "page_index").distinct()
    domain = q.filter("anchored").select("document", "question_id", "page_index", "col", F.col("place").alias("from_"), "end")
    inside = domain.join(b.select("document", "page_index", "col", "place", F.col("text").alias("b_raw")), ["document", "page_index", "col"]).filter((F.col("place") >= F.col("from_")) & (F.col("end").isNull() | (F.col("place") < F.col("end"))))
    options = r"(?:^|\s)([A-H])[.、．)]"
    seen = inside.groupBy("document", "question_id").agg(
        F.array_distinct(F.flatten(F.collect_list(F.slice(_labels(F.col("b_raw"), r"^\s*[（(]([0-9]{1,2})[）)]"), 1, 1)))).alias("subs"), F.array_distinct(F.flatten(F.collect_list(_labels(F.col("b_raw"), options)))).alias("options")
    )
    declared = items.groupBy("document", "question_id").agg(
        F.array_distinct(F.flatten(F.collect_list(F.slice(_labels(F.col("label"), r"[（(]([0-9]{1,2})[）)]"), 1, 1)))).alias("labels"), F.array_distinct(F.flatten(F.collect_list(_labels(F.col("text"), options)))).alias("item_options")
    )
    met = seen.join(questions.select("document", "question_id", _labels(F.col("text"), options).alias("own")), ["document", "question_id"]).join(declared, ["document", "question_id"], "left")
    empty = F.array().cast("array<string>")
    lacking = lambda observed, known: F.when(F.size(observed) >= 2, F.array_sort(F.array_except(observed, known))).otherwise(empty)
    met = met.withColumn("no_subs", lacking(F.col("subs"), F.coalesce("labels", empty))).withColumn("no_options", lacking(F.col("options"), F.concat("own", F.coalesce("item_options", empty))))
    named = lambda c: F.concat(qid.cast("string"), F.lit(":"), F.array_join(c, ","))
    out = [
        line(q.filter("not anchored"), "QUESTION_ANCHOR_UNRESOLVED", qid, page), line(q.filter("anchored and ref_ord = 0 and not by_number"), "QUESTION_NUMBER_UNCONFIRMED", qid, page), line(twice, "DUPLICATE_QUESTION_ANCHOR", qid, page),
        line(i.filter("not anchored"), "ITEM_ANCHOR_UNRESOLVED", iid, page), line(shared, "SHARED_ITEM_OCR_ANCHOR", iid, page), line(falling, "ITEM_READING_ORDER_CONFLICT", qid, page),
        line(met.filter(F.size("no_subs") > 0), "SUBQUESTION_COVERAGE_CONFLICT", named(F.col("no_subs")), none), line(met.filter(F.size("no_options") > 0), "OPTION_COVERAGE_CONFLICT", named(F.col("no_options")), none),
        line(disordered, "READING_ORDER_CONFLICT", none, none),
        line(evidence.join(covered.drop("question_id"), ["document", "page_index", "number", "col", "place"], "left_anti"), "OCR_QUESTION_NOT_COVERED", F.col("number"), page),
        line(pages.select("document").distinct().join(evidence.select("document"), "document", "left_anti"), "NO_OCR_NUMBER_EVIDENCE", none, none),
    ]
    if other_pages is not None:
        out.append(line(other_pages.filter("source = 'supplementary_template'"), "SUPPLEMENTARY_TEMPLATE_EXCLUDED", F.col("reason"), page))
    both = out[0]
    for other in out[1:]:
        both = both.unionByName(other)
    return both
