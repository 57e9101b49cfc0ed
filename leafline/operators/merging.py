"""Topologies read page by page made into one, and a teacher's topology handed on to students."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leafline import store
from leafline.functions import text


def smallest_linked(members: DataFrame, folder: str, node: str = "node", key: str = "key", rounds: int = 64) -> DataFrame:
    """(node, label): nodes that share a key, directly or by others, have one label, the smallest node among them.

    Each round every key takes the smallest label of its nodes and every node the smallest of its keys', then the label
    of the node that its label names; rounds are written to the folder, and the one after which nothing has changed is
    the last. Both steps are aggregations, so a key that a third of all nodes share is combined before it is shuffled.
    """
    spark, kind = members.sparkSession, members.schema[node].dataType.simpleString()
    links = store.put(members.select(node, key).distinct(), folder, "links")
    labels = store.put(links.select(node, F.col(node).alias("label")).distinct(), folder, "round=0")
    for n in range(1, rounds + 1):
        of_key = links.join(labels, node).groupBy(key).agg(F.min("label").alias("l_"))
        of_node = links.join(of_key, key).groupBy(node).agg(F.min("l_").alias("l_"))
        jump = labels.select(F.col(node).alias("l_"), F.col("label").alias("far_"))
        after = of_node.join(jump, "l_", "left").select(node, F.least("l_", F.coalesce("far_", "l_")).alias("label"))
        after = store.put(after, folder, f"round={n}")
        changed = after.join(labels.withColumnRenamed("label", "old_"), node).filter("label <> old_")
        labels = after
        if changed.isEmpty():
            return spark.read.schema(f"`{node}` {kind}, label {kind}").parquet(f"{folder}/round={n}")
    raise RuntimeError(f"labels still change after {rounds} rounds")


def _merged_items(sources: Column) -> Column:
    """array<struct<label, pages>> of a question's sources (array<struct<label, pages>> each) in order.

    The first source's items stand. An item of a later one joins the first with an equal normalised label, else the one
    at its place, else it is appended.
    """
    first = F.transform(F.get(sources, F.lit(0)), lambda i: F.struct(i["label"].alias("label"), i["key"].alias("key"), i["pages"].alias("pages")))
    later = F.flatten(F.transform(F.slice(sources, 2, F.greatest(F.size(sources) - 1, F.lit(0))), lambda s: F.transform(s, lambda i, n: F.struct(i["label"].alias("label"), i["key"].alias("key"), i["pages"].alias("pages"), n.alias("place")))))

    def join(known: Column, item: Column) -> Column:
        by_label = F.array_position(F.transform(known, lambda k: k["key"]), item["key"]).cast("int") - 1
        at = F.when(by_label >= 0, by_label).when(item["place"] < F.size(known), item["place"]).otherwise(-1)
        grown = F.transform(known, lambda k, n: F.struct(k["label"].alias("label"), k["key"].alias("key"), F.when(n == at, F.array_distinct(F.concat(k["pages"], item["pages"]))).otherwise(k["pages"]).alias("pages")))
        return F.when(at >= 0, grown).otherwise(F.concat(known, F.array(F.struct(item["label"].alias("label"), item["key"].alias("key"), item["pages"].alias("pages")))))

    return F.transform(F.aggregate(later, first, join), lambda i: F.struct(i["label"].alias("label"), i["pages"].alias("pages")))


def merged_topologies(questions: DataFrame, folder: str) -> DataFrame:
    """(document, section, title, question, number, pages, items, sources): questions of all pages of a document made one.

    questions: (document, record, ord, title, number, pages array<int>, items array<struct<label, pages>>), a row for
    each question of each record, whose order is (record, ord). Rows of a document with one number are one question if
    they share a page or have sections of equal normalised title, directly or by others. A merged question lies in the
    section of its first row and has the pages of all rows in the order they came. Sections are numbered as first seen.
    A row without pages is linked by its section alone.
    """
    rows = questions.withColumn("key_", text.folded(F.col("title"))).withColumn("node", F.struct("document", "record", "ord"))
    items = F.transform("items", lambda i: F.struct(i["label"].alias("label"), i["pages"].alias("pages")))
    rows = rows.withColumn("items", items)
    by = F.concat(F.array(F.struct(F.lit("section").alias("kind"), F.col("key_").alias("of"))), F.transform("pages", lambda p: F.struct(F.lit("page").alias("kind"), p.cast("string").alias("of"))))
    members = rows.select("node", F.explode(by).alias("by")).select("node", F.struct("node.document", "by.*").alias("by"))
    members = members.join(rows.select("node", "number"), "node").select("node", F.struct("by", "number").alias("key"))
    labelled = rows.join(smallest_linked(members, folder), "node")
    sections = rows.groupBy("document", "key_").agg(F.min(F.struct("record", "ord")).alias("seen_"), F.min_by("title", F.struct("record", "ord")).alias("title_"))
    sections = sections.withColumn("section", F.row_number().over(W.partitionBy("document").orderBy("seen_"))).select("document", "key_", "section", "title_")
    # labels of items are normalised row by row before they are gathered
    one = labelled.select("*", F.posexplode_outer("items").alias("at_", "i_")).withColumn("ik_", text.folded(F.coalesce("i_.label", F.lit(""))))
    item = F.when(F.col("i_").isNotNull(), F.struct("at_", F.struct(F.col("i_.label").alias("label"), F.col("ik_").alias("key"), F.col("i_.pages").alias("pages")).alias("i")))
    source = one.groupBy("document", "label", "node", "number", "pages", "key_").agg(F.array_sort(F.collect_list(item)).alias("i_"))
    gathered = source.groupBy("document", "label").agg(F.array_sort(F.collect_list(F.struct("node", "number", "pages", "key_", "i_"))).alias("s_"))
    head = F.get("s_", F.lit(0))
    out = gathered.select(
        "document", "label", head["number"].alias("number"), head["key_"].alias("key_"), F.array_distinct(F.flatten(F.transform("s_", lambda s: s["pages"]))).alias("pages"),
        _merged_items(F.transform("s_", lambda s: F.transform(s["i_"], lambda i: i["i"]))).alias("items"), F.size("s_").alias("sources"),
    ).join(sections, ["document", "key_"])
    place = F.row_number().over(W.partitionBy("document", "section").orderBy("label"))
    return out.select("document", "section", F.col("title_").alias("title"), place.alias("question"), "number", "pages", "items", "sources")


def last_reasons(pages: DataFrame) -> DataFrame:
    """(document, source, page_index, reason) of pages (document, record, ord, source, page_index, reason) that hold no question: of several reasons the last."""
    return pages.groupBy("document", "source", "page_index").agg(F.max_by("reason", F.struct("record", "ord")).alias("reason"))


SLOT = "struct<slot_idx: int, anchor_before: string, anchor_after: string, student_answer: string, recognized_text: string, handwriting_bbox: array<double>, cardinality_confirmed: boolean, coordinate_role: string>"
PLAN = "struct<slot_id: string, index: int, label: string, anchor_before: string, anchor_after: string>"
REGIONS = "array<struct<page_index: int, box: array<double>>>"
PACKAGE_ITEM = (
    f"struct<item_id: string, standard_answer: string, student_answer: string, eval_feedback: string, eval_status: string, student_score: double, is_correct: boolean, expected_slot_count: int, slot_count_source: string, "
    f"quality: map<string, string>, answer_regions: {REGIONS}, student_regions: {REGIONS}, option_regions: {REGIONS}, blank_regions: {REGIONS}, writing_regions: {REGIONS}, stem_region: struct<page_index: int, box: array<double>>, "
    f"semantic_slot_plan: array<{PLAN}>, slots: array<{SLOT}>>"
)
SECTIONS = f"array<struct<section_id: string, title: string, questions: array<struct<question_id: string, number: int, items: array<{PACKAGE_ITEM}>>>>>"
#: What one paper's retries and anchors say does not hold for the next. Fixed values.
OWN_QUALITY = ("automatic_relocalization", "localization_retry_feedback", "student_anchor_conflict")


def _item_key(c: Column) -> Column:
    return text.ascii_key(c.cast("string"))


def _inherited(item: Column, found: Column) -> Column:
    """A teacher's item for a student: the tree stays, answers and places are cleared, and what the student's own reading found is set."""
    none = lambda kind: F.lit(None).cast(kind)
    no_regions = F.array().cast(REGIONS)
    known = F.coalesce(item["expected_slot_count"], F.lit(0)) > 0
    given = F.coalesce(found["expected_slot_count"], F.lit(0)) > 0
    slots = F.coalesce(item["slots"], F.array().cast(f"array<{SLOT}>"))
    count = F.when(known, item["expected_slot_count"]).when(given, found["expected_slot_count"]).when(F.size(slots) > 0, F.size(slots))
    source = F.when(known, item["slot_count_source"]).when(given, F.coalesce(found["slot_count_source"], F.lit("student_vlm"))).when(F.size(slots) > 0, "teacher_topology").otherwise(item["slot_count_source"])
    planned = F.when(known, item["expected_slot_count"]).when(given, found["expected_slot_count"]).otherwise(0)  # slots alone make no plan
    anchor = lambda i, side: F.coalesce(F.get(F.transform(F.filter(slots, lambda s: s["slot_idx"] == i), lambda s: s[side]), F.lit(0)), F.lit(""))
    plan = F.transform(F.when(planned > 0, F.sequence(F.lit(1), planned)).otherwise(F.array().cast("array<int>")), lambda i: F.struct(
        F.concat(item["item_id"], F.lit(":slot:"), i).alias("slot_id"), i.alias("index"), F.concat(F.lit("answer_point_"), i).alias("label"), anchor(i, "anchor_before").alias("anchor_before"), anchor(i, "anchor_after").alias("anchor_after"),
    ))
    cleared = F.transform(slots, lambda s: s.withField("student_answer", none("string")).withField("recognized_text", F.lit("")).withField("handwriting_bbox", none("array<double>")).withField("cardinality_confirmed", F.lit(True)).withField("coordinate_role", F.lit("matching_hint_only")))
    own = F.coalesce(found["student_regions"], no_regions)
    out = (
        item.withField("student_answer", found["student_answer"]).withField("eval_feedback", found["eval_feedback"]).withField("eval_status", F.lit("pending"))
        .withField("student_score", none("double")).withField("is_correct", none("boolean")).withField("expected_slot_count", count).withField("slot_count_source", source)
        .withField("quality", F.map_filter(F.coalesce(item["quality"], F.create_map().cast("map<string,string>")), lambda k, _: ~k.isin(*OWN_QUALITY)))
        .withField("semantic_slot_plan", F.when(F.size(F.coalesce(item["semantic_slot_plan"], F.array().cast(f"array<{PLAN}>"))) > 0, item["semantic_slot_plan"]).otherwise(plan)).withField("slots", cleared)
        .withField("student_regions", own).withField("answer_regions", own).withField("stem_region", none("struct<page_index: int, box: array<double>>"))
    )
    for c in ("option_regions", "blank_regions", "writing_regions"):
        out = out.withField(c, no_regions)
    return out


def inherited(teachers: DataFrame, students: DataFrame) -> DataFrame:
    """One package per student: the teacher's topology of the same subject with the student's own answers and regions.

    teachers: (subject, exam_id, golden_source, topology_locked, sections SECTIONS), one per subject; students: (exam_id, student_id,
    subject, page_files, sections SECTIONS). Items meet by normalised id; of several of a student's the last counts.
    `mapped` counts the items met; `conflicts` has, sorted, COUNT_CONFLICT:id for items whose slot count the teacher's
    overrides, UNKNOWN_ITEM:id for a student's items that the teacher lacks, DUPLICATE_ITEM:id for ids that come twice.
    A student whose subject has no teacher keeps no tree: sections are null and the error is MISSING_TEACHER_GOLDEN.
    A student's items meet the teacher's by a join, so without the tree the work grows with the items read. What a
    teacher's item is for those who lack it is made once; only met items are rewritten for a student.
    """
    listed = lambda tree: F.flatten(F.transform(tree, lambda s: F.flatten(F.transform(s["questions"], lambda q: q["items"]))))
    given = teachers.withColumn("tree_", F.col("sections").cast(SECTIONS))
    asked = given.select("subject", F.explode(F.transform(listed(F.col("tree_")), lambda i: F.struct(_item_key(i["item_id"]).alias("k"), i["item_id"].alias("item_id"), i["expected_slot_count"].alias("n")))).alias("i"))
    asked = asked.groupBy("subject", F.col("i.k").alias("k")).agg(F.collect_list(F.struct("i.item_id", "i.n")).alias("asked_"))
    unmet = F.lit(None).cast(PACKAGE_ITEM)
    kept = F.transform("tree_", lambda s: s.withField("questions", F.transform(s["questions"], lambda q: q.withField("items", F.transform(q["items"], lambda i: F.struct(_item_key(i["item_id"]).alias("k"), i.alias("i"), _inherited(i, unmet).alias("unmet")))))))
    t = given.select("subject", F.col("exam_id").alias("teacher_id"), F.col("golden_source").alias("source_"), "topology_locked", kept.alias("tree_"))
    # of a student's items in order of id and place the last of each id, and whether it has others
    known = ["exam_id", "student_id", "subject", "page_files"]
    rows = students.select(*known, F.monotonically_increasing_id().alias("row_"), F.coalesce(listed(F.col("sections").cast(SECTIONS)), F.array().cast(f"array<{PACKAGE_ITEM}>")).alias("items_"))
    rows = rows.withColumn("keys_", F.sort_array(F.transform("items_", lambda i, n: F.struct(_item_key(i["item_id"]).alias("k"), n.alias("n")))))
    at = lambda n: F.get("keys_", n)["k"]
    ended = F.filter(F.transform("keys_", lambda e, n: F.struct(e["k"].alias("k"), e["n"].alias("n"), e["k"].eqNullSafe(at(n - 1)).alias("twice"), e["k"].eqNullSafe(at(n + 1)).alias("more"))), lambda e: ~e["more"])
    own = F.transform(ended, lambda e: F.struct(e["k"].alias("k"), e["twice"].alias("twice"), F.get("items_", e["n"]).alias("v")))
    each = rows.select(*known, "row_", F.explode_outer(own).alias("o")).select(*known, "row_", "o.k", "o.twice", "o.v")
    named = lambda code, values: F.transform(values, lambda v: F.concat(F.lit(f"{code}:"), v))
    met = each.join(asked, ["subject", "k"], "left")
    clash = F.filter("asked_", lambda i: (i["n"] > 0) & (F.col("v.expected_slot_count") > 0) & (F.col("v.expected_slot_count") != i["n"]))
    faults = F.when(F.col("asked_").isNotNull(), named("COUNT_CONFLICT", F.transform(clash, lambda i: i["item_id"]))).when(F.col("k").isNotNull(), F.array(F.concat(F.lit("UNKNOWN_ITEM:"), "k")))
    again = F.when(F.col("twice"), F.concat(F.lit("DUPLICATE_ITEM:"), "k"))
    per = met.groupBy("row_").agg(
        *[F.first(c).alias(c) for c in known], F.sum(F.when(F.col("asked_").isNotNull(), F.size("asked_")).otherwise(0)).cast("int").alias("met_"),
        F.flatten(F.collect_list(faults)).alias("faults_"), F.collect_list(again).alias("twice_"), F.collect_list(F.when(F.col("asked_").isNotNull(), F.struct("k", "v"))).alias("found_"),
    )
    out = per.join(t, "subject", "left").withColumn("ids_", F.transform("found_", lambda e: e["k"]))
    of = lambda x: F.get("found_", F.array_position("ids_", x["k"]).cast("int") - 1)["v"]
    item = lambda x: F.when(F.array_contains("ids_", x["k"]), _inherited(x["i"], of(x))).otherwise(x["unmet"])
    tree = F.transform("tree_", lambda s: s.withField("questions", F.transform(s["questions"], lambda q: q.withField("items", F.transform(q["items"], item)))))
    no_teacher = F.col("teacher_id").isNull()
    return out.select(
        "exam_id", "student_id", "subject", F.lit("student").alias("document_type"), "page_files", F.size("page_files").alias("total_pages"),
        F.when(~no_teacher, F.coalesce("source_", F.concat(F.lit("teacher:"), "teacher_id"))).alias("golden_source"), "topology_locked", tree.alias("sections"),
        F.when(no_teacher, 0).otherwise(F.col("met_")).alias("mapped"), F.when(no_teacher, F.array().cast("array<string>")).otherwise(F.array_sort(F.concat("faults_", "twice_"))).alias("conflicts"), F.when(no_teacher, "MISSING_TEACHER_GOLDEN").alias("error"),
    )
