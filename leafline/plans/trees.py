"""Queries of tree rules, page merging, joins with pages, and exports, with their SQL twins."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leafline.functions import boxes, text
from leafline.operators import aggregates, candidates, evaluation, extraction, joins, ordering, structure, trees, windows
from leafline.plans.registry import long, pick, pick_sql, query
from leafline.plans.texts import _BOX, vector_boxes
from leafline.sources import files

KINDS = ["choice", "essay", "poster", None]

_TREE = f"""
    WITH sec AS (SELECT CASE WHEN c_custkey % 50 = 7 THEN NULL WHEN c_custkey % 40 = 3 THEN c_custkey - 1 ELSE c_custkey END AS section_id, c_custkey AS ord FROM customer),
    que AS (SELECT o_custkey AS section_id, CASE WHEN o_orderkey % 97 = 5 THEN NULL WHEN o_orderkey % 31 = 4 THEN o_orderkey - 1 ELSE o_orderkey END AS question_id, CASE WHEN o_orderkey % 23 <> 0 THEN (o_orderkey % 9)::INT END AS number, o_orderkey AS ord FROM orders),
    itm AS (SELECT l_orderkey AS question_id, (l_orderkey * 10 + l_linenumber)::VARCHAR AS item_id, min(l_partkey) AS ord, min(l_partkey) AS p, max(l_quantity)::INT % 9 AS expected, min(l_suppkey)::INT - 1 AS localized FROM lineitem GROUP BY 1, 2),
    it2 AS (SELECT *, {pick_sql('p', KINDS)} AS kind, p % 5 AS a, (p % 3)::INT AS anchor_page, CASE WHEN p % 7 = 0 THEN 'CONFLICT' END AS decision FROM itm),
    slt AS (SELECT (l_orderkey * 10 + l_linenumber)::VARCHAR AS item_id, l_linenumber - 1 + (l_partkey % 2)::INT AS slot_idx, CASE WHEN l_partkey % 11 <> 0 THEN 'x' ELSE ' ' END AS anchor_before FROM lineitem)
"""


def _tree(t):
    c, o, p = F.col("c_custkey"), F.col("o_orderkey"), F.col("ord")
    sections = t("customer").select(F.when(c % 50 == 7, None).when(c % 40 == 3, c - 1).otherwise(c).alias("section_id"), c.alias("ord"))
    questions = t("orders").select(F.col("o_custkey").alias("section_id"), F.when(o % 97 == 5, None).when(o % 31 == 4, o - 1).otherwise(o).alias("question_id"), F.when(o % 23 != 0, (o % 9).cast("int")).alias("number"), o.alias("ord"))
    item_id = (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string")
    fixed = lambda *x: F.array(*[F.lit(float(v)) for v in x])
    anchor = F.when(p % 5 == 0, None).when(p % 5 == 1, fixed(1, 2, 1, 5)).when(p % 5 == 2, fixed(0, 0, 2000, 10)).otherwise(fixed(0, 0, 10, 10))
    items = t("lineitem").groupBy(F.col("l_orderkey").alias("question_id"), item_id.alias("item_id")).agg(F.min("l_partkey").alias("ord"), (F.max("l_quantity").cast("int") % 9).alias("expected"), (F.min("l_suppkey").cast("int") - 1).alias("localized"))
    items = items.withColumn("kind", pick(p, KINDS)).withColumn("anchor", anchor).withColumn("anchor_page", (p % 3).cast("int")).withColumn("decision", F.when(p % 7 == 0, "CONFLICT"))
    slots = t("lineitem").select(item_id.alias("item_id"), (F.col("l_linenumber") - 1 + (F.col("l_partkey") % 2).cast("int")).alias("slot_idx"), F.when(F.col("l_partkey") % 11 != 0, "x").otherwise(" ").alias("anchor_before"), F.lit(None).cast("string").alias("anchor_after"))
    return sections, questions, items, slots


_REPORT = """
    , ps AS (SELECT section_id, count(number) > count(DISTINCT number) AS repeated, bool_or(coalesce(p > number, false)) AS falls FROM (SELECT *, lag(number) OVER (PARTITION BY section_id ORDER BY ord) AS p FROM que) GROUP BY 1),
    sn AS (SELECT *, row_number() OVER (PARTITION BY section_id ORDER BY ord) AS k FROM sec), qn AS (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY section_id, ord) AS k FROM que),
    ns AS (SELECT item_id, count(*) AS n, count(DISTINCT slot_idx) AS d, min(slot_idx) AS lo, max(slot_idx) AS hi FROM slt GROUP BY 1), x AS (SELECT it2.*, n, d, lo, hi FROM it2 JOIN ns USING (item_id)),
    r AS (
        SELECT 'MISSING_SECTION_ID' AS rule, 'error' AS level, section_id::VARCHAR AS key FROM sn WHERE section_id IS NULL
        UNION ALL SELECT 'DUPLICATE_SECTION_ID', 'error', section_id::VARCHAR FROM sn WHERE section_id IS NOT NULL AND k > 1
        UNION ALL SELECT 'SECTION_WITHOUT_QUESTIONS', 'error', section_id::VARCHAR FROM sn WHERE section_id IS NULL OR section_id NOT IN (SELECT section_id FROM ps)
        UNION ALL SELECT 'REPEATED_NUMBERS', 'warning', section_id::VARCHAR FROM sn JOIN ps USING (section_id) WHERE repeated UNION ALL SELECT 'NUMBERS_OUT_OF_ORDER', 'warning', section_id::VARCHAR FROM sn JOIN ps USING (section_id) WHERE falls
        UNION ALL SELECT 'MISSING_QUESTION_ID', 'error', NULL FROM qn WHERE question_id IS NULL UNION ALL SELECT 'DUPLICATE_QUESTION_ID', 'error', question_id::VARCHAR FROM qn WHERE question_id IS NOT NULL AND k > 1
        UNION ALL SELECT 'INVALID_NUMBER', 'error', question_id::VARCHAR FROM qn WHERE number IS NULL OR number < 1
        UNION ALL SELECT 'QUESTION_WITHOUT_ITEMS', 'error', question_id::VARCHAR FROM qn WHERE question_id IS NULL OR question_id NOT IN (SELECT question_id FROM itm)
        UNION ALL SELECT 'UNKNOWN_KIND', 'warning', item_id FROM x WHERE kind = 'poster' UNION ALL SELECT 'COUNT_RANGE', 'error', item_id FROM x WHERE expected < 1
        UNION ALL SELECT 'SLOTS_NOT_CONTIGUOUS', 'error', item_id FROM x WHERE lo <> 1 OR hi <> n OR d <> n UNION ALL SELECT 'COUNT_MISMATCH', '{counts}', item_id FROM x WHERE expected <> 0 AND expected <> n
        UNION ALL SELECT 'INVALID_ANCHOR_BOX', 'error', item_id FROM x WHERE a = 1 UNION ALL SELECT 'ANCHOR_OUTSIDE_CANVAS', 'error', item_id FROM x WHERE a = 2 UNION ALL SELECT 'ANCHOR_PAGE', 'error', item_id FROM x WHERE a <> 0 AND anchor_page < 1 {strict})
    SELECT DISTINCT rule, level, key FROM r
"""
_STRICT = """
        UNION ALL SELECT 'MISSING_LOCALIZED_COUNT', 'error', item_id FROM x WHERE localized < 0 UNION ALL SELECT 'LOCALIZED_MISMATCH', 'error', item_id FROM x WHERE localized >= 0 AND expected <> 0 AND localized <> expected
        UNION ALL SELECT 'COUNT_CONFLICT', 'error', item_id FROM x WHERE decision = 'CONFLICT' UNION ALL SELECT 'MISSING_ANCHOR', 'error', item_id FROM x WHERE a = 0
        UNION ALL SELECT 'SLOT_WITHOUT_ANCHOR', 'error', item_id || '/' || slot_idx FROM slt WHERE anchor_before = ' '
"""


@query(_TREE + _REPORT.format(counts="warning", strict=""))
def q80_tree_report(t):
    return trees.tree_report(*_tree(t))


@query(_TREE + _REPORT.format(counts="error", strict=_STRICT))
def q80b_strict_tree_report(t):
    return trees.tree_report(*_tree(t), strict=True)


@query(_TREE + "SELECT 'INVALID' AS status, 'STRUCTURE_INCOMPLETE,SLOT_SEMANTICS_UNRESOLVED,SLOT_COUNT_CONFLICT' AS issues, false AS ready_to_lock FROM (SELECT count(*) AS n FROM it2 WHERE decision = 'CONFLICT') WHERE n > 0")
def q81_lock_readiness(t):
    sections, questions, items, slots = _tree(t)
    out = trees.lock_readiness(trees.tree_report(sections, questions, items, slots), items.withColumn("semantics", F.when(F.col("ord") % 2 == 0, "ACCEPTED").otherwise("OPEN")), slots, "PARTIAL")
    return out.withColumn("issues", F.array_join("issues", ","))


@query("""
    WITH q AS (SELECT o_orderkey AS question_id, CASE WHEN o_orderkey % 13 = 0 THEN ' ' ELSE 'text' END AS text, CASE o_orderkey % 7 WHEN 0 THEN [o_custkey, o_custkey] WHEN 1 THEN [o_custkey + 1, o_custkey] WHEN 2 THEN [o_custkey, 100000000] ELSE [o_custkey] END AS pages FROM orders),
    i AS (SELECT l_orderkey AS question_id, l_orderkey * 10 + l_linenumber AS item_id, min(l_partkey) AS p, count(*) AS n FROM lineitem GROUP BY 1, 2),
    j AS (SELECT i.*, o_custkey + CASE WHEN p % 10 = 0 THEN 1 ELSE 0 END AS page, pages FROM i JOIN orders ON o_orderkey = question_id JOIN q USING (question_id)),
    per AS (SELECT question_id, count(*) AS n, bool_and(p % 2 = 0) AS choices, list(DISTINCT page) AS item_pages FROM j GROUP BY 1), pages AS (SELECT DISTINCT c_custkey AS page_index FROM customer),
    used AS (SELECT DISTINCT page_index FROM (SELECT unnest(pages) AS page_index FROM q UNION ALL SELECT page FROM j)), oth AS (SELECT c_custkey AS page_index FROM customer WHERE c_custkey % 10 = 0)
    SELECT 'INVALID_PAGE_REFERENCES' AS code, question_id::VARCHAR AS owner, NULL::INT AS page_index FROM q WHERE question_id % 7 IN (0, 2) OR list_max(pages) NOT IN (SELECT page_index FROM pages) OR list_min(pages) NOT IN (SELECT page_index FROM pages)
    UNION ALL SELECT 'INVALID_PAGE_REFERENCES', item_id::VARCHAR, NULL FROM j WHERE page NOT IN (SELECT page_index FROM pages) UNION ALL SELECT 'PAGE_ORDER_CONFLICT', question_id::VARCHAR, NULL FROM q WHERE question_id % 7 = 1
    UNION ALL SELECT 'EMPTY_QUESTION_TEXT', question_id::VARCHAR, NULL FROM q WHERE text = ' ' UNION ALL SELECT 'EMPTY_ITEM_TEXT', item_id::VARCHAR, NULL FROM j WHERE p % 17 = 0
    UNION ALL SELECT 'OPTIONS_ARE_NOT_SUBQUESTIONS', question_id::VARCHAR, NULL FROM per WHERE n > 1 AND choices UNION ALL SELECT 'ITEM_OUTSIDE_QUESTION_PAGES', item_id::VARCHAR, NULL FROM j WHERE NOT list_contains(pages, page)
    UNION ALL SELECT 'QUESTION_PAGE_WITHOUT_ITEM', question_id::VARCHAR, unnest(list_filter(list_distinct(pages), lambda x: NOT list_contains(coalesce(item_pages, []), x)))::INT FROM q LEFT JOIN per USING (question_id)
    UNION ALL SELECT 'INVALID_NON_QUESTION_PAGE', NULL, page_index::INT FROM oth JOIN used USING (page_index) UNION ALL SELECT 'UNEXPLAINED_PAGE', NULL, page_index::INT FROM pages WHERE page_index NOT IN (SELECT page_index FROM used) AND page_index NOT IN (SELECT page_index FROM oth)
""")
def q82_topology_issues(t):
    o, c = F.col("o_orderkey"), F.col("o_custkey").cast("int")
    listed = F.when(o % 7 == 0, F.array(c, c)).when(o % 7 == 1, F.array(c + 1, c)).when(o % 7 == 2, F.array(c, F.lit(100000000))).otherwise(F.array(c))
    questions = t("orders").select(o.alias("question_id"), F.when(o % 13 == 0, " ").otherwise("text").alias("text"), listed.alias("pages"), c.alias("page_"))
    items = t("lineitem").groupBy(F.col("l_orderkey").alias("question_id"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("item_id")).agg(F.min("l_partkey").alias("p"))
    items = items.join(questions.select("question_id", "page_"), "question_id").select("question_id", "item_id", F.when(F.col("p") % 2 == 0, "choice").otherwise("fill").alias("kind"), F.lit("A.").alias("label"), F.when(F.col("p") % 17 == 0, "").otherwise("x").alias("text"), F.array(F.col("page_") + F.when(F.col("p") % 10 == 0, 1).otherwise(0)).alias("pages"))
    pages = t("customer").select(F.col("c_custkey").cast("int").alias("page_index"))
    return trees.topology_issues(questions.drop("page_"), items, pages, pages.filter("page_index % 10 = 0"))


@query("""
    SELECT user_id, array_to_string(CASE WHEN count(DISTINCT event_type) >= 2 THEN list_sort(list_filter(list_distinct(list(event_type)), lambda x: x NOT IN ('view', 'click'))) ELSE [] END, ',') AS missing FROM events GROUP BY 1
""")
def q83_label_coverage(t):
    rows = t("events").groupBy("user_id").agg(F.collect_list("event_type").alias("seen"))
    return rows.select("user_id", F.array_join(trees.label_coverage(F.array(F.lit("view"), F.lit("click")), F.col("seen")), ",").alias("missing"))


@query("""
    WITH r AS (SELECT conv_id, turn, length(text) AS ord2, length(text) % 4 AS q, CASE WHEN length(text) % 5 = 0 THEN 0 ELSE 1 END AS number FROM conversations), s AS (SELECT *, number > 0 AS sound FROM r),
    b AS (SELECT *, sound AND row_number() OVER (PARTITION BY conv_id, sound, q ORDER BY turn, ord2) = 1 AS begins FROM s),
    o AS (SELECT *, CASE WHEN sound THEN q ELSE last_value(CASE WHEN begins THEN q END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn, ord2 ROWS UNBOUNDED PRECEDING) END AS owner FROM b)
    SELECT conv_id, turn, owner::INT AS owner, NOT begins AS cross_page FROM o WHERE owner IS NOT NULL
""")
def q84_attached_rows(t):
    n = F.char_length("text")
    rows = t("conversations").select("conv_id", "turn", n.alias("ord2"), (n % 4).alias("q"), F.when(n % 5 == 0, 0).otherwise(1).alias("number"), F.lit("title").alias("title"))
    return trees.attached(rows, ["conv_id"], ["turn", "ord2"], "q", "number", "title").select("conv_id", "turn", F.col("owner").cast("int").alias("owner"), "cross_page")


@query("""
    WITH r AS (SELECT conv_id, role, turn, length(text) % 3 AS k, CASE WHEN length(text) % 4 <> 0 THEN 'a' || turn END AS a FROM conversations)
    SELECT conv_id, role, array_to_string(list_sort(list_distinct(list(k))), ',') AS regions, nullif(coalesce(string_agg(a, chr(10) ORDER BY turn), ''), '') AS answer, count(*) > 1 AS cross_page FROM r GROUP BY 1, 2
""")
def q85_merged_items(t):
    n = F.char_length("text")
    rows = t("conversations").select("conv_id", "role", "turn", n.alias("n"), F.array(n % 3).alias("regions"), F.when(n % 4 != 0, F.concat(F.lit("a"), "turn")).alias("answer"))
    out = trees.merged_items(rows, ["conv_id", "role"], ["turn", "n"], "regions", "answer")
    return out.withColumn("regions", F.array_join(F.array_sort("regions"), ","))


ENDS, TITLES = ["done.", "由于", "a =", "list，", None, "ok"], ["（2）next", "解得 x", "12. new", "plain", "（1）first", None]


@query(f"""
    WITH p AS (SELECT c_nationkey, c_custkey, (c_custkey % 4)::INT AS number, ((c_custkey + 1) % 4)::INT AS last_number, {pick_sql('c_custkey', ENDS)} AS last, {pick_sql('c_custkey // 2', TITLES)} AS title, (c_custkey % 3)::INT AS n FROM customer),
    i AS (SELECT *, coalesce(regexp_matches(trim(last), '([，,:：；;、—=+×÷<≥≤/\\-]|且|而|又|并且|由于|若|因为|所以|如图|可知|即|则|求|试求|解得|证明|满足)$'), false) OR coalesce(list_max(list_transform(regexp_extract_all(title, '[(（]([0-9]+)[)）]', 1), lambda x: x::INT)), 0) > n AS open FROM p),
    w AS (SELECT *, lag(last_number) OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS before, coalesce(lag(open) OVER (PARTITION BY c_nationkey ORDER BY c_custkey), false) AS was_open, trim(coalesce(title, '')) AS t FROM i)
    SELECT c_custkey, open, CASE WHEN coalesce(before, 0) = 0 THEN false WHEN number = before THEN true WHEN regexp_matches(t, '^[（(][0-9]+[）)]') AND (regexp_extract(t, '([0-9]+)', 1)::INT > 1 OR was_open) THEN true WHEN was_open AND starts_with(t, '解得') THEN true
           ELSE was_open AND NOT regexp_matches(t, '(^|[^0-9])[0-9]{{1,3}}[.、．:：)]') END AS continues FROM w
""")
def q86_stitched_pages(t):
    c = F.col("c_custkey")
    rows = t("customer").select("c_nationkey", "c_custkey", (c % 4).cast("int").alias("number"), ((c + 1) % 4).cast("int").alias("last_number"), pick(F.floor(c / 2), TITLES).alias("title"), pick(c, ENDS).alias("last"), (c % 3).cast("int").alias("n"))
    rows = rows.withColumn("open", trees.incomplete_end(F.col("last"), F.col("title"), F.col("n")))
    return trees.stitched(rows, ["c_nationkey"], ["c_custkey"], "number", "title", "open").select("c_custkey", "open", "continues")


@query("SELECT c_custkey::VARCHAR || '(a)' AS id, CASE WHEN s_suppkey IS NOT NULL THEN 'q-' || s_suppkey || ' A' END AS id_2, s_name FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey")
def q87_join_by_key(t):
    left = t("customer").select(F.concat(F.col("c_custkey").cast("string"), F.lit("(a)")).alias("id"))
    return trees.by_key(left, t("supplier").select(F.concat(F.lit("q-"), "s_suppkey", F.lit(" A")).alias("id"), "s_name"), "id").select("id", "id_2", "s_name")


@query("""
    WITH a AS (SELECT o_custkey AS item, o_orderkey AS slot, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS k, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders),
    b AS (SELECT o_custkey AS item, o_totalprice AS v, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS k, count(*) OVER (PARTITION BY o_custkey) AS m FROM orders WHERE o_orderkey % 20 <> 0)
    SELECT a.item, slot, CASE WHEN n = m THEN v END AS v FROM a LEFT JOIN b ON a.item = b.item AND a.k = b.k
""")
def q88_zipped_slots(t):
    o = t("orders").select(F.col("o_custkey").alias("item"), F.col("o_orderkey").alias("slot"), F.col("o_totalprice").alias("v"), F.col("o_orderdate").alias("at"))
    return trees.zipped(o.select("item", "slot"), o.filter("slot % 20 <> 0"), "item", "slot", ["at", "slot"], "v")


@query("""
    WITH l AS (SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag || l_linestatus AS v FROM lineitem)
    SELECT a.l_orderkey, a.l_linenumber, array_to_string(list_sort(list_distinct(coalesce(list(b.v) FILTER (WHERE b.v IS NOT NULL), []))), ',') AS foreign_texts FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM l) a LEFT JOIN l b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber <> b.l_linenumber GROUP BY 1, 2
""")
def q89_foreign_texts(t):
    rows = t("lineitem").select("l_orderkey", "l_linenumber", F.concat("l_returnflag", "l_linestatus").alias("v"))
    return trees.foreign_texts(rows, ["l_orderkey"], "l_linenumber", "v").select("l_orderkey", "l_linenumber", F.array_join("foreign", ",").alias("foreign_texts"))


@query()
def q90_anchored_items(t):
    """Each conversation a page: its user turns the items, all its turns the blocks."""
    c = t("conversations").select(F.col("conv_id").alias("page"), "turn", "role", "text")
    items = c.filter("role = 'user'").select("page", F.col("turn").alias("item_id"), F.lit(3).alias("number"), F.substring("text", 4, 200).alias("text"))
    return trees.anchored(trees.anchor_scores(items, c.select("page", F.col("turn").alias("block_ord"), "text")))


@query("""
    WITH r AS (SELECT o_custkey, o_orderkey, o_orderkey % 5 AS number, CASE WHEN o_orderkey % 4 <> 0 THEN o_totalprice END AS top FROM orders)
    SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY coalesce(top, 'inf'::DOUBLE), number, o_orderkey)::INT AS place FROM r
""")
def q91_question_order(t):
    q = t("orders").select("o_custkey", "o_orderkey", (F.col("o_orderkey") % 5).alias("number"))
    p = F.col("o_totalprice")
    regions = t("orders").filter("o_orderkey % 4 <> 0").select("o_custkey", "o_orderkey", F.explode(F.array(F.array(F.lit(0.0), p, p, p), F.array(F.lit(0.0), p + 9, p, p))).alias("box"))
    return trees.question_order(q, regions, ["o_custkey"], "o_orderkey", "number").select("o_custkey", "o_orderkey", "place")


@query("""
    WITH i AS (SELECT o_custkey, o_orderkey, l_linenumber, l_quantity, CASE WHEN o_custkey % 3 = 0 THEN 0.0 WHEN l_quantity > 20 THEN l_quantity END AS got, CASE WHEN o_custkey % 2 = 0 THEN o_totalprice END AS total FROM orders JOIN lineitem ON l_orderkey = o_orderkey)
    SELECT o_custkey, count(DISTINCT o_orderkey)::INT AS n_questions, count(*)::INT AS n_items, coalesce(max(total), 0.0) AS total_score, nullif(coalesce(sum(got), 0.0), 0.0) AS student_total_score, min(l_quantity) AS first_x FROM i GROUP BY 1
""")
def q92_nested_packages(t):
    met = t("orders").join(t("lineitem"), F.col("l_orderkey") == F.col("o_orderkey"))
    q = F.col("l_quantity")
    rows = met.select("o_custkey", F.lit("s").alias("section_id"), F.col("o_orderkey").alias("question_id"), F.col("l_linenumber").alias("item_id"), q.alias("score"), F.when(F.col("o_custkey") % 3 == 0, 0.0).when(q > 20, q).alias("student_score"), F.when(F.col("o_custkey") % 2 == 0, F.col("o_totalprice")).alias("total_score"), F.array(F.lit(0.0), q, q, q).alias("box"))
    out = trees.nested(rows, ["o_custkey"])
    questions = F.get("sections", F.lit(0))["questions"]
    boxed = F.flatten(F.transform(questions, lambda x: F.transform(x["items"], lambda i: F.get(i["box"], F.lit(0)))))
    return out.select("o_custkey", F.size(questions).alias("n_questions"), F.size(boxed).alias("n_items"), "total_score", "student_total_score", F.array_min(boxed).alias("first_x"))


@query("""
    WITH s AS (SELECT o_orderkey, l_linenumber, l_quantity, l_returnflag FROM orders LEFT JOIN (SELECT l_orderkey, l_linenumber, min(l_quantity) AS l_quantity, min(l_returnflag) AS l_returnflag FROM lineitem WHERE l_quantity > 25 GROUP BY 1, 2) ON l_orderkey = o_orderkey)
    SELECT CASE WHEN l_linenumber IS NULL THEN o_orderkey::VARCHAR ELSE o_orderkey || '__slot_' || l_linenumber END AS item_id, CASE WHEN l_linenumber IS NULL THEN 'MISSING_SLOT_COORDINATES' ELSE l_returnflag END AS slot_status, CASE WHEN l_linenumber IS NULL THEN 'HITL_REQUIRED' ELSE 'PENDING' END AS review_status,
           CASE WHEN l_linenumber IS NULL THEN 'name' ELSE 'name · 槽位 ' || l_linenumber || ' [' || l_returnflag || ']' END AS item_name, CASE WHEN l_linenumber IS NOT NULL THEN CASE WHEN l_returnflag = 'R' THEN 7.0 ELSE l_quantity END END AS y1, l_linenumber BETWEEN 1 AND 4 AS page_known FROM s
""")
def q93_workspace(t):
    q = F.col("q")
    line = t("lineitem").filter("l_quantity > 25").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_quantity").alias("q"), F.min("l_returnflag").alias("f"))
    writing = F.when(F.col("f") == "R", F.array(F.lit(1.0), F.lit(7.0), F.lit(2.0), F.lit(9.0)))
    slot = F.struct(F.col("l_linenumber").alias("slot_idx"), F.col("l_linenumber").alias("page_index"), F.col("f").alias("status"), F.array(F.lit(0.0), q, q, q + 1).alias("expected"), writing.alias("handwriting"), F.lit(None).cast("string").alias("text"))
    items = t("orders").select("o_orderkey").join(line.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.collect_list(slot).alias("slots")), "o_orderkey", "left")
    out = trees.workspace(items.select(F.col("o_orderkey").cast("string").alias("item_id"), F.lit("name").alias("item_name"), "slots"), 4)
    return out.select("item_id", "slot_status", "review_status", "item_name", F.get("box", F.lit(0)).alias("y1"), "page_known")


@query("""
    WITH p AS (SELECT conv_id, turn, length(text) AS n, CASE WHEN role = 'user' THEN left(text, 5) ELSE '' END AS a, CASE WHEN turn % 3 <> 0 THEN left(text, 3) END AS b FROM conversations)
    SELECT conv_id, string_agg('=== ' || turn || ' ===' || chr(10) || CASE WHEN a <> '' THEN a ELSE '[fallback]' END, chr(10) || chr(10) ORDER BY turn, CASE WHEN a <> '' THEN a ELSE '[fallback]' END) AS text, count(*) AS pages_total, count_if(trim(a) <> '' AND trim(coalesce(b, '')) <> '')::BIGINT AS dual_source_pages, count_if(trim(a) = '' AND trim(coalesce(b, '')) <> '')::BIGINT AS fallback_pages FROM p GROUP BY 1
""")
def q94_dual_evidence(t):
    rows = t("conversations").select("conv_id", "turn", F.when(F.col("role") == "user", F.left("text", F.lit(5))).otherwise("").alias("a"), F.when(F.col("turn") % 3 != 0, F.left("text", F.lit(3))).alias("b"))
    return trees.evidence(rows, ["conv_id"], "turn", "a", "b")


RESULTS = ['{"document_type": "teacher", "questions": [{"id": "q1", "standard_answer": null}, {"items": [{"x": 1}, {"standard_answer": "B"}]}]}', '{"document_type": "student"}', '{"document_type": "teacher", "questions": []}', "broken", None]


@query(f"SELECT o_orderkey, ({['questions[1].id,questions[1].items[0].standard_answer', 'document_type,questions', '', 'document_type,questions', 'document_type,questions']})[o_orderkey % 5 + 1] AS faults FROM orders")
def q95_result_faults(t):
    return t("orders").select("o_orderkey", F.array_join(trees.result_faults(pick(F.col("o_orderkey"), RESULTS), "teacher"), ",").alias("faults"))


@query("""
    SELECT event_type, count(*) AS rows, count_if(value > 50)::BIGINT AS large, count_if(user_id % 2 = 0)::BIGINT AS even, round(sum(value) / greatest(1, count(*)), 4) AS reduction FROM events GROUP BY 1
""")
def q96_counters(t):
    rows = trees.counters(t("events"), {"large": F.col("value") > 50, "even": F.col("user_id") % 2 == 0}, ["event_type"])
    return rows.join(t("events").groupBy("event_type").agg(aggregates.mean_or_zero(F.col("value")).alias("reduction")), "event_type")


@query("""
    WITH a AS (SELECT o_custkey, o_orderkey, o_orderkey % 3 AS faults FROM orders), k AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY faults, o_orderkey) AS k FROM a), c AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey % 3, -o_totalprice, o_orderkey) AS k FROM orders)
    SELECT k.o_custkey, k.o_orderkey AS attempt, c.o_orderkey AS candidate FROM k JOIN c ON c.o_custkey = k.o_custkey AND c.k = 1 WHERE k.k = 1
""")
def q97_best_attempts(t):
    o = t("orders").withColumn("faults", F.col("o_orderkey") % 3)
    attempt = ordering.best(o, ["o_custkey"], -F.col("faults"), ["o_orderkey"]).select("o_custkey", F.col("o_orderkey").alias("attempt"))
    candidate = ordering.first_by(o, ["o_custkey"], ["faults", -F.col("o_totalprice"), "o_orderkey"]).select("o_custkey", F.col("o_orderkey").alias("candidate"))
    return attempt.join(candidate, "o_custkey")


@query("""
    WITH s AS (SELECT l_orderkey AS d, l_linenumber AS i, l_partkey % 2 AS slot, CASE WHEN l_quantity > 40 THEN 'UNRESOLVED' WHEN l_quantity < 10 THEN 'BLANK' ELSE 'RECOGNIZED' END AS st FROM lineitem),
    g AS (SELECT d, i, slot, bool_and(st = 'RECOGNIZED') AS r, bool_and(st = 'BLANK') AS b FROM s GROUP BY ALL)
    SELECT d AS document_id, count(*) AS total_logical_slots, count_if(r)::BIGINT AS answers_extracted, count_if(b)::BIGINT AS blank_slots, count_if(NOT r AND NOT b)::BIGINT AS unresolved_slots, (SELECT count(*) FROM s WHERE s.d = g.d AND st = 'BLANK') AS blank_regions FROM g GROUP BY 1
""")
def q98_answer_summary(t):
    q = F.col("l_quantity")
    parts = t("lineitem").select(F.col("l_orderkey").alias("document_id"), F.col("l_linenumber").alias("item_id"), (F.col("l_partkey") % 2).alias("slot_id"), F.when(q > 40, "UNRESOLVED").when(q < 10, "BLANK").otherwise("RECOGNIZED").alias("content_status"))
    out = extraction.answer_summary(parts)
    return out.select("document_id", "total_logical_slots", "answers_extracted", "blank_slots", "unresolved_slots", F.coalesce(F.try_element_at("content", F.lit("BLANK")), F.lit(0)).alias("blank_regions"))


@query(_BOX + """
    SELECT label AS case_id, count(*) AS annotated_regions, count_if(greatest(0, least(x2, 210) - greatest(x1, 0)) * greatest(0, least(y2, 190) - greatest(y1, 0)) / greatest(1, (x2 - x1) * (y2 - y1)) >= 0.95 AND vec_id % 3 <> 0)::BIGINT AS context_contains_answer FROM b GROUP BY 1
""")
def q99_context_recall(t):
    slots = vector_boxes(t).select(F.col("label").alias("case_id"), (F.col("vec_id") % 3).alias("item_id"), F.col("vec_id").alias("slot_id"), F.lit(1).alias("page_index"), F.lit(0).alias("ord"), "box")
    contexts = slots.filter("item_id <> 0").select("case_id", "item_id", "page_index", F.array(*[F.lit(float(x)) for x in (0, 0, 210, 190)]).alias("context_box")).distinct()
    return evaluation.context_recall(slots, contexts)


@query("""
    SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority < '2') AND c_custkey NOT IN (SELECT s_suppkey FROM supplier)
""")
def q100_unexplained_pages(t):
    urgent = t("orders").filter("o_orderpriority < '2'").select(F.col("o_custkey").alias("c_custkey")).distinct()
    return structure.unexplained_pages(t("customer").select("c_custkey"), urgent, t("supplier").select(F.col("s_suppkey").alias("c_custkey")), ["c_custkey"])


@query("""
    WITH e AS (SELECT user_id, event_id, epoch_us(ts) / 1e6 AS s FROM events), f AS (SELECT *, CASE WHEN s - lag(s) OVER (PARTITION BY user_id ORDER BY s, event_id) > 7200 THEN 1 ELSE 0 END AS far FROM e),
    i AS (SELECT *, sum(far) OVER (PARTITION BY user_id ORDER BY s, event_id ROWS UNBOUNDED PRECEDING) AS k FROM f) SELECT user_id, count(*) AS n, round(least(0.95, 0.58 + 0.06 * count(*)), 6)::DOUBLE AS confidence FROM i WHERE k = 0 GROUP BY 1
""")
def q101_streaks(t):
    rows = t("events").withColumn("s", F.unix_micros(F.col("ts").cast("timestamp")) / 1e6)
    found = windows.streak(rows, ["user_id"], ["s", "event_id"], F.col("s"), 7200).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return found.withColumn("confidence", F.round(candidates.cohort_confidence(F.col("n")), 6))


@query("""
    SELECT o_custkey, len(list_filter([1, 2, 3], lambda x: NOT list_contains(list(o_orderkey % 5 + 1), x))) = 0 AND count_if(o_orderstatus <> 'F')::DOUBLE / count(*) >= 0.45 AS accepted FROM orders GROUP BY 1
""")
def q102_accepted_templates(t):
    rows = t("orders").groupBy("o_custkey").agg(F.collect_set((F.col("o_orderkey") % 5 + 1).cast("int")).alias("found"), aggregates.ratio(F.count_if(F.col("o_orderstatus") != "F"), F.count(F.lit(1))).alias("kept"))
    return rows.select("o_custkey", structure.accepted_template(F.col("found"), F.array(F.lit(1), F.lit(2), F.lit(3)), F.col("kept")).alias("accepted"))


@query("""
    WITH d AS (SELECT n_name AS subject, s_name AS owner, CASE WHEN s_suppkey % 4 = 0 THEN 'teacher' ELSE 'student' END AS role FROM supplier JOIN nation ON n_nationkey = s_nationkey),
    own AS (SELECT * FROM d WHERE role = 'student' AND owner IN (SELECT max(owner) FROM d WHERE role = 'student'))
    SELECT subject, owner, role FROM own UNION ALL SELECT subject, owner, role FROM d WHERE role = 'teacher' AND subject IN (SELECT subject FROM own)
""")
def q103_selected_documents(t):
    d = t("supplier").join(t("nation"), F.col("n_nationkey") == F.col("s_nationkey")).select(F.col("n_name").alias("subject"), F.col("s_name").alias("owner"), F.when(F.col("s_suppkey") % 4 == 0, "teacher").otherwise("student").alias("role"))
    last = d.filter("role = 'student'").agg(F.max("owner").alias("m"))
    marked = d.join(F.broadcast(last), F.col("owner") == F.col("m"), "left").withColumn("owner_", F.when(F.col("m").isNotNull(), "chosen").otherwise(F.col("owner")))  # one row
    picked = files.selected(marked.select("subject", F.col("owner_").alias("owner"), "role", F.col("owner").alias("name")), student="chosen")
    return picked.select("subject", F.col("name").alias("owner"), "role")


@query("""
    SELECT conv_id, sha256(string_agg(role || text, '' ORDER BY turn, role)) AS fingerprint FROM conversations GROUP BY 1
""")
def q104_document_fingerprints(t):
    pages = t("conversations").select("conv_id", F.col("turn").alias("page_index"), F.col("role").alias("name"), F.col("text").cast("binary").alias("content"))
    return files.document_fingerprint(pages, ["conv_id"])


@query(_BOX + """
    , s AS (SELECT * FROM b WHERE vec_id % 10 = 3), m AS (SELECT s.vec_id, s.label, o.vec_id AS other, o.x1 AS ox1, o.x2 AS ox2, s.x1 AS sx1, s.x2 AS sx2, abs((s.y1 + s.y2) / 2 - (o.y1 + o.y2) / 2) <= greatest(18, (s.y2 - s.y1) * 0.6) AS near FROM s JOIN b o ON o.label = s.label)
    SELECT s.vec_id::VARCHAR AS slot_id, (SELECT max_by('t' || other, ox2) FROM m WHERE m.vec_id = s.vec_id AND near AND ox2 <= sx1 + 8) AS before, (SELECT min_by('t' || other, ox1) FROM m WHERE m.vec_id = s.vec_id AND near AND ox1 >= sx2 - 8) AS after FROM s
""")
def q105_printed_context(t):
    rows = vector_boxes(t).withColumnRenamed("label", "page")
    slots = rows.filter("vec_id % 10 = 3").select(F.col("vec_id").cast("string").alias("slot_id"), "page", "box")
    blocks = rows.select("page", F.col("vec_id").alias("block_ord"), F.concat(F.lit("t"), "vec_id").alias("text"), F.col("box").alias("block_box"))
    return joins.printed_context(slots, blocks).select("slot_id", "before", "after")


@query("SELECT s.doc_id, s.lang, text IS NOT NULL AND length(text) > 500 AS served FROM (SELECT doc_id, lang, text FROM documents) s")
def q106_new_work(t):
    """Documents that a cache of the long ones lacks, and those it has."""
    d = t("documents").select("doc_id", "lang", F.col("doc_id").alias("fingerprint"), "text")
    cache = d.filter(F.char_length("text") > 500).select("fingerprint")
    missing = files.new_work(d, cache).select("doc_id", "lang", F.lit(False).alias("served"))
    return missing.unionByName(d.join(cache, "fingerprint", "left_semi").select("doc_id", "lang", F.lit(True).alias("served")))


@query("""
    SELECT conv_id, role, turn AS slot FROM conversations UNION ALL SELECT conv_id, 'nobody', NULL FROM (SELECT DISTINCT conv_id FROM conversations)
""")
def q107_expanded_slots(t):
    items = t("conversations").groupBy("conv_id", "role").agg(F.collect_list("turn").alias("slots"))
    none = items.select("conv_id", F.lit("nobody").alias("role"), F.lit(None).cast("array<bigint>").alias("slots")).distinct()
    return files.expand_slots(items.unionByName(none))
