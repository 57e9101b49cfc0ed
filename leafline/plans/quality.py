"""Queries of quality, telemetry, cohorts and numbering with their SQL twins."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leafline.operators import quality
from leafline.plans.registry import pick, pick_sql, query
from leafline.plans.texts import _BOX, vector_boxes

GIVEN = ["A", "b.", "ABC", "✓", "xyz", "", None, " 12 ", "seven words", "a long answer of many words", "c 、"]


@query(f"""
    WITH v AS (SELECT o_orderkey, ['choice', 'fill_blank', 'short'][o_orderkey % 3 + 1] AS k, CASE WHEN o_orderkey % 7 <> 0 THEN (o_orderkey % 10) / 10.0::DOUBLE END AS c, trim(coalesce({pick_sql('o_orderkey // 3', GIVEN)}, '')) AS t FROM orders),
    f AS (SELECT *, CASE WHEN k = 'choice' AND regexp_matches(t, '^[A-Ha-h]\\s*[.、]?$') THEN upper(left(t, 1)) ELSE t END AS x FROM v), n AS (SELECT *, length(x) AS n FROM f),
    g AS (SELECT *, CASE WHEN k = 'choice' THEN CASE WHEN regexp_matches(x, '^[A-H]$') THEN 1 WHEN regexp_matches(x, '^[A-H]{{2,4}}$') THEN 2 WHEN regexp_matches(x, '^[✓✔√☑勾]$') THEN 3 ELSE 4 END WHEN n = 0 THEN 5 WHEN k = 'fill_blank' THEN CASE WHEN n <= 3 THEN 6 WHEN n <= 10 THEN 7 ELSE 8 END ELSE 9 END AS s FROM n)
    SELECT o_orderkey, x AS text, x <> t AS corrected, CASE s WHEN 1 THEN CASE WHEN c > 0.8 THEN 0.95 ELSE 0.85 END WHEN 2 THEN CASE WHEN c > 0.7 THEN 0.9 ELSE 0.75 END WHEN 3 THEN CASE WHEN c IS NULL OR c >= 0.65 THEN 0.85 ELSE 0.75 END WHEN 4 THEN 0.3 WHEN 5 THEN 0.0
           WHEN 6 THEN CASE WHEN c > 0.7 THEN 0.85 ELSE 0.7 END WHEN 7 THEN CASE WHEN c > 0.6 THEN 0.75 ELSE 0.6 END WHEN 8 THEN 0.5 ELSE CASE WHEN c > 0.5 THEN 0.6 ELSE 0.4 END END::DOUBLE AS confidence,
           CASE WHEN s <= 3 OR (s = 6 AND c > 0.7) THEN 'high' WHEN s IN (4, 5) THEN 'low' ELSE 'medium' END AS quality, NOT (s <= 3 OR (s = 6 AND coalesce(c > 0.7, false)) OR (s = 7 AND coalesce(c > 0.6, false))) AS needs_review FROM g
""")
def q110_assessed_answers(t):
    o = F.col("o_orderkey")
    kind = F.element_at(F.array(*[F.lit(x) for x in ("choice", "fill_blank", "short")]), (o % 3 + 1).cast("int"))
    a = quality.assessed(pick(F.floor(o / 3), GIVEN), kind, F.when(o % 7 != 0, (o % 10) / 10.0))
    rows = t("orders").select("o_orderkey", a.alias("a"))
    return rows.select("o_orderkey", *[F.col(f"a.{c}").alias(c) for c in ("text", "corrected", "confidence", "quality", "needs_review")])


GEOMETRY, CONTENT = ["ALIGNED", "MISSING", "FAILED", "ALIGNED_WITH_WARNING", "UNCERTAIN", None], ["RECOGNIZED", "BLANK", "OCR_UNCERTAIN", "VLM_UNCERTAIN"]
_FAULTS = f"""
    WITH s AS (SELECT l_orderkey AS item_id, l_linenumber AS slot_idx, {pick_sql('l_partkey', GEOMETRY)} AS g, {pick_sql('l_suppkey', CONTENT)} AS c, CASE WHEN l_quantity > 45 THEN 'ANOMALY_ESCALATED' ELSE 'PENDING' END AS st, l_returnflag = 'N' AS b, CASE WHEN l_quantity > 5 THEN 'x' ELSE '' END AS text FROM lineitem),
    f AS (SELECT item_id, slot_idx, 'reason' AS level, 'TEACHER_ANSWER_MISSING' AS code FROM s WHERE text = ''
        UNION ALL SELECT item_id, slot_idx, CASE WHEN g = 'MISSING' AND c = 'BLANK' AND b THEN 'warning' WHEN g IN ('MISSING', 'FAILED', 'UNCERTAIN') THEN 'reason' WHEN g = 'ALIGNED_WITH_WARNING' THEN 'warning' ELSE 'reason' END,
            CASE WHEN g = 'MISSING' AND c = 'BLANK' AND b THEN 'BLANK_WITHOUT_PIXELS' WHEN g = 'MISSING' THEN 'NOT_FOUND' WHEN g IN ('FAILED', 'UNCERTAIN') THEN 'GEOMETRY_OPEN' WHEN g = 'ALIGNED_WITH_WARNING' THEN 'GEOMETRY_WARNING' ELSE 'ESCALATED' END
            FROM s WHERE g IN ('MISSING', 'FAILED', 'UNCERTAIN', 'ALIGNED_WITH_WARNING') OR st = 'ANOMALY_ESCALATED'
        UNION ALL SELECT item_id, slot_idx, 'warning', 'CONTENT_UNCERTAIN' FROM s WHERE c LIKE '%_UNCERTAIN')
"""


def _faults(t):
    q = F.col("l_quantity")
    slots = t("lineitem").select(
        F.col("l_orderkey").alias("item_id"), F.col("l_linenumber").alias("slot_idx"), pick(F.col("l_partkey"), GEOMETRY).alias("geometry"), pick(F.col("l_suppkey"), CONTENT).alias("content"),
        F.when(q > 45, "ANOMALY_ESCALATED").otherwise("PENDING").alias("status"), (F.col("l_returnflag") == "N").alias("blank_confirmed"), F.when(q > 5, "x").otherwise("").alias("text"),
    )
    return quality.slot_faults(slots, teacher=True)


@query(_FAULTS + "SELECT item_id, slot_idx, level, code FROM f")
def q111_slot_faults(t):
    return _faults(t)


@query(_FAULTS + """
    , p AS (SELECT item_id, count_if(level = 'reason') AS r, count_if(level = 'warning') AS w FROM f GROUP BY 1), o AS (SELECT o_orderkey AS item_id, (o_orderkey % 4 = 0)::INT AS k, (o_orderkey % 3)::INT AS n FROM orders)
    SELECT item_id, CASE WHEN coalesce(r, 0) > 0 OR k > 0 THEN 'NEED_REVIEW' ELSE 'OK' END AS status, coalesce(r, 0)::BIGINT AS reasons, coalesce(w, 0)::BIGINT AS warnings, n AS regions, k::BIGINT AS overlaps FROM o LEFT JOIN p USING (item_id)
""")
def q112_item_quality(t):
    o = F.col("o_orderkey")
    region = F.array(F.lit(0.0), F.lit(0.0), F.lit(1.0), F.lit(1.0))
    items = t("orders").select(o.alias("item_id"), F.array_repeat(region, (o % 3).cast("int")).alias("regions"))
    return quality.item_quality(items, _faults(t), items.filter("item_id % 4 = 0").select("item_id"))


@query("""
    SELECT event_type AS operation, count(*) AS request_count, round(sum(value / 10), 4) AS duration_seconds, sum(user_id % 3)::BIGINT AS image_count, sum(event_id)::BIGINT AS image_bytes, sum(user_id % 2 + 1)::BIGINT AS attempts, count_if(value > 90)::BIGINT AS failures,
           count_if(user_id % 5 = 0)::BIGINT AS cache_hits, round(count_if(user_id % 5 = 0) / greatest(1, count(*)), 4) AS cache_hit_rate FROM events GROUP BY ROLLUP (event_type)
""")
def q113_telemetry_rollup(t):
    u = F.col("user_id")
    return quality.telemetry(t("events").select(F.col("event_type").alias("operation"), (F.col("value") / 10).alias("duration_seconds"), (u % 3).alias("image_count"), F.col("event_id").alias("image_bytes"), (u % 2 + 1).alias("attempts"), F.when(F.col("value") > 90, "FAILED").otherwise("SUCCESS").alias("status"), (u % 5 == 0).alias("cache_hit")))


@query("""
    WITH s AS (SELECT l_suppkey, l_linenumber, count(*) FILTER (WHERE l_quantity <= 40) AS n, count_if(l_quantity <= 40 AND l_returnflag = 'R' AND l_linenumber % 3 = 0) AS k FROM lineitem GROUP BY 1, 2)
    SELECT l_suppkey, CASE WHEN max(n) >= 2 THEN count_if(coalesce(round(k / nullif(n, 0), 4), 0) >= 0.2) END::BIGINT AS slots, max(n)::BIGINT AS samples FROM s GROUP BY 1
""")
def q114_cohort_support(t):
    used = F.when(F.col("l_quantity") <= 40, (F.col("l_returnflag") == "R") & (F.col("l_linenumber") % 3 == 0))
    return quality.cohort_support(t("lineitem").select("l_suppkey", "l_linenumber", used.alias("used")), ["l_suppkey"], "l_linenumber", "used")


@query(_BOX + """
    , c AS (SELECT *, (x1 + x2) / 2 AS cx, (y1 + y2) / 2 AS cy FROM b), g AS (SELECT *, CASE WHEN lag(x2) OVER w IS NULL OR (x1 - lag(x2) OVER w < 50 AND abs(cy - lag(cy) OVER w) < 30) THEN 0 ELSE 1 END AS far FROM c WINDOW w AS (PARTITION BY label ORDER BY cy, cx, vec_id))
    SELECT vec_id, sum(far) OVER (PARTITION BY label ORDER BY cy, cx, vec_id ROWS UNBOUNDED PRECEDING)::BIGINT AS cluster FROM g
""")
def q115_line_clusters(t):
    return quality.line_clusters(vector_boxes(t), ["label"], "box", ["vec_id"]).select("vec_id", "cluster")


@query("""
    WITH l AS (SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey, l_quantity)::INT AS slot_idx FROM lineitem WHERE l_quantity > 20), n AS (SELECT l_orderkey, max(slot_idx) AS n FROM l GROUP BY 1)
    SELECT l_orderkey, slot_idx, true AS filled FROM l UNION ALL SELECT o_orderkey, k::INT, false FROM (SELECT o_orderkey, coalesce(n, 0) AS n, unnest(range(1, 6)) AS k FROM orders LEFT JOIN n ON l_orderkey = o_orderkey) WHERE k > n
""")
def q116_renumbered_slots(t):
    expected = t("orders").select(F.col("o_orderkey").alias("l_orderkey"), F.lit(5).alias("expected"))
    return quality.renumbered(t("lineitem").filter("l_quantity > 20"), "l_orderkey", ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"], expected)


@query("""
    SELECT c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey % 13, c_custkey)::INT AS place FROM customer
""")
def q117_natural_order(t):
    c = F.col("c_custkey")
    key = quality.natural_key(F.concat(F.lit("Page"), (c % 13).cast("string"), F.lit("-"), c.cast("string"), F.lit(".png")))
    return t("customer").withColumn("key", key).select("c_custkey", F.row_number().over(W.partitionBy("c_nationkey").orderBy("key")).alias("place"))


@query(_BOX + """
    SELECT vec_id, CASE vec_id % 4 WHEN 0 THEN 200 WHEN 1 THEN 100 ELSE 1654 END AS width, CASE vec_id % 4 WHEN 0 THEN 300 WHEN 1 THEN 100 ELSE 2338 END AS height, x2 <= CASE vec_id % 4 WHEN 0 THEN 200 WHEN 1 THEN 100 ELSE 1654 END AND y2 <= CASE vec_id % 4 WHEN 0 THEN 300 WHEN 1 THEN 100 ELSE 2338 END AS valid FROM b
""")
def q118_page_sizes(t):
    slots = vector_boxes(t).withColumn("page_index", (F.col("vec_id") % 4).cast("int"))
    pages = t("region").select(F.col("r_regionkey").alias("page_index")).filter("page_index < 2").withColumn("width", F.when(F.col("page_index") == 0, 200).otherwise(100)).withColumn("height", F.when(F.col("page_index") == 0, 300).otherwise(100))
    return quality.page_sizes(slots, pages).select("vec_id", "width", "height", "valid")


@query("""
    SELECT event_id, '{"a": {"answer_bbox": [2, 1, 4, ' || json_extract_string(props, '$.k') || ']}, "n": [1, 2, 3, 4]}' AS tree FROM events
""")
def q119_transposed_trees(t):
    tree = F.concat(F.lit('{"a": {"answer_bbox": [1, 2, '), F.get_json_object("props", "$.k"), F.lit(', 4]}, "n": [1, 2, 3, 4]}'))
    return t("events").select("event_id", quality.transposed_tree(tree).alias("tree"))
