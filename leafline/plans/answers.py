"""Queries of the retry ladder and of automatic repair, with their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from leafline import store
from leafline.operators import ladder, repair
from leafline.plans.registry import query
from leafline.sources import providers


def _turns(t):
    """Three turns of a conversation are a page, a turn is an item with one slot."""
    page = (F.col("turn") / 3).cast("int") + 1
    return t("conversations").select(F.col("conv_id").cast("string").alias("document_id"), page.alias("page_index"), F.concat(F.lit("t"), "turn").alias("item_id"), F.col("turn").cast("int").alias("item_ord"), "conv_id", "turn", "text")


def _expected(t):
    return _turns(t).select("document_id", "page_index", "item_id", "item_ord", F.lit("fill").alias("item_type"), F.lit(1).alias("expected_slot_count"))


def recorded(t):
    """Answers of two attempts at a page, one at an item, one at an empty item, with faults that depend on page, turn and text."""
    rows, n = _turns(t), F.char_length("text")
    where = (F.col("conv_id") + F.col("page_index")) % 6

    def item(rung, layout, label, filled):
        region = F.struct(F.array(*[F.lit(float(x)) for x in (0, 0, 500, 100)]).alias("answer_bbox"), F.concat(F.lit(f"{rung}:"), "text").alias("transcription"), F.lit(True).alias("legible"), F.lit("handwriting").alias("content_kind"), F.lit(0.9).alias("confidence"))
        slot = F.struct(F.lit(1).alias("index"), label.alias("label"), F.lit("").alias("anchor_before"), F.lit("").alias("anchor_after"), F.when(filled, F.array(region)).otherwise(F.array()).alias("regions"), F.lit(0.9).alias("confidence"))
        return F.struct("item_id", "page_index", layout.alias("answer_layout"), F.array(slot).alias("slots"), F.lit(0.9).alias("confidence"))

    fine, some = F.lit("single"), n % 7 != 0
    part = F.lit("answer_part")
    pages = []
    for rung in (1, 2):
        # where 0: neither attempt is sound; where 3: the first lacks its first item; where 5: no answer to the first
        layout = F.when(where == 0, "round").otherwise(fine) if rung == 2 else fine
        kept = rows.filter(~((where.isin(0, 3)) & (F.col("turn") % 3 == 0))) if rung == 1 else rows
        made = kept.groupBy("document_id", "page_index", where.alias("w")).agg(F.array_sort(F.collect_list(F.struct("item_ord", item(rung, layout, part, some).alias("item")))).alias("i"))
        made = made.filter("w <> 5") if rung == 1 else made
        pages.append(made.select(F.concat_ws("/", "document_id", "page_index", F.lit(rung)).alias("key"), F.to_json(F.struct(F.transform("i", lambda x: x["item"]).alias("items"))).alias("response")))
    alone = [(3, rows.filter(where == 0), F.when(F.col("turn") % 4 == 1, "other").otherwise(part), some), (4, rows.filter(~some), part, F.col("turn") % 2 == 0)]
    for rung, of, label, filled in alone:
        pages.append(of.select(F.concat_ws("/", "document_id", "page_index", F.lit(rung), "item_id").alias("key"), F.to_json(F.struct(F.array(item(rung, fine, label, filled)).alias("items"))).alias("response")))
    out = pages[0]
    for p in pages[1:]:
        out = out.unionByName(p)
    return out


_TURNS = """
    t AS (SELECT conv_id::VARCHAR AS document_id, (turn // 3 + 1)::INT AS page_index, 't' || turn AS item_id, turn, text, (conv_id + turn // 3 + 1) % 6 AS w, length(text) % 7 = 0 AS blank FROM conversations),
    p AS (SELECT document_id, page_index, w, count(*) FILTER (WHERE turn % 3 <> 0) AS others, bool_or(turn % 3 = 0) AS has_first FROM t GROUP BY ALL),
    i AS (SELECT t.*, CASE WHEN t.w = 0 THEN CASE WHEN turn % 4 <> 1 THEN 3 END WHEN t.w IN (3, 5) THEN 2 ELSE 1 END AS base FROM t)
"""


@query(f"""
    WITH {_TURNS}
    SELECT document_id, page_index, item_id, CASE WHEN blank AND turn % 2 = 0 THEN 4 ELSE base END::INT AS rung,
           CASE WHEN blank AND turn % 2 = 0 THEN '4:' || text WHEN NOT blank THEN base || ':' || text END AS text
    FROM i WHERE base IS NOT NULL
""")
def q120_ladder(t):
    """Every turn of all conversations asked for in a ladder over recorded answers; its second run asks nothing (the answers are gone by then)."""
    expected, answers = _expected(t), recorded(t)
    folder = store.new_folder(expected.sparkSession, "ladder")
    ladder.climb(expected, lambda asked: providers.replayed(asked, answers), folder)
    again = ladder.climb(expected, providers.none, folder)
    found = ladder.accepted(again)
    slot = F.get(F.col("item.slots"), F.lit(0))
    return found.select("document_id", "page_index", "item_id", "rung", F.get(slot["regions"], F.lit(0))["transcription"].alias("text"))


@query(f"""
    WITH {_TURNS},
    c AS (SELECT document_id, page_index, count(*) AS items, count(base) AS accepted_items, count(*) FILTER (WHERE base IS NOT NULL AND blank) AS empties FROM i GROUP BY ALL)
    SELECT document_id, page_index, items, accepted_items, CASE WHEN accepted_items = 0 THEN 'UNRESOLVED' WHEN accepted_items < items THEN 'PARTIAL' ELSE 'ACCEPTED' END AS status,
           (CASE WHEN w = 0 THEN 2 + items WHEN w IN (3, 5) THEN 2 ELSE 1 END + empties)::BIGINT AS calls,
           (CASE WHEN w = 0 THEN 1 + items WHEN w IN (3, 5) THEN 1 ELSE 0 END + empties)::BIGINT AS retries
    FROM c JOIN p USING (document_id, page_index)
""")
def q121_ladder_pages(t):
    """Statuses and calls of the pages of the same ladder."""
    expected, answers = _expected(t), recorded(t)
    done = ladder.climb(expected, lambda asked: providers.replayed(asked, answers), store.new_folder(expected.sparkSession, "ladder"))
    return ladder.page_statuses(done, expected).select("document_id", "page_index", "items", "accepted_items", "status", "calls", "retries")


def _versions(t):
    """Results of the orders' lines in three versions: an order is an item, a line a slot."""
    aligned, read, faults = (F.col(c) for c in ("aligned", "recognized", "issues"))
    base = t("lineitem").groupBy(F.col("l_orderkey").alias("item_id")).agg(F.count_if(F.col("l_quantity") > 20).alias("aligned"), F.count_if(F.col("l_returnflag") == "R").alias("recognized"), F.count_if(F.col("l_tax") > 0.04).alias("issues"), F.max("l_returnflag").alias("text"))
    k = F.col("item_id") % 5
    second = base.withColumn("aligned", F.when(k == 0, aligned + 1).when(k == 1, F.greatest(aligned - 1, F.lit(0))).otherwise(aligned)).withColumn("issues", F.when(k == 2, F.greatest(faults - 1, F.lit(0))).when(k == 3, faults + 1).otherwise(faults))
    third = second.filter("item_id % 2 = 0").withColumn("recognized", read + F.when(F.col("item_id") % 3 == 0, 1).otherwise(0))
    return [base, second, third.withColumn("text", F.concat(F.lit("3 "), "text"))]


@query("""
    WITH v1 AS (SELECT l_orderkey AS item_id, count_if(l_quantity > 20) AS a, count_if(l_returnflag = 'R') AS r, count_if(l_tax > 0.04) AS i, max(l_returnflag) AS text FROM lineitem GROUP BY 1),
    v2 AS (SELECT item_id, CASE item_id % 5 WHEN 0 THEN a + 1 WHEN 1 THEN greatest(a - 1, 0) ELSE a END AS a, r, CASE item_id % 5 WHEN 2 THEN greatest(i - 1, 0) WHEN 3 THEN i + 1 ELSE i END AS i, text FROM v1),
    v3 AS (SELECT item_id, a, r + CASE WHEN item_id % 3 = 0 THEN 1 ELSE 0 END AS r, i, '3 ' || text AS text FROM v2 WHERE item_id % 2 = 0),
    s2 AS (SELECT v1.item_id, v2.a >= v1.a AND v2.r >= v1.r AND (v2.a > v1.a OR (v2.a = v1.a AND (v2.r > v1.r OR (v2.r = v1.r AND v2.i < v1.i)))) AS better, v1.a AS a1, v1.r AS r1, v1.i AS i1, v1.text AS t1, v2.a AS a2, v2.r AS r2, v2.i AS i2 FROM v1 JOIN v2 USING (item_id)),
    c2 AS (SELECT item_id, CASE WHEN better THEN a2 ELSE a1 END AS a, CASE WHEN better THEN r2 ELSE r1 END AS r, CASE WHEN better THEN i2 ELSE i1 END AS i, t1 AS text, CASE WHEN better THEN 2 ELSE 1 END AS version FROM s2),
    s3 AS (SELECT c2.*, v3.a AS a3, v3.r AS r3, v3.i AS i3, v3.text AS t3, v3.item_id IS NOT NULL AND v3.a >= c2.a AND v3.r >= c2.r AND (v3.a > c2.a OR (v3.a = c2.a AND (v3.r > c2.r OR (v3.r = c2.r AND v3.i < c2.i)))) AS better FROM c2 LEFT JOIN v3 USING (item_id))
    SELECT item_id, CASE WHEN better THEN a3 ELSE a END::BIGINT AS aligned, CASE WHEN better THEN r3 ELSE r END::BIGINT AS recognized, CASE WHEN better THEN i3 ELSE i END::BIGINT AS issues, CASE WHEN better THEN t3 ELSE text END AS text, CASE WHEN better THEN 3 ELSE version END::INT AS version FROM s3
""")
def q122_adopted_versions(t):
    """Three versions of results, the second and the third decided twice, the third then read."""
    versions = _versions(t)
    spark = versions[0].sparkSession
    folder = store.new_folder(spark, "results")
    for n, rows in enumerate([versions[0], versions[1], versions[1], versions[2], versions[1], versions[2]], 1):
        number = {1: 1, 2: 2, 3: 2, 4: 3, 5: 2, 6: 3}[n]  # versions begun again
        repair.adopt(rows, folder, number, ["item_id"])
    schema = "item_id bigint, aligned bigint, recognized bigint, issues bigint, text string, version int"
    return repair.current(spark, folder, schema, ["item_id"])


@query("""
    WITH s AS (SELECT l_orderkey AS item_id, l_quantity > 20 AND l_returnflag <> 'N' AS al, l_linestatus = 'F' AS rec, CASE l_suppkey % 4 WHEN 0 THEN ['ANCHOR_NOT_FOUND'] WHEN 1 THEN ['FORMULA_DISAGREEMENT', 'OTHER'] WHEN 2 THEN ['OTHER'] ELSE [] END AS issues, o_custkey % 3 AS attempts
               FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
    g AS (SELECT item_id, count_if(al) AS aligned, count_if(rec) AS recognized, sum(len(issues)) AS issues, list_sort(list_distinct(flatten(list(issues)))) AS reasons, max(attempts) AS attempts FROM s GROUP BY 1),
    k AS (SELECT *, list_filter(reasons, lambda x: x <> 'OTHER') AS known FROM g)
    SELECT item_id, aligned, recognized, issues::BIGINT AS issues, array_to_string(known, ',') AS reasons, len(known) > 0 AND (list_contains(known, 'FORMULA_DISAGREEMENT') OR (list_contains(known, 'ANCHOR_NOT_FOUND') AND aligned = 0 AND attempts < 2)) AS again FROM k
""")
def q123_items_to_retry(t):
    met = t("lineitem").join(t("orders"), F.col("o_orderkey") == F.col("l_orderkey"))
    k = F.col("l_suppkey") % 4
    issues = F.when(k == 0, F.array(F.lit("ANCHOR_NOT_FOUND"))).when(k == 1, F.array(F.lit("FORMULA_DISAGREEMENT"), F.lit("OTHER"))).when(k == 2, F.array(F.lit("OTHER")))
    box = F.array(*[F.lit(float(x)) for x in (0, 0, 9, 9)])
    slots = met.select(
        F.col("l_orderkey").alias("item_id"), F.when(F.col("l_returnflag") == "N", "MISSING").otherwise("ALIGNED").alias("geometry_status"), F.when(F.col("l_quantity") > 20, box).otherwise(F.array()).alias("box"),
        F.when(F.col("l_linestatus") == "F", "RECOGNIZED").otherwise("BLANK").alias("content_status"), F.lit("x").alias("text"), issues.alias("issues"), (F.col("o_custkey") % 3).alias("attempts"),
    )
    of_item = repair.states(slots, ["item_id"]).join(slots.groupBy("item_id").agg(F.max("attempts").alias("attempts")), "item_id")
    known, again = repair.to_retry(F.col("reasons"), F.col("aligned"), F.col("attempts"), F.lit(False))
    return of_item.select("item_id", "aligned", "recognized", "issues", F.array_join(known, ",").alias("reasons"), again.alias("again"))


@query("""
    WITH RECURSIVE b AS (SELECT vec_id AS place, label AS page, vec_id % 3 = 0 AS old, abs(embedding[1]::DOUBLE) * 1500 AS x, abs(embedding[2]::DOUBLE) * 2000 AS y, abs(embedding[3]::DOUBLE) * 900 + 30 AS w, abs(embedding[4]::DOUBLE) * 900 + 30 AS h FROM embeddings),
    m AS (SELECT a.place, a.page, c.place AS other, c.old FROM b a JOIN b c ON a.page = c.page AND NOT a.old AND (c.old OR c.place < a.place) AND
          greatest(0, least(a.x + a.w, c.x + c.w) - greatest(a.x, c.x)) * greatest(0, least(a.y + a.h, c.y + c.h) - greatest(a.y, c.y)) / greatest(1, least(a.w * a.h, c.w * c.h)) > 0.4),
    taken AS (SELECT DISTINCT place FROM m WHERE old),
    r AS (SELECT place, page, row_number() OVER (PARTITION BY page ORDER BY place) AS k FROM b WHERE NOT old AND place NOT IN (SELECT place FROM taken)),
    walk AS (
        SELECT page, 0::BIGINT AS k, []::BIGINT[] AS kept, []::BIGINT[] AS gone FROM (SELECT DISTINCT page FROM r)
        UNION ALL
        SELECT r.page, r.k, CASE WHEN hit THEN kept ELSE list_append(kept, r.place) END, CASE WHEN hit THEN list_append(gone, r.place) ELSE gone END
        FROM (SELECT r.*, walk.kept, walk.gone, EXISTS (SELECT 1 FROM m WHERE m.place = r.place AND NOT m.old AND list_contains(walk.kept, m.other)) AS hit FROM walk JOIN r ON r.page = walk.page AND r.k = walk.k + 1) r),
    g AS (SELECT unnest(gone) AS place FROM (SELECT page, max_by(gone, k) AS gone FROM walk GROUP BY page))
    SELECT page, place, place IN (SELECT place FROM taken) OR place IN (SELECT place FROM g) AS conflict FROM b WHERE NOT old
""")
def q124_free_places(t):
    """Embeddings as boxes: a third lie on the page already, the others are put there one by one."""
    at = lambda i: F.abs(F.get("embedding", F.lit(i)).cast("double"))
    x, y, w, h = at(0) * 1500, at(1) * 2000, at(2) * 900 + 30, at(3) * 900 + 30
    rows = t("embeddings").select(F.col("label").alias("page"), F.col("vec_id").alias("place"), F.array(x, y, x + w, y + h).alias("box"))
    return repair.free_places(rows.filter("place % 3 <> 0"), rows.filter("place % 3 = 0").select("page", "box")).select("page", "place", "conflict")
