"""All registered queries of the engine with their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leafline.functions import boxes, text
from leafline.operators import aggregates, assignment, candidates, contamination, evaluation, extraction, joins, ordering, structure, windows
from leafline.plans.registry import ORACLE_SQL, QUERIES, long, query  # noqa: F401
from leafline.streaming import arrivals

@query("SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus = 'O' AND o_totalprice > 100000 ORDER BY o_orderkey LIMIT 100")
def q01_filter_limit(t):
    rows = t("orders").filter((F.col("o_orderstatus") == "O") & (F.col("o_totalprice") > 100000))
    return rows.select("o_orderkey", "o_totalprice", "o_orderstatus").orderBy("o_orderkey").limit(100)


@query(r"""
    WITH n AS (SELECT page_id, lower(coalesce(url, '')) AS n FROM pages)
    SELECT page_id, coalesce(TRY_CAST(nullif(regexp_extract(n, 'page[ _-]*([0-9]+)', 1), '') AS BIGINT), TRY_CAST(nullif(regexp_extract(n, '\bp([0-9]+)\b', 1), '') AS BIGINT),
        TRY_CAST(nullif(regexp_extract(n, '[_-]([0-9]+)(?:\.[a-z]+)?$', 1), '') AS BIGINT), TRY_CAST(nullif(regexp_extract(n, '([0-9]+)[^0-9]*$', 1), '') AS BIGINT), 999999) AS page_number
    FROM n
""")
def q02_page_number(t):
    return t("pages").select("page_id", text.page_number(F.col("url")).alias("page_number"))


@query("""
    SELECT doc_id, length(regexp_replace(coalesce(text, ''), '[ \\t\\n\\r\\v\\f]+', '', 'g'))::BIGINT AS n_compact,
           md5(lower(regexp_replace(coalesce(text, ''), '[ \\t\\n\\r\\v\\f]+', '', 'g'))) AS squeezed_md5 FROM documents
""".replace("\\\\", "\\"))
def q03_normalised_text(t):
    return t("documents").select("doc_id", long(F.char_length(text.compact(F.col("text")))).alias("n_compact"), F.md5(text.squeezed(F.col("text")).cast("binary")).alias("squeezed_md5"))


@query("SELECT sha256(text) AS fingerprint, count(*) AS n, min(doc_id) AS first_doc FROM documents GROUP BY 1 HAVING count(*) > 1")
def q04_fingerprint_groups(t):
    rows = t("documents").select("doc_id", F.sha2("text", 256).alias("fingerprint"))
    return rows.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_doc")).filter("n > 1")


@query("""
    WITH d AS (SELECT d.doc_id, d.source, d.lang, (CASE WHEN coalesce(d.text, '') <> '' THEN 100 ELSE 0 END + CASE WHEN l.quality = 1 THEN 50 ELSE 0 END
                      + CASE WHEN l.doc_id IS NOT NULL THEN 30 ELSE 0 END + CASE WHEN d.n_chars > 1000 THEN 20 ELSE 0 END + CASE WHEN l.toxic = 0 THEN 10 ELSE 0 END)::BIGINT AS score
               FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)
    SELECT source, lang, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY source, lang ORDER BY score DESC, doc_id) AS k FROM d) WHERE k = 1
""")
def q05_best_candidate(t):
    d = t("documents").join(t("labels").withColumn("labelled", F.lit(1)), "doc_id", "left")
    points = [(F.coalesce("text", F.lit("")) != "", 100), (F.col("quality") == 1, 50), (F.col("labelled") == 1, 30), (F.col("n_chars") > 1000, 20), (F.col("toxic") == 0, 10)]
    score = sum((F.when(c, n).otherwise(0) for c, n in points), F.lit(0))
    return ordering.best(d.select("source", "lang", "doc_id", long(score).alias("score")), ["source", "lang"], F.col("score"), ["doc_id"])


@query("""
    SELECT count(*) AS answers_expected, count(*) FILTER (WHERE l.quality = p.guess) AS answers_exact,
           count(*) FILTER (WHERE p.guess = 1 AND l.quality = 1)::DOUBLE / nullif(count(*) FILTER (WHERE l.quality = 1), 0) AS recall,
           count(*) FILTER (WHERE p.guess = 1 AND l.quality = 1)::DOUBLE / nullif(count(*) FILTER (WHERE p.guess = 1), 0) AS precision
    FROM labels l LEFT JOIN (SELECT doc_id, CASE WHEN n_chars >= 200 THEN 1 ELSE 0 END AS guess FROM documents) p USING (doc_id)
""")
def q06_evaluation(t):
    guess = t("documents").select("doc_id", F.when(F.col("n_chars") >= 200, 1).otherwise(0).alias("guess"))
    met = t("labels").join(guess, "doc_id", "left")
    hit = F.count_if((F.col("guess") == 1) & (F.col("quality") == 1))
    return met.agg(
        F.count(F.lit(1)).alias("answers_expected"), F.count_if(F.col("quality") == F.col("guess")).alias("answers_exact"),
        aggregates.ratio(hit, F.count_if(F.col("quality") == 1)).alias("recall"), aggregates.ratio(hit, F.count_if(F.col("guess") == 1)).alias("precision"),
    )


@query("""
    WITH r AS (SELECT coalesce(d.lang, 'None') AS lang, coalesce(d.source, 'None') AS source, coalesce(l.quality::VARCHAR, 'None') AS quality, d.n_chars, coalesce(l.toxic, 0) AS toxic FROM documents d LEFT JOIN labels l USING (doc_id))
    SELECT coalesce('lang=' || lang, 'source=' || source, 'quality=' || quality) AS label, count(*) AS case_count, sum(n_chars)::BIGINT AS chars, sum(toxic)::BIGINT AS toxic
    FROM r GROUP BY GROUPING SETS ((lang), (source), (quality))
""")
def q07_grouping_sets(t):
    rows = t("documents").join(t("labels"), "doc_id", "left")
    return aggregates.by_dimension(rows, ["lang", "source", "quality"], {"chars": F.col("n_chars"), "toxic": long(F.coalesce("toxic", F.lit(0)))})


@query("""
    WITH d AS (SELECT l_orderkey AS o_orderkey, round(sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)), 2) AS derived FROM lineitem GROUP BY 1),
    o AS (SELECT o_orderkey, o_custkey, o_totalprice AS declared, derived, coalesce(abs(o_totalprice - derived) > 0.01, false) AS repaired, coalesce(derived, o_totalprice) AS total FROM orders LEFT JOIN d USING (o_orderkey))
    SELECT c_custkey, round(sum(total), 0) AS total, count_if(repaired)::BIGINT AS repaired, count(*)::BIGINT AS n_orders, CASE WHEN count_if(repaired) > 0 THEN 'REPAIRED' ELSE 'OK' END AS status
    FROM customer JOIN o ON o_custkey = c_custkey GROUP BY 1
""")
def q08_score_tree(t):
    lines = t("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))), 2).alias("score"))
    orders = aggregates.balanced_level(lines, t("orders").select("o_orderkey", "o_custkey", "o_totalprice"), "o_orderkey", "score", "o_totalprice")
    met = t("customer").select("c_custkey").join(orders, F.col("o_custkey") == F.col("c_custkey"))
    n = F.count_if("repaired")
    return met.groupBy("c_custkey").agg(F.round(F.sum("o_totalprice"), 0).alias("total"), n.alias("repaired"), F.count(F.lit(1)).alias("n_orders"), F.when(n > 0, "REPAIRED").otherwise("OK").alias("status"))


@query("""
    WITH w AS (SELECT conv_id, turn, lag(turn) OVER (PARTITION BY conv_id ORDER BY length(text), turn) AS prev FROM conversations WHERE turn IS NOT NULL)
    SELECT conv_id, prev AS after, turn AS before, turn - prev - 1 AS n_missing FROM w WHERE prev < turn - 1
""")
def q09_numbering_gaps(t):
    rows = t("conversations").withColumn("n", F.char_length("text"))
    return windows.numbering_gaps(rows, ["conv_id"], ["n", "turn"], "turn").select("conv_id", "after", "before", long(F.size("missing")).alias("n_missing"))


@query("""
    WITH w AS (SELECT l_orderkey, l_linenumber, lag(l_linenumber) OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber) AS prev FROM lineitem)
    SELECT l_orderkey, count_if(coalesce(prev > l_linenumber, false))::BIGINT AS falls, max(l_linenumber) - min(l_linenumber) + 1 <> count(DISTINCT l_linenumber) AS gap FROM w GROUP BY 1
""")
def q09b_order_faults(t):
    return windows.order_faults(t("lineitem"), ["l_orderkey"], ["l_shipdate", "l_linenumber"], "l_linenumber")


@query("""
    WITH e AS (SELECT user_id, event_id, epoch_us(ts) / 1e6 AS s FROM events),
    f AS (SELECT *, CASE WHEN s - lag(s) OVER (PARTITION BY user_id ORDER BY s, event_id) > 3600 THEN 1 ELSE 0 END AS far FROM e),
    i AS (SELECT *, sum(far) OVER (PARTITION BY user_id ORDER BY s, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS island FROM f)
    SELECT user_id, island, count(*) AS n, min(event_id) AS first_event FROM i GROUP BY 1, 2
""")
def q10_islands(t):
    rows = t("events").withColumn("s", F.unix_micros(F.col("ts").cast("timestamp")) / 1e6)
    found = windows.islands(rows, ["user_id"], ["s", "event_id"], F.col("s"), 3600)
    return found.groupBy("user_id", "island").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_event"))


@query("""
    WITH w AS (SELECT conv_id, turn, role, text, lag(text) OVER (PARTITION BY conv_id ORDER BY turn) AS p, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS r FROM conversations)
    SELECT conv_id, turn, coalesce(r = role OR (NOT regexp_matches(rtrim(p), '[.!?]$') AND regexp_matches(ltrim(text), '^[a-z]')), false) AS continues FROM w
""")
def q11_continuation(t):
    return windows.continuation(t("conversations"), ["conv_id"], ["turn"], "text", "role").select("conv_id", "turn", "continues")


@query("""
    SELECT l_orderkey, l_linenumber, l_quantity AS corridor_top, CASE WHEN nxt IS NULL THEN 60 ELSE greatest(l_quantity + 1, nxt - 8) END AS corridor_bottom
    FROM (SELECT *, lead(l_quantity) OVER (PARTITION BY l_orderkey ORDER BY l_quantity, l_linenumber) AS nxt FROM lineitem)
""")
def q12_corridors(t):
    rows = windows.corridors(t("lineitem"), ["l_orderkey"], ["l_quantity", "l_linenumber"], F.col("l_quantity"), F.col("l_quantity") + 1, F.lit(60.0))
    return rows.select("l_orderkey", "l_linenumber", "corridor_top", "corridor_bottom")


def _vector_boxes(t) -> DataFrame:
    """A box from the first four numbers of each vector, on a page of 1000."""
    v = [F.round(F.abs(F.get("embedding", F.lit(i)).cast("double")) * 1000, 3) for i in range(4)]
    return t("embeddings").select("vec_id", "label", F.array(v[0], v[1], v[0] + v[2] + 1, v[1] + v[3] + 1).alias("box"))


@query("""
    WITH v AS (SELECT vec_id, label, round(abs(embedding[1]::DOUBLE) * 1000, 3) AS a, round(abs(embedding[2]::DOUBLE) * 1000, 3) AS b, round(abs(embedding[3]::DOUBLE) * 1000, 3) AS c, round(abs(embedding[4]::DOUBLE) * 1000, 3) AS d FROM embeddings),
    x AS (SELECT vec_id, label, a AS x1, b AS y1, a + c + 1 AS x2, b + d + 1 AS y2 FROM v),
    p AS (SELECT l.vec_id AS vec_id, r.vec_id AS other_id, greatest(0, least(l.x2, r.x2) - greatest(l.x1, r.x1)) * greatest(0, least(l.y2, r.y2) - greatest(l.y1, r.y1)) AS i,
                 (l.x2 - l.x1) * (l.y2 - l.y1) AS la, (r.x2 - r.x1) * (r.y2 - r.y1) AS ra FROM x l JOIN x r ON l.label = r.label AND l.vec_id < r.vec_id)
    SELECT vec_id, other_id, round(i / greatest(1, la + ra - i), 6) AS overlap FROM p WHERE i / greatest(1, la + ra - i) > 0.35
""")
def q13_overlapping_boxes(t):
    rows = _vector_boxes(t)
    other = rows.select("label", F.col("vec_id").alias("vec_id_2"), F.col("box").alias("box_2"))
    pairs = joins.overlapping(rows, other, ["label"], "box", boxes.iou, 0.35, 250.0, keep=F.col("vec_id") < F.col("vec_id_2"))
    return pairs.select("vec_id", F.col("vec_id_2").alias("other_id"), F.round("overlap", 6).alias("overlap"))


@query("""
    WITH p AS (SELECT conv_id, role, turn, CASE WHEN length(text) % 7 = 0 THEN NULL ELSE text END AS text FROM conversations)
    SELECT conv_id, role, count(*)::INT AS n_parts, CASE WHEN count(*) = count(text) THEN string_agg(text, chr(10) ORDER BY turn) END AS text,
           CASE WHEN count(*) = count(text) THEN 'RECOGNIZED' ELSE 'UNRESOLVED' END AS status FROM p GROUP BY 1, 2
""")
def q14_joined_parts(t):
    rows = t("conversations").withColumn("text", F.when(F.char_length("text") % 7 != 0, F.col("text")))
    return aggregates.joined_parts(rows, ["conv_id", "role"], ["turn"], "text")


@query("""
    SELECT o_orderkey, count(*) AS n_parts, CASE WHEN bool_and(l_linestatus IN ('F')) THEN 'COMPLETE' WHEN bool_or(l_linestatus IN ('F')) THEN 'PARTIAL' ELSE 'UNRESOLVED' END AS status
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1
""")
def q15_item_status(t):
    met = t("orders").select("o_orderkey").join(t("lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linestatus"), "o_orderkey")
    return met.groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("n_parts"), aggregates.inclusion_status(F.col("l_linestatus"), ("F",)).alias("status"))


@query("""
    WITH p AS (SELECT l_orderkey AS item_id, CASE WHEN l_quantity > 45 THEN NULL ELSE 'x' END AS text, CASE WHEN l_quantity > 45 THEN 'UNRESOLVED' WHEN l_quantity < 3 THEN 'BLANK' ELSE 'RECOGNIZED' END AS status,
                      CASE WHEN l_quantity < 2 THEN 'MISSING' ELSE 'ALIGNED' END AS geometry, l_returnflag = 'N' AS confirmed FROM lineitem),
    g AS (SELECT item_id, count(*) AS n, count_if(status = 'RECOGNIZED') AS r, count_if(status = 'BLANK') AS b, bool_or(text IS NOT NULL) AS some_,
                 bool_and(geometry = 'ALIGNED' OR (geometry = 'MISSING' AND status = 'BLANK' AND confirmed)) AS placed FROM p GROUP BY 1)
    SELECT item_id, greatest(4, n)::BIGINT AS expected_slots, n AS observed_slots, r::BIGINT AS recognized_slots, b::BIGINT AS blank_slots, greatest(0, greatest(4, n) - r - b)::BIGINT AS unresolved_slots,
           CASE WHEN n >= 4 AND r + b = n AND placed THEN 'COMPLETE' WHEN some_ THEN 'PARTIAL' ELSE 'UNRESOLVED' END AS answer_status, (r + b)::DOUBLE / greatest(4, n) AS completion_rate FROM g
""")
def q15b_answer_completion(t):
    q = F.col("l_quantity")
    parts = t("lineitem").select(
        F.col("l_orderkey").alias("item_id"), F.when(q <= 45, "x").alias("text"), F.when(q > 45, "UNRESOLVED").when(q < 3, "BLANK").otherwise("RECOGNIZED").alias("status"),
        F.when(q < 2, "MISSING").otherwise("ALIGNED").alias("geometry"), (F.col("l_returnflag") == "N").alias("blank_confirmed"), F.lit(4).cast("bigint").alias("expected"),
    )
    return aggregates.item_status(parts, ["item_id"], "expected")


@query("""
    SELECT doc_id, 'left' AS side FROM (SELECT DISTINCT doc_id FROM documents) WHERE doc_id NOT IN (SELECT doc_id FROM labels)
    UNION ALL SELECT doc_id, 'right' FROM (SELECT DISTINCT doc_id FROM labels) WHERE doc_id NOT IN (SELECT doc_id FROM documents)
""")
def q16_uncovered(t):
    return joins.uncovered(t("documents"), t("labels"), ["doc_id"])


@query("""
    WITH a AS (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_quantity > 10), b AS (SELECT DISTINCT o_orderkey AS k FROM orders WHERE o_orderstatus <> 'P')
    SELECT count_if(a.k IS NULL)::BIGINT AS missing, count_if(b.k IS NULL)::BIGINT AS unexpected, count_if(a.k IS NULL) = 0 AND count_if(b.k IS NULL) = 0 AS covered FROM a FULL JOIN b ON a.k = b.k
""")
def q17_coverage(t):
    return joins.coverage(t("lineitem").filter("l_quantity > 10").select(F.col("l_orderkey").alias("k")), t("orders").filter("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("k")), ["k"])


@query("""
    SELECT c_custkey, n_name, r_name, CASE WHEN r_name IS NULL THEN 'TEACHER_MISSING' END AS error
    FROM customer LEFT JOIN (SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON r_regionkey = n_regionkey AND r_name <> 'ASIA') ON n_nationkey = c_nationkey
""")
def q18_lookup(t):
    places = t("nation").join(t("region").filter("r_name <> 'ASIA'"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "r_name")
    return joins.lookup(t("customer"), places, ["c_nationkey"], "TEACHER_MISSING").select("c_custkey", "n_name", "r_name", "error")


@query("""
    SELECT event_type AS operation, count(*) AS request_count, round(sum(value), 4) AS duration_seconds, count_if(value > 90)::BIGINT AS failures, count_if(user_id % 2 = 0)::BIGINT AS cache_hits,
           round(count_if(user_id % 2 = 0) / greatest(1, count(*)), 4) AS cache_hit_rate FROM events GROUP BY 1
""")
def q19_telemetry(t):
    return aggregates.telemetry(t("events"), F.col("event_type"), F.col("value"), F.col("value") > 90, F.col("user_id") % 2 == 0)


@query("""
    WITH c AS (SELECT p_partkey, p_size % 4 AS a, length(p_brand) % 4 AS b, length(p_type) % 4 AS c FROM part),
    d AS (SELECT *, CASE WHEN a > 0 AND b > 0 AND c > 0 THEN CASE WHEN a = b AND b = c THEN 'CONSENSUS' ELSE 'CONFLICT' END WHEN b > 0 AND c > 0 THEN CASE WHEN b = c THEN 'CONSENSUS_TWO_WAY' ELSE 'CONFLICT' END ELSE 'INSUFFICIENT' END AS decision FROM c)
    SELECT p_partkey, decision, CASE decision WHEN 'CONSENSUS' THEN a WHEN 'CONSENSUS_TWO_WAY' THEN c END::INT AS resolved FROM d
""")
def q20_consensus(t):
    decision, resolved = aggregates.consensus(F.col("p_size") % 4, F.char_length("p_brand") % 4, F.char_length("p_type") % 4)
    return t("part").select("p_partkey", decision.alias("decision"), resolved.cast("int").alias("resolved"))


@query("""
    WITH s AS (SELECT l_suppkey, l_shipmode_, count_if(l_returnflag = 'R')::DOUBLE / count(*) AS support FROM (SELECT *, l_linenumber AS l_shipmode_ FROM lineitem) GROUP BY 1, 2)
    SELECT l_suppkey, slot, round(support, 4) AS support, rank FROM (SELECT l_suppkey, l_shipmode_ AS slot, support, row_number() OVER (PARTITION BY l_suppkey ORDER BY support DESC, l_shipmode_)::INT AS rank FROM s WHERE support >= 0.2) WHERE rank <= 3
""")
def q21_support_top(t):
    s = t("lineitem").groupBy("l_suppkey", F.col("l_linenumber").alias("slot")).agg(aggregates.ratio(F.count_if(F.col("l_returnflag") == "R"), F.count(F.lit(1))).alias("support"))
    return ordering.top(s.filter("support >= 0.2"), ["l_suppkey"], [F.col("support").desc(), F.col("slot")], 3).withColumn("support", F.round("support", 4))


@query("""
    SELECT l_suppkey, greatest(-80, least(80, median(l_quantity - 25))) AS dx, greatest(-80, least(80, median(l_extendedprice / 100 - 300))) AS dy, count(*) AS samples FROM lineitem GROUP BY 1
""")
def q22_feedback(t):
    rows = t("lineitem").groupBy("l_suppkey").agg(F.median(F.col("l_quantity") - 25).alias("dx"), F.median(F.col("l_extendedprice") / 100 - 300).alias("dy"), F.count(F.lit(1)).alias("samples"))
    return rows.select("l_suppkey", boxes.clamped(F.col("dx"), 80.0).alias("dx"), boxes.clamped(F.col("dy"), 80.0).alias("dy"), "samples")


@query("""
    WITH b AS (SELECT item_id, list_distinct([substr(lower(text), i::INT, 4) FOR i IN range(1, length(text) - 2)]) AS g FROM benchmark WHERE length(text) >= 4)
    SELECT l.item_id, r.item_id AS other_id, round(len(list_intersect(l.g, r.g))::DOUBLE / len(l.g), 6) AS share FROM b l JOIN b r ON l.item_id <> r.item_id WHERE len(list_intersect(l.g, r.g))::DOUBLE / len(l.g) > 0.4
""")
def q23_contamination(t):
    b = t("benchmark").filter(F.char_length("text") >= 4).select("item_id", text.ngrams(F.lower("text"), 4).alias("g"))
    # equi-join on grams, then counts: only pairs that share one meet
    own = b.select("item_id", F.size("g").alias("n"), F.explode("g").alias("gram"))
    met = own.join(own.select(F.col("item_id").alias("other_id"), "gram"), "gram").filter("item_id <> other_id").groupBy("item_id", "other_id", "n").agg(F.count(F.lit(1)).alias("k"))
    return met.filter("k / n > 0.4").select("item_id", "other_id", F.round(F.col("k") / F.col("n"), 6).alias("share"))


@query("""
    WITH d AS (SELECT doc_id, unnest(list_distinct([substr(lower(text), i::INT, 4) FOR i IN range(1, length(text) - 2)])) AS g FROM documents WHERE length(text) >= 4),
    b AS (SELECT item_id, unnest(list_distinct([substr(lower(text), i::INT, 4) FOR i IN range(1, length(text) - 2)])) AS g FROM benchmark WHERE length(text) >= 4),
    nd AS (SELECT doc_id, count(*) AS nd FROM d GROUP BY 1), nb AS (SELECT item_id, count(*) AS nb FROM b GROUP BY 1),
    k AS (SELECT doc_id, item_id, count(*) AS k FROM d JOIN b USING (g) GROUP BY 1, 2)
    SELECT doc_id, item_id, round(k::DOUBLE / nb, 6) AS share, round(k::DOUBLE / nd, 6) AS doc_share FROM k JOIN nd USING (doc_id) JOIN nb USING (item_id) WHERE k::DOUBLE / nb > 0.4 OR k::DOUBLE / nd > 0.4
""")
def q23b_document_contamination(t):
    lower = lambda name, key: t(name).select(key, F.lower("text").alias("text"))
    found = contamination.contaminated(lower("documents", "doc_id"), lower("benchmark", "item_id"), 0.4, 4)
    return found.select("doc_id", "item_id", F.round("share", 6).alias("share"), F.round("doc_share", 6).alias("doc_share"))


@query("""
    SELECT p_partkey, CASE WHEN lower(p_type) SIMILAR TO '.*(brass|choice).*' THEN 'choice' WHEN lower(p_type) SIMILAR TO '.*(fill|steel).*' THEN 'fill' WHEN p_size > 40 THEN 'essay' ELSE 'short' END AS kind FROM part
""")
def q24_kind(t):
    n = F.lower("p_type")
    return t("part").select("p_partkey", F.when(n.rlike("brass|choice"), "choice").when(n.rlike("fill|steel"), "fill").when(F.col("p_size") > 40, "essay").otherwise("short").alias("kind"))


@query(r"""
    WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '\s+', '', 'g') AS t, CASE WHEN n_chars % 5 = 0 THEN 0.5 ELSE 0.9 END AS c FROM documents),
    r AS (SELECT doc_id, list_filter([CASE WHEN t = '' THEN 'EMPTY' END, CASE WHEN c < 0.65 THEN 'LOW_CONFIDENCE' END, CASE WHEN regexp_matches(t, '(\.\.\.|…)$') THEN 'TRUNCATED' END, CASE WHEN regexp_full_matches_(t) THEN 'MARKER_ONLY' END], lambda x: x IS NOT NULL) AS rs FROM d)
    SELECT doc_id, (i - 1)::INT AS ord, rs[i] AS reason FROM (SELECT doc_id, rs, unnest(range(1, len(rs) + 1)) AS i FROM r)
""".replace("regexp_full_matches_(t)", r"regexp_matches(t, '^[(\[]?[0-9]{1,2}[)\].、]?$')"))
def q25_reasons(t):
    d = t("documents").select("doc_id", text.content_issues(F.col("text"), F.when(F.col("n_chars") % 5 == 0, 0.5).otherwise(0.9), F.lit("short"), F.lit("")).alias("r"))
    return aggregates.reason_rows(d, ["doc_id"], F.col("r"))


@query("""
    WITH e AS (SELECT user_id, event_id, event_type, last_value(CASE WHEN event_type <> 'purchase' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before,
                      first_value(CASE WHEN event_type <> 'purchase' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS after FROM events)
    SELECT user_id, event_id, before, after FROM e WHERE event_type = 'purchase'
""")
def q26_nearest_around(t):
    return joins.nearest_around(t("events"), ["user_id"], ["ts", "event_id"], F.col("event_type") == "purchase", "event_id").select("user_id", "event_id", "before", "after")


@query("""
    SELECT event_id, CASE WHEN TRY_CAST(props AS JSON) IS NULL OR json_type(TRY_CAST(props AS JSON)) <> 'OBJECT' THEN 'NOT_OBJECT' WHEN len(list_filter(json_keys(props), lambda x: x <> 'k')) > 0 THEN 'UNKNOWN_KEY'
        WHEN NOT list_contains(json_keys(props), 'k') THEN 'MISSING_KEY' WHEN TRY_CAST(json_extract_string(props, '$.k') AS INT) IS NULL THEN 'WRONG_TYPE' END AS fault, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events
""")
def q27_json_audit(t):
    return t("events").select("event_id", structure.json_audit(F.col("props"), ["k"], {"k": "int"}).alias("fault"), F.get_json_object("props", "$.k").try_cast("bigint").alias("k"))


@query("""
    SELECT count(*) AS items, count_if(n_chars > 0)::BIGINT AS with_text, count_if(lang = 'en')::BIGINT AS english, count_if(n_chars > 5000)::BIGINT AS large, count(DISTINCT source) AS sources, count_if(n_chars > 5000)::DOUBLE / count(*) AS large_rate FROM documents
""")
def q28_stage_counters(t):
    big, n = F.count_if(F.col("n_chars") > 5000), F.count(F.lit(1))
    return t("documents").agg(n.alias("items"), F.count_if(F.col("n_chars") > 0).alias("with_text"), F.count_if(F.col("lang") == "en").alias("english"), big.alias("large"), F.countDistinct("source").alias("sources"), aggregates.ratio(big, n).alias("large_rate"))


@query("""
    WITH q AS (SELECT CASE WHEN n = 0 THEN 'missing' WHEN c < 0.5 THEN 'poor' WHEN n < 20 AND c < 0.8 THEN 'doubtful' WHEN c < 0.8 THEN 'fair' ELSE 'good' END AS quality
               FROM (SELECT length(trim(coalesce(text, ''), ' ')) AS n, (doc_id % 10)::DOUBLE / 10 AS c FROM documents))
    SELECT quality, count(*) AS n, printf('%.1f%%', 100.0 * count(*) / sum(count(*)) OVER ()) AS share FROM q GROUP BY 1
""")
def q29_triage(t):
    q = t("documents").select(aggregates.triage(F.col("text"), (F.col("doc_id") % 10).cast("double") / 10).alias("quality"))
    n = q.groupBy("quality").agg(F.count(F.lit(1)).alias("n"))
    return n.select("quality", "n", F.format_string("%.1f%%", (100.0 * F.col("n") / F.sum("n").over(W.partitionBy())).cast("double")).alias("share"))  # five lines


@query("""
    WITH w AS (SELECT item_id, unnest(list_distinct(string_split(text, ' '))) AS w FROM benchmark), n AS (SELECT item_id, count(*) AS n FROM w GROUP BY 1),
    p AS (SELECT l.item_id, r.item_id AS other_id, count(*)::DOUBLE / max(n.n) AS share FROM w l JOIN w r ON l.w = r.w AND l.item_id <> r.item_id JOIN n ON n.item_id = l.item_id GROUP BY 1, 2),
    k AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY share DESC, other_id) AS k, lead(share) OVER (PARTITION BY item_id ORDER BY share DESC, other_id) AS nxt FROM p)
    SELECT item_id, other_id, round(share, 6) AS share FROM k WHERE k = 1 AND share >= 0.2 AND share - coalesce(nxt, '-inf'::DOUBLE) >= 0.02
""")
def q30_best_with_margin(t):
    w = t("benchmark").select("item_id", F.array_distinct(F.split("text", " ")).alias("ws")).select("item_id", F.size("ws").alias("n"), F.explode("ws").alias("w"))
    p = w.join(w.select(F.col("item_id").alias("other_id"), "w"), "w").filter("item_id <> other_id").groupBy("item_id", "other_id").agg((F.count(F.lit(1)) / F.max("n")).alias("share"))
    return ordering.with_margin(p, ["item_id"], "share", ["other_id"], 0.2, 0.02).withColumn("share", F.round("share", 6))


@query("""
    WITH d AS (SELECT doc_id, unnest(list_distinct(string_split(text, ' '))) AS w FROM documents WHERE text IS NOT NULL), b AS (SELECT item_id, unnest(list_distinct(string_split(text, ' '))) AS w FROM benchmark WHERE text IS NOT NULL),
    n AS (SELECT doc_id, count(*) AS n FROM d GROUP BY 1), k AS (SELECT doc_id, item_id, count(*)::DOUBLE / any_value(n) AS share FROM d JOIN b USING (w) JOIN n USING (doc_id) GROUP BY 1, 2),
    r AS (SELECT *, row_number() OVER w AS k, lead(share) OVER w AS nxt FROM k WINDOW w AS (PARTITION BY doc_id ORDER BY share DESC, item_id))
    SELECT doc_id, item_id, round(share, 6) AS share FROM r WHERE k = 1 AND share >= 0.2 AND share - coalesce(nxt, '-inf'::DOUBLE) >= 0.02
""")
def q30b_document_best_with_margin(t):
    found = contamination.best_items(t("documents").select("doc_id", "text"), t("benchmark").select("item_id", "text"), 0.2, 0.02)
    return found.withColumn("share", F.round("share", 6))


@query()
def q31_best_assignment(t):
    e = t("events").filter("value > 0").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day"), "user_id", "event_type").agg(F.round(F.sum("value"), 4).alias("score"))
    return assignment.assign(e, "day", "user_id", "event_type", "score")


@query()
def q31b_greedy_assignment(t):
    e = t("events").filter("value > 0").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day"), "user_id", "event_type").agg(F.round(F.sum("value"), 4).alias("score"))
    return assignment.assign(e, "day", "user_id", "event_type", "score", method="greedy")


@query()
def q32_reading_order(t):
    rows = _vector_boxes(t).select(F.col("label").alias("page"), "vec_id", "box", F.concat(F.lit("block "), F.col("vec_id")).alias("text"))
    return ordering.reading_order(rows, ["page"], "box", "text", 1000.0).select("page", "vec_id", "place")


@query()
def q33_contiguous_parts(t):
    import pandas as pd

    rows = t("conversations").select("conv_id", "turn", F.char_length("text").alias("n"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["turn", "n"])
        steps = [abs(b - a) / 100 for a, b in zip(pdf["n"], pdf["n"][1:])]
        starts = assignment.contiguous_parts(steps, 3)
        return pd.DataFrame({"conv_id": pdf["conv_id"].iloc[0], "part": range(len(starts)), "start": starts})

    return rows.groupBy("conv_id").applyInPandas(run, "conv_id bigint, part int, start int")


@query()
def q34_similarity(t):
    b = t("benchmark").select("item_id", "text")
    w = W.orderBy("item_id")  # a bounded side input of a few hundred questions
    return b.withColumn("next", F.lead("text").over(w)).filter("next is not null").select("item_id", F.round(text.similarity("text", "next"), 6).alias("ratio"))


@query("""
    WITH q AS (SELECT o_custkey, (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) // 5 + 1 AS section, o_orderkey, o_orderkey % 4 AS number FROM orders),
    b AS (SELECT *, CASE WHEN count(*) OVER (PARTITION BY o_custkey, number) = 1 THEN 'q' || number ELSE 's' || section || '_q' || number END AS base FROM q)
    SELECT o_custkey, o_orderkey, CASE WHEN n = 1 THEN base ELSE base || '_' || n END AS local_id FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, base ORDER BY section, o_orderkey) AS n FROM b)
""")
def q35_local_ids(t):
    q = t("orders").select("o_custkey", "o_orderkey", (F.col("o_orderkey") % 4).alias("number"), (F.floor((F.row_number().over(W.partitionBy("o_custkey").orderBy("o_orderkey")) - 1) / 5) + 1).alias("section"))
    return structure.local_ids(q, ["o_custkey"], "section", ["o_orderkey"], "number").select("o_custkey", "o_orderkey", "local_id")


@query("""
    SELECT o.k AS l_orderkey, n::INT AS l_linenumber FROM (SELECT o_orderkey AS k, unnest(range(1, 6)) AS n FROM orders) o LEFT JOIN lineitem ON l_orderkey = o.k AND l_linenumber = n WHERE l_orderkey IS NULL
""")
def q36_placeholders(t):
    expected = t("orders").select(F.col("o_orderkey").alias("l_orderkey"), F.lit(5).alias("expected"))
    return windows.placeholders(t("lineitem"), expected, ["l_orderkey"], "l_linenumber", "expected")


@query("""
    SELECT user_id, array_to_string(list_sort(list_distinct(list(event_type))), ',') AS codes, array_to_string(list_sort(list_filter(['click', 'error', 'purchase', 'signup', 'view'], lambda x: NOT list_contains(list(event_type), x))), ',') AS absent FROM events GROUP BY 1
""")
def q37_code_sets(t):
    rows = aggregates.code_sets([t("events").filter("event_id % 2 = 0"), t("events").filter("event_id % 2 = 1")], ["user_id"], "event_type")
    all_ = F.array(*[F.lit(x) for x in ("click", "error", "purchase", "signup", "view")])
    return rows.select("user_id", F.array_join("codes", ",").alias("codes"), F.array_join(F.array_sort(F.array_except(all_, F.col("codes"))), ",").alias("absent"))


@query("""
    SELECT time_bucket(INTERVAL 1 DAY, ts) AS start, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1, 2
""")
def q39_tumbling(t):
    return arrivals.tumbling(t("events")).select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n", F.round("total", 2).alias("total"))


@query()
def q39b_sessions(t):
    return arrivals.sessions(t("events"))


@query("SELECT o_orderkey, round_even(o_totalprice * 1000 / 1654, 0) AS x, round_even(o_totalprice / 2, 0) AS half FROM orders")
def q40_half_even(t):
    return t("orders").select("o_orderkey", F.bround(F.col("o_totalprice") * 1000 / 1654, 0).alias("x"), F.bround(F.col("o_totalprice") / 2, 0).alias("half"))


@query("""
    WITH s AS (SELECT conv_id, turn, sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING)::BIGINT AS span FROM conversations)
    SELECT conv_id, span, count(*) AS n, min(turn) AS first_turn FROM s GROUP BY 1, 2
""")
def q41_marker_spans(t):
    s = windows.spans(t("conversations"), ["conv_id"], ["turn"], F.col("role") == "user")
    return s.groupBy("conv_id", "span").agg(F.count(F.lit(1)).alias("n"), F.min("turn").alias("first_turn"))


@query("""
    WITH w AS (SELECT l_orderkey, l_linenumber, l_quantity, l_partkey, l_suppkey, CASE WHEN lag(l_quantity) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) >= l_quantity THEN 1 ELSE 0 END AS stop FROM lineitem),
    s AS (SELECT *, sum(stop) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity ROWS UNBOUNDED PRECEDING) AS stops FROM w)
    SELECT l_orderkey, l_linenumber, l_quantity FROM s WHERE stops = 0
""")
def q42_rising_prefix(t):
    return windows.rising_prefix(t("lineitem"), ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity"], "l_quantity").select("l_orderkey", "l_linenumber", "l_quantity")


@query("""
    SELECT l_orderkey, l_linenumber, coalesce((lag(l_quantity + 1) OVER w + l_quantity) / 2, 0) AS band_low, coalesce((l_quantity + 1 + lead(l_quantity) OVER w) / 2, 100) AS band_high
    FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_quantity, l_linenumber)
""")
def q43_sibling_bands(t):
    rows = windows.bands(t("lineitem"), ["l_orderkey"], ["l_quantity", "l_linenumber"], F.col("l_quantity"), F.col("l_quantity") + 1, F.lit(0.0), F.lit(100.0))
    return rows.select("l_orderkey", "l_linenumber", "band_low", "band_high")


@query("SELECT l_orderkey, bool_and(n = l_linenumber) AS contiguous FROM (SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS n FROM lineitem) GROUP BY 1")
def q44_contiguous(t):
    return windows.contiguous(t("lineitem"), ["l_orderkey"], "l_linenumber")


@query("""
    WITH i AS (SELECT l_orderkey AS item_id, count(l_linenumber) AS n, count(DISTINCT l_linenumber) AS d, min(l_linenumber) AS lo, max(l_linenumber) AS hi, max(l_quantity::INT % 8) AS e FROM lineitem GROUP BY 1)
    SELECT 'DUPLICATE_SLOT' AS rule, 'error' AS level, item_id::VARCHAR AS key, (n - d) || ' repeated' AS message FROM i WHERE n > d
    UNION ALL SELECT 'SLOT_GAP', 'error', item_id::VARCHAR, 'slots ' || lo || ' to ' || hi FROM i WHERE n > 0 AND (lo <> 1 OR hi <> d)
    UNION ALL SELECT 'COUNT_RANGE', 'error', item_id::VARCHAR, 'count ' || e FROM i WHERE NOT e BETWEEN 1 AND 100
    UNION ALL SELECT 'COUNT_MISMATCH', 'warning', item_id::VARCHAR, e || ' expected, ' || d || ' found' FROM i WHERE e <> d
""")
def q45_tree_rules(t):
    return aggregates.tree_rules(t("lineitem").select(F.col("l_orderkey").alias("item_id"), F.col("l_linenumber").alias("slot_idx"), (F.col("l_quantity").cast("int") % 8).alias("expected_slot_count")))


@query("""
    SELECT conv_id, turn, ((row_number() OVER (PARTITION BY role ORDER BY conv_id, turn) - 1) // 12)::BIGINT AS batch, role FROM conversations
""")
def q46_batches(t):
    return ordering.batches(t("conversations").select("conv_id", "turn", "role"), ["role"], ["conv_id", "turn"], 12)


@query("""
    SELECT s.lang, coalesce(n, 0)::BIGINT AS n FROM (VALUES ('de'), ('en'), ('es'), ('fr'), ('zh')) AS s(lang) LEFT JOIN (SELECT lang, count(*) AS n FROM documents GROUP BY 1) c ON c.lang = s.lang
""")
def q47_histogram(t):
    return aggregates.histogram(t("documents"), "lang", ["de", "en", "es", "fr", "zh"])


@query("""
    WITH p AS (SELECT conv_id, turn, role, lower(regexp_replace(role, '[^0-9A-Za-z]+', '', 'g')) AS title FROM conversations),
    f AS (SELECT *, min(turn) OVER (PARTITION BY conv_id, title) AS first FROM p)
    SELECT conv_id, turn, dense_rank() OVER (PARTITION BY conv_id ORDER BY first)::INT AS section FROM f
""")
def q48_merged_sections(t):
    rows = t("conversations").select("conv_id", "turn", F.col("role").alias("head"))
    return structure.merged_sections(rows, ["conv_id"], F.lower(F.regexp_replace("head", "[^0-9A-Za-z]+", "")), ["turn"]).select("conv_id", "turn", "section")


@query("""
    SELECT o_orderkey, CASE WHEN ready THEN p1 = p2 END AS correct, CASE WHEN ready THEN CASE WHEN p1 = p2 THEN o_totalprice ELSE 0 END END AS score, CASE WHEN ready THEN 'auto_graded' ELSE 'needs_review' END AS status
    FROM (SELECT *, o_orderpriority LIKE '1%' OR o_orderpriority LIKE '2%' AS ready, lower(o_orderstatus) AS p1, CASE WHEN o_custkey % 2 = 0 THEN 'o' ELSE 'f' END AS p2 FROM orders)
""")
def q49_grading(t):
    kind = F.when(F.col("o_orderpriority").rlike("^[12]"), "choice").otherwise("essay")
    right, points, status = aggregates.graded(kind, F.col("o_orderstatus"), F.when(F.col("o_custkey") % 2 == 0, " O ").otherwise("f"), F.col("o_totalprice"))
    return t("orders").select("o_orderkey", right.alias("correct"), points.alias("score"), status.alias("status"))


@query("""
    SELECT l_orderkey, l_linenumber, a < b AS improved FROM (SELECT l_orderkey, l_linenumber, {'x': 1, 'y': 2, 'z': -l_linenumber} AS a, {'x': 1, 'y': 2, 'z': -3} AS b FROM lineitem)
""")
def q50_improved(t):
    before, after = [F.lit(1), F.lit(2), -F.col("l_linenumber")], [F.lit(1), F.lit(2), F.lit(-3)]
    return t("lineitem").select("l_orderkey", "l_linenumber", aggregates.improved(before, after).alias("improved"))


@query()
def q38_readiness(t):
    """Conversations as documents: an item for each role, a slot for each of its turns."""
    r = F.struct(
        F.array(*[F.lit(float(x)) for x in (0, 0, 500, 100)]).alias("answer_bbox"), F.col("text").alias("transcription"), (F.char_length("text") % 11 != 0).alias("legible"),
        F.lit("handwriting").alias("content_kind"), (F.lit(0.5) + (F.char_length("text") % 5) / 10).alias("confidence"),
    )
    w = W.partitionBy("conv_id", "role").orderBy("turn", F.xxhash64("text"))
    slot = F.struct(F.col("i").alias("index"), F.lit("answer_part").alias("label"), F.lit("").alias("anchor_before"), F.lit("").alias("anchor_after"), F.array(r).alias("regions"), F.lit(0.9).alias("confidence"))
    doc = F.col("conv_id").cast("string").alias("document_id")
    items = t("conversations").withColumn("i", F.row_number().over(w)).groupBy("conv_id", "role").agg(F.array_sort(F.collect_list(slot)).alias("slots"))
    item = F.struct(F.col("role").alias("item_id"), F.lit(1).alias("page_index"), F.lit("single").alias("answer_layout"), "slots", F.lit(0.9).alias("confidence"))
    pages = items.groupBy(doc).agg(F.to_json(F.struct(F.array_sort(F.collect_list(item)).alias("items"))).alias("response"))
    pages = pages.select("document_id", F.lit(1).alias("page_index"), F.lit(1654).alias("width"), F.lit(2338).alias("height"), "response")
    expected = t("conversations").groupBy(doc, F.col("role").alias("item_id")).agg(F.lit("short").alias("item_type"), F.count(F.lit(1)).cast("int").alias("expected_slot_count"))
    return extraction.readiness(pages, expected).drop("faults")


@query("""
    WITH s AS (SELECT p_partkey, p_brand, p_size::DOUBLE AS w, (p_partkey % 7)::DOUBLE AS d, p_partkey % 5 <> 0 AS found, p_partkey % 3 = 0 AS same FROM part),
    i AS (SELECT *, greatest(0, 10 + w - d) * 20 AS c, (10 + w) * 20 AS a FROM s),
    m AS (SELECT p_brand, count(*) AS slots_expected, count_if(found) AS slots_predicted, count_if(found AND c / greatest(1, 2 * a - c) >= 0.5) AS slots_matched, count_if(found AND same) AS slot_text_exact FROM i GROUP BY 1)
    SELECT p_brand AS case_id, slots_expected, slots_predicted::BIGINT AS slots_predicted, slots_matched::BIGINT AS slots_matched, slot_text_exact::BIGINT AS slot_text_exact,
           slots_matched::DOUBLE / nullif(slots_expected, 0) AS slot_recall_iou50, slots_matched::DOUBLE / nullif(slots_predicted, 0) AS slot_precision_iou50, slot_text_exact::DOUBLE / nullif(slots_expected, 0) AS slot_text_exact_match FROM m
""")
def q51_slot_evaluation(t):
    w, d = F.col("p_size").cast("double"), (F.col("p_partkey") % 7).cast("double")
    flat = lambda x: F.array(x, F.lit(0.0), x + 10 + w, F.lit(20.0))
    base = t("part").select(F.col("p_brand").alias("case_id"), F.lit("i").alias("item_id"), F.col("p_partkey").cast("string").alias("slot_id"), F.lit(1).alias("page_index"), F.lit(0).alias("ord"), flat(F.lit(0.0)).alias("box"), flat(d).alias("moved"), "p_partkey")
    truth = base.withColumn("text", F.lit("A"))
    found = base.filter("p_partkey % 5 <> 0").withColumn("box", F.col("moved")).withColumn("text", F.when(F.col("p_partkey") % 3 == 0, " A").otherwise("B"))
    none_q, none_i = base.select("case_id", F.lit("q").alias("question_id")).distinct(), base.select("case_id", "item_id", "ord", F.array(F.lit("x")).alias("answer"))
    counted = evaluation.counts(none_q, none_q, none_i.drop("ord").distinct(), none_i.distinct(), truth, found)
    return evaluation.metrics(counted).select("case_id", "slots_expected", "slots_predicted", "slots_matched", "slot_text_exact", "slot_recall_iou50", "slot_precision_iou50", "slot_text_exact_match")


@query("""
    WITH s AS (SELECT event_type AS page, count(DISTINCT user_id % 5) AS n FROM events GROUP BY 1), v AS (SELECT event_type AS page, (user_id % 7)::INT AS x, count_if(value > 50) AS votes, quantile_cont(value, 0.75) AS b FROM events GROUP BY 1, 2)
    SELECT page, x, votes::BIGINT AS votes, votes >= greatest(2, ceil(n * 0.7)) AS stable, round(b, 6) AS brightness FROM v JOIN s USING (page)
""")
def q52_cohort_votes(t):
    pixels = t("events").select(F.col("event_type").alias("page"), (F.col("user_id") % 5).alias("sheet"), (F.col("user_id") % 7).cast("int").alias("x"), F.lit(0).alias("y"), "value", (F.col("value") > 50).alias("ink"))
    return candidates.cohort_votes(pixels).select("page", "x", "votes", "stable", F.round("brightness", 6).alias("brightness"))


@query("""
    SELECT c_custkey, coalesce(o.k, s.k, -1) AS k FROM customer LEFT JOIN (SELECT o_custkey AS c_custkey, max(o_orderkey) AS k FROM orders WHERE o_orderstatus = 'P' GROUP BY 1) o USING (c_custkey)
    LEFT JOIN (SELECT s_suppkey AS c_custkey, -s_suppkey AS k FROM supplier) s USING (c_custkey)
""")
def q53_fallback_chain(t):
    pending = t("orders").filter("o_orderstatus = 'P'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_orderkey").alias("k"))
    other = t("supplier").select(F.col("s_suppkey").alias("c_custkey"), (-F.col("s_suppkey")).alias("k"))
    return joins.first_of(t("customer").select("c_custkey"), [pending, other], ["c_custkey"], "k").withColumn("k", F.coalesce("k", F.lit(-1)))


@query("""
    SELECT conv_id, count(*)::BIGINT AS n, CASE WHEN bool_and(role <> 'system') AND bool_or(regexp_matches(chr((65 + turn % 12)::INT), '^[A-H]$')) THEN 1 ELSE count(*) END::BIGINT AS n_items FROM conversations GROUP BY 1
""")
def q54_collapsed_choices(t):
    rows = t("conversations").select("conv_id", "turn", F.when(F.col("role") != "system", "choice").otherwise("fill").alias("kind"), F.char(65 + F.col("turn") % 12).alias("label"), F.array("role").alias("refs"))
    out = structure.collapsed_choices(rows, ["conv_id"], "turn", "kind", "label", "refs")
    return rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).join(out, "conv_id").select("conv_id", "n", "n_items")


@query("""
    WITH c AS (SELECT o_custkey, list_distinct(list(o_orderpriority)) AS a FROM orders GROUP BY 1), s AS (SELECT list_distinct(list(o_orderpriority)) AS b FROM orders WHERE o_orderpriority < '4')
    SELECT o_custkey, len(list_intersect(a, b)) >= 0.65 * len(b) AND len(list_filter(a, lambda x: NOT list_contains(b, x))) <= greatest(2, round_even(len(b) * 0.25, 0)) AS accepted FROM c, s
""")
def q55_candidate_gate(t):
    one = F.lit(1).alias("one_")
    named = t("orders").filter("o_orderpriority < '4'").agg(F.collect_set("o_orderpriority").alias("b")).select("b", one)  # one row, a handful of names
    rows = t("orders").groupBy("o_custkey").agg(F.collect_set("o_orderpriority").alias("a")).select("o_custkey", "a", one)
    return rows.join(F.broadcast(named), "one_").select("o_custkey", structure.candidate_gate(F.col("a"), F.col("b")).alias("accepted"))


@query("SELECT vec_id, x2 > x1 AND x2 <= 1654 AND y2 > y1 AND y2 <= 2338 AS valid, round((x2 - x1) * (y2 - y1), 3) AS area FROM (SELECT vec_id, round(abs(embedding[1]::DOUBLE) * 1000, 3) AS x1, round(abs(embedding[2]::DOUBLE) * 1000, 3) AS y1, round(abs(embedding[1]::DOUBLE) * 1000, 3) + round(abs(embedding[3]::DOUBLE) * 1000, 3) + 1 AS x2, round(abs(embedding[2]::DOUBLE) * 1000, 3) + round(abs(embedding[4]::DOUBLE) * 1000, 3) + 1 AS y2 FROM embeddings)")
def q56_valid_boxes(t):
    return _vector_boxes(t).select("vec_id", boxes.valid_box(F.col("box")).alias("valid"), F.round(boxes.area(F.col("box")), 3).alias("area"))


@query()
def q57_scored_candidates(t):
    rows = _vector_boxes(t)
    flag = F.col("vec_id") % 9 == 0
    blocks = rows.select(F.col("label").alias("page"), F.col("vec_id").alias("block_ord"), F.col("box").alias("block_box"), F.concat(F.lit("block "), "vec_id").alias("text"), F.lit(0.9).alias("confidence"), flag.alias("printed"), F.lit(False).alias("foreign_printed"), F.lit(0.0).alias("excluded"))
    slots = rows.select(F.col("vec_id").cast("string").alias("slot_id"), F.col("label").alias("page"), F.col("box").alias("proposal"), F.array(*[F.lit(float(x)) for x in (0, 0, 1654, 2338)]).alias("domain"), F.lit(None).cast("array<double>").alias("stem"), F.lit("fill").alias("kind"), F.lit(False).alias("multi_line"), F.lit(False).alias("broad_hint"))
    return candidates.scored_candidates(slots, blocks).select("slot_id", "page", "block_ord", "score", "eligible")


@query("""
    SELECT user_id, event_id, round(epoch_us(ts) / 1e6 - epoch_us(prev) / 1e6, 3) AS seconds FROM (SELECT *, lag(ts) OVER w AS prev, lag(event_type) OVER w AS kind FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) WHERE kind = 'view' AND event_type <> 'view'
""")
def q58_phase_seconds(t):
    w = W.partitionBy("user_id").orderBy("ts", "event_id")
    rows = t("events").withColumn("at", F.col("ts")).withColumn("n", F.row_number().over(w))
    return windows.phase_seconds(rows, ["user_id"], "at", F.col("event_type") == "view").select("user_id", "event_id", F.round("seconds", 3).alias("seconds"))
