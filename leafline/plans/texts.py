"""Queries of text, number and box functions with their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from leafline.functions import boxes, parsing, text
from leafline.plans.registry import long, pick, pick_sql, query

FORMULAS = ["$x + 1$", "\\left( a − b \\right)", " （３） ", None, "\\frac{1}{2} = x", "a  b", "\\left[ $y$ \\right]"]


@query(f"""
    WITH v AS (SELECT p_partkey, p_size % 2 = 0 AS f, translate(regexp_replace(coalesce({pick_sql('p_partkey', FORMULAS)}, ''), '\\s+', '', 'g'), '−（）', '-()') AS c FROM part)
    SELECT p_partkey, c AS compact, CASE WHEN f THEN replace(replace(replace(c, '$', ''), '\\left', ''), '\\right', '') ELSE c END AS comparable FROM v
""")
def q60_comparison_value(t):
    v = pick(F.col("p_partkey"), FORMULAS)
    return t("part").select("p_partkey", text.compact(v).alias("compact"), text.comparable(v, F.col("p_size") % 2 == 0).alias("comparable"))


KEYS = ["Ａｂ１－２", "Straße 7", "\\frac{a}{b} × 3", "q12 (a)", "Q3_b", "3.0 ÷ 2；", "日本 語。", None, "ok—fine", "  "]


@query(f"""
    WITH v AS (SELECT p_partkey, coalesce({pick_sql('p_partkey', KEYS)}, '') || p_brand AS v FROM part), n AS (SELECT *, translate(v, 'Ａｂ１－２；', 'Ab1-2;') AS k FROM v)
    SELECT p_partkey, lower(regexp_replace(replace(k, '×', 'x'), '[^\\p{{L}}\\p{{N}}]+', '', 'g')) AS folded, replace(lower(regexp_replace(k, '[^\\p{{L}}\\p{{N}}]+', '', 'g')), 'ß', 'ss') AS casefolded,
           lower(regexp_replace(regexp_replace(k, '\\\\(frac|sqrt|left|right|mathrm|text|square)', '', 'g'), '[^\\p{{L}}\\p{{N}}]+', '', 'g')) AS formula_key,
           regexp_replace(regexp_replace(lower(regexp_replace(v, '[^0-9A-Za-z]+', '', 'g')), '^q([0-9])', '\\1'), '^$', '') AS ascii_key, lower(regexp_replace(v, '[^\\p{{L}}\\p{{N}}]+', '', 'g')) AS letters,
           lower(regexp_replace(regexp_replace(translate(regexp_replace(v, '\\s+', '', 'g'), '×÷−–—', '*/---'), '\\.0+\\b', '', 'g'), '[,.;:，。；：、]', '', 'g')) AS answer_key
    FROM n
""")
def q61_comparison_keys(t):
    v = F.concat(F.coalesce(pick(F.col("p_partkey"), KEYS), F.lit("")), "p_brand")
    made = {"folded": text.folded(v), "casefolded": text.casefolded(v), "formula_key": text.formula_key(v), "ascii_key": text.ascii_key(v), "letters": text.letters(v), "answer_key": text.answer_key(v)}
    return t("part").select("p_partkey", *[c.alias(n) for n, c in made.items()])


CHOICES = ["A", "b.", "(C)", "a,c", "［D］", "√", "Tick", "AB", "hello A world", "A. yes B. no", "答案：C", "", None, "（e）", "A、B/C", "x", "I choose B", "C) because"]
_SEEN = "list_distinct(list_transform({}, lambda x: upper(x)))"


@query(f"""
    WITH v AS (SELECT o_orderkey, o_orderkey % 3 AS s, trim(coalesce({pick_sql('o_orderkey', CHOICES)}, '')) AS r, {pick_sql('o_orderkey', CHOICES)} AS raw FROM orders),
    c AS (SELECT *, translate(regexp_replace(coalesce(raw, ''), '\\s+', '', 'g'), '−（）［］', '-()[]') AS t FROM v),
    f AS (SELECT *, regexp_extract_all(r, '(?i)\\b([A-H])\\b', 1) AS a, regexp_extract_all(r, '(?i)([A-H])[.、)）]', 1) AS b, regexp_extract_all(r, '(?i)([A-H])', 1) AS d FROM c),
    g AS (SELECT *, CASE WHEN len(a) > 0 THEN {_SEEN.format('a')} WHEN len(b) > 0 THEN {_SEEN.format('b')} ELSE {_SEEN.format('d')} END AS seen FROM f),
    h AS (SELECT *, CASE WHEN lower(r) IN ('✓', '✔', '√', '☑', '勾', 'check', 'tick') THEN '✓' WHEN len(seen) = 1 THEN seen[1] END AS found FROM g)
    SELECT o_orderkey, CASE WHEN lower(t) IN ('✓', '✔', '√', '☑', '勾', 'check', 'tick') THEN '✓' WHEN regexp_matches(t, '^[(\\[]?[A-Ha-h][)\\]]?[.。、]?$') THEN upper(regexp_extract(t, '([A-Ha-h])', 1))
               WHEN regexp_matches(t, '^[(\\[]?[A-Ha-h]([,，、/][A-Ha-h])+[)\\]]?$') THEN regexp_replace(upper(t), '[^A-H]', '', 'g') WHEN regexp_matches(t, '^[A-Ha-h]{{2,8}}$') THEN upper(t) ELSE t END AS choice, found,
           CASE WHEN r <> '' THEN CASE WHEN s = 0 THEN found ELSE r END END AS answer, CASE WHEN r = '' THEN 'empty_input' WHEN s = 0 THEN 'choice' ELSE 'verbatim_transcription' END AS method FROM h
""")
def q62_choices(t):
    v = pick(F.col("o_orderkey"), CHOICES)
    answer, method = parsing.parsed_answer(v, F.when(F.col("o_orderkey") % 3 == 0, "choice_mark").otherwise("fill_blank"), F.lit("short"))
    return t("orders").select("o_orderkey", text.choice(v).alias("choice"), text.found_choice(F.coalesce(v, F.lit(""))).alias("found"), answer.alias("answer"), method.alias("method"))


NUMBERS = ["12. question", "（3）sub", "q7_2", "no digits", None, "", "x15", "1234.", "7、八", "3.50", "-4", "（5分）", "( 2.5 分 )", "8:", " 9 "]


@query(f"""
    WITH v AS (SELECT o_orderkey, {pick_sql('o_orderkey', NUMBERS)} AS v FROM orders)
    SELECT o_orderkey, TRY_CAST(nullif(regexp_extract(coalesce(v, ''), '([0-9]+)', 1), '') AS BIGINT) AS digits, TRY_CAST(nullif(regexp_extract(coalesce(v, ''), '(?:^|[^0-9])([0-9]{{1,3}})(?:\\s*[.、．:：)]|$)', 1), '') AS INT) AS in_text,
           TRY_CAST(nullif(regexp_extract(coalesce(v, ''), '(?:^|[^0-9])([0-9]{{1,3}})(?:_|$)', 1), '') AS INT) AS in_id, TRY_CAST(nullif(regexp_extract(coalesce(v, ''), '[（(]\\s*([0-9]+(?:\\.[0-9]+)?)\\s*分\\s*[)）]', 1), '') AS DOUBLE) AS points,
           TRY_CAST(nullif(v, '') AS DOUBLE) AS number, CASE WHEN regexp_matches(trim(v), '^[+-]?[0-9]+$') AND TRY_CAST(v AS INT) > 0 THEN TRY_CAST(v AS INT) END AS positive FROM v
""")
def q63_numbers(t):
    v = pick(F.col("o_orderkey"), NUMBERS)
    return t("orders").select("o_orderkey", text.number_in(v).alias("digits"), parsing.number_in_text(v).alias("in_text"), parsing.number_in_id(v).alias("in_id"), text.score_points(v).alias("points"), parsing.safe_float(v).alias("number"), parsing.positive_int(v).alias("positive"))


KINDS, STEMS = ["single choice", "填空", "composition", None, "other", "True/False judgment"], ["Which? A. one B. two C. three", "The value is ____.", "Explain.", None, "Is it ( )?"]


@query(f"""
    WITH v AS (SELECT p_partkey, lower(coalesce({pick_sql('p_partkey', KINDS)}, '')) AS n, coalesce({pick_sql('p_partkey', STEMS)}, '') || repeat('x', p_size * 10) AS t FROM part)
    SELECT p_partkey, CASE WHEN regexp_matches(n, 'choice|single|judg|选择|判断') THEN 'choice' WHEN regexp_matches(n, 'fill|blank|填空') THEN 'fill' WHEN regexp_matches(n, 'essay|composition|作文') THEN 'essay'
           WHEN len(regexp_extract_all(t, '\\b[A-D][.、)]')) >= 2 THEN 'choice' WHEN regexp_matches(t, '_{{2,}}|（ *）|\\( *\\)') THEN 'fill' WHEN length(t) > 400 THEN 'essay' ELSE 'short' END AS kind FROM v
""")
def q64_item_kinds(t):
    stem = F.concat(F.coalesce(pick(F.col("p_partkey"), STEMS), F.lit("")), F.repeat(F.lit("x"), F.col("p_size") * 10))
    return t("part").select("p_partkey", text.kind(stem, pick(F.col("p_partkey"), KINDS)).alias("kind"))


@query("""
    SELECT page_id, regexp_replace(regexp_replace(coalesce(url, ''), '[^0-9A-Za-z_.-]+', '_', 'g'), '^_+|_+$', '', 'g') AS safe_id, 'data:image/png;base64,' || to_base64(encode(coalesce(html, ''))) AS data_url, coalesce(sha256(html), '') AS fingerprint FROM pages
""")
def q65_ids_and_payloads(t):
    content = F.col("html").cast("binary")
    from leafline.sources.files import page_fingerprint

    return t("pages").select("page_id", text.safe_id(F.col("url")).alias("safe_id"), parsing.data_url(F.coalesce(content, F.lit(b""))).alias("data_url"), page_fingerprint(content).alias("fingerprint"))


BROKEN = ["(a + b) = c", "x^", "\\frac{1}{2}", "\\frac{1}", "a + )", "[1, 2", "rac{3}", "y_{}", "\\tfrac {a} {b} - 3", "frac(1)", "\\(x", "2 × 3 −1", None, "{a}{b", "\\dfrac{x}{}"]


@query(f"""
    WITH v AS (SELECT o_orderkey, trim(coalesce({pick_sql('o_orderkey', BROKEN)}, '')) AS v, o_orderkey % {len(BROKEN)} AS k FROM orders), c AS (SELECT *, translate(regexp_replace(v, '\\s+', '', 'g'), '−（）', '-()') AS c FROM v),
    r AS (SELECT *, list_filter([CASE WHEN k IN (4, 5, 6, 13) THEN 'UNBALANCED_EXPRESSION' END, CASE WHEN regexp_matches(c, '[\\^_]($|\\{{\\}}|[)\\]}}=+*/^_-])') THEN 'INCOMPLETE_SCRIPT' END,
               CASE WHEN len(regexp_extract_all(v, '\\\\(d?frac|tfrac)')) <> len(regexp_extract_all(v, '\\\\(d?frac|tfrac)\\s*\\{{[^{{}}]+\\}}\\s*\\{{[^{{}}]+\\}}')) OR regexp_matches(v, '(^|[^\\\\])frac\\s*[({{]') THEN 'MALFORMED_FRACTION' END,
               CASE WHEN regexp_matches(c, '([=+*/-]|\\\\times|\\\\div)\\s*[)\\]}}]') THEN 'MISSING_OPERAND' END, CASE WHEN regexp_matches(c, '(^|[^A-Za-z])(rac\\}}|xt\\}})') THEN 'MALFORMED_FORMULA' END], lambda x: x IS NOT NULL) AS issues FROM c)
    SELECT o_orderkey, k NOT IN (4, 5, 6, 13) AS balanced, array_to_string(issues, ',') AS issues, length(c) - length(replace(c, '-', '')) AS minus_count, NOT list_contains(issues, 'MALFORMED_FRACTION') AS fractions_complete FROM r
""".replace("k IN (4, 5, 6, 13)", "k IN (4, 5, 13)").replace("k NOT IN (4, 5, 6, 13)", "k NOT IN (4, 5, 13)"))
def q66_formulas(t):
    rows = t("orders").select("o_orderkey", F.coalesce(pick(F.col("o_orderkey"), BROKEN), F.lit("")).alias("v"))
    rows = rows.withColumn("issues", parsing.formula_issues(F.col("v")))
    s = parsing.formula_signature(F.col("v"), F.col("issues"))
    return rows.select("o_orderkey", text.balanced("v").alias("balanced"), F.array_join("issues", ",").alias("issues"), long(s["minus_count"]).alias("minus_count"), s["fractions_complete"].alias("fractions_complete"))


@query("""
    SELECT p_partkey, coalesce(lower(regexp_replace(p_type, '\\s+', '', 'g')) = 'economy', false) AND p_size % 3 <> 0 AS equal FROM part
""".replace("lower(regexp_replace(p_type, '\\s+', '', 'g')) = 'economy'", "p_type = 'ECONOMY'"))
def q67_equal_answers(t):
    given = F.array(F.concat(F.lit(" "), "p_type"), F.when(F.col("p_size") % 3 != 0, F.lit("（x）")))
    return t("part").select("p_partkey", text.equal_answers(given, F.array(F.lit("ECONOMY"), F.lit("(x)"))).alias("equal"))


FORMS = ["填 ____ 和 ____。", "“a”：“b”是 x", "name: age: city:", "( ) [ ] （ ）", "none", "…… ....", None, "x = 1"]
ANSWERS = ["a；b；c", "one", None, "x；", "；"]


@query(f"""
    WITH v AS (SELECT o_orderkey, o_orderkey % 5 AS e, ['fill', 'choice', 'essay', 'short'][o_orderkey % 4 + 1] AS k, {pick_sql('o_orderkey // 4', ANSWERS)} AS a, coalesce({pick_sql('o_orderkey // 20', FORMS)}, '') AS t FROM orders),
    n AS (SELECT *, greatest(len(regexp_extract_all(t, '[“"‘''][^”"’''\\n]{{1,24}}[”"’'']\\s*([:：=]|(?i:is)\\b|是)')), len(regexp_extract_all(replace(t, '==', ''), '(?m)(^|[\\s,，;；])[^\\s,，;；:：=]{{1,12}}\\s*[:：=]')), len(regexp_extract_all(t, '_{{2,}}|\\.{{4,}}|…{{2,}}|[(（\\[]\\s*[_·.\\s]*[)）\\]]'))) AS c,
              CASE WHEN a IS NOT NULL THEN CASE WHEN k = 'fill' THEN greatest(1, len(string_split(a, '；'))) ELSE 1 END END AS g FROM v)
    SELECT o_orderkey, CASE WHEN c >= 2 THEN c END::INT AS anchors, CASE WHEN e > 3 THEN e WHEN k = 'essay' THEN 1 WHEN k = 'choice' THEN 1 WHEN g > 0 THEN g WHEN c >= 2 THEN c END::INT AS n,
           CASE WHEN e > 3 THEN 'vlm' WHEN k = 'essay' THEN 'logical_free_response' WHEN k = 'choice' THEN 'logical_choice_response' WHEN g > 0 THEN 'teacher_standard_answer' WHEN c >= 2 THEN 'anonymous_layout_anchor' END AS source FROM n
""")
def q68_slot_counts(t):
    n = F.col("o_orderkey")
    stem, answer = pick(F.floor(n / 20), FORMS), pick(F.floor(n / 4), ANSWERS)
    count, source = parsing.slot_count(F.when(n % 5 > 3, (n % 5).cast("int")), F.element_at(F.array(*[F.lit(x) for x in ("fill", "choice", "essay", "short")]), (n % 4 + 1).cast("int")), answer, stem)
    return t("orders").select("o_orderkey", parsing.anchor_count(stem).alias("anchors"), count.cast("int").alias("n"), source.alias("source"))


ONE_CUE = ["In the year ____ it was founded.", "The capital of France is ( ).", "no cue at all", "…… at the start", None]


@query(f"""
    WITH v AS (SELECT p_partkey, trim(coalesce({pick_sql('p_partkey', ONE_CUE)}, '') || ' ' || repeat(p_name || ' ', 5)) AS r FROM part), m AS (SELECT *, regexp_extract(r, '(_{{2,}}|\\.{{3,}}|…{{2,}}|（\\s*）|\\(\\s*\\)|\\[\\s*\\])', 1) AS cue FROM v)
    SELECT p_partkey, CASE WHEN cue = '' THEN right(r, 96) ELSE trim(right(split_part(r, cue, 1), 48)) END AS before, CASE WHEN cue = '' THEN '' ELSE trim(left(substr(r, strpos(r, cue) + length(cue)), 48)) END AS after FROM m
""")
def q69_answer_contexts(t):
    v = F.concat(F.coalesce(pick(F.col("p_partkey"), ONE_CUE), F.lit("")), F.lit(" "), F.repeat(F.concat("p_name", F.lit(" ")), 5))
    found = F.get(parsing.answer_contexts(v, F.lit(1)), F.lit(0))
    return t("part").select("p_partkey", found["before"].alias("before"), found["after"].alias("after"))


JSONS = ['{"1": "a", "(2)": "b"}', '["x", "y"]', "plain", '{"（3）": "c"}', "[]", None]


@query(f"""
    WITH v AS (SELECT o_orderkey, o_orderkey % 3 + 1 AS m, {pick_sql('o_orderkey // 3', JSONS)} AS a FROM orders)
    SELECT o_orderkey, CASE left(a, 1) WHEN '{{' THEN coalesce(json_extract_string(a, '$."' || m || '"'), json_extract_string(a, '$."(' || m || ')"'), json_extract_string(a, '$."（' || m || '）"'))
           WHEN '[' THEN json_extract_string(a, '$[' || (m - 1) || ']') ELSE CASE WHEN m = 1 THEN a END END AS part FROM v
""")
def q70_answer_for_marker(t):
    return t("orders").select("o_orderkey", parsing.answer_for_marker(pick(F.floor(F.col("o_orderkey") / 3), JSONS), F.col("o_orderkey") % 3 + 1).alias("part"))


@query("""
    SELECT event_id, 'sha256:' || sha256('{"a":"é","k":' || json_extract_string(props, '$.k') || '}') AS fingerprint, '{"k": ' || json_extract_string(props, '$.k') || '}' AS stripped, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS at FROM events
""")
def q71_canonical_json(t):
    k = F.get_json_object("props", "$.k")
    tree = F.concat(F.lit('{"k": '), k, F.lit(', "state": "x", "a": "é", "created_at": 5}'))
    boxed = F.concat(F.lit('{"k": '), k, F.lit(', "answer_bbox": [1, 2], "roi": {"x": 1}}'))
    named = F.array(F.lit("bbox"), F.lit("roi"))
    return t("events").select("event_id", parsing.canonical_hash(tree).alias("fingerprint"), parsing.without_geometry(boxed, named).alias("stripped"), F.substring(parsing.timestamp_text(F.col("ts")), 1, 19).alias("at"))


TEXTS = ["3. 答：42", "证明：因为 a", "解: x", "二、 ok", "", None, "答"]


@query(f"""
    WITH v AS (SELECT p_partkey, p_name, {pick_sql('p_partkey', TEXTS)} AS v FROM part), n AS (SELECT *, regexp_replace(v, '^[0-9一二三四五六七八九十]+[.、．）)]', '') AS n FROM v)
    SELECT p_partkey, nullif(trim(regexp_replace(regexp_replace(n, '答[:：]?', '', 'g'), '解[:：]?', '', 'g')), '') AS fill, nullif(trim(regexp_replace(n, '^(答|解|证明|证)[:：]?', '')), '') AS essay, coalesce(regexp_matches(v, '^\\s*[A-Ha-h]\\s*[.、．:：)）]'), false) AS option,
           p_name AS kept FROM n
""")
def q72_clean_answers(t):
    v = pick(F.col("p_partkey"), TEXTS)
    stem = F.lit("the whole text of a printed question")
    return t("part").select("p_partkey", parsing.fill_answer(v).alias("fill"), parsing.essay_answer(v).alias("essay"), parsing.printed_option(v).alias("option"), parsing.without_fragment(F.concat("p_name", stem), stem).alias("kept"))


@query("""
    WITH p AS (SELECT p_partkey, lower(regexp_replace(p_name, '[^A-Za-z0-9]+', '', 'g')) AS n FROM part)
    SELECT p_partkey, length(n) >= 3 AND (contains('smallwidgetsareprinted', n) OR n = 'coldwidget') AS printed FROM p
""")
def q73_printed_text(t):
    references = F.array(F.lit("smallwidgetsareprinted"), F.lit("coldwidget"))
    rows = t("part").select("p_partkey", text.casefolded("p_name").alias("n"))
    exact = F.col("n").isin("coldwidget") | F.contains(F.lit("smallwidgetsareprinted"), F.col("n"))
    near = parsing.resembles_print("n", references)
    return rows.select("p_partkey", (near & exact).alias("printed"))


_BOX = """
    WITH v AS (SELECT vec_id, label, floor(abs(embedding[1]::DOUBLE) * 1000000) / 1000 AS x1, floor(abs(embedding[2]::DOUBLE) * 1000000) / 1000 AS y1, floor(abs(embedding[3]::DOUBLE) * 1000000) / 1000 AS w, floor(abs(embedding[4]::DOUBLE) * 1000000) / 1000 AS h FROM embeddings),
    b AS (SELECT *, x1 + w + 1 AS x2, y1 + h + 1 AS y2 FROM v)
"""


def vector_boxes(t):
    """A box from the first four numbers of each vector, on a page of 1000."""
    v = [F.floor(F.abs(F.get("embedding", F.lit(i)).cast("double")) * 1000000) / 1000 for i in range(4)]
    return t("embeddings").select("vec_id", "label", F.array(v[0], v[1], v[0] + v[2] + 1, v[1] + v[3] + 1).alias("box"))


@query(_BOX + """
    , i AS (SELECT *, greatest(0, least(x2, 200) - greatest(x1, 50)) * greatest(0, least(y2, 150) - greatest(y1, 20)) AS c, (x2 - x1) * (y2 - y1) AS a FROM b)
    SELECT vec_id, round(c / greatest(1, a), 6) AS containment, round(c / greatest(1, least(a, 150 * 130)), 6) AS of_smaller, round((y1 + y2) / 2, 6) AS center_y, round(greatest(0, least(y2, 150) - greatest(y1, 20)) / greatest(1, least(y2 - y1, 130)), 6) AS vertical,
           c / greatest(1, a) >= 0.5 OR ((x1 + x2) / 2 BETWEEN 50 AND 200 AND (y1 + y2) / 2 BETWEEN 20 AND 150) AS inside FROM i
""")
def q74_box_relations(t):
    b, o = F.col("box"), F.array(*[F.lit(float(x)) for x in (50, 20, 200, 150)])
    return vector_boxes(t).select("vec_id", F.round(boxes.containment(b, o), 6).alias("containment"), F.round(boxes.overlap_of_smaller(b, o), 6).alias("of_smaller"), F.round(boxes.center_y(b), 6).alias("center_y"), F.round(boxes.shared_height(b, o), 6).alias("vertical"), boxes.in_region(b, o).alias("inside"))


@query(_BOX + """
    SELECT vec_id, round_even(x1 * (1654 / 1000.0::DOUBLE), 0) AS sx1, round_even(y2 * (2338 / 1000.0::DOUBLE), 0) AS sy2, y1 AS ty1, x1 AS tx1, round(x1 + greatest(-80, least(80, w - 100)), 6) AS mx1, round(y2 + greatest(-80, least(80, h - 150)) + greatest(-80, least(80, 2 * h - 150)), 6) AS my2 FROM b
""")
def q75_scaled_boxes(t):
    b, one = F.col("box"), F.lit(1000.0)
    s, tr = boxes.scaled(b, (one, one), (F.lit(1654.0), F.lit(2338.0))), boxes.transposed(b)
    w, h = F.get(b, F.lit(2)) - F.get(b, F.lit(0)) - 1, F.get(b, F.lit(3)) - F.get(b, F.lit(1)) - 1
    m = boxes.shifted(b, w - 100, h - 150, F.lit(0.0), 2 * h - 150)
    at = lambda c, i: F.get(c, F.lit(i))
    return vector_boxes(t).select("vec_id", at(s, 0).alias("sx1"), at(s, 3).alias("sy2"), at(tr, 0).alias("ty1"), at(tr, 1).alias("tx1"), F.round(at(m, 0), 6).alias("mx1"), F.round(at(m, 3), 6).alias("my2"))


@query(_BOX + """
    , p AS (SELECT *, x2 - x1 AS bw, y2 - y1 AS bh, vec_id % 5 AS k FROM b)
    SELECT vec_id, array_to_string(list_filter([CASE WHEN k = 0 THEN 'INVALID_BOX' END, CASE WHEN k = 1 THEN 'WRONG_PAGE' END, CASE WHEN k <> 0 AND bw * bh / (200.0 * 200) > 0.6 THEN 'TOO_LARGE' END, CASE WHEN k <> 0 AND (x2 > 200 OR y2 > 200) THEN 'OUT_OF_BOUNDS' END], lambda x: x IS NOT NULL), ',') AS region,
           array_to_string(list_filter([CASE WHEN bw > 200 * CASE vec_id % 4 WHEN 0 THEN 0.35 WHEN 1 THEN 0.58 WHEN 2 THEN 0.94 ELSE 0.82 END THEN 'TOO_WIDE' END, CASE WHEN bw * bh > 40000 * CASE vec_id % 4 WHEN 0 THEN 0.1 WHEN 1 THEN 0.2 WHEN 2 THEN 0.68 ELSE 0.45 END THEN 'TOO_LARGE' END], lambda x: x IS NOT NULL), ',') AS slot,
           bw * bh / 40000 > 0.6 OR (bw / 200 > 0.9 AND bh / 200 > 0.4) AS too_broad FROM p
""")
def q76_box_gates(t):
    k, side = F.col("vec_id") % 5, F.lit(200.0)
    b = F.when(k == 0, F.array(F.lit(3.0), F.lit(3.0), F.lit(1.0), F.lit(9.0))).otherwise(F.col("box"))
    region = boxes.region_reasons(b, F.when(k == 1, "p2").otherwise("p1"), F.lit("p1"), side, side)
    kind = F.element_at(F.array(*[F.lit(x) for x in ("choice", "fill", "large", "short")]), (F.col("vec_id") % 4 + 1).cast("int"))
    return vector_boxes(t).select("vec_id", F.array_join(region, ",").alias("region"), F.array_join(boxes.slot_reasons(F.col("box"), kind, side, side), ",").alias("slot"), boxes.too_broad(F.col("box"), side, side).alias("too_broad"))


@query(_BOX + """
    , r AS (SELECT vec_id, floor(x1) AS x1, floor(y1) AS y1, floor(x2) AS x2, floor(y2) AS y2 FROM b)
    SELECT vec_id, i::INT AS part, x1, round(y1 + i * (least(y2, 150) - y1) / 3, 2) AS y1, x2, CASE WHEN i = 2 THEN round(least(y2, 150), 2) ELSE round(y1 + (i + 1) * (least(y2, 150) - y1) / 3, 2) END AS y2 FROM r, (SELECT unnest(range(3)) AS i) WHERE least(y2, 150) > y1
""")
def q77_split_regions(t):
    rows = vector_boxes(t).select("vec_id", F.posexplode(boxes.split_down(F.transform("box", lambda v: F.floor(v).cast("double")), 3, F.lit(150.0))).alias("part", "p"))
    return rows.select("vec_id", "part", *[F.get("p", F.lit(i)).alias(n) for i, n in enumerate(("x1", "y1", "x2", "y2"))])


@query(_BOX + "SELECT label, min(x1) AS x1, min(y1) AS y1, max(x2) AS x2, max(y2) AS y2, sort_[len(sort_) // 2 + 1] AS upper_median, median(x2) AS median FROM (SELECT *, list_sort(list(x2) OVER (PARTITION BY label)) AS sort_ FROM b) GROUP BY label, sort_")
def q78_union_and_medians(t):
    rows = vector_boxes(t).withColumn("w", F.get(F.col("box"), F.lit(2)))
    out = rows.groupBy("label").agg(boxes.union_all(F.col("box")).alias("u"), boxes.upper_median(F.col("w")).alias("upper_median"), F.median("w").alias("median"))
    return out.select("label", *[F.get("u", F.lit(i)).alias(n) for i, n in enumerate(("x1", "y1", "x2", "y2"))], "upper_median", "median")


@query(_BOX + """
    , g AS (SELECT *, (x2 - x1) * (y2 - y1) AS a, x2 - x1 AS bw, y2 - y1 AS bh, vec_id % 2 = 0 AS choice, greatest(0, least(x2, 100) - greatest(x1, 40)) * greatest(0, least(y2, 90) - greatest(y1, 30)) AS s, greatest(0, least(x2, 300) - greatest(x1, 150)) * greatest(0, least(y2, 300) - greatest(y1, 100)) AS d FROM b)
    SELECT vec_id, CASE WHEN x2 > 400 OR y2 > 400 THEN 'invalid_or_out_of_bounds' ELSE array_to_string(list_filter([CASE WHEN a / 160000 > CASE WHEN choice THEN 0.035 ELSE 0.12 END THEN 'box_area_too_large' END, CASE WHEN choice AND (bw > 0.22 * 400 OR bh > 0.12 * 400) THEN 'choice_box_not_local' END,
           CASE WHEN NOT choice AND bh > 0.32 * 400 THEN 'answer_box_too_tall' END, CASE WHEN NOT ((x1 + x2) / 2 BETWEEN 0 AND 250 AND (y1 + y2) / 2 BETWEEN 10 AND 350) THEN 'outside_question_corridor' END, CASE WHEN s / 3600 > 0.62 THEN 'covers_printed_stem' END,
           CASE WHEN s / 3600 > 0.45 THEN 'crosses_other_question_stem' END, CASE WHEN d / a >= 0.3 THEN 'overlaps_diagram_mask' END, CASE WHEN s / least(a, 3600) >= 0.55 THEN 'duplicates_sibling_slot' END], lambda x: x IS NOT NULL), ',') END AS reasons FROM g
""")
def q79_hard_gate(t):
    fixed = lambda *x: F.array(*[F.lit(float(v)) for v in x])
    stem, side = fixed(40, 30, 100, 90), F.lit(400.0)
    reasons = boxes.hard_gate(F.col("box"), F.when(F.col("vec_id") % 2 == 0, "choice").otherwise("fill"), side, side, fixed(0, 10, 250, 350), stem, F.array(stem), F.array(fixed(150, 100, 300, 300)), F.array(stem))
    return vector_boxes(t).select("vec_id", F.array_join(reasons, ",").alias("reasons"))
