"""Queries of ink as runs, merged boxes and clusters of boxes, with their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from leafline.operators import assignment, candidates, ink
from leafline.plans.registry import query


def _runs(t):
    """Events as runs of ink: a page for each kind, a sheet for each fifth user, fifty lines."""
    x0 = F.floor("value").cast("int")
    return t("events").select(F.col("event_type").alias("page"), (F.col("user_id") % 5).alias("sheet"), (F.col("event_id") % 50).alias("y"), x0.alias("x0"), (x0 + F.col("event_id") % 17).alias("x1"))


_PIXELS = """
    r AS (SELECT event_type AS page, user_id % 5 AS sheet, event_id % 50 AS y, floor(value)::INT AS x0, floor(value)::INT + event_id % 17 AS x1 FROM events),
    p AS (SELECT DISTINCT page, sheet, y, unnest(range(x0, x1)) AS x FROM r)
"""


@query(f"""
    WITH {_PIXELS}, n AS (SELECT page, count(DISTINCT sheet) AS n FROM r GROUP BY 1), v AS (SELECT page, y, x, count(*) AS votes FROM p GROUP BY ALL),
    i AS (SELECT *, x - row_number() OVER (PARTITION BY page, y, votes ORDER BY x) AS island FROM v)
    SELECT page, y, min(x) AS x0, max(x) + 1 AS x1, votes, votes >= greatest(2, ceil(any_value(n) * 0.7)) AS stable FROM i JOIN n USING (page) GROUP BY page, y, votes, island
""")
def q134_voted_runs(t):
    """Votes of the sheets of a page by stretches of a line; the SQL counts pixel by pixel."""
    runs = _runs(t)
    sheets = runs.groupBy("page").agg(F.countDistinct("sheet").alias("n"))
    return ink.voted(runs, sheets, ["page"])


@query(f"""
    WITH {_PIXELS}, n AS (SELECT page, count(DISTINCT sheet) AS n FROM r GROUP BY 1),
    s AS (SELECT page, y, x FROM p JOIN n USING (page) GROUP BY page, y, x HAVING count(*) >= greatest(2, ceil(any_value(n) * 0.7))),
    w AS (SELECT p.* FROM p ANTI JOIN s USING (page, y, x)), i AS (SELECT *, x - row_number() OVER (PARTITION BY page, sheet, y ORDER BY x) AS island FROM w)
    SELECT page, sheet, y, min(x) AS x0, max(x) + 1 AS x1 FROM i GROUP BY page, sheet, y, island
""")
def q135_writing_runs(t):
    """What each sheet has beyond the ink that most sheets of its page share."""
    runs = _runs(t)
    sheets = runs.groupBy("page").agg(F.countDistinct("sheet").alias("n"))
    printed = ink.voted(runs, sheets, ["page"]).filter("stable").select("page", "y", "x0", "x1")
    return ink.without(runs, printed, ["page", "y"], ["sheet"])


@query("""
    WITH RECURSIVE b AS (SELECT label, vec_id, abs(embedding[1]::DOUBLE) * 300 AS x1, abs(embedding[2]::DOUBLE) * 300 AS y1, abs(embedding[1]::DOUBLE) * 300 + 200 AS x2, abs(embedding[2]::DOUBLE) * 300 + 60 AS y2 FROM embeddings),
    o AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY y1, x1, vec_id) AS k FROM b),
    walk AS (
        SELECT label, k, 1 AS n, x1, y1, x2, y2 FROM o WHERE k = 1
        UNION ALL
        SELECT label, k, CASE WHEN hit THEN n ELSE n + 1 END, CASE WHEN hit THEN least(w1, x1) ELSE x1 END, CASE WHEN hit THEN least(w2, y1) ELSE y1 END, CASE WHEN hit THEN greatest(w3, x2) ELSE x2 END, CASE WHEN hit THEN greatest(w4, y2) ELSE y2 END
        FROM (SELECT *, c / greatest(1, (w3 - w1) * (w4 - w2) + (x2 - x1) * (y2 - y1) - c) > 0.3 AS hit
              FROM (SELECT o.label, o.k, w.n, w.x1 AS w1, w.y1 AS w2, w.x2 AS w3, w.y2 AS w4, o.x1, o.y1, o.x2, o.y2, greatest(0, least(w.x2, o.x2) - greatest(w.x1, o.x1)) * greatest(0, least(w.y2, o.y2) - greatest(w.y1, o.y1)) AS c
                    FROM walk w JOIN o ON o.label = w.label AND o.k = w.k + 1))),
    g AS (SELECT label, n, max_by({'x': x1, 'y': y1, 'u': x2, 'v': y2}, k) AS z FROM walk GROUP BY 1, 2)
    SELECT label, n::INT AS place, round(z.x, 4) AS x1, round(z.y, 4) AS y1, round(z.u, 4) AS x2, round(z.v, 4) AS y2 FROM g
""")
def q136_merged_boxes(t):
    at = lambda i: F.abs(F.get("embedding", F.lit(i)).cast("double")) * 300
    rows = t("embeddings").select("label", "vec_id", F.array(at(0), at(1), at(0) + 200, at(1) + 60).alias("box"))
    out = assignment.merged(rows, ["label"], "box", ["vec_id"])
    side = lambda i, n: F.round(F.get("box", F.lit(i)), 4).alias(n)
    return out.select("label", "place", side(0, "x1"), side(1, "y1"), side(2, "x2"), side(3, "y2"))


@query()
def q137_best_clusters(t):
    """Embeddings as blocks; those of a label are the candidates of one slot, whose best cluster of neighbouring boxes is wanted."""
    at = lambda i: F.abs(F.get("embedding", F.lit(i)).cast("double"))
    box = F.array(at(0) * 1600, at(1) * 2200, at(0) * 1600 + 120, at(1) * 2200 + 30)
    proposal = F.array(*[F.lit(float(x)) for x in (100, 100, 500, 300)])
    rows = t("embeddings").select(F.concat(F.lit("s"), F.col("label") * 100 + F.col("vec_id") % 20).alias("slot_id"), F.col("vec_id").cast("int").alias("block_ord"), box.alias("block_box"), at(2).alias("score"), (F.col("vec_id") % 3 != 0).alias("eligible"), proposal.alias("proposal"))
    return candidates.best_clusters(rows, 30.0).select("slot_id", "score", F.size("block_ords").alias("n_blocks"))
