"""Answer candidates: recognised blocks scored against a proposed place, clustered into writing, and voted on by a cohort."""

from __future__ import annotations

import re
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafline.functions import boxes

#: What marks a place to answer at; what is a numbering mark alone.
CUE = re.compile(r"_{2,}|\.{3,}|…{2,}|（\s*）|\(\s*\)|\[\s*\]")
MARKER = r"^\s*(?:第\s*\d+\s*[题问]?|\d+\s*[.、。．:：)）]|[A-Ha-h]\s*[.、．)])\s*$"
OPTION = r"^\s*[A-H]\s*[.、．)]"
#: Parts of a cell's slots, so that a full cell is the work of several tasks.
PARTS = 8


def scored_candidates(slots: DataFrame, blocks: DataFrame, cell: float = 250.0) -> DataFrame:
    """Blocks that may be a slot's answer, with `score`, `rejection_reasons` and `eligible`.

    slots: (slot_id, page, proposal, domain, stem, kind, multi_line, broad_hint), boxes in the same page;
    blocks: (page, block_ord, block_box, text, confidence, printed, foreign_printed, excluded) with excluded the share of the
    block in known print, and optionally `merged`: one whose print and answer were read again apart. A block is looked at if 15 % of it lies in the proposal widened by its own size, 40 % and its centre
    in the domain, and its centre or 8 % in the proposal. Such a block touches the proposal itself, so both meet in the
    cells of a grid of size `cell`, each pair in its smallest shared cell only.
    """
    b, p, d, stem = F.col("block_box"), F.col("proposal"), F.col("domain"), F.col("stem")
    numbers = lambda name, box: {f"{name}{i}_": F.get(box, F.lit(i)) for i in range(4)}
    at = lambda name, i: F.col(f"{name}{i}_")
    blocks = blocks if "merged" in blocks.columns else blocks.withColumn("merged", F.lit(False))
    # what one side alone decides is made before the pairs, whose code has to stay small enough to be compiled
    placed = slots.filter((F.size(p) == 4) & (F.size(d) == 4)).withColumns(numbers("p", p) | numbers("d", d) | numbers("s", F.when(F.size(stem) == 4, stem)) | {"has_stem_": stem.isNotNull(), "diagonal_": F.greatest(F.lit(1.0), F.sqrt(F.pow(boxes.width(p), 2) + F.pow(boxes.height(p), 2))), "d_width_": F.greatest(F.lit(1.0), boxes.width(d))})
    search = F.array(at("p", 0) - boxes.width(p), at("p", 1) - boxes.height(p), at("p", 2) + boxes.width(p), at("p", 3) + boxes.height(p))
    placed = placed.withColumns(numbers("w", search) | {"stem_y_": (F.get(stem, F.lit(1)) + F.get(stem, F.lit(3))) / 2 - 0.60 * F.greatest(F.lit(1.0), boxes.height(stem))})
    placed = placed.withColumn("cell_", F.explode(boxes.cells(p, cell))).withColumn("part_", F.pmod(F.xxhash64("slot_id"), F.lit(PARTS))).drop("proposal", "domain", "stem")
    met = blocks.filter(F.size(b) == 4).withColumns(numbers("b", b) | {"area_": F.greatest(F.lit(1.0), boxes.area(b)), "b_width_": boxes.width(b), "marker_": F.col("text").rlike(MARKER), "option_": F.col("text").rlike(OPTION)})
    met = met.withColumn("cell_", F.explode(boxes.cells(b, cell))).withColumn("part_", F.explode(F.array(*[F.lit(i).cast("bigint") for i in range(PARTS)])))
    # as many tasks as set, whatever their bytes: pairs cost more than rows
    keys, tasks = ["page", "cell_", "part_"], int(slots.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = placed.repartition(tasks, *keys).join(met.repartition(tasks, *keys), keys)
    first = lambda i: F.floor(F.greatest(at("p", i), at("b", i)) / cell)
    rows = rows.filter((at("b", 0) <= at("p", 2)) & (at("p", 0) <= at("b", 2)) & (at("b", 1) <= at("p", 3)) & (at("p", 1) <= at("b", 3)) & (F.col("cell_.cx") == first(0)) & (F.col("cell_.cy") == first(1)))
    cx, cy = (at("b", 0) + at("b", 2)) / 2, (at("b", 1) + at("b", 3)) / 2
    px, py = (at("p", 0) + at("p", 2)) / 2, (at("p", 1) + at("p", 3)) / 2
    shared = lambda o, i: F.greatest(F.lit(0.0), F.least(at("b", i + 2), at(o, i + 2)) - F.greatest(at("b", i), at(o, i)))
    share = lambda o: shared(o, 0) * shared(o, 1) / F.col("area_")
    inside = cx.between(at("p", 0), at("p", 2)) & cy.between(at("p", 1), at("p", 3))
    rows = rows.withColumn("in_proposal", share("p")).withColumn("in_domain", share("d")).withColumn("inside", inside)
    rows = rows.filter((share("w") >= 0.15) & (F.col("in_domain") >= 0.40) & cx.between(at("d", 0), at("d", 2)) & cy.between(at("d", 1), at("d", 3)) & (F.col("inside") | (F.col("in_proposal") >= 0.08)))
    rows = rows.withColumn("in_stem", F.when(at("s", 0).isNotNull(), share("s")).otherwise(0.0)).withColumn("distance", F.sqrt(F.pow(cx - px, 2) + F.pow(cy - py, 2)) / F.col("diagonal_"))
    marker, option, wide = F.col("marker_"), F.col("option_"), F.col("b_width_") / F.col("d_width_")
    faults = [
        (marker, "STRUCTURAL_MARKER"), (F.col("foreign_printed"), "OTHER_ITEM_PRINTED_TEXT"), (option & ~F.contains("kind", F.lit("choice")), "PRINTED_OPTION_FOR_OTHER_ITEM"),
        (F.col("has_stem_") & ~F.col("multi_line") & (cy < F.col("stem_y_")), "BEFORE_ITEM_READING_ANCHOR"), ((wide > 0.70) & (F.col("in_proposal") < 0.35), "LONG_LINE_PARTIAL_INTERSECTION"),
        (~F.col("multi_line") & (F.col("in_stem") >= 0.60) & (F.col("printed") | (wide > 0.65)), "PRINTED_STEM_OVERLAP"), (F.col("excluded") >= 0.15, "PRINTED_EXCLUSION_OVERLAP"),
        (F.coalesce(F.col("merged"), F.lit(False)), "MERGED_PRINTED_AND_ANSWER_OCR_BOX"),
    ]
    reasons = F.array_compact(F.array(*[F.when(met, name) for met, name in faults]))
    # told without the list, which costs more than all else of a pair and is made only where it is asked for
    eligible = reduce(lambda a, c: a & c, [~F.coalesce(met, F.lit(False)) for met, _ in faults])
    unit = lambda c: F.greatest(F.lit(0.0), F.least(F.lit(1.0), c))
    minus = lambda c, w: F.when(c, w).otherwise(0.0)
    score = (
        F.when(F.col("broad_hint"), 0.18).otherwise(0.50) * F.least(F.lit(1.0), F.col("in_proposal")) + 0.22 * F.greatest(F.lit(0.0), 1 - F.col("distance")) + 0.18 * unit(F.coalesce("confidence", F.lit(0.55)))
        + minus(F.col("inside"), 0.10) + F.when(~F.col("multi_line"), 0.10 * unit((cx - at("d", 0)) / F.col("d_width_"))).otherwise(0.0)
        - minus(F.col("printed"), 0.22) - minus(F.col("foreign_printed"), 0.28) - minus(option, 0.24) - minus(marker, 0.30) - minus(F.col("excluded") >= 0.72, 0.24)
    )
    return rows.select("slot_id", "page", "block_ord", "block_box", "text", F.round(score, 4).alias("score"), reasons.alias("rejection_reasons"), eligible.alias("eligible"))


def _gaps(a: list[float], b: list[float]) -> tuple[float, float, float, float]:
    """Gaps across and down, and shared width and height as shares of the smaller box's."""
    shared = [max(0.0, min(a[i + 2], b[i + 2]) - max(a[i], b[i])) for i in (0, 1)]
    least = [max(1.0, min(a[i + 2] - a[i], b[i + 2] - b[i])) for i in (0, 1)]
    gap = [max(0.0, max(a[i], b[i]) - min(a[i + 2], b[i + 2])) for i in (0, 1)]
    return gap[0], gap[1], shared[0] / least[0], shared[1] / least[1]


def writing_clusters(found: list[list[float]], line: float) -> list[list[int]]:
    """Groups of boxes joined by steps: on one line within 3 line heights, below one another within 2.4, or aligned within 1.5."""

    def near(a: list[float], b: list[float]) -> bool:
        across, down, x_share, y_share = _gaps(a, b)
        off = abs((a[0] + a[2]) - (b[0] + b[2])) / 2
        return (y_share >= 0.25 and across <= 3 * line) or (x_share >= 0.12 and down <= 2.4 * line) or (down <= 1.5 * line and off <= 1.2 * max(1.0, a[2] - a[0], b[2] - b[0]))

    group = list(range(len(found)))
    for i in range(len(found)):
        for j in range(i):
            if group[i] != group[j] and near(found[i], found[j]):
                low, high = sorted((group[i], group[j]))
                group = [low if g == high else g for g in group]
    return [[i for i, g in enumerate(group) if g == k] for k in sorted(set(group))]


def ranked_clusters(members: list[tuple[list[float], float]], proposal: list[float], line: float) -> list[tuple[float, list[float], list[int]]]:
    """(score, box, members) of the clusters of (box, score), best first, then from the top left."""
    area = lambda b: max(0.0, b[2] - b[0]) * max(0.0, b[3] - b[1])
    span = max(1.0, float(np.hypot(proposal[2] - proposal[0], proposal[3] - proposal[1])))
    out = []
    for group in writing_clusters([b for b, _ in members], line):
        own = np.array([members[i][0] for i in group])
        box = [*own[:, :2].min(axis=0).tolist(), *own[:, 2:].max(axis=0).tolist()]
        scores = [members[i][1] for i in group]
        dense = min(1.0, 3 * sum(map(area, own.tolist())) / max(1.0, area(box)))
        common = max(0.0, min(box[2], proposal[2]) - max(box[0], proposal[0])) * max(0.0, min(box[3], proposal[3]) - max(box[1], proposal[1]))
        away = float(np.hypot(box[0] + box[2] - proposal[0] - proposal[2], box[1] + box[3] - proposal[1] - proposal[3])) / 2 / span
        score = 0.38 * max(scores) + 0.24 * sum(scores) / len(scores) + 0.18 * min(1.0, common / max(1.0, area(box))) + 0.12 * dense + 0.08 * max(0.0, 1 - away)
        out.append((round(score, 4), box, group))
    return sorted(out, key=lambda c: (-c[0], c[1][1], c[1][0]))


def best_clusters(candidates: DataFrame, line: float) -> DataFrame:
    """(slot_id, score, box, block_ords) of each slot's best cluster of eligible candidates (slot_id, block_ord, block_box, score, eligible, proposal)."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("block_ord")
        best = ranked_clusters([(list(b), s) for b, s in zip(pdf["block_box"], pdf["score"])], list(pdf["proposal"].iloc[0]), line)[0]
        return pd.DataFrame({"slot_id": [pdf["slot_id"].iloc[0]], "score": [best[0]], "box": [best[1]], "block_ords": [[int(pdf["block_ord"].iloc[i]) for i in best[2]]]})

    rows = candidates.filter("eligible").select("slot_id", "block_ord", "block_box", "score", "proposal")
    return rows.groupBy("slot_id").applyInPandas(run, "slot_id string, score double, box array<double>, block_ords array<int>")


def cohort_votes(pixels: DataFrame, share: float = 0.70, at_least: int = 2) -> DataFrame:
    """(page, x, y, votes, stable, brightness): ink of aligned sheets (page, sheet, x, y, value, ink): stable where enough sheets have it; brightness is the 75th percentile."""
    sheets = pixels.groupBy("page").agg(F.countDistinct("sheet").alias("n"))
    votes = pixels.groupBy("page", "x", "y").agg(F.count_if("ink").alias("votes"), F.percentile("value", 0.75).alias("brightness"))
    needed = F.greatest(F.lit(at_least), F.ceil(F.col("n") * share))
    return votes.join(sheets, "page").select("page", "x", "y", "votes", (F.col("votes") >= needed).alias("stable"), "brightness")


def cohort_confidence(samples: Column) -> Column:
    """From the least number of samples of any page; 0 without."""
    return F.when(samples > 0, F.least(F.lit(0.95), 0.58 + 0.06 * samples)).otherwise(0.0)


def answer_contexts(text: str | None, count: int) -> list[tuple[str, str]]:
    """The 48 characters before and after each of the first `count` places to answer at; where there are fewer, the end of the text."""
    raw = (text or "").strip()
    found = [(raw[max(0, m.start() - 48) : m.start()].strip(), raw[m.end() : m.end() + 48].strip()) for m in CUE.finditer(raw)][:count]
    return found + [(raw[-96:], "")] * (count - len(found))
