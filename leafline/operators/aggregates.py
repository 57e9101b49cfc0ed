"""Roll-ups over the document tree, statuses, evaluation and telemetry."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ratio(a: Column, b: Column) -> Column:
    """a / b, null for no b."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def balanced_level(children: DataFrame, parents: DataFrame, key: str, child: str, parent: str, tolerance: float = 0.01) -> DataFrame:
    """parents with `parent` set to the sum of their children's non-null `child`, where there is one; `derived`, `declared` and whether they differ by more than the tolerance (`repaired`)."""
    sums = children.groupBy(key).agg(F.sum(child).alias("derived"))
    met = parents.join(sums, key, "left").withColumn("declared", F.col(parent))
    met = met.withColumn("repaired", F.coalesce(F.abs(F.col("declared") - F.col("derived")) > tolerance, F.lit(False)))
    return met.withColumn(parent, F.coalesce("derived", "declared"))


def joined_parts(parts: DataFrame, keys: list[str], order: list[str], text: str) -> DataFrame:
    """Texts of a key joined by line ends in order, null if any of several is null; how many; status."""
    rows = parts.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*order, F.col(text).alias("text_")))).alias("rows_"), F.bool_or(F.col(text).isNull()).alias("broken_"))
    joined = F.when(~F.col("broken_"), F.array_join(F.transform("rows_", lambda r: r["text_"]), "\n"))
    return rows.select(*keys, F.size("rows_").alias("n_parts"), joined.alias("text"), F.when(F.col("broken_"), "UNRESOLVED").otherwise("RECOGNIZED").alias("status"))


def inclusion_status(status: Column, good: tuple[str, ...]) -> Column:
    """Aggregate: COMPLETE if all rows' statuses are good, PARTIAL if some are, UNRESOLVED if none."""
    is_good = F.coalesce(status.isin(*good), F.lit(False))
    return F.when(F.bool_and(is_good), "COMPLETE").when(F.bool_or(is_good), "PARTIAL").otherwise("UNRESOLVED")


def item_status(parts: DataFrame, keys: list[str], expected: str) -> DataFrame:
    """(keys, counts, answer_status, completion_rate) of parts (keys, status, geometry, blank_confirmed, text), expected the declared number."""
    n, done = F.count(F.lit(1)), F.count_if(F.col("status").isin("RECOGNIZED", "BLANK"))
    rows = parts.groupBy(*keys).agg(
        F.greatest(F.coalesce(F.max(expected), F.lit(0)), n).alias("expected_slots"), n.alias("observed_slots"),
        F.count_if(F.col("status") == "RECOGNIZED").alias("recognized_slots"), F.count_if(F.col("status") == "BLANK").alias("blank_slots"),
        done.alias("done_"), F.bool_or(F.col("text").isNotNull()).alias("any_"),
        F.bool_and(F.col("geometry").isin("ALIGNED", "ALIGNED_WITH_WARNING") | ((F.col("geometry") == "MISSING") & (F.col("status") == "BLANK") & F.coalesce("blank_confirmed", F.lit(False)))).alias("placed_"),
    )
    complete = (F.col("observed_slots") == F.col("expected_slots")) & (F.col("done_") == F.col("observed_slots")) & F.coalesce("placed_", F.lit(False))
    return rows.select(
        *keys, "expected_slots", "observed_slots", "recognized_slots", "blank_slots",
        F.greatest(F.lit(0), F.col("expected_slots") - F.col("done_")).alias("unresolved_slots"),
        F.when(complete, "COMPLETE").when(F.col("any_"), "PARTIAL").otherwise("UNRESOLVED").alias("answer_status"), ratio(F.col("done_"), F.col("expected_slots")).alias("completion_rate"),
    )


def by_dimension(rows: DataFrame, dimensions: list[str], sums: dict[str, Column]) -> DataFrame:
    """(label, case_count, sums): each row counted under `dimension=value` for each dimension, a null value as None."""
    filled = rows.select(*[F.coalesce(F.col(d).cast("string"), F.lit("None")).alias(d) for d in dimensions], *[c.alias(n) for n, c in sums.items()])
    grouped = filled.groupingSets([[F.col(d)] for d in dimensions], *[F.col(d) for d in dimensions]).agg(F.count(F.lit(1)).alias("case_count"), *[F.sum(n).alias(n) for n in sums])
    label = F.coalesce(*[F.concat(F.lit(f"{d}="), F.col(d)) for d in dimensions])
    return grouped.select(label.alias("label"), "case_count", *sums)


def telemetry(events: DataFrame, operation: Column, seconds: Column, failed: Column, hit: Column) -> DataFrame:
    """Per operation: requests, summed seconds, failures, hits and hit rate, to four digits."""
    n = F.count(F.lit(1))
    return events.groupBy(operation.alias("operation")).agg(
        n.alias("request_count"), F.round(F.sum(seconds), 4).alias("duration_seconds"), F.count_if(failed).alias("failures"), F.count_if(hit).alias("cache_hits"),
        F.round(F.count_if(hit) / F.greatest(F.lit(1), n), 4).alias("cache_hit_rate"),
    )


def consensus(llm: Column, layout: Column, cohort: Column) -> tuple[Column, Column]:
    """(decision, resolved count) of three counts, of which 0 and null are absent."""
    a, b, c = (F.coalesce(x, F.lit(0)) for x in (llm, layout, cohort))
    all_ = (a > 0) & (b > 0) & (c > 0)
    decision = (
        F.when(all_ & (a == b) & (b == c), "CONSENSUS").when(all_, "CONFLICT")
        .when((b > 0) & (c > 0), F.when(b == c, "CONSENSUS_TWO_WAY").otherwise("CONFLICT")).otherwise("INSUFFICIENT")
    )
    return decision, F.when(decision == "CONSENSUS", llm).when(decision == "CONSENSUS_TWO_WAY", cohort)


def histogram(rows: DataFrame, column: str, values: list[str]) -> DataFrame:
    """(column, n) for each of the values, zero where absent."""
    dim = rows.sparkSession.createDataFrame([(v,) for v in values], f"`{column}` string")
    return dim.join(rows.groupBy(column).agg(F.count(F.lit(1)).alias("n_")), column, "left").select(column, F.coalesce("n_", F.lit(0)).alias("n"))


def reason_rows(rows: DataFrame, keys: list[str], reasons: Column) -> DataFrame:
    """(keys, ord, reason): one row per reason of an array, by place."""
    return rows.select(*keys, F.posexplode(reasons).alias("ord", "reason"))


def reason_lists(reasons: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, reasons, status): distinct reasons in order of (ord, reason)."""
    rows = reasons.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("ord", "reason"))).alias("r_"))
    return rows.select(*keys, F.array_distinct(F.transform("r_", lambda r: r["reason"])).alias("reasons"), F.lit("NEED_REVIEW").alias("status"))


def code_sets(sources: list[DataFrame], keys: list[str], code: str) -> DataFrame:
    """(keys, codes): sorted distinct codes of several tables."""
    both = reduce(DataFrame.unionByName, [s.select(*keys, code) for s in sources])
    return both.groupBy(*keys).agg(F.array_sort(F.collect_set(code)).alias("codes"))


def improved(before: list[Column], after: list[Column]) -> Column:
    """Whether (aligned, recognised, -issues) got better by order, and neither of the first two got worse."""
    return (F.struct(*after) > F.struct(*before)) & (after[0] >= before[0]) & (after[1] >= before[1])


def graded(kind: Column, standard: Column, given: Column, points: Column) -> tuple[Column, Column, Column]:
    """(correct, score, status): choices with both answers are compared, all else is for review."""
    from leafline.functions.text import squeezed

    ready = kind.rlike("choice|single|judgment|选择|判断") & standard.isNotNull() & given.isNotNull()
    right = squeezed(standard) == squeezed(given)
    return F.when(ready, right), F.when(ready, F.when(right, F.coalesce(points, F.lit(0.0))).otherwise(0.0)), F.when(ready, "auto_graded").otherwise("needs_review")


def triage(text: Column, confidence: Column) -> Column:
    """Quality of an answer by length and confidence."""
    n = F.char_length(F.trim(F.coalesce(text, F.lit(""))))
    sure = F.coalesce(confidence, F.lit(0.0))
    return F.when(n == 0, "missing").when(sure < 0.5, "poor").when((n < 20) & (sure < 0.8), "doubtful").when(sure < 0.8, "fair").otherwise("good")


def reports(rows: DataFrame, key: Column, rules: list[tuple], message: bool = False) -> DataFrame:
    """(rule, level, key[, message]) for each rule (name, level, condition[, message]) that a row breaks, in one pass."""
    line = lambda r: F.struct(F.lit(r[0]).alias("rule"), F.lit(r[1]).alias("level"), key.cast("string").alias("key"), *([r[3].cast("string").alias("message")] if message else []))
    return rows.select(F.inline(F.array_compact(F.array(*[F.when(F.coalesce(r[2], F.lit(False)), line(r)) for r in rules]))))


def tree_rules(tree: DataFrame) -> DataFrame:
    """(rule, level, key, message) of the rows (item_id, slot_idx, expected_slot_count) of a tree: ids missing, slots repeated or not contiguous from 1, counts out of range or not met."""
    items = tree.groupBy("item_id").agg(F.count("slot_idx").alias("n"), F.countDistinct("slot_idx").alias("d"), F.min("slot_idx").alias("lo"), F.max("slot_idx").alias("hi"), F.max("expected_slot_count").alias("e"))
    return reports(items, F.col("item_id"), [
        ("MISSING_ID", "error", F.col("item_id").isNull(), F.lit("item without id")),
        ("DUPLICATE_SLOT", "error", F.col("n") > F.col("d"), F.concat(F.col("n") - F.col("d"), F.lit(" repeated"))),
        ("SLOT_GAP", "error", (F.col("n") > 0) & ((F.col("lo") != 1) | (F.col("hi") != F.col("d"))), F.concat(F.lit("slots "), F.col("lo"), F.lit(" to "), F.col("hi"))),
        ("COUNT_RANGE", "error", ~F.col("e").between(1, 100), F.concat(F.lit("count "), F.col("e"))),
        ("COUNT_MISMATCH", "warning", F.col("e") != F.col("d"), F.concat(F.col("e"), F.lit(" expected, "), F.col("d"), F.lit(" found"))),
    ], message=True)


def mean_or_zero(value: Column, digits: int = 4) -> Column:
    """Aggregate: the sum over how many rows there are, nought without."""
    return F.round(F.coalesce(F.sum(value), F.lit(0.0)) / F.greatest(F.lit(1), F.count(F.lit(1))), digits)
