"""Topology of a document: local ids, collapsed choices, merged sections, declared sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def local_ids(questions: DataFrame, document: list[str], section: str, order: list[str], number: str) -> DataFrame:
    """questions with `local_id`, unique in the document: q{number} where the number is, else s{section}_q{number}, further ones with _2, _3."""
    alone = F.count(F.lit(1)).over(W.partitionBy(*document, number)) == 1
    base = F.when(alone, F.concat(F.lit("q"), F.col(number))).otherwise(F.concat(F.lit("s"), F.col(section), F.lit("_q"), F.col(number)))
    nth = F.row_number().over(W.partitionBy(*document, "base_").orderBy(section, *order))
    rows = questions.withColumn("base_", base)
    return rows.withColumn("local_id", F.when(nth == 1, F.col("base_")).otherwise(F.concat("base_", F.lit("_"), nth))).drop("base_")


def collapsed_choices(items: DataFrame, keys: list[str], order: str, kind: str, label: str, references: str) -> DataFrame:
    """(keys, n_items, references) of questions: one item with the distinct references in order if all are choices and one is labelled A to H, else as many items as there are."""
    rows = items.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.bool_and(F.col(kind) == "choice").alias("all_"), F.bool_or(F.col(label).rlike("^[A-H]$")).alias("any_"),
        F.array_sort(F.collect_list(F.struct(order, references))).alias("r_"),
    )
    return rows.select(*keys, F.when(F.col("all_") & F.coalesce("any_", F.lit(False)), 1).otherwise(F.col("n")).cast("bigint").alias("n_items"), F.array_distinct(F.flatten(F.transform("r_", lambda r: r[references]))).alias("references"))


def merged_sections(pages: DataFrame, keys: list[str], title: Column, order: list[str]) -> DataFrame:
    """pages with `section`: sections of equal normalised title are one, numbered from 1 as first seen."""
    rows = pages.withColumn("title_", title)
    first = F.min(F.struct(*order)).over(W.partitionBy(*keys, "title_"))
    return rows.withColumn("first_", first).withColumn("section", F.dense_rank().over(W.partitionBy(*keys).orderBy("first_"))).drop("first_", "title_")


def unexplained_pages(pages: DataFrame, referenced: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of pages that neither a question refers to nor a reason explains."""
    return pages.select(*keys).join(referenced.select(*keys), keys, "left_anti").join(other.select(*keys), keys, "left_anti")


def accepted_template(found: Column, expected: Column, kept: Column, least: float = 0.45) -> Column:
    """Whether all expected numbers were found and enough characters stay."""
    return (F.size(F.array_except(expected, found)) == 0) & (kept >= least)


def candidate_gate(candidate: Column, source: Column) -> Column:
    """Whether a proposed set of names overlaps the source by .65 and adds at most max(2, a quarter of it, half to even)."""
    both, extra = F.size(F.array_intersect(candidate, source)), F.size(F.array_except(candidate, source))
    return (both >= 0.65 * F.size(source)) & (extra <= F.greatest(F.lit(2), F.bround(F.size(source) * 0.25)))


def json_audit(text: Column, allowed: list[str], types: dict[str, str]) -> Column:
    """First fault of a JSON object against a closed schema: not an object, unknown key, missing key, wrong type; null if none."""
    keys = F.json_object_keys(text)
    expected = F.array(*[F.lit(k) for k in allowed])
    out = F.when(keys.isNull(), "NOT_OBJECT").when(F.size(F.array_except(keys, expected)) > 0, "UNKNOWN_KEY").when(F.size(F.array_except(expected, keys)) > 0, "MISSING_KEY")
    for k, t in types.items():
        out = out.when(F.get_json_object(text, f"$.{k}").try_cast(t).isNull(), "WRONG_TYPE")
    return out
