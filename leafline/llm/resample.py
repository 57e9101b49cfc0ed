"""Importance resampling towards a target distribution.

Texts are collapsed by grouping on the whole text: each distinct text is cut into words once, its features hashed into
buckets once and weighed once; its bucket counts are multiplied by how many rows have it. Buckets' gains compare the
target's share with the corpus's, a text's weight is the floored mean over its features, and weights are joined back to
the rows before each row gets the noise of its own id (Gumbel), so that the highest scores are a draw without
replacement.
"""

from __future__ import annotations

import dataclasses
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafline.llm.exact_dedup import ascii_lower
from leafline.llm.storage import written

#: Texts with this share of all rows or more, 1/HOT, are at most HOT; their weights are broadcast, as a join on them would be one task's.
HOT = 1000
#: Fixed value: what parts words once A-Z are in lower case.
APART = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: A row's place within its partition has this many bits in monotonically_increasing_id().
PLACE_BITS = 33


@dataclasses.dataclass(frozen=True)
class Law:
    """max_n: longest run of words that is a feature; percent: how many of the documents with least_words words are drawn."""

    max_n: int = 1
    buckets: int = 10_000
    least_words: int = 20
    percent: int = 10
    seed: str = "2024"


def words(text: Column) -> Column:
    return F.filter(F.split(ascii_lower(text), APART), lambda w: w != "")


def _runs_of(ws: Column, n: int) -> Column:
    at = F.transform(F.sequence(F.lit(1), F.size(ws) - n + 1), lambda i: F.concat_ws(" ", F.slice(ws, i, n)))
    return F.when(F.size(ws) >= n, at).otherwise(F.array().cast("array<string>"))


def runs(ws: Column, max_n: int) -> Column:
    """All runs of 1 to max_n neighbouring words, joined by a space."""
    return F.concat(ws, *[_runs_of(ws, n) for n in range(2, max_n + 1)]) if max_n > 1 else ws


def bucketed(text: Column, law: Law) -> Column:
    """struct<n_words, buckets>: the number of words, and the bucket of each feature. The words are bound once, as a lambda's body is evaluated for each element."""
    bucket = lambda g: F.pmod(F.crc32(g.cast("binary")), F.lit(law.buckets)).cast("int")
    of = lambda ws: F.struct(F.size(ws).alias("n_words"), F.transform(runs(ws, law.max_n), bucket).alias("buckets"))
    return F.get(F.transform(F.array(words(text)), of), F.lit(0))


def collapsed(df: DataFrame, text_col: str, law: Law, name: str) -> DataFrame:
    """(digest, n_words, buckets, copies) of each distinct text, a null one being empty; written, as it is read for the counts and for the weights."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    groups = df.select(text.alias("text_")).groupBy("text_").agg(F.count(F.lit(1)).alias("copies"))
    return written(groups.select(F.sha2("text_", 256).alias("digest"), F.inline(F.array(bucketed(F.col("text_"), law))), "copies"), name)


def bucket_counts(texts: DataFrame) -> dict[int, int]:
    """Features in each bucket over all rows: at most as many lines as there are buckets."""
    lines = texts.select(F.explode("buckets").alias("b"), "copies").groupBy("b").agg(F.sum("copies").alias("n"))
    return {r["b"]: r["n"] for r in lines.collect()}


def gains(corpus: dict[int, int], target: dict[int, int], buckets: int) -> list[int]:
    all_corpus, all_target = sum(corpus.values()), sum(target.values())
    ratio = lambda b: (target.get(b, 0) + 1) * (all_corpus + buckets) / ((corpus.get(b, 0) + 1) * (all_target + buckets))
    return [math.floor(1000 * math.log(ratio(b))) for b in range(buckets)]


def weighed(texts: DataFrame, of_bucket: list[int]) -> DataFrame:
    """texts with n_features and weight, the floored mean of its features' gains (none: 0)."""
    known = F.split(F.lit(",".join(map(str, of_bucket))), ",").cast("array<int>")  # folded into one literal of fixed size
    total = F.aggregate("buckets", F.lit(0).cast("bigint"), lambda s, b: s + F.get(known, b))
    n = F.size("buckets").cast("bigint")
    rows = texts.select("digest", F.col("n_words").cast("bigint").alias("n_words"), n.alias("n_features"), total.alias("total"), "copies")
    weight = F.expr("CASE WHEN n_features = 0 THEN 0L ELSE (total - pmod(total, n_features)) div n_features END")
    return rows.select("digest", "n_words", "n_features", weight.alias("weight"), "copies")


def noise(row_id: Column, seed: str) -> Column:
    """floor(-1000 ln(-ln(u))) of a u made from the seed and the row's id; a null id is the text `null`."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(row_id.cast("string"), F.lit("null"))), 256), 1, 8), 16, 10).cast("bigint")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("bigint")


def numbered(df: DataFrame, *order: Column, name: str) -> DataFrame:
    """df with `rank` from 1 in the order given: sorted by ranges, and each range's rows counted on from those before it. The driver gets a line a range."""
    rows = written(df.orderBy(*order).withColumn("at_", F.monotonically_increasing_id()), name)
    part = F.shiftright("at_", PLACE_BITS)
    sizes = sorted((r["part"], r["n"]) for r in rows.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect())
    begins, before = [], 0
    for p, n in sizes:
        begins.append((p, before))
        before += n
    starts = df.sparkSession.createDataFrame(begins, "part_ bigint, start_ bigint")
    place = F.col("at_").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    return rows.withColumn("part_", part).join(F.broadcast(starts), "part_").withColumn("rank", F.col("start_") + place + 1).drop("part_", "start_", "at_")


def cut_for(scores: DataFrame, k: int) -> int | None:
    """The k-th highest score: from the counts of each score, which are whole thousandths of a logarithm and so at most some ten thousand lines."""
    seen = 0
    for r in sorted(scores.groupBy("score").agg(F.count(F.lit(1)).alias("n")).collect(), key=lambda r: -r["score"]) if k else []:
        seen += r["n"]
        if seen >= k:
            return r["score"]
    return None


def resample(docs: DataFrame, target: DataFrame, law: Law = Law(), id_col: str = "doc_id", text_col: str = "text", target_col: str = "text") -> DataFrame:
    """(id_col, n_features, weight, score, rank) of each row of docs; rank is null for rows that are not drawn.

    Null and empty texts have no features and weight 0. Equal texts have equal weights, each row noise of its own: rows
    of one id have the same noise. Ties go to the smaller id (null last), then to the smaller digest; rows alike in all
    of these are drawn one by one. An empty table gives no rows, an empty target gives gains all the same. Other columns
    are dropped. Texts are equal when their bytes are; weights are joined back by SHA-256.
    """
    ids = docs.select(F.col(id_col).alias("id"), F.sha2(F.coalesce(F.col(text_col).cast("string"), F.lit("")), 256).alias("digest"))
    ids = written(ids, "resample-ids")
    texts = collapsed(docs, text_col, law, "resample-texts")
    aims = collapsed(target, target_col, law, "resample-target")
    weights = weighed(texts, gains(bucket_counts(texts), bucket_counts(aims), law.buckets))
    n_rows = texts.agg(F.sum("copies")).first()[0] or 0
    hot = F.broadcast(weights.filter(F.col("copies") * HOT >= n_rows).drop("copies"))  # at most HOT lines
    cold = weights.filter(F.col("copies") * HOT < n_rows).drop("copies")
    back = ids.join(hot, "digest").unionByName(ids.join(hot, "digest", "left_anti").join(cold, "digest"))
    scored = written(back.withColumn("score", F.col("weight") + noise(F.col("id"), law.seed)), "resample-scored")
    able = F.col("n_words") >= law.least_words
    k = scored.filter(able).count() * law.percent // 100
    cut = cut_for(scored.filter(able), k)
    shown = ["id", "n_features", "weight", "score"]
    none = F.lit(None).cast("bigint")
    if cut is None:
        return scored.select(*shown, none.alias("rank")).withColumnRenamed("id", id_col)
    near = able & (F.col("score") >= cut)
    ranked = numbered(scored.filter(near), F.desc("score"), F.asc_nulls_last("id"), F.asc("digest"), name="resample-ranked")
    drawn = ranked.select(*shown, F.when(F.col("rank") <= k, F.col("rank")).alias("rank"))
    return drawn.unionByName(scored.filter(~near).select(*shown, none.alias("rank"))).withColumnRenamed("id", id_col)
