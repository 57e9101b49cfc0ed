"""The queries of this subpackage and, where SQL can say it, their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafline.llm.bpe import bpe_round_trip
from leafline.llm.exact_dedup import exact_dedup
from leafline.llm.hard_negatives import mine
from leafline.llm import lm, pii
from leafline.llm.jaccard import jaccard_classes
from leafline.llm.packing import pack
from leafline.llm.resample import resample
from leafline.llm.sharding import shard
from leafline.llm.storage import documents
from leafline.llm.suffix_dedup import CHUNK_ROWS, remove_repeats
from leafline.llm.toxicity import fit, sample_labelled, score
from leafline.llm.warc import captures, resolve_revisits
from leafline.llm.winnowing import as_string, fingerprints_with_next, hashes, likeness, positions

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def held_out(remainder: int, folds: int) -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == remainder, F.lit(False))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = fit(sample_labelled(docs.filter(~held_out(2, 4)), labels))
    return score(docs.select("doc_id", "text", held_out(2, 4).alias("held_out")), model).drop("text")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), VOCABULARY)


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = bpe_round_trip(documents(spark, sf_dir), VOCABULARY)
    return done.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir)).withColumnRenamed("digest", "text_sha256")


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(documents(spark, sf_dir), k=3, num=90, den=100)


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = F.xxhash64("_metadata.file_path", F.floor(F.col("_metadata.row_index") / CHUNK_ROWS))
    done = remove_repeats(documents(spark, sf_dir).select("doc_id", "text", place.alias("chunk")), chunk_col="chunk")
    return done.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"), F.size("span_starts").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = lm.score(documents(spark, sf_dir).select("doc_id", "text", (~held_out(1, 5)).alias("train")))
    return done.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op8_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fingerprints_with_next(documents(spark, sf_dir))
    own, edited = F.array_distinct(hashes(F.col("chosen"))), F.array_distinct(hashes(F.col("edited_chosen")))
    return made.select(
        "doc_id", F.char_length("text").cast("bigint").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        as_string(F.col("chosen")).alias("fingerprint"), as_string(F.col("edited_chosen")).alias("edited_fingerprint"),
        likeness(own, edited).alias("near_edited"), likeness(own, F.col("next_hashes")).alias("near_next"), positions(F.col("chosen")).alias("positions"),
    )


def op9_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = resolve_revisits(captures(spark.read.parquet(f"{sf_dir}/pages.parquet")))
    lines = F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    return done.withColumn("headers", F.array_join(lines, "|"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(documents(spark, sf_dir), n_shards=16, law="bytes").withColumn("grown_shard", F.lit(None).cast("int"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), label=moved)


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(documents(spark, sf_dir))
    n = [F.size(F.filter("base.kind", F.lit(k).eqNullSafe)).cast("bigint").alias(f"n_{name}") for k, name in enumerate(pii.KINDS)]
    return found.select("doc_id", *n, F.sha2(pii.as_text(F.col("base")), 256).alias("base_sha256"), pii.as_text(F.col("spans")).alias("spans"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_packing": op2_packing,
    "op3_bpe": op3_bpe,
    "op6_exact_dedup": op6_exact_dedup,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op7_lm_scoring": op7_lm_scoring,
    "op8_winnowing": op8_winnowing,
    "op9_warc_revisits": op9_warc_revisits,
    "op10_sharding": op10_sharding,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_resampling": op12_resampling,
    "op13_pii": op13_pii,
}

ORACLE_SQL: dict[str, str] = {
    "op6_exact_dedup": """
        WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
        SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
        FROM d
    """,
    "op9_warc_revisits": r"""
        WITH p AS (
            SELECT page_id AS p, page_id * 100 AS t, md5(coalesce(html, '')) AS tag, sha256(coalesce(html, '')) AS sha, octet_length(encode(coalesce(html, ''))) AS n,
                   regexp_replace(regexp_replace(lower(regexp_extract(url, '^(?:(?:[A-Za-z][A-Za-z0-9+.-]*:)?//)?([^/?#]*)', 1)), '^www\.', ''), ':(80|443)$', '')
                   || regexp_replace(regexp_extract(url, '^(?:(?:[A-Za-z][A-Za-z0-9+.-]*:)?//)?[^/?#]*([^?#]*)', 1), '/+$', '') AS place,
                   array_to_string(list_sort(list_filter(string_split(regexp_extract(url, '\?([^#]*)', 1), '&'),
                       lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[^=]*|ref|fbclid|gclid)(=|$)'))), '&') AS q
            FROM pages),
        c AS (SELECT *, CASE WHEN url_q = '' THEN place ELSE place || '?' || url_q END AS canonical FROM (SELECT *, coalesce(q, '') AS url_q FROM p)),
        full_ AS (SELECT p * 4 AS id, canonical, t AS ts, tag, sha, n, CASE WHEN p % 5 = 0 THEN 'W/' || tag ELSE tag END AS own, t - 50 AS lm FROM c WHERE p % 13 <> 0),
        rev AS (
            SELECT p * 4 + k AS record_id, canonical, t + shift AS ts, CASE WHEN p % 9 = 0 THEN NULL WHEN p % 7 = 0 THEN 'stale' ELSE tag END AS given, t - 50 AS lm
            FROM c, (VALUES (1, 1000), (2, -10)) AS v(k, shift) WHERE k = 1 OR p % 10 = 0),
        m AS (
            SELECT r.*, f.id, f.tag, f.own, f.sha, f.n, f.lm AS flm,
                   row_number() OVER (PARTITION BY r.record_id ORDER BY f.ts DESC NULLS LAST, f.id DESC) AS k
            FROM rev r LEFT JOIN full_ f ON f.canonical = r.canonical AND (f.ts < r.ts OR (f.ts = r.ts AND f.id < r.record_id))),
        o AS (SELECT *, CASE WHEN id IS NULL THEN 'no_earlier_response' WHEN given IS NOT NULL AND given = tag THEN 'resolved'
                             WHEN given IS NULL AND lm = flm THEN 'resolved' ELSE 'validator_mismatch' END AS outcome FROM m WHERE k = 1)
        SELECT record_id, canonical, ts AS "at", outcome, CASE WHEN outcome = 'resolved' THEN id END AS refers_to,
               CASE WHEN outcome = 'resolved' THEN 'cache-control: max-age=120|content-type: text/html|date: ' || ts || '|etag: ' || coalesce(given, own)
                    ELSE 'cache-control: max-age=120|content-type: text/plain|date: ' || ts || coalesce('|etag: ' || given, '') END AS headers,
               CASE WHEN outcome = 'resolved' THEN sha END AS payload_sha256, CASE WHEN outcome = 'resolved' THEN n END AS payload_bytes
        FROM o
    """,
    "op11_hard_negatives": """
        WITH v AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
            FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        p AS (
            SELECT a.vec_id AS a, a.label AS l, b.vec_id AS b, b.label AS m, list_inner_product(a.e, b.e)::BIGINT AS s
            FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
        pos AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY s DESC, b) AS k FROM p WHERE l = m) WHERE k <= 5),
        neg AS (
            SELECT pos.a, pos.b, pos.s AS ps, p.b AS n, p.s AS ns, row_number() OVER (PARTITION BY pos.a, pos.b ORDER BY p.s DESC, p.b) AS k
            FROM pos JOIN p ON p.a = pos.a AND p.m <> p.l AND 50 * pos.s <= 100 * p.s AND 100 * p.s <= 95 * pos.s)
        SELECT a AS anchor_id, b AS positive_id, k::INT AS rank, n AS negative_id, ps AS positive_score, ns AS negative_score FROM neg WHERE k <= 3
    """,
    "op12_resampling": r"""
        WITH poly AS (
            SELECT list(list_reduce([c, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END) ORDER BY c) AS t
            FROM (SELECT unnest(range(256))::BIGINT AS c)),
        d AS (SELECT doc_id, string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
        b AS (SELECT string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
        dw AS (SELECT doc_id, w FROM (SELECT doc_id, unnest(ws) AS w FROM d) WHERE w <> ''),
        bw AS (SELECT w FROM (SELECT unnest(ws) AS w FROM b) WHERE w <> ''),
        v AS (SELECT w, hex(encode(w)) AS x FROM (SELECT DISTINCT w FROM dw UNION SELECT DISTINCT w FROM bw)),
        h AS (
            SELECT w, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(x)::BIGINT, 2), lambda i: ('0x' || substr(x, i, 2))::BIGINT)),
                                      lambda c, y: xor(c // 256, t[(xor(c, y) % 256) + 1])), 4294967295) % 10000 AS bucket
            FROM v, poly),
        s AS (SELECT bucket, count(*) AS n FROM dw JOIN h USING (w) GROUP BY bucket),
        t AS (SELECT bucket, count(*) AS n FROM bw JOIN h USING (w) GROUP BY bucket),
        g AS (
            SELECT k AS bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT sum(n) FROM s) + 10000)::DOUBLE
                                                / ((coalesce(s.n, 0) + 1)::DOUBLE * ((SELECT sum(n) FROM t) + 10000)::DOUBLE)))::BIGINT AS gain
            FROM (SELECT unnest(range(10000)) AS k) LEFT JOIN s ON s.bucket = k LEFT JOIN t ON t.bucket = k),
        w AS (SELECT doc_id, count(*) AS n_features, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight FROM dw JOIN h USING (w) JOIN g USING (bucket) GROUP BY doc_id),
        c AS (
            SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
                   coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
            FROM documents LEFT JOIN w USING (doc_id)),
        r AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS k, count(*) OVER (PARTITION BY n_features >= 20) AS able FROM c)
        SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND k <= able // 10 THEN k END AS rank FROM r
    """,
}
