"""Not-modified revisit records resolved against the latest earlier full response of the same canonical URL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Headers that a not-modified answer may bring up to date, in lower case.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")
#: Query parameters that name no other page.
TRACKING = "^(utm_[^=]*|ref|fbclid|gclid)(=|$)"
#: Seconds of one URL's records that one window holds; earlier ones are looked up through a line per such span.
SPAN = 86_400
FIELDS = ("record_id", "kind", "url", "at", "status", "etag", "last_modified", "headers", "payload_sha256", "payload_bytes")


def canonical_url(url: Column) -> Column:
    """Host in lower case without `www.`, port 80 or 443; path without last slash; query sorted, without tracking parameters; no scheme, no fragment. Null stays null."""
    part = lambda i: F.regexp_extract(url, r"^(?:(?:[A-Za-z][A-Za-z0-9+.-]*:)?//)?([^/?#]*)([^?#]*)(?:\?([^#]*))?", i)
    host = F.regexp_replace(F.regexp_replace(F.lower(part(1)), r"^www\.", ""), r":(80|443)$", "")
    query = F.array_join(F.array_sort(F.filter(F.split(part(3), "&"), lambda x: (x != "") & ~x.rlike(TRACKING))), "&")
    return F.concat(host, F.regexp_replace(part(2), "/+$", ""), F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))


def _strong(tag: Column) -> Column:
    return F.regexp_replace(tag, "^W/", "")


def resolve_revisits(records: DataFrame, span: int = SPAN) -> DataFrame:
    """One row per revisit: (record_id, canonical, at, outcome, refers_to, headers, payload_sha256, payload_bytes).

    records has FIELDS: kind `response` or `revisit`, at in seconds, headers a map with names in lower case. Full
    responses have status 200. Earlier is by (at, record_id); rows repeated in full are taken as one response. outcome:
    `resolved`, `no_earlier_response`, `validator_mismatch` or `no_validator`; entity tags are compared without `W/`,
    and Last-Modified only where the revisit has no tag. headers of a resolved revisit: the response's, with the
    revisit's permitted ones in their place; of others the revisit's own. Revisits without URL or time have no
    earlier response; nulls among validators count as absent; other columns are dropped; an empty table gives no rows.
    The rows of one URL are split by `span`, so no URL is bound to one task. Payloads stay where they are.
    """
    rows = records.select(*FIELDS).withColumn("canonical", canonical_url(F.col("url"))).withColumn("span", F.floor(F.col("at") / span))
    full = (F.col("kind") == "response") & (F.col("status") == 200) & F.col("canonical").isNotNull() & F.col("at").isNotNull()
    seen = F.when(full, F.struct("at", "record_id", "etag", "last_modified", "headers", "payload_sha256", "payload_bytes"))
    rows = rows.filter(full | (F.col("kind") == "revisit")).withColumn("seen", seen)
    near = W.partitionBy("canonical", "span").orderBy(F.col("at"), F.col("record_id")).rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumn("near", F.last("seen", ignorenulls=True).over(near)).filter("kind = 'revisit'")
    # lines per URL and span: the last response in it, then the last of any earlier span
    ends = records.select(*FIELDS).withColumn("canonical", canonical_url(F.col("url"))).filter(full).withColumn("span", F.floor(F.col("at") / span))
    ends = ends.groupBy("canonical", "span").agg(F.max(F.struct("at", "record_id")).alias("end"))
    asked = rows.filter(F.col("near").isNull() & F.col("canonical").isNotNull() & F.col("at").isNotNull()).select("canonical", "span").distinct()
    lines = ends.select("canonical", "span", "end").unionByName(asked.select("canonical", "span", F.lit(None).cast(ends.schema["end"].dataType).alias("end")))
    lines = lines.groupBy("canonical", "span").agg(F.max("end").alias("end"), F.lit(1).alias("one"))
    earlier = W.partitionBy("canonical").orderBy("span").rowsBetween(W.unboundedPreceding, -1)
    far = lines.select("canonical", "span", F.last("end", ignorenulls=True).over(earlier).alias("far")).filter("far is not null").select("canonical", "span", F.col("far.record_id").alias("far_id"), F.col("far.at").alias("far_at"))
    responses = records.select(*FIELDS).withColumn("canonical", canonical_url(F.col("url"))).filter(full).dropDuplicates(["canonical", "at", "record_id"])
    found = far.join(responses.select(F.col("canonical"), F.col("at").alias("far_at"), F.col("record_id").alias("far_id"), seen.alias("before")), ["canonical", "far_at", "far_id"]).select("canonical", "span", "before")
    rows = rows.join(found, ["canonical", "span"], "left").withColumn("of", F.coalesce("near", "before"))
    tag, when = F.col("etag"), F.col("last_modified")
    outcome = (
        F.when(F.col("of").isNull(), "no_earlier_response")
        .when(tag.isNull() & when.isNull(), "no_validator")
        .when(F.when(tag.isNotNull(), F.coalesce(_strong(tag) == _strong(F.col("of.etag")), F.lit(False))).otherwise(F.coalesce(when == F.col("of.last_modified"), F.lit(False))), "resolved")
        .otherwise("validator_mismatch")
    )
    fresh = F.map_filter(F.coalesce("headers", F.create_map().cast("map<string,string>")), lambda k, v: k.isin(*PERMITTED))
    kept = F.map_filter(F.coalesce("of.headers", F.create_map().cast("map<string,string>")), lambda k, v: ~F.map_contains_key(fresh, k))
    good = F.col("outcome") == "resolved"
    return rows.withColumn("outcome", outcome).select(
        "record_id", "canonical", "at", "outcome", F.when(good, F.col("of.record_id")).alias("refers_to"),
        F.when(good, F.map_concat(kept, fresh)).otherwise(F.col("headers")).alias("headers"),
        F.when(good, F.col("of.payload_sha256")).alias("payload_sha256"), F.when(good, F.col("of.payload_bytes")).alias("payload_bytes"),
    )


def captures(pages: DataFrame) -> DataFrame:
    """Records of a crawl over `pages`: each page fetched at 100 seconds times its id (partial content for every 13th), revisited 1000 seconds later, every tenth also 10 seconds before.

    Every seventh later revisit has another entity tag, every ninth none; every fifth response has a weak tag.
    """
    p, at = F.col("page_id"), F.col("page_id") * 100
    tag = F.md5(F.coalesce("html", F.lit("")).cast("binary"))
    page = pages.select("page_id", "url", tag.alias("tag"), F.sha2(F.coalesce("html", F.lit("")), 256).alias("sha"), F.octet_length(F.coalesce("html", F.lit(""))).cast("bigint").alias("n"))

    def headers(*pairs: Column) -> Column:
        return F.map_filter(F.create_map(*pairs), lambda k, v: v.isNotNull())

    own = F.when(p % 5 == 0, F.concat(F.lit("W/"), F.col("tag"))).otherwise(F.col("tag"))
    given = F.when(p % 9 == 0, F.lit(None)).when(p % 7 == 0, F.lit("stale")).otherwise(F.col("tag"))
    response = F.struct(
        (p * 4).alias("record_id"), F.lit("response").alias("kind"), at.alias("at"), F.when(p % 13 == 0, 206).otherwise(200).alias("status"), own.alias("etag"), (at - 50).alias("last_modified"),
        headers(F.lit("cache-control"), F.lit("max-age=60"), F.lit("content-type"), F.lit("text/html"), F.lit("date"), at.cast("string"), F.lit("etag"), own).alias("headers"),
        F.col("sha").alias("payload_sha256"), F.col("n").alias("payload_bytes"),
    )

    def revisit(k: int, shift: int) -> Column:
        return F.struct(
            (p * 4 + k).alias("record_id"), F.lit("revisit").alias("kind"), (at + shift).alias("at"), F.lit(304).alias("status"), given.alias("etag"), (at - 50).alias("last_modified"),
            headers(F.lit("cache-control"), F.lit("max-age=120"), F.lit("content-type"), F.lit("text/plain"), F.lit("date"), (at + shift).cast("string"), F.lit("etag"), given).alias("headers"),
            F.lit(None).cast("string").alias("payload_sha256"), F.lit(None).cast("bigint").alias("payload_bytes"),
        )

    each = F.when(p % 10 == 0, F.array(response, revisit(1, 1000), revisit(2, -10))).otherwise(F.array(response, revisit(1, 1000)))
    return page.select("url", F.explode(each).alias("r")).select("r.record_id", "r.kind", "url", "r.at", "r.status", "r.etag", "r.last_modified", "r.headers", "r.payload_sha256", "r.payload_bytes")
