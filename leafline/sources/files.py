"""Discovery, fingerprints and readers of document folders; writers of results."""

from __future__ import annotations

import json
import os
import re
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leafline.functions.text import page_number

#: File types of pages.
IMAGES = ("jpg", "jpeg", "png", "webp", "bmp", "tif", "tiff")
BLOCKS = "image string, blocks array<struct<text: string, bbox: array<double>, confidence: double>>"


def discover(spark: SparkSession, root: str, include_scans: bool = False) -> DataFrame:
    """(subject, owner, role, path, name, page_index, content) of page images in root/subject/owner/: teachers first, pages by number, then name."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    parts = F.split("path", "/")
    rows = files.select("path", F.element_at(parts, -1).alias("name"), F.element_at(parts, -2).alias("owner"), F.element_at(parts, -3).alias("subject"), "content")
    rows = rows.filter(F.lower(F.regexp_extract("name", r"\.([A-Za-z]+)$", 1)).isin(*IMAGES))
    if not include_scans:
        rows = rows.filter(~F.startswith("name", F.lit("扫描_")))
    role = F.when((F.lower("owner") == "teacher") | F.contains("owner", F.lit("教师")), "teacher").otherwise("student")
    w = W.partitionBy("subject", "owner").orderBy(page_number(F.col("name")), "name")
    return rows.withColumn("role", role).withColumn("page_index", F.row_number().over(w))


def selected(documents: DataFrame, subject: str | None = None, student: str | None = None, limit: int | None = None) -> DataFrame:
    """Documents (subject, owner, role) of a subject and student, with the teachers of the student's subjects; the first `limit` by subject, teachers first, then owner."""
    rows = documents if subject is None else documents.filter(F.col("subject") == subject)
    if student is not None:
        own = rows.filter((F.col("role") == "student") & (F.col("owner") == student))
        rows = own.unionByName(rows.filter("role = 'teacher'").join(own.select("subject").distinct(), "subject", "left_semi"))
    return rows if limit is None else rows.orderBy("subject", F.col("role") != "teacher", "owner").limit(limit)


def document_fingerprint(pages: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, fingerprint): SHA-256 over name and bytes of each page in order. A document's pages are one group, bounded by paper."""
    rows = pages.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("page_index", "name", "content"))).alias("p_"))
    joined = F.aggregate("p_", F.lit(b"").cast("binary"), lambda a, p: F.concat(a, p["name"].cast("binary"), p["content"]))
    return rows.select(*keys, F.sha2(joined, 256).alias("fingerprint"))


def page_fingerprint(content: Column) -> Column:
    """SHA-256 of a page, empty for none."""
    return F.coalesce(F.sha2(content, 256), F.lit(""))


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """Recognised blocks per image from JSON lines; blank lines are passed over, a broken line fails."""
    return spark.read.schema(BLOCKS).option("mode", "FAILFAST").json(path)


def read_headings(spark: SparkSession, path: str) -> DataFrame:
    """(path, ord, level, title) of headings of level 2 to 4 in Markdown files of at most 2 MiB."""
    text = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value").filter(F.octet_length("value") <= 2 << 20)
    lines = text.select("path", F.posexplode(F.split("value", r"\r?\n")).alias("ord", "line"))
    return lines.select("path", "ord", F.char_length(F.regexp_extract("line", "^(#{2,4}) ", 1)).alias("level"), F.trim(F.regexp_extract("line", "^#{2,4} +(.*)$", 1)).alias("title")).filter("level > 0")


def model_json(text: str) -> dict:
    """The one JSON object in a model's answer, with or without fences; ValueError for none or several that differ."""
    found, decode, at = [], json.JSONDecoder().raw_decode, 0
    text = re.sub(r"```[a-zA-Z]*", "", text)
    while (at := text.find("{", at)) >= 0:
        try:
            value, at = decode(text, at)
        except ValueError:
            at += 1
            continue
        if value not in found:
            found.append(value)
    if len(found) != 1:
        raise ValueError(f"{len(found)} objects in the answer")
    return found[0]


def new_work(pages: DataFrame, cache: DataFrame, key: str = "fingerprint") -> DataFrame:
    """Pages whose fingerprint a cache table does not have."""
    return pages.join(cache.select(key), key, "left_anti")


def expand_slots(items: DataFrame, slots: str = "slots") -> DataFrame:
    """One row per slot, one with nulls for items without."""
    return items.select(*[c for c in items.columns if c != slots], F.explode_outer(slots).alias("slot"))


def write_documents(df: DataFrame, path: str, by: str = "subject", overwrite: bool = False) -> None:
    """JSON in a folder for each subject; refuses an existing path unless told to overwrite."""
    df.write.mode("overwrite" if overwrite else "errorifexists").partitionBy(by).json(path)


def write_json(value: object, path: str) -> None:
    """A small JSON file on this machine, whole or not at all."""
    fd, temporary = tempfile.mkstemp(dir=os.path.dirname(os.path.abspath(path)))
    with os.fdopen(fd, "w", encoding="utf-8") as f:
        json.dump(value, f, ensure_ascii=False, indent=2)
        f.flush()
        os.fsync(f.fileno())
    os.replace(temporary, path)
