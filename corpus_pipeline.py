"""From raw documents to packed training sequences in five stages.

Every stage takes rows as they come: a null text counts as empty, null ids are ids like others, repeated ids are rows of
their own, ties are broken by id and then by row, columns beside COLUMNS are dropped, and an empty table gives none.
Long texts are read whole.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafline.llm.exact_dedup import exact_dedup, text_digest
from leafline.llm.jaccard import jaccard_copies, row_key
from leafline.llm.packing import pack
from leafline.llm.queries import held_out
from leafline.llm.storage import documents, passing, place_in_files, remove, without, written
from leafline.llm.suffix_dedup import CHUNK_ROWS, remove_repeats
from leafline.llm.toxicity import fit, sample_labelled, score

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not call toxic; it learns from labels outside the held-out fold. Null and empty texts have the score of no evidence; with labels of one kind only all rows have one score."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = fit(sample_labelled(docs.filter(~held_out(2, 4)), labels))
    return score(docs, model).filter("predicted = 0").select(*COLUMNS)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal after lower-casing A-Z, the row with the largest doc_id; of its repetitions one. A row is known by its doc_id, null or not, and its text's digest."""
    found = written(exact_dedup(docs).select("doc_id", "keep_id", "kept", "digest"), "pipeline-exact")
    same = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    rows = docs.select(*COLUMNS, text_digest(F.col("text")).alias("digest"))
    return without(rows, found.filter(~same), ["doc_id", "digest"], checked=found.filter(same & ~F.col("kept"))).select(*COLUMNS)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by five-word shingles with a similarity of 0.8 or more, the row with the smallest doc_id; of rows repeated whole one."""
    dropped, repeated = jaccard_copies(docs, k=5, num=80, den=100)
    rows = docs.select(*COLUMNS, row_key(F.col("doc_id"), F.col("text")).alias("at"))
    return without(rows, written(dropped, "pipeline-near"), ["at"], checked=repeated).select(*COLUMNS)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without strings of 50 bytes that also start in a document with a smaller doc_id; a null id is larger than any, rows of one id do not shorten one another. A null text becomes an empty one."""
    place = place_in_files(docs, CHUNK_ROWS)
    rows = docs.select(*COLUMNS, *([] if place is None else [place.alias("chunk")]))
    done = remove_repeats(rows, chunk_col=None if place is None else "chunk", carry=("lang", "source"), as_text=True)
    return done.select("doc_id", F.col("kept").alias("text"), "lang", "source", F.char_length("kept").cast("bigint").alias("n_chars"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 1024 tokens; an empty text is one piece, the end."""
    return pack(docs, VOCABULARY)


STAGES = [("toxicity", toxicity), ("exact_dedup", exact), ("jaccard_join", near), ("suffix_dedup", repeats), ("packing", packing)]

#: SQL cannot say what the classifier, byte strings and vocabulary do; tests compare stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces that the stages make of `documents`; each stage's result is written and read again, and what it was made from is deleted."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        with passing(spark) as keep:
            after = keep(written(stage(spark, docs, sf_dir), f"pipeline-{name}"))
        if hasattr(docs, "_leafline_path"):
            remove(docs)
        docs = after
    return STAGES[-1][1](spark, docs, sf_dir)
