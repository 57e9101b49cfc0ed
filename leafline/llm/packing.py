"""Documents packed into sequences of fixed size by their length histogram."""

from __future__ import annotations

import json
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leafline.llm.bpe import WORDS, byte_symbols, tokenizer
from leafline.llm.spfhp import pack_histogram
from leafline.llm.storage import tune, written

SIZE = 1024
END = 0

#: A text with a longer word, or more white space beyond one character a word, is left to the encoder of bpe.py: the faster library's
#: pattern overflows its stack on long runs of white space, and its merges are quadratic in the length of a word.
LONG_RUN = 1000

_encoders: dict[str, tiktoken.Encoding] = {}


def encoder(path: str) -> tiktoken.Encoding:
    """The vocabulary file's ids from a faster library; its merges have to be in the order of the ids they make."""
    if path not in _encoders:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, symbols, special = spec["model"]["vocab"], byte_symbols(), {t["content"]: t["id"] for t in spec["added_tokens"]}
        pairs = (m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"])
        made = [vocab[a + b] for a, b in pairs]
        if made != sorted(made):
            raise ValueError(f"{path}: merges are not in the order of their ids")
        ranks = {bytes(symbols[c] for c in s): i for s, i in vocab.items() if s not in special}
        _encoders[path] = tiktoken.Encoding("file", pat_str=WORDS, mergeable_ranks=ranks, special_tokens=special)
    return _encoders[path]


def ids_of(text: str, path: str) -> list[int]:
    """The ids of a text, whatever its runs."""
    lengths = list(map(len, text.split()))
    if max(max(lengths, default=0), len(text) - sum(lengths) - len(lengths)) > LONG_RUN:
        return tokenizer(path).encode(text)
    return encoder(path).encode(text, allowed_special="all")


def pieces_of(docs: DataFrame, path: str, size: int = SIZE, keep_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, start, length, ids_crc32, doc_tokens, part, local[, ids]): each document's ids and the end id, cut after every `size` ids.

    `local` numbers the pieces of one length within one task's `part`. A null text is the end id alone.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    names = [id_col, "start", "length", "ids_crc32", "doc_tokens", "part", "local", *["ids"] * keep_ids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), Counter()
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                rows = batch.slice(at, 1000)
                owner, cols, kept = [], [[] for _ in range(6)], []
                for i, text in enumerate(rows.column(1).to_pylist()):
                    ids = np.array([*ids_of(text or "", path), END], dtype="<u4")
                    for start in range(0, len(ids), size):
                        piece = ids[start : start + size]
                        owner.append(i)
                        for c, v in zip(cols, (start, len(piece), zlib.crc32(piece.tobytes()), len(ids), part, seen[len(piece)])):
                            c.append(v)
                        seen[len(piece)] += 1
                        if keep_ids:
                            kept.append(piece.astype(np.int32))
                arrays = [rows.column(0).take(pa.array(owner, pa.int64())), *(pa.array(c, pa.int64()) for c in cols)]
                yield pa.RecordBatch.from_arrays(arrays + ([pa.array(kept, pa.list_(pa.int32()))] if keep_ids else []), names)

    schema = f"`{id_col}` {id_type}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, part bigint, local bigint" + ", ids array<int>" * keep_ids
    return docs.select(id_col, F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


def placements(histogram: dict[int, int], size: int) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, rank after the last, how many of it a sequence has, first sequence, offset) for each run of each pattern.

    Patterns are at most three for each length and have fewer runs than lengths fit a sequence, whatever the input's size.
    """
    out, next_rank, sequence = [], Counter(), 0
    for p in pack_histogram(histogram, size):
        offset = 0
        for length, n in p.runs:
            out.append((length, next_rank[length], next_rank[length] + n * p.count, n, sequence, offset))
            next_rank[length] += n * p.count
            offset += length * n
        sequence += p.count
    return out


def pack(docs: DataFrame, path: str, size: int = SIZE, keep_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids]) of each piece.

    A null or empty text is one piece, the end id alone. Null ids of rows and repeated rows are documents like others,
    packed row by row; other columns are dropped. An empty table gives no rows. The driver gets the histogram of
    lengths, at most `size` lines; ids are read once and not shuffled unless kept.
    """
    spark = tune(docs.sparkSession)
    pieces = written(pieces_of(docs, path, size, keep_ids, id_col, text_col), "pack-pieces")
    counts = written(pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n")), "pack-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = spark.createDataFrame(placements(histogram, size), "length bigint, first bigint, after bigint, per bigint, sequence bigint, offset0 bigint")
    before = W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)  # a line per task
    ranked = pieces.join(counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0")), ["length", "part"]).withColumn("rank", F.col("n0") + F.col("local"))
    met = ranked.join(F.broadcast(places).withColumnRenamed("length", "length_"), (F.col("length") == F.col("length_")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("after")))
    nth = F.col("rank") - F.col("first")
    return met.select(
        id_col, "start", "length", "ids_crc32", "doc_tokens",
        (F.col("sequence") + F.expr("(rank - first) div per")).alias("sequence_id"), (F.col("offset0") + nth % F.col("per") * F.col("length")).alias("offset"),
        *["ids"] * keep_ids,
    )
