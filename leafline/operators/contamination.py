"""Documents against a benchmark: which items' grams they hold, and which item their words match best.

The benchmark is the small side: an index of its items by gram is built once and held in every worker, documents are
looked at one by one and whole. A benchmark is measured before it is fetched; one of more than MOST_BYTES is taken in
parts by the hash of the id, each of which meets all documents in a pass of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Bytes of a benchmark's texts that are indexed and broadcast at once.
MOST_BYTES = 32 << 20


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def _packed(codes: np.ndarray, n: int) -> np.ndarray:
    """Runs of n <= 4 codes under 65536, each run as one number."""
    c = codes.astype(np.uint64)
    out = np.zeros(max(0, len(c) - n + 1), np.uint64)
    for i in range(n):
        out = (out << np.uint64(16)) | c[i : i + len(out)]
    return out


class _Grams:
    """Numbers of the grams of n code points in the vocabulary of some texts."""

    def __init__(self, texts: list[str], n: int) -> None:
        self.n = n
        alphabet = np.unique(np.concatenate([_codes(t) for t in texts] or [np.zeros(0, "<u4")]))
        if len(alphabet) > 65535:
            raise ValueError("items of one block have over 65535 different characters")
        self.known = np.zeros(0x110000, np.uint16)  # 0: in no item
        self.known[alphabet] = np.arange(1, len(alphabet) + 1)
        self.vocabulary = np.unique(np.concatenate([_packed(self.known[_codes(t)], n) for t in texts] or [np.zeros(0, np.uint64)]))

    def __len__(self) -> int:
        return len(self.vocabulary)

    def size(self, text: str) -> int:
        codes = _codes(text)
        if len(codes) and codes.max() >= 65536:
            codes = np.unique(codes, return_inverse=True)[1]
            if codes.max() >= 65536:
                return len({text[i : i + self.n] for i in range(len(text) - self.n + 1)})
        return len(np.unique(_packed(codes, self.n)))

    def of(self, text: str) -> np.ndarray:
        g = _packed(self.known[_codes(text)], self.n)
        if not len(self.vocabulary):
            return np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, g), len(self.vocabulary) - 1)
        return at[self.vocabulary[at] == g]


class _Words:
    """Numbers of the words between single spaces in the vocabulary of some texts."""

    def __init__(self, texts: list[str]) -> None:
        self.number = {w: i for i, w in enumerate(sorted({w for t in texts for w in t.split(" ")}))}

    def __len__(self) -> int:
        return len(self.number)

    def size(self, text: str) -> int:
        return len(set(text.split(" ")))

    def of(self, text: str) -> np.ndarray:
        return np.array([self.number[w] for w in set(text.split(" ")) if w in self.number], np.int64)


class _Index:
    """For each element of the items' vocabulary the items that have it, one after another."""

    def __init__(self, items: list[str], kind) -> None:
        self.elements = kind(items)
        own = [np.unique(self.elements.of(t)) for t in items]
        self.sizes = np.array([len(x) for x in own], np.int64)
        element, item = np.concatenate(own or [np.zeros(0, np.int64)]), np.repeat(np.arange(len(items)), self.sizes)
        order = np.argsort(element, kind="stable")
        self.items = item[order].astype(np.int32)
        self.begins = np.searchsorted(element[order], np.arange(len(self.elements) + 1))

    def shared(self, text: str) -> np.ndarray:
        """How many distinct elements a text shares with each item."""
        ids = np.unique(self.elements.of(text))
        n = self.begins[ids + 1] - self.begins[ids]
        at = np.repeat(self.begins[ids] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum()) if len(ids) else ids
        return np.bincount(self.items[at], minlength=len(self.sizes))


def _parts(benchmark: DataFrame) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts of a benchmark (id, text), in parts of about MOST_BYTES at most, by id."""
    key, text = (F.col(c) for c in benchmark.columns[:2])
    n = -(-(benchmark.agg(F.sum(F.octet_length(text))).first()[0] or 0) // MOST_BYTES)
    for i in range(n):
        rows = sorted(benchmark.filter(F.pmod(F.xxhash64(key), F.lit(n)) == i).collect(), key=lambda r: r[0])
        if rows:
            yield [r[0] for r in rows], [r[1] for r in rows]


def _united(docs: DataFrame, found: list[DataFrame], schema: str) -> DataFrame:
    out = docs.sparkSession.createDataFrame([], schema)
    for f in found:
        out = out.unionByName(f)
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame, least: float = 0.4, n: int = 4) -> DataFrame:
    """(doc_id, item_id, share, doc_share): documents and items of which over `least` of the item's distinct grams of n <= 4 characters are in the document, or of the document's in the item.

    docs: (doc_id, text), benchmark: (item_id, text). Texts that are null or shorter than n have no grams.
    """
    sized = lambda df: df.filter(f"char_length(text) >= {n}")
    a, b = (df.schema.fields[0].dataType.simpleString() for df in (docs, benchmark))
    schema = f"doc_id {a}, item_id {b}, share double, doc_share double"

    def against(ids: list, texts: list[str]) -> DataFrame:
        index = docs.sparkSession.sparkContext.broadcast(_Index(texts, lambda t: _Grams(t, n)))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, names = index.value, pa.array(ids)
            for batch in batches:
                i, j, share, doc_share = [], [], [], []
                for at, t in enumerate(batch.column(1).to_pylist()):
                    k = held.shared(t)
                    of_item, of_doc = k / held.sizes, k / held.elements.size(t)
                    met = np.flatnonzero((of_item > least) | (of_doc > least))
                    i += [at] * len(met)
                    j += met.tolist()
                    share += of_item[met].tolist()
                    doc_share += of_doc[met].tolist()
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(i, pa.int64())), names.take(pa.array(j, pa.int64())), pa.array(share, pa.float64()), pa.array(doc_share, pa.float64())], ["doc_id", "item_id", "share", "doc_share"])

        return sized(docs).mapInArrow(run, schema)

    return _united(docs, [against(*part) for part in _parts(sized(benchmark))], schema)


def best_items(docs: DataFrame, benchmark: DataFrame, least: float, lead: float) -> DataFrame:
    """(doc_id, item_id, share): each document's best item by the share of the document's distinct words that it has, if that is `least` or more and leads the second, where another item shares a word, by `lead` or more."""
    some = lambda df: df.filter("text is not null")
    a, b = (df.schema.fields[0].dataType.simpleString() for df in (docs, benchmark))
    rows = some(docs).withColumn("row_", F.monotonically_increasing_id())  # repeated ids are rows of their own
    best_two = f"doc_id {a}, row_ bigint, item_id {b}, share double"

    def against(ids: list, texts: list[str]) -> DataFrame:
        index = docs.sparkSession.sparkContext.broadcast(_Index(texts, _Words))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, names = index.value, pa.array(ids)
            for batch in batches:
                i, j, share = [], [], []
                for at, t in enumerate(batch.column(1).to_pylist()):
                    k = held.shared(t)
                    for item in np.argsort(-k, kind="stable")[:2]:  # of equals the smallest item_id
                        if k[item]:
                            i.append(at)
                            j.append(int(item))
                            share.append(k[item] / held.elements.size(t))
                place = pa.array(i, pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0).take(place), batch.column(2).take(place), names.take(pa.array(j, pa.int64())), pa.array(share, pa.float64())], ["doc_id", "row_", "item_id", "share"])

        return rows.select(docs.columns[0], "text", "row_").mapInArrow(run, best_two)

    found = [against(*part) for part in _parts(some(benchmark))]
    w = W.partitionBy("row_").orderBy(F.desc("share"), "item_id")  # two lines a part of the benchmark
    ranked = _united(docs, found, best_two).withColumn("k_", F.row_number().over(w)).withColumn("next_", F.lead("share").over(w))
    good = (F.col("k_") == 1) & (F.col("share") >= least) & F.coalesce(F.col("share") - F.col("next_") >= lead, F.lit(True))
    return ranked.filter(good).select("doc_id", "item_id", "share")
