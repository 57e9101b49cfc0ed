"""Toxicity by compression distance.

Two zstandard dictionaries of one size are trained, one on windows of ordinary text and one on windows of toxic text,
each placed before the same ordinary base. A window is compressed with both; as the base lies at the same distance in
both, the lengths differ only where one of the two dictionaries matches. Figures of a text's differences go through a
calibrated logistic curve, whose cut has the best F1.

Most windows of a toxic document are ordinary. Which ones the toxic dictionary is trained on is decided by compression
alone: all windows are compressed with dictionaries that did not see their document, and those of toxic documents stay
whose difference is larger than that of nearly all ordinary windows; those of ordinary documents that look most toxic
(but for the few that look like quotations) train the ordinary dictionary; and so again, ROUNDS times. Toxic windows
that another document repeats word for word take no part, as a copied passage would match itself.

The model is fitted on a bounded sample of labelled rows (MOST_DOCS for each label, MOST_BYTES of text and MOST_WINDOWS
of ordinary windows at most, by hash order), each label weighed by its share of all labelled rows, and sent to the
executors; its size is fixed by the dictionaries' sizes.
"""

import collections
import dataclasses
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafline.llm.storage import trim, tune

#: Most labelled rows of each label that the model is fitted on, most bytes of their texts in all, and most windows of ordinary ones.
MOST_DOCS = {0: 6_000, 1: 2_000}
MOST_BYTES = 30_000_000
MOST_WINDOWS = 80_000
#: Words of a window that is scored, and of one that a dictionary is trained on.
WINDOW_WORDS, TRAIN_WORDS = 6, 3
LEVEL = 12
#: Bytes of either dictionary, and of the base behind both.
DICTIONARY_BYTES, BASE_BYTES = 3_072, 110_000
#: Share of ordinary windows below whose differences a toxic window is not chosen; share of ordinary windows that look most toxic, and of those that look so toxic that they may quote; how often both are chosen anew. Chosen, with the sizes, on sf0.1 and check_s.
BELOW, HARD, QUOTED, ROUNDS = 0.985, 0.05, 0.002, 4
FOLDS = 3
CUT = 0.3


def words(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "replace").split()


def windows(ws: list[bytes], n: int = WINDOW_WORDS) -> list[bytes]:
    return [b" " + b" ".join(ws[i : i + n]) + b" " for i in range(0, len(ws), n)]


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    p = zstandard.ZstdCompressionParameters.from_level(LEVEL, source_size=8 * WINDOW_WORDS, dict_size=len(content), write_checksum=False, write_content_size=False, write_dict_id=False)
    d.precompute_compress(compression_params=p)
    return zstandard.ZstdCompressor(dict_data=d, compression_params=p)


def _train(size: int, samples: list[bytes], k: int) -> bytes:
    """Dictionary of at most `size` bytes; where zstandard finds too few samples for training, the samples themselves."""
    try:
        return zstandard.train_dictionary(size, samples, k=k, d=6).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:size]


class _Measure:
    def __init__(self, base: bytes, ordinary: bytes, toxic: bytes) -> None:
        self.ordinary, self.toxic = _compressor(ordinary + base or b" " * 8), _compressor(toxic + base or b" " * 8)

    def gains(self, ws: list[bytes]) -> np.ndarray:
        """For each window, by how many bytes it is shorter with the toxic dictionary than with the ordinary one."""
        if len(ws) < 2:
            return np.array([len(self.ordinary.compress(w)) - len(self.toxic.compress(w)) for w in ws], float)
        a, b = self.ordinary.multi_compress_to_buffer(ws), self.toxic.multi_compress_to_buffer(ws)
        return np.array([len(x) - len(y) for x, y in zip(a, b)], float)

    def features(self, text: str) -> list[float]:
        g = np.sort(self.gains(windows(words(text))))[::-1]
        if not len(g):
            return [0.0] * FEATURES
        above = [g[g >= k] for k in (1, 2, 3)]
        return [float(x) for x in (g[0], g[:3].sum() / 3, g.mean(), np.log1p(len(g)), len(above[0]) / len(g), len(above[1]) / len(g), *(np.log1p(a.sum()) for a in above))]


FEATURES = 9


@dataclasses.dataclass
class ToxicityModel:
    base: bytes
    ordinary: bytes
    toxic: bytes
    weights: list[float]

    def scorer(self):
        m, w = _Measure(self.base, self.ordinary, self.toxic), np.array(self.weights)
        return lambda text: float(1 / (1 + np.exp(-np.clip(w[0] + np.dot(w[1:], m.features(text)), -30, 30))))


def _own_windows(texts: list[str], toxic: np.ndarray, rng: np.random.Generator) -> tuple[list[bytes], np.ndarray]:
    """Windows and the place of each one's text: MOST_WINDOWS of ordinary texts, and of toxic ones all that no other text has word for word."""
    cut = lambda t: windows(words(t), TRAIN_WORDS)  # noqa: E731  cut twice, as all windows at once take much memory
    named = [np.fromiter(((zlib.crc32(w) << 32) | zlib.adler32(w) for w in cut(t)), np.uint64) for t in texts]
    names, n = np.unique(np.concatenate([np.unique(x) for x in named]), return_counts=True)
    repeated = names[n > 1]
    sizes = np.array([0 if y else len(x) for x, y in zip(named, toxic)])
    order = rng.permutation(int(sizes.sum()))[:MOST_WINDOWS]
    taken = np.zeros(int(sizes.sum()), bool)
    taken[order] = True
    ws, at, begin = {0: [], 1: []}, {0: [], 1: []}, 0
    for i, (t, y) in enumerate(zip(texts, toxic)):
        kept = ~np.isin(named[i], repeated) if y else taken[begin : begin + sizes[i]]
        begin += sizes[i]
        if kept.any():
            own = cut(t)
            ws[y] += [own[k] for k in np.flatnonzero(kept)]
            at[y] += [i] * int(kept.sum())
    drawn = np.searchsorted(np.sort(order), order)  # ordinary ones in the order they were drawn
    return [ws[0][k] for k in drawn] + ws[1], np.array([at[0][k] for k in drawn] + at[1], int)


class _Chooser:
    """Windows chosen by compression differences, and dictionaries of those outside a fold."""

    def __init__(self, texts: list[str], toxic: np.ndarray, fold: np.ndarray) -> None:
        self.rng = np.random.default_rng(0)
        self.ws, at = _own_windows(texts, toxic, self.rng)
        self.toxic, self.fold = toxic[at].astype(bool) if len(at) else np.zeros(0, bool), fold[at] if len(at) else np.zeros(0, int)
        self.half = ~self.toxic & (self.rng.random(len(self.ws)) < 0.5)  # half of the ordinary windows are for the base
        self.base, self.chosen = self.half, ~self.half
        for _ in range(ROUNDS):
            self.choose()

    def dictionaries(self, without: int) -> tuple[bytes, bytes, bytes]:
        of = lambda some: [self.ws[i] for i in self.rng.permutation(np.flatnonzero(some & (self.fold != without)))]
        return _train(BASE_BYTES, of(self.base), 64), _train(DICTIONARY_BYTES, of(self.chosen & ~self.toxic), 32), _train(DICTIONARY_BYTES, of(self.chosen & self.toxic), 32)

    def choose(self) -> None:
        gain = np.zeros(len(self.ws))
        for f in range(FOLDS):
            m = _Measure(*self.dictionaries(f))
            own = np.flatnonzero(self.fold == f)
            gain[own] = m.gains([self.ws[i] for i in own])
        ordinary = gain[~self.toxic]
        if not len(ordinary) or self.toxic.sum() == 0:
            return
        most = np.quantile(ordinary, 1 - QUOTED)
        self.base = self.half & (gain < most)
        told = self.toxic & (gain > np.quantile(ordinary, BELOW))
        hard = ~self.toxic & ~self.half & (gain >= np.quantile(ordinary, 1 - HARD)) & (gain <= most)
        if told.any() and hard.any():
            self.chosen = told | hard


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Coefficients of a ridge logistic regression of weighted rows by Newton steps, the bias first."""
    x1 = np.c_[np.ones(len(x)), x]
    w, ridge = np.zeros(x1.shape[1]), np.diag([1e-6] + [1e-2] * x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x1 @ w, -30, 30)))
        w = w - np.linalg.solve((x1 * (weight * p * (1 - p))[:, None]).T @ x1 + ridge, x1.T @ (weight * (p - y)) + ridge @ w)
    return w


def fit(labelled: list[tuple[str, int, float]]) -> ToxicityModel:
    """Model of (text, label, weight) rows. Differences for calibration come from dictionaries that did not see their text."""
    labelled = sorted({(t or "", int(y), float(w)) for t, y, w in labelled})
    texts, y, weight = [r[0] for r in labelled], np.array([r[1] for r in labelled], int), np.array([r[2] for r in labelled], float)
    if not (0 < y.sum() < len(y)):
        return ToxicityModel(b"", b"", b"", [-30.0 if not y.sum() else 30.0] + [0.0] * FEATURES)
    fold = np.random.default_rng(1).permutation(len(y)) % FOLDS
    chooser = _Chooser(texts, y, fold)
    x = np.zeros((len(y), FEATURES))
    for k in range(FOLDS):
        m = _Measure(*chooser.dictionaries(k))
        for i in np.flatnonzero(fold == k):
            x[i] = m.features(texts[i])
    weight *= len(y) / weight.sum()
    w = _logistic(x, y, weight)
    # the cut with the best F1 becomes a score of CUT
    z = w[0] + x @ w[1:]
    order = np.argsort(-z)
    hit = np.cumsum((weight * y)[order])
    f1 = 2 * hit / (np.cumsum(weight[order]) + hit[-1])
    best = int(np.argmax(f1))
    edge = (z[order[best]] + z[order[min(best + 1, len(y) - 1)]]) / 2
    w[0] += np.log(CUT / (1 - CUT)) - edge
    return ToxicityModel(*chooser.dictionaries(-1), [float(v) for v in w])


def sample_labelled(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> list[tuple[str, int, float]]:
    """Bounded sample of labelled rows (text, label, weight), least hashes of the id first, whole texts only; a text that no longer fits is passed over.

    The weight is how many labelled rows of docs with that label each taken one stands for. Of rows with one id that
    with the least digest counts; an id with both labels counts under each. Ids, digests and sizes are chosen from
    first; only texts that fit are fetched.
    """
    tune(docs.sparkSession)
    known = docs.select(id_col)
    rows = labels.select(id_col, F.col(label_col).cast("int").alias("y")).filter("y in (0, 1)").join(known, id_col, "left_semi").withColumn("h", F.xxhash64(id_col, F.lit(3))).dropDuplicates([id_col, "y"])
    of_label = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = [rows.filter(F.col("y") == y).orderBy("h", id_col).limit(most) for y, most in MOST_DOCS.items()]
    chosen = parts[0].unionByName(parts[1])  # at most the sum of MOST_DOCS lines
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    texts = docs.select(id_col, text.alias("text"))
    keyed = texts.join(F.broadcast(chosen.select(id_col).distinct()), id_col).groupBy(id_col).agg(F.min(F.struct(F.sha2("text", 256).alias("digest"), F.octet_length("text").alias("size"))).alias("of"))
    met = chosen.join(F.broadcast(keyed), id_col).select(id_col, "y", "h", "of.digest", "of.size").collect()
    left, taken = {y: MOST_BYTES * most // sum(MOST_DOCS.values()) for y, most in MOST_DOCS.items()}, []
    for r in sorted(met, key=lambda r: (r["h"], r["digest"], r["y"])):
        if r["size"] <= left[r["y"]]:
            left[r["y"]] -= r["size"]
            taken.append((r[id_col], r["digest"], r["y"]))
    kind = docs.schema[id_col].dataType.simpleString()
    fits = docs.sparkSession.createDataFrame(taken, f"`{id_col}` {kind}, digest string, y int")
    fetched = texts.withColumn("digest", F.sha2("text", 256)).join(F.broadcast(fits), [id_col, "digest"]).dropDuplicates([id_col, "digest", "y"])
    out = [(r["text"], r["y"]) for r in fetched.collect()]
    n = collections.Counter(y for _, y in out)
    return [(t, y, of_label[y] / n[y]) for t, y in out]


def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with `score` (0 to 1, higher: toxic likelier) and `predicted` (1 from CUT on) in place of columns so named.

    A null or empty text has no windows and gets the score of no evidence. Null ids, repeated rows and ties are scored
    row by row. An empty table gives none. Whole texts are scored; no shuffle. id_col takes no part in the score.
    """
    shared = tune(docs.sparkSession).sparkContext.broadcast(model)  # dictionaries of fixed size

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        one = shared.value.scorer()
        for s in batches:
            yield pd.Series([one(t or "") for t in s], dtype="float64")
            trim()  # the worker lives on in later stages

    kept = [c for c in docs.columns if c not in ("score", "predicted")]
    return docs.select(*[F.col(f"`{c}`") for c in kept], scored(F.col(text_col).cast("string")).alias("score")).withColumn("predicted", (F.col("score") >= CUT).cast("int"))
