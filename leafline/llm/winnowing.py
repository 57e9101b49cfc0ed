"""Document fingerprints by winnowing, with built-in functions only.

All k-grams of a text (k code points, at every position) have a rolling hash, the exclusive or of their code points'
own hashes, each shifted by how many follow it: hashes of 2, 4, 8 code points come from two neighbouring ones of half
the length, so each code point is read once and no k-gram is ever a string. Of every `window` neighbouring hashes the smallest is kept, the rightmost
of equals, with its position. Two texts that share window + k - 1 code points in a row share a kept hash. Hash and
position are packed in one long, so a window's choice is a plain minimum: the hash in the upper 32 bits, below it the
position counted down.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

K = 8
#: Neighbouring k-grams of which one is kept.
WINDOW = 24
#: Rows that a bucket of neighbouring documents holds about, and most bounds that its ranges of ids are drawn with.
BUCKET_ROWS, BOUNDS = 2000, 1024
LAST = (1 << 31) - 1


def _least_of(df: DataFrame, column: str, far: int) -> DataFrame:
    """df with each number of the array replaced by the least of it and the one `far` places on, if any."""
    c = F.col(column)
    return df.withColumn(column, F.zip_with(c, F.slice(c, far + 1, F.greatest(F.size(c) - far, F.lit(0))), lambda x, y: F.least(x, y)))


def points(text: Column) -> Column:
    """A hash of each code point."""
    return F.transform(F.split(text, ""), lambda c: F.xxhash64(c))


def rolling(df: DataFrame, column: str, k: int) -> DataFrame:
    """df with an array of points() replaced by the hashes of the k-grams that begin at each; fewer than k code points are one k-gram.

    Of a k-gram's two parts the second begins where the first ends; where k is no power of two the last two overlap. k is 2 or more, or the hashes are the points.
    """
    c, n, width = F.col(column), F.size(F.col(column)), 1
    join = lambda a, b, step: F.shiftleft(a, step).bitwiseXOR(b)
    whole = c
    while width < k:  # places too near the end become null and go at last
        step = min(width, k - width)
        whole = F.zip_with(whole, F.slice(whole, step + 1, F.greatest(n, F.lit(1))), lambda a, b: join(a, b, step))
        df, whole = df.withColumn("rolled_", whole), F.col("rolled_")
        width += step
    short = F.aggregate(c, F.lit(0).cast("bigint"), lambda a, b: join(a, b, 1))
    out = F.when(n >= k, F.slice(whole, 1, n - (k - 1))).when(n > 0, F.array(short)).otherwise(c)
    return df.withColumn(column, out).drop("rolled_")


def minima(docs: DataFrame, text: str, out: str, k: int = K, window: int = WINDOW, before: Column | None = None) -> DataFrame:
    """docs with column `out`: array<bigint>, the packed choice of each window of column `text`.

    A text shorter than k is one k-gram; a null or empty text has no choices; a text with fewer k-grams than a window
    is one window. `before`, a column that costs nothing to read: how many code points, with a window each, come
    before the text; if any do, k-grams that fill no window give none.
    """
    t, of = F.col(text), F.col(out)
    shift = F.lit(0) if before is None else before
    df = rolling(docs.withColumn(out, F.when(F.coalesce(F.char_length(t), F.lit(0)) == 0, F.lit([]).cast("array<bigint>")).otherwise(points(t))), out, k)
    df = df.withColumn(out, F.transform(of, lambda h, i: F.shiftleft(h, 32).bitwiseOR(F.lit(LAST).cast("bigint") - i)))
    width = 1
    while width < window:  # least of width neighbours, then of twice as many or of what is left
        step = min(width, window - width)
        df = _least_of(df, out, step)
        width += step
    df = df.withColumn(out, F.slice(of, 1, F.greatest(F.size(of) - (window - 1), F.when(shift > 0, 0).otherwise(1))))
    return df if before is None else df.withColumn(out, F.transform(of, lambda x: x - before))


def winnow(docs: DataFrame, text: str, out: str, k: int = K, window: int = WINDOW) -> DataFrame:
    """docs with column `out`: array<bigint>, the distinct packed choices of column `text`, by position; see minima()."""
    return minima(docs, text, out, k, window).withColumn(out, F.array_distinct(out))


def hashes(packed: Column) -> Column:
    return F.transform(packed, lambda x: F.shiftright(x, 32))


def positions(packed: Column) -> Column:
    """Code points before each chosen k-gram."""
    return F.transform(packed, lambda x: F.lit(LAST).cast("bigint") - x.bitwiseAND(F.lit(LAST).cast("bigint")))


def likeness(a: Column, b: Column) -> Column:
    """Shared among all hashes of two sets of hashes, 0 to 1; 1 for two empty ones."""
    both, either = F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))
    return F.when(either == 0, F.lit(1.0)).otherwise(both / F.greatest(either, F.lit(1)))


def as_string(packed: Column) -> Column:
    """Eight hexadecimal digits for each chosen hash, by position."""
    return F.array_join(F.transform(packed, lambda x: F.lower(F.lpad(F.hex(F.shiftrightunsigned(x, 32)), 8, "0"))), "")


def with_next(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """docs in buckets of neighbouring ids, each with the rows of its first successor.

    Columns: those of docs, `bucket`, `visitor` (true for the successor's row, which is there for its values only).
    Ranges of ids come from at most BOUNDS quantiles, cut evenly for their rows; `order` sorts a bucket. Null ids are
    the smallest.
    """
    ids = docs.select(F.col(id_col).cast("bigint").alias("id"))
    n = ids.count()
    n_bounds = max(1, min(BOUNDS, n // BUCKET_ROWS))
    bounds = ids.agg(F.percentile_approx("id", [i / n_bounds for i in range(n_bounds + 1)], 20 * BOUNDS)).first()[0] or [0, 0]
    fine = max(1, n // (n_bounds * BUCKET_ROWS))
    id_ = F.coalesce(F.col(id_col).cast("bigint"), F.lit(bounds[0] - 1))
    bounds = sorted({*bounds})
    lows = F.lit([float(b) for b in bounds[:-1] or bounds])
    at = F.greatest(F.lit(1), F.size(F.filter(F.lit(bounds[:-1] or bounds), lambda b: b <= id_)))
    low = F.element_at(lows, at)
    high = F.coalesce(F.get(F.lit([float(b) for b in bounds]), at), low + 1)
    part = F.greatest(F.lit(0), F.least(F.lit(fine - 1), F.floor((id_ - low) / F.greatest(high - low, F.lit(1.0)) * fine)))
    rows = docs.withColumn("bucket", (at * fine + part).cast("bigint"))
    firsts = rows.groupBy("bucket").agg(F.max(id_).alias("first")).withColumn("range", F.expr(f"bucket div {fine}"))
    edges = firsts.groupBy("range").agg(F.min("bucket").alias("lowest_"))  # a line per range, BOUNDS at most
    edges = edges.select("range", F.lag("lowest_").over(W.orderBy(F.col("range").desc())).alias("above"), F.min("lowest_").over(W.partitionBy()).alias("lowest"))
    within = F.lag("bucket").over(W.partitionBy("range").orderBy(F.col("bucket").desc()))
    before = firsts.withColumn("within", within).join(F.broadcast(edges), "range").select("first", F.coalesce("within", "above").alias("before"), "lowest")
    visits = before.select(F.col("first").alias("first_"), F.coalesce("before", "lowest").alias("bucket"))
    guests = docs.withColumn("first_", id_).join(visits, "first_").drop("first_").select(*docs.columns, "bucket", F.lit(True).alias("visitor"))
    return rows.withColumn("visitor", F.lit(False)).unionByName(guests)


def fingerprints_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, text, edited, chosen, edited_chosen, next_hashes) of each row.

    `edited` is the text with its last floor(n/2) code points replaced by the first as many (or all) of the next row's
    text, by descending id, after the last the first. chosen and edited_chosen are packed choices of winnow(). A null
    text counts as empty; a null id comes last; rows with one id are ordered by their text's hash; a single row is
    its own successor; an empty table gives no rows. Other columns are dropped. Each text is shuffled once.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    span = K + WINDOW - 1  # code points of a window
    half = (F.char_length("text") / 2).cast("int")
    both = with_next(rows, "id").withColumn("tie", F.xxhash64("text")).withColumn("half", half).withColumn("kept", F.char_length("text") - F.col("half"))
    both = both.withColumn("same", F.greatest(F.lit(0), F.col("kept") - (span - 1)))
    w = W.partitionBy("bucket").orderBy("visitor", F.col("id").desc_nulls_last(), "tie")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.col("kept")), F.substring(F.coalesce(F.lead("text").over(w), F.lit("")), F.lit(1), F.col("half")))
    df = minima(both.withColumn("edited", edited), "text", "chosen")
    # windows that lie in the kept half are those of the text, windows that lie behind it those of the next text: only the ones across are hashed anew
    behind = F.char_length("edited") - F.col("kept")
    df = df.withColumn("behind", behind).withColumn("across", F.substring(F.col("edited"), F.col("same") + 1, F.when(behind >= span, F.col("kept") - F.col("same") + span - 1).otherwise(F.char_length("edited"))))
    df = minima(df, "across", "across_chosen", before=F.col("same"))
    df = df.withColumn("end", F.when(behind >= span, F.substring(F.col("edited"), F.char_length("edited") - span + 1, F.lit(span))))
    df = minima(df, "end", "end_chosen").withColumn("mine", F.array_distinct("chosen"))
    df = df.withColumn("next_chosen", F.lead("mine").over(w))
    # choices of windows in order stand in order, so those of the windows in the part taken over end with its last window's
    last = F.col("behind") - span + F.get(positions(F.col("end_chosen")), F.lit(0))
    place = lambda x: F.lit(LAST).cast("bigint") - x.bitwiseAND(F.lit(LAST).cast("bigint"))
    taken = F.when(F.col("behind") >= span, F.transform(F.filter("next_chosen", lambda x: place(x) <= last), lambda x: x - F.col("kept"))).otherwise(F.lit([]).cast("array<bigint>"))
    df = df.withColumn("edited_chosen", F.array_distinct(F.concat(F.slice("chosen", 1, F.col("same")), "across_chosen", taken)))
    return df.filter("not visitor").select(F.col("id").alias(id_col), "text", "edited", F.col("mine").alias("chosen"), "edited_chosen", F.array_distinct(hashes(F.col("next_chosen"))).alias("next_hashes"))
