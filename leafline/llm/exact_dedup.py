"""Exact deduplication as a stateful stream.

Each distinct text has a key (its digest and byte length) in a disk-backed state store that never expires; the state
retains the digest, the identifier of the row that stays and that row's content locator. Rows whose digest was met
more than once have their full bytes compared; texts that differ in spite of an equal digest are told apart by the
texts themselves. exact_dedup() takes one table and leaves nothing; exact_dedup_batch() goes on from a folder that holds
the state and the contents of all batches before.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leafline.llm.storage import children, likely, new_path, written

#: Fixed values.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Micro-batches that one table is gathered in: the state carries the groups from one to the next.
ROUNDS = 2
#: Names of the settings of the state store while the stream runs.
STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "128",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all else as it is. Texts of ASCII alone take Spark's faster lower()."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def text_digest(text: Column) -> Column:
    """The `digest` that exact_dedup gives a text by default."""
    return sha256(ascii_lower(F.coalesce(text.cast("string"), F.lit(""))))


def _own_session(spark: SparkSession) -> SparkSession:
    """A session with the settings of the given one and those of the state store, so streams side by side don't disturb each other's."""
    own = spark.newSession()
    for k, v in spark.conf.getAll.items():
        if own.conf.isModifiable(k):
            own.conf.set(k, v)
    for k, v in STORE.items():  # not known to isModifiable()
        own.conf.set(k, v)
    return own


def _written_out(spark: SparkSession, path: str) -> bool:
    return "_SUCCESS" in children(spark, path)


def _latest(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    """(digest, n_bytes, keep, group_size) as last emitted by micro-batches, of which each has a folder whose name ends in its number."""
    known, locator = schema["id"].dataType.simpleString(), schema["locator"].dataType.simpleString()
    out = f"digest string, n_bytes int, keep struct<id: {known}, locator: {locator}>, group_size bigint, batch bigint"
    if not paths:
        return spark.createDataFrame([], out).drop("batch")
    emitted = spark.read.schema(out).parquet(*paths)
    last = F.max(F.struct("batch", "keep", "group_size")).alias("last")
    return emitted.groupBy("digest", "n_bytes").agg(last).select("digest", "n_bytes", "last.keep", "last.group_size")


def gather(spark: SparkSession, path: str, schema: T.StructType, checkpoint: str, out: str, rounds: int = 1) -> None:
    """Runs the stream over the rows (digest, n_bytes, id, locator) of all files below a folder; its micro-batches, `rounds` or more, write the keys they met to folders of their own.

    The stream goes on from its checkpoint: what it has seen stays in its state, and only new files are read.
    """
    own = _own_session(spark)
    files = sum(n.endswith(".parquet") for n in children(spark, path)) or 1
    state = (
        own.readStream.schema(schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", -(-files // rounds) if rounds > 1 else 1 << 30).parquet(path)
        .groupBy("digest", "n_bytes")
        .agg(F.max(F.struct("id", "locator")).alias("keep"), F.count(F.lit(1)).alias("group_size"))
    )
    query = (
        state.writeStream.outputMode("update")
        .foreachBatch(lambda df, n: df.withColumn("batch", F.lit(n).cast("bigint")).write.mode("overwrite").parquet(f"{out}/{n}"))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def exact_dedup_batch(
    docs: DataFrame,
    state: str,
    batch: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    normalise: Callable[[Column], Column] = ascii_lower,
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """exact_dedup() of a batch against itself and all batches before it, which a folder `state` that all machines share remembers.

    Rows are those of docs alone: keep_id may be of an earlier batch, and a kept row of an earlier batch may since have
    given way to one with a larger id; a null id is smaller than any, in whatever batch. The folder holds the stream's
    checkpoint with its state, which never expires, each row's key, and the contents by locator (batch and row). The text
    at the kept row's locator is fetched, from its batch's files alone, for every digest met more than once and compared
    byte by byte; keys whose texts were found to differ are remembered and told apart by all their texts.

    Batches are numbered from 0; `batch` is the next number by default. A batch is added step by step, each of which
    counts once its folder is written out, so one that was broken off anywhere is given again, with the same rows, and
    goes on where it stood: it is added once. A number that was ended gives its result of then. Other rows under a number
    that was begun are an error, and so is a number beyond the next.
    """
    spark = docs.sparkSession
    ended = sum(_written_out(spark, f"{state}/ended/{n}") for n in children(spark, f"{state}/ended"))
    nth = ended if batch is None else batch
    if nth > ended:
        raise ValueError(f"batch {nth} comes after {ended}, which is not ended")
    name = f"{nth:08d}"
    text = normalise(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    given = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.struct(F.lit(nth).alias("batch"), F.monotonically_increasing_id().alias("row")).alias("locator"))
    given = given.select("*", digest(F.col("text")).alias("digest"), F.octet_length("text").alias("n_bytes"))
    contents = lambda numbers: spark.read.schema(given.schema).parquet(*[f"{state}/contents/{n}" for n in numbers])
    mark = lambda df: df.agg(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("id", "text"), F.lit(1 << 32)))).first()
    if not _written_out(spark, f"{state}/contents/{name}"):
        given.write.mode("overwrite").parquet(f"{state}/contents/{name}")
    elif mark(given) != mark(contents([name])):
        raise ValueError(f"batch {nth} was begun with other rows")
    rows = contents([name])
    keys = rows.select("id", "digest", "n_bytes", "locator")
    if not _written_out(spark, f"{state}/keys/{name}"):
        keys.write.mode("overwrite").parquet(f"{state}/keys/{name}")
    begun = lambda n: f"{state}/begun/{n:08d}"
    micro = lambda path: sorted(int(n) for n in children(spark, path) if n.isdigit())
    if not _written_out(spark, begun(nth)):  # which micro-batch will be the first of this batch
        spark.createDataFrame([(max(micro(f"{state}/checkpoint/commits"), default=-1) + 1,)], "first bigint").write.mode("overwrite").parquet(begun(nth))
    if not _written_out(spark, f"{state}/ended/{name}"):
        gather(spark, f"{state}/keys", keys.schema, f"{state}/checkpoint", f"{state}/groups")
    first = lambda n: spark.read.schema("first bigint").parquet(begun(n)).first()[0]
    until = first(nth + 1) if _written_out(spark, begun(nth + 1)) else 1 << 62
    own = [f"{state}/groups/{k}" for k in micro(f"{state}/groups") if first(nth) <= k < until]
    found = written(_latest(spark, own, keys.schema), "dedup-kept")
    mine = keys.join(found, ["digest", "n_bytes"])
    hits = written(mine.filter("group_size > 1").select("digest", "n_bytes", F.col("keep.locator").alias("locator")).distinct(), "dedup-hits")
    at = [f"{r['n']:08d}" for r in hits.select(F.col("locator.batch").alias("n")).distinct().collect()]  # numbers of batches
    if not _written_out(spark, f"{state}/collided/{name}"):
        kept = likely(contents(at or [name]).select("locator", F.col("text").alias("kept_text")), hits, ["locator"]).join(hits, "locator")
        met = likely(rows.select("digest", "n_bytes", "text"), hits, ["digest", "n_bytes"]).join(kept, ["digest", "n_bytes"])
        met.filter("text <> kept_text").select("digest", "n_bytes").distinct().write.mode("overwrite").parquet(f"{state}/collided/{name}")
    collided = spark.read.schema("digest string, n_bytes int").parquet(*[f"{state}/collided/{n:08d}" for n in range(nth + 1)]).distinct()
    line = lambda df: df.select("id", F.col("keep.id").alias("keep_id"), "group_size", (F.col("locator") == F.col("keep.locator")).alias("kept"), "digest", "n_bytes")
    out = line(mine)
    if not collided.isEmpty():
        again = contents([f"{n:08d}" for n in range(nth + 1)]).join(collided, ["digest", "n_bytes"], "left_semi")
        by_text = again.groupBy("digest", "n_bytes", "text").agg(F.max(F.struct("id", "locator")).alias("keep"), F.count(F.lit(1)).alias("group_size"))
        told = rows.join(collided, ["digest", "n_bytes"], "left_semi").join(by_text, ["digest", "n_bytes", "text"])
        out = out.join(collided, ["digest", "n_bytes"], "left_anti").unionByName(line(told))
    out = written(out, "dedup-batch")
    spark.range(1).write.mode("overwrite").parquet(f"{state}/ended/{name}")
    return out.select(F.col("id").alias(id_col), "keep_id", "group_size", "kept", "digest")


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    normalise: Callable[[Column], Column] = ascii_lower,
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """One row per row of docs: (id_col, keep_id, group_size, kept, digest); of equal normalised texts the row with the largest id stays.

    A null text counts as empty. A null id is smaller than any other. Of rows with the same id and text one stays, and
    all have its id as keep_id. An empty table gives no rows; other columns are dropped. Digests
    are shuffled, and the texts of rows whose digest occurs more than once, combined map-side.
    """
    spark = docs.sparkSession
    text = normalise(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    keys = written(rows.select("id", digest(F.col("text")).alias("digest"), F.octet_length("text").alias("n_bytes"), F.monotonically_increasing_id().alias("locator")), "dedup-keys")
    groups = new_path(spark, "dedup-state")
    gather(spark, keys._leafline_path, keys.schema, new_path(spark, "dedup-stream"), groups, ROUNDS)  # noqa: SLF001
    state = written(_latest(spark, [f"{groups}/{n}" for n in children(spark, groups)], keys.schema), "dedup-kept")
    hits = state.filter("group_size > 1").select("digest", "n_bytes")
    texts = rows.select(digest(F.col("text")).alias("digest"), F.octet_length("text").alias("n_bytes"), "text")
    met = likely(texts, hits, ["digest", "n_bytes"]).join(hits, ["digest", "n_bytes"])  # keys of hits are unique; Spark would push a semi join below the filter
    compared = met.groupBy("digest", "n_bytes").agg(F.min("text").alias("a"), F.max("text").alias("b")).filter("a <> b").select("digest", "n_bytes")
    collided = written(compared, "dedup-collided")
    out = keys.join(state, ["digest", "n_bytes"]).select("id", F.col("keep.id").alias("keep_id"), "group_size", (F.col("locator") == F.col("keep.locator")).alias("kept"), "digest", "n_bytes")
    if not collided.isEmpty():
        again = rows.withColumn("digest", digest(F.col("text"))).withColumn("n_bytes", F.octet_length("text")).withColumn("locator", F.monotonically_increasing_id()).join(collided, ["digest", "n_bytes"], "left_semi")
        again = written(again, "dedup-again")
        by_text = again.groupBy("digest", "n_bytes", "text").agg(F.max(F.struct("id", "locator")).alias("keep"), F.count(F.lit(1)).alias("group_size"))
        split = again.join(by_text, ["digest", "n_bytes", "text"]).select("id", F.col("keep.id").alias("keep_id"), "group_size", (F.col("locator") == F.col("keep.locator")).alias("kept"), "digest", "n_bytes")
        out = out.join(collided, ["digest", "n_bytes"], "left_anti").unionByName(split)
    return out.select(F.col("id").alias(id_col), "keep_id", "group_size", "kept", "digest")
