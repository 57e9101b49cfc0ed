"""Tables written in the folder all machines share, to cut lineage and to reuse."""

from __future__ import annotations

import contextlib
import contextvars
import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafline import ship

#: Bits of the filter of likely(); when full it lets all rows pass.
FILTER_BITS = 1 << 23


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Where that is unset, a temporary one on one machine, as in tests; an error on a cluster."""
    known = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not known:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir is not set: it has to name a folder that all machines share")
        known = "file://" + tempfile.mkdtemp(prefix="leafline-")
        spark.conf.set("spark.checkpoint.dir", known)
    return known.rstrip("/")


#: Rows of one batch between Spark and Python: whole documents are large, Spark's own number is made for small rows.
BATCH_ROWS = 1000


def tune(spark: SparkSession) -> SparkSession:
    """The session, with batches sized for documents unless they were sized already."""
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return ship(spark)


def trim() -> None:
    """Gives memory that a worker no longer uses back to the machine, where its C library can."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        return


#: Paths made within passing().
_made: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("made", default=None)


def new_path(spark: SparkSession, name: str) -> str:
    path, made = f"{shared_dir(spark)}/leafline-{name}-{uuid.uuid4().hex}", _made.get()
    if made is not None:
        made.append(path)
    return path


@contextlib.contextmanager
def passing(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Tables written within are deleted at its end, but for those given to the function it yields."""
    made: list[str] = []
    kept: set[str] = set()
    token = _made.set(made)

    def keep(df: DataFrame) -> DataFrame:
        kept.add(df._leafline_path)  # noqa: SLF001
        return df

    try:
        yield keep
    finally:
        _made.reset(token)
        for path in made:
            if path not in kept:
                drop_path(spark, path)


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder: computed once, kept when executors are lost."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._leafline_path = path  # noqa: SLF001
    return out


def remove(df: DataFrame) -> None:
    """Deletes a table made by written() that no later plan reads."""
    drop_path(df.sparkSession, df._leafline_path)  # noqa: SLF001


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001
    files = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())  # noqa: SLF001
    return [f.getPath().getName() for f in files.listStatus(at)] if files.exists(at) else []


def path_exists(spark: SparkSession, path: str) -> bool:
    return bool(children(spark, path))


def drop_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm  # noqa: SLF001
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)  # noqa: SLF001


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tune(spark).read.parquet(f"{sf_dir}/documents.parquet")


#: Tasks among which the rows of one group are spread.
SALTS = 16


def salted_join(rows: DataFrame, per_group: DataFrame, key: str, spread: str) -> DataFrame:
    """rows with the columns of per_group, which has a line per key: each line goes to SALTS tasks, and a group's rows among them by the hash of `spread`."""
    line = per_group.withColumn("salt_", F.explode(F.array(*[F.lit(i).cast("bigint") for i in range(SALTS)])))
    return rows.withColumn("salt_", F.pmod(F.xxhash64(spread), F.lit(SALTS))).join(line, [key, "salt_"]).drop("salt_")


def likely(df: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of df whose keys may be among those of wanted: all that are and a few others, so a join after it shuffles little.

    The filter that is broadcast has at most FILTER_BITS / 64 lines.
    """
    bit = F.pmod(F.xxhash64(*keys), F.lit(FILTER_BITS))
    bits = wanted.select(bit.alias("bit_")).groupBy(F.expr("bit_ div 64").alias("word_")).agg(F.expr("bit_or(shiftleft(1L, cast(bit_ % 64 as int)))").alias("bits_"))
    met = df.withColumn("bit_", bit).withColumn("word_", F.expr("bit_ div 64")).join(F.broadcast(bits), "word_")
    return met.filter("getbit(bits_, bit_ % 64) = 1").select(*df.columns)


def without(df: DataFrame, dropped: DataFrame, keys: list[str], checked: DataFrame | None = None) -> DataFrame:
    """Rows of df whose keys are not among those of dropped, nulls being equal to one another.

    Rows that the filter of likely() clears stay where they are; only the others are shuffled for an exact check.
    Rows whose keys are in `checked` are sure to be among those others.
    """
    care = dropped.select(*keys) if checked is None else dropped.select(*keys).unionByName(checked.select(*keys))
    bit = F.pmod(F.xxhash64(*keys), F.lit(FILTER_BITS))
    bits = care.select(bit.alias("bit_")).groupBy(F.expr("bit_ div 64").alias("word_")).agg(F.expr("bit_or(shiftleft(1L, cast(bit_ % 64 as int)))").alias("bits_"))
    met = df.withColumn("bit_", bit).withColumn("word_", F.expr("bit_ div 64")).join(F.broadcast(bits), "word_", "left")
    hit = F.coalesce(F.expr("getbit(bits_, bit_ % 64)") == 1, F.lit(False))
    gone = dropped.select(*[F.col(k).alias(f"gone_{i}") for i, k in enumerate(keys)]).distinct()
    same = [F.col(k).eqNullSafe(F.col(f"gone_{i}")) for i, k in enumerate(keys)]
    # an outer join, as Spark would push an anti join below the filter
    checked_rows = met.filter(hit).select(*df.columns).join(gone.withColumn("gone_", F.lit(1)), same, "left").filter("gone_ is null").select(*df.columns)
    if checked is not None:
        checked_rows = checked_rows.dropDuplicates(keys)
    return met.filter(~hit).select(*df.columns).unionByName(checked_rows)


def place_in_files(df: DataFrame, rows: int) -> Column | None:
    """A long that names runs of about `rows` rows lying together in df's files; None if df does not read files."""
    place = F.xxhash64("_metadata.file_path", F.floor(F.col("_metadata.row_index") / rows))
    try:
        df.select(place)
    except AnalysisException:
        return None
    return place
