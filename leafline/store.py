"""Tables that outlive a run, in a folder that all machines share, written part by part."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Where that is unset, a temporary one on one machine, as in tests; an error on a cluster."""
    known = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not known:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir is not set: it has to name a folder that all machines share")
        known = "file://" + tempfile.mkdtemp(prefix="leafline-")
        spark.conf.set("spark.checkpoint.dir", known)
    return known.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _names(spark: SparkSession, path: str) -> list[str]:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001
    files = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())  # noqa: SLF001
    return sorted(f.getPath().getName() for f in files.listStatus(at)) if files.exists(at) else []


def parts(spark: SparkSession, folder: str) -> list[str]:
    """Names of the parts of a folder whose writing came to its end."""
    return [n for n in _names(spark, folder) if "_SUCCESS" in _names(spark, f"{folder}/{n}")]


def put(rows: DataFrame, folder: str, part: str) -> DataFrame:
    """rows as that part, in place of what an earlier run left there; a part counts once its writing has ended."""
    spark, path = rows.sparkSession, f"{folder}/{part}"
    rows.write.mode("overwrite").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def get(spark: SparkSession, folder: str, schema: str, names: list[str] | None = None) -> DataFrame:
    """All ended parts, or those named, as one table; an empty one if there are none."""
    known = parts(spark, folder) if names is None else names
    return spark.read.schema(schema).parquet(*[f"{folder}/{n}" for n in known]) if known else spark.createDataFrame([], schema)
