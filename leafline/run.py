"""A whole run: recorded page answers and expected items in, documents and a manifest out.

    python -m leafline.run --pages DIR --expected DIR --out DIR [--subject S] [--limit N] [--production] [--fail-on-review]

Exit status: 0; 1 if a document failed; 2 with --fail-on-review if one needs review, or with --production if one is not ready.
"""

from __future__ import annotations

import argparse
import dataclasses
import importlib.util
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafline import ship
from leafline.operators import extraction
from leafline.sources import files

SCHEMA_VERSION = "leafline.document.v1"


@dataclasses.dataclass(frozen=True)
class RunConfig:
    pages: str
    expected: str
    out: str
    subject: str | None = None
    limit: int | None = None
    production: bool = False
    fail_on_review: bool = False
    overwrite: bool = False

    def __post_init__(self) -> None:
        if self.limit is not None and self.limit < 1:
            raise ValueError("limit must be 1 or more")


def doctor() -> dict[str, bool]:
    """What of the optional libraries is there."""
    return {name: importlib.util.find_spec(name) is not None for name in ("cv2", "PIL", "numpy", "pandas", "pyarrow")}


def manifest(documents: DataFrame) -> DataFrame:
    """One row: how many documents are ready, need review and failed, and the sums of their slots."""
    failed = F.col("items").isNull()
    return documents.agg(
        F.lit(SCHEMA_VERSION).alias("schema_version"), F.count(F.lit(1)).alias("documents"), F.count_if("production_ready").alias("ready"), F.count_if(failed).alias("failed"), F.count_if(~F.col("production_ready") & ~failed).alias("needing_review"),
        *[F.sum(c).alias(c) for c in ("expected_slots", "recognized_slots", "blank_slots", "unresolved_slots")],
    )


def run(spark: SparkSession, config: RunConfig) -> dict:
    """Writes out/documents (JSON, a folder per subject) and out/manifest.json's row; returns that row."""
    ship(spark)
    expected = spark.read.parquet(config.expected)
    if config.subject is not None:
        expected = expected.filter(F.col("subject") == config.subject)
    if config.limit is not None:
        first = expected.select("subject", "document_id").distinct().orderBy("subject", "document_id").limit(config.limit)
        expected = expected.join(first, ["subject", "document_id"], "left_semi")
    subjects = expected.select("document_id", "subject").distinct()
    if subjects.isEmpty():
        raise ValueError("no document is selected")
    pages = spark.read.parquet(config.pages).join(subjects.select("document_id"), "document_id", "left_semi")
    documents = extraction.readiness(pages, expected).join(subjects, "document_id")
    files.write_documents(documents, f"{config.out}/documents", overwrite=config.overwrite)
    written = spark.read.schema(documents.schema).json(f"{config.out}/documents")
    row = manifest(written)
    row.coalesce(1).write.mode("overwrite" if config.overwrite else "errorifexists").json(f"{config.out}/manifest")
    return row.first().asDict()


def exit_status(row: dict, config: RunConfig) -> int:
    if row["failed"]:
        return 1
    return 2 if row["needing_review"] and (config.fail_on_review or config.production) else 0


def main(args: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    for name in ("pages", "expected", "out"):
        parser.add_argument(f"--{name}", required=True)
    parser.add_argument("--subject")
    parser.add_argument("--limit", type=int)
    for name in ("production", "fail-on-review", "overwrite"):
        parser.add_argument(f"--{name}", action="store_true")
    config = RunConfig(**vars(parser.parse_args(args)))
    return exit_status(run(SparkSession.builder.getOrCreate(), config), config)


if __name__ == "__main__":
    sys.exit(main())
