"""Evaluation of extractions against truth: `python -m leafline.evaluate --truth T --predicted P --out O [--cases C]`.

T and P are folders with Parquet tables `questions`, `items` and `slots`, as leafline.operators.evaluation names them; C
is a table (case_id, subject, layout, pages, cohort_samples). Writes O/cases and, with C, O/groups as JSON.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from leafline import ship
from leafline.operators import evaluation


def run(spark: SparkSession, truth: str, predicted: str, out: str, cases: str | None = None) -> str:
    """COMPLETE, or PARTIAL if a case of the table has no counts."""
    ship(spark)
    read = lambda folder, name: spark.read.parquet(f"{folder}/{name}")
    counted = evaluation.counts(*(read(f, n) for n in ("questions", "items", "slots") for f in (truth, predicted)))
    evaluation.metrics(counted).write.mode("overwrite").json(f"{out}/cases")
    if cases is None:
        return "COMPLETE"
    table = spark.read.parquet(cases)
    evaluation.by_dataset(table, counted).write.mode("overwrite").json(f"{out}/groups")
    return "COMPLETE" if table.join(counted, "case_id", "left_anti").isEmpty() else "PARTIAL"


def main(args: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    for name in ("truth", "predicted", "out"):
        parser.add_argument(f"--{name}", required=True)
    parser.add_argument("--cases")
    return 0 if run(SparkSession.builder.getOrCreate(), **vars(parser.parse_args(args))) == "COMPLETE" else 1


if __name__ == "__main__":
    sys.exit(main())
