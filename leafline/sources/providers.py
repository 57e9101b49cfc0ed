"""Model and recognition back ends behind one interface: none, replayed answers, or a function of one's own."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ANSWERS = "key string, status string, response string"


def none(requests: DataFrame) -> DataFrame:
    """Requests (key, prompt) unanswered."""
    return requests.select("key", F.lit("UNAVAILABLE").alias("status"), F.lit(None).cast("string").alias("response"))


def replayed(requests: DataFrame, recorded: DataFrame) -> DataFrame:
    """Recorded answers (key, response) of requests; those without one are MISSING."""
    met = requests.select("key").join(recorded.select("key", "response").dropDuplicates(["key"]), "key", "left")
    return met.select("key", F.when(F.col("response").isNull(), "MISSING").otherwise("OK").alias("status"), "response")


def called(requests: DataFrame, call: Callable[[str], str], attempts: int = 2) -> DataFrame:
    """Answers of call(prompt), tried `attempts` times; equal prompts are asked once, cached by their hash."""
    asked = requests.select("key", F.sha2("prompt", 256).alias("hash"), "prompt")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for h, prompt in zip(pdf["hash"], pdf["prompt"]):
                status, response = "FAILED", None
                for _ in range(max(1, min(3, attempts))):
                    try:
                        status, response = "OK", call(prompt)
                        break
                    except (OSError, ValueError, TimeoutError):
                        continue
                out.append((h, status, response))
            yield pd.DataFrame(out, columns=["hash", "status", "response"])

    answers = asked.select("hash", "prompt").dropDuplicates(["hash"]).mapInPandas(run, "hash string, status string, response string")
    return asked.join(answers, "hash").select("key", "status", "response")


def checked_batch(returned: DataFrame, expected: DataFrame) -> DataFrame:
    """(batch, slot_id, outcome) of a batched answer: an unknown or repeated id rejects its batch; a missing one is to be retried."""
    known = expected.select("batch", "slot_id").withColumn("known_", F.lit(True))
    rows = returned.select("batch", "slot_id").groupBy("batch", "slot_id").agg(F.count(F.lit(1)).alias("n_")).join(known, ["batch", "slot_id"], "left")
    bad = rows.groupBy("batch").agg(F.bool_or(F.col("known_").isNull() | (F.col("n_") > 1)).alias("bad_"))
    out = expected.select("batch", "slot_id").join(rows.select("batch", "slot_id", "n_"), ["batch", "slot_id"], "left").join(bad, "batch", "left")
    return out.select("batch", "slot_id", F.when(F.coalesce("bad_", F.lit(False)), "REJECTED").when(F.col("n_").isNull(), "RETRY").otherwise("ACCEPTED").alias("outcome"))
