"""Where queries and their SQL twins are registered, and helpers to write them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafline import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function of (table) under its name; `sql` is its twin."""

    def add(f: Callable[[Callable[[str], DataFrame]], DataFrame]) -> Callable:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return f(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))

        QUERIES[f.__name__] = run
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def long(c: Column) -> Column:
    return c.cast("bigint")


def pick(number: Column, values: list[str | None]) -> Column:
    """One of the values by a number, in turn: texts of a shape that the tables lack."""
    return F.element_at(F.array(*[F.lit(v).cast("string") for v in values]), (F.pmod(number, F.lit(len(values))) + 1).cast("int"))


def pick_sql(number: str, values: list[str | None]) -> str:
    """pick() in SQL."""
    quoted = ", ".join("NULL" if v is None else "'" + v.replace("'", "''") + "'" for v in values)
    return f"([{quoted}])[({number}) % {len(values)} + 1]"
