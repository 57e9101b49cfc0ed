"""JSON documents as tables of their nodes, and closed-world checks of nested objects and arrays on them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafline import store

#: How the kinds of a schema are called among Spark's types of variants.
KINDS = {"object": ("OBJECT",), "array": ("ARRAY",), "string": ("STRING",), "int": ("BIGINT",), "number": ("BIGINT", "DECIMAL", "DOUBLE"), "boolean": ("BOOLEAN",), "null": ("VOID",)}
FAULTS = "array<struct<path: string, fault: string>>"


def _kind(value: Column) -> Column:
    return F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)


def json_nodes(rows: DataFrame, keys: list[str], column: str, folder: str, most_levels: int = 100) -> DataFrame:
    """(keys, path, pattern, parent, parent_path, depth, ord, name, kind, value) of every node of a JSON column, by levels until one has no containers.

    path is that of the node, pattern the same with [] for every place of an array; the root's is $. kind is OBJECT,
    ARRAY, STRING, BIGINT, DECIMAL, DOUBLE, BOOLEAN or VOID; value is the node as JSON. A text that is no JSON, or null,
    has no node. Each level is written to the folder, as text (tables of variants are shredded to one type a column), and
    read for the next one. More levels than most_levels are an error.
    """
    spark = rows.sparkSession
    null = F.lit(None)
    root = rows.select(
        *keys, F.lit("$").alias("path"), F.lit("$").alias("pattern"), null.cast("string").alias("parent"), null.cast("string").alias("parent_path"), F.lit(0).alias("depth"),
        F.lit(0).alias("ord"), null.cast("string").alias("name"), F.try_parse_json(column).alias("value"),
    ).filter("value is not null")
    shown = lambda df: df.withColumn("kind", _kind(F.col("value"))).withColumn("value", F.to_json("value"))
    level = store.put(shown(root), folder, "level=0")
    levels = ["level=0"]
    while not (within := level.filter("kind in ('OBJECT', 'ARRAY')")).isEmpty():
        if len(levels) > most_levels:
            raise ValueError(f"more than {most_levels} levels")
        up = within.select(*keys, F.col("path").alias("parent_path"), F.col("pattern").alias("parent"), "depth", F.parse_json("value").alias("held"))
        each = up.lateralJoin(spark.tvf.variant_explode(F.col("held").outer()))
        step = lambda base, place: F.when(F.col("key").isNotNull(), F.concat(base, F.lit("."), "key")).otherwise(F.concat(base, F.lit("["), place, F.lit("]")))
        down = each.select(
            *keys, step(F.col("parent_path"), F.col("pos").cast("string")).alias("path"), step(F.col("parent"), F.lit("")).alias("pattern"), "parent", "parent_path", (F.col("depth") + 1).alias("depth"),
            F.col("pos").alias("ord"), F.col("key").alias("name"), "value",
        )
        levels.append(f"level={len(levels)}")
        level = store.put(shown(down), folder, levels[-1])
    return spark.read.schema(level.schema).parquet(*[f"{folder}/{n}" for n in levels])


def patterns(schema: dict | list | str, at: str = "$", name: str | None = None, parent: str | None = None, required: bool = True) -> list[tuple]:
    """(pattern, kind, parent, name, required) of a schema: an object is a dict of its keys, of which those that end in ? may lack; an array is a list of the one schema of its elements; all else is a kind."""
    kind = "object" if isinstance(schema, dict) else "array" if isinstance(schema, list) else schema
    if kind != "any" and kind not in KINDS:
        raise ValueError(f"unknown kind {kind!r}")
    out = [(at, kind, parent, name, required)]
    if kind == "object":
        for k, s in schema.items():
            key = k.removesuffix("?")
            out += patterns(s, f"{at}.{key}", key, at, not k.endswith("?"))
    if kind == "array":
        out += patterns(schema[0], f"{at}[]", None, at, False)
    return out


def _faults(value: Column, path: Column, schema: dict | list | str) -> Column:
    """array<struct<path, fault>> of a node and of what the schema knows below it. Null, without the node, makes null."""
    kind = "object" if isinstance(schema, dict) else "array" if isinstance(schema, list) else schema
    none = F.array().cast(FAULTS)
    fault = lambda at, name: F.struct(at.alias("path"), F.lit(name).alias("fault"))
    if kind == "any":
        return none
    # a container's kind is told by opening it, as schema_of_variant reads all that it holds
    opened = lambda as_, use: _with(F.try_variant_get(value, "$", as_), lambda held: F.when(held.isNull(), wrong).otherwise(use(held)))
    wrong = F.array(fault(path, "WRONG_TYPE"))
    if kind == "object":
        of = {k.removesuffix("?"): (v, not k.endswith("?")) for k, v in schema.items()}

        def within(held: Column) -> Column:
            at = lambda k: F.concat(path, F.lit("."), k)
            keys = F.map_keys(held)
            missing = F.transform(F.array_except(F.array(*[F.lit(k) for k, (_, needed) in of.items() if needed]).cast("array<string>"), keys), lambda k: fault(at(k), "MISSING_KEY"))
            unknown = F.transform(F.filter(keys, lambda k: ~k.isin(*of)) if of else keys, lambda k: fault(at(k), "UNKNOWN_KEY"))
            below = [F.when(F.map_contains_key(held, k), _faults(F.element_at(held, k), at(F.lit(k)), v)).otherwise(none) for k, (v, _) in of.items() if v != "any"]
            return F.concat(missing, unknown, *below)

        return opened("map<string, variant>", within)
    if kind == "array":
        each = lambda v, n: _faults(v, F.concat(path, F.lit("["), n.cast("string"), F.lit("]")), schema[0])
        return opened("array<variant>", lambda held: F.flatten(F.transform(held, each)))
    return F.when(_kind(value).isin(*KINDS[kind]), none).otherwise(wrong)


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), which is made once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def closed_world_faults(rows: DataFrame, keys: list[str], column: str, schema: dict | list, folder: str | None = None) -> DataFrame:
    """(keys, path, fault) of every departure of a JSON column from a schema that names all that may be there.

    NOT_JSON for a text that is none or null; WRONG_TYPE of a node; UNKNOWN_KEY of a node in an object that should not
    have it, whatever lies below it; MISSING_KEY where an object lacks a key, as the path it should have. A text is
    parsed once and followed as far down as the schema goes, in the row where it lies: nothing is shuffled or written,
    and `folder` is not needed.
    """
    patterns(schema)  # tells of unknown kinds
    value = F.col("value_")
    parsed = rows.select(*keys, F.try_parse_json(column).alias("value_"))
    not_json = F.array(F.struct(F.lit("$").alias("path"), F.lit("NOT_JSON").alias("fault")))
    found = F.when(value.isNull(), not_json).otherwise(_faults(value, F.lit("$"), schema))
    return parsed.select(*keys, F.inline(found))
