"""Stored trees, templates, review events and settings: small files that the driver reads and writes."""

from __future__ import annotations

import json
import os
import sqlite3
import stat
from contextlib import closing
from datetime import datetime, timezone
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafline.functions import boxes
from leafline.functions.parsing import hash_of
from leafline.sources.files import write_json

EVENTS = "item_id string, delta_x double, delta_y double, delta_w double, delta_h double"
DELTAS = ("delta_x", "delta_y", "delta_w", "delta_h")
#: A tree's states.
LOCKED, DRAFT = "LOCKED", "DRAFT"


def read_template(spark: SparkSession, path: str) -> DataFrame:
    """(place, page): the pages, as JSON, of a template file; ValueError for one that is no object with an array of pages."""
    try:
        data = json.loads(Path(path).read_text(encoding="utf-8"))
    except (OSError, ValueError) as e:
        raise ValueError(f"template cannot be read: {path}: {e}") from e
    if not isinstance(data, dict) or not isinstance(data.get("pages"), list):
        raise ValueError(f"{path}: a template is an object with an array of pages")
    return spark.createDataFrame([(i, json.dumps(p, ensure_ascii=False)) for i, p in enumerate(data["pages"])], "place int, page string")


def write_template(pages: list[dict], path: str, source: str) -> None:
    write_json({"source": source, "pages": pages}, path)


def tree_path(place: str, subject: str) -> Path | None:
    """The file itself, or that of the subject in a folder; None if there is none."""
    at = Path(place)
    if at.is_dir():
        at = at / ("".join(c if c.isalnum() or c in "._-" else "_" for c in subject).strip("_") + ".json")
    return at if at.is_file() else None


def save_tree(tree: dict, path: str, errors: list[str], readiness: list[str], lock: bool = True) -> dict:
    """Writes the tree whole or not at all, with its state, time and fingerprint, and returns it.

    It is locked if asked for and nothing is open; ValueError if it has errors then, a draft if it is only not ready.
    """
    if lock and errors:
        raise ValueError("tree has errors: " + "; ".join(errors))
    out = dict(tree) | {"updated_at": datetime.now(timezone.utc).astimezone().isoformat(timespec="seconds"), "state": LOCKED if lock and not readiness else DRAFT, "validation": {"errors": errors, "readiness_issues": readiness}}
    out["fingerprint"] = hash_of(out)
    write_json(out, path)
    return out


def load_tree(path: str, subject: str | None = None, draft: bool = False) -> dict:
    """A stored tree; ValueError for another subject, one that is not locked (unless drafts do), or one changed since its fingerprint was taken."""
    tree = json.loads(Path(path).read_text(encoding="utf-8"))
    if subject and str(tree.get("subject")) != subject:
        raise ValueError(f"tree is for {tree.get('subject')}, not {subject}")
    if tree.get("state") != LOCKED and not draft:
        raise ValueError("tree is not locked")
    if tree.get("fingerprint") and tree["fingerprint"] != hash_of(tree):
        raise ValueError("tree was changed after its fingerprint was taken")
    return tree


def read_events(spark: SparkSession, database: str) -> DataFrame:
    """Review events (item_id and four shifts) of an SQLite file, which is opened for reading only; none without the file or its table."""
    rows: list[tuple] = []
    if Path(database).is_file():
        try:
            with closing(sqlite3.connect(f"file:{Path(database).resolve()}?mode=ro", uri=True)) as connection:
                rows = connection.execute(f"SELECT item_id, {', '.join(DELTAS)} FROM hitl_audit_events").fetchall()
        except sqlite3.Error:
            rows = []
    return spark.createDataFrame([(str(r[0]), *(None if v is None else float(v) for v in r[1:])) for r in rows], EVENTS)


def feedback(events: DataFrame) -> DataFrame:
    """(item_id, the median of each shift, samples)."""
    return events.groupBy("item_id").agg(*[F.median(d).alias(d) for d in DELTAS], F.count(F.lit(1)).alias("samples"))


def with_feedback(slots: DataFrame, profiles: DataFrame, box: str = "box", limit: float = 80.0) -> DataFrame:
    """slots with their boxes shifted by their item's feedback, each shift within the limit; as they are without any."""
    moved = boxes.shifted(F.col(box), *[F.col(d) for d in DELTAS], limit=limit)
    return slots.join(profiles, "item_id", "left").withColumn(box, F.when(F.col("samples") > 0, moved).otherwise(F.col(box))).select(*slots.columns)


def settings(names: tuple[str, ...], path: str | None = None, environment: dict[str, str] | None = None) -> dict[str, str]:
    """Values of the named settings, from NAME=value lines of a file that its owner alone may read, then from the environment; other names are passed over."""
    known: dict[str, str] = {}
    if path and Path(path).is_file():
        if stat.S_IMODE(os.stat(path).st_mode) & 0o077:
            raise PermissionError(f"{path}: others than its owner may read it")
        for line in Path(path).read_text(encoding="utf-8").splitlines():
            name, eq, value = line.partition("=")
            if eq and name.strip() in names and not name.lstrip().startswith("#"):
                known[name.strip()] = value.strip().strip("\"'")
    environment = dict(os.environ) if environment is None else environment
    return known | {n: environment[n] for n in names if environment.get(n)}
