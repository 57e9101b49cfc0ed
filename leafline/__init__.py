"""leafline: a PySpark-native engine for hierarchical document data."""

import os
from pathlib import Path

__version__ = "0.1.0"


def ship(spark):
    """The session, with this package importable in its Python workers where they see the driver's files; a cluster installs it."""
    root = str(Path(__file__).resolve().parents[1])
    known = spark.sparkContext.environment
    paths = [p for p in known.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        known["PYTHONPATH"] = os.pathsep.join([root, *paths])
    return spark
