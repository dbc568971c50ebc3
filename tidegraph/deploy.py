"""Brings the package to Python workers that can't import it from their own path."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends the package to all workers of this application, once, unless PYTHONPATH has it there."""
    package = Path(__file__).resolve().parent
    sc = spark.sparkContext
    if sc.applicationId in _shipped or str(package.parent) in os.environ.get("PYTHONPATH", "").split(os.pathsep) or not package.is_dir():
        return
    at = os.path.join(tempfile.mkdtemp(prefix="package-"), f"{package.name}.zip")
    with zipfile.ZipFile(at, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(at)
    _shipped.add(sc.applicationId)
