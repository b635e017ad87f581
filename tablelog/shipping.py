"""Python workers import this package by name: hand it to them where they don't have it."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package's source to the executors, once an application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    _shipped.add(app)
    root = Path(__file__).resolve().parent
    if not root.is_dir():
        return  # it runs from an archive that was sent already
    # the workers that plan a streaming source run beside the driver and take no sent files: they find the folder itself
    paths = [str(root.parent), *filter(None, spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep))]
    spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(dict.fromkeys(paths))
    target = Path(tempfile.mkdtemp(prefix="tablelog-source-")) / "tablelog-source.zip"
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(target))
