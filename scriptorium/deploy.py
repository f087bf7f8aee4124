"""Brings this package to the executors' Python, wherever the driver found it."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Once for each application: the package as an archive that Spark hands out."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    package = Path(__file__).resolve().parent
    with tempfile.TemporaryDirectory() as folder:
        source = Path(folder) / "source"
        shutil.copytree(package, source / package.name, ignore=shutil.ignore_patterns("__pycache__"))
        kept = Path(tempfile.mkdtemp(prefix="scriptorium-")) / package.name  # Spark serves it from here as long as it runs
        spark.sparkContext.addPyFile(shutil.make_archive(str(kept), "zip", source))
    _shipped.add(application)
