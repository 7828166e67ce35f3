"""Sending this package to the Python workers of a session, wherever the driver was started from."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SENT: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Add the package's sources to the session's Python files, once per application; Spark fetches them to executors."""
    app = spark.sparkContext.applicationId
    if app in _SENT:
        return
    root = Path(__file__).resolve().parent.parent
    folder = tempfile.mkdtemp(prefix="citeloom-package-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = os.path.join(folder, f"{root.name}.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, source.relative_to(root.parent))
    spark.sparkContext.addPyFile(path)
    _SENT.add(app)
