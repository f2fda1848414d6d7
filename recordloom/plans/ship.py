"""Makes the package importable on the executors when the session was started somewhere else."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[2]


def ship(spark: SparkSession) -> None:
    """Sends the package to the executors, once a context, unless they find it by their working folder or PYTHONPATH."""
    if str(ROOT) in os.environ.get("PYTHONPATH", "").split(os.pathsep) or Path.cwd() == ROOT:
        return
    sc = spark.sparkContext
    if getattr(sc, "_recordloom_sent", False):
        return
    archive = Path(tempfile.mkdtemp(prefix="recordloom-")) / "recordloom.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted((ROOT / "recordloom").rglob("*.py")):
            out.write(path, path.relative_to(ROOT))
    sc.addPyFile(str(archive))
    sc._recordloom_sent = True
