"""Sends the package to the executors, for sessions whose workers can't import it."""

from __future__ import annotations

import pathlib
import tempfile
import zipfile

from pyspark.sql import SparkSession

_done: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Adds the package to the session's Python files, once; Spark's own file server deals it out."""
    sc = spark.sparkContext
    if sc.applicationId in _done:
        return
    root = pathlib.Path(__file__).resolve().parent
    if not root.is_dir():  # it was imported from such a file already
        return
    path = pathlib.Path(tempfile.mkdtemp(prefix="stratamend-ship-")) / "stratamend.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(path))
    _done.add(sc.applicationId)
