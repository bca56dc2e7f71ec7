"""Makes the package importable in the Python workers of a cluster that has not installed it."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_HERE = Path(__file__).resolve().parent


def ship(spark: SparkSession) -> SparkSession:
    """Sends the package's source as a zip file to all executors, once per context; returns the session."""
    sc = spark.sparkContext
    if not getattr(sc, "_chunkloom_shipped", False):
        target = Path(tempfile.mkdtemp(prefix="chunkloom-")) / "chunkloom.zip"
        with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
            for f in sorted(_HERE.rglob("*.py")):
                z.write(f, f.relative_to(_HERE.parent).as_posix())
        sc.addPyFile(str(target))
        sc._chunkloom_shipped = True
    return spark
