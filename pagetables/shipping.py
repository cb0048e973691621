"""Bring the package to the workers, wherever the driver was started."""

from __future__ import annotations

import io
import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
_SHIPPED: set[str] = set()


def ship(spark: SparkSession, packages: tuple[str, ...] = ("pagetables", "acceptance")) -> SparkSession:
    """Send the Python modules to all executors, once per application; Spark serves the archive from the driver."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        archive = io.BytesIO()
        with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
            for package in packages:
                for f in sorted((ROOT / package).rglob("*.py")):
                    z.write(f, f.relative_to(ROOT))
        path = os.path.join(tempfile.mkdtemp(prefix="modules-"), "pagetables_modules.zip")
        Path(path).write_bytes(archive.getvalue())
        context.addPyFile(path)
        _SHIPPED.add(context.applicationId)
    return spark
