"""Make this package importable in the Python workers of a cluster."""

from __future__ import annotations

import io
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

import emberlog


def ship_package(spark: SparkSession) -> str:
    """Send the package's sources to all executors of the session; return the archive's path.

    Isolation forest and training-text operators run Python in workers, which import
    ``emberlog``.  Call this once where the package is not installed there and is not
    given by ``--py-files``.  The archive is made beside Spark's own files of the driver;
    Spark copies it to every executor.
    """
    root = Path(emberlog.__file__).parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
        for source in sorted(root.rglob("*.py")):
            archive.write(source, source.relative_to(root.parent))
    from pyspark import SparkFiles

    target = Path(SparkFiles.getRootDirectory()) / "emberlog.zip"
    target.write_bytes(packed.getvalue())
    spark.sparkContext.addPyFile(str(target))
    return str(target)
