"""This package on the Python workers of a cluster."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession


def ship_package(spark: SparkSession) -> None:
    """Give this package to the Python workers, once a session; does what --py-files would do."""
    context = spark.sparkContext
    if not getattr(context, "_botlens_shipped", False):
        root = Path(__file__).resolve().parents[1]
        archive = shutil.make_archive(f"{tempfile.mkdtemp(prefix='botlens-')}/botlens", "zip", root, "botlens")
        context.addPyFile(archive)
        context._botlens_shipped = True
