"""Sends the package to the executors of a session that was started without it on their path."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession

_SENT: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Once for each application: what --py-files does. Spark's file server hands the archive to the executors."""
    app = spark.sparkContext.applicationId
    if app in _SENT:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    folder = tempfile.mkdtemp()
    staged = os.path.join(folder, "package")
    shutil.copytree(os.path.join(root, "skein"), os.path.join(staged, "skein"), ignore=shutil.ignore_patterns("__pycache__"))
    spark.sparkContext.addPyFile(shutil.make_archive(os.path.join(folder, "skein"), "zip", staged))
    _SENT.add(app)
