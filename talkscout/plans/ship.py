"""Sending the package to the executors."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make the package importable in Python workers, wherever the driver was started; once for an application.

    Spark itself takes the archive from the driver to the executors, as it does with `--py-files`.
    """
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    name = os.path.basename(_PACKAGE)
    archive = os.path.join(tempfile.mkdtemp(prefix=f"{name}-"), f"{name}.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(_PACKAGE):
            for file in sorted(files):
                if file.endswith(".py"):
                    path = os.path.join(folder, file)
                    z.write(path, os.path.join(name, os.path.relpath(path, _PACKAGE)))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(application)
