"""Python workers need the package: it is sent to them unless their path has it already."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_sent: set[str] = set()


def ship(spark: SparkSession, root: str) -> None:
    app = spark.sparkContext.applicationId
    if app in _sent or root in map(os.path.abspath, os.environ.get("PYTHONPATH", "").split(os.pathsep)):
        return
    path = os.path.join(tempfile.mkdtemp(prefix="ledgerloom-"), "ledgerloom.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(os.path.join(root, "ledgerloom")):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, root))
    spark.sparkContext.addPyFile(path)
    _sent.add(app)
